import random
import re

from microlake.llm import licenses as L


def brute(text):
    words = L.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    starts, labels = [], set()
    for phrase, label in L.PHRASES.items():
        p = phrase.split()
        for i in range(len(words) - len(p) + 1):
            if words[i : i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_base_against_brute_force():
    scanner, rng = L.Scanner(L.build_rules()), random.Random(6)
    parts = ["GNU", "General", "public", "license", "Apache", "cc", "CC", "by", "MIT", "ébyé", "x", "2.0"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) + rng.choice([" ", "-", ", ", "\n", ""]) for _ in range(rng.randint(0, 14)))
        assert scanner.scan(text)[:5] == brute(text), text
    assert scanner.scan(None) == scanner.scan("") == (0, 0, None, None, "", "", 0.0)


def test_rules():
    rules = L.build_rules()
    assert len(rules) > 300
    scanner = L.Scanner(rules)
    label = lambda t: scanner.scan(t)[5].split(",")
    assert "gpl-2-or-later" in label("GNU General Public License, version 2 or (at your option) any later version")
    assert "gpl-3" in label("under the GNU GPL v3") and "apache-2.0" in label("the Apache License, Version 2.0")
    assert "cc-by-nc-4.0" in label("Licensed under CC BY-NC 4.0.") and "bsd-3-clause" in label("the 3-Clause BSD License")
    assert label("Permission is hereby granted, free of charge, to any person obtaining a copy of this software") == ["mit"]
    assert label("nothing of the kind") == [""]


def test_weaker_detections_inside_stronger_ones_go():
    scanner = L.Scanner(L.build_rules())
    found = [r.label for _, _, r in scanner.detections("gnu general public license version 2 or later")]
    assert found == ["gpl-2-or-later"]
    every = [(m.start(), m.end(), r.priority) for r in scanner.rules for m in r.pattern.finditer("gnu general public license version 2 or later")]
    assert len(every) > 1


def test_keywords_gate_only_what_cannot_match():
    rules = L.build_rules()
    scanner, rng = L.Scanner(rules), random.Random(2)
    words = sorted({k for r in rules for k in r.keywords})
    for _ in range(300):
        text = " ".join(rng.choice(words + ["license", "version", "2 0", "public", "general", "the"]) for _ in range(8))
        tried = {i for _, at in scanner.gate.iter(text) for i in at}
        assert not any(r.pattern.search(text) for i, r in enumerate(rules) if i not in tried)


def plain(rules, text):
    """Labels and score with every rule tried on the whole text and each detection compared with every other."""
    normal = " ".join(L.WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text)))
    found = [(m.start(), m.end(), r.priority, r.label) for r in rules for m in r.pattern.finditer(normal)]
    inside = lambda x, y: y[0] <= x[0] and x[1] <= y[1]
    longer = lambda x, y: (y[1] - y[0]) > (x[1] - x[0])
    kept = [x for i, x in enumerate(found) if not any(inside(x, y) and (y[2] > x[2] or y[2] == x[2] and (longer(x, y) or y[:2] == x[:2] and j < i)) for j, y in enumerate(found))]
    base = set(filter(None, brute(text)[4].split(",")))
    return ",".join(sorted(base | {x[3] for x in kept})), max([0.0, *(min(1.0, x[2] / 100) for x in kept), *(0.5 for _ in base)])


def test_labels_and_score_against_a_plain_evaluation():
    rules, rng = L.build_rules(), random.Random(12)
    scanner = L.Scanner(rules)
    for _ in range(120):
        parts = [_match_of(re._parser.parse(rng.choice(rules).pattern.pattern), rng) for _ in range(3)] + ["of this", "MIT License,", "CC-BY", "version 2 or later"]
        text = " ".join(rng.choice(parts) for _ in range(rng.randint(1, 7)))
        assert scanner.scan(text)[5:] == plain(rules, text), text


def test_odd_and_empty(odd, empty):
    out = L.scan_licenses(odd)
    assert out.columns == [*odd.columns, "license_scan_"] and out.count() == odd.count()
    assert L.scan_licenses(empty).count() == 0


def _match_of(parsed, rng):
    out = ""
    for op, arg in parsed:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op in ("ANY", "NOT_LITERAL"):
            out += "w"
        elif op == "IN":
            kind, value = rng.choice(arg)
            out += chr(value if str(kind) == "LITERAL" else value[0])
        elif op.endswith("REPEAT"):
            out += "".join(_match_of(arg[2], rng) for _ in range(rng.randint(arg[0], min(arg[1], arg[0] + 2))))
        elif op == "SUBPATTERN":
            out += _match_of(arg[3], rng)
        elif op == "BRANCH":
            out += _match_of(rng.choice(arg[1]), rng)
        else:
            assert op == "ASSERT_NOT", op
    return out


def test_gate_passes_all_matches():
    rules, rng = L.build_rules(), random.Random(4)
    scanner = L.Scanner(rules)
    for i, r in enumerate(rules):
        for _ in range(6):
            text = _match_of(re._parser.parse(r.pattern.pattern), rng)
            assert r.pattern.search(text), (r.label, text)
            assert i in {j for _, at in scanner.gate.iter(text) for j in at}, (r.label, text)


def test_notices():
    scanner = L.Scanner(L.build_rules())
    label = lambda t: scanner.scan(t)[5].split(",")
    fsf = "the GNU {} as published by the Free Software Foundation"
    gpl, lgpl = fsf.format("General Public License"), fsf.format("Lesser General Public License")
    assert label(f"{gpl}, either version 2 of the License, or (at your option) any later version.") == ["gpl", "gpl-2-or-later"]
    assert label(f"{gpl}; version 2 of the License.") == ["gpl", "gpl-2"]
    assert label(f"{lgpl}; either version 2.1 of the License, or (at your option) any later version.") == ["lgpl-2.1-or-later"]
    assert label("the LaTeX Project Public License, either version 1.3 of this license or (at your option) any later version.") == ["lppl-1.3-or-later"]
    assert label("Licensed under the EUPL, Version 1.2 or – as soon they will be approved by the European Commission - subsequent versions of the EUPL") == ["eupl-1.2-or-later"]
    assert "mpl-2.0" in label("SPDX-License-Identifier: MPL-2.0") and label("licensed under EPL 2.0") == ["epl-2.0"]
