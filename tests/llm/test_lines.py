import hashlib
import random
import time

import numpy as np
import pytest

from microlake.llm import lines as L


def key(line):
    k = line.strip(" \t\n\x0b\x0c\r")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in k)


def brute(docs):
    seen = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                seen.setdefault(key(x), set()).add(-(2**63) if i is None else i)
    many = {k: max(v) for k, v in seen.items() if len(v) >= 5}
    out = []
    for i, t in docs:
        every = (t or "").split("\n")
        stay = [x for x in every if key(x) not in many or many[key(x)] == (-(2**63) if i is None else i)]
        out.append((i, len(every), len(every) - len(stay), hashlib.sha256("\n".join(stay).encode()).hexdigest()))
    return sorted(out, key=str)


def run(df):
    from pyspark.sql import functions as F

    out = L.dedup_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def docs(rng):
    pool = ["É" * 39 + "Z", "A shared line of more than forty characters, Number " + "x" * 5, "short", "", "b" * 40, "b" * 39]
    change = lambda x: rng.choice([x, x.upper() if x.isascii() else x, f"  {x}\t"])
    return [(i, "\n".join(change(rng.choice(pool)) for _ in range(rng.randint(0, 8)))) for i in range(25)] + [(100, None), (None, pool[1]), (3, pool[1]), (3, pool[1]), (200, "\n".join([pool[4]] * 3))]


@pytest.mark.parametrize("filters", [True, False])
def test_against_brute_force(spark, monkeypatch, filters):
    if not filters:
        monkeypatch.setattr(L, "FILTER_BYTES", 0)
    rows = docs(random.Random(5))
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_odd_and_empty(odd, empty):
    assert L.dedup_lines(empty).count() == 0
    out = L.dedup_lines(odd)
    assert out.columns == [*odd.columns, "n_lines_", "n_dropped_"] and out.count() == odd.count()


def test_insertion_and_deletion_are_undone(spark, docs_of):
    line = "this line is in many documents, and is long enough"
    first, more = docs_of([line] * 4), docs_of([line] * 2, 10)
    refs = L.references(first)
    assert L.repeated(refs).count() == 0
    grown = L.insert(refs, more)
    assert L.repeated(grown).first()["keeper"] == 11
    back = L.delete(grown, more)
    assert back.count() == refs.count() and L.repeated(back).count() == 0
    assert L.repeated(L.delete(grown, spark.createDataFrame([(11,)], "doc_id long"))).first()["keeper"] == 10


def test_changes_reach_the_filters_and_are_undone(spark, docs_of):
    a, b = "a line of many documents, which is long enough", "another of these lines, which is long enough, too"
    first, more = docs_of([f"{a}\n{b}"] * 4 + [b]), docs_of([a, f"{a}\n{b}", "short"], 10)
    refs = L.references(first)
    filters = L.build_filters(L.repeated(refs).select("h1", "h2"), 1)
    state = lambda r, f: (sorted(map(tuple, r.collect())), [x["n"] for x in f.collect()])
    known = lambda f, x: bool(L.CuckooFilter.load(bytes(f.first()["filter"])).contains(*np.array([L.line_key(x)]).T)[0])
    assert not known(filters, a) and known(filters, b)
    grown, filters2 = L.change(refs, filters, 1, added=more)
    assert known(filters2, a) and known(filters2, b)
    back, filters3 = L.change(grown, filters2, 1, deleted=more)
    assert state(back, filters3) == state(refs, filters) and not known(filters3, a) and known(filters3, b)
    # a document whose text changes goes and comes in one call
    swapped, filters4 = L.change(refs, filters, 1, added=docs_of([a], 4), deleted=spark.createDataFrame([(4,)], "doc_id long"))
    assert known(filters4, a) and not known(filters4, b) and swapped.count() == refs.count()


def test_long_texts_and_clashing_names(spark):
    from pyspark.sql import functions as F

    line = "a line that is in six documents and is long enough"
    rows = [(i, "\n".join([line, *map(str, range(200_000))]) if i == 0 else "\n".join([line] * 50_000 if i == 1 else [line])) for i in range(6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"n_lines": F.lit("mine"), "n_dropped": F.lit(1)})
    began = time.time()
    got = {r["doc_id"]: r for r in L.dedup_lines(docs).collect()}
    assert time.time() - began < 60
    assert got[0]["text"] == "\n".join(map(str, range(200_000))) and (got[0]["n_lines_"], got[0]["n_dropped_"], got[0]["n_lines"]) == (200_001, 1, "mine")
    assert (got[1]["text"], got[1]["n_dropped_"], got[5]["text"]) == ("", 50_000, line)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    h = rng.integers(-(2**63), 2**63 - 1, (3000, 2))
    f = L.CuckooFilter.sized(1500)
    for a, b in h[:1500]:
        f.insert(a, b)
    f = L.CuckooFilter.load(f.dump())
    assert f.contains(h[:1500, 0], h[:1500, 1]).all()
    assert f.contains(h[1500:, 0], h[1500:, 1]).mean() < 0.01
    assert all(f.delete(a, b) for a, b in h[:700])
    assert f.contains(h[700:1500, 0], h[700:1500, 1]).all()
    assert f.contains(h[:700, 0], h[:700, 1]).mean() < 0.01
    full = L.CuckooFilter(1)  # overflows into its list
    for a, b in h[:40]:
        full.insert(a, b)
    assert full.contains(h[:40, 0], h[:40, 1]).all()


def test_filters_are_updated(spark):
    h = [(int(a), int(b)) for a, b in np.random.default_rng(2).integers(-(2**63), 2**63 - 1, (60, 2))]
    frame = lambda rows: spark.createDataFrame(rows, "h1 long, h2 long")
    filters = L.update_filters(L.build_filters(frame(h[:40]), 2), frame(h[40:]), frame(h[:10]), 2)
    known = {r["shard"]: L.CuckooFilter.load(bytes(r["filter"])) for r in filters.collect()}
    held = [bool(known[(a >> 63) & 1].contains(np.array([a]), np.array([b]))[0]) for a, b in h]
    assert all(held[10:]) and not any(held[:10]) and sum(r["n"] for r in filters.collect()) == 50
