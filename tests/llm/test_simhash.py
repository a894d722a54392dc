import random

import numpy as np
import xxhash

from microlake.llm import simhash as S


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate({i: 32 for i in range(9, 14)}).split(" ") if w]
    if not words:
        return 0
    runs = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(prints, distance=4):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints():
    rng = random.Random(1)
    for _ in range(60):
        text = "".join(rng.choice(["a", "É", "B", " ", "\n", "\x0b", "word ", " "]) for _ in range(rng.randint(0, 80)))
        assert S.fingerprint(text) & (2**64 - 1) == brute_print(text)
    assert S.fingerprint(None) == S.fingerprint(" \t") == 0


def _prints(rng, n, families):
    centres = [rng.getrandbits(64) for _ in range(families)]
    out = [0, 0]
    for _ in range(n):
        x = rng.choice(centres)
        for b in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 7])):
            x ^= 1 << b
        out.append(x)
    return out


def _components(spark, prints):
    fps = spark.createDataFrame([(int(np.uint64(x).astype(np.int64)),) for x in sorted(set(prints))], "fp long")
    roots = {r["node"]: r["root"] for r in S.components(S.links(fps)).collect()}
    groups = {}
    for x in set(prints):
        s = int(np.uint64(x).astype(np.int64))
        groups.setdefault(roots.get(s, s), set()).add(x)
    return {frozenset(g) for g in groups.values()}


def test_no_link_is_lost(spark):
    prints = sorted(set(_prints(random.Random(7), 400, 25)))
    want = {}
    for x, r in zip(prints, brute_components(prints), strict=True):
        want.setdefault(r, set()).add(x)
    assert _components(spark, prints) == {frozenset(g) for g in want.values()}


def test_large_groups_are_split_and_whole(spark, monkeypatch):
    monkeypatch.setattr(S, "LARGE_GROUP", 128)
    monkeypatch.setattr(S, "BLOCK", 64)
    prints = sorted(set(_prints(random.Random(9), 900, 2)))
    want = {}
    for x, r in zip(prints, brute_components(prints), strict=True):
        want.setdefault(r, set()).add(x)
    assert _components(spark, prints) == {frozenset(g) for g in want.values()}


def test_long_chains(spark):
    prints = [(1 << i) - 1 for i in range(0, 61, 4)]  # each within 4 of the next
    assert len(_components(spark, prints)) == 1


def test_deduplicate_odd_and_empty(odd, empty, docs_of):
    text = "one two three four five six seven eight nine ten " * 5
    docs = docs_of([text + "x", text + "x", text + "x", "quite another text of some words, alone in its group"], 3)
    assert sorted(r["doc_id"] for r in S.deduplicate(docs).collect()) == [3, 6]
    assert S.deduplicate(empty).count() == 0 and S.near_duplicates(empty).count() == 0
    out = S.deduplicate(odd)
    assert out.columns == odd.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert kept.count((4, "same row here")) == 1 and (1, None) in kept and (2, "") not in kept


def test_query_end_to_end(spark, tmp_path):
    """Fingerprints and components of whole texts, nulls and ties among them, against brute force."""
    rng = random.Random(14)
    words = [f"w{i}" for i in range(400)]
    texts = [None, "", " \t", "One", "one", "a b c", "A b  c\n"]
    for _ in range(6):
        base = rng.choices(words, k=rng.choice([40, 300]))
        for _ in range(6):
            now = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                now[rng.randrange(len(now))] = rng.choice(words)
            texts.append(" ".join(now))
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k]) for i, k in enumerate(order)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    prints = [brute_print(t) for _, t in rows]
    want = {(i, f"{x:016x}", c) for (i, _), x, c in zip(rows, prints, brute_components(prints), strict=True)}
    got = {tuple(r) for r in S.op5_simhash_near_dedup(spark, str(tmp_path)).select("doc_id", "fingerprint", "component_id").collect()}
    assert got == want and len({c for *_, c in want}) < len(rows) - 10
