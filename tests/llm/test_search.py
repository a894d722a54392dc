import math
import random
import re

import numpy as np

from microlake.llm import search as S

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=50):
    """All scores by the formula, one document after another."""
    held = [(-(2**63) if i is None else i, w) for i, t in docs if (w := words(t))]
    n, total = len(held), sum(len(w) for _, w in held)
    df = {}
    for _, w in held:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    terms = {}
    for i, t in items:
        terms.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in terms.items():
        scored = []
        for i, w in held:
            m = 50 + (50 * len(w) * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((10**9 * w.count(t)) // (1000 * w.count(t) + 20 * m)) for t in ts if t in df and t in w)
            if s > 0:
                scored.append((-s, i))
        out += [(item, r, None if i == -(2**63) else i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def run(docs, items, k=50):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in S.search(docs, items, k).collect()), key=str)


def made(n, seed=4):
    rng = random.Random(seed)
    pool = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(2000)] + ["Über", "日本", "X-y"]
    text = lambda m: " ".join(rng.choice(pool) for _ in range(m))
    docs = [(i, text(rng.randint(1, 60))) for i in range(n)]
    return docs + [(n + i, docs[i][1]) for i in range(0, n, 5)], [(i, text(rng.randint(1, 30))) for i in range(12)]


def test_against_brute_force(spark, monkeypatch):
    docs, items = made(300)
    docs += [(None, "w1 w2 w3 Über"), (900, None), (901, ""), (902, "-- !"), (903, docs[0][1].upper()), (903, docs[0][1])]
    items += [(3, "w1 w2"), (None, "w2 über"), (77, None), (78, "nowhere"), (79, "W1")]
    d, i = spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS)
    expected = brute(docs, items)
    assert run(d, i) == expected
    for name, value in (("SHARD_DOCS", 16), ("DEPTH", 2), ("DEEPER", 2), ("FIRST_SHARDS", 3), ("BLOCK_TERMS", 60)):
        monkeypatch.setattr(S, name, value)
    assert run(d, i) == expected  # many shards, rounds and blocks
    assert run(d, i, 3) == brute(docs, items, 3)


def test_lists_are_read_as_deep_as_needed():
    """Unlike documents are left unread; ties at the end of the best are all resolved."""
    n = 10_000
    ids = np.arange(n)
    steep = np.sort(np.random.default_rng(1).integers(1, 10**6, n) ** 3 // 10**12)[::-1].astype(np.int32)
    lists = [(np.random.default_rng(2).permutation(n).astype(np.int32), steep, 7), (np.arange(100, dtype=np.int32), np.arange(100_000_000, 99_999_900, -1).astype(np.int32), 9)]
    whole = np.zeros(n, np.int64)
    for docs, impacts, w in lists:
        whole[docs] += w * impacts.astype(np.int64)
    best, scores, read = S.nra(lists[1:], ids, 5)
    assert best.tolist() == [0, 1, 2, 3, 4]
    best, scores, read = S.nra(lists, ids, 10)
    order = np.lexsort((ids, -whole))[:10]
    assert best.tolist() == order.tolist() and scores.tolist() == whole[order].tolist()
    flat = [(np.arange(n, dtype=np.int32)[::-1].copy(), np.full(n, 5, np.int32), 3)]
    best, scores, read = S.nra(flat, ids, 4)
    assert best.tolist() == [0, 1, 2, 3] and read == n
    assert len(S.nra(flat, ids, 4, 16)[0]) == 0 and S.nra(flat, ids, 4, 16)[2] == S.DEPTH


def test_odd_and_empty(spark, odd, empty):
    items = spark.createDataFrame([(1, "same row here"), (2, "word"), (3, "über straße 日本語")], ITEMS)
    rows = run(odd, items)
    assert [r[2] for r in rows if r[0] == 1] == [4, 4, 4] and [r[2] for r in rows if r[0] == 2] == [3] and [r[2] for r in rows if r[0] == 3] == [6]
    assert run(empty, items) == [] and run(odd, items.limit(0)) == []
