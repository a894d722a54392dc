import random
import re

from pyspark.sql import functions as F

from microlake.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, width=10):
    windows = {}
    for i, t in items:
        w = words(t)
        for at in range(max(1, len(w) - width + 1) if w else 0):
            windows.setdefault(tuple(w[at : at + width]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for g, ids in windows.items():
            for at in range(len(w) - len(g) + 1):
                if tuple(w[at : at + len(g)]) == g:
                    hit |= set(range(at, at + len(g)))
                    found |= ids
        out.append((i, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


def run(docs, items):
    return sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in D.contamination(docs, items).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocabulary = ["The", "of", "über", "x1", "Aa", "bb", "cc"]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "-"]) for _ in range(n))
    items = [(1, make(13)), (2, make(4)), (3, "one"), (4, None), (5, ""), (None, make(10)), (6, "zz " * 12)]
    docs = [(i, make(rng.randint(0, 40))) for i in range(30)] + [(90, items[0][1] + " x " + items[0][1].upper()), (91, "ZZ " * 14), (92, None), (None, items[5][1]), (90, "one"), (90, "one")]
    got = run(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert got == brute(docs, items)


def test_odd_and_empty(spark, odd, empty):
    items = spark.createDataFrame([(1, "same row here"), (2, "word " * 10)], "item_id long, text string")
    rows = run(odd, items)
    assert len(rows) == odd.count()
    assert [r for r in rows if r[0] == 4 and r[2] == 3] == [(4, 3, 3, ["1"])] * 2
    assert (3, 30_000, 30_000, ["2"]) in rows and (1, 0, 0, []) in rows
    assert run(empty, items) == []
    assert all(r[2] == 0 for r in run(odd, items.limit(0)))
    kept = D.decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 3


def test_proximity(spark, docs_of):
    docs = docs_of(["alpha beta gamma delta", "alpha x beta gamma y delta", "delta gamma beta alpha"])
    phrases = D.Phrases(spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string"), 4)
    postings = D.stored(D.build_postings(docs, phrases.vocab), "p")
    slots = D.stored(phrases.slots(postings.groupBy("term_id").agg(F.count("*").alias("n"))), "s")
    assert {r["_id"] for r in D.phrase_matches(postings, slots).collect()} == {0}
    assert {r["_id"] for r in D.proximity_matches(postings, slots, 2).collect()} == {0, 1}
