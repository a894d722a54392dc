import random
import re
from collections import Counter
from itertools import permutations

from microlake.llm import filters as A


def brute(docs, labels):
    """A plain evaluation of all orders. docs: (id, text, source)."""
    least, good, toxic = {}, set(), set()
    for i, q, t in labels:
        good |= {i} if q == 1 else set()
        toxic |= {i} if t == 1 else set()
    low = lambda i: -(2**63) if i is None else i
    for i, t, _ in docs:
        least[t or ""] = min(least.get(t or "", 2**63), low(i))
    fails = []
    for i, t, s in docs:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        f = "A" * (len(w) < 50) + "B" * (100 * len(set(w)) < 65 * len(w)) + "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t))
        fails.append((s or "", f + "D" * bool(re.search(r"[#$%&*|]", t)) + "E" * (low(i) > least[t]), i in good and i is not None, i in toxic and i is not None))
    out, shapley = {}, Counter()
    for part in {p for p, *_ in fails}:
        for order in map("".join, permutations("ABCDE")):
            left = [x for x in fails if x[0] == part]
            for step, x in enumerate(order, 1):
                here = [r for r in left if x in r[1]]
                left = [r for r in left if x not in r[1]]
                redundant = sum(p == part and x in f for p, f, *_ in fails) - len(here)
                out[part, order, step] = (len(left), len(here), redundant, sum(p == part and f == x for p, f, *_ in fails), sum(r[2] for r in here), sum(r[3] for r in here))
                shapley[part, x] += len(here)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def run(docs, labels):
    rows = A.audit(docs, labels).collect()
    found = {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"], r["unique_fails"], r["good_lost"], r["toxic_lost"], r["shapley"]) for r in rows}
    assert len(found) == len(rows)
    return found


SCHEMA = "doc_id long, text string, source string"
LABELS = "doc_id long, quality int, toxic int"


def made(n, seed=5):
    rng = random.Random(seed)
    texts = []
    for _ in range(n):
        size, pool = rng.choice([3, 49, 50, 51, 200]), rng.choice([["a", "b"], [f"w{i}" for i in range(150)], ["Über", "A", "ab", "c d"]])
        texts.append(rng.choice(["", "$ "]) + rng.choice([" ", "\n", "\t\x0b"]).join(rng.choice(pool) for _ in range(size)) if rng.random() > 0.2 or not texts else rng.choice(texts))
    return [(i, t, rng.choice(["s1", "s2", None])) for i, t in enumerate(texts)]


def test_against_a_plain_evaluation(spark, monkeypatch):
    docs = [*made(60), (70, None, "s1"), (71, "", "s1"), (None, "", None), (72, "same", "s2"), (72, "same", "s2"), (73, "same", "s2")]
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 75, 3)] + [(None, 1, 1), (3, 1, None)]
    expected = brute(docs, labels)
    got = run(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert got == expected
    monkeypatch.setattr(A, "TOKENS", 100)  # many shards
    assert run(spark.createDataFrame(docs, SCHEMA).repartition(3), spark.createDataFrame(labels, LABELS)) == expected


def test_matrix_holds_the_counts_in_one_dictionary(spark):
    docs = made(25)
    matrix, words = A.document_term_matrix(spark.createDataFrame(docs, SCHEMA).repartition(4))
    name = {r["column"]: bytes(r["word"]).decode() for r in words.collect()}
    assert len(set(name.values())) == len(name)
    found = {}
    for r in matrix.collect():
        for k, i in enumerate(r["ids"]):
            a, b = r["starts"][k], r["starts"][k + 1]
            assert list(r["columns"][a:b]) == sorted(r["columns"][a:b])
            found[i] = Counter(dict(zip([name[c] for c in r["columns"][a:b]], r["counts"][a:b])))
            assert r["sums"][k] == sum(r["counts"][a:b]) and r["nonzeros"][k] == b - a
    assert found == {i: Counter(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t, _ in docs}


def test_words_that_share_a_column_get_another_seed(spark, monkeypatch):
    """Under the first seed all words fall into three columns."""
    docs, plain = made(20), A.column_of
    monkeypatch.setattr(A, "column_of", lambda word, seed: plain(word, seed) % 3 if seed == 0 else plain(word, seed))
    d = spark.createDataFrame(docs, SCHEMA)
    assert A.dictionary(d, 0).filter("other IS NOT NULL").count() == 3 and A.dictionary(d, 1).filter("other IS NOT NULL").count() == 0
    labels = [(i, 1, 1) for i in range(20)]
    assert run(d, spark.createDataFrame(labels, LABELS)) == brute(docs, labels)


def test_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 1), (4, 0, 1)], LABELS)
    rows = A.audit(odd.drop("score"), labels).collect()
    assert sum(r["kept"] + r["removed"] for r in rows if r["filter_order"] == "ABCDE" and r["step"] == 1) == odd.count()
    assert sum(r["toxic_lost"] for r in rows if r["filter_order"] == "ABCDE") == 4
    assert A.audit(empty, labels).count() == 0
    assert A.audit(odd, labels.limit(0)).count() == 600 * 4
