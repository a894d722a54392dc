import random
import zlib

from microlake.llm import quality as Q


def texts(rng, n):
    word = lambda: "".join(rng.choice(["the", "er", "on", "an", "re"]) for _ in range(rng.randint(1, 3)))
    out = []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 80))]
        junk = i % 4 == 0
        out.append((i, " ".join(x + "&&&" if junk else x for x in w), "l", "s", 1, 0 if junk else 1))
    return out


def test_held_out_accuracy(spark):
    rows = texts(random.Random(1), 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, q int")
    labels = docs.selectExpr("doc_id", "q AS quality")
    extra = spark.createDataFrame([(None, 1), (5, None), (6, 7)], "doc_id long, quality int")
    model = Q.fit(docs.drop("q"), labels.unionByName(extra))
    got = {r["doc_id"]: r["quality_score"] for r in Q.score(docs.drop("q"), model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum((got[r[0]] >= 0.3) == bool(r[5]) for r in held) / len(held) > 0.97
    assert all(0 <= s <= 1 for s in got.values())


def test_odd_empty_and_unlabelled(spark, odd, empty):
    labels = spark.createDataFrame([(3, 0), (4, 1), (6, 1)], "doc_id long, quality int")
    model = Q.fit(odd, labels, sample=2)
    assert len(model.labels) <= 2
    out = Q.score(odd, model)
    assert out.columns == [*odd.columns, "quality_score_"]
    rows = out.collect()
    assert {r["quality_score_"] for r in rows if not (r["text"] or "").split()} == {model.prior}
    assert Q.score(empty, model).count() == 0
    none = Q.fit(odd, labels.limit(0))
    assert {r["quality_score_"] for r in Q.score(odd, none).collect()} == {1.0}
    assert {r["quality_score_"] for r in Q.score(odd, Q.fit(empty, labels)).collect()} == {1.0}


def test_scores_do_not_depend_on_blocks(monkeypatch):
    f = Q.Features()
    rows = [(*map(list, f.row(t)), q) for _, t, *_, q in texts(random.Random(2), 60)]
    m = Q.fit_rows(rows)
    import numpy as np

    v = np.array([np.asarray(values) @ m.project[ids] for ids, values, _ in rows])
    whole = m.scores(v)
    monkeypatch.setattr(Q, "BLOCK", 7)
    assert np.allclose(m.scores(v), whole)
