from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_decontam import words
from test_lines import key as line_key
from test_shingles import brute_components

import corpus_pipeline as P
from microlake.llm import mixing, quality

D = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """The documents before and after each stage."""
    docs, out = spark.read.parquet(f"{D}/documents.parquet"), {}
    for name, stage in P.STAGES:
        after = P.stored(stage(spark, docs, D), name)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in df.collect())


def test_order_and_columns(steps):
    assert [name for name, _ in P.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "mixing"]
    for name, (before, after) in steps.items():
        assert after.columns == before.columns + ["pass_no", "virtual_finish"] * (name == "mixing")
        assert 0 < after.count() <= before.count() * (1 + (name == "mixing"))


def test_quality_by_plain_nearest_neighbours(spark, steps):
    before, after = steps["quality"]
    model, features = quality.fit(before, spark.read.parquet(f"{D}/labels.parquet")), quality.Features()
    want = Counter()
    for r in before.collect():
        ids, values = features.row(r["text"])
        v = sum((x * model.project[i].astype(float) for i, x in zip(ids, values, strict=True)), np.zeros(model.project.shape[1]))
        score = model.prior
        if np.linalg.norm(v) > 0:
            near = sorted(((float(w @ v / np.linalg.norm(v)), float(q)) for w, q in zip(model.vectors, model.labels, strict=True)), reverse=True)[: quality.NEIGHBOURS]
            votes = [(min(1.0, max(1e-6, c)) ** quality.POWER, q) for c, q in near]
            score = sum(w * q for w, q in votes) / sum(w for w, _ in votes)
        if score >= quality.THRESHOLD:
            want[tuple(r[c] for c in ("doc_id", "text", "lang", "source"))] += 1
    assert rows(after) == want and sum(want.values()) < before.count()


def test_line_dedup_by_brute_force(steps):
    before, after = steps["line_dedup"]
    held = {}
    for r in before.collect():
        for x in (r["text"] or "").split("\n"):
            held.setdefault(line_key(x), set()).add(r["doc_id"])
    often = {k: max(ids) for k, ids in held.items() if len(k) >= 40 and len(ids) >= 5}
    cut = lambda r: r["text"] and "\n".join(x for x in r["text"].split("\n") if often.get(line_key(x), r["doc_id"]) == r["doc_id"])
    want = Counter((r["doc_id"], cut(r), r["lang"], r["source"]) for r in before.collect())
    assert rows(after) == want and all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_near_dedup_by_brute_force(steps):
    before, after = steps["near_dedup"]
    docs = sorted(before.collect(), key=lambda r: r["doc_id"])
    root = brute_components([r["text"] for r in docs])
    assert rows(after) == rows_of(r for i, r in enumerate(docs) if root[i] == i) and after.count() < before.count()


def rows_of(some):
    return Counter(tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in some)


def test_decontamination_by_brute_force(spark, steps):
    before, after = steps["decontamination"]
    docs, windows = before.collect(), set()
    for r in spark.read.parquet(f"{D}/benchmark.parquet").collect():
        w = words(r["text"])
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))} - {()}
    sizes, hit = {len(g) for g in windows}, set()
    for r in docs:
        w = words(r["text"])
        if any(tuple(w[i : i + n]) in windows for n in sizes for i in range(len(w) - n + 1)):
            hit.add(r["doc_id"])
    assert rows(after) == rows_of(r for r in docs if r["doc_id"] not in hit)


def test_mixing_takes_what_the_queues_say(steps):
    before, after = steps["mixing"]
    passes = {(r["doc_id"], r["source"]): r["passes"] for r in mixing.mix_sizes(before).collect()}
    want = Counter()
    for r in before.collect():
        want[tuple(r[c] for c in ("doc_id", "text", "lang", "source"))] += passes[r["doc_id"], r["source"]]
    assert rows(after) == +want


def test_reads_its_own_output(spark, steps):
    docs = steps["mixing"][1].withColumns({"quality_score": F.lit(1.0), "n_lines": F.lit(2), "n_dropped": F.lit(3)})
    for _, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, D), "again")
    assert docs.count() > 0 and docs.columns[-2:] == ["pass_no_", "virtual_finish_"]


def test_odd_and_empty(spark, odd, empty):
    for name, stage in P.STAGES:
        out = stage(spark, odd, D)
        assert out.columns[: len(odd.columns)] == odd.columns and out.count() > 0, name
        assert stage(spark, empty, D).count() == 0, name
