import pytest

from microlake.llm import mixing as M


def fill(sizes):
    """Targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    budget, target, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (budget - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def rows(spark):
    out = [(i, " ".join(["w"] * (i % 37)), ["b", "a", "é", None, "c"][min(i % 9, 4)]) for i in range(900)]
    return spark.createDataFrame(out, "doc_id long, text string, source string")


def test_targets_and_takes(spark):
    got = M.mix_sizes(rows(spark)).collect()
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["size"] * r["passes"]
    want = fill(sizes)
    for r in got:
        assert r["target"] == pytest.approx(want[r["source"]]) and r["source_size"] == sizes[r["source"]] and 0 <= r["passes"] <= 2
    for s, t in want.items():
        assert abs(taken[s] - t) <= 60
    again = {(r["doc_id"], r["passes"]) for r in M.mix_sizes(rows(spark).repartition(7)).collect()}
    assert again == {(r["doc_id"], r["passes"]) for r in got}


def test_mix_repeats_documents_in_order_of_finish(spark):
    mixed = M.mix(rows(spark))
    assert mixed.columns == ["doc_id", "text", "source", "pass_no", "virtual_finish"]
    passes = {r["doc_id"]: r["passes"] for r in M.mix_sizes(rows(spark)).collect() if r["passes"]}
    found = {}
    for r in mixed.collect():
        found[r["doc_id"]] = found.get(r["doc_id"], 0) + 1
    assert found == passes
    finish = [r["virtual_finish"] for r in mixed.collect()]
    assert finish == sorted(finish)


def test_one_text_under_two_sources(spark):
    rows_of = [(1000, "one two three", "a"), (1000, "one two three", "zz"), *((i, "w " * 50, "ab"[i % 2]) for i in range(40))]
    docs = spark.createDataFrame(rows_of, "doc_id long, text string, source string")
    passes = {(r["doc_id"], r["source"]): r["passes"] for r in M.mix_sizes(docs).collect()}
    found = {}
    for r in M.mix(docs).collect():
        found[r["doc_id"], r["source"]] = found.get((r["doc_id"], r["source"]), 0) + 1
    assert found == {k: n for k, n in passes.items() if n}


def test_null_ids_are_dealt_out(spark):
    from pyspark.sql import functions as F

    docs = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"), F.lit("s").alias("source"))
    got = M.mix_sizes(docs).collect()
    assert len({r["finish"] for r in got}) == 300 and abs(sum(r["passes"] * r["size"] for r in got) - 900) <= 2


def test_odd_and_empty(odd, empty):
    assert M.mix_sizes(empty).count() == 0 and M.mix(empty).count() == 0
    got = M.mix_sizes(odd).collect()
    assert len(got) == odd.count() and all(r["passes"] == 0 for r in got if r["size"] == 0)
    assert set(odd.columns) < set(M.mix(odd).columns)
    assert all(r["passes"] == 0 and r["target"] == 0 for r in M.mix_sizes(odd.filter("size(split(text, 'q')) > 9 OR text = ''")).collect())
