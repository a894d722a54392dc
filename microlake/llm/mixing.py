"""Mixing sources to target weights by weighted fair queueing.

Every document of a source stands in a queue in shuffled (hash) order, twice: once for each pass over the source. Its
virtual finish time is the number of its source's words up to and including it, divided by the source's target. The mix
is all entries in order of virtual finish time, cut where the words so far reach the sum of the targets.

Running sums are taken in two levels, first over hash ranges and then inside one, so no task gets a whole source.

Defined cases: null text has size 0; sources rank by code point and null comes last; sizes of 0 take nothing and have
target 0 if their whole source is empty; a null id has its place by its text; rows alike in id, text and source share
their fate; empty tables give an empty result. Other columns are passed on by mix(), not read; where they have the names of
the columns that mix() adds, those get a _ behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import NO_ID, doc_id, own_names, packed, stored, table, with_key

WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
#: Documents for which a range of hashes is made; a source's share of one range is summed in one task.
ROWS_A_RANGE = 20_000
#: Ranges at least, so that a source with many documents is spread at any size.
LEAST_RANGES = 128
#: Ranges of virtual finish time at least, of which the one with the cut is summed row by row; there are more of them as the
#: documents are more.
TIME_RANGES = 4096


def word_count(c: Column) -> Column:
    return F.coalesce(F.regexp_count(c, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) of (source, size) rows. A source's target is its weight's share of SHARE times all
    sizes; targets stop at PASSES times the source's size, and the others share the excess by weight.

    With sources ordered by cap over weight, the capped ones come first: a source is capped if the level that the rest
    would share, were all before it capped, is above its own cap."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    cycle = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (rank - 1) % len(WEIGHTS) + 1)
    ranked = by.select("source", "source_size", cycle.cast("long").alias("weight")).withColumn("cap", PASSES * F.col("source_size"))
    before = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy()
    level = ranked.select(
        "*", (SHARE * F.sum("source_size").over(whole)).alias("budget"), F.sum("weight").over(whole).alias("all_weight"),
        F.coalesce(F.sum("cap").over(before), F.lit(0)).alias("cap_before"), F.coalesce(F.sum("weight").over(before), F.lit(0)).alias("weight_before"),
    ).withColumn("free", (F.col("budget") - F.col("cap_before")) * F.col("weight") / (F.col("all_weight") - F.col("weight_before")) < F.col("cap"))
    first = level.select("*", F.when(F.col("free"), F.struct("weight_before", "cap_before")).alias("at"))
    at = F.min("at").over(whole)  # of the first that is not capped
    share = F.when(F.col("weight_before") >= at["weight_before"], (F.col("budget") - at["cap_before"]) * F.col("weight") / (F.col("all_weight") - at["weight_before"]))
    return first.select("source", "source_size", F.coalesce(share, F.col("cap").cast("double")).alias("target"))


def mix_sizes(docs: DataFrame) -> DataFrame:
    """One row for each document row: _id, _dk, doc_id, source, size, source_size, target, passes (times it is taken),
    finish (virtual finish time on the first pass)."""
    digest = F.md5(F.coalesce(F.when(F.col("_id") != NO_ID, F.col("_id")).cast("string"), F.concat(F.lit("text "), F.coalesce(F.col("_dk").cast("string"), F.lit("")))).cast("binary"))
    sized = stored(with_key(docs, F.col("source").cast("string").alias("source")).select("_id", "_dk", "source", word_count(F.col("text")).alias("size"), digest.alias("place")), "sizes")
    n = sized.count()
    ranges, slots = n // ROWS_A_RANGE + LEAST_RANGES, n * PASSES // ROWS_A_RANGE + TIME_RANGES
    sized = sized.withColumn("range", F.conv(F.substring("place", 1, 8), 16, 10).cast("long") * ranges / 2**32).withColumn("range", F.floor("range"))
    share = stored(targets(sized), "targets")
    # words of the source before each hash range, then inside the range
    part = sized.groupBy("source", "range").agg(F.sum("size").alias("part"))
    earlier = W.partitionBy("source").orderBy("range").rowsBetween(W.unboundedPreceding, -1)
    starts = part.select("source", "range", F.coalesce(F.sum("part").over(earlier), F.lit(0)).alias("start"))
    inside = W.partitionBy("source", "range").orderBy("place", "_id", "_dk").rangeBetween(W.unboundedPreceding, W.currentRow)
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    queued = sized.withColumn("inside", F.sum("size").over(inside))
    queued = queued.join(starts, same(queued, starts) & (queued["range"] == starts["range"])).drop(starts["source"], starts["range"])
    queued = queued.join(share, same(queued, share)).drop(share["source"])
    done = F.when(F.col("target") > 0, (F.col("start") + F.col("inside")) / F.col("target"))
    queued = stored(queued.select("_id", "_dk", "source", "size", "source_size", "target", "place", done.alias("finish"), F.when(F.col("target") > 0, F.col("source_size") / F.col("target")).alias("lap")), "queued")
    # the cut, in order of virtual finish time
    entries = queued.filter("size > 0 AND finish IS NOT NULL").select("size", "place", "_id", "_dk", F.explode(F.transform(F.sequence(F.lit(0), F.lit(PASSES - 1)), lambda i: F.struct(i.alias("lap_no"), (F.col("finish") + F.col("lap") * i).alias("at")))).alias("e")).select("size", "place", "_id", "_dk", "e.*")
    slot = F.least(F.floor(F.col("at") * (slots // PASSES)), F.lit(slots - 1).cast("long")).alias("slot")
    entries = entries.withColumn("slot", slot)
    loads = entries.groupBy("slot").agg(F.sum("size").alias("load"))
    budget = share.agg(F.sum("target").alias("budget"))
    sums = loads.select("slot", F.sum("load").over(W.orderBy("slot")).alias("sum"), "load").crossJoin(F.broadcast(budget))
    edge = sums.filter(F.col("sum") > F.col("budget")).orderBy("slot").limit(1).select("slot", (F.col("sum") - F.col("load")).alias("base"), "budget")
    order = ["at", "place", "lap_no", "_id", "_dk"]
    run = entries.join(F.broadcast(edge), "slot").withColumn("sum", F.col("base") + F.sum("size").over(W.partitionBy("slot").orderBy(*order).rangeBetween(W.unboundedPreceding, W.currentRow)))
    beyond = run.filter(F.col("sum") > F.col("budget")).agg(F.min(F.struct(*order)).alias("cut"))
    taken = lambda i: F.coalesce(F.col("cut").isNull() | (F.struct((F.col("finish") + F.col("lap") * i).alias("at"), F.col("place"), F.lit(i).alias("lap_no"), F.col("_id"), F.col("_dk")) < F.col("cut")), F.lit(False)) & F.col("finish").isNotNull() & (F.col("size") > 0)
    passes = sum((taken(i).cast("int") for i in range(PASSES)), F.lit(0))
    return queued.crossJoin(F.broadcast(stored(beyond, "cut"))).select("_id", "_dk", doc_id(), "source", "size", "source_size", "target", passes.alias("passes"), "finish", "lap")


def _source_key(c: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), c), F.lit("n")).alias("_sk")  # tells null from any text


def mix(docs: DataFrame) -> DataFrame:
    """The mix: each document row as often as it is taken, with pass_no and virtual_finish beside its own columns, sorted
    by virtual finish time over all partitions."""
    key, names = ["_id", "_dk", "_sk"], own_names(docs, "pass_no virtual_finish")
    chosen = mix_sizes(docs).filter("passes > 0").select("_id", "_dk", _source_key(F.col("source")), "passes", "finish", "lap")
    chosen = chosen.groupBy(*key).agg(F.max("passes").alias("passes"), F.min("finish").alias("finish"), F.max("lap").alias("lap"))
    keyed = with_key(docs, _source_key(F.col("source").cast("string")), packed(docs)).drop("text")
    both = keyed.join(chosen, key).withColumn("no", F.explode(F.sequence(F.lit(0), F.col("passes") - 1)))
    out = both.select("row.*", F.col("no").alias(names["pass_no"]), (F.col("finish") + F.col("lap") * F.col("no")).alias(names["virtual_finish"]))
    return out.repartitionByRange(names["virtual_finish"]).sortWithinPartitions(names["virtual_finish"])


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sizes(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target", (F.col("size") * F.col("passes")).cast("long").alias("taken"))


ORACLE = {
    "op7_source_mixing": r"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5(CAST(doc_id AS VARCHAR)) AS place FROM documents),
s AS (SELECT source, sum(size) AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT source, n, 2 * n AS cap, CASE (r - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
t AS (SELECT 1.5::DOUBLE * (SELECT sum(n) FROM s) AS budget),
lev AS (SELECT *, (SELECT coalesce(sum(cap), 0) FROM w b WHERE b.cap / b.w < a.cap / a.w OR (b.cap / b.w = a.cap / a.w AND b.source < a.source)) AS cb,
               (SELECT coalesce(sum(w), 0) FROM w b WHERE b.cap / b.w < a.cap / a.w OR (b.cap / b.w = a.cap / a.w AND b.source < a.source)) AS wb,
               (SELECT sum(w) FROM w) AS aw FROM w a, t),
f AS (SELECT min(wb) AS wb, min(cb) AS cb FROM lev WHERE (budget - cb) * w / (aw - wb) < cap),
g AS (SELECT source, n, CASE WHEN lev.wb >= f.wb THEN (budget - f.cb) * w / (aw - f.wb) ELSE CAST(cap AS DOUBLE) END AS target FROM lev, f),
q AS (SELECT doc_id, place, size, n, target,
             CAST(sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id) AS DOUBLE) / target AS fin, CAST(n AS DOUBLE) / target AS lap
      FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
e AS (SELECT doc_id, place, size, 0 AS lap_no, fin AS vf FROM q WHERE size > 0 UNION ALL SELECT doc_id, place, size, 1, fin + lap * 1 FROM q WHERE size > 0),
c AS (SELECT *, sum(size) OVER (ORDER BY vf, place, lap_no, doc_id) AS run FROM e),
k AS (SELECT doc_id, count(*) AS passes FROM c WHERE run <= (SELECT sum(target) FROM g) GROUP BY 1)
SELECT q.doc_id, size, CAST(n AS BIGINT) AS source_size, target, CAST(size * coalesce(passes, 0) AS BIGINT) AS taken FROM q LEFT JOIN k USING (doc_id)
""",
}
QUERIES = {"op7_source_mixing": op7_source_mixing}
