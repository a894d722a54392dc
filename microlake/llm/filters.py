"""Filter interaction audit over a sparse document-term matrix.

Words are encoded by one global dictionary: a word's column is its 64-bit hash, and the dictionary, in which each word stands once,
proves that no two words share a column; otherwise the hash gets another seed. The matrix is cut into shards of bounded size,
blocks of documents in compressed rows, which tasks build by themselves as soon as the dictionary is proven. Sums and nonzero
counts of the rows are the documents' words and distinct words. From these, two flags of the text and the copies of each text come
the filters that a document fails; documents are counted by part and set of failed filters, and each order of the filters is told
from these counts.

Defined cases: a null text is an empty one and has no words; a null source is part ''; a null id is smaller than all
others; rows that repeat id and text are no copies of each other; of several labels of an id, one with 1 suffices; an empty
table gives an empty result. Columns other than doc_id, text, source, quality and toxic are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import count, permutations

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, stored, table

LETTERS = "ABCDE"
#: Words from which a shard is closed; it holds one document more than that at most.
TOKENS = 1 << 17
#: Different words that a task gathers for the dictionary before it sends them on.
GATHERED = 1 << 19
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5
_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = re.compile(rb"[#$%&*|]")
MATRIX = """shard long, ids array<long>, parts array<string>, texts array<binary>, flags array<int>,
starts array<int>, columns array<long>, counts array<int>, sums array<long>, nonzeros array<long>"""


def words_of(text: str) -> tuple[bytes, list[bytes]]:
    raw = text.encode("utf-8", "surrogatepass")
    return raw, raw.split()  # of bytes: at ASCII white space alone


def column_of(word: bytes, seed: int) -> int:
    """The word's column, as a signed integer."""
    return (xxhash.xxh64_intdigest(word, seed) ^ (1 << 63)) - (1 << 63)


class _Columns(dict):
    """Word: its column."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        self[word] = found = column_of(word, self.seed)
        return found


class _Shard:
    """Rows of a block of documents."""

    def __init__(self, seed: int):
        self.of = _Columns(seed)
        self.rows, self.columns, self.counts, self.tokens = [], [], [], 0

    def add(self, row_id: int, part: str, text: str) -> None:
        raw, words = words_of(text)
        columns, counts = np.unique(np.fromiter(map(self.of.__getitem__, words), np.int64, len(words)), return_counts=True)
        capitals = len(raw) - len(raw.translate(None, _CAPITALS))
        flags = 4 * (100 * capitals > MOST_CAPITALS * len(text)) + 8 * bool(_SIGNS.search(raw))
        self.rows.append((row_id, part, hashlib.sha256(raw).digest(), flags))
        self.columns.append(columns)
        self.counts.append(counts)
        self.tokens += len(words)

    def frame(self, shard: int) -> pd.DataFrame:
        ids, parts, texts, flags = map(list, zip(*self.rows, strict=True))
        nonzeros, counts = np.array([len(x) for x in self.columns], np.int64), np.concatenate(self.counts)
        starts, total = np.concatenate([[0], np.cumsum(nonzeros)]), np.concatenate([[0], np.cumsum(counts)])
        sums = total[starts[1:]] - total[starts[:-1]]
        one = {"shard": shard, "ids": ids, "parts": parts, "texts": texts, "flags": flags, "starts": starts.astype(np.int32), "columns": np.concatenate(self.columns), "counts": counts.astype(np.int32), "sums": sums, "nonzeros": nonzeros}
        return pd.DataFrame({k: [v] for k, v in one.items()})


def dictionary(texts: DataFrame, seed: int) -> DataFrame:
    """(column, word, other) of all words of the column text; other is another word that has the column, if there is one."""

    def gathered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: set[bytes] = set()
        send = lambda: pd.DataFrame({"column": [column_of(w, seed) for w in found], "word": list(found)})
        for b in batches:
            for text in b["text"]:
                found.update(words_of(text)[1])
                if len(found) >= GATHERED:
                    yield send()
                    found.clear()
        if found:
            yield send()

    words = texts.select("text").mapInPandas(gathered, "column long, word binary")
    held = words.groupBy("column").agg(F.min("word").alias("word"), F.max("word").alias("last"))
    return held.select("column", "word", F.when(F.col("word") != F.col("last"), F.col("last")).alias("other"))


def document_term_matrix(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The matrix and its global dictionary (column, word). A row of the matrix is a block of documents in compressed rows: document
    i has counts[starts[i]:starts[i + 1]] in the columns of these places, in ascending order; sums and nonzeros are those of the rows."""
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    for seed in count():
        words = stored(dictionary(rows, seed), "dictionary")
        if words.filter("other IS NOT NULL").isEmpty():
            break

    def sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, shard = count(TaskContext.get().partitionId() << 32), _Shard(seed)
        for b in batches:
            for row in zip(b["_id"], b["part"], b["text"], strict=True):
                shard.add(*row)
                if shard.tokens >= TOKENS:
                    yield shard.frame(next(numbers))
                    shard = _Shard(seed)
        if shard.rows:
            yield shard.frame(next(numbers))

    return rows.mapInPandas(sharded, MATRIX), words.select("column", "word")


def own_failures(docs: DataFrame) -> DataFrame:
    """(_id, key, part, fails, times): the documents by the failures that their own text tells, and a digest of it; fails has bit i for
    the i-th of LETTERS. Rows that repeat are counted in times."""
    matrix, _ = document_term_matrix(docs)
    rows = matrix.select(F.explode(F.arrays_zip("ids", "parts", "texts", "flags", "sums", "nonzeros")).alias("x"))
    short, poor = F.col("x.sums") < LEAST_WORDS, 100 * F.col("x.nonzeros") < LEAST_DISTINCT * F.col("x.sums")
    own = F.col("x.flags") + short.cast("int") + 2 * poor.cast("int")
    flat = rows.select(F.col("x.ids").alias("_id"), F.col("x.parts").alias("part"), F.col("x.texts").alias("key"), own.alias("fails"))
    return flat.groupBy("_id", "key", "part", "fails").agg(F.count("*").alias("times"))


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, fails, n, good, toxic): documents by part and set of failed filters. Copies of a text are summed up before they meet, so a
    large group of them is a row for each part and label; all but those of the smallest id fail the last filter."""
    marked = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    label = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(marked("quality"), marked("toxic"))
    rows = own_failures(docs).join(label, "_id", "left")
    kinds = [F.col("part"), F.col("fails"), *[F.coalesce(c, F.lit(False)).alias(c) for c in ("quality", "toxic")]]
    groups = stored(rows.groupBy("key", *kinds).agg(F.sum("times").alias("n"), F.min(F.struct("_id", "times")).alias("lo")), "copies")
    met = groups.join(groups.groupBy("key").agg(F.min("lo._id").alias("first")), "key")
    first = F.when(F.col("lo._id") == F.col("first"), F.col("lo.times")).otherwise(0)
    two = F.array(F.struct(F.col("fails").alias("fails"), first.alias("n")), F.struct((F.col("fails") + 16).alias("fails"), (F.col("n") - first).alias("n")))
    both = met.select("part", "quality", "toxic", F.explode(two).alias("x")).select("part", "quality", "toxic", "x.*")
    of = lambda c: F.sum(F.when(F.col(c), F.col("n")).otherwise(0))
    return both.filter("n > 0").groupBy("part", "fails").agg(F.sum("n").alias("n"), of("quality").alias("good"), of("toxic").alias("bad")).withColumnRenamed("bad", "toxic")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the five filters and step."""
    parts = counted(docs, labels).groupBy("part").agg(F.collect_list(F.struct("fails", "n", "good", "toxic")).alias("sets"))  # 32 at most
    orders = ",".join("".join(p) for p in permutations(LETTERS))
    ordered = parts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ",")))
    steps = ordered.select("*", F.posexplode(F.split("filter_order", "")).alias("step", "letter"))
    earlier = F.substring("filter_order", F.lit(1), F.col("step"))
    before = sum((F.when(F.contains(earlier, F.lit(x)), 1 << i).otherwise(0) for i, x in enumerate(LETTERS)), F.lit(0))
    masked = steps.select("*", F.expr("shiftleft(1, ascii(letter) - ascii('A'))").alias("bit"), before.alias("before"))
    fails = lambda x, mask: x["fails"].bitwiseAND(F.col(mask)) != 0

    def total(where, what=lambda x: x["n"]) -> Column:
        return F.aggregate(F.filter("sets", where), F.lit(0).cast("long"), lambda s, x: s + what(x))

    here = lambda x: fails(x, "bit") & ~fails(x, "before")
    # in 120 orders, the filter is first among the k that a document fails in 120 / k
    share = lambda x: x["n"] * F.expr("CAST(120 AS LONG)") / F.bit_count(x["fails"])
    return masked.select(
        "part", "filter_order", (F.col("step") + 1).cast("int").alias("step"),
        total(lambda x: ~fails(x, "bit") & ~fails(x, "before")).alias("kept"), total(here).alias("removed"),
        total(lambda x: fails(x, "bit") & fails(x, "before")).alias("redundant"), total(lambda x: x["fails"] == F.col("bit")).alias("unique_fails"),
        total(here, lambda x: x["good"]).alias("good_lost"), total(here, lambda x: x["toxic"]).alias("toxic_lost"),
        total(lambda x: fails(x, "bit"), lambda x: share(x).cast("long")).alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
ORACLE = {
    "op12_filter_audit": rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, len({_WORDS}) AS n, len(list_distinct({_WORDS})) AS u FROM d),
f AS (SELECT w.doc_id, part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
        n < {LEAST_WORDS} AS A, 100 * u < {LEAST_DISTINCT} * n AS B, 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > {MOST_CAPITALS} * len(t) AS C,
        regexp_matches(t, '[#$%&*|]') AS D, w.doc_id > min(w.doc_id) OVER (PARTITION BY t) AS E
      FROM w LEFT JOIN labels USING (doc_id)),
p AS (SELECT part, (CASE WHEN A THEN 'A' ELSE '' END) || (CASE WHEN B THEN 'B' ELSE '' END) || (CASE WHEN C THEN 'C' ELSE '' END)
        || (CASE WHEN D THEN 'D' ELSE '' END) || (CASE WHEN E THEN 'E' ELSE '' END) AS fails,
        count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM f GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, substr(filter_order, step, 1) AS x, substr(filter_order, 1, step - 1) AS before FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, x, n, good, toxic, fails, contains(fails, x) AS fail,
        before <> '' AND len(regexp_replace(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']', '', 'g')) < len(fails) AS gone FROM p, s),
c AS (SELECT part, filter_order, step, any_value(x) AS x, sum(n) FILTER (WHERE NOT fail AND NOT gone) AS kept, sum(n) FILTER (WHERE fail AND NOT gone) AS removed,
        sum(n) FILTER (WHERE fail AND gone) AS redundant, sum(n) FILTER (WHERE fails = x) AS unique_fails,
        sum(good) FILTER (WHERE fail AND NOT gone) AS good_lost, sum(toxic) FILTER (WHERE fail AND NOT gone) AS toxic_lost FROM r GROUP BY 1, 2, 3)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, x), 0) AS BIGINT) AS shapley FROM c
""",
}
QUERIES = {"op12_filter_audit": op12_filter_audit}
