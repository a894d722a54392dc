"""Ranked lexical search by NRA: lists in order of impact are read in sequence, with no look-up of single documents.

The index has shards of bounded size. A shard lists, for each term of the queries, its documents with their impact, the greatest
first. All lists of a query are read to the same depth. A document's score is at least the sum of what has been read of it, and
at most that sum with, for each list in which it has not been seen yet, the impact at which this list stands. Reading goes on until
no document outside the best k can reach the kth score, not even with an equal one, and both bounds meet for all that can.

Shards are searched in a few rounds, each of many times as many shards as the one before. The kth score of the rounds before is
known to a round, so most of its shards end after their first reads. Rounds are written to the shared folder.

Queries are worked on in blocks whose terms are bounded, each against all documents; only a block's terms and thresholds are sent.

Defined cases: null and empty texts have no terms and count in no statistic; a null id is smaller than all others, and several
rows of an id are documents of their own; items that share an id are one; an item without terms, or whose terms no document
holds, has no rows; empty tables give an empty result. Columns other than doc_id, text and item_id are not read.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import NO_ID, stored, table, words

K = 50
#: Terms that the items of a block have, about; a block is one pass over the documents.
BLOCK_TERMS = 1_000_000
#: A shard is closed when it has so many documents with terms, or so many postings.
SHARD_DOCS, SHARD_POSTINGS = 1 << 14, 1 << 20
#: Postings of each list that are read first; each further step goes DEEPER times as deep.
DEPTH, DEEPER = 128, 4
#: Shards of the first round, and how many times more each further one has.
FIRST_SHARDS = 32
_TERMS = bytes(ord(c.lower()) if c.isalnum() else 32 for c in map(chr, range(128))) + bytes(range(128, 256))
_SHARD = "shard long, with_terms long, tokens long, ids array<long>, lengths array<long>, terms array<int>, starts array<int>, docs array<int>, tfs array<int>"
_INDEX = "shard long, ids array<long>, terms array<int>, starts array<int>, docs array<int>, impacts array<int>"


class _Shard:
    def __init__(self):
        self.with_terms = self.tokens = 0
        self.ids, self.lengths, self.docs, self.terms, self.tfs = [], [], array("i"), array("i"), array("i")

    def add(self, doc: int, raw: bytes, vocabulary: dict[bytes, int]) -> None:
        found = raw.translate(_TERMS).split()
        if not found:
            return
        self.with_terms += 1
        self.tokens += len(found)
        held = Counter(map(vocabulary.get, found))
        held.pop(None, None)
        if held:
            self.docs.extend([len(self.ids)] * len(held))
            self.terms.extend(held.keys())
            self.tfs.extend(held.values())
            self.ids.append(doc)
            self.lengths.append(len(found))

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or len(self.docs) >= SHARD_POSTINGS

    def frame(self, shard: int) -> pd.DataFrame:
        terms = np.array(self.terms, np.int32)
        order = np.argsort(terms, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(terms[order]) > 0])) if len(terms) else np.zeros(0, np.int64)
        one = {
            "shard": shard, "with_terms": self.with_terms, "tokens": self.tokens, "ids": self.ids, "lengths": self.lengths, "terms": terms[order][starts],
            "starts": np.append(starts, len(terms)).astype(np.int32), "docs": np.array(self.docs, np.int32)[order], "tfs": np.array(self.tfs, np.int32)[order],
        }
        return pd.DataFrame({k: [v] for k, v in one.items()})


class Index:
    """Shards of impact-sorted lists over all documents, for the terms of a block of queries, with the terms' weights."""

    def __init__(self, docs: DataFrame, terms: list[str]):
        self.number = {t: i for i, t in enumerate(terms)}
        spark = docs.sparkSession
        vocabulary = spark.sparkContext.broadcast({t.encode("utf-8", "surrogatepass"): i for t, i in self.number.items()})

        def sharded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            numbers, shard = count(TaskContext.get().partitionId() << 32), _Shard()
            for b in batches:
                for i, t in zip(b["_id"], b["text"], strict=True):
                    if t:
                        shard.add(i, t.encode("utf-8", "surrogatepass"), vocabulary.value)
                    if shard.full():
                        yield shard.frame(next(numbers))
                        shard = _Shard()
            if shard.with_terms:
                yield shard.frame(next(numbers))

        rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id"), F.col("text").cast("string").alias("text"))
        raw = stored(rows.mapInPandas(sharded, _SHARD), "postings")
        sums = raw.agg(F.sum("with_terms").alias("n"), F.sum("tokens").alias("l"), F.count("*").alias("shards")).first()
        self.documents, self.tokens, self.shards = sums["n"] or 0, sums["l"] or 0, sums["shards"]
        size = F.transform("terms", lambda t, i: F.struct(t.alias("term"), (F.get("starts", i + 1) - F.get("starts", i)).cast("long").alias("n")))
        held = raw.select(F.explode(size).alias("x")).groupBy("x.term").agg(F.sum("x.n").alias("df")).collect()  # a row for each term of the block
        self.weights = {r["term"]: math.floor(1000 * math.log((2 * self.documents + 2) / (2 * r["df"] + 1))) for r in held}
        n, total = self.documents, self.tokens

        def sorted_by_impact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                out = []
                for lengths, starts, at, tfs in zip(b["lengths"], b["starts"], b["docs"], b["tfs"], strict=True):
                    long = np.asarray(lengths, np.int64)
                    m = 100 - 50 + (50 * long * n) // max(1, total)
                    tf = np.asarray(tfs, np.int64)
                    impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[at])
                    order = np.lexsort((-impact, np.repeat(np.arange(len(starts) - 1), np.diff(starts))))
                    out.append((at[order], impact[order].astype(np.int32)))
                yield b[["shard", "ids", "terms", "starts"]].assign(docs=[x for x, _ in out], impacts=[x for _, x in out])

        self.lists = stored(raw.select("shard", "ids", "lengths", "terms", "starts", "docs", "tfs").mapInPandas(sorted_by_impact, _INDEX), "index")


def nra(lists: list[tuple[np.ndarray, np.ndarray, int]], ids: np.ndarray, k: int, floor: int = 1) -> tuple[np.ndarray, np.ndarray, int]:
    """The k best of a shard's documents by the lists (places of documents, impacts from the greatest on, weight), and their scores;
    those below floor are left out. The third value counts the postings that were read."""
    lower, read, depth = np.zeros(len(ids), np.int64), 0, DEPTH
    done = [0] * len(lists)
    while True:
        bounds = []
        for i, (docs, impacts, weight) in enumerate(lists):
            end = min(depth, len(docs))
            lower[docs[done[i] : end]] += weight * impacts[done[i] : end].astype(np.int64)
            read += end - done[i]
            done[i] = end
            bounds.append(weight * int(impacts[end - 1]) if end < len(docs) else 0)
        open_to = np.full(len(ids), sum(bounds), np.int64)
        for (docs, _, _), end, bound in zip(lists, done, bounds, strict=True):
            if bound:
                open_to[docs[:end]] -= bound
        kth = int(np.partition(lower, len(ids) - k)[len(ids) - k]) if len(ids) >= k else 0
        left = np.flatnonzero(lower + open_to >= max(kth, floor, 1))
        if not open_to[left].any():
            best = left[np.lexsort((ids[left], -lower[left]))[:k]]
            return ids[best], lower[best], read
        depth *= DEEPER


def _best(found: DataFrame, k: int) -> DataFrame:
    order = W.partitionBy("item").orderBy(F.desc("score"), "doc")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _search_block(docs: DataFrame, queries: list[list[str]], k: int) -> DataFrame:
    """(item, doc, score, rank) for a block of queries; item is the query's place in it."""
    spark = docs.sparkSession
    index = Index(docs, sorted({t for q in queries for t in q}))
    weighed = [[(n, w) for n, w in ((index.number[t], index.weights.get(index.number[t], 0)) for t in q) if w] for q in queries]
    sent = spark.sparkContext.broadcast(weighed)
    found = stored(spark.createDataFrame([], "item int, doc long, score long, rank int"), "best")
    share = F.pmod(F.xxhash64("shard"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    before, now = 0.0, min(1.0, FIRST_SHARDS / max(1, index.shards))
    while before < 1.0:
        kth = {r["item"]: r["score"] for r in found.filter(F.col("rank") == k).collect()}  # one row for each query of the block
        floors = spark.sparkContext.broadcast(kth)

        def searched(batches: Iterator[pd.DataFrame], floors=floors) -> Iterator[pd.DataFrame]:
            for b in batches:
                for ids, terms, starts, at, impacts in zip(b["ids"], b["terms"], b["starts"], b["docs"], b["impacts"], strict=True):
                    ids, place, out = np.asarray(ids, np.int64), {t: i for i, t in enumerate(terms.tolist())}, []
                    for item, query in enumerate(sent.value):
                        lists = [(at[starts[i] : starts[i + 1]], impacts[starts[i] : starts[i + 1]], w) for t, w in query if (i := place.get(t)) is not None]
                        floor = floors.value.get(item, 1)
                        if lists and sum(w * int(x[0]) for _, x, w in lists) >= floor:
                            best, scores, _ = nra(lists, ids, k, floor)
                            out.append(pd.DataFrame({"item": item, "doc": best, "score": scores}))
                    if out:
                        yield pd.concat(out)

        some = index.lists.filter((share >= before) & (share < now))
        new = some.select("ids", "terms", "starts", "docs", "impacts").mapInPandas(searched, "item int, doc long, score long")
        found = stored(_best(found.drop("rank").unionByName(new), k), "best")
        before, now = now, min(1.0, now * FIRST_SHARDS)
    return found


def search(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents, those of equal score by ascending id."""
    spark = docs.sparkSession
    terms = items.select("item_id", F.explode(F.array_distinct(words(F.col("text")))).alias("term")).distinct()
    queries = stored(terms.groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms")), "queries")
    blocks = max(1, math.ceil((queries.agg(F.sum(F.size("terms"))).first()[0] or 0) / BLOCK_TERMS))
    kind = items.schema["item_id"].dataType.simpleString()
    out = []
    for block in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()  # bounded by BLOCK_TERMS
        best = _search_block(docs, [r["terms"] for r in rows], k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item int, item_id {kind}")
        out.append(best.join(F.broadcast(names), "item"))
    found = out[0]
    for more in out[1:]:
        found = found.unionByName(more)
    return found.select("item_id", F.col("rank").cast("int").alias("rank"), F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "score")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TOKENS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
ORACLE = {
    "op11_ranked_search": rf"""
WITH q AS (SELECT DISTINCT item_id, unnest({_TOKENS}) AS term FROM benchmark),
d AS (SELECT doc_id, {_TOKENS} AS w FROM documents),
l AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM l),
p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(w) AS term FROM l) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2, 3),
t AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM p, s GROUP BY 1),
i AS (SELECT doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + ((50 * n * docs) // total)))) AS impact FROM p JOIN t USING (term), s),
r AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM q JOIN i USING (term) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score FROM r WHERE score > 0
QUALIFY rank <= {K}
""",
}
QUERIES = {"op11_ranked_search": op11_ranked_search}
