"""Exact top-k inner products: a ball tree for each shard of the vectors, searched by branch and bound.

Vectors go to the cell of the most alike of at most PIVOTS pivots (a sample, in hash order of the ids; it only decides how
much can be left out), and large cells are split into shards, so that a shard is a ball of its own with a centre and a
radius. Queries go in blocks of a cell. A search takes a tree's nodes in order of the upper bound of the inner product in
their ball, q.c + |q| r, over the block's queries, and leaves out a node for each query whose current kth score the bound
doesn't reach.

The kth scores are shared in rounds: each block first searches the shard with the highest bound, then a few more, then the
rest, and in each round begins from the scores found before. A block and a shard whose bound doesn't reach any of the
block's kth scores never meet, and the shard isn't sent there; a shard's tree is built once for all blocks that do.

Defined cases: components become floor(256 x), x as double; vectors that are null, empty, or hold null or non-finite
components, take no part, nor do rows without an id; rows that repeat id and vector count once; all rows with the
query's id are its own; vectors of different lengths are not compared; ties go to the smaller id; a query with fewer
candidates gets them all, and an empty table gives an empty result. Scores are exact at any size of the components: vectors of a length
of 2**31 or more (LARGE) are left out of the trees and multiplied in whole numbers of any width. A score beyond 64 bits is given as the
greatest or least that these can hold, and such ones are ranked by what they are. A component of which 256 x is beyond the doubles
is not finite. Columns other than vec_id and embedding are not read.
"""

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

K = 5
QUERY_EVERY = 50
SCALE = 256
ROWS_A_SHARD = 8192
QUERIES_A_BLOCK = 512
LEAF = 128
#: Length from which a vector is multiplied by itself; two shorter ones have a product within 64 bits.
LARGE = 2.0**31
#: Pivots at most; fewer vectors have one for each shard.
PIVOTS = 512
#: Shards, in order of their bound, that a block searches in each round; all that are left in the last.
ROUNDS = (1, 4, None)
#: Parts that the blocks of a shard are dealt out to.
SALTS = 4

_FOUND = "query_id long, vec_id long, score long, wide string"
_MOST, _LEAST = 2**63 - 1, -(2**63)
#: Digits that the product of any two vectors of doubles has at most, and some more.
_DIGITS = 700


def quantized(vectors: DataFrame) -> DataFrame:
    """(vec_id, dim, v): distinct usable vectors in whole numbers, as doubles."""
    e = F.transform("embedding", lambda x: x.cast("double") * SCALE)
    usable = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(e, lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    rows = vectors.filter(F.col("vec_id").isNotNull() & (F.size(e) > 0)).filter(usable)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.size(e).alias("dim"), ints.alias("v")).distinct()


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of integers that are shorter than LARGE."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return np.rint(a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    longest = lambda x: np.linalg.norm(x.astype(np.float64), axis=1).max(initial=0)
    if longest(a) * longest(b) >= 2**63:
        raise OverflowError("inner products beyond 64 bits")
    return a @ b.T


def _whole(rows: np.ndarray) -> np.ndarray:
    """The rows as whole numbers of any width."""
    return np.array([[int(x) for x in r] for r in rows.tolist()], object).reshape(rows.shape)


def wide(score: int) -> tuple[int, str]:
    """The score within 64 bits, and, at their ends, a text by which such scores are in order."""
    if score >= _MOST:
        return _MOST, f"{score:0{_DIGITS}}"
    return (_LEAST, f"{10**_DIGITS + score:0{_DIGITS}}") if score <= _LEAST else (score, "")


class Shard:
    """A tree of the vectors that are shorter than LARGE, and the others."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        small = np.linalg.norm(rows, axis=1) < LARGE
        self.tree = BallTree(ids[small], rows[small].astype(np.int64))
        self.ids, self.rows = ids[~small], _whole(rows[~small])

    def search(self, ids: np.ndarray, rows: np.ndarray, k: int, floor: np.ndarray) -> pd.DataFrame:
        """(query_id, vec_id, score, wide) of the k best for each query, at least."""
        small = np.linalg.norm(rows, axis=1) < LARGE
        found, scores = self.tree.search(ids[small], rows[small].astype(np.int64), k, floor[small])
        at, col = np.nonzero(found != -1)
        out = [pd.DataFrame({"query_id": ids[small][at], "vec_id": found[at, col], "score": scores[at, col], "wide": ""})]
        more = []
        for chosen, other_ids, other in ((np.arange(len(ids)), self.ids, self.rows), (np.flatnonzero(~small), self.tree.ids, self.tree.rows.astype(object))):
            if not len(other_ids):
                continue
            for q in chosen.tolist():
                products = other @ _whole(rows[q : q + 1])[0]
                best = heapq.nsmallest(k, ((-p, i) for p, i in zip(products.tolist(), other_ids.tolist(), strict=True) if i != ids[q]))
                more += [(int(ids[q]), i, *wide(-p)) for p, i in best]
        return pd.concat([*out, pd.DataFrame(more, columns=["query_id", "vec_id", "score", "wide"])]) if more else out[0]


class BallTree:
    """Rows in tree order; nodes as (start, end, left, right) with centres and radii; leaves have left = -1."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order, self.nodes, centres, radii = np.arange(len(ids)), [], [], []
        x = rows.astype(np.float64)

        def grow(start: int, end: int) -> int:
            part = x[order[start:end]]
            c = part.mean(0)
            far = np.linalg.norm(part - c, axis=1)
            at = len(self.nodes)
            self.nodes.append([start, end, -1, -1])
            centres.append(c)
            radii.append(far.max())
            if end - start > LEAF and radii[at] > 0:
                a = part[far.argmax()]
                b = part[np.linalg.norm(part - a, axis=1).argmax()]
                mid = (end - start) // 2
                order[start:end] = order[start:end][np.argpartition(part @ (b - a), mid)]
                self.nodes[at][2:] = grow(start, start + mid), grow(start + mid, end)
            return at

        if len(ids):
            grow(0, len(ids))
        self.ids, self.rows = ids[order], rows[order]
        self.nodes = np.array(self.nodes, np.int64).reshape(-1, 4)
        self.centres, self.radii = np.array(centres).reshape(-1, rows.shape[1]), np.array(radii)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best for each query that reach the query's floor; id -1 where there are fewer."""
        none = np.iinfo(np.int64).min
        best_id, best = np.full((len(queries), k), -1, np.int64), np.full((len(queries), k), none, np.int64)
        size = np.linalg.norm(queries.astype(np.float64), axis=1)

        def bounds(node: int, active: np.ndarray) -> np.ndarray:
            up = queries[active] @ self.centres[node] + size[active] * self.radii[node]
            up += np.abs(up) * 1e-9 + 0.5
            return up

        heap, tick = [], 0
        if len(self.nodes):
            everyone = np.arange(len(queries))
            heap = [(0.0, 0, 0, everyone, bounds(0, everyone))]
        while heap:
            _, _, node, active, up = heapq.heappop(heap)
            kth = np.maximum(best[active, -1], floor[active])
            near = up >= kth
            active, up = active[near], up[near]
            if not len(active):
                continue
            start, end, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    child_up = bounds(child, active)
                    tick += 1
                    heapq.heappush(heap, (-float(child_up.max()), tick, child, active, child_up))
                continue
            got = _dot(queries[active], self.rows[start:end])
            ids = np.broadcast_to(self.ids[start:end], got.shape)
            got = np.where(ids == query_ids[active, None], none, got)
            some = (got >= np.maximum(best[active, -1], floor[active])[:, None]).any(1)
            at = active[some]
            both = np.concatenate([best[at], got[some]], 1)
            both_id = np.concatenate([best_id[at], ids[some]], 1)
            order = np.lexsort((both_id, ~both), axis=1)[:, :k]  # ~ turns the order of integers round
            best[at] = np.take_along_axis(both, order, 1)
            best_id[at] = np.where(best[at] == none, -1, np.take_along_axis(both_id, order, 1))
        return best_id, best


def _pack(a: np.ndarray, kind: type) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def in_cells(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """rows with the number of the pivot (dim, v) of their length that they are most alike."""
    by_dim: dict[int, list] = {}
    for r in pivots.collect():  # at most PIVOTS
        by_dim.setdefault(r["dim"], []).append(r["v"])
    unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)
    shared = rows.sparkSession.sparkContext.broadcast({d: unit(np.array(v, np.float64)) for d, v in by_dim.items()})

    @F.pandas_udf("int")
    def cell(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for vectors in parts:
            out = np.zeros(len(vectors), np.int32)
            dims = vectors.map(len).to_numpy()
            for d in np.unique(dims):
                if d in shared.value:
                    at = np.flatnonzero(dims == d)
                    out[at] = (np.array(vectors.iloc[at].tolist(), np.float64) @ shared.value[d].T).argmax(1)
            yield pd.Series(out)

    return rows.withColumn("cell", cell("v"))


def packs(rows: DataFrame, rows_a_pack: int) -> DataFrame:
    """(dim, cell, part, ids, rows, centre, radius): the vectors of a cell in parts of about rows_a_pack."""
    parts = rows.groupBy("dim", "cell").agg(F.ceil(F.count("*") / rows_a_pack).cast("int").alias("parts"))

    def one(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        matrix = np.array(pdf["v"].tolist(), np.float64).reshape(len(pdf), k[0])
        with np.errstate(all="ignore"):  # what is beyond the doubles makes a bound that leaves nothing out
            centre = matrix.mean(0)
            radius = np.linalg.norm(matrix - centre, axis=1).max()
        return pd.DataFrame({"dim": [k[0]], "cell": [k[1]], "part": [k[2]], "ids": [_pack(pdf["vec_id"].to_numpy(), np.int64)], "rows": [_pack(matrix, np.float64)], "centre": [centre.tolist()], "radius": [float(radius)]})

    dealt = rows.join(F.broadcast(parts), ["dim", "cell"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), "parts").cast("int"))
    return dealt.groupBy("dim", "cell", "part").applyInPandas(one, "dim int, cell int, part int, ids binary, rows binary, centre array<double>, radius double")


def cells_of(blocks: DataFrame, shards: DataFrame) -> DataFrame:
    """(dim, block, shard, bound, place): each block with each shard of its length, and the place of the shard for it by its
    bound: no inner product of a query of the block and a vector of the shard is higher."""
    dot = F.aggregate(F.zip_with("qc", "c", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    size = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    q = blocks.select("dim", "block", F.col("centre").alias("qc"), F.col("radius").alias("qr"), size("centre").alias("qs"))
    s = shards.select("dim", "shard", F.col("centre").alias("c"), F.col("radius").alias("r"), size("centre").alias("cs"))
    bound = dot + F.col("qs") * F.col("r") + F.col("qr") * (F.col("cs") + F.col("r"))
    safe = F.when(F.isnan(bound), float("inf")).otherwise(bound + F.abs(bound) * 1e-9 + 0.5)
    both = q.join(s, "dim").select("dim", "block", "shard", safe.alias("bound"))
    return both.withColumn("place", F.row_number().over(W.partitionBy("dim", "block").orderBy(F.desc("bound"), "shard")))


def _search(cells: DataFrame, blocks: DataFrame, shards: DataFrame, floors: DataFrame | None, k: int) -> DataFrame:
    """Results for cells (dim, block, shard), from floors (query_id, kth) on. A shard comes before the blocks it meets, in
    each of the parts that these are dealt out to."""
    sent = cells.join(blocks.select("dim", "block", "ids", "rows"), ["dim", "block"])
    if floors is None:
        sent = sent.withColumn("floors", F.lit(None).cast("array<struct<query_id:long,kth:long>>"))
    else:
        sent = sent.join(floors, ["dim", "block"], "left")
    sent = sent.withColumns({"salt": F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int"), "is_block": F.lit(1)})
    used = sent.select("dim", "shard", "salt").distinct()
    trees = used.join(shards.select("dim", "shard", "ids", "rows"), ["dim", "shard"]).withColumns({"floors": F.lit(None).cast("array<struct<query_id:long,kth:long>>"), "is_block": F.lit(0)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard = None
        for b in batches:
            for r in b.itertuples(index=False):
                ids = np.frombuffer(r.ids, np.int64)
                rows = np.frombuffer(r.rows, np.float64).reshape(len(ids), r.dim)
                if not r.is_block:
                    shard = Shard(ids, rows)
                    continue
                known = {x["query_id"]: x["kth"] for x in r.floors} if r.floors is not None else {}
                yield shard.search(ids, rows, k, np.array([known.get(x, _LEAST) for x in ids.tolist()], np.int64))

    names = ["dim", "shard", "salt", "is_block", "ids", "rows", "floors"]
    both = trees.select(*names).unionByName(sent.select(*names)).repartition("dim", "shard", "salt")
    return both.sortWithinPartitions("dim", "shard", "salt", "is_block").mapInPandas(run, _FOUND)


def _best(found: DataFrame, k: int) -> DataFrame:
    best = W.partitionBy("query_id").orderBy(F.desc("score"), F.desc("wide"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = K, rows_a_shard: int = ROWS_A_SHARD, counts: dict | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector for which queries holds, its k highest inner products. counts: gets
    the number of pairs of block and shard, and of those searched."""
    usable = stored(quantized(vectors), "vectors")
    cells_wanted = max(1, min(PIVOTS, usable.count() // rows_a_shard))
    pivots = usable.select("dim", "v", F.xxhash64("vec_id", F.lit(2)).alias("at")).orderBy("at", "v").limit(cells_wanted)
    rows = stored(in_cells(usable, pivots), "cells")
    numbered = lambda df, name: stored(df.withColumn(name, F.monotonically_increasing_id()), name)
    shards = numbered(packs(rows, rows_a_shard), "shard")
    blocks = numbered(packs(rows.filter(queries), QUERIES_A_BLOCK), "block")
    of_block = stored(blocks.select("dim", "block", F.explode(_ids("ids")).alias("query_id")), "queries")
    cells = stored(cells_of(blocks, shards), "bounds")
    most = shards.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    found, done, searched = None, 0, 0
    for n in ROUNDS:
        if found is not None and done >= most:
            break  # all shards have been searched
        now, floors = cells.filter(F.col("place") > done), None
        if found is not None:
            kth = found.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth"))
            held = of_block.join(kth, "query_id", "left").groupBy("dim", "block").agg(
                F.min(F.when(F.col("n") >= k, F.col("kth")).otherwise(F.lit(-(2**63)))).alias("least"),
                F.collect_list(F.when(F.col("n") >= k, F.struct("query_id", "kth"))).alias("floors"),
            )
            held = stored(held, "floors")
            now = now.join(held.select("dim", "block", "least"), ["dim", "block"]).filter(F.col("bound") >= F.col("least"))
            floors = held.select("dim", "block", "floors")
        if n is not None:
            now = now.filter(F.col("place") <= done + n)
            done += n
        now = stored(now.select("dim", "block", "shard"), "round")
        if counts is not None:
            searched += now.count()
            counts.update(pairs=cells.count(), searched=searched)
        more = _search(now, blocks, shards, floors, k)
        found = stored(_best(more if found is None else found.drop("rank").unionByName(more), k), "found")
    return found.select("query_id", "rank", "vec_id", "score")


@F.pandas_udf(T.ArrayType(T.LongType()))
def _ids(packed: pd.Series) -> pd.Series:
    return packed.map(lambda raw: np.frombuffer(raw, np.int64))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


ORACLE = {
    "op9_exact_topk": """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
}
QUERIES = {"op9_exact_topk": op9_exact_topk}
