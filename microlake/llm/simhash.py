"""SimHash near-dedup by multi-index hashing.

A 64-bit fingerprint has two segments of 32 bits. If two fingerprints differ in at most four bits, they differ in at most
two bits of the first segment or in at most one bit of the second. So each fingerprint is entered in a table under every
key of the Hamming ball of radius one around each segment: two first segments at distance two meet under a key between
them, and two second segments at distance one under either of them. What meets is compared by its complete distance.

Equal fingerprints are one class before that, so a group of copies is one entry. Under a key, members are compared in
blocks and leave a spanning forest of what is linked, never their pairs. Keys with very many members are split: each pair
of blocks is a group of its own. Components come from the forests' edges by alternating large-star and small-star steps, each
written to the shared folder.

Defined cases: null and empty texts have fingerprint zero, which links like any other; a null id is smaller than all others, and
a component that holds one has a null component_id; rows that repeat are alike and get the same answer each; an empty
table gives an empty result. Columns other than doc_id and text pass through deduplicate() untouched. Texts are read whole.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, doc_id, small, stored, table, with_key

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: Members from which a key's group is split, and those of a block then.
LARGE_GROUP = 4096
BLOCK = 2048
BROADCAST_ROWS = 200_000
#: Rows of the sorted table that are worked on together.
ROWS_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set if it is set in over half the hashes of the shingles, repeats included."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # on bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
    hashes = np.array([xxhash.xxh64_intdigest(b" ".join(r), SEED) for r in runs], np.uint64)
    set_in = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_in += bits.sum(0, dtype=np.uint32)
    return int(np.packbits(set_in * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(_id, _dk, fp) for each document row; fp is the fingerprint as a signed integer."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return with_key(docs).select("_id", "_dk", hashed("text").alias("fp"))


def _ball(segment: Column) -> Column:
    """Keys at distance 0 and 1 from a 32-bit value."""
    return F.array(segment, *[segment.bitwiseXOR(1 << b) for b in range(32)])


def _segments() -> list[Column]:
    """The two segments as keys of one table; the second's have bit 32 set."""
    fp = F.col("fp")
    return [F.shiftrightunsigned(fp, 32), fp.bitwiseAND(0xFFFFFFFF).bitwiseOR(1 << 32)]


def crowded(fps: DataFrame, centres: list[Column], ball: Callable[[Column], Column], least: int, least_centre: int) -> DataFrame:
    """(key, n): keys with about least members or more, counting centres that have least_centre at least."""
    often = fps.select(F.explode(F.array(*centres)).alias("centre")).groupBy("centre").count().filter(F.col("count") >= least_centre)
    keys = often.select(F.explode(ball(F.col("centre"))).alias("key"), "count").groupBy("key").agg(F.sum("count").alias("n"))
    return stored(keys.filter(F.col("n") >= least), "large-keys")


def entries(fps: DataFrame, centres: list[Column], ball: Callable[[Column], Column], *carried: str, only: DataFrame | None = None, but: DataFrame | None = None) -> DataFrame:
    """(key, slot, *carried): where each fingerprint stands in the table, under all keys of the balls around its centres, the
    segments. slot is 0 but for keys with large groups, of which each pair of blocks has a slot. only, but: keys (key) that alone
    are wanted, or that are not."""
    # centres with a few members already lead to all keys with large groups
    large = crowded(fps, centres, ball, LARGE_GROUP // 2, LARGE_GROUP // 64)
    table = fps.select(F.explode(F.concat(*[ball(c) for c in centres])).alias("key"), *carried)
    for keys, how in ((only, "left_semi"), (but, "left_anti")):
        if keys is not None:
            table = table.join(small(keys.select("key"), BROADCAST_ROWS), "key", how)
    table = table.join(small(large, BROADCAST_ROWS), "key", "left")
    blocks = F.ceil(F.col("n") / BLOCK).cast("long")
    mine = F.pmod(F.xxhash64("fp", "key"), blocks)
    pairs = F.transform(F.sequence(F.lit(0).cast("long"), blocks - 1), lambda b: F.least(mine, b) * blocks + F.greatest(mine, b) + 1)
    return table.select("key", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pairs)).alias("slot"), *carried)


def by_group(table: DataFrame, work: Callable[..., pd.DataFrame], schema: str) -> DataFrame:
    """Calls work with arrays of the columns of entries: rows sorted by key and slot, and then by the other columns, of whole
    groups, of many at once. Groups of one row are left out."""
    names = table.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def several(rows: list[np.ndarray]) -> Iterator[pd.DataFrame]:
            if len(rows[0]):
                _, sizes = group_starts(rows[0], rows[1])
                stay = np.repeat(sizes > 1, sizes)
                if stay.any():
                    yield work(*[x[stay] for x in rows])

        for b in batches:
            held.append([b[c].to_numpy() for c in names])
            n += len(b)
            if n >= ROWS_AT_ONCE:
                now = [np.concatenate(x) for x in zip(*held, strict=True)]
                last = np.flatnonzero((now[0] != now[0][-1]) | (now[1] != now[1][-1]))
                cut = last[-1] + 1 if len(last) else 0
                held, n = [[x[cut:] for x in now]], len(now[0]) - cut  # the last group may go on in the next batch
                yield from several([x[:cut] for x in now])
        if n:
            yield from several([np.concatenate(x) for x in zip(*held, strict=True)])

    return table.repartition("key", "slot").sortWithinPartitions(*names).mapInPandas(run, schema)


def group_starts(key: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the groups of sorted rows start, and their sizes."""
    starts = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (slot[1:] != slot[:-1])]))
    return starts, np.diff(np.append(starts, len(key)))


def _forest(fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for the members of one group that are linked to others."""
    near = np.zeros((len(fp), len(fp)), bool)
    for at in range(0, len(fp), 512):
        near[at : at + 512] = np.bitwise_count(fp[at : at + 512, None] ^ fp[None, :]) <= distance
    root = np.arange(len(fp))
    while True:
        lowest = np.array([root[row].min() for row in near])
        lowest = np.minimum(lowest, root[lowest])
        if (lowest == root).all():
            break
        root = lowest
    linked = root != np.arange(len(fp))
    return fp[linked], fp[root[linked]]


def _links(key: np.ndarray, slot: np.ndarray, fp: np.ndarray, distance: int) -> pd.DataFrame:
    """Edges of rows sorted by key and slot, whose groups are whole."""
    u = fp.view(np.uint64)
    starts, sizes = group_starts(key, slot)
    second = key >> 32 == 1
    centre = np.where(second, (fp & 0xFFFFFFFF) | (1 << 32), (u >> np.uint64(32)).astype(np.int64))
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    # small groups: all of them at once, pair by pair of places
    left = np.repeat(sizes, sizes) - (np.arange(len(key)) - np.repeat(starts, sizes)) - 1  # members behind each
    at = np.flatnonzero((left > 0) & (np.repeat(sizes, sizes) <= 32))
    step = 1
    while len(at):
        other = at + step
        # members with one segment meet under that segment; it is enough to compare them there
        apart = (centre[at] != centre[other]) | (centre[at] == key[at])
        hit = apart & (np.bitwise_count(u[at] ^ u[other]) <= distance)
        a.append(fp[at[hit]])
        b.append(fp[other[hit]])
        step += 1
        at = at[left[at] >= step]
    for g in np.flatnonzero(sizes > 32):
        rows = slice(starts[g], starts[g] + sizes[g])
        if (centre[rows] == centre[rows.start]).all() and centre[rows.start] != key[rows.start]:
            continue
        x, y = _forest(np.unique(u[rows]), distance)
        a.append(x.view(np.int64))
        b.append(y.view(np.int64))
    a, b = np.concatenate(a), np.concatenate(b)
    return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)}).drop_duplicates()


def links(fps: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): edges between distinct fingerprints whose components are those of all pairs within the distance."""
    if distance > 4:
        raise ValueError("two segments with balls of radius one find distances up to 4")

    def run(key: np.ndarray, slot: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
        return _links(key, slot, fp, distance)

    return by_group(entries(fps, _segments(), _ball, "fp"), run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of the edges (a, b)."""
    edges = stored(edges.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("r")).filter("v <> r").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("r").alias("v"), F.col("v").alias("r")))
        least = both.groupBy("v").agg(F.least(F.min("r"), F.first("v")).alias("m"))
        large = both.join(least, "v").filter("r > v").select(F.col("r").alias("v"), F.col("m").alias("r")).filter("v <> r").distinct()
        large = stored(large, "large-star")
        down = large.groupBy("v").agg(F.min("r").alias("m"))
        edges = large.join(down, "v").select(F.explode(F.array(F.struct("v", F.col("m").alias("r")), F.struct(F.col("r").alias("v"), F.col("m").alias("r")))).alias("e")).select("e.*").filter("v <> r").distinct()
        edges = stored(edges, "small-star")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "r").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("v").alias("node"), F.col("r").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """One row for each document row: _id, _dk, fp, and component, the smallest _id reachable."""
    fps = stored(fingerprints(docs, shingle), "fingerprints")
    classes = stored(fps.groupBy("fp").agg(F.min("_id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), distance)).withColumnRenamed("node", "fp")
    grouped = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    lowest = grouped.groupBy("root").agg(F.min("first").alias("component"))
    return fps.join(stored(grouped.join(lowest, "root").select("fp", "component"), "components"), "fp")


def one_of_each(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The document with the smallest id of each component in found (_id, _dk, component), with all columns."""
    stays = found.groupBy("component").agg(F.min(F.struct("_id", "_dk")).alias("k")).select("k.*")
    keyed = with_key(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).drop("text")
    return keyed.join(stays.hint("shuffle_hash"), ["_id", "_dk"]).dropDuplicates(["_id", "_dk"]).select("row.*")


def deduplicate(docs: DataFrame, distance: int = DISTANCE, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with all columns: the one with the smallest id (of rows that share it, one)."""
    return one_of_each(docs, near_duplicates(docs, distance, shingle))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    component = F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id")
    return found.select(doc_id(), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), component)


QUERIES = {"op5_simhash_near_dedup": op5_simhash_near_dedup}
