"""Near-duplicates of five-word shingles and similarity 0.8, by SimHash and multi-index hashing with wide fingerprints.

Sets of similarity 0.8 differ in 15 of 100 bits of a fingerprint, so 64 bits and a few differing ones, as in simhash, cannot
tell them from others. Here a fingerprint has 512 bits, of which 384 make 16 segments of 24. Each is entered in a table under every key of
the upward ball around each segment (the segment itself, and with any one zero bit set), which takes half of a Hamming
ball of radius one. Two segments that are equal or differ in one bit meet, and so do half of those that differ in two. A
pair of similarity exactly 0.8 meets in some segment with probability 0.97, one of 0.85 with 0.99. What meets is compared by its first
64 bits, then by its complete distance, and what is near enough by the shingle sets themselves, whole: only pairs whose
Jaccard similarity is at least LEAST are linked. With all that, a pair of similarity exactly 0.8 is found with probability
0.94, and of 0.85 with 0.99.

Texts with one shingle set are one class before that. Under each segment, all classes are first compared with the smallest.
What these links join needs no further comparison, so a large group of near copies costs its size and not its square. What
stood near the smallest but is not joined to it makes a region with it; in a region, blocks of classes are compared with
each other, but for those that are joined already, and leave a spanning forest of their links. Last, classes of different regions
that meet under some key are compared; under crowded keys by the complete distance at once. Keys and regions with very many
members are split into pairs of blocks.

Defined cases: null and empty texts have no shingles and are one class; texts of fewer words than a shingle have one, of
all their words; a null id is smaller than all others; rows that repeat are alike; an empty table gives an empty result.
Columns other than doc_id and text pass through deduplicate() untouched. Texts are read whole.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import NOT_SPACE, ODD, WordHashes, mixed, stored, with_key
from .simhash import by_group, components, crowded, entries, group_starts, one_of_each

SHINGLE = 5
#: The least similarity, as a fraction of whole numbers.
LEAST = (4, 5)
WORDS, SEGMENTS, SEGMENT_BITS = 8, 16, 24
#: Most differing bits of the first 64, and of all 512. At similarity 0.8 they have means of 9.7 and 77.5 and standard
#: deviations of 2.9 and 8.1; at 0.6, means of 14.7 and 118; between unlike sets, 32 and 256.
NEAR_FIRST, NEAR_ALL = 16, 94
#: Comparisons with one text that a task may get.
SHARE = 256
#: Classes of a region's block.
BLOCK = 512
#: Members of a key from which their whole fingerprints are sent there.
CROWD = 24
SEED = 42
_STEPS = np.array([ODD * (i + 1) % 2**64 for i in range(WORDS)], np.uint64)
_PLACES = np.array([pow(ODD, i + 1, 2**64) for i in range(SHINGLE)], np.uint64)


class Shingles:
    """Sorted hashes of the distinct shingles of a text, with A-Z in lower case."""

    def __init__(self):
        self.words = WordHashes(NOT_SPACE)

    def of(self, text: str | None) -> np.ndarray:
        w = self.words.of(text.encode("utf-8", "surrogatepass").lower()) if text else np.zeros(0, np.uint64)
        if not len(w):
            return w
        n = max(1, len(w) - SHINGLE + 1)
        sums = np.zeros(n, np.uint64)
        for i in range(min(SHINGLE, len(w))):
            sums += w[i : i + n] * _PLACES[i]
        return np.unique(mixed(sums))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """A bit is set if it is set in over half of the shingles' hashes, of which each gives WORDS words."""
    set_in = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 255):  # so many fit in a byte
        wide = mixed(hashes[at : at + 255, None] + _STEPS[None, :])
        set_in += np.add.reduce(np.unpackbits(wide.view(np.uint8), axis=1, bitorder="little"), axis=0, dtype=np.uint8)
    return np.packbits(set_in * 2 > len(hashes), bitorder="little").view(np.int64)


def prints(docs: DataFrame) -> DataFrame:
    """(_id, _dk, fp, size, bits) for each document row; fp is a hash of the shingle set, size its size."""

    @F.pandas_udf("struct<fp:long,size:long,bits:array<long>>")
    def made(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        shingles = Shingles()
        for texts in batches:
            rows = []
            for t in texts:
                s = shingles.of(t)
                rows.append((int(np.uint64(xxhash.xxh64_intdigest(s.tobytes(), SEED)).view(np.int64)), len(s), fingerprint(s)))
            yield pd.DataFrame(rows, columns=["fp", "size", "bits"])

    return with_key(docs).select("_id", "_dk", made("text").alias("p")).select("_id", "_dk", "p.*")


def _segments() -> list[Column]:
    """The segments as keys of one table, by the number of the segment and its bits."""
    out = []
    for i in range(SEGMENTS):
        word, shift = divmod(i * SEGMENT_BITS, 64)
        bits = F.shiftrightunsigned(F.col("bits")[word], shift)
        if shift + SEGMENT_BITS > 64:
            bits = bits.bitwiseOR(F.shiftleft(F.col("bits")[word + 1], 64 - shift))
        out.append(bits.bitwiseAND((1 << SEGMENT_BITS) - 1).bitwiseOR(i << SEGMENT_BITS))
    return out


def _ball(key: Column) -> Column:
    """A key, and those with one more bit of the segment set."""
    ups = F.filter(F.array(*[F.lit(1 << b).cast("long") for b in range(SEGMENT_BITS)]), lambda b: key.bitwiseAND(b) == 0)
    return F.concat(F.array(key), F.transform(ups, lambda b: key.bitwiseOR(b)))


def _first_near(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b)) <= NEAR_FIRST


def near_enough(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) of classes whose complete distance and sizes allow the similarity."""
    side = lambda x, y: classes.select(F.col("fp").alias(x), F.struct("size", "bits").alias(y))
    both = pairs.join(side("a", "x"), "a").join(side("b", "y"), "b")
    apart = sum((F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(WORDS)), F.lit(0))
    over, under = LEAST
    sizes = F.least("x.size", "y.size") * under >= F.greatest("x.size", "y.size") * over
    return both.filter(sizes & (apart <= NEAR_ALL)).select("a", "b")


def sets_of(asked: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(fp, hashes): the shingle sets of the classes asked for (fp)."""

    @F.pandas_udf("array<long>")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        shingles = Shingles()
        for texts in batches:
            yield pd.Series([shingles.of(t).view(np.int64) for t in texts])

    keyed = with_key(docs).join(classes.join(asked.distinct(), "fp").select("fp", "first.*"), ["_id", "_dk"]).dropDuplicates(["fp"])
    return stored(keyed.select("fp", hashed("text").alias("hashes")), "sets")


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of the distinct pairs (a, b) of classes whose shingle sets are similar."""
    sets = sets_of(pairs.select(F.col("a").alias("fp")).union(pairs.select("b")), docs, classes)
    # a text that many are compared with is dealt out over shares
    shares = pairs.groupBy("b").agg(F.ceil(F.count("*") / SHARE).cast("long").alias("n"))
    left = pairs.join(shares, "b").select("a", "b", F.pmod(F.xxhash64("a"), "n").alias("share"))
    left = left.join(sets.select(F.col("fp").alias("a"), F.col("hashes").alias("x")), "a")
    right = shares.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("share"))
    right = right.join(sets.select(F.col("fp").alias("b"), F.col("hashes").alias("y")), "b")
    both = left.join(right, ["b", "share"]).withColumn("common", F.size(F.array_intersect("x", "y")))
    over, under = LEAST
    return both.filter(F.col("common") * under >= (F.size("x") + F.size("y") - F.col("common")) * over).select("a", "b")


def forest(fps: list[int], roots: list[int], bits: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Edges between similar classes that, with what the roots say, join all of them that similar pairs join."""
    over, under = LEAST
    up = {r: r for r in roots}

    def top(r: int) -> int:
        while up[r] != r:
            up[r] = up[up[r]]
            r = up[r]
        return r

    code = np.unique(roots, return_inverse=True)[1]
    size = np.array([len(x) for x in sets])
    out = []
    for i in range(len(fps) - 1):
        rest = slice(i + 1, None)
        fits = (code[rest] != code[i]) & (np.minimum(size[rest], size[i]) * under >= np.maximum(size[rest], size[i]) * over)
        at = np.flatnonzero(fits) + i + 1
        for j in at[np.bitwise_count(bits[at] ^ bits[i]).sum(1) <= NEAR_ALL].tolist():
            a, b = top(roots[i]), top(roots[j])
            if a != b:
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common * under >= (size[i] + size[j] - common) * over:
                    up[a] = b
                    out.append((max(fps[i], fps[j]), min(fps[i], fps[j])))
    return out


def inside_regions(rooted: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): edges between classes (region, root, fp, bits) of one region that have different roots. A region's blocks hold either
    one large root's classes alone or those of small roots; two blocks of one root never meet."""
    open_regions = rooted.groupBy("region").agg(F.count("*").alias("n"), F.count_distinct("root").alias("roots")).filter("roots > 1").select("region", "n")
    members = stored(rooted.join(open_regions, "region"), "regions")
    large = members.groupBy("region", "root").agg(F.count("*").alias("of_root")).filter(F.col("of_root") >= BLOCK)
    small = members.groupBy("region").agg(F.max("n").alias("n")).join(large.groupBy("region").agg(F.sum("of_root").alias("of_large")), "region", "left")
    small = small.select("region", (F.col("n") - F.coalesce("of_large", F.lit(0))).alias("of_small"))
    part = lambda c, n: F.pmod(F.xxhash64(c), F.greatest(F.lit(1), F.ceil(n / BLOCK))).cast("string")
    lone = F.when(F.col("of_root").isNotNull(), F.col("root")).alias("lone")
    block = F.when(F.col("of_root").isNotNull(), F.concat_ws(" ", F.col("root").cast("string"), part("fp", F.col("of_root")))).otherwise(F.concat(F.lit("m"), part("root", F.col("of_small"))))
    dealt = members.join(large, ["region", "root"], "left").join(small, "region")
    dealt = stored(dealt.select("region", "n", "root", "fp", "bits", lone, block.alias("block")), "blocks")
    blocks = dealt.select("region", "block", "lone").distinct()
    a, b = blocks.alias("a"), blocks.alias("b")
    meet = (F.col("a.region") == F.col("b.region")) & (F.col("a.block") <= F.col("b.block")) & ~F.coalesce(F.col("a.lone") == F.col("b.lone"), F.lit(False))
    pairs = a.join(b, meet).select("a.region", F.array(F.col("a.block"), F.col("b.block")).alias("pair"))
    sent = dealt.join(pairs.select("region", "pair", F.explode(F.array_distinct("pair")).alias("block")), ["region", "block"])
    # small regions share groups
    groups = F.greatest(F.lit(1), F.lit(members.count() // BLOCK))
    group = F.when(F.col("n") >= BLOCK, F.xxhash64("region", "pair")).otherwise(F.pmod(F.xxhash64("region"), groups))
    sent = sent.join(sets_of(members.select("fp"), docs, classes), "fp").select(group.alias("group"), F.concat_ws("|", F.col("region").cast("string"), "pair").alias("place"), "root", "fp", "bits", "hashes")

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        edges = []
        for _, g in pdf.groupby("place", sort=False):
            sets = [np.asarray(x, np.int64) for x in g["hashes"]]
            edges += forest(g["fp"].tolist(), g["root"].tolist(), np.stack(g["bits"].to_list()).astype(np.int64), sets)
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return sent.groupBy("group").applyInPandas(compare, "a long, b long")


def _apart(limit: int, key: np.ndarray, slot: np.ndarray, region: np.ndarray, fp: np.ndarray, *words: np.ndarray) -> pd.DataFrame:
    """Pairs of one group, of different regions, with limit differing bits in words at most; rows are sorted by key, slot, region."""
    starts, sizes = group_starts(key, slot)
    bits = np.stack(words, 1).view(np.uint64)
    near = lambda x, y: np.bitwise_count(x ^ y).sum(1) <= limit
    found = [np.zeros((0, 2), np.int64)]
    # small groups: all of them at once, pair by pair of places
    behind = np.repeat(starts + sizes, sizes) - np.arange(len(key)) - 1
    at, step = np.flatnonzero((behind > 0) & (np.repeat(sizes, sizes) <= 64)), 1
    while len(at):
        hit = (region[at] != region[at + step]) & near(bits[at], bits[at + step])
        found.append(np.stack([fp[at[hit]], fp[at[hit] + step]], 1))
        step += 1
        at = at[behind[at] >= step]
    for start, size in zip(starts[sizes > 64], sizes[sizes > 64], strict=True):
        end = start + size
        for i in range(start, end):  # those of the same region are next to each other
            other = i + 1 + np.searchsorted(region[i + 1 : end], region[i], "right")
            if other >= end:
                break
            hit = other + np.flatnonzero(near(bits[other:end], bits[i]))
            found.append(np.stack([np.full(len(hit), fp[i]), fp[hit]], 1))
    pairs = np.concatenate(found)
    return pd.DataFrame({"a": pairs.max(1, initial=-(2**63)), "b": pairs.min(1, initial=2**63 - 1)}).drop_duplicates()


def links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): edges between classes (fp, first, size, bits) whose components are those of all similar pairs found."""
    some = classes.filter("size > 0")
    first = F.col("bits")[0].alias("bits0")
    held = some.select(F.explode(F.array(*_segments())).alias("key"), "fp", first)
    centres = held.groupBy("key").agg(F.count("*").alias("n"), F.min(F.struct("fp", "bits0")).alias("centre")).filter("n > 1").select("key", "centre")
    star = held.join(centres, "key").filter((F.col("fp") != F.col("centre.fp")) & _first_near(F.col("bits0"), F.col("centre.bits0")))
    star = stored(near_enough(star.select(F.col("fp").alias("a"), F.col("centre.fp").alias("b")).distinct(), some), "star")
    linked = stored(verified(star, docs, classes), "links")

    named = lambda edges, name: components(edges).select(F.col("node").alias("fp"), F.col("root").alias(name))
    rooted = some.join(named(linked, "root"), "fp", "left").join(named(star, "region"), "fp", "left")
    rooted = stored(rooted.select("fp", "bits", first, F.coalesce("root", "fp").alias("root"), F.coalesce("region", "fp").alias("region")), "rooted")
    inside = stored(inside_regions(rooted, docs, classes), "inside")
    crowds = crowded(rooted, _segments(), _ball, CROWD, 2)
    met = by_group(entries(rooted, _segments(), _ball, "region", "fp", "bits0", but=crowds), partial(_apart, NEAR_FIRST), "a long, b long")
    words = {f"w{i}": F.col("bits")[i] for i in range(WORDS)}
    met_in_crowds = by_group(entries(rooted.withColumns(words), _segments(), _ball, "region", "fp", *words, only=crowds), partial(_apart, NEAR_ALL), "a long, b long")
    met = met.unionByName(met_in_crowds).distinct()
    between = verified(stored(near_enough(met, some), "pairs"), docs, classes)
    return linked.unionByName(inside).unionByName(between)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each document row: _id, _dk, fp, and component, the smallest _id reachable."""
    found = stored(prints(docs), "prints")
    classes = stored(found.groupBy("fp").agg(F.min(F.struct("_id", "_dk")).alias("first"), F.first("size").alias("size"), F.first("bits").alias("bits")), "classes")
    roots = components(links(docs, classes)).withColumnRenamed("node", "fp")
    grouped = classes.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = grouped.groupBy("root").agg(F.min("first._id").alias("component"))
    return found.select("_id", "_dk", "fp").join(stored(grouped.join(lowest, "root").select("fp", "component"), "components"), "fp")


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each component, with all columns: the one with the smallest id (of rows that share it, one)."""
    return one_of_each(docs, near_duplicates(docs))
