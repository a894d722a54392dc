"""Reversible line dedup: exact reference tables, with sharded cuckoo filters in front of them.

A line's key is the line without white space at its ends and with A-Z in lower case, kept as a 128-bit hash. The exact
side is a table of references (key, document). Counting it gives each key's number of documents and the largest id; keys
in enough documents are repeated, and their lines are dropped but for those of that document. Inserting documents adds
references, deleting a document takes its own away, and counting again undoes every decision that rested on it.

The repeated keys also stand in cuckoo filters, one for each range of hashes, which are updated by insertion and deletion
of single keys: change() takes new and deleted documents, finds the keys that became or ceased to be repeated, and
passes just these on. Documents are read once against the filters; only lines that a filter knows are looked up in the
exact table, so a false hit of a filter costs a lookup and changes no result. While all filters together are small
enough they are broadcast; beyond that, the hashes of long lines are dealt out by shard and salt to the shard's filter.

Defined cases: null and empty texts are one empty line, whose key is too short to drop; a null id is a document of its
own, smaller than any other; rows that share an id are one document, and all of them keep a line if that id is the
largest; a line repeated within a document counts once and all its places are treated alike; empty tables give an empty
result. Other columns pass through untouched; where they have the names of the columns that dedup_lines() adds, those get a _ behind them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NO_ID, own_names, packed, stored, table, with_key

LEAST_CHARS = 40
LEAST_DOCS = 5
KEYS_A_SHARD = 32_768
SLOTS = 4
#: Bytes of all filters up to which they are broadcast.
FILTER_BYTES = 32 << 20
#: Parts that a shard's lines are dealt out to beyond that, by document, each with a copy of the filter.
SALTS = 16
SPACE = " \t\n\x0b\x0c\r"


def line_key(line: str, least: int = LEAST_CHARS) -> tuple[int, int] | None:
    """Two signed halves of the key's hash; None for keys that are too short."""
    key = line.strip(SPACE)
    if len(key) < least:
        return None
    d = xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower())  # bytes.lower() changes A-Z alone
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


class CuckooFilter:
    """Partial-key cuckoo filter over pairs of 64-bit hashes, with 16-bit tags and four slots a bucket. A key that no
    slot takes goes to a list beside the table, so that there are never false negatives."""

    def __init__(self, buckets: int):
        self.tags = np.zeros((1 << max(1, (buckets - 1).bit_length()), SLOTS), np.uint16)
        self.rest: list[tuple[int, int]] = []  # (bucket, tag)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        return cls(-(-keys * 5 // (SLOTS * 4)) or 1)

    def _tag(self, h1, h2):
        return (np.asarray(h2, np.int64).view(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, bucket, tag):
        return (bucket ^ (np.asarray(tag, np.uint64) * np.uint64(0x5BD1E995))) & np.uint64(len(self.tags) - 1)

    def _first(self, h1):
        return np.asarray(h1, np.int64).view(np.uint64) & np.uint64(len(self.tags) - 1)

    def insert(self, h1: int, h2: int) -> None:
        tag, b = self._tag(h1, h2), int(self._first(h1))
        for at in (b, int(self._other(np.uint64(b), tag))):
            free = np.flatnonzero(self.tags[at] == 0)
            if len(free):
                self.tags[at, free[0]] = tag
                return
        at = b
        for kick in range(200):
            slot = kick % SLOTS
            self.tags[at, slot], tag = tag, self.tags[at, slot]
            at = int(self._other(np.uint64(at), tag))
            free = np.flatnonzero(self.tags[at] == 0)
            if len(free):
                self.tags[at, free[0]] = tag
                return
        self.rest.append((at, int(tag)))

    def delete(self, h1: int, h2: int) -> bool:
        """Takes one copy of the key out; only keys that were inserted may be deleted."""
        tag, b = self._tag(h1, h2), int(self._first(h1))
        places = (b, int(self._other(np.uint64(b), tag)))
        for at in places:
            full = np.flatnonzero(self.tags[at] == tag)
            if len(full):
                self.tags[at, full[0]] = 0
                return True
        for at in places:
            if (at, int(tag)) in self.rest:
                self.rest.remove((at, int(tag)))
                return True
        return False

    def contains(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        tag, b = self._tag(h1, h2), self._first(h1)
        other = self._other(b, tag)
        hit = (self.tags[b.astype(np.int64)] == tag[:, None]).any(1) | (self.tags[other.astype(np.int64)] == tag[:, None]).any(1)
        for at, t in self.rest:
            hit |= ((b == at) | (other == at)) & (tag == t)
        return hit

    def dump(self) -> bytes:
        return np.array([len(self.tags), len(self.rest)], np.int64).tobytes() + self.tags.tobytes() + np.array(self.rest, np.int64).tobytes()

    @classmethod
    def load(cls, raw: bytes) -> CuckooFilter:
        n, k = np.frombuffer(raw, np.int64, 2)
        out = cls(int(n))
        out.tags = np.frombuffer(raw, np.uint16, int(n) * SLOTS, 16).reshape(-1, SLOTS).copy()
        out.rest = [tuple(map(int, x)) for x in np.frombuffer(raw, np.int64, 2 * int(k), 16 + 2 * SLOTS * int(n)).reshape(-1, 2)]
        return out


def references(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """(h1, h2, _id): the exact side of the index, one row for each document that holds a long line."""

    def keys(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(*k, i) for i, t in zip(b["_id"], b["text"], strict=True) if t for k in {line_key(x, least_chars) for x in t.split("\n")} - {None}]
            yield pd.DataFrame(rows, columns=["h1", "h2", "_id"])

    return with_key(docs).select("_id", "text").mapInPandas(keys, "h1 long, h2 long, _id long").distinct()


def insert(refs: DataFrame, docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """The references with those of further documents."""
    return refs.unionByName(references(docs, least_chars)).distinct()


def delete(refs: DataFrame, ids: DataFrame) -> DataFrame:
    """The references without those of the documents in ids (doc_id)."""
    gone = ids.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id")).distinct()
    return refs.join(gone, "_id", "left_anti")


def repeated(refs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(h1, h2, n_docs, keeper): keys in at least least_docs documents, and the one that keeps their lines."""
    return refs.groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("_id").alias("keeper")).filter(F.col("n_docs") >= least_docs)


def build_filters(keys: DataFrame, shards: int) -> DataFrame:
    """(shard, n, filter) over (h1, h2) keys. A shard is a range of hashes with about KEYS_A_SHARD keys."""

    def one(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.sized(len(pdf))
        for a, b in zip(pdf["h1"], pdf["h2"], strict=True):
            f.insert(a, b)
        return pd.DataFrame({"shard": [k[0]], "n": [len(pdf)], "filter": [f.dump()]})

    return keys.select(shard_of(F.col("h1"), shards).alias("shard"), "h1", "h2").groupBy("shard").applyInPandas(one, "shard long, n long, filter binary")


def update_filters(filters: DataFrame, added: DataFrame, removed: DataFrame, shards: int) -> DataFrame:
    """The filters after single keys came (added: h1, h2) and went (removed)."""
    parts = [x.select(shard_of(F.col("h1"), shards).alias("shard"), "h1", "h2", F.lit(s).alias("sign")) for x, s in ((added, 1), (removed, -1))]

    def one(k: tuple, old: pd.DataFrame, new: pd.DataFrame) -> pd.DataFrame:
        f = CuckooFilter.load(old["filter"].iloc[0]) if len(old) else CuckooFilter.sized(2 * len(new))
        n = int(old["n"].sum())
        for a, b, s in zip(new["h1"], new["h2"], new["sign"], strict=True):
            if s > 0:
                f.insert(a, b)
            else:
                f.delete(a, b)
            n += s
        return pd.DataFrame({"shard": [k[0]], "n": [n], "filter": [f.dump()]})

    return filters.groupBy("shard").cogroup(parts[0].unionByName(parts[1]).groupBy("shard")).applyInPandas(one, "shard long, n long, filter binary")


def shard_of(h1, shards: int):
    """The top bits of h1; shards is a power of two."""
    return F.shiftrightunsigned(h1, 64 - shards.bit_length() + 1) if shards > 1 else F.lit(0).cast("long")


def change(refs: DataFrame, filters: DataFrame, shards: int, added: DataFrame | None = None, deleted: DataFrame | None = None, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """References and filters after documents came (added: doc_id, text) and went (deleted: doc_id). Only keys that these
    documents hold are counted again, and only those that crossed the threshold change a filter."""
    none = refs.limit(0)
    came = none if added is None else references(added, least_chars)
    ids = None if deleted is None else deleted.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("_id")).distinct()
    went = none if ids is None else refs.join(ids, "_id", "left_semi").select("h1", "h2", "_id")
    now = refs.join(went, ["h1", "h2", "_id"], "left_anti").unionByName(came).distinct()
    now = stored(now, "references")
    touched = stored(came.select("h1", "h2").union(went.select("h1", "h2")).distinct(), "touched")
    often = lambda r: repeated(r.join(touched, ["h1", "h2"], "left_semi"), least_docs).select("h1", "h2")
    was, is_now = stored(often(refs), "repeated-before"), stored(often(now), "repeated-now")
    return now, stored(update_filters(filters, is_now.join(was, ["h1", "h2"], "left_anti"), was.join(is_now, ["h1", "h2"], "left_anti"), shards), "line-filters")


def _long_lines(docs: DataFrame, filters: dict[int, bytes] | None, shards: int, least_chars: int) -> DataFrame:
    """(_id, _dk, line, h1, h2): long lines; with filters, those that they know."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = None if filters is None else {s: CuckooFilter.load(raw) for s, raw in filters.items()}
        bits = shards.bit_length() - 1
        for b in batches:
            rows = [(i, d, n, *k) for i, d, t in zip(b["_id"], b["_dk"], b["text"], strict=True) if t for n, x in enumerate(t.split("\n")) if (k := line_key(x, least_chars))]
            if known is not None and rows:
                h = np.array([r[3:] for r in rows], np.int64)
                shard = h[:, 0].view(np.uint64) >> np.uint64(64 - bits) if bits else np.zeros(len(h), np.uint64)
                hit = np.zeros(len(h), bool)
                for s in np.unique(shard):
                    if int(s) in known:
                        at = np.flatnonzero(shard == s)
                        hit[at] = known[int(s)].contains(h[at, 0], h[at, 1])
                rows = [rows[i] for i in np.flatnonzero(hit)]
            yield pd.DataFrame(rows, columns=["_id", "_dk", "line", "h1", "h2"])

    return with_key(docs).select("_id", "_dk", "text").mapInPandas(look, "_id long, _dk long, line int, h1 long, h2 long")


def _routed(lines: DataFrame, filters: DataFrame, shards: int) -> DataFrame:
    """Lines that their shard's filter knows: each shard and salt is sorted so that the filter comes before its lines."""
    named = lines.columns
    own = lines.withColumns({"shard": shard_of(F.col("h1"), shards), "salt": F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"), "filter": F.lit(None).cast("binary")})
    zeros = [F.lit(0).cast(kind).alias(c) for c, kind in lines.dtypes]  # nulls would make floats of integers
    copies = filters.select(*zeros, "shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), "filter")

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, known = None, None
        for b in batches:
            for place, rows in b.groupby(["shard", "salt"], sort=False):
                if place != at:
                    at, known = place, None
                head = rows["filter"].iloc[0]
                if head is not None:
                    known, rows = CuckooFilter.load(head), rows.iloc[1:]
                if known is not None and len(rows):
                    yield rows[known.contains(rows["h1"].to_numpy(np.int64), rows["h2"].to_numpy(np.int64))][named]

    both = own.unionByName(copies).repartition("shard", "salt")
    return both.sortWithinPartitions("shard", "salt", F.col("filter").isNull()).mapInPandas(look, lines.schema)


def _without(text: Column, n_lines: Column, drop: Column) -> Column:
    """The text without the lines of the given numbers. It is split once: inside transform(), lines has been computed."""
    stay = F.array_except(F.sequence(F.lit(0), n_lines.cast("int") - 1), drop)
    return F.transform(F.array(F.split(text, "\n", -1)), lambda lines: F.concat_ws("\n", F.transform(stay, lambda i: F.get(lines, i))))[0]


def dedup_lines(docs: DataFrame, least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS, refs: DataFrame | None = None) -> DataFrame:
    """The documents with all their columns, text without its repeated lines (null stays null), n_lines and n_dropped.
    refs: references of an index that holds the documents; by default it is built from them."""
    exact = stored(repeated(references(docs, least_chars) if refs is None else refs, least_docs), "line-counts")
    n = exact.count()
    shards = 1 << max(0, (n // KEYS_A_SHARD).bit_length())
    table = stored(build_filters(exact.select("h1", "h2"), shards), "line-filters")
    if n * 2 * 2 < FILTER_BYTES:
        filters = {r["shard"]: bytes(r["filter"]) for r in table.collect()}  # at most FILTER_BYTES
        maybe = _long_lines(docs, filters, shards, least_chars)
    else:
        maybe = _routed(_long_lines(docs, None, shards, least_chars), table, shards)
    hits = maybe.join(exact, ["h1", "h2"]).filter(F.col("_id") != F.col("keeper"))
    dropped = hits.groupBy("_id", "_dk").agg(F.collect_set("line").alias("drop"))
    both = with_key(docs, packed(docs)).drop("text").join(dropped.hint("shuffle_hash"), ["_id", "_dk"], "left")
    text = F.col("row.text")
    n_lines = F.length(F.coalesce(text, F.lit(""))) - F.length(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(""))) + 1
    out = both.select("row", F.when(F.col("drop").isNull(), text).otherwise(_without(text, n_lines, F.col("drop"))).alias("kept"), n_lines.cast("long").alias("n_lines"), F.coalesce(F.array_size("drop"), F.lit(0)).cast("long").alias("n_dropped"))
    return out.select(*[F.col("kept").alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns], *[F.col(n).alias(name) for n, name in own_names(docs, "n_lines n_dropped").items()])


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = {
    "op4_line_dedup": r"""
WITH l AS (SELECT doc_id, n, x, translate(trim(x, e' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
           FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS x, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)),
r AS (SELECT k, max(doc_id) AS keeper FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT l.*, r.k IS NOT NULL AND l.doc_id <> r.keeper AS drop_it FROM l LEFT JOIN r ON l.k = r.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE drop_it) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY n) FILTER (WHERE NOT drop_it), '')) AS kept_sha256
FROM d GROUP BY doc_id
""",
}
QUERIES = {"op4_line_dedup": op4_line_dedup}
