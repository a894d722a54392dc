"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

The index holds one posting (document, position, term) for every training token whose term occurs in a test item;
other tokens can be in no answer. A window of test words is looked up from its rarest terms: the lists of the two
rarest are shifted by the terms' offsets and intersected, and what is left is intersected with the lists of the
remaining terms, of the documents that still count.

Defined cases: a null or empty text has no words, so n_words 0 and no hits; a null id is an id of its own; rows that
repeat id and text get the same answer each; an item without words yields no window; items that share an id are one item;
empty tables give an empty result (no documents) or no hits (no items). Columns other than doc_id, text, item_id are
not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import doc_id, small, stored, table, with_key, words

WINDOW = 10
#: Rows up to which the tables made from the test items, and the list of documents with candidates, are broadcast.
BROADCAST_ROWS = 500_000
#: Ends every document's list of words; its position is the number of words. No word has a NUL.
END = "\x00"


def item_windows(items: DataFrame, width: int = WINDOW) -> DataFrame:
    """(item_id, terms): every run of width words of an item; an item of fewer, but not none, is one window."""
    w = F.col("w")
    runs = F.when(F.size(w) > width, F.transform(F.sequence(F.lit(1), F.size(w) - (width - 1)), lambda i: F.slice(w, i, F.lit(width)))).otherwise(F.array(w))
    return (
        items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words(F.col("text")).alias("w"))
        .filter(F.size(w) > 0)
        .select("item_id", F.explode(runs).alias("terms"))
        .distinct()
    )


class Phrases:
    """The distinct windows of the test items, numbered, with the items that hold them and the terms they need."""

    def __init__(self, items: DataFrame, width: int = WINDOW):
        held = stored(item_windows(items, width), "item-windows")
        self.windows = stored(held.select("terms").distinct().withColumn("win", F.monotonically_increasing_id()), "windows")
        self.items = stored(held.join(self.windows, "terms").select("win", "item_id"), "items")
        vocab = self.windows.select(F.explode("terms").alias("term")).distinct().withColumn("term_id", F.monotonically_increasing_id() + 1)
        end = items.sparkSession.range(1).select(F.lit(END).alias("term"), F.lit(0).cast("long").alias("term_id"))
        self.vocab = stored(vocab.unionByName(end), "vocab")

    def slots(self, frequency: DataFrame) -> DataFrame:
        """(win, len, k, offset, term_id): a window's terms; k counts them from the rarest on."""
        slots = (
            self.windows.select("win", F.size("terms").alias("len"), F.posexplode("terms").alias("offset", "term"))
            .join(small(self.vocab, BROADCAST_ROWS), "term")
            .join(small(frequency, BROADCAST_ROWS), "term_id", "left")
        )
        rarest = W.partitionBy("win").orderBy(F.coalesce("n", F.lit(0)), "offset")
        return slots.select("win", "len", "offset", "term_id", (F.row_number().over(rarest) - 1).alias("k"))


def build_postings(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """The index: (_id, _dk, pos, term_id) for each token whose term is in vocab, and the end of each document."""
    tokens = with_key(docs).select("_id", "_dk", F.posexplode(F.array_append(words(F.col("text")), F.lit(END))).alias("pos", "term"))
    return tokens.join(small(vocab, BROADCAST_ROWS), "term").select("_id", "_dk", "pos", "term_id")


def shifted(postings: DataFrame, slots: DataFrame) -> DataFrame:
    """Lists of the slots' terms, each position moved back by the term's offset: where the window would start."""
    return (
        postings.filter("term_id > 0")
        .join(small(slots, BROADCAST_ROWS), "term_id")
        .filter(F.col("pos") >= F.col("offset"))
        .select("_id", "_dk", "win", "len", (F.col("pos") - F.col("offset")).alias("start"), "k")
    )


def _complete(lists: DataFrame, need) -> DataFrame:
    """The places that each of the lists from k = low on has."""
    return lists.groupBy("_id", "_dk", "win", "len", "start").agg(F.expr("bit_or(shiftleft(1L, k))").alias("seen")).filter(F.col("seen") == need).drop("seen")


def phrase_matches(postings: DataFrame, slots: DataFrame) -> DataFrame:
    """(_id, _dk, win, len, start): each place where all terms of a window stand in order, one after another."""
    two = F.when(F.col("len") > 1, 3).otherwise(1)
    found = stored(_complete(shifted(postings, slots.filter("k < 2")), two), "candidates")
    docs = small(found.select("_id", "_dk").distinct(), BROADCAST_ROWS)
    lists = postings.filter("term_id > 0").join(docs, ["_id", "_dk"], "left_semi")
    rest = small(slots.filter("k >= 2").select("win", "k", "offset", "term_id"), BROADCAST_ROWS)
    wanted = found.join(rest, "win").withColumn("pos", F.col("start") + F.col("offset"))
    all_but_two = F.expr("shiftleft(1L, len) - 4")
    whole = _complete(wanted.join(lists, ["_id", "_dk", "pos", "term_id"]), all_but_two)
    return whole.unionByName(found.filter("len <= 2"))


def proximity_matches(postings: DataFrame, slots: DataFrame, slop: int, least: float = 1.0) -> DataFrame:
    """(_id, _dk, win, start, terms_near): places where at least the share least of a window's terms stand within slop
    words of where the window, laid at its rarest term, has them."""
    anchors = stored(shifted(postings, slots.filter("k = 0")), "anchors")
    docs = small(anchors.select("_id", "_dk").distinct(), BROADCAST_ROWS)
    lists = postings.filter("term_id > 0").join(docs, ["_id", "_dk"], "left_semi")
    wanted = anchors.drop("k").join(small(slots.select("win", "k", "offset", "term_id"), BROADCAST_ROWS), "win")
    near = wanted.withColumn("pos", F.explode(F.sequence(F.col("start") + F.col("offset") - slop, F.col("start") + F.col("offset") + slop)))
    hit = near.join(lists, ["_id", "_dk", "pos", "term_id"])
    return hit.groupBy("_id", "_dk", "win", "len", "start").agg(F.count_distinct("k").alias("terms_near")).filter(F.col("terms_near") >= F.col("len") * least).drop("len")


def contamination(docs: DataFrame, items: DataFrame, width: int = WINDOW) -> DataFrame:
    """One row for each document row: _id, _dk, doc_id, n_words, n_hit, n_items, items, contaminated."""
    phrases = Phrases(items, width)
    postings = stored(build_postings(docs, phrases.vocab), "postings")
    slots = stored(phrases.slots(postings.groupBy("term_id").agg(F.count("*").alias("n"))), "slots")
    matches = stored(phrase_matches(postings, slots), "matches")
    # words under the union of the matches: each match adds what lies beyond the furthest end before it
    before = W.partitionBy("_id", "_dk").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1)
    spans = matches.select("_id", "_dk", "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    added = F.greatest(F.lit(0), F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(before), F.lit(0))))
    hit = spans.select("_id", "_dk", added.alias("added")).groupBy("_id", "_dk").agg(F.sum("added").alias("n_hit"))
    items_of = (
        matches.select("_id", "_dk", "win").distinct().join(small(phrases.items, BROADCAST_ROWS), "win")
        .groupBy("_id", "_dk").agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    )
    ends = postings.filter("term_id = 0").select("_id", "_dk", F.col("pos").cast("long").alias("n_words"))
    found = ends.join(hit.join(items_of, ["_id", "_dk"]), ["_id", "_dk"], "left")
    return found.select(
        "_id", "_dk", doc_id(), "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).select("*", F.size("items").cast("long").alias("n_items"), (F.col("n_hit") > 0).alias("contaminated"))


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no window of any item."""
    keyed = with_key(docs, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    bad = stored(contamination(docs, items).filter("contaminated").select("_id", "_dk").distinct(), "contaminated")
    return keyed.join(small(bad, BROADCAST_ROWS), ["_id", "_dk"], "left_anti").select("row.*")


_SPLIT = "list_filter(string_split_regex(translate(coalesce({t}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

ORACLE = {
    "op1_benchmark_decontamination": f"""
WITH d AS (SELECT doc_id, {_SPLIT.format(t='text')} AS w FROM documents),
b AS (SELECT item_id, {_SPLIT.format(t='text')} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS g
        FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
grams AS (SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS g
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
m AS (SELECT doc_id, item_id, i, win.n FROM grams JOIN win ON grams.g = win.g AND grams.n = win.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
""",
}
QUERIES = {"op1_benchmark_decontamination": op1_benchmark_decontamination}
