"""Quality classifier: nearest-neighbour voting among labelled documents in a latent-semantic space.

Fit: a bounded sample of labelled documents (SAMPLE, in hash order of the ids, so that it is the same on each run) is
turned into hashed term and word-shape frequencies; a truncated SVD of their weighted matrix, of fixed size, gives the
space. Only these sparse rows come to the driver, and the vectors, labels and projection that are broadcast have a size
that the parameters bound. Score: every document's whole text is projected, its cosines with all labelled vectors are
computed exactly, block by block, and its NEIGHBOURS nearest vote with their label, weighted by a power of the cosine.

Labels are used for documents whose crc32 of the id is not 0 modulo 5; the score of a text depends on the text alone.

Defined cases: null and empty texts, or ones of white space, score as the share of label 1 in the sample; so does every
text if there are no labels (share 1); labels other than 0 and 1 and null ids of labels are ignored, of several labels
of an id the least counts; rows that repeat get the same score; an empty table gives an empty result. Columns other than
doc_id and text are not read.
"""

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WordHashes, bytes_but, held_out, own_names, packed, short_batches, stored, table

#: Labelled documents that the classifier is fitted on at most.
SAMPLE = 4000
TERMS = 4096
SHAPES = 1024
RANK = 48
NEIGHBOURS = 15
#: Weight of the terms' block against that of the shapes, which has 1.
TERM_WEIGHT = 0.25
POWER = 8
THRESHOLD = 0.3
BLOCK = 128
_BYTES = [chr(i) for i in range(128)]
#: For words: ASCII letters in lower case, bytes of other letters as they are, anything else 0.
_LETTERS = bytes([ord(c.lower()) if c.isalpha() else 0 for c in _BYTES] + list(range(128, 256)))
#: For shapes: capitals A, other letters a, digits 0, white space a space, punctuation as it is.
_KINDS = bytes([ord("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else " " if c.isspace() else c) for c in _BYTES] + [ord("a")] * 128)


class Features:
    """Sparse rows: unit-length blocks of square-rooted term and shape frequencies, by array operations on the text's
    bytes. A shape is a token with runs of capitals, other letters and digits as A, a and 0, cut to 8: 'The&&&' is 'Aa&'."""

    def __init__(self):
        self.words = WordHashes(bytes_but(b"\0"))

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        kinds = np.frombuffer(raw.translate(_KINDS), np.uint8)
        change = np.concatenate([[True], kinds[1:] != kinds[:-1]]) if len(kinds) else np.zeros(0, bool)
        found = Counter(x[:8] for x in kinds[change].tobytes().split())
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.float32)
        both = np.zeros(WIDTH)
        for x, n in found.items():
            both[TERMS + zlib.crc32(x) % SHAPES] += n
        # one more shape, of the text as a whole: words that repeat the one before
        hashes = self.words.of(raw.translate(_LETTERS)) >> np.uint64(32)
        both[-1] = (hashes[1:] == hashes[:-1]).sum()
        both[TERMS:] /= both[TERMS:].sum()
        both[:TERMS] = np.bincount((hashes % np.uint64(TERMS)).astype(np.int64), minlength=TERMS) * (TERM_WEIGHT**2 / max(1, len(hashes)))
        ids = np.flatnonzero(both)
        return ids, np.sqrt(both[ids]).astype(np.float32)


WIDTH = TERMS + SHAPES + 1


class Model:
    """The projection, the labelled vectors of unit length, and their labels."""

    def __init__(self, project: np.ndarray, vectors: np.ndarray, labels: np.ndarray):
        self.project, self.vectors, self.labels = project, vectors, labels
        self.prior = float(labels.mean()) if len(labels) else 1.0

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        """Votes for rows of projected documents, BLOCK at a time against all labelled vectors."""
        out = np.full(len(vectors), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        if not k:
            return out
        size = np.linalg.norm(vectors, axis=1)
        for at in range(0, len(vectors), BLOCK):
            some = np.flatnonzero(size[at : at + BLOCK] > 0) + at
            if not len(some):
                continue
            cos = (vectors[some] / size[some, None]) @ self.vectors.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            weight = np.clip(np.take_along_axis(cos, near, 1), 1e-6, 1) ** POWER
            out[some] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def fit_rows(rows: list[tuple[list[int], list[float], int]]) -> Model:
    """The model of at most SAMPLE sparse rows with labels."""
    rows = [r for r in rows if len(r[0])]
    a = np.zeros((len(rows), WIDTH), np.float32)
    for i, (ids, values, _) in enumerate(rows):
        a[i, np.asarray(ids, np.int64)] = values
    labels = np.array([r[2] for r in rows], np.float32)
    if not len(rows):
        return Model(np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels)
    idf = np.log((1 + len(rows)) / (1 + (a > 0).sum(0))) + 1
    idf[TERMS:] = 1  # a shape is telling by how much of it there is
    a *= idf
    # truncated SVD by subspace iteration from a fixed start
    q = np.random.default_rng(7).standard_normal((WIDTH, min(RANK + 16, len(rows)))).astype(np.float32)
    for _ in range(6):
        q, _ = np.linalg.qr(a.T @ (a @ q))
    _, _, v = np.linalg.svd(a @ q, full_matrices=False)
    project = (q @ v[:RANK].T).astype(np.float32)
    vectors = a @ project
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Model((project * idf[:, None]).astype(np.float32), vectors, labels)


def _sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    features = Features()
    for b in batches:
        got = [features.row(t) for t in b["text"]]
        yield pd.DataFrame({"ids": [x.tolist() for x, _ in got], "vals": [x.tolist() for _, x in got], "label": b["label"]})


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """labels: (doc_id, quality). Learns from at most sample labelled documents that are not held out."""
    usable = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(5, 0))
    chosen = usable.groupBy("doc_id").agg(F.min("quality").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", "text").join(F.broadcast(stored(chosen, "labelled")), "doc_id").select("doc_id", "text", "label")
    rows = stored(texts.repartition(8, "doc_id").mapInPandas(_sparse, "ids array<int>, vals array<float>, label int"), "features")
    rows = rows.orderBy(F.xxhash64("ids", "vals"), "label").limit(sample)  # repeated ids can't lengthen it
    return fit_rows([(r["ids"], r["vals"], r["label"]) for r in rows.collect()])


def votes(docs: DataFrame, model: Model) -> Column:
    """The score of the column text of docs."""
    short_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((model.project, model.vectors, model.labels))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, features = Model(*shared.value), Features()
        for texts in batches:
            vectors = np.zeros((len(texts), m.project.shape[1]), np.float32)
            for i, t in enumerate(texts):
                ids, values = features.row(t)
                if len(ids):
                    vectors[i] = values @ m.project[ids]
            yield pd.Series(m.scores(vectors))

    return scored(F.col("text").cast("string"))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with all their columns and quality_score (with a _ behind it, if they have such a column)."""
    return docs.select("*", votes(docs, model).alias(own_names(docs, "quality_score")["quality_score"]))


def accepted(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold."""
    return docs.select(packed(docs), votes(docs, model).alias("score")).filter(F.col("score") >= threshold).select("row.*")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op2_quality_classifier": op2_quality_classifier}
