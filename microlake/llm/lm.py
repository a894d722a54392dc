"""LM scoring with a hashed maximum-entropy model, class-factored.

P(word | history) = P(class | history) * P(word | class, history). The end of a text is a class of its own. The most
frequent words, by rank, fill classes of WORDS_A_CLASS each; all other words fall in classes by their last two bytes. Both
factors are softmaxes over sums of rows of weights: one row for each feature of the history, which are the word before
(n-gram), the word before that (skip), and the two together (n-gram), hashed to rows; for the word in its class they are hashed
together with the class. In a class of rarer words, those that occur LEARNT times have a factor of the history as well, by a tree
of softmaxes that is as deep as their number asks for: its root has the rest of the class as one outcome, its most frequent words, and
nodes with the others. In the rest, P(word | class) is (c + 1) / (N + V + 1) with its own exact counts, so that one unseen
word has a share in each class. The words with a factor of their own and the rows grow with the training tokens without a bound: the
rows in proportion up to 2**STEEP_BITS of a feature, and with the root beyond, because they are sent to the tasks.

Training is distributed and synchronous: in each of ROUNDS, all tasks sum the gradient of their share of that round's
documents at the same weights; the sums are added up in two levels of grouping, and one step, with a rate for each weight, is
taken. Rounds part the training documents by hash, so each is used once, and the result does not depend on how they
are dealt out to tasks, but for rounding.

Counts are exact and cover all training documents. The most frequent words, HOT at most, are broadcast with their
counts; a document's other words are looked up by a join on the word.

Defined cases: null and empty texts have just the end token; a null id is in the training part; rows that share id and text
get the same answer each; without training documents every token has base 1/(0+1*(0+1)) = 1, so 0, and classes are
equally likely; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import NOT_SPACE, ODD, WordHashes, doc_id, held_out, mixed, stored, table, with_key

END = b"\n"
CLASSES, WORDS_A_CLASS, SUFFIX_CLASSES = 8, 32, 7
ALL_CLASSES = 1 + CLASSES + SUFFIX_CLASSES
FEATURES = 3
#: Rows of a feature, as powers of two, and the training tokens for each of them up to STEEP_BITS.
LEAST_BITS, STEEP_BITS, TOKENS_A_ROW = 10, 14, 4096
#: Training tokens of a word for each word of a suffix class that has its own outcomes.
LEARNT = 4096
ROUNDS = 5
#: Size of a step, and what is added to the size of a weight's gradients, in tokens.
RATE, PRIOR = 0.4, 30.0
#: Tokens of a block of the numpy work.
STEP = 16384
HOT = 100_000
#: Words that a task counts before it hands the counts on.
HELD = 300_000
#: Parts of the gradient, each of which is summed by itself.
PARTS = 64
_SUFFIX = np.array([zlib.crc32(bytes([i >> 8, i & 255])) % SUFFIX_CLASSES for i in range(1 << 16)], np.int16) + 1 + CLASSES
_TURNS = np.array([pow(ODD, 2 * i + 3, 2**64) for i in range(FEATURES)], np.uint64)
_CLASS_TURN = np.uint64(0xD6E8FEB86659FD93)


def suffix_class(word: bytes) -> int:
    """The class of a word that is not among the most frequent ones."""
    return 0 if word == END else int(_SUFFIX[(word[-2] << 8 if len(word) > 1 else 0) | word[-1]])


def lowered(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass").lower() if text else b""  # bytes.lower() changes A-Z alone


def bits_for(tokens: int) -> int:
    """Rows of a feature as a power of two."""
    rows = math.log2(tokens / TOKENS_A_ROW + 1)
    return max(LEAST_BITS, math.ceil(rows) if rows <= STEEP_BITS else STEEP_BITS + int((rows - STEEP_BITS) / 2))


def tree_paths(n: int, width: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each of n words, most frequent first, and at the end for the rest of their class, the nodes (from 0, -1 behind the last) and
    outcomes on its way from the root; and the number of nodes. Of the root's outcomes the first is the rest, those of the first
    half are words, and those of the second half are words or trees of even depth."""
    first = min(n, width // 2 - 1)
    more, levels = n - first, 0
    while (width - width // 2) * width**levels < more:
        levels += 1
    nodes, outcomes = np.full((n + 1, levels + 1), -1, np.int32), np.zeros((n + 1, levels + 1), np.int32)
    nodes[:, 0], outcomes[:first, 0], j, used = 0, 1 + np.arange(first), np.arange(more), 1
    outcomes[first:n, 0] = width // 2 + j // width**levels
    for level in range(1, levels + 1):
        nodes[first:n, level] = used + j // width ** (levels - level + 1)
        outcomes[first:n, level] = j // width ** (levels - level) % width
        used += 1 + int(j[-1]) // width ** (levels - level + 1)
    return nodes, outcomes, used


class Model:
    """Hashes of the words that have outcomes, by which they are numbered, and the weights: w1, w2 (feature, row, outcome), and the
    biases b1, b2, which begin as the logarithms of the shares that the outcomes have. The first CLASSES lines of b2 are the classes of
    frequent words, the others nodes of trees. learned: (word, count) of words of suffix classes, most frequent first; rest: for each
    class what the other words of it count."""

    def __init__(self, words: list[bytes], counts: list[int], class_counts: np.ndarray, tokens: int, learned: list[tuple[bytes, int]] = (), rest: np.ndarray | None = None):
        self.bits, width = bits_for(tokens), WORDS_A_CLASS
        self.frequent = len(words)
        h = WordHashes(NOT_SPACE).of(b" ".join([*words, *(w for w, _ in learned)]))
        self.ranks = np.argsort(h)
        self.hashes = h[self.ranks]
        self.w1 = np.zeros((FEATURES, 1 << self.bits, ALL_CLASSES), np.float32)
        self.w2 = np.zeros((FEATURES, 1 << self.bits, width), np.float32)
        self.b1 = (np.log(class_counts + 1) - np.log((class_counts + 1).sum())).astype(np.float32)
        n = np.zeros(CLASSES * width)
        n[: len(words)] = counts
        n, self.rest = self._trees(n.reshape(CLASSES, width), learned, rest)
        # places that no word has stay out of reach
        self.b2 = np.where(n > 0, np.log(np.maximum(n, 1)) - np.log(np.maximum(n.max(1, keepdims=True), 1)), -80).astype(np.float32)

    def _trees(self, n: np.ndarray, learned: list[tuple[bytes, int]], rest: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Sets the way of each learned word, and of the rest of each class that has such words. Returns n with a line for each node, and
        which way is that of the rest of a class, or -1."""
        of, ways, behind = np.array([suffix_class(w) for w, _ in learned], int), [], np.full(ALL_CLASSES, -1)
        for c in sorted(set(of.tolist())):
            nodes, outcomes, used = tree_paths(int((of == c).sum()), n.shape[1])
            behind[c] = len(learned) + len(ways)
            ways.append((np.append(np.flatnonzero(of == c), behind[c]), np.where(nodes >= 0, nodes + len(n), -1), outcomes))
            n = np.concatenate([n, np.zeros((used, n.shape[1]))])
        deepest = max((w[1].shape[1] for w in ways), default=0)
        self.nodes, self.outcomes = np.full((len(learned) + len(ways), deepest), -1, np.int32), np.zeros((len(learned) + len(ways), deepest), np.int32)
        for at, nodes, outcomes in ways:
            self.nodes[at, : nodes.shape[1]], self.outcomes[at, : nodes.shape[1]] = nodes, outcomes
        count = np.array([k for _, k in learned] + [max(rest[c], 1) for c in np.flatnonzero(behind >= 0)], float)
        for nodes, outcomes in zip(self.nodes.T, self.outcomes.T, strict=True):
            np.add.at(n, (nodes[nodes >= 0], outcomes[nodes >= 0]), count[nodes >= 0])
        return n, behind

    def steps(self, classes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each softmax below that of the classes: the token, the line of b2, and the outcome. Some tokens have none, some many."""
        at = np.flatnonzero((places >= 0) & (classes <= CLASSES))
        out = [(at, classes[at].astype(np.int32) - 1, places[at].astype(np.int32))]
        if self.nodes.size:
            at = np.flatnonzero(self.rest[classes] >= 0)
            way = np.where(places[at] >= 0, places[at], self.rest[classes[at]])
            for nodes, outcomes in zip(self.nodes.T, self.outcomes.T, strict=True):
                going = np.flatnonzero(nodes[way] >= 0)
                at, way = at[going], way[going]
                out.append((at, nodes[way], outcomes[way]))
        return tuple(np.concatenate(x) for x in zip(*out, strict=True))

    def arrays(self) -> list[np.ndarray]:
        return [self.w1, self.w2, self.b1, self.b2]


class Reader:
    """Turns texts into blocks of tokens. The place of a frequent word is that in its class, the place of a learned one its number."""

    def __init__(self, model: Model):
        self.model, self.words = model, WordHashes(NOT_SPACE)

    def read(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, class, and place (-1 for words without one) of each token of the texts, ends included; and where each text ends."""
        m, raw = self.model, END.join([*raws, b""])  # an end parts words, too
        word = NOT_SPACE.take(np.frombuffer(raw, np.uint8))
        ends = np.flatnonzero(word[:-1] > word[1:])
        own = np.searchsorted(ends, np.cumsum([len(x) + 1 for x in raws]))  # words up to the end of each text
        stops = own + np.arange(1, len(raws) + 1)
        h, classes, places = (np.zeros(len(ends) + len(raws), t) for t in (np.uint64, np.int16, np.int32))
        places -= 1
        if len(ends):
            at = np.ones(len(h), bool)
            at[stops - 1] = False
            at = np.flatnonzero(at)
            h[at] = hashes = self.words.of(raw)
            b = np.frombuffer(raw, np.uint8)
            before = np.where((ends > 0) & word[ends - 1], b[ends - 1], 0).astype(np.int64)
            classes[at] = _SUFFIX[before << 8 | b[ends]]
            if len(m.hashes):
                found = np.minimum(np.searchsorted(m.hashes, hashes), len(m.hashes) - 1)
                known = np.flatnonzero(m.hashes[found] == hashes)
                size, ranks = m.w2.shape[2], m.ranks[found[known]]
                frequent = ranks < m.frequent
                places[at[known]] = np.where(frequent, ranks % size, ranks - m.frequent)
                classes[at[known[frequent]]] = 1 + ranks[frequent] // size
        return h, classes, places, stops

    def tokens(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The same of one text."""
        return self.read([raw])[:3]

    def blocks(self, texts: Iterator[str | None], most: int = 0) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, bool]]]]:
        """Features (a line for each kind), classes and places of at most so many tokens, and for each of their texts, in order, the number
        of tokens and whether the text ends there. What lies before a text counts as ends."""
        most = most or STEP
        held, size = [], 0
        for t in texts:
            held.append(lowered(t))
            size += len(held[-1]) + 1
            if size >= 8 * most:
                yield from self._cut(held, most)
                held, size = [], 0
        if held:
            yield from self._cut(held, most)

    def _cut(self, raws: list[bytes], most: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, list[tuple[int, bool]]]]:
        h, classes, places, stops = self.read(raws)
        one, two = np.append(np.uint64(0), h[:-1]), np.append(np.zeros(2, np.uint64), h)[: len(h)]
        two[np.append(0, stops[:-1])] = 0
        for at in range(0, len(h), most):
            to = min(at + most, len(h))
            a, b = one[at:to], two[at:to]
            edges = stops[np.searchsorted(stops, at, "right") : np.searchsorted(stops, to, "right")].tolist()
            sizes = [(y - x, True) for x, y in zip([at, *edges], edges)] + [(to - x, False) for x in [at, *edges][-1:] if x < to]
            yield np.stack([a, b * np.uint64(3) + np.uint64(1), mixed(a * np.uint64(5) + b)]), classes[at:to], places[at:to], sizes


def _row(model: Model, features: np.ndarray) -> np.ndarray:
    return ((features * _TURNS[:, None]) >> np.uint64(64 - model.bits)).astype(np.uint32)


def class_rows(model: Model, features: np.ndarray) -> np.ndarray:
    return _row(model, features)


def word_rows(model: Model, features: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    return _row(model, features + (nodes + 1).astype(np.uint64) * _CLASS_TURN)


def shares(weights: np.ndarray, rows: np.ndarray, bias: np.ndarray) -> np.ndarray:
    """Probabilities of all outcomes, a line for each token."""
    z = weights[0].take(rows[0], 0)
    for w, r in zip(weights[1:], rows[1:], strict=True):
        z += w.take(r, 0)
    z += bias
    np.exp(np.clip(z, -85, 60, out=z), out=z)  # sums of weights stay far inside
    z /= (z @ np.ones(z.shape[1], np.float32))[:, None]
    return z


def _add_up(sums: np.ndarray, rows: np.ndarray, g: np.ndarray) -> None:
    """Adds each line of g to its rows: two numbers at a time, as the parts of one complex number, which add.at takes in half the time."""
    width = g.shape[1] // 2
    pairs = np.ascontiguousarray(g).view(np.complex64).ravel()
    for total, r in zip(sums, rows, strict=True):
        np.add.at(total.view(np.complex64).reshape(-1), (r.astype(np.int64)[:, None] * width + np.arange(width)).ravel(), pairs)


def add_gradient(model: Model, sums: list[np.ndarray], features: np.ndarray, classes: np.ndarray, places: np.ndarray) -> None:
    """Adds a block's gradient of the negative logarithm to sums, which are shaped as the model's arrays."""
    rows = class_rows(model, features)
    g = shares(model.w1, rows, model.b1)
    g[np.arange(len(classes)), classes] -= 1
    _add_up(sums[0], rows, g)
    sums[2] += g.sum(0)
    at, nodes, outcomes = model.steps(classes, places)
    if len(at):
        rows = word_rows(model, features[:, at], nodes)
        g = shares(model.w2, rows, model.b2[nodes])
        g[np.arange(len(at)), outcomes] -= 1
        _add_up(sums[1], rows, g)
        _add_up(sums[3][None], nodes[None], g)


def log_shares(model: Model, features: np.ndarray, classes: np.ndarray, places: np.ndarray) -> np.ndarray:
    """log10 of what the softmaxes give to each token: its class, and its word or the rest of its class."""
    log = lambda p: np.log10(np.maximum(p.astype(np.float64), 1e-300))
    out = log(shares(model.w1, class_rows(model, features), model.b1)[np.arange(len(classes)), classes])
    at, nodes, outcomes = model.steps(classes, places)
    if len(at):
        p = shares(model.w2, word_rows(model, features[:, at], nodes), model.b2[nodes])[np.arange(len(at)), outcomes]
        out += np.bincount(at, log(p), len(out))
    return out


def count_words(docs: DataFrame) -> DataFrame:
    """(word, class, n) over all tokens of the documents, ends included."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()

        def out() -> pd.DataFrame:
            frame = pd.DataFrame({"word": list(held), "n": list(held.values())})
            held.clear()
            return frame

        for b in batches:
            for t in b["text"]:
                held.update(lowered(t).split())
                held[END] += 1
                if len(held) > HELD:
                    yield out()
        if held:
            yield out()

    part = docs.select(F.col("text").cast("string").alias("text")).mapInPandas(counted, "word binary, n long")
    last = F.expr("substring(concat(X'00', word), -2)")  # as in suffix_class
    of_word = F.when(F.col("word") == F.lit(END), 0).otherwise(F.crc32(last) % SUFFIX_CLASSES + 1 + CLASSES)
    return part.groupBy("word").agg(F.sum("n").alias("n")).select("word", of_word.cast("int").alias("class"), "n")


def least_count(counts: DataFrame, most: int) -> int:
    """A count that at most most words reach, from a histogram with steps of an eighth of a power of two."""
    steps = F.floor(F.log2("n") * 8).alias("step")
    held, least = 0, 2**62
    for r in counts.groupBy(steps).agg(F.count("*").alias("words"), F.min("n").alias("n")).orderBy(F.desc("step")).collect():  # some hundred rows
        held += r["words"]
        if held > most:
            break
        least = r["n"]
    return least


def train(docs: DataFrame, model: Model) -> None:
    """Takes the model's steps: in each round, one along the summed gradient of that round's documents."""
    spark = docs.sparkSession
    texts = docs.select(F.col("text").cast("string").alias("text"), F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.col("text")), F.lit(ROUNDS)).alias("round"))
    cores = spark.sparkContext.defaultParallelism
    squares = [np.zeros_like(a) for a in model.arrays()]
    for number in range(ROUNDS):
        shared = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            model = shared.value
            reader, sums, tokens = Reader(model), [np.zeros_like(a) for a in model.arrays()], 0
            for features, classes, places, _ in reader.blocks(t for b in batches for t in b["text"]):
                add_gradient(model, sums, features, classes, places)
                tokens += len(classes)
            if tokens:
                parts = np.array_split(np.concatenate([s.ravel() for s in sums]), PARTS)
                yield pd.DataFrame({"part": range(PARTS), "task": tokens % 64, "sums": [x.tobytes() for x in parts]})

        def added(k: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in pdf["sums"])
            return pd.DataFrame({"part": [k[0]], "task": [0], "sums": [total.astype(np.float32).tobytes()]})

        schema = "part int, task int, sums binary"
        # a task for each core hands in one gradient
        moves = texts.filter(F.col("round") == number).select("text").coalesce(cores).mapInPandas(learn, schema)
        moves = moves.groupBy("part", "task").applyInPandas(added, schema).groupBy("part").applyInPandas(added, schema)
        got = sorted((r["part"], bytes(r["sums"])) for r in stored(moves, "gradient").collect())  # the size of the model
        shared.unpersist()
        if not got:
            continue
        whole, at = np.frombuffer(b"".join(x for _, x in got), np.float32), 0
        for weights, square in zip(model.arrays(), squares, strict=True):
            g = whole[at : at + weights.size].reshape(weights.shape)
            at += weights.size
            square += g * g
            weights -= RATE * g / (np.sqrt(square) + PRIOR)


def fit(training: DataFrame, counts: DataFrame) -> tuple[Model, np.ndarray, dict[bytes, int]]:
    """The model; for each class the tokens and distinct words that count words inside it (none for frequent and learned words); and
    the counts of the frequent words and of the end."""
    top = counts.filter(F.col("word") != F.lit(END)).orderBy(F.desc("n"), "word").limit(CLASSES * WORDS_A_CLASS).select("word", "n").collect()
    words, n = [bytes(r["word"]) for r in top], [r["n"] for r in top]
    inside = np.zeros((ALL_CLASSES, 2))
    for r in counts.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():  # a row for each class
        inside[r["class"]] = r["n"], r["v"]
    tokens = int(inside[:, 0].sum())
    for i, (w, k) in enumerate(zip(words, n, strict=True)):  # frequent words leave the class of their ending
        inside[suffix_class(w)] -= k, 1
        inside[1 + i // WORDS_A_CLASS, 0] += k
    often = counts.filter((F.col("word") != F.lit(END)) & (F.col("n") >= LEARNT)).select("word", "n").collect()  # one for LEARNT tokens at most
    learned = sorted(((bytes(r["word"]), r["n"]) for r in often), key=lambda x: (-x[1], x[0]))[len(words) :]
    whole = inside[:, 0].copy()
    for w, k in learned:
        inside[suffix_class(w)] -= k, 1
    model = Model(words, n, whole, tokens, learned, inside.sum(1) + 1)
    train(training, model)
    frequent = dict(zip(words, n, strict=True)) | ({END: int(inside[0, 0])} if tokens else {})
    inside[: 1 + CLASSES] = 0
    return model, inside, frequent


def score(docs: DataFrame, training: DataFrame) -> DataFrame:
    """One row for each document row: _id, _dk, n_tokens, n_known, train_tokens, base_score, score."""
    counts = stored(count_words(training), "word-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    hot = {bytes(r["word"]): r["n"] for r in counts.filter(F.col("n") >= least_count(counts, HOT)).select("word", "n").collect()}  # at most HOT
    floor, learnt = math.log10(total + distinct + 1), LEARNT
    model, inside, frequent = fit(training, counts)
    shared = docs.sparkSession.sparkContext.broadcast((model, np.log10(inside.sum(1) + 1), hot | frequent, set(frequent)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model, inside, hot, frequent = shared.value
        reader = Reader(model)
        logs = {w: (n, math.log10(n + 1)) for w, n in hot.items()}
        for b in batches:
            got, at, part = np.zeros(len(b)), 0, 0.0
            for features, classes, places, sizes in reader.blocks(iter(b["text"])):
                logged = log_shares(model, features, classes, places) - np.where(places >= 0, 0, inside[classes])
                edges = np.cumsum([0] + [n for n, _ in sizes])
                for i, (_, last) in enumerate(sizes):
                    part += logged[edges[i] : edges[i + 1]].sum()
                    if last:
                        got[at], at, part = part, at + 1, 0.0
            out = []
            for t in b["text"]:
                words = lowered(t).split()
                base, known, inner, rare = 0.0, 0, 0.0, []
                for w, n in (*Counter(words).items(), (END, 1)):
                    if found := logs.get(w):
                        known += n
                        base += n * found[1]
                        if found[0] < learnt and w not in frequent:
                            inner += n * found[1]
                    else:
                        rare.append((w, n))
                out.append((len(words) + 1, known, base, inner, [w for w, _ in rare], [n for _, n in rare]))
            frame = pd.DataFrame(out, columns=["n_tokens", "hot_known", "hot_logs", "inner_logs", "words", "ns"])
            yield pd.concat([b[["_id", "_dk"]].reset_index(drop=True), frame.assign(model=got)], axis=1)

    schema = "_id long, _dk long, n_tokens long, hot_known long, hot_logs double, inner_logs double, words array<binary>, ns array<long>, model double"
    parts = stored(with_key(docs).mapInPandas(run, schema).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = parts.select("row", F.explode(F.arrays_zip("words", "ns")).alias("x")).select("row", F.col("x.words").alias("word"), F.col("x.ns").alias("k"))
    logs, inner = F.col("k") * F.log10(F.col("n") + 1), F.col("n") < LEARNT
    seen = rare.join(counts.select("word", "n"), "word").groupBy("row").agg(F.sum("k").alias("rare_known"), F.sum(logs).alias("rare_logs"), F.sum(F.when(inner, logs)).alias("rare_inner"))
    known = F.col("hot_known") + F.coalesce("rare_known", F.lit(0))
    rare_logs, rare_inner = (F.coalesce(c, F.lit(0.0)) for c in ("rare_logs", "rare_inner"))
    return parts.drop("words", "ns").join(seen, "row", "left").select(
        "_id", "_dk", "n_tokens", known.alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("hot_logs") + rare_logs - F.col("n_tokens") * F.lit(floor)).alias("base_score"), (F.col("model") + F.col("inner_logs") + rare_inner).alias("score"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, docs.filter(~held_out(7, 2)))
    held = F.coalesce(F.crc32(doc_id_text()) % 7 == 2, F.lit(False)).alias("held_out")
    return scored.select(doc_id(), held, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def doc_id_text():
    return doc_id().cast("string").cast("binary")


QUERIES = {"op8_lm_scoring": op8_lm_scoring}
