"""Toxicity by a weighted finite-state pattern grammar.

The words of a text become symbols: insult, mild insult, threat, target, negation, report, quotation mark, clause end, other. Three
transducers are composed into one machine: negation rewrites insults and threats in its scope, reported speech those that are
only told of, and the target transducer notes whether what is left is aimed at somebody. The machine runs over each clause that holds
an insult or a threat, and what it emits are the kinds of matches; a text's score is a logistic function of how many different ones of
each kind its clauses have.

Fit: the lexicon of insults is a set of word stems, learned from labelled texts by where they stand: for the stems of each word,
the different surroundings that they have in texts of label 1 and of label 0 are counted, so that copies of a text count
once. A stem is taken if label 1 is so frequent among its texts that chance does not explain it; it is an insult if nearly all of
them have that label, else a mild one. Insults that are listed by hand are mild ones as long as the labels don't bear them out. The weights of the kinds are those of most posterior
probability, from prior weights that hold where the labels tell nothing. At most SAMPLE labelled documents are learned from, in hash
order of their ids; the score of a text depends on the text alone.

Labels are used for documents whose crc32 of the id is not 0 modulo 5.

Defined cases: null and empty texts, and those without any match, have the same score, below 0.5; labels other than 0 and 1 and
null ids of labels are ignored, of several labels of an id the greatest counts, and of several texts the one of the least hash; without labels the prior weights hold; rows that
repeat get the same score; an empty table gives an empty result. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, own_names, stored, table

#: Labelled documents that are learned from at most.
SAMPLE = 20_000
THRESHOLD = 0.5
#: A stem has so many letters at least (or is a whole word) and stands in so many texts of label 1. Of the texts that have it, this share
#: or more has label 1: for insults, and for mild ones.
LEAST_LETTERS, LEAST_TEXTS, LEAST_SHARE, MILD_SHARE = 3, 4, 0.98, 0.7
#: Stems that may pass by chance, of all that are tried, and stems that are kept at most, the most significant ones.
BY_CHANCE, LEXICON = 0.05, 2000
LONGEST = 12
#: Words that are sent on together while stems are learned.
ROWS_AT_ONCE = 1 << 15
#: Words over which a negation reaches, and that may stand between a match and its target.
SCOPE, NEAR = 3, 4

INSULT, MILD, THREAT, TARGET, NOT, REPORT, QUOTE, OTHER = "imvtnrqo"
END = "."
# Word lists of this grammar.
MILD_WORDS = "idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash garbage clown disgusting fool fools imbecile cretin jerk vermin filth filthy dimwit halfwit coward creep bastard scumbag dumbass asshole bitch retard".split()
THREAT_WORDS = "kill murder hurt hang shoot stab beat destroy crush burn slaughter strangle smash".split()
TARGET_WORDS = "you your yours yourself u ur he she him her his hers they them their those these people everyone tu vous toi du dich dir ihr euch sie ihn usted ustedes ti él ella ellos".split()
NOT_WORDS = "not no never neither nor isn't aren't wasn't don't doesn't didn't won't wouldn't can't cannot without pas jamais nicht kein keine nie nunca ni".split()
REPORT_WORDS = "said says say saying told tells claimed claims called calls wrote writes reported reports quoted alleged according dit disait sagte sagt dijo dice".split()
_WORDS = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:\n]|[\"“”«»]")
_LETTERS = re.compile(r"[^\W\d_]+")
_QUOTES, _ENDS = "\"“”«»", ".!?;:\n"

Arcs = dict[tuple[object, str], tuple[object, str]]


@dataclass(frozen=True)
class Transducer:
    """A deterministic transducer of one symbol for one: arcs from (state, symbol) to (state, symbol). Missing arcs keep state and symbol."""

    start: object
    arcs: Arcs

    def step(self, state: object, symbol: str) -> tuple[object, str]:
        return self.arcs.get((state, symbol), (state, symbol))


def compose(first: Transducer, second: Transducer, symbols: str) -> Transducer:
    """What first puts out is what second takes in; only pairs of states that can be reached are built."""
    start = (first.start, second.start)
    arcs: Arcs = {}
    todo, seen = [start], {start}
    while todo:
        a, b = state = todo.pop()
        for x in symbols:
            to_a, y = first.step(a, x)
            to_b, z = second.step(b, y)
            arcs[state, x] = ((to_a, to_b), z)
            if (to_a, to_b) not in seen:
                seen.add((to_a, to_b))
                todo.append((to_a, to_b))
    return Transducer(start, arcs)


def negation() -> Transducer:
    """Insults and threats within SCOPE words behind a negation become J, K and U."""
    arcs: Arcs = {}
    for left in range(SCOPE + 1):
        after = max(0, left - 1)
        for x, y in ((INSULT, "J"), (MILD, "K"), (THREAT, "U")):
            arcs[left, x] = (after, y if left else x)
        for x in (TARGET, REPORT, QUOTE, OTHER):
            arcs[left, x] = (after, x)
        arcs[left, NOT] = (SCOPE, OTHER)
    return Transducer(0, arcs)


def reported_speech() -> Transducer:
    """Insults and threats behind a reporting verb, to the clause's end or the closing quotation mark, become R and V."""
    arcs: Arcs = {("plain", REPORT): ("told", OTHER), ("told", QUOTE): ("quoted", OTHER), ("quoted", QUOTE): ("plain", OTHER), ("plain", QUOTE): ("plain", OTHER)}
    for state in ("told", "quoted"):
        arcs |= {(state, x): (state, y) for x, y in ((INSULT, "R"), (MILD, "R"), (THREAT, "V"), (REPORT, OTHER))}
    return Transducer("plain", arcs)


def target() -> Transducer:
    """Insults and threats with a target within NEAR words before them become A, B and C; a target within NEAR words behind one
    that had none yet gives the same, at the target's place, as a, b and c."""
    arcs: Arcs = {}
    aimed = {INSULT: "A", MILD: "B", THREAT: "C"}
    states = [("", 0), *(("t", n) for n in range(1, NEAR + 1)), *((x, n) for x in aimed for n in range(1, NEAR + 1))]
    for kind, n in states:
        after = (kind, n - 1) if n > 1 else ("", 0)
        for x in (*"JKURV", REPORT, QUOTE, OTHER, NOT):
            arcs[(kind, n), x] = (after, x)
        for x, y in aimed.items():
            arcs[(kind, n), x] = (after, y) if kind == "t" else ((x, NEAR), x)
        arcs[(kind, n), TARGET] = (("t", NEAR), aimed[kind].lower() if kind in aimed else OTHER)
    return Transducer(("", 0), arcs)


SYMBOLS = INSULT + MILD + THREAT + TARGET + NOT + REPORT + QUOTE + OTHER
#: What the machine emits, with prior weights: insults as such, aimed, negated; the mild ones likewise; threats; told ones of each.
KINDS = {"i": 1.5, "A": 3.0, "a": 1.5, "J": 0.0, "m": 0.3, "B": 3.0, "b": 2.7, "K": -0.3, "v": 0.1, "C": 2.5, "c": 2.4, "U": -0.5, "R": 0.1, "V": 0.1}
BIAS = -2.0
#: A kind's weight is for the first different match; that there are so many adds these shares of it. Besides, insults of whatever
#: kind that are not negated or told are counted together.
FURTHER = {1: 1.0, 2: 0.5, 3: 0.25, 4: 0.25, 6: 0.25}
TOGETHER = "iAmB"
PRIOR = tuple(w * share for w in (*KINDS.values(), 0.3) for share in FURTHER.values())
#: Variance of the weights about the prior.
LOOSE = 9.0


class Machine:
    """The composed grammar as a table of states."""

    def __init__(self):
        whole = compose(compose(negation(), reported_speech(), SYMBOLS), target(), SYMBOLS)
        number: dict[object, int] = {whole.start: 0}
        for to, _ in whole.arcs.values():
            number.setdefault(to, len(number))
        self.table: list[dict[str, tuple[int, str]]] = [{} for _ in number]
        for (state, x), (to, y) in whole.arcs.items():
            self.table[number[state]][x] = (number[to], y)

    def matches(self, clause: str) -> str:
        """What the clause, as symbols, emits, a character for each symbol."""
        state, out = 0, []
        for x in clause:
            state, y = self.table[state][x]
            out.append(y if y in KINDS else OTHER)
        return "".join(out)


class Lexicon(dict):
    """Word in lower case: its symbol. Stems are looked up as words come in and remembered; a stem that ends in a space is a whole word."""

    REMEMBERED = 1 << 17

    def __init__(self, stems: tuple[str, ...], mild: tuple[str, ...] = ()):
        super().__init__()
        self.stems, self.mild, self.fixed = frozenset(stems), frozenset(mild), {}
        for some, symbol in ((MILD_WORDS, MILD), (THREAT_WORDS, THREAT), (REPORT_WORDS, REPORT), (TARGET_WORDS, TARGET), (NOT_WORDS, NOT)):
            self.fixed |= dict.fromkeys(some, symbol)
        self.fixed |= dict.fromkeys(_QUOTES, QUOTE) | dict.fromkeys(_ENDS, END)

    def __missing__(self, word: str) -> str:
        plain = word.replace("’", "'")
        parts = {plain + " ", *(plain[:n] for n in range(LEAST_LETTERS, min(len(plain), LONGEST) + 1))}
        symbol = INSULT if parts & self.stems else self.fixed.get(plain, MILD if parts & self.mild else OTHER)
        if len(self) >= self.REMEMBERED:
            self.clear()
        self[word] = symbol
        return symbol


_CLAUSE = re.compile(f"[^{re.escape(END)}]*[{INSULT}{MILD}{THREAT}][^{re.escape(END)}]*")


@dataclass(frozen=True)
class Model:
    stems: tuple[str, ...] = ()
    mild: tuple[str, ...] = ()
    weights: tuple[float, ...] = PRIOR
    bias: float = BIAS


class Scorer:
    def __init__(self, model: Model):
        self.model, self.machine, self.lexicon = model, Machine(), Lexicon(model.stems, model.mild)

    def counts(self, text: str | None) -> list[int]:
        """Different matches of each kind in the text's clauses, and of TOGETHER; counts beyond the last of FURTHER are that one."""
        words = _WORDS.findall(text.lower()) if text else []
        found: dict[str, set[str]] = {k: set() for k in KINDS}
        symbols = "".join(map(self.lexicon.__getitem__, words))
        for m in _CLAUSE.finditer(symbols):
            for kind, word in zip(self.machine.matches(m.group()), words[m.start() : m.end()], strict=True):
                if kind in KINDS:
                    found[kind].add(word)
        most = max(FURTHER)
        return [min(len(x), most) for x in (*found.values(), set().union(*(found[k] for k in TOGETHER)))]

    def value(self, counts: list[int]) -> float:
        x = self.model.bias + float(np.dot(steps(counts), self.model.weights))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, x))))

    def clauses(self, text: str | None) -> list[tuple[int, int, float, str]]:
        """(start, end, weight, kinds) of the clauses with a match, in code points, end exclusive."""
        if not text:
            return []
        places = [m.span() for m in _WORDS.finditer(text)]
        symbols = "".join(self.lexicon[text[a:b].lower()] for a, b in places)
        out, weight = [], dict(zip(KINDS, self.model.weights[:: len(FURTHER)], strict=False))
        for m in _CLAUSE.finditer(symbols):
            kinds = "".join(sorted(set(self.machine.matches(m.group())) - {OTHER}))
            if kinds:
                out.append((places[m.start()][0], places[m.end() - 1][1], sum(weight[k] for k in kinds), kinds))
        return out


def steps(counts: list[int]) -> list[int]:
    """For each count, whether it reaches each number of FURTHER."""
    return [int(n >= k) for n in counts for k in FURTHER]


def _words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(word, around, doc, label): the words of a text, with a hash of the words around them where the label is 1."""
    for b in batches:
        found: dict[str, list] = {"word": [], "around": [], "doc": [], "label": []}
        for doc, text, label in zip(b["doc_id"], b["text"], b["label"], strict=True):
            words = _LETTERS.findall((text or "").lower())
            if label:
                near = zip(["", *words], words, [*words[1:], ""], strict=False)  # no words: none
                rows = {(x[1], zlib.crc32("\0".join(x).encode("utf-8", "surrogatepass"))) for x in near}
            else:
                rows = {(w, 0) for w in words}
            found["word"] += [w for w, _ in rows]
            found["around"] += [a for _, a in rows]
            found["doc"] += [doc] * len(rows)
            found["label"] += [label] * len(rows)
            if len(found["word"]) >= ROWS_AT_ONCE:
                yield pd.DataFrame(found)
                found = {k: [] for k in found}
        if found["word"]:  # a frame without rows has no column of text
            yield pd.DataFrame(found)


def learn_stems(labelled: DataFrame) -> tuple[tuple[str, ...], tuple[str, ...]]:
    """The stems that tell label 1, as insults and as mild ones. labelled: (doc_id, text, label), a bounded sample. Texts of label 0 count once for each of their
    words that has the stem."""
    totals = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not totals.get(1):
        return (), ()
    base = min(0.99, totals[1] / sum(totals.values()))
    seen = stored(labelled.repartition("doc_id").mapInPandas(_words, "word string, around long, doc long, label int"), "label-words")
    lengths = F.sequence(F.lit(LEAST_LETTERS), F.least(F.length("word"), F.lit(LONGEST)))
    parts = F.when(F.length("word") >= LEAST_LETTERS, F.transform(lengths, lambda n: F.substring(F.col("word"), F.lit(1), n)))
    stem = F.explode(F.array_append(F.coalesce(parts, F.array().cast("array<string>")), F.concat("word", F.lit(" ")))).alias("stem")
    once = seen.filter("label = 1").groupBy("word", "around").agg(F.min("doc").alias("doc"))  # copies share what stands around
    ones = once.select("word", "doc").distinct().select("doc", stem).distinct().groupBy("stem").agg(F.count("*").alias("n1")).filter(F.col("n1") >= LEAST_TEXTS)
    noughts = seen.filter("label = 0").groupBy("word").agg(F.count("*").alias("n")).select("n", stem).groupBy("stem").agg(F.sum("n").alias("n0"))
    texts = stored(ones.join(noughts, "stem", "left").fillna(0, ["n0"]), "stems")
    tried, n = max(1, texts.count()), F.col("n1") + F.col("n0")
    unlike = lambda k, share: F.when(F.col(k) > 0, F.col(k) * F.log(F.col(k) / n / share)).otherwise(0.0)
    told = texts.filter(F.col("n1") >= max(MILD_SHARE, base) * n).withColumn("surprise", unlike("n1", base) + unlike("n0", 1 - base))
    told = told.filter(F.col("surprise") >= math.log(tried / BY_CHANCE)).orderBy(F.desc("surprise"), "stem").limit(LEXICON).collect()
    plain = shortest({r["stem"]: r["n1"] for r in told if r["n1"] >= LEAST_SHARE * (r["n1"] + r["n0"])})
    return tuple(sorted(plain)), tuple(sorted(shortest({r["stem"]: r["n1"] for r in told}) - plain))


def shortest(found: dict[str, int]) -> set[str]:
    """Of stems of one another the shortest, but lengthened as long as one longer stem has all the texts of it."""
    longer: dict[str, list[str]] = {}
    for s in found:
        longer.setdefault(s[:-1], []).append(s)
    out = set()
    for s in found:
        if any(s[:n] in found for n in range(LEAST_LETTERS, len(s))):
            continue
        while alike := [x for x in longer.get(s, []) if found[x] == found[s]]:
            s = alike[0]
        out.add(s)
    return out


def fit_weights(rows: list[tuple[list[int], int, int]]) -> tuple[tuple[float, ...], float]:
    """Weights and bias of most posterior probability, by Newton's steps. rows: (counts, label, times)."""
    if not rows:
        return PRIOR, BIAS
    prior, x = np.array([*PRIOR, BIAS]), np.array([[*steps(c), 1.0] for c, _, _ in rows])
    y, times = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows], float)
    w = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        slope = x.T @ (times * (p - y)) + (w - prior) / LOOSE
        curve = (x * (times * p * (1 - p))[:, None]).T @ x + np.eye(len(w)) / LOOSE
        move = np.linalg.solve(curve, slope)
        w = w - move * min(1.0, 2.0 / max(1e-12, np.abs(move).max()))
        if np.abs(move).max() < 1e-9:
            break
    return tuple(float(v) for v in w[:-1]), float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """labels: (doc_id, toxic). Learns from at most sample labelled documents that are not held out."""
    usable = labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).filter(~held_out(5, 0))
    chosen = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(stored(chosen, "labelled")), "doc_id")
    one = texts.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label"))
    labelled = stored(one, "labelled-texts")
    stems, mild = learn_stems(labelled)
    start = Model(stems, mild)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(start)
        for b in batches:
            yield pd.DataFrame({"counts": [scorer.counts(t) for t in b["text"]], "label": b["label"]})

    rows = labelled.repartition("doc_id").mapInPandas(counted, "counts array<int>, label int").groupBy("counts", "label").agg(F.count("*").alias("n"))
    found = sorted((list(r["counts"]), r["label"], r["n"]) for r in rows.collect())  # sample rows at most
    return Model(stems, mild, *fit_weights(found))


def toxicity(docs: DataFrame, model: Model) -> Column:
    """The score of the column text of docs."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([scorer.value(scorer.counts(t)) for t in texts], dtype="float64")

    return scored(F.col("text").cast("string"))


def matched_clauses(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with all their columns and toxic_clauses: start, end, weight and kinds of each clause with a match."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("array<struct<start:int,end:int,weight:double,kinds:string>>")
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(shared.value)
        for texts in batches:
            yield pd.Series([[dict(zip(("start", "end", "weight", "kinds"), c, strict=True)) for c in scorer.clauses(t)] for t in texts])

    return docs.select("*", found(F.col("text").cast("string")).alias(own_names(docs, "toxic_clauses")["toxic_clauses"]))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = docs.select("doc_id", held_out(5, 0).alias("held_out"), toxicity(docs, fit(docs, table(spark, sf_dir, "labels"))).alias("score"))
    return scored.select("*", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op13_toxicity": op13_toxicity}
