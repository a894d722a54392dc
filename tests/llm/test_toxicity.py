import random

import pytest
from pyspark.sql import functions as F

from microlake.llm import toxicity as T

LABELS = "doc_id long, quality int, toxic int"


def kinds(text, stems=("idiot ",)):
    scorer = T.Scorer(T.Model(tuple(stems)))
    return [c[3] for c in scorer.clauses(text)]


def test_composed_machine_equals_its_parts():
    """Over all short words of the alphabet the composed table gives what the transducers give one after another."""
    machine, parts = T.Machine(), (T.negation(), T.reported_speech(), T.target())
    rng = random.Random(1)
    for _ in range(2000):
        word = "".join(rng.choice(T.SYMBOLS) for _ in range(rng.randint(1, 9)))
        states, out = [p.start for p in parts], []
        for x in word:
            for i, p in enumerate(parts):
                states[i], x = p.step(states[i], x)
            out.append(x if x in T.KINDS else T.OTHER)
        assert machine.matches(word) == "".join(out)


def test_grammar():
    assert kinds("What a lovely day. You are an idiot!") == ["A"]
    assert kinds("idiot") == ["i"] and kinds("An IDIOT, that is you.") == ["ai"]
    assert kinds("He is not an idiot") == ["J"] and kinds("They said that he is an idiot") == ["R"]
    assert kinds("I will kill you") == ["cv"] and kinds("You I will kill") == ["C"] and kinds("I never kill") == ["U"] and kinds("he said he would kill you") == ["V"]
    assert kinds("Take the trash out") == ["m"] and kinds("you trash") == ["B"]
    assert kinds("no. idiot") == ["i"]  # a negation ends with its clause
    assert kinds("idiotic") == [] and kinds("idiotic", ["idiot"]) == ["i"]
    assert kinds("") == [] and kinds(None) == []
    scorer = T.Scorer(T.Model())
    value = lambda t: scorer.value(scorer.counts(t))
    assert value("You moron.") > 0.5 > value("He called you a moron.") and value("You are no moron.") < 0.5
    assert value("") == value(None) == value("good morning") < 0.5
    text = "Fine day: you moron! Bye"
    (a, b, _, _), = scorer.clauses(text)
    assert text[a:b] == "you moron"


def test_long_text_is_read_to_its_end():
    scorer = T.Scorer(T.Model(("zzap",)))
    assert scorer.counts("word " * 500_000 + "zzapper")[0] == 1


def made(n, seed=2):
    """Texts of two languages, a tenth with words of three made-up stems; a large group of copies is toxic too."""
    rng = random.Random(seed)
    syllables = ["ka", "lo", "mi", "ru", "te", "so", "na", "vi"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        w = [word() for _ in range(rng.randint(20, 60))]
        bad = i % 10 == 3
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["zilch", "gropp", "brax"]) + rng.choice(syllables))
        docs.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    copied = " ".join(["qux" + word() for _ in range(40)] + ["zilchka"])
    for i in range(n, n + n // 20):
        docs.append((i, copied))
        labels.append((i, 1, 1))
    return docs, labels


def test_stems_are_learned_and_held_out_texts_told(spark):
    docs, labels = made(1500)
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    model = T.fit(d, l)
    assert set(model.stems) >= {"zilch", "gropp", "brax"} and not [s for s in model.stems if s.startswith("qux")]
    fresh, truth = made(400, 9)
    rows = spark.createDataFrame(fresh, "doc_id long, text string")
    got = {r["doc_id"]: r["s"] >= T.THRESHOLD for r in rows.select("doc_id", T.toxicity(rows, model).alias("s")).collect()}
    assert got == {i: bool(t) for i, _, t in truth}


def test_held_out_labels_are_never_used(spark):
    docs, labels = made(600)
    d, l = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, LABELS)
    other = l.withColumn("toxic", F.when(T.held_out(5, 0), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.fit(d, l) == T.fit(d, other)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.1"])
def test_held_out_accuracy(spark, sf):
    rows = T.op13_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out")
    hit = {(r["toxic"], r["predicted"]): r["count"] for r in rows.groupBy("toxic", "predicted").count().collect()}
    assert hit.get((0, 1), 0) <= 0.01 * (hit[0, 0] + hit.get((0, 1), 0))
    assert hit[1, 1] >= 0.9 * (hit[1, 1] + hit.get((1, 0), 0)), hit


def test_odd_and_empty(spark, odd, empty):
    labels = spark.createDataFrame([(3, 1, 1), (4, 0, 0), (None, 1, 1), (6, 1, 7), (6, 1, None)], LABELS)
    model = T.fit(odd, labels)
    got = odd.select("doc_id", T.toxicity(odd, model).alias("s")).collect()
    assert len(got) == odd.count() and all(0 <= r["s"] < 0.5 for r in got)
    assert empty.select(T.toxicity(empty, model)).count() == 0
    found = T.matched_clauses(odd, model)
    assert found.columns == [*odd.columns, "toxic_clauses"] and found.filter(F.size("toxic_clauses") > 0).count() == 0
    unlabelled = T.fit(odd, labels.limit(0))
    assert unlabelled.stems == () and unlabelled.weights == T.PRIOR


def test_texts_without_words_are_no_frame(spark):
    """A batch without words, or one whose last text filled a run of rows, leaves nothing to send on."""
    rows = spark.createDataFrame([(1, "", 1), (2, "12 :: 3", 0)], "doc_id long, text string, label int").coalesce(1)
    assert rows.mapInPandas(T._words, "word string, around long, doc long, label int").collect() == []
    assert T.learn_stems(rows) == ((), ())
