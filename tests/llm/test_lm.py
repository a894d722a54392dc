import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from microlake.llm import lm as M


def corpus(rng, n):
    a, b = [f"x{i}en" for i in range(40)], [f"y{i}os" for i in range(40)]
    return [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(rng.randint(0, 60)))) for i in range(n)]


def brute(rows):
    counts = Counter()
    words = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*words(t), M.END])
    n, v = sum(counts.values()), len(counts)
    return {(i, t): (len(words(t)) + 1, sum(counts[w] > 0 for w in [*words(t), M.END]), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(t), M.END])) for i, t in rows}


@pytest.mark.parametrize("hot", [100_000, 20, 0])
def test_base_against_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(M, "HOT", hot)
    rows = [*corpus(random.Random(1), 120), (500, None), (501, "È é Unseen-word"), (None, "null id"), (502, "x1en " * 9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    got = M.score(docs, docs.filter(~M.held_out(7, 2))).select(M.doc_id(), "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    by = {i: w for (i, _), w in want.items()}
    assert len(got) == len(rows)
    for r in got:
        w = by[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == w[:3]
        assert r["base_score"] == pytest.approx(w[3], rel=1e-9) and r["score"] < 0
    held = [r for r in got if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)  # the history tells the class


def plain_score(model, inside, counts, frequent, text):
    """log10 of a text, token by token, with Python's own numbers."""
    hasher, out = M.WordHashes(M.NOT_SPACE), 0.0
    words = M.lowered(text).split()
    hashes = [int(hasher.of(w)[0]) for w in words]
    mask, step, top = 2**64 - 1, int(M._CLASS_TURN), 64 - model.bits
    ranked = sorted((w for w in frequent if w != M.END), key=lambda w: (-frequent[w], w))
    for i, w in enumerate([*words, M.END]):
        one, two = ([0, 0, *hashes][i + 1 - j] for j in (0, 1))
        features = [one, (two * 3 + 1) & mask, int(M.mixed(np.array([(one * 5 + two) & mask], np.uint64))[0])]
        rank = ranked.index(w) if w in ranked else None
        c = M.suffix_class(w) if rank is None else 1 + rank // M.WORDS_A_CLASS
        z = [float(model.b1[k]) + sum(float(model.w1[f][(x * int(M._TURNS[f]) & mask) >> top][k]) for f, x in enumerate(features)) for k in range(M.ALL_CLASSES)]
        out += (z[c] - math.log(sum(map(math.exp, z)))) / math.log(10)
        if rank is not None:
            rows = [(((x + c * step) & mask) * int(M._TURNS[f]) & mask) >> top for f, x in enumerate(features)]
            z = [float(model.b2[c - 1][k]) + sum(float(model.w2[f][r][k]) for f, r in enumerate(rows)) for k in range(M.WORDS_A_CLASS)]
            out += (z[rank % M.WORDS_A_CLASS] - math.log(sum(map(math.exp, z)))) / math.log(10)
        elif w != M.END:
            out += math.log10((counts[w] + 1) / (inside[c].sum() + 1))
    return out


def test_score_against_a_plain_recomputation_and_base(spark, monkeypatch):
    """The score is what the weights say; on held-out texts the history is worth a tenth of a decimal digit a token at least; how rows are dealt out changes nothing."""
    monkeypatch.setattr(M, "WORDS_A_CLASS", 4)
    monkeypatch.setattr(M, "TOKENS_A_ROW", 4)
    monkeypatch.setattr(M, "PRIOR", 3.0)
    rng, follow = random.Random(3), {}
    vocabulary = [f"w{i}{x}" for i in range(60) for x in ("en", "os", "er")]
    texts = []
    for _ in range(700):
        w = [rng.choice(vocabulary)]
        while len(w) < 30:
            w.append(rng.choice(follow.setdefault(w[-1], rng.sample(vocabulary[:40], 3) + rng.sample(vocabulary, 2))))
        texts.append(" ".join(w))
    texts += ["", None, "w1en Unseen-Word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    training = docs.filter(~M.held_out(7, 2))
    counts = M.count_words(training)
    model, inside, frequent = M.fit(training, counts)
    counts = Counter({bytes(r["word"]): r["n"] for r in counts.collect()})
    scored = {r["doc_id"]: r for r in M.score(docs.repartition(5), training.repartition(3)).select(M.doc_id(), "n_tokens", "base_score", "score").collect()}
    for i in (*range(0, 700, 70), 700, 701, 702):
        assert scored[i]["score"] == pytest.approx(plain_score(model, inside, counts, frequent, texts[i]), rel=1e-4, abs=1e-3), i
    held = [r for i, r in scored.items() if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(r["score"] - r["base_score"] for r in held) > 0.1 * sum(r["n_tokens"] for r in held)


def test_shares_of_a_history_sum_to_one():
    some = M.CLASSES * M.WORDS_A_CLASS - 5
    model = M.Model([f"w{i}".encode() for i in range(some)], list(range(some, 0, -1)), np.ones(M.ALL_CLASSES), 10**6)
    rng = np.random.default_rng(1)
    for a in model.arrays()[:2]:
        a += rng.normal(0, 1, a.shape).astype(np.float32)
    features = rng.integers(0, 2**63, (M.FEATURES, 1)).astype(np.uint64)
    total = 0.0
    for c in range(M.ALL_CLASSES):
        for place in range(M.WORDS_A_CLASS) if 1 <= c <= M.CLASSES else [-1]:
            total += 10 ** float(M.log_shares(model, features, np.array([c]), np.array([place]))[0])
    assert total == pytest.approx(1, abs=1e-5)


def test_gradient_is_that_of_the_logarithm():
    model = M.Model([f"x{i}en".encode() for i in range(40)], list(range(40, 0, -1)), np.ones(M.ALL_CLASSES), 10**6)
    rng = random.Random(2)
    features, classes, places, _ = next(M.Reader(model).blocks(t for _, t in corpus(rng, 40)))
    loss = lambda: -float(M.log_shares(model, features, classes, places).sum()) * math.log(10)
    sums = [np.zeros_like(a) for a in model.arrays()]
    M.add_gradient(model, sums, features, classes, places)
    before = loss()
    for weights, g in zip(model.arrays(), sums, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        weights[at] += 0.01
        assert (loss() - before) / 0.01 == pytest.approx(float(g[at]), rel=0.05)
        weights[at] -= 0.01
    for weights, g in zip(model.arrays(), sums, strict=True):
        weights -= 0.01 * g
    assert loss() < before


def test_reader_and_long_texts(monkeypatch):
    model = M.Model([b"ab", b"x"], [3, 2], np.ones(M.ALL_CLASSES), 100)
    reader = M.Reader(model)
    text = "Ab é x\x0by  Z&&& " * 50
    h, classes, places = reader.tokens(M.lowered(text))
    words = M.lowered(text).split()
    assert len(h) == len(words) + 1 and classes[-1] == 0 and len(set(h[:-1].tolist())) == len(set(words))
    assert places[:-1].tolist() == [{b"ab": 0, b"x": 1}.get(w, -1) for w in words]
    assert classes[:-1].tolist() == [1 if w in (b"ab", b"x") else M.suffix_class(w) for w in words]
    whole = [np.concatenate(x, -1) for x in list(zip(*((f, c) for f, c, _, _ in reader.blocks([text, None, "a b"])), strict=True))]
    small = list(reader.blocks([text, None, "a b"], 7))
    assert (np.concatenate([f for f, *_ in small], 1) == whole[0]).all() and (np.concatenate([c for _, c, *_ in small]) == whole[1]).all()
    assert sum(last for *_, sizes in small for _, last in sizes) == 3 and sum(n for *_, sizes in small for n, _ in sizes) == len(h) + 1 + 3


def test_odd_and_empty(odd, empty):
    assert M.score(empty, empty).count() == 0
    got = M.score(odd, odd.limit(0)).collect()
    assert len(got) == odd.count() and all(r["base_score"] == 0 and r["n_known"] == 0 for r in got)


def test_many_texts_are_read_at_once_as_one_by_one(spark):
    """Texts of a block are hashed together; words, histories and classes are those of each text by itself."""
    model = M.Model([b"ab", b"x"], [3, 2], np.ones(M.ALL_CLASSES), 100)
    reader, texts = M.Reader(model), ["Ab x y", None, "", " \t", "é", "x " * 40 + "ab", "last\n", "q"]
    h, classes, places, stops = reader.read([M.lowered(t) for t in texts])
    alone = [reader.tokens(M.lowered(t)) for t in texts]
    for got, i in ((h, 0), (classes, 1), (places, 2)):
        assert got.tolist() == np.concatenate([a[i] for a in alone]).tolist()
    assert stops.tolist() == np.cumsum([len(a[0]) for a in alone]).tolist()
    together, each = list(reader.blocks(iter(texts), 1000)), [b for t in texts for b in reader.blocks(iter([t]), 1000)]
    assert len(together) == 1 and (together[0][0] == np.concatenate([b[0] for b in each], 1)).all()
    counted = M.count_words(spark.createDataFrame([(t,) for t in texts], "text string")).collect()
    assert {bytes(r["word"]): r["class"] for r in counted} == {w: M.suffix_class(w) for t in texts for w in [*M.lowered(t).split(), M.END]}


def test_rows_are_added_up_whole():
    rng = np.random.default_rng(4)
    rows, g = rng.integers(0, 9, (3, 500)).astype(np.uint16), rng.normal(0, 1, (500, 16)).astype(np.float32)
    got, want = np.zeros((3, 9, 16), np.float32), np.zeros((3, 9, 16))
    M._add_up(got, rows, g)
    for f in range(3):
        np.add.at(want[f], rows[f], g.astype(float))
    assert np.abs(got - want).max() < 1e-4


def test_shares_of_learned_words_sum_to_one(monkeypatch):
    """Trees of several depths: every word of a class has one way, and all of them, the rest of each class too, share the whole of a history."""
    monkeypatch.setattr(M, "WORDS_A_CLASS", 4)
    for n in (0, 1, 2, 3, 4, 11, 12, 40, 200):
        nodes, outcomes, used = M.tree_paths(n, 4)
        ways = {tuple(x[x[:, 0] >= 0].ravel().tolist()) for x in np.stack([nodes, outcomes], 2)}
        assert len(ways) == n + 1 and set(nodes.ravel().tolist()) - {-1} == set(range(used)) and outcomes.max() < 4
    learned = [(f"r{i}{end}".encode(), 500 - i) for i in range(90) for end in ("en", "os")]
    words = [f"w{i}".encode() for i in range(M.CLASSES * 4)]
    model = M.Model(words, list(range(700, 700 - len(words), -1)), np.ones(M.ALL_CLASSES), 10**6, learned, np.full(M.ALL_CLASSES, 50))
    rng = np.random.default_rng(1)
    for a in model.arrays():
        a += rng.normal(0, 1, a.shape).astype(np.float32)
    _, classes, places = M.Reader(model).tokens(b" ".join([*words, *(w for w, _ in learned)]))
    assert len({*zip(classes.tolist(), places.tolist(), strict=True)}) == len(classes) and (places[:-1] >= 0).all()
    rest = np.arange(M.CLASSES + 1, M.ALL_CLASSES)
    classes, places = np.append(classes, rest).astype(np.int16), np.append(places, np.full(len(rest), -1))
    features = np.repeat(rng.integers(0, 2**63, (M.FEATURES, 1)).astype(np.uint64), len(classes), 1)
    assert (10 ** M.log_shares(model, features, classes, places)).sum() == pytest.approx(1, abs=1e-4)
    loss = lambda: -float(M.log_shares(model, features, classes, places).sum()) * math.log(10)
    sums = [np.zeros_like(a) for a in model.arrays()]
    M.add_gradient(model, sums, features, classes, places)
    before, line = loss(), int(model.nodes[0, 1])
    model.b2[line, 1] += 0.01
    assert (loss() - before) / 0.01 == pytest.approx(float(sums[3][line, 1]), rel=0.05)


@pytest.mark.parametrize("hot", [100_000, 50])
def test_history_tells_words_beyond_the_most_frequent(spark, monkeypatch, hot):
    """Words of suffix classes with LEARNT tokens have a factor of the history, whether their counts are sent or joined."""
    for name, value in (("WORDS_A_CLASS", 4), ("TOKENS_A_ROW", 4), ("PRIOR", 3.0), ("HOT", hot)):
        monkeypatch.setattr(M, name, value)
    rng, frequent = random.Random(5), [f"f{i}" for i in range(40)]
    rare = [f"r{i}{x}" for i in range(30) for x in ("en", "os")]
    after = {w: rng.sample(rare, 2) for w in frequent}
    texts = [" ".join(x for _ in range(20) for w in [rng.choice(frequent)] for x in (w, rng.choice(after[w]))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    score = {}
    for learnt in (10**9, 60):
        monkeypatch.setattr(M, "LEARNT", learnt)
        got = M.score(docs, docs.filter(~M.held_out(7, 2))).select(M.doc_id(), "n_tokens", "score").collect()
        held = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2]
        score[learnt] = sum(r["score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert score[60] > score[10**9] + 0.1


def test_rows_grow_with_the_corpus_without_a_bound():
    sizes = [M.bits_for(n) for n in (0, 10**6, 6 * 10**7, 10**9, 10**10, 10**11, 10**12)]
    assert sizes == sorted(sizes) and sizes[0] == M.LEAST_BITS and sizes[2] == 14 < sizes[3] < sizes[4] < sizes[5] < sizes[6]
