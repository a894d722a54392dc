import random

from microlake.llm import shingles as S


def brute_set(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(texts):
    sets, root = [brute_set(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if root[i] != root[j] and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return root


def _texts(rng):
    out = ["", None, "one two three", "One two  three", "one two four"]
    for _ in range(8):
        words = [f"w{rng.randrange(9999)}" for _ in range(rng.choice([20, 60, 150, 1500]))]
        for _ in range(12):
            now = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 35))):
                now[rng.randrange(len(now))] = f"w{rng.randrange(9999)}"
            out.append(" ".join(now))
            if rng.random() < 0.5:
                words = now  # chains, whose ends are apart
    return out


def similar(a, b):
    return a == b or 5 * len(a & b) >= 4 * len(a | b)


def test_components_against_brute_force(docs_of):
    """No text is joined to one that no chain of similar texts leads to; nearly all similar pairs are joined."""
    texts = _texts(random.Random(3))
    want, sets = brute_components(texts), [brute_set(t) for t in texts]
    assert 10 < len(set(want)) < len(texts) - 20
    got = {r["_id"]: r["component"] for r in S.near_duplicates(docs_of(texts)).collect()}
    assert all(want[i] == want[c] and c <= i and got[c] == c for i, c in got.items())
    pairs = [(i, j) for i in range(len(texts)) for j in range(i) if similar(sets[i], sets[j])]
    assert sum(got[i] == got[j] for i, j in pairs) >= 0.95 * len(pairs)


def test_recall_of_pairs(docs_of):
    """Pairs of similarity 0.8 to 0.95, each apart from all others."""
    rng, texts = random.Random(8), []
    for n in range(150):
        words = [f"w{n}_{i}" for i in range(rng.choice([30, 100, 400]))]
        now = list(words)
        for _ in range(round(len(words) * rng.choice([0.008, 0.016, 0.02]))):
            now[rng.randrange(len(now))] = "new"
        texts += [" ".join(words), " ".join(now)]
    sets = [brute_set(t) for t in texts]
    near = [i for i in range(0, len(texts), 2) if similar(sets[i], sets[i + 1])]
    got = {r["_id"]: r["component"] for r in S.near_duplicates(docs_of(texts)).collect()}
    assert len(near) > 100 and sum(got[i + 1] == i for i in near) >= 0.95 * len(near)
    assert all(got[i + 1] == i + 1 for i in range(0, len(texts), 2) if i not in near)


def test_large_groups_are_split(docs_of, monkeypatch):
    from microlake.llm import simhash

    rng = random.Random(9)
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(w if rng.random() > rng.choice([0.003, 0.02]) else f"x{rng.randrange(99)}" for w in words) for _ in range(90)]
    want = brute_components(texts)
    assert len(set(want)) > 3
    whole = {r["_id"]: r["component"] for r in S.near_duplicates(docs_of(texts)).collect()}
    assert sum(whole[i] == c for i, c in enumerate(want)) > 80
    monkeypatch.setattr(simhash, "LARGE_GROUP", 16)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(S, "BLOCK", 4)
    monkeypatch.setattr(S, "CROWD", 3)
    assert {r["_id"]: r["component"] for r in S.near_duplicates(docs_of(texts)).collect()} == whole


def test_odd_and_empty(odd, empty):
    assert S.deduplicate(empty).count() == 0 and S.near_duplicates(empty).count() == 0
    out = S.deduplicate(odd)
    assert out.columns == odd.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    assert kept.count((4, "same row here")) == 1 and (1, None) in kept and (2, "") not in kept
