import os
import random

import pytest

from microlake.llm import tokens as T

pytestmark = pytest.mark.skipif(not os.path.exists(T.VOCABULARY), reason="no vocabulary file")
ODD = ["", " ", "  a  b ", " x", "日本語 tést\n\n\t☃☃ 🙂", "▁▁a ▁", "a" * 300, "The quick (brown) fox's 12.5% <s> x_y"]


def reference(pieces, spelled):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.Unigram(pieces, 0, spelled))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement=T.SPACE, prepend_scheme="always", split=True)
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("spelled", [True, False])
def test_counts_are_the_tokenizers(spelled):
    pieces = [p for p in T.load_pieces() if spelled or p[0] not in T.BYTE_PIECES]
    count, want, rng = T.TokenCounter(pieces), reference(pieces, spelled), random.Random(4)
    made = ["".join(rng.choice("abcdeé ☃\n日n,") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    for text in ODD + made:
        assert count.of_text(text) == want(text), text


def test_ties_take_the_match_that_starts_first():
    pieces = [("<unk>", 0.0), (T.SPACE, -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), (T.SPACE + "a", -2.0), ("aba", -3.0)]
    count, want = T.TokenCounter(pieces), reference(pieces, False)
    for text in ("ab", "aba", "abab", "ba ab", "abcab", "ccc", "c a c"):
        assert count.of_text(text) == want(text), text


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(T, "REMEMBERED", 5)
    c = T.TokenCounter(T.load_pieces())
    plain = T.TokenCounter(T.load_pieces())
    for i in range(40):
        c.of_text(f"w{i} x{i}")
        assert len(c.known) <= 5
    assert c.of_text("w1 x2 w3 y4 y5 y6") == sum(plain.of_piece(T.SPACE + w) for w in "w1 x2 w3 y4 y5 y6".split())


def test_odd_and_empty(odd, empty):
    out = T.count_tokens(odd)
    assert out.columns == [*odd.columns, "n_tokens_"]
    rows = {(r["doc_id"], r["text"]): r["n_tokens_"] for r in out.collect()}
    assert rows[(1, None)] == 0 and rows[(2, "")] == 0 and rows[(7, "one")] >= 1
    assert T.count_tokens(empty).count() == 0
