"""Token counts of a unigram tokenizer, without making the tokens: count-only Viterbi.

A text's spaces become U+2581 and one is put in front if there is none; it is then cut before each of them, as the
Metaspace pre-tokenizer does. In a piece of text, an Aho-Corasick automaton enumerates the vocabulary matches by their
ends, and dynamic programming carries the best score and its number of tokens to each position. Ties are the tokenizer's:
of equal scores the match that starts first stays, a character gets the unknown token only where no vocabulary entry is
that character alone, at the lowest score less 10, and is then spelled in byte tokens if the vocabulary has them all;
otherwise a run of unknown characters is one token.

The vocabulary file is a parameter; the driver reads it and broadcasts its pieces, whose number the file fixes. Pieces of
text repeat a lot, so that each task remembers a bounded number of counts.

Defined cases: null and empty texts have 0 tokens; rows that repeat get the same count; a null id is passed on; an empty
table gives an empty result. Other columns are passed on by count_tokens(). Texts are read whole; lone surrogates
count as unknown.
"""

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import own_names, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
SPACE = "▁"
REMEMBERED = 400_000
BYTE_PIECES = frozenset(f"<0x{i:02X}>" for i in range(256))


def load_pieces(path: str = VOCABULARY) -> list[tuple[str, float]]:
    """(piece, score) for each id of a sentencepiece file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(sp.id_to_piece(i), float(sp.get_score(i))) for i in range(sp.get_piece_size())]


class TokenCounter:
    """Counts the tokens of texts."""

    def __init__(self, pieces: list[tuple[str, float]]):
        self.matches = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.matches.add_word(piece, (len(piece), score))
        self.matches.make_automaton()
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.spelled = BYTE_PIECES <= {p for p, _ in pieces}
        self.singles = frozenset(p for p, _ in pieces if len(p) == 1)
        self.known: dict[str, int] = {}

    def of_piece(self, word: str) -> int:
        n = len(word)
        if self.singles.issuperset(word):  # no character can be unknown
            best, count = [0.0] + [float("-inf")] * n, [0] * (n + 1)
            for last, (length, score) in self.matches.iter(word):
                start = last + 1 - length
                score += best[start]
                if score > best[last + 1]:
                    best[last + 1], count[last + 1] = score, count[start] + 1
            return count[n]
        best: list[float | None] = [0.0] + [None] * n
        count, loose, alone = [0] * (n + 1), [False] * (n + 1), [False] * (n + 1)
        done = 0

        def settle(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if alone[done]:
                    continue
                score = best[done - 1] + self.unknown
                if best[done] is None or score > best[done]:
                    best[done], loose[done] = score, True
                    if self.spelled:
                        count[done] = count[done - 1] + len(word[done - 1].encode("utf-8", "surrogatepass"))
                    else:
                        count[done] = count[done - 1] + (not loose[done - 1])

        for last, (length, score) in self.matches.iter(word):  # of those with the same end, the longest comes first
            end = last + 1
            if done < last:
                settle(last)
            start = end - length
            score += best[start]
            if best[end] is None or score > best[end]:
                best[end], count[end] = score, count[start] + 1
            if length == 1:
                alone[end] = True
        settle(n)
        return count[n]

    def of_text(self, text: str | None) -> int:
        if not text:
            return 0
        cut = text.replace(" ", SPACE)
        parts = (cut if cut[0] == SPACE else SPACE + cut).split(SPACE)[1:]
        known, total = self.known, 0
        for part, n in Counter(parts).items():
            got = known.get(part)
            if got is None:
                if len(known) >= REMEMBERED:
                    known.clear()
                got = self.of_piece(SPACE + part)
                if len(part) < 64:
                    known[part] = got
            total += n * got
        return total


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The documents with all their columns and n_tokens (with a _ behind it, if they have such a column)."""
    pieces = docs.sparkSession.sparkContext.broadcast(load_pieces(vocabulary))

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = TokenCounter(pieces.value)
        for texts in batches:
            yield pd.Series([counter.of_text(t) for t in texts], dtype="int64")

    return docs.withColumn(own_names(docs, "n_tokens")["n_tokens"], counted(F.col("text").cast("string")))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens")


QUERIES = {"op3_token_counts": op3_token_counts}
