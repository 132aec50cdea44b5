"""Token counts of a unigram tokenizer: Aho-Corasick matches and a count-only Viterbi.

Words (between white space) are marked with a leading U+2581 and tokenised one by one. Aho-Corasick enumerates
all vocabulary pieces that end at each code point; the dynamic programme carries the best score and its number of
pieces, nothing else. Ties follow the usual unigram decoder: of equally good ways to reach a place
the one with the earlier start (longer last piece) wins. A code point without a piece of its own costs the smallest
score less ``UNKNOWN_PENALTY``; it counts as its UTF-8 bytes if the vocabulary has byte pieces, else a run of
such code points counts as one piece.

The vocabulary is a file of a public tokenizer (its path is a parameter); its pieces keep their rank
and score ``-log(rank + 2)``, the law of rank and frequency. Nothing is trained. The vocabulary has a fixed
size and is broadcast; counts of words are remembered within a task, in a table of bounded size.

Defined results: a null, empty or blank text has no words, no pieces and score 0. Repeated rows each get their
row; words of any length are read whole. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularium.llm.common import share, shared_model, table

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 200_000
WORD_BYTES = 256


@dataclass
class Vocabulary:
    pieces: dict[str, float]
    byte_pieces: bool

    @property
    def unknown(self) -> float:
        return min(self.pieces.values(), default=0.0) - UNKNOWN_PENALTY


def read_vocabulary(path: str = VOCABULARY) -> Vocabulary:
    """Pieces of a sentencepiece file in their order; control and unknown pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    special = [i for i in range(model.get_piece_size()) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)]
    left_out = set(special)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size()) if i not in left_out]
    scores = {name: -math.log(rank + 2) for rank, name in enumerate(names)}
    return Vocabulary(scores, sum(model.is_byte(i) for i in special) == 256)


class Counter:
    """Counts pieces of words; made once per task."""

    def __init__(self, vocabulary: Vocabulary):
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.pieces.items():
            self.automaton.add_word(piece, (len(piece), score))
        if vocabulary.pieces:
            self.automaton.make_automaton()
        self.empty = not vocabulary.pieces
        self.single = frozenset(p for p in vocabulary.pieces if len(p) == 1)
        self.unknown = vocabulary.unknown
        self.byte_pieces = vocabulary.byte_pieces
        self.known: dict[str, tuple[int, float]] = {}

    def word(self, word: str) -> tuple[int, float]:
        """Number of pieces of the best segmentation and its score."""
        return self.covered(word) if self.single.issuperset(word) else self.with_unknown(word)

    def covered(self, word: str) -> tuple[int, float]:
        """All code points are pieces: matches alone decide."""
        best, count = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
        for last, (size, score) in self.automaton.iter(word):
            start = last + 1 - size
            total = best[start] + score
            if total > best[last + 1]:  # the longest match comes first and keeps ties
                best[last + 1] = total
                count[last + 1] = count[start] + 1
        return count[-1], best[-1]

    def with_unknown(self, word: str) -> tuple[int, float]:
        n = len(word)
        best, count = [-math.inf] * (n + 1), [0] * (n + 1)
        loose = [False] * (n + 1)  # the last piece of the best way is unknown
        best[0] = 0.0
        at, single = 0, False

        def finish(end: int) -> None:
            """All pieces that end here are seen: try the lone code point."""
            if single:
                return
            score = best[end - 1] + self.unknown
            if score > best[end]:
                best[end] = score
                if self.byte_pieces:
                    count[end] = count[end - 1] + len(word[end - 1].encode("utf-8", "surrogatepass"))
                else:
                    count[end] = count[end - 1] + (not loose[end - 1])
                loose[end] = True

        if not self.empty:
            for last, (size, score) in self.automaton.iter(word):
                end = last + 1
                while at + 1 < end:
                    at += 1
                    finish(at)
                    single = False
                total = best[end - size] + score
                if total > best[end]:
                    best[end], count[end], loose[end] = total, count[end - size] + 1, False
                single = single or size == 1
        while at < n:
            at += 1
            finish(at)
            single = False
        return count[n], best[n]

    def text(self, text: str | None) -> tuple[int, int, float]:
        """Words, pieces and score of a text."""
        known, pieces, score = self.known, 0, 0.0
        words = text.split() if text else []
        for w in words:
            found = known.get(w)
            if found is None:
                found = self.word(MARK + w)
                if len(w) < WORD_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[w] = found
            pieces += found[0]
            score += found[1]
        return len(words), pieces, score


def count_tokens(docs: DataFrame, vocabulary: Vocabulary, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``n_words``, ``n_tokens`` and ``token_score`` (natural logarithm)."""
    shared = share(docs.sparkSession, vocabulary)
    picked = docs.select(*keep, F.col("text").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared_model(shared))
        for batch in batches:
            found = [counter.text(x.as_py()) for x in batch.column(batch.num_columns - 1)]
            words, pieces, scores = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(scores, pa.float64())],
                [*batch.schema.names[:-1], "n_words", "n_tokens", "token_score"],
            )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(run, f"{schema}, n_words long, n_tokens long, token_score double")


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_vocabulary())
