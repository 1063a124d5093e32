"""Token counts under a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton lists, for each place of a word, the vocabulary pieces that end there;
dynamic programming carries the best score and its number of pieces.  The rules are those of the
unigram model of the ``tokenizers`` library: of paths with equal scores the one found first
stays, where paths are tried by the start of their last piece; a character that is no piece costs
the lowest score less 10 and counts as its UTF-8 bytes.  The text is split before each space,
which becomes U+2581, so words are counted on their own and looked up when they come again.

The vocabulary file holds merge ranks in place of scores; a piece of rank r gets the log
probability of Zipf's law, -ln((r + 1) * H) with H the harmonic number of the vocabulary's size.

Defined cases: a null or empty text has no tokens; rows with equal or null ids are counted each
on its own; no rows give no rows.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE_MARK = "▁"
_UNKNOWN_PENALTY = 10.0
_CACHED_WORDS = 300_000

_worker: dict = {}


def unigram_vocabulary(path: str) -> list[tuple[str, float]]:
    """(piece, score) by id.  Pieces that are no text (unknown, control, byte) score lowest."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    size = model.vocab_size()
    special = [i for i in range(size)
               if model.is_unknown(i) or model.is_control(i) or model.is_byte(i)]
    log_h = math.log(sum(1 / r for r in range(1, size + 1)))
    lowest = -math.log(size) - log_h
    scores = [-math.log(i - len(special) + 1) - log_h if i >= len(special) else lowest
              for i in range(size)]
    for i in special:
        scores[i] = lowest
    return [(model.id_to_piece(i), s) for i, s in enumerate(scores)]


class ViterbiCounter:
    """Counts the pieces of the best path."""

    def __init__(self, vocabulary: list[tuple[str, float]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {piece for piece, _ in vocabulary if len(piece) == 1}
        self.unknown = min(score for _, score in vocabulary) - _UNKNOWN_PENALTY
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = len(word)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        reached, place = [True] + [False] * n, 0

        def unknown_to(end: int) -> None:
            """The character before ``end`` as unknown, tried after all pieces that end there."""
            char = word[end - 1]
            if char not in self.single:
                score = best[end - 1] + self.unknown
                if not reached[end] or score > best[end]:
                    reached[end], best[end] = True, score
                    count[end] = count[end - 1] + len(char.encode("utf-8", "surrogatepass"))

        for last, (length, score) in self.automaton.iter(word):
            end = last + 1
            while place < last:  # ends that no further piece has
                place += 1
                unknown_to(place)
            # Pieces that end at one place come longest first.
            score += best[end - length]
            if not reached[end] or score > best[end]:
                reached[end], best[end], count[end] = True, score, count[end - length] + 1
        while place < n:
            place += 1
            unknown_to(place)
        return count[n]

    def text(self, text: str) -> int:
        marked = text.replace(" ", SPACE_MARK)
        if not marked:
            return 0
        if marked[0] != SPACE_MARK:
            marked = SPACE_MARK + marked
        words = marked.split(SPACE_MARK)[1:]
        known = self.known
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            new = {w for w in words if w not in known}
        if len(known) + len(new) > _CACHED_WORDS:
            known.clear()
            new = set(words)
        for w in new:
            known[w] = self.word(SPACE_MARK + w)
        return sum(map(known.__getitem__, words))


def _counter(path: str) -> ViterbiCounter:
    """One automaton for each Python worker."""
    if _worker.get("path") != path:
        _worker.update(path=path, counter=ViterbiCounter(unigram_vocabulary(path)))
    return _worker["counter"]


def token_counts(docs: DataFrame, model: str, *, id_col: str = "doc_id",
                 text: str = "text") -> DataFrame:
    """doc_id and n_tokens for every row."""
    def work(batches):
        counter = _counter(model)
        for batch in batches:
            counts = [counter.text(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text).cast("string")).mapInArrow(
        work, "doc_id long, n_tokens long")
