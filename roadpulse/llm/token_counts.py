"""Token counts of a unigram vocabulary, without building the tokens.

An Aho-Corasick automaton enumerates the vocabulary's matches in a piece of
text; dynamic programming carries the best score and its piece count to each
end. Of equally good ways to an end the one that starts earliest stays, as the
tokenizer does it. No piece of the vocabulary crosses a word's begin or a line
break, so words are counted on their own and remembered.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import doc_texts, map_batches

#: What a word's begin looks like in the vocabulary, and what an unknown character costs more than the worst piece.
BEGIN, UNKNOWN = "▁", 10.0
#: Distinct words whose counts a worker remembers.
CACHED_WORDS = 250_000


def piece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in the order of their ids."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.IdToPiece(i), model.GetScore(i)) for i in range(model.GetPieceSize())]


@dataclass
class Counter:
    """Counts of one vocabulary; unknown characters count as their UTF-8 bytes."""
    vocabulary: list[tuple[str, float]]
    known: dict[str, tuple[int, float]] = field(default_factory=dict)

    def __post_init__(self):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in self.vocabulary:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in self.vocabulary) - UNKNOWN
        inner = [p for p, _ in self.vocabulary if BEGIN in p[1:] and p.strip(BEGIN)]
        if inner or any("\n" in p for p, _ in self.vocabulary):
            raise ValueError(f"pieces go over a word's begin or a line break: {inner[:3]}")

    def viterbi(self, text: str) -> tuple[int, float]:
        """(pieces, score) of the best segmentation."""
        n = len(text)
        best, pieces = [0.0] + [-np.inf] * n, [0] * (n + 1)
        single, done = -1, 0
        for end, (size, score) in self.automaton.iter(text):
            end += 1
            while done < end - 1:  # ends before this one are settled but for an unknown character
                done += 1
                if single != done:
                    self._unknown(text, done, best, pieces)
            if size == 1:
                single = end
            start = end - size
            if (s := best[start] + score) > best[end]:
                best[end], pieces[end] = s, pieces[start] + 1
        while done < n:
            done += 1
            if single != done:
                self._unknown(text, done, best, pieces)
        return pieces[n], best[n]

    def _unknown(self, text: str, end: int, best: list[float], pieces: list[int]) -> None:
        if (s := best[end - 1] + self.unknown) > best[end]:
            best[end], pieces[end] = s, pieces[end - 1] + len(text[end - 1].encode("utf-8", "replace"))

    def word(self, word: str) -> tuple[int, float]:
        found = self.known.get(word)
        if found is None:
            if len(self.known) > CACHED_WORDS:
                self.known.clear()
            found = self.known[word] = self.viterbi(word)
        return found

    def count(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text; a begin is put before it, and stands for each space."""
        if not text:
            return 0, 0.0
        n, score = 0, 0.0
        for line in (BEGIN + text.replace(" ", BEGIN)).split("\n"):
            if n:
                a, b = self.word("\n")
                n, score = n + a, score + b
            head, *rest = line.split(BEGIN)
            chunks, run = [head] if head else [], ""
            for w in rest:
                run += BEGIN
                if w:
                    chunks.append(run + w)
                    run = ""
            if run:
                chunks.append(run)
            for w in chunks:
                a, b = self.word(w)
                n, score = n + a, score + b
        return n, score


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]]) -> DataFrame:
    """doc_id, n_tokens, score (of the best segmentation), one row per row of ``docs``.

    Null and empty texts have no tokens and score 0. Repeated rows and null ids
    get a row each; an empty table gives no rows; other columns are not looked
    at. The vocabulary, a tokenizer's, goes to the tasks.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()
    state: dict[str, Counter] = {}

    def run(batch: pa.RecordBatch):
        if "counter" not in state:
            state["counter"] = Counter(vocabulary)
        found = [state["counter"].count(t) for t in batch.column("text").to_pylist()]
        yield {"doc_id": batch.column("doc_id"), "n_tokens": [a for a, _ in found], "score": [b for _, b in found]}
    return map_batches(doc_texts(docs), run, f"doc_id {ids}, n_tokens long, score double")


def total_tokens(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("n_tokens").alias("n_tokens"))
