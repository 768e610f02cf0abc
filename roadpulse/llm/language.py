"""Language of texts by cross-parsing against suffix automata.

Per language a bounded sample of labelled text becomes a suffix automaton: it
recognises exactly the sample's substrings. A text is parsed from left to right
into longest matches, each phrase as long as the automaton can go on. The fewer
phrases a language needs, the closer the text is to it; a phrase costs the bits
that point into the sample, so samples of different lengths compare. Automata
are walked by many pieces of text in step, one numpy operation for all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import map_batches, stored
from .words import spans

#: The sample of a language: documents at most, characters of each, bytes of all after cleaning.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_BYTES = 200, 1000, 40_000
#: Folds of documents by id, of which the first is held out.
FOLDS = 5
#: Bytes of a piece; a phrase ends where its piece does, in every language alike.
PIECE = 256
UNKNOWN = "und"
_SPACE = 32
#: ASCII other than letters reads as one space; lower-casing is done before.
_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[:97] = _SPACE
_CLEAN[123:128] = _SPACE


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % FOLDS == 0


def clean(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of texts with every run of other ASCII as one space, and the texts' offsets in them."""
    data = _CLEAN[data]
    keep = np.ones(len(data), bool)
    keep[1:] = (data[1:] != _SPACE) | (data[:-1] != _SPACE)
    begins = offsets[:-1][offsets[:-1] < len(data)]
    keep[begins] = True  # a text's first byte does not depend on the text before
    after = np.append(0, np.cumsum(keep))
    return data[keep], after[offsets]


@dataclass(frozen=True)
class Automaton:
    """Suffix automaton of a sample. State 0 is the start; target 0 means there is no way on.

    Most states have one way on: its symbol and target lie in ``only`` and
    ``to``; ``branch`` is the row of ``table`` of a state that has more, 0 else.
    Symbol 0 is any byte that the sample lacks, and the end of a piece.
    """
    symbol: np.ndarray   # of each byte
    only: np.ndarray
    to: np.ndarray
    branch: np.ndarray
    table: np.ndarray    # rows of targets by symbol, flat
    width: int
    size: int

    @staticmethod
    def of(text: bytes) -> Automaton:
        after: list[dict[int, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(after)
            after.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in after[p]:
                after[p][c] = new
                p = link[p]
            if p >= 0:
                q = after[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(after)
                    after.append(dict(after[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    link[q] = link[new] = twin
                    while p >= 0 and after[p].get(c) == q:
                        after[p][c] = twin
                        p = link[p]
            last = new
        used = sorted(set(text))
        symbol = np.zeros(256, np.uint8 if len(used) < 256 else np.uint16)
        symbol[used] = np.arange(1, len(used) + 1)
        width, n = len(used) + 1, len(after)
        only, to, branch = np.zeros(n, symbol.dtype), np.zeros(n, np.int32), np.zeros(n, np.int32)
        rows = [np.zeros(width, np.int32)]
        for state, ways in enumerate(after):
            if len(ways) == 1 and state:
                (c, q), = ways.items()
                only[state], to[state] = symbol[c], q
            elif ways or not state:
                row = np.zeros(width, np.int32)
                for c, q in ways.items():
                    row[symbol[c]] = q
                branch[state] = len(rows)
                rows.append(row)
        return Automaton(symbol, only, to, branch * width, np.concatenate(rows), width, len(text))

    def phrases(self, pieces: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Phrases of each piece: column of ``pieces``, whose first ``length`` bytes count; longest pieces first."""
        width, height = pieces.shape[1], pieces.shape[0]
        count = np.zeros(width, np.int32)
        state = np.zeros(width, np.int32)
        start = self.table[self.branch[0]:self.branch[0] + self.width]
        active = width - np.searchsorted(length[::-1], np.arange(height), "right")  # pieces longer than that
        for i in range(height):
            n = int(active[i])
            if n < len(state):  # the others have ended, within a phrase or not
                count[n:len(state)] += state[n:] != 0
                state = state[:n]
            if not n:
                break
            c = self.symbol[pieces[i, :n]]
            ahead = np.where((self.only[state] == c) & (c != 0), self.to[state], self.table[self.branch[state] + c])
            broken = ahead == 0
            count[:n] += (broken & (state != 0)).astype(np.int32) + (c == 0)  # an unknown byte is a phrase by itself
            state = np.where(broken, start[c], ahead)
        count[:len(state)] += state != 0
        return count


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts as columns, longest first; their lengths; the text of each."""
    size = np.diff(offsets)
    n = -(-size // PIECE)
    text = np.repeat(np.arange(len(size)), n)
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = offsets[:-1][text] + step * PIECE
    length = np.minimum(PIECE, offsets[1:][text] - begin)
    order = np.argsort(-length, kind="stable")
    begin, length, text = begin[order], length[order], text[order]
    height = int(length.max(initial=0))
    at = begin[None, :] + np.arange(height)[:, None]
    return np.append(data, np.zeros(PIECE, np.uint8))[at], length, text


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    automata: tuple[Automaton, ...]

    def bits(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each text in each language: phrases times the bits that point into the sample."""
        data, offsets = clean(data, offsets)
        pieces, length, text = cut(data, offsets)
        out = np.zeros((len(offsets) - 1, len(self.automata)))
        for k, a in enumerate(self.automata):
            count = np.bincount(text, a.phrases(pieces, length), minlength=len(out)) if len(length) else 0
            out[:, k] = count * np.log2(a.size + 1)
        return out


def sample(docs: DataFrame, most_docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> DataFrame:
    """lang and text of at most ``most_docs`` documents of each language outside the held-out fold, the first characters of each.

    Documents are chosen by the hash of their id: the languages' counts give a
    share that leaves a few times as many, of which the first by hash stay.
    """
    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.substring(F.lower(F.col("text").cast("string")), 1, chars).alias("text"),
                       F.xxhash64("doc_id").alias("order")) \
        .where("doc_id is not null and lang is not null and text is not null").where(~held_out())
    counts = stored(rows.groupBy("lang").agg(F.count("*").alias("n")), "languages")
    share = F.pmod("order", F.lit(1 << 20)) * F.col("n") <= F.lit(4 * most_docs << 20)
    some = rows.join(counts, "lang").where(share)
    first = F.row_number().over(Window.partitionBy("lang").orderBy("order", "text"))
    return some.withColumn("k", first).where(F.col("k") <= most_docs).select("lang", "text", "k")


def fit(docs: DataFrame, most_docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS, most_bytes: int = SAMPLE_BYTES) -> Model:
    """Automata of all languages that a sample of ``docs`` gives.

    Bounded: a language's sample has ``most_bytes`` bytes at most, its automaton
    twice as many states.
    """
    texts: dict[str, list[str]] = {}
    for r in sample(docs, most_docs, chars).orderBy("lang", "k").toLocalIterator():
        texts.setdefault(r["lang"], []).append(r["text"])
    built = {}
    for lang, own in texts.items():
        raw = [t.encode() for t in own]
        data, offsets = clean(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(t) for t in raw]))
        joined = b" ".join(data[a:b].tobytes() for a, b in zip(offsets, offsets[1:]))[:most_bytes]
        if joined.strip():
            built[lang] = Automaton.of(joined)
    return Model(tuple(built), tuple(built.values()))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score, phrase_bits (per language), one row per row of ``docs``.

    The language of fewest normalised phrases; of equal ones the first by name.
    ``score`` is its share of the likelihoods that the bits stand for. Texts
    that are null or hold no letter, and all texts if there is no language, are
    ``und`` with score 0. A row without doc_id is not held out, nor learnt from.
    An empty table gives no rows. Other columns have no part in it.
    """
    names = np.array([*model.languages, UNKNOWN], object)

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        letters = np.asarray(batch.column("letters").to_numpy(zero_copy_only=False))
        for lo, hi, data, offsets in spans(batch.column("text")):
            some = letters[lo:hi] & bool(model.languages)
            best, score = np.full(hi - lo, len(model.languages)), np.zeros(hi - lo)
            bits = model.bits(data, offsets)
            if model.languages:
                best = np.where(some, bits.argmin(axis=1), best)
                score = np.where(some, 1 / np.exp2(np.minimum(bits.min(axis=1)[:, None] - bits, 0)).sum(axis=1), 0)
            yield {"doc_id": batch.column("doc_id").slice(lo, hi - lo), "held_out": batch.column("held_out").slice(lo, hi - lo),
                   "lang_pred": pa.array(names[best].tolist(), pa.string()), "score": pa.array(score), "phrase_bits": bits.tolist()}
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), text.rlike(r"\p{L}").alias("letters"),
                       F.lower(text).alias("text"))
    ids = docs.schema["doc_id"].dataType.simpleString()
    return map_batches(rows, run, f"doc_id {ids}, held_out boolean, lang_pred string, score double, phrase_bits array<double>")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score, learnt from the documents outside the held-out fold."""
    return predict(docs, fit(docs)).drop("phrase_bits")
