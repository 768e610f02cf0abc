"""Ranked lexical search by presence masks.

One pass over the texts keeps, per document, which terms of the items it holds
and how often. Then documents are taken a few thousand at a time: a bitmap per
term tells which of them hold it; an item's bitmaps, read across, give each
document's mask of matched terms, and equal masks form a group. The most a mask
can score is the sum of its terms' best impacts there, so the masks are
evaluated from the highest maximum down until the item's weakest kept result is
above the next maximum: no document that could be among the best is left out. A
task carries its best results from one set of documents to the next, and an
item none of whose masks can reach them is passed over at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import _arrow, doc_texts, map_batches, stored
from .words import ALNUM, Words, words

TOP = 50
#: Characters of the items of one block, which goes to every task: about 40 MB with its index.
BLOCK_CHARS = 4 << 20
#: Documents grouped at a time, and the most bits of their bitmaps.
SET_DOCS, SET_BITS = 4096, 1 << 26
#: Documents of the next masks that are scored together.
STEP = 256
#: Parts of an item's results that are reduced on their own first.
SALTS = 64
_LAST = np.iinfo(np.int64).max


def item_terms(texts: list[str | None]) -> list[bytes]:
    """The distinct terms of texts, in byte order."""
    found: set[bytes] = set()
    for w in words(pa.array([t for t in texts if t], pa.string()), ALNUM, lower=True):
        found.update(w.data[a:b].tobytes() for a, b in zip(w.start, w.end))
    return sorted(found)


@dataclass
class Vocabulary:
    """Terms of a block of items, found by hash and compared by their bytes."""
    terms: list[bytes]
    hashes: np.ndarray = field(init=False)

    def __post_init__(self):
        data = b" ".join(self.terms)
        self.data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        size = np.array([len(t) for t in self.terms], np.int64)
        self.start = np.cumsum(size + 1) - size - 1 if len(size) else size
        self.end = self.start + size
        whole = Words(0, 1, self.data, self.start, self.end, np.array([0, len(size)]))
        hashes = whole.hashes()
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.table = np.zeros(1 << 20, bool)
        self.table[self.hashes >> np.uint64(44)] = True

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) of all words that are terms."""
        if not len(self.hashes) or not len(w):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        h = w.hashes()
        at = np.flatnonzero(self.table[h >> np.uint64(44)])
        words_, terms = [], []
        first, last = np.searchsorted(self.hashes, h[at], "left"), np.searchsorted(self.hashes, h[at], "right")
        for k in range(int((last - first).max(initial=0))):  # once, unless two terms share a hash
            some = first + k < last
            word, term = at[some], self.order[first[some] + k]
            same = same_bytes(w.data, w.start[word], w.end[word], self.data, self.start[term], self.end[term])
            words_.append(word[same])
            terms.append(term[same])
        return (np.concatenate(words_), np.concatenate(terms)) if words_ else (np.zeros(0, np.int64),) * 2


def same_bytes(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Which of the spans in ``a`` and ``b`` hold the same bytes; no span is empty."""
    same = a_end - a_start == b_end - b_start
    some = np.flatnonzero(same)
    if len(some):
        size = a_end[some] - a_start[some]
        before = np.cumsum(size) - size
        step = np.arange(size.sum()) - np.repeat(before, size)
        equal = a[np.repeat(a_start[some], size) + step] == b[np.repeat(b_start[some], size) + step]
        same[some] = np.logical_and.reduceat(equal, before)
    return same


def postings(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """doc_id, n (terms with repeats), terms and tf (of the vocabulary), of the documents that hold any term at all."""
    known: dict[str, Vocabulary] = {}

    def run(batch: pa.RecordBatch):
        if not known:
            known["v"] = Vocabulary(vocabulary)
        ids = batch.column("doc_id")
        for w in words(batch.column("text"), ALNUM, lower=True):
            word, term = known["v"].find(w)
            doc = np.searchsorted(w.first, word, "right") - 1
            pair, tf = np.unique(doc * np.int64(max(1, len(vocabulary))) + term, return_counts=True)
            doc, term = np.divmod(pair, max(1, len(vocabulary)))
            n = np.diff(w.first)
            some = np.flatnonzero(n)
            offsets = pa.array(np.append(np.searchsorted(doc, some), len(doc)).astype(np.int32))
            yield {"doc_id": ids.slice(w.lo, w.hi - w.lo).take(pa.array(some)), "n": pa.array(n[some]),
                   "terms": pa.ListArray.from_arrays(offsets, pa.array(term.astype(np.int32))),
                   "tf": pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int32)))}
    texts = doc_texts(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return map_batches(texts, run, "doc_id long, n long, terms array<int>, tf array<int>")


@dataclass
class Best:
    """The best results of an item so far, best first."""
    top: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    nameless: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @property
    def least(self) -> int:
        """What a result has to reach to be among the best."""
        return int(self.score[-1]) if len(self.score) == self.top else 1

    def add(self, score: np.ndarray, nameless: np.ndarray, doc: np.ndarray) -> None:
        good = score >= self.least
        score, nameless, doc = (np.concatenate(x) for x in (
            (self.score, score[good]), (self.nameless, nameless[good]), (self.doc, doc[good])))
        order = np.lexsort((doc, nameless, -score))[:self.top]
        self.score, self.nameless, self.doc = score[order], nameless[order], doc[order]


class DocumentSet:
    """Some documents: their postings by document and by term, and a bitmap per term."""

    def __init__(self, doc: np.ndarray, nameless: np.ndarray, offsets: np.ndarray, terms: np.ndarray, impact: np.ndarray, n_terms: int):
        self.doc, self.nameless, self.offsets, self.terms, self.impact = doc, nameless, offsets, terms, impact
        size = len(doc)
        held, column = np.unique(terms, return_inverse=True)
        self.column = np.full(n_terms, -1, np.int64)
        self.column[held] = np.arange(len(held))
        bits = np.zeros((len(held), size), bool)
        bits[column, np.repeat(np.arange(size), np.diff(offsets))] = True
        self.bitmaps = np.packbits(bits, axis=1)
        best = np.zeros(len(held), np.int64)
        np.maximum.at(best, column, impact)
        #: Best impact of each term here.
        self.best = np.append(best, 0)
        self.mine = np.zeros(n_terms, bool)

    def limit(self, item_terms: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The most that any document here can score, per item (its terms start at ``starts``)."""
        return np.add.reduceat(self.best[self.column[item_terms]], starts)

    def search(self, terms: np.ndarray, best: Best) -> None:
        """Merge the documents' scores for an item with these terms into its best results."""
        column = self.column[terms]
        column = column[column >= 0]
        if not len(column):
            return
        bits = np.unpackbits(self.bitmaps[column], axis=1, count=len(self.doc))
        masks = np.ascontiguousarray(np.packbits(bits, axis=0).T)
        keys = np.zeros((len(masks), -(-masks.shape[1] // 8) * 8), np.uint8)
        keys[:, :masks.shape[1]] = masks
        keys = keys.view(np.uint64).ravel() if keys.shape[1] == 8 else keys.view(f"V{keys.shape[1]}").ravel()
        _, example, group = np.unique(keys, return_index=True, return_inverse=True)
        most = self.best[column] @ bits[:, example].astype(np.int64)
        able = np.flatnonzero(most[group] >= best.least)
        able = able[np.argsort(-most[group[able]], kind="stable")]  # documents, those of the best masks first
        most = most[group[able]]
        self.mine[terms] = True
        at = 0
        while at < len(able) and most[at] >= best.least:
            # whole masks: STEP documents or more, up to the last one of equal maximum
            end = int(np.searchsorted(-most, -most[min(at + STEP, len(able)) - 1], "right"))
            chosen = able[at:end]
            best.add(self.scores(chosen), self.nameless[chosen], self.doc[chosen])
            at = end
        self.mine[terms] = False

    def scores(self, chosen: np.ndarray) -> np.ndarray:
        size = self.offsets[chosen + 1] - self.offsets[chosen]
        before = np.cumsum(size) - size
        rows = np.repeat(self.offsets[chosen] - before, size) + np.arange(size.sum())
        return np.add.reduceat(np.where(self.mine[self.terms[rows]], self.impact[rows], 0), before)


def document_sets(batch: pa.RecordBatch, weights: np.ndarray, n_docs: int, n_words: int) -> Iterator[DocumentSet]:
    """The batch's documents that hold a term, some thousands at a time."""
    def make(part: pa.RecordBatch) -> Iterator[DocumentSet]:
        lists = part.column("terms")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        size = np.diff(offsets)
        terms = lists.values.to_numpy()[offsets[0]:offsets[-1]]
        if part.num_rows > 1 and part.num_rows * len(np.unique(terms)) > SET_BITS:
            half = part.num_rows // 2
            yield from make(part.slice(0, half))
            yield from make(part.slice(half))
            return
        counts = part.column("tf")
        tf = counts.values.to_numpy()[counts.offsets[0].as_py():counts.offsets[-1].as_py()].astype(np.int64)
        n = part.column("n").to_numpy()
        length = 50 + 50 * n * n_docs // n_words
        impact = weights[terms] * (1_000_000_000 * tf // (1000 * tf + 20 * np.repeat(length, size)))
        held = np.flatnonzero(size)
        ids = part.column("doc_id")
        doc = ids.fill_null(_LAST).to_numpy(zero_copy_only=False)
        if len(held):
            yield DocumentSet(doc[held], np.asarray(ids.is_null().to_numpy(zero_copy_only=False))[held],
                              np.append(0, np.cumsum(size[held])), terms, impact, len(weights))
    for at in range(0, batch.num_rows, SET_DOCS):
        yield from make(batch.slice(at, SET_DOCS))


def search_block(docs: DataFrame, items: list[tuple[object, list[bytes]]], id_type: str, top: int) -> DataFrame:
    """item_id, doc_id, score: what may be among the best of each item, from every task its own."""
    vocabulary = sorted({t for _, own in items for t in own})
    number = {t: i for i, t in enumerate(vocabulary)}
    names = [i for i, _ in items]
    flat = np.array([number[t] for _, own in items for t in own], np.int64)
    starts = np.cumsum([0] + [len(own) for _, own in items])
    found = stored(postings(docs, vocabulary), "postings")
    n_docs, n_words = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weights = np.zeros(len(vocabulary), np.int64)
    for r in df.toLocalIterator():  # at most the block's terms
        weights[r["term"]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["df"] + 1)))
    arrow_id = _arrow(docs.sparkSession.createDataFrame([], f"item_id {id_type}").schema["item_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in names]
        for batch in batches:
            for some in document_sets(batch, weights, n_docs, n_words):
                most = some.limit(flat, starts[:-1])
                for i in np.flatnonzero(most >= np.fromiter((b.least for b in best), np.int64, len(best))):
                    some.search(flat[starts[i]:starts[i + 1]], best[i])
        for name, b in zip(names, best):
            if len(b.score):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(b.score), arrow_id), pa.array(b.doc, mask=b.nameless), pa.array(b.score)],
                    ["item_id", "doc_id", "score"])
    return found.where(F.size("terms") > 0).mapInArrow(run, f"item_id {id_type}, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each item with a score above 0.

    Terms are runs of digits, letters and non-ASCII characters, A-Z
    lower-cased, of whole texts. Null and empty texts have none and no part in
    the statistics. Rows of one item_id, null included, are one item with the
    terms of all; an item without terms has no results. Every row of ``docs`` is
    a document of its own, repeated ones too; equal scores go by doc_id, rows
    without one last. Empty tables give no rows; other columns are not looked at.
    """
    id_type = items.schema["item_id"].dataType.simpleString()
    sized = stored(items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
                   .distinct().withColumn("size", F.length("text")), "search-items")
    blocks = max(1, -((sized.agg(F.sum("size")).first()[0] or 0) // -block_chars))
    parts = []
    for b in range(blocks):
        texts: dict[object, list[str]] = {}
        for r in sized.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).select("item_id", "text").collect():
            texts.setdefault(r["item_id"], []).append(r["text"])  # about block_chars characters
        own = [(i, terms) for i, t in texts.items() if (terms := item_terms(t))]
        if own:
            parts.append(search_block(docs, own, id_type, top))
    if not parts:
        return docs.sparkSession.createDataFrame([], f"item_id {id_type}, rank int, doc_id long, score long")
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # results of many tasks: best of each part first, so that no task gets all of an item's
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    salted = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))).where(F.col("rank") <= top)
    ranked = salted.drop("rank", "salt").withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*best)))
    return ranked.where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
