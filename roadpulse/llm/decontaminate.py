"""Benchmark decontamination: a prefix-filtered set join of documents with item windows.

An item's windows are its runs of ten words; a shorter item is one window. A
window is a set of shingles, and to contain it a document must hold every one,
so the prefix that has to be joined is a single shingle: the rarest in the
corpus. Documents meet the index of those shingles; the shingle's place in the
window and both lengths bound where the window can lie; the words there are
then compared.

Items are taken in blocks of a bounded number of words, the only thing sent to
the tasks, so a benchmark of any size is joined block after block.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import doc_texts, map_batches, stored
from .words import ALNUM, Words, shingle_hashes, words

WINDOW = 10
SHINGLE = 3
#: What stands for items without id.
NO_ID = "null"
#: Words of the items of one block: some 10 MB with the index over them.
BLOCK_WORDS = 200_000


class WindowIndex:
    """Windows of one block of items, found by one shingle each."""

    def __init__(self, items: list[tuple[str, str]]):
        of: dict[bytes, set[str]] = defaultdict(set)
        parts: dict[bytes, np.ndarray] = {}
        for item, text in items:
            for w in words(pa.array([text], pa.string()), ALNUM, lower=True):
                h, size = w.hashes(), min(WINDOW, len(w))
                for at in range(len(w) - size + 1 if size else 0):
                    key = w.text(at, size)
                    of[key].add(item)
                    parts[key] = h[at:at + size]
        self.texts = list(of)
        self.items = [sorted(of[k]) for k in self.texts]
        self.hashes = [parts[k] for k in self.texts]
        self.size = np.array([len(h) for h in self.hashes], np.int64)
        #: shingle length -> windows that use it
        self.by_k = {k: np.flatnonzero(np.minimum(self.size, SHINGLE) == k) for k in range(1, SHINGLE + 1)}
        self.by_k = {k: v for k, v in self.by_k.items() if len(v)}

    def shingles(self) -> dict[int, np.ndarray]:
        """All shingles of the windows, sorted."""
        return {k: np.unique(np.concatenate([shingle_hashes(self.hashes[w], k) for w in ws])) for k, ws in self.by_k.items()}

    def choose(self, count: dict[int, int]) -> WindowIndex:
        """Keep for each window its rarest shingle, the first of equally rare ones."""
        self.lists = {}
        for k, ws in self.by_k.items():
            rows = []
            for w in ws:
                own = shingle_hashes(self.hashes[w], k)
                at = min(range(len(own)), key=lambda i: (count.get(int(own[i]), 0), int(own[i]), i))
                rows.append((int(own[at]), int(w), at))
            rows.sort()
            h = np.array([r[0] for r in rows], np.uint64)
            keys, first = np.unique(h, return_index=True)
            self.lists[k] = (keys, np.append(first, len(h)), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]),
                             presence(keys))
        return self


def presence(keys: np.ndarray) -> np.ndarray:
    """A bit table that rules out nearly all shingles which are not in ``keys``."""
    table = np.zeros(1 << 20, bool)
    table[keys >> np.uint64(44)] = True
    return table


def found_in(h: np.ndarray, keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``h`` whose value is in the sorted ``keys``, and which key it is."""
    at = np.flatnonzero(table[h >> np.uint64(44)])
    key = np.minimum(np.searchsorted(keys, h[at]), len(keys) - 1)
    same = keys[key] == h[at]
    return at[same], key[same]


def count_shingles(docs: DataFrame, index: WindowIndex) -> dict[int, int]:
    """How often each shingle of the windows occurs in all documents."""
    keys = {k: (v, presence(v)) for k, v in index.shingles().items()}

    def count(batch: pa.RecordBatch):
        total: dict[int, np.ndarray] = {k: np.zeros(len(v), np.int64) for k, (v, _) in keys.items()}
        for w in words(batch.column("text"), ALNUM, lower=True):
            h = w.hashes()
            for k, (v, table) in keys.items():
                s = shingle_hashes(h, k)
                at, key = found_in(s, v, table)
                inside = at + k <= w.first[np.searchsorted(w.first, at, "right")]
                total[k] += np.bincount(key[inside], minlength=len(v))
        for k, n in total.items():
            some = np.flatnonzero(n)
            yield {"shingle": pa.array(keys[k][0][some].view(np.int64)), "n": pa.array(n[some])}

    rows = map_batches(docs.select("text"), count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return {r["shingle"] & 0xFFFFFFFFFFFFFFFF: r["n"] for r in rows.toLocalIterator()}  # at most the block's shingles


def windows_in(w: Words, index: WindowIndex) -> tuple[np.ndarray, np.ndarray]:
    """(first word, window) of every occurrence of a window in ``w``."""
    h, starts, wins = w.hashes(), [], []
    for k, (keys, first, window, place, table) in index.lists.items():
        at, key = found_in(shingle_hashes(h, k), keys, table)
        n = first[key + 1] - first[key]
        row = np.repeat(first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at, win = np.repeat(at, n), window[row]
        start = at - place[row]
        doc = np.searchsorted(w.first, at, "right") - 1
        fits = (start >= w.first[doc]) & (start + index.size[win] <= w.first[doc + 1])
        start, win = start[fits], win[fits]
        same = np.fromiter((w.text(s, index.size[x]) == index.texts[x] for s, x in zip(start, win)), bool, len(start))
        starts.append(start[same])
        wins.append(win[same])
    return (np.concatenate(starts), np.concatenate(wins)) if starts else (np.zeros(0, np.int64),) * 2


def hits_of_block(docs: DataFrame, index: WindowIndex) -> DataFrame:
    """One row per document: doc_id, text_key, n_words, hits (disjoint spans of words, end exclusive), items."""
    ids = docs.schema["doc_id"].dataType.simpleString()

    def find(batch: pa.RecordBatch):
        for w in words(batch.column("text"), ALNUM, lower=True):
            start, win = windows_in(w, index)
            n_docs = w.hi - w.lo
            step = np.zeros(len(w) + 1, np.int32)
            np.add.at(step, start, 1)
            np.add.at(step, start + index.size[win], -1)
            hit = np.cumsum(step[:-1]) > 0
            edge = np.zeros(len(w) + 1, bool)
            edge[w.first] = True
            begins = np.flatnonzero(hit & (~np.append(False, hit[:-1]) | edge[:-1])) if len(w) else np.zeros(0, int)
            ends = np.flatnonzero(hit & (~np.append(hit[1:], False) | edge[1:])) + 1 if len(w) else np.zeros(0, int)
            items: list[set[str]] = [set() for _ in range(n_docs)]
            doc = np.searchsorted(w.first, start, "right") - 1
            for d, x in set(zip(doc.tolist(), win.tolist())):
                items[d].update(index.items[x])
            base = w.first[:-1]
            spans: list[list[dict]] = [[] for _ in range(n_docs)]
            for d, a, b in zip((np.searchsorted(w.first, begins, "right") - 1).tolist(), begins.tolist(), ends.tolist()):
                spans[d].append({"start": a - base[d], "end": b - base[d]})
            yield {"doc_id": batch.column("doc_id").slice(w.lo, n_docs), "text_key": batch.column("text_key").slice(w.lo, n_docs),
                   "n_words": pa.array(np.diff(w.first)), "hits": spans, "items": [sorted(x) for x in items]}

    return map_batches(docs, find, f"doc_id {ids}, text_key string, n_words long, hits array<struct<start:long,end:long>>, items array<string>")


def text_key(text: Column) -> Column:
    """What tells the texts of rows with one doc_id apart, null ids included."""
    return F.md5(F.coalesce(text.cast("string"), F.lit("")))


def find_in_rows(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, text_key, n_words, hits, items of every row; see ``find_contamination``."""
    docs = doc_texts(docs).withColumn("text_key", text_key(F.col("text")))
    items = stored(benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit(NO_ID)).alias("item_id"), "text")
                   .where("text is not null").withColumn("size", F.length("text")), "items")
    blocks = max(1, -((items.agg(F.sum("size")).first()[0] or 0) // -(4 * block_words)))
    found = []
    for b in range(blocks):
        # by text, so that many rows of one id, or of none, do not make one block large
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).select("item_id", "text").distinct()
        index = WindowIndex([tuple(r) for r in block.collect()])  # about block_words words
        found.append(hits_of_block(docs, index.choose(count_shingles(docs, index))))
    if blocks == 1:
        return found[0]
    # equal rows have equal hits, so a row's id and text stand for it; only rows with hits are merged
    some = None
    for f in found:
        own = f.where(F.size("hits") > 0).dropDuplicates(["doc_id", "text_key"]).select(
            F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "hits", "items")
        some = own if some is None else some.unionByName(own)
    merged = stored(some.groupBy("hit_id", "hit_key").agg(  # a row a block each
        F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")), "merged-hits")
    rows = found[0].select("doc_id", "text_key", "n_words")
    both = rows.join(merged, rows["doc_id"].eqNullSafe(merged["hit_id"]) & (rows["text_key"] == merged["hit_key"]), "left")
    none = F.array().cast("array<struct<start:long,end:long>>")
    return both.select("doc_id", "text_key", "n_words", F.coalesce(union_spans(F.col("hits")), none).alias("hits"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def find_contamination(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """doc_id, n_words, hits, items: where item windows lie in each document, one row per row of ``docs``.

    Words are runs of digits, letters and non-ASCII characters of the
    lower-cased text. Null or empty documents have no words and no hits; null,
    empty or wordless items have no window; an empty benchmark hits nothing; an
    empty table gives no rows. Every row is judged by its own text, also where
    ids repeat or are null. Rows of one item id are one item; items without id
    are the one item ``null``. Columns other than doc_id, item_id and text are
    not looked at. A benchmark of any size gives the same result.
    """
    return find_in_rows(docs, benchmark, block_words).drop("text_key")


def union_spans(hits):
    """Disjoint spans from sorted ones that may overlap."""
    kind = "array<struct<start:long,end:long>>"
    return F.aggregate(hits, F.array().cast(kind), lambda acc, x: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= x["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"], F.greatest(F.element_at(acc, -1)["end"], x["end"]))
            .cast("struct<start:long,end:long>"))))
        .otherwise(F.concat(acc, F.array(x))))


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Digest columns of ``find_contamination``."""
    n_hit = F.aggregate("hits", F.lit(0).cast("bigint"), lambda a, x: a + x["end"] - x["start"])
    return find_contamination(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents without any item window, all their columns.

    Every row is judged by its own text: rows that share an id, or have none,
    go only if they hold a window themselves.
    """
    bad = stored(find_in_rows(docs, benchmark, block_words).where(F.size("hits") > 0).select(
        F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")), "contaminated")
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_key(docs["text"]) == bad["bad_key"]), "left_anti")
