"""Substring deduplication over FM-indexes, one per shard of passages.

A window of words and its copies choose the same anchor: the run of ANCHOR
words in it with the least hash. Windows are therefore dealt out by anchor, and
each shard is complete for its own: no text has to be streamed past every
shard. The work goes over blocks of documents:

1. each block sends its anchors to the shards, with the number of different
   passages around each; they answer which of them occur in more than one
   document, and which are heavy, with more than HEAVY passages in all blocks;
2. the block sends the passages around the shared ones, consecutive windows with
   one anchor together and equal ones once, with the smallest doc_id they have;
   windows of a heavy anchor go one by one, dealt out by their own hash;
3. a shard indexes its distinct passages (BWT, wavelet matrix), takes their
   windows back through it and finds for each the smallest doc_id of all
   passages in its suffix interval;
4. the block removes the words of windows that start in an earlier document.

Blocks and shards hold a bounded share of the input each: a phrase with ever new
neighbours is a heavy anchor, whose windows spread over all shards, and a passage
that very many documents have is one entry per block.
Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fm_index import FmIndex
from .tables import doc_texts, stored
from .words import NOT_SPACE, Words, flat, mix, shingle_hashes, words

WINDOW = 13
ANCHOR = 6
#: Text bytes of a block, and of the input for each shard.
BLOCK_BYTES, SHARD_BYTES = 1 << 20, 8 << 20
LEAST_SHARDS = 48
#: Passages around one anchor that are still held together.
HEAVY = 4096
#: In the count of an anchor's passages that a block sends: two of its documents have the anchor.
_TWICE = 1 << 15
_NO_ID = np.iinfo(np.int64).max
_CODEC = "zstd"


def squeeze(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec=_CODEC, asbytes=True)


def unsqueeze(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], decompressed_size=size, codec=_CODEC, asbytes=True) if size else b""


def blocks(docs: DataFrame) -> DataFrame:
    """block, doc_id (list), ends (list), data (the texts, compressed), size: documents in bounded blocks."""
    def run(batches):
        name = TaskContext.get().partitionId() << 33
        ids, ends, parts, size = [], [], [], 0

        def row():
            return pa.RecordBatch.from_arrays([
                pa.array([name]), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())),
                pa.array([squeeze(b"".join(parts))], pa.binary()), pa.array([size])], ["block", "doc_id", "ends", "data", "size"])
        for batch in batches:
            data, offsets = flat(batch.column("text"))
            for n, i in enumerate(batch.column("doc_id").to_pylist()):
                text = data[offsets[n]:offsets[n + 1]].tobytes()
                if parts and size + len(text) > BLOCK_BYTES:
                    yield row()
                    name, ids, ends, parts, size = name + 1, [], [], [], 0
                size += len(text)
                ids.append(i)
                ends.append(size)
                parts.append(text)
        if ids:
            yield row()
    docs = doc_texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    return docs.mapInArrow(run, "block long, doc_id array<long>, ends array<long>, data binary, size long")


@dataclass
class Runs:
    """Consecutive windows of one document with one anchor."""
    first: np.ndarray   # word at which the first window starts
    count: np.ndarray   # windows
    anchor: np.ndarray  # hash
    doc: np.ndarray     # document in the block


@dataclass
class Pieces:
    """What a block sends: runs, and single windows of heavy anchors."""
    first: np.ndarray
    count: np.ndarray
    doc: np.ndarray
    shard: np.ndarray
    number: np.ndarray  # in the list of its shard


class Block:
    """One block, read the same way in every pass."""

    def __init__(self, ids: list[int | None], ends: list[int], data: bytes, shards: int):
        text = unsqueeze(data)
        offsets = pa.py_buffer(np.append(0, ends).astype(np.int64).tobytes())
        column = pa.Array.from_buffers(pa.large_binary(), len(ids), [None, offsets, pa.py_buffer(text)])
        self.ids = ids
        self.rank = np.array([_NO_ID if i is None else i for i in ids], np.int64)
        self.words: Words = next(words(column, NOT_SPACE, lower=False, chunk=1 << 62))
        self.shards = shards
        self.runs, self.window = _runs(self.words)
        self.anchors, self.which = np.unique(self.runs.anchor, return_inverse=True)
        self.shard = (self.anchors % np.uint64(shards)).astype(np.int64)

    def twice(self) -> np.ndarray:
        """Of each anchor, whether two documents of the block have it."""
        low, high = np.full(len(self.anchors), _NO_ID), np.full(len(self.anchors), np.iinfo(np.int64).min)
        ids = self.rank[self.runs.doc]
        np.minimum.at(low, self.which, ids)
        np.maximum.at(high, self.which, ids)
        return low < high

    def passages_of_anchors(self) -> np.ndarray:
        """Of each anchor, how many different passages of the block have it."""
        last = self.runs.first + self.runs.count - 1
        whole = self.window[self.runs.first] + mix(self.window[last] + self.runs.count.astype(np.uint64))
        return np.bincount(self.which[np.unique(whole, return_index=True)[1]], minlength=len(self.anchors))

    def flags(self, answers: list[tuple[int, bytes]]) -> np.ndarray:
        """Of each anchor, 1 if it is shared, 2 if it is heavy too, else 0, from the answers of the shards."""
        out = np.zeros(len(self.anchors), np.int8)
        order = np.argsort(self.shard, kind="stable")
        cuts = np.searchsorted(self.shard[order], [s for s, _ in answers])
        for (shard, bits), at in zip(answers, cuts):
            got = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)
            mine = order[at:at + int((self.shard == shard).sum())]
            out[mine] = got[:len(mine)].astype(np.int8) + got[len(mine):2 * len(mine)]
        return out

    def passages(self, flags: np.ndarray):
        """The pieces with a shared anchor; each shard's list of texts, and the smallest doc_id of each text."""
        chosen = np.flatnonzero(flags[self.which]) if len(self.which) else np.zeros(0, np.int64)
        heavy = flags[self.which[chosen]] == 2
        parts = np.where(heavy, self.runs.count[chosen], 1)
        run, heavy = np.repeat(chosen, parts), np.repeat(heavy, parts)
        begin = self.runs.first[run] + np.arange(len(run)) - np.repeat(np.cumsum(parts) - parts, parts)
        count = np.where(heavy, 1, self.runs.count[run])
        shard = self.shard[self.which[run]]
        shard[heavy] = (self.window[begin[heavy]] % np.uint64(self.shards)).astype(np.int64)
        w, data = self.words, self.words.data.tobytes()
        doc = self.runs.doc[run]
        lists: dict[int, dict[bytes, int]] = {}
        least: dict[int, list[int]] = {}
        number = np.zeros(len(run), np.int64)
        for n, (s, a, b, r) in enumerate(zip(shard.tolist(), w.start[begin].tolist(), w.end[begin + count + WINDOW - 2].tolist(),
                                             self.rank[doc].tolist())):
            known, low = lists.setdefault(s, {}), least.setdefault(s, [])
            text = data[a:b]
            at = known.get(text)
            if at is None:
                at = known[text] = len(low)
                low.append(r)
            elif r < low[at]:
                low[at] = r
            number[n] = at
        return Pieces(begin, count, doc, shard, number), lists, least


def _runs(w: Words) -> tuple[Runs, np.ndarray]:
    """The runs of a block, and the hash of each window by its first word."""
    h = w.hashes()
    n = len(h) - WINDOW + 1
    if n <= 0:
        return Runs(*[np.zeros(0, np.int64)] * 2, np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.zeros(0, np.uint64)
    g = shingle_hashes(h, ANCHOR)
    best, at = g[:n].copy(), np.arange(n)
    for j in range(1, WINDOW - ANCHOR + 1):
        less = g[j:j + n] < best
        best[less] = g[j:j + n][less]
        at[less] = np.flatnonzero(less) + j
    doc = np.searchsorted(w.first, np.arange(n), "right") - 1
    whole = np.arange(n) + WINDOW <= w.first[doc + 1]
    new = np.append(True, (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]))
    first = np.flatnonzero(new & whole)
    stops = np.append(np.flatnonzero(new), n)
    last = np.minimum(stops[np.searchsorted(stops, first, "right")], w.first[doc[first] + 1] - WINDOW + 1)
    window = mix(mix(g[:n] + mix(g[ANCHOR:][:n])) + g[WINDOW - ANCHOR:][:n])  # the three runs of words cover it
    return Runs(first, last - first, best[first], doc[first]), window


def _read(batch: pa.RecordBatch, shards: int):
    for b, ids, ends, data in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "ends", "data"))):
        yield b, Block(ids, ends, data, shards)


def _send_anchors(shards: int):
    def run(batches):
        for batch in batches:
            for name, block in _read(batch, shards):
                counts = np.minimum(block.passages_of_anchors(), _TWICE - 1).astype(np.uint16) + block.twice() * np.uint16(_TWICE)
                order = np.argsort(block.shard, kind="stable")
                cuts = np.flatnonzero(np.append(True, np.diff(block.shard[order]) != 0)) if len(order) else []
                rows = [(name, int(block.shard[part[0]]), block.anchors[part].tobytes(),
                         squeeze(counts[part].tobytes())) for part in np.split(order, cuts[1:])] if len(order) else []
                yield _batch(rows, (pa.int64(), pa.int32(), pa.binary(), pa.binary()), ("block", "shard", "anchors", "counts"))
    return run


def _shared_anchors(heavy: int):
    def run(table: pa.Table) -> pa.Table:
        """A shard's answer to each block: which of its anchors another document has too, and which are heavy."""
        sent = [np.frombuffer(x, np.uint64) for x in table.column("anchors").to_pylist()]
        counts = np.concatenate([np.frombuffer(unsqueeze(x), np.uint16) for x in table.column("counts").to_pylist()])
        _, which, blocks_of = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        shared = blocks_of > 1
        shared[which[counts >= _TWICE]] = True
        many = shared & (np.bincount(which, counts & (_TWICE - 1), len(shared)) > heavy)
        at, rows = 0, []
        for block, shard, s in zip(table.column("block").to_pylist(), table.column("shard").to_pylist(), sent):
            mine = which[at:at + len(s)]
            at += len(s)
            if shared[mine].any():
                rows.append((block, shard, np.packbits(np.append(shared[mine], many[mine]), bitorder="little").tobytes()))
        return pa.Table.from_batches([_batch(rows, (pa.int64(), pa.int32(), pa.binary()), ("block", "shard", "shared"))])
    return run


def _answers(batch: pa.RecordBatch, column: str) -> list[list[tuple[int, bytes]]]:
    return [sorted((x["shard"], x[column]) for x in row or ()) for row in batch.column(column).to_pylist()]


def _send_passages(shards: int):
    def run(batches):
        for batch in batches:
            rows = []
            for (name, block), answers in zip(_read(batch, shards), _answers(batch, "shared")):
                _, lists, least = block.passages(block.flags(answers))
                for shard, known in lists.items():
                    sizes = np.fromiter(map(len, known), np.int64, len(known))
                    rows.append((name, shard, len(known), squeeze(
                        sizes.tobytes() + np.array(least[shard], np.int64).tobytes() + b"".join(known))))
            yield _batch(rows, (pa.int64(), pa.int32(), pa.int64(), pa.binary()), ("block", "shard", "n", "passages"))
    return run


def _window_minima(table: pa.Table) -> pa.Table:
    """A shard's answer to each block: of every window of its passages, the smallest doc_id that has it."""
    number: dict[bytes, int] = {}
    least: list[int] = []
    sent: list[list[int]] = []
    for n, data in zip(table.column("n").to_pylist(), table.column("passages").to_pylist()):
        data = unsqueeze(data)
        sizes, low = np.frombuffer(data, np.int64, n), np.frombuffer(data, np.int64, n, 8 * n)
        ends = 16 * n + np.cumsum(sizes)
        own = []
        for a, b, r in zip((ends - sizes).tolist(), ends.tolist(), low.tolist()):
            at = number.setdefault(data[a:b], len(least))
            if at == len(least):
                least.append(r)
            elif r < least[at]:
                least[at] = r
            own.append(at)
        sent.append(own)
    minima, first = passage_minima(list(number), np.array(least, np.int64))
    rows = [(block, shard, squeeze(np.concatenate([minima[first[p]:first[p + 1]] for p in own]).tobytes()))
            for block, shard, own in zip(table.column("block").to_pylist(), table.column("shard").to_pylist(), sent)]
    return pa.Table.from_batches([_batch(rows, (pa.int64(), pa.int32(), pa.binary()), ("block", "shard", "minima"))])


def passage_minima(passages: list[bytes], least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of the passages, in order, the least of ``least`` over the passages that have it; and each passage's first window."""
    w = next(words(pa.array(passages, pa.large_binary()), NOT_SPACE, lower=False, chunk=1 << 62))
    _, ids = np.unique(w.hashes(), return_inverse=True)
    of = np.repeat(np.arange(len(passages)), np.diff(w.first))
    text = np.zeros(len(ids) + len(passages), np.int64)  # a separator after each passage
    place = np.arange(len(ids)) + of
    text[place] = ids + 1
    n = np.diff(w.first) - WINDOW + 1
    first = np.append(0, np.cumsum(n))
    owner = np.repeat(np.arange(len(passages)), n)
    start = (w.first[:-1] + np.arange(len(passages)))[owner] + np.arange(first[-1]) - first[owner]
    index = FmIndex(text)
    lo, hi = index.matching(text, start, WINDOW)
    minima = least[owner]
    many = np.flatnonzero(hi > lo)
    if len(many):
        spots, which = np.unique(lo[many], return_inverse=True)  # intervals of equal length are equal or apart
        ends = np.zeros(len(spots), np.int64)
        ends[which] = hi[many]
        at_suffix = np.full(len(text) + 1, _NO_ID)
        passage_at = np.searchsorted(w.first[1:] + np.arange(len(passages)), index.order, "left")
        at_suffix[:-1] = least[np.minimum(passage_at, len(passages) - 1)]
        low = np.minimum.reduceat(at_suffix, np.column_stack([spots, ends]).ravel())[::2]
        minima[many] = low[which]
    return minima, first


def _remove(shards: int):
    def run(batches):
        for batch in batches:
            for (_, block), shared, minima in zip(_read(batch, shards), _answers(batch, "shared"), _answers(batch, "minima")):
                pieces, _, _ = block.passages(block.flags(shared))
                w = block.words
                step = np.zeros(len(w) + 1, np.int32)
                for s, data in minima:
                    low = np.frombuffer(unsqueeze(data), np.int64)
                    mine = np.flatnonzero(pieces.shard == s)
                    number, n = pieces.number[mine], pieces.count[mine]
                    count = np.zeros(int(number.max()) + 1, np.int64)
                    count[number] = n
                    begin = np.append(0, np.cumsum(count))[number]
                    inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                    early = low[np.repeat(begin, n) + inner] < np.repeat(block.rank[pieces.doc[mine]], n)
                    hit = (np.repeat(pieces.first[mine], n) + inner)[early]
                    np.add.at(step, hit, 1)
                    np.add.at(step, hit + WINDOW, -1)
                gone = np.cumsum(step[:-1]) > 0
                total = np.append(0, np.cumsum(gone))
                data, removed, texts = w.data, np.diff(total[w.first]), []
                whole = data.tobytes()
                for d in range(len(block.ids)):
                    a, b = int(w.first[d]), int(w.first[d + 1])
                    if a == b:
                        texts.append(b"")
                    elif not removed[d]:
                        texts.append(b" ".join(whole[w.start[a]:w.end[b - 1]].split()))
                    else:
                        keep = a + np.flatnonzero(~gone[a:b])
                        texts.append(b" ".join([whole[x:y] for x, y in zip(w.start[keep].tolist(), w.end[keep].tolist())]))
                yield pa.RecordBatch.from_arrays([
                    pa.array(block.ids, pa.int64()), pa.array(np.diff(w.first)), pa.array(removed), pa.array(texts, pa.binary()).cast(pa.string())],
                    ["doc_id", "n_words", "n_removed", "text"])
    return run


def _batch(rows: list[tuple], types: tuple, names: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], list(names))


def drop_repeated(docs: DataFrame, block_docs: DataFrame | None = None, heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_words, n_removed, text (the kept words joined by one space), one row per row of ``docs``.

    A word goes if a window of WINDOW consecutive words that covers it also
    starts in a document with a smaller doc_id. Null and empty texts have no
    words; rows that repeat a doc_id are no earlier than each other; a row
    without doc_id comes after all others. An empty table gives no rows; other
    columns are not looked at.
    """
    held = stored(blocks(docs), "blocks") if block_docs is None else block_docs
    size = held.agg(F.sum("size")).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-size // SHARD_BYTES))
    to_block = lambda df, c: df.groupBy("block").agg(F.collect_list(F.struct("shard", c)).alias(c))
    sent = held.mapInArrow(_send_anchors(shards), "block long, shard int, anchors binary, counts binary")
    shared = stored(to_block(sent.groupBy("shard").applyInArrow(
        _shared_anchors(heavy), "block long, shard int, shared binary"), "shared"), "shared-anchors")
    asked = stored(held.join(shared, "block"), "asked")
    passages = asked.mapInArrow(_send_passages(shards), "block long, shard int, n long, passages binary")
    minima = stored(to_block(passages.groupBy("shard").applyInArrow(
        _window_minima, "block long, shard int, minima binary"), "minima"), "minima")
    return held.join(shared, "block", "left").join(minima, "block", "left").mapInArrow(
        _remove(shards), "doc_id long, n_words long, n_removed long, text string")


def substring_digests(docs: DataFrame) -> DataFrame:
    return drop_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))
