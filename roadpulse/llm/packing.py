"""Hierarchical multi-length packing of tokenised documents.

Within a task documents are taken in pools of a fixed number of tokens. Of a
pool, whole windows are cut from long documents; each rest is routed to the
tier of the shortest context that holds it. Tiers are packed from the longest
on: a rest opens a window of its tier's size and the gap is filled from the
shorter tiers, longest fitting rest first, the last bit with a cut. The windows
of each tier, longest first, are then dealt to step groups, each to the one with
the fewest tokens, so the groups are equally large and alike in their tiers.
Nothing is shuffled and ids never leave their task; a sequence number is the
partition's number and a count in it.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .tables import doc_texts
from .words import spans

CONTEXT = 4096
#: Context sizes, each with its own tier.
TIERS = (256, 512, 1024, 2048, 4096)
#: Tokens of a step group: 256 full windows.
GROUP_TOKENS = 256 * CONTEXT
#: Step groups of a pool.
POOL_GROUPS = 4
END = 2
#: Distinct words whose ids a worker remembers; bytes of the texts that are encoded together.
CACHED_WORDS, TOGETHER = 500_000, 4 << 20
_SPECIAL = "<|"
#: Set between words that are encoded in one call: it is a word of its own and has one id.
_BETWEEN = "\x01"
_TAILS = frozenset(".,;:!?")
#: Words of these letters alone are what normaliser and splitter leave as they are.
_PLAIN = re.compile("[a-zß-öø-ÿ]+").fullmatch
#: The tokenizer spells bytes as characters: printable ones of Latin-1 as themselves, the others in order from 256 on.
_SPELT = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_SPELLING = {b: chr(b) for b in _SPELT} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SPELT)}
_LETTERS = {c: "".join(_SPELLING[b] for b in chr(c).encode()) for c in range(0xDF, 0x100)}


class Encoder:
    """The tokenizer's ids of whole texts, computed word by word.

    Its normaliser lower-cases, and its splitter treats the two sides of a
    space, of a line break, and of a mark that ends a word after a letter or
    digit apart from each other, so the ids of a text are those of its words in
    order. Texts that may hold special tokens are encoded as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.between = self._ids(_BETWEEN)
        self.known: dict[str, bytes] = {}
        self._start()

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _start(self) -> None:
        self.known.clear()
        self.known.update({c: np.array(self._ids(c), "<u4").tobytes() for c in _TAILS})

    def _learn(self, words: list[str]) -> None:
        """Ids of new words: plain ones by the model alone, the others in one call of the whole tokenizer."""
        tokenize, others = self.model.tokenize, []
        for w in words:
            if _PLAIN(w):
                found = tokenize(w.translate(_LETTERS))
                self.known[w] = struct.pack(f"<{len(found)}I", *[x.id for x in found])
            else:
                others.append(w)
        if not others:
            return
        words = others
        ids = np.array(self._ids(f" {_BETWEEN} ".join(words)), "<u4")
        cuts = np.flatnonzero(ids == self.between[0]) if len(self.between) == 1 else ()
        if len(cuts) == len(words) - 1:
            data, at = ids.tobytes(), 0
            for w, cut in zip(words, [*(4 * cuts).tolist(), len(data)] if len(words) > 1 else [len(data)]):
                self.known[w] = data[at:cut]
                at = cut + 4
        else:
            for w in words:
                self.known[w] = np.array(self._ids(w), "<u4").tobytes()

    def _lookup(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words."""
        known = self.known
        if len(known) > CACHED_WORDS:
            self._start()
        new = [w for w in words if w not in known]
        if new:
            ended = [w for w in new if w[-1:] in _TAILS and w[-2:-1].isalnum()]
            cores = dict.fromkeys(w[:-1] for w in ended)
            fresh = [w for w in {**cores, **dict.fromkeys(new)} if w not in known and (w in cores or w[-1:] not in _TAILS or not w[-2:-1].isalnum())]
            if fresh:
                self._learn(fresh)
            for w in ended:
                known[w] = known[w[:-1]] + known[w[-1]]
        return [known[w] for w in words]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text of a string column without nulls.

        Arrow splits the texts and tells their words apart; each distinct word
        is looked up once, and its ids are gathered for all its places.
        """
        for lo, hi, _, _ in spans(texts, TOGETHER):
            own = texts.slice(lo, hi - lo)
            special = pc.match_substring(own, _SPECIAL).to_numpy(zero_copy_only=False)
            plain = pc.if_else(pa.array(special), "", own) if special.any() else own
            parts = pc.split_pattern(pc.replace_substring(pc.ascii_lower(plain), "\n", " "), " ")
            words = parts.flatten().dictionary_encode()
            ids = self._lookup(words.dictionary.to_pylist())
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            start = np.cumsum(size) - size
            word = words.indices.to_numpy()
            n = size[word]
            after = np.append(0, np.cumsum(n))
            flat = np.frombuffer(b"".join(ids), "<u4")[np.repeat(start[word] - after[:-1], n) + np.arange(after[-1])]
            offsets = parts.offsets.to_numpy()
            offsets = after[offsets - offsets[0]]
            for i in range(hi - lo):
                yield np.array(self._ids(own[i].as_py()), np.uint32) if special[i] else flat[offsets[i]:offsets[i + 1]]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept over its tasks."""
    if path not in _encoders:
        _encoders.clear()
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tier_of(n: int) -> int:
    return next(t for t in TIERS if n <= t)


def pack_pool(sizes: list[int]) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """Sequences of one pool: (tier, [(document, start, length)]).

    Every sequence is as long as its tier but for what the pool's last rest
    leaves, which is cut into tiers and an end shorter than the least of them.
    """
    out: list[tuple[int, list[tuple[int, int, int]]]] = []
    rests: dict[int, list[tuple[int, int, int]]] = {t: [] for t in TIERS}  # (length, document, start), sorted
    for doc, n in enumerate(sizes):
        whole = n // CONTEXT * CONTEXT
        out += [(CONTEXT, [(doc, at, CONTEXT)]) for at in range(0, whole, CONTEXT)]
        if n > whole:
            rests[tier_of(n - whole)].append((n - whole, doc, whole))
    for own in rests.values():
        own.sort()

    def fitting(gap: int) -> tuple[int, int, int] | None:
        """The longest rest that fits into the gap, or else the shortest, to be cut."""
        for t in reversed(TIERS[:TIERS.index(tier_of(gap)) + 1]):
            if (at := bisect_right(rests[t], (gap, 1 << 62, 0))):
                return rests[t].pop(at - 1)
        return next((rests[t].pop(0) for t in TIERS if rests[t]), None)

    for t in reversed(TIERS):
        while rests[t]:
            n, doc, start = rests[t].pop()
            window, gap = [(doc, start, n)], t - n
            while gap and (rest := fitting(gap)):
                n, doc, start = rest
                cut = min(n, gap)
                window.append((doc, start, cut))
                gap -= cut
                if n > cut:
                    insort(rests[tier_of(n - cut)], (n - cut, doc, start + cut))
            if gap:
                out += shorter(window, t - gap)
            else:
                out.append((t, window))
    return out


def step_groups(tiers: list[int], filled: list[int], groups: int) -> list[int]:
    """The group of each sequence: longest tiers first, each to the group with the fewest tokens."""
    load = [(0, g) for g in range(groups)]
    heapify(load)
    out = [0] * len(tiers)
    for i in sorted(range(len(tiers)), key=lambda i: (-filled[i], i)):
        tokens, g = load[0]
        out[i] = g
        heapreplace(load, (tokens + filled[i], g))
    return out


def shorter(window: list[tuple[int, int, int]], filled: int) -> list[tuple[int, list[tuple[int, int, int]]]]:
    """The pool's last, partly filled window as windows of the shorter tiers."""
    out, pieces = [], list(window)
    while filled:
        size = next((t for t in reversed(TIERS) if t <= filled), filled)
        took, have = [], 0
        while have < size:
            doc, start, n = pieces.pop(0)
            cut = min(n, size - have)
            took.append((doc, start, cut))
            have += cut
            if n > cut:
                pieces.insert(0, (doc, start + cut, n - cut))
        out.append((size if size in TIERS else CONTEXT, took))
        filled -= size
    return out


def pack(docs: DataFrame, tokenizer: str, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, tier, step_group.

    Every document ends with id 2; null text counts as empty and is that id
    alone. Pieces of a document are in order of start, those of a sequence lie
    at gapless offsets. Repeated rows are packed each; doc_id may be null; an
    empty table gives no rows; other columns are not looked at. step_group
    numbers the groups of sequences with equally many tokens.
    """
    ids = docs.schema["doc_id"].dataType.simpleString()

    pool_tokens = POOL_GROUPS * group_tokens

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() << 33
        sequence, group = part, part
        held: list[tuple[object, int, np.ndarray, int]] = []  # doc_id, first id, ids, ids of the whole document
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence, group
            rows = []
            packed = pack_pool([len(x[2]) for x in held])
            groups = -(-tokens // group_tokens)
            dealt = step_groups([t for t, _ in packed], [sum(n for _, _, n in pieces) for _, pieces in packed], groups)
            for (tier, pieces), own_group in zip(packed, dealt):
                at = 0
                for doc, start, n in pieces:
                    name, base, own, whole = held[doc]
                    rows.append((name, base + start, n, zlib.crc32(own[start:start + n].astype("<u4").tobytes()), whole, sequence, at, tier,
                                 group + own_group))
                    at += n
                sequence += 1
            group += groups
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for name, ids_ in zip(batch.column("doc_id"), encoder(tokenizer).encode(batch.column("text"))):
                own = np.append(ids_, np.uint32(END)).astype(np.uint32)
                whole, at = len(own), 0
                while at < whole:  # a document may end one pool and go on in the next
                    n = min(whole - at, pool_tokens - tokens)
                    held.append((name.as_py(), at, own[at:at + n], whole))
                    tokens, at = tokens + n, at + n
                    if tokens == pool_tokens:
                        yield flush()
                        held, tokens = [], 0
        if held:
            yield flush()

    from .tables import _arrow
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "tier", "step_group"]
    types = [_arrow(docs.schema["doc_id"].dataType), *[pa.int64()] * 6, pa.int32(), pa.int64()]
    return doc_texts(docs).mapInArrow(
        run, f"doc_id {ids}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
             "tier int, step_group long")
