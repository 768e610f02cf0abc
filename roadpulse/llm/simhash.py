"""SimHash near-duplicates over a byte-position inverted index with count filtering.

Two 64-bit fingerprints that differ in at most four bits share at least four of
their eight bytes in place. The index therefore posts each fingerprint under
every choice of four byte positions and the bytes there: a pair under a common
posting has that many matches, and a pair without one can't be near. Within a
posting the shared positional bytes are tallied, pairs below the guaranteed
number are dropped and the rest is verified bit by bit. Links form a tree per
posting, never all pairs, and equal fingerprints are one node.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import doc_texts, map_batches, stored
from .words import LOWER

SHINGLE = 4
SEED = 42
MOST_BITS = 4
#: Matches that two fingerprints within MOST_BITS are sure to have.
LEAST_BYTES = 8 - MOST_BITS
#: Postings above this length are linked over midpoints, task by task, rather than in one.
LONG_POSTING = 1 << 16

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_LOWER = LOWER.tobytes()


def fingerprint(text: bytes) -> int:
    """Majority bits of the XXH64 values of the text's shingles; 0 without words."""
    parts = text.translate(_LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)
    k = min(SHINGLE, len(parts))
    n, ones = len(parts) - k + 1, np.zeros((8, 256), np.int64)
    for lo in range(0, n, 1 << 16):
        hi = min(n, lo + (1 << 16))
        h = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                         zip(starts[lo:hi].tolist(), ends[lo + k - 1:hi + k - 1].tolist())), np.uint64, hi - lo)
        places = h.view(np.uint8).reshape(-1, 8) + np.arange(8, dtype=np.int64) * 256
        ones += np.bincount(places.ravel(), minlength=2048).reshape(8, 256)
    majority = (2 * (ones @ _BITS) > n).ravel()
    return int(np.packbits(majority, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and its fingerprint as a long."""
    def run(batch: pa.RecordBatch):
        found = np.fromiter((fingerprint(t.as_buffer().to_pybytes()) for t in batch.column("text").cast(pa.binary())),
                            np.uint64, batch.num_rows)
        yield {"doc_id": batch.column("doc_id"), "fp": pa.array(found.view(np.int64))}
    return map_batches(doc_texts(docs).withColumn("doc_id", F.col("doc_id").cast("bigint")), run, "doc_id long, fp long")


def postings(prints: DataFrame) -> DataFrame:
    """(posting, fp): each fingerprint under every choice of LEAST_BYTES of its positional bytes."""
    masks = []
    for n, places in enumerate(combinations(range(8), LEAST_BYTES)):
        mask = sum(0xFF << (8 * p) for p in places)
        masks.append(F.struct(F.lit(n).alias("n"), F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint").alias("mask")))
    chosen = prints.select("fp", F.explode(F.array(*masks)).alias("x"))
    return chosen.select(F.xxhash64(F.col("x.n"), F.col("fp").bitwiseAND(F.col("x.mask"))).alias("posting"), "fp")


def near(fp: np.uint64, others: np.ndarray) -> np.ndarray:
    """Which of ``others`` reach the guaranteed matches with ``fp`` and differ in few enough bits."""
    x = others ^ fp
    tally = (x.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
    return (tally >= LEAST_BYTES) & (np.bitwise_count(x) <= MOST_BITS)


def tree(fps: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what is near within one posting: a tree for each group."""
    links, rest, todo = [], fps[1:], [fps[0]]
    while len(rest):
        if not todo:
            todo, rest = [rest[0]], rest[1:]
            continue
        at = todo.pop()
        found = near(at, rest)
        if found.any():
            new = rest[found]
            links += [(at, x) for x in new]
            todo += list(new)
            rest = rest[~found]
    return links


def link(prints: DataFrame, long_posting: int = LONG_POSTING) -> DataFrame:
    """(a, b): links between distinct fingerprints whose closure is that of all near pairs."""
    def run(batches):
        held_key, held, long_key = None, np.zeros(0, np.uint64), None
        for batch in batches:
            key = batch.column("posting").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            if len(held):
                key, fp = np.append(np.full(len(held), held_key), key), np.append(held, fp)
            first = np.append(0, np.flatnonzero(key[1:] != key[:-1]) + 1) if len(key) else np.zeros(0, int)
            stop = np.append(first[1:], len(key))
            out: list[tuple] = []
            if len(first):
                done = stop[:-1] - first[:-1]
                for a, n in zip(first[:-1][done > 1].tolist(), done[done > 1].tolist()):
                    if key[a] == long_key:
                        out += [(x, None) for x in fp[a:a + n]]
                    else:
                        out += tree(fp[a:a + n])
                for a in first[:-1][(done == 1) & (key[first[:-1]] == long_key)] if long_key is not None else ():
                    out.append((fp[a], None))
                held_key, held = key[first[-1]], fp[first[-1]:]
                if len(held) > long_posting or held_key == long_key:
                    out += [(x, None) for x in held]
                    long_key, held = held_key, held[:0]
            if out:
                yield _links(out)
        if len(held) > 1:
            if out := tree(held):
                yield _links(out)

    schema = "a long, b long"
    dealt = postings(prints).repartition("posting").sortWithinPartitions("posting")
    found = stored(dealt.mapInArrow(run, schema).distinct(), "near")
    # what shares a midpoint, two bits from each at most, is near, and what is near shares one
    masks = [0] + [1 << i for i in range(64)] + [1 << i | 1 << j for i, j in combinations(range(64), 2)]
    middle = np.array(masks, np.uint64)

    def spread(batch: pa.RecordBatch):
        for fp in batch.column("a").to_numpy().view(np.uint64):
            yield {"a": pa.array(np.full(len(middle), fp).view(np.int64)), "b": pa.array((middle ^ fp).view(np.int64))}
    over = map_batches(found.where("b is null").select("a").repartition("a"), spread, schema)
    return found.where("b is not null").unionByName(over)


def _links(pairs: list[tuple]) -> pa.RecordBatch:
    a = np.fromiter((x for x, _ in pairs), np.uint64, len(pairs)).view(np.int64)
    b = pa.array([None if y is None else int(np.uint64(y).view(np.int64)) for _, y in pairs], pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), b], ["a", "b"])


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, one row per row of ``docs``.

    component_id is the smallest doc_id that near links reach, the document's
    own included. Words are runs without ASCII white space after A-Z are
    lower-cased; null, empty and blank texts have fingerprint 0 and are linked
    like any other. Repeated rows get a row each. A row without doc_id takes
    part; where a component has no doc_id at all component_id is null. An empty
    table gives no rows; other columns are not looked at.
    """
    prints = stored(fingerprints(docs), "fingerprints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct")
    roots = components(link(distinct.select("fp")))
    linked = stored(roots.join(distinct, roots["node"] == distinct["fp"]).select("fp", "root", "least_id"), "linked")
    least = stored(linked.groupBy("root").agg(F.min("least_id").alias("component_id")), "least")
    of = stored(linked.join(least, "root").select(F.col("fp").alias("of_fp"), "component_id"), "classes")
    classes = stored(distinct.join(of, distinct["fp"] == of["of_fp"], "left").select(
        "fp", F.coalesce("component_id", "least_id").alias("component_id")), "membership")
    return prints.join(classes, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each group, that with the smallest doc_id; all columns."""
    gone = stored(near_duplicates(docs).where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct(), "near-gone")
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone_id"]), "left_anti")
