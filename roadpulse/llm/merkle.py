"""Merkle manifest of a dataset: one tree per source, one tree over their roots.

Nodes live in a postorder append log: a builder takes leaves in order and
appends a node the moment its run of three is complete. Builders are aligned –
one has ``3**SPAN`` consecutive leaves, a complete subtree unless it is the
last – so each writes its own segment of the log and their top nodes are the
leaves of the next round of builders. A node's place follows from subtree sizes
alone: before leaf i lie as many complete subtrees of each height as the digits
of i in base three say, and a node directly follows its last leaf and the lower
nodes that end there. Proof extraction addresses siblings in the log that way;
nothing is searched, and no task or driver holds more than a segment.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

#: Nodes that become one.
RUN = 3
#: Levels that one builder completes: it has at most RUN ** SPAN leaves.
SPAN = 7
#: Characters of a hex digest, bytes of a stored one.
_HEX, _RAW = 64, 32

_PATH = "array<struct<left:string,right:string>>"


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h, width = 0, 1
    while width < n:
        h, width = h + 1, width * RUN
    return h


def subtree_size(h: int) -> int:
    """Nodes of a complete subtree of that height."""
    return (RUN ** (h + 1) - 1) // (RUN - 1)


def leaf_position(i: int) -> int:
    """Place of leaf ``i`` in the log: the complete subtrees before it, by the digits of ``i``."""
    at, h = 0, 0
    while i:
        at += i % RUN * subtree_size(h)
        i, h = i // RUN, h + 1
    return at


def position(level: int, index: int, n: int) -> int:
    """Place of a node in the log of a tree with ``n`` leaves; its last run may be short."""
    return leaf_position(min((index + 1) * RUN ** level, n) - 1) + level


def siblings(level: int, index: int, n: int) -> tuple[list[int], list[int]]:
    """Indexes of the run's others, before and after a node."""
    first = index - index % RUN
    width = -(-n // RUN ** level)
    return list(range(first, index)), list(range(index + 1, min(first + RUN, width)))


def join(digests: list[bytes]) -> bytes:
    """Hex digest, as bytes, of hex digests."""
    return hashlib.sha256(b"".join(digests)).hexdigest().encode()


def append_log(leaves: list[bytes], levels: int) -> list[bytes]:
    """Nodes over ``leaves`` in the order in which they are completed, ``levels`` levels high."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def done(level: int, digest: bytes) -> None:
        log.append(digest)
        if level < levels:
            waiting[level].append(digest)
            if len(waiting[level]) == RUN:
                close(level)

    def close(level: int) -> None:
        run, waiting[level] = waiting[level], []
        done(level + 1, join(run))

    for leaf in leaves:
        done(0, leaf)
    for level in range(levels):
        if waiting[level]:
            close(level)
    return log


def _field(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Leaf of a row of documents that holds ``text``, 32 bytes."""
    head = [_field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    return F.unhex(F.sha2(F.concat(*head, _field(text)), 256))


def numbered(rows: DataFrame, tree: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` in order, stored with their place ``at``; and per part of a tree: first ``at``, leaf before it, leaves of the tree.

    A range partitioning deals the order out, so a tree with a third of all
    rows lies in many parts; only the parts' counts are summed up.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    laid = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("at", F.monotonically_increasing_id()), name)
    parts = laid.groupBy(F.shiftright("at", 33).alias("part"), F.col(tree).alias("part_tree")).agg(
        F.min("at").alias("first"), F.count("*").alias("own"))
    whole = Window.partitionBy("part_tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return laid, parts.select("part", "part_tree", "first", F.coalesce(F.sum("own").over(before), F.lit(0)).alias("before"),
                              F.sum("own").over(whole).alias("n"))


def with_numbers(laid: DataFrame, parts: DataFrame, tree: str) -> DataFrame:
    both = (F.shiftright(laid["at"], 33) == parts["part"]) & laid[tree].eqNullSafe(parts["part_tree"])
    return laid.join(parts, both).withColumn("leaf_no", F.col("at") - F.col("first") + F.col("before")).drop(
        "at", "first", "before", "part", "part_tree")


def build_round(nodes: DataFrame, payload: list[str], name: str, span: int) -> DataFrame:
    """One round of builders: tree, block, n, members (in order), log (digests in postorder) and top of each block.

    ``nodes`` has tree, leaf_no, n (leaves of the tree) and digest.
    """
    members = F.sort_array(F.collect_list(F.struct("leaf_no", "digest", *payload)))  # at most RUN ** span of them
    blocks = nodes.groupBy("tree", F.expr(f"leaf_no div {RUN ** span}").alias("block")).agg(
        F.max("n").alias("n"), members.alias("members"))
    kind = blocks.schema["members"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            logs, tops = [], []
            for members, n in zip(batch.column("members"), batch.column("n").to_pylist()):
                leaves = [d.hex().encode() for d in members.values.field("digest").to_pylist()]
                log = append_log(leaves, min(span, height(n)))
                logs.append(bytes.fromhex(b"".join(log).decode()))
                tops.append(logs[-1][-_RAW:])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("tree", "block", "n", "members")), pa.array(logs, pa.binary()), pa.array(tops, pa.binary())],
                ["tree", "block", "n", "members", "log", "top"])
    return stored(blocks.mapInArrow(run, f"tree long, block long, n long, members {kind}, log binary, top binary"), name)


def build_rounds(nodes: DataFrame, payload: list[str], name: str, span: int) -> list[DataFrame]:
    """Rounds of builders until every tree has one top node."""
    most = nodes.agg(F.max("n")).first()[0] or 1
    block = RUN ** span
    rounds = [build_round(nodes, payload, name, span)]
    while (most := -(-most // block)) > 1:
        above = rounds[-1].select("tree", F.col("block").alias("leaf_no"), F.expr(f"(n + {block - 1}) div {block}").alias("n"),
                                  F.col("top").alias("digest"))
        rounds.append(build_round(above, [], f"{name}-{len(rounds)}", span))
    return rounds


@dataclass(frozen=True)
class Manifest:
    """Logs of the sources' trees, lowest round first, of the tree over them, and the root (None without rows).

    Members of the lowest round hold doc_id and, where the row is now another, its leaf as ``claimed``.
    """
    sources: list[DataFrame]
    forest: list[DataFrame]
    root: str | None
    span: int = SPAN


def build(docs: DataFrame, claimed: Column | None = None, span: int = SPAN) -> Manifest:
    """Manifest of ``docs``; ``claimed`` is the text a row is claimed to hold by now, if that is another.

    Leaves of a source ascend by doc_id, null first; rows of equal id by their
    leaf. Null sources are a source of their own, before all others. Columns
    other than doc_id, source, lang, n_chars and text have no part in it.
    """
    text = F.col("text")
    leaf = leaf_digest(text)
    other = F.lit(None).cast("binary") if claimed is None else F.when(~claimed.eqNullSafe(text), leaf_digest(claimed))
    leaves = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                                leaf.alias("digest"), other.alias("claimed")), "leaves")
    laid, parts = numbered(leaves, "source", ["doc_id", "digest"], "ordered-leaves")
    parts = stored(parts, "leaf-parts")
    all_sources, ordered = numbered(parts.select("part_tree").distinct().select(F.lit(0).alias("all"), F.col("part_tree").alias("source")),
                                    "all", ["source"], "ordered-sources")
    trees = stored(with_numbers(all_sources, ordered, "all"), "sources").select(
        F.col("source").alias("tree_source"), F.col("leaf_no").alias("tree"), F.col("n").alias("trees"))
    parts = parts.join(trees, parts["part_tree"].eqNullSafe(trees["tree_source"])).drop("tree_source")
    nodes = with_numbers(laid, parts, "source")
    sources = build_rounds(nodes.select("tree", "leaf_no", "n", "digest", "doc_id", "claimed"), ["doc_id", "claimed"], "source-log", span)
    subroots = sources[-1].select("tree", "top").join(trees, "tree").select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("leaf_no"), F.col("trees").alias("n"), F.col("top").alias("digest"))
    forest = build_rounds(subroots, [], "forest-log", span)
    top = forest[-1].select("top").first()
    return Manifest(sources, forest, top[0].hex() if top else None, span)


class Segment:
    """A builder's segment of the log, read at closed-form positions."""

    def __init__(self, log: bytes, members: int, levels: int):
        self.hex, self.members, self.levels = log.hex().encode(), members, levels
        self.sides: dict[tuple[int, int], tuple[bytes, bytes]] = {}

    def digest(self, level: int, index: int) -> bytes:
        at = _HEX * position(level, index, self.members)
        return self.hex[at:at + _HEX]

    def path(self, leaf: int) -> list[tuple[bytes, bytes]]:
        """Siblings left and right, level by level up to the segment's top."""
        out = []
        for level in range(self.levels):
            side = self.sides.get((level, leaf))
            if side is None:
                left, right = siblings(level, leaf, self.members)
                side = self.sides[level, leaf] = tuple(
                    b"".join(self.digest(level, i) for i in x) for x in (left, right))
            out.append(side)
            leaf //= RUN
        return out


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """Root that a leaf and its siblings give."""
    for left, right in path:
        leaf = hashlib.sha256(left + leaf + right).hexdigest().encode()
    return leaf


def proof_digest(path: list[tuple[bytes, bytes]]) -> str:
    return hashlib.sha256(b"".join(a + b for a, b in path)).hexdigest()


def _segments(batches: Iterator[pa.RecordBatch], span: int) -> Iterator[tuple[Segment, dict, pa.StructArray]]:
    """Per block: its segment, the path above it with its subroot, and its members."""
    names = ("n", "log", "path", "subroot", "top", "tree")
    for batch in batches:
        for at in range(batch.num_rows):
            own = {c: batch.column(c)[at].as_py() for c in names}
            members = batch.column("members")[at].values
            own["path"] = [(x["left"].encode(), x["right"].encode()) for x in own["path"] or ()]
            own["subroot"] = own["subroot"] or own["top"].hex()
            yield Segment(own["log"], len(members), min(span, height(own["n"]))), own, members


def _below(blocks: DataFrame, paths: DataFrame | None, by_tree: bool) -> DataFrame:
    """Blocks with the path above their top, and the subroot where that is known."""
    if paths is None:
        return blocks.select("*", F.lit(None).cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    if by_tree:
        return blocks.join(paths.select(F.col("leaf_no").alias("tree"), "path", F.lit(None).cast("string").alias("subroot")), "tree")
    return blocks.join(paths.select("tree", F.col("leaf_no").alias("block"), "path", "subroot"), ["tree", "block"])


def paths_of(blocks: DataFrame, span: int) -> DataFrame:
    """tree, leaf_no, path, subroot of every member of blocks that have their own path."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, own, members in _segments(batches, span):
            found = [[{"left": a.decode(), "right": b.decode()} for a, b in segment.path(i) + own["path"]] for i in range(len(members))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([own["tree"]] * len(members), pa.int64()), members.field("leaf_no"),
                 pa.array(found, pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))),
                 pa.array([own["subroot"]] * len(members), pa.string())],
                ["tree", "leaf_no", "path", "subroot"])
    return blocks.mapInArrow(run, f"tree long, leaf_no long, path {_PATH}, subroot string")


def located(manifest: Manifest) -> DataFrame:
    """The lowest blocks with the path from their top over the subroot to the root."""
    paths = None
    for blocks in reversed(manifest.forest):
        paths = stored(paths_of(_below(blocks, paths, by_tree=False), manifest.span), "paths")
    by_tree = True
    for blocks in reversed(manifest.sources[1:]):
        paths = stored(paths_of(_below(blocks, paths, by_tree), manifest.span), "paths")
        by_tree = False
    return _below(manifest.sources[0], paths, by_tree)


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, path (siblings left and right, level by level) of every row."""
    rows = paths_of(located(manifest), manifest.span)
    leaves = manifest.sources[0].select("tree", F.explode("members").alias("m")).select(
        "tree", "m.leaf_no", "m.doc_id", F.lower(F.hex("m.digest")).alias("leaf"))
    return leaves.join(rows, ["tree", "leaf_no"]).select("doc_id", "leaf", "subroot", "path")


def audit(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, one row per row of the documents.

    folded_root is what the claimed leaf (the leaf itself, where nothing else is
    claimed) gives with the siblings of the manifest; verified tells whether
    that is the root. A lone row is its own subroot, and a lone subroot the
    root; their proof is the digest of nothing. An empty table gives no rows.
    """
    root, span = manifest.root, manifest.span
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for segment, own, members in _segments(batches, span):
            n = len(members)
            leaves = [d.hex() for d in members.field("digest").to_pylist()]
            claimed = [d.hex() if d is not None else leaf for d, leaf in zip(members.field("claimed").to_pylist(), leaves)]
            found = [segment.path(i) + own["path"] for i in range(n)]
            folded = [fold(c.encode(), p).decode() for c, p in zip(claimed, found)]
            yield pa.RecordBatch.from_arrays(
                [members.field("doc_id"), pa.array(leaves, pa.string()), pa.array([own["subroot"]] * n, pa.string()),
                 pa.array([root] * n, pa.string()), pa.array([proof_digest(p) for p in found], pa.string()),
                 pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())], names)
    return located(manifest).mapInArrow(run, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
                                             "folded_root string, verified boolean")


def without_breaks(docs: DataFrame) -> Column:
    """Text of the documents whose id has an even crc32, without its line breaks; the others' as it is."""
    even = F.crc32(docs["doc_id"].cast("string")) % 2 == 0
    return F.when(F.coalesce(even, F.lit(False)), F.replace(docs["text"].cast("string"), F.lit("\n"), F.lit(""))).otherwise(docs["text"])


def manifest_digests(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """Digest columns of a manifest and of the audit of rows that were tampered with."""
    return audit(build(docs, without_breaks(docs), span))
