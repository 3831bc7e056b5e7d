"""Merkle manifest of a dataset as a postorder append log.

Every source is a tree over its leaves in order of ``doc_id``: three consecutive nodes, the last run
fewer, become one node, level by level, until one remains. The sources' roots form a last tree of the
same kind. *Aligned builders* make the log: a task takes ``3 ** BLOCK_LEVELS`` consecutive leaves, so that
all of their subtree is its own, and writes each node as soon as its last leaf is there. The roots of
such blocks are the leaves of the next layer of builders, so nothing but blocks of that size is ever
held at once, whatever the size of a source.

Completion order is postorder. A node's place in it follows from sizes of subtrees alone (`position`):
what ends before its first leaf, and what lies below it. A block's log is one row, digests of equal
width one behind the other, so the siblings of a leaf are cut out of it by their places and no search
or index is needed. `proofs` walks the layers from the root down and hands each block the path above it.

Ranks within a source come from a range exchange and counts per partition, so a source with a third of
all rows is dealt over as many tasks as the range exchange has partitions.

Rows: ``doc_id`` NULL sorts first; rows of equal ``doc_id`` are ordered by their leaf, equal rows are
leaves of their own. A NULL source is a source. A row with a NULL ``doc_id`` is never tampered with.
An empty table has no root and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from hashlib import sha256
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from tidemark.llm.common import group_of, stored

RUN = 3
BLOCK_LEVELS = 6
_WIDTH = 32
_SEGMENT = pa.schema(
    [
        ("part", pa.string()),
        ("block", pa.int64()),
        ("total", pa.int64()),
        ("leaves", pa.int64()),
        ("size", pa.int32()),
        ("nodes", pa.binary()),
        ("ids", pa.list_(pa.int64())),
        ("changed", pa.list_(pa.binary())),
    ]
)
_PATH = pa.schema(
    [("part", pa.string()), ("block", pa.int64()), ("path", pa.binary()), ("root", pa.binary())]
)
_LOG = pa.schema(
    [("part", pa.string()), ("place", pa.int64()), ("level", pa.int32()), ("digest", pa.string())]
)
_PROOF = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("source", pa.string()),
        ("place", pa.int64()),
        ("leaf", pa.string()),
        ("subroot", pa.string()),
        ("proof_sha256", pa.string()),
        ("folded_root", pa.string()),
    ]
)


def node_of(children: list[bytes]) -> bytes:
    """H of a run: sha256 over the digests as hex text."""
    return sha256("".join(c.hex() for c in children).encode()).digest()


def height_of(leaves: int) -> int:
    """Levels above the leaves of a tree."""
    height = 0
    while RUN**height < leaves:
        height += 1
    return height


def position(level: int, index: int, leaves: int) -> int:
    """Place, from 0, of a node in the postorder log of a tree with so many leaves.

    Before it stand the nodes that end before its first leaf, one in ``3 ** j`` leaves for every level
    ``j``, and the nodes below it, of which each level has a third of the one before, rounded up.
    """
    first = index * RUN**level
    below = min(RUN**level, leaves - first)
    ended, j = 0, first
    while j:
        ended += j
        j //= RUN
    return ended + sum(-(-below // RUN**j) for j in range(level + 1)) - 1


def append_log(leaves: list[bytes], height: int) -> list[bytes]:
    """All nodes of a tree of ``height`` levels in the order in which they are complete."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(height + 1)]

    def append(level: int, node: bytes) -> None:
        log.append(node)
        open_runs[level].append(node)
        if level < height and len(open_runs[level]) == RUN:
            close(level)

    def close(level: int) -> None:
        node = node_of(open_runs[level])
        open_runs[level].clear()
        append(level + 1, node)

    for leaf in leaves:
        append(0, leaf)
    for level in range(height):
        if open_runs[level]:
            close(level)
    return log


Step = tuple[int, list[bytes]]


def siblings(nodes: bytes, leaf: int, leaves: int, height: int) -> Iterator[Step]:
    """Per level, a node's number in its run and the run's other nodes, out of the block's log."""
    index, width = leaf, leaves
    for level in range(height):
        first = index - index % RUN
        others = []
        for other in range(first, min(first + RUN, width)):
            if other != index:
                at = position(level, other, leaves) * _WIDTH
                others.append(nodes[at : at + _WIDTH])
        yield index - first, others
        index, width = index // RUN, -(-width // RUN)


def fold(node: bytes, steps: list[Step]) -> bytes:
    """The root that a node and its siblings give."""
    for number, others in steps:
        node = node_of([*others[:number], node, *others[number:]])
    return node


def packed(steps: list[Step]) -> bytes:
    return b"".join(bytes([number, len(others)]) + b"".join(others) for number, others in steps)


def unpacked(path: bytes) -> list[Step]:
    steps, at = [], 0
    while at < len(path):
        number, others = path[at], path[at + 1]
        at += 2
        steps.append((number, [path[at + i * _WIDTH : at + (i + 1) * _WIDTH] for i in range(others)]))
        at += others * _WIDTH
    return steps


def _field(value: Column) -> Column:
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaves_of(docs: DataFrame) -> DataFrame:
    """``part`` (the source), ``id``, ``leaf`` and, where the row is tampered with, ``changed``."""

    def leaf(text: Column) -> Column:
        values = [F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text]
        return F.unhex(F.sha2(F.concat(*map(_field, values)), 256))

    tampered = leaf(F.translate("text", "\n", ""))
    return docs.select(
        F.col("source").alias("part"),
        F.col("doc_id").cast("bigint").alias("id"),
        leaf(F.col("text")).alias("leaf"),
        F.when(group_of(F.col("doc_id"), 2) == 0, tampered).alias("changed"),
    )


def ranked(rows: DataFrame, order: list[str], label: str) -> DataFrame:
    """``rank`` of each row within its ``part``, from 0, and ``total``, the rows of the part.

    A range exchange puts rows in order over all partitions; where a part runs over several, the counts
    before a partition are added. The table of counts has a row per part and per partition.
    """
    dealt = rows.repartitionByRange("part", *order).sortWithinPartitions("part", *order)
    placed = stored(
        dealt.select("*", F.spark_partition_id().alias("piece"), F.monotonically_increasing_id().alias("row")),
        label,
    )
    runs = placed.groupBy("part", "piece").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    part = Window.partitionBy("part")
    before = part.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("part").alias("of"),
        F.col("piece").alias("in_piece"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(part).alias("total"),
    )
    same = F.col("part").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("in_piece"))
    return placed.join(runs, same).select(
        *rows.columns, (F.col("row") + F.col("shift")).alias("rank"), "total"
    )


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(n).to_pylist() for n in names))


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, f.type) for column, f in zip(zip(*held), schema)], schema=schema
        )

    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield batch()
            held = []
    if held:
        yield batch()


def _map(df: DataFrame, rows, schema: pa.Schema, at_once: int) -> DataFrame:
    """What the generator ``rows`` makes of the Arrow batches of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _in_batches(rows(batches), schema, at_once)

    return df.mapInArrow(run, from_arrow_schema(schema))


def build_layer(leaves: DataFrame, levels: int, label: str) -> DataFrame:
    """One row per block of ``3 ** levels`` leaves: the log of its subtree and what hangs on its leaves."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        rows = _rows(batches, "part", "block", "total", "leaves", "leaf", "id", "changed")
        for (part, block, total, leaves), group in groupby(rows, lambda r: r[:4]):
            digests, ids, changed = zip(*(r[4:] for r in group))
            log = append_log(list(digests), min(levels, height_of(total)))
            yield part, block, total, leaves, len(ids), b"".join(log), ids, changed

    aligned = leaves.withColumn("block", F.expr(f"rank div {RUN**levels}"))
    dealt = aligned.repartition("part", "block").sortWithinPartitions("part", "block", "rank")
    columns = dealt.select("part", "block", "total", "leaves", "leaf", "id", "changed")
    return stored(_map(columns, blocks, _SEGMENT, 64), label)


def _last_node() -> Column:
    return F.expr(f"substring(nodes, length(nodes) - {_WIDTH - 1}, {_WIDTH})")


@dataclass(frozen=True)
class Forest:
    """Trees of all parts, as layers of blocks of ``levels`` levels from the leaves up."""

    layers: list[DataFrame]
    levels: int

    @property
    def span(self) -> int:
        return RUN**self.levels

    def roots(self) -> DataFrame:
        """``part`` and ``root``: the last node of a block that has all of its layer's nodes."""
        whole = (x.filter(F.col("total") <= self.span) for x in self.layers)
        return reduce(DataFrame.unionByName, (x.select("part", _last_node().alias("root")) for x in whole))

    def log(self) -> DataFrame:
        """The postorder log: ``part``, ``place`` from 0, ``level`` and the node's ``digest`` in hex.

        Blocks above the first layer begin with the roots below them, which are left out.
        """
        rows = (_map(x, _log_rows(k, self.levels), _LOG, 5000) for k, x in enumerate(self.layers))
        return reduce(DataFrame.unionByName, rows)


def _log_rows(layer: int, levels: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        names = ("part", "block", "total", "leaves", "size", "nodes")
        for part, block, total, leaves, size, nodes in _rows(batches, *names):
            for level in range(1 if layer else 0, min(levels, height_of(total)) + 1):
                for i in range(-(-size // RUN**level)):
                    at = position(level, i, size) * _WIDTH
                    index = block * RUN ** (levels - level) + i
                    place = position(layer * levels + level, index, leaves)
                    yield part, place, layer * levels + level, nodes[at : at + _WIDTH].hex()

    return rows


def build(leaves: DataFrame, levels: int, label: str) -> Forest:
    """Layers of blocks over ranked leaves (``part``, ``rank``, ``total``, ``leaf``, ``id``, ``changed``).

    The number of layers follows from the largest part, the only value the driver reads.
    """
    span = RUN**levels
    layers = [build_layer(leaves.withColumn("leaves", F.col("total")), levels, f"{label}-0")]
    most = layers[0].agg(F.max("total")).first()[0] or 0
    while most > span:
        most = -(-most // span)
        tops = layers[-1].filter(F.col("total") > span).select(
            "part",
            F.col("block").alias("rank"),
            F.expr(f"(total + {span - 1}) div {span}").alias("total"),
            "leaves",
            _last_node().alias("leaf"),
            F.lit(None).cast("bigint").alias("id"),
            F.lit(None).cast("binary").alias("changed"),
        )
        layers.append(build_layer(tops, levels, f"{label}-{len(layers)}"))
    return Forest(layers, levels)


def _with_paths(segments: DataFrame, above: DataFrame) -> DataFrame:
    """Segments with the ``path`` above their block and the ``root`` of their part."""
    over = above.select(F.col("part").alias("of"), F.col("block").alias("of_block"), "path", "root")
    same = F.col("part").eqNullSafe(F.col("of")) & (F.col("block") == F.col("of_block"))
    return segments.join(over, same).drop("of", "of_block")


def _paths_below(levels: int):
    """The paths of a block's leaves: their siblings in the block, then the block's own path."""
    names = ("part", "block", "total", "size", "nodes", "path", "root")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, block, total, size, nodes, path, root in _rows(batches, *names):
            height = min(levels, height_of(total))
            for i in range(size):
                steps = siblings(nodes, i, size, height)
                yield part, block * RUN**levels + i, packed(list(steps)) + path, root

    return rows


def block_paths(forest: Forest, tops: DataFrame, label: str) -> DataFrame:
    """``part``, ``block``, ``path`` and ``root`` for each block of the first layer, from the top down.

    ``tops`` has what lies above each part (``part``, ``path``, ``root``). A layer's paths are one row
    per node at the bottom of it, a small share of the rows of the layer below.
    """
    over_roots = tops.select("part", F.lit(0).cast("bigint").alias("block"), "path", "root")
    above = None
    for number in range(len(forest.layers) - 1, -1, -1):
        layer = forest.layers[number]
        here = _with_paths(layer.filter(F.col("total") <= forest.span).select("part", "block"), over_roots)
        if above is not None:
            here = here.unionByName(above)
        if number == 0:
            return here
        below = _map(_with_paths(layer, here), _paths_below(forest.levels), _PATH, 1000)
        above = stored(below, f"{label}-{number}")


def _proof_rows(levels: int):
    names = ("part", "block", "total", "size", "nodes", "ids", "changed", "path", "root")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for part, block, total, size, nodes, ids, changed, path, root in _rows(batches, *names):
            height = min(levels, height_of(total))
            above = unpacked(path)
            above_hex = _hex(above)
            folded: dict[bytes, str] = {}
            for i in range(size):
                at = position(0, i, size) * _WIDTH
                leaf = nodes[at : at + _WIDTH]
                steps = list(siblings(nodes, i, size, height))
                proof = sha256(_hex(steps) + above_hex).hexdigest()
                top = fold(changed[i] or leaf, steps)
                if top not in folded:  # most leaves of a block lead to the same node
                    folded[top] = fold(top, above).hex()
                place = block * RUN**levels + i
                yield ids[i], part, place, leaf.hex(), root.hex(), proof, folded[top]

    return rows


def _hex(steps: list[Step]) -> bytes:
    return b"".join(other for _, others in steps for other in others).hex().encode()


@dataclass(frozen=True)
class Manifest:
    """Trees of the sources, the tree of their roots, and the root of all (None without rows).

    ``numbered`` has each source's place among the leaves of the last tree.
    """

    sources: Forest
    top: Forest
    numbered: DataFrame
    root: str | None


def manifest(docs: DataFrame, levels: int = BLOCK_LEVELS) -> Manifest:
    """Build the logs of all sources and of the tree above them, in blocks of ``3 ** levels`` leaves."""
    leaves = stored(leaves_of(docs), "merkle-leaves")
    sources = build(ranked(leaves, ["id", "leaf"], "merkle-ranked"), levels, "merkle-log")
    roots = stored(
        sources.roots().select(
            F.lit("").alias("part"),
            F.col("part").alias("source"),
            F.col("root").alias("leaf"),
            F.lit(None).cast("bigint").alias("id"),
            F.lit(None).cast("binary").alias("changed"),
        ),
        "merkle-subroots",
    )
    numbered = stored(ranked(roots, ["source"], "merkle-sources"), "merkle-numbered")
    top = build(numbered.drop("source"), levels, "merkle-top")
    found = top.roots().first()
    return Manifest(sources, top, numbered, None if found is None else bytes(found.root).hex())


def source_paths(made: Manifest) -> DataFrame:
    """``part`` (the source), ``path`` from its root to the root of all, ``root`` (the source's)."""
    spark = made.numbered.sparkSession
    nothing = F.lit("").cast("binary")
    summit = spark.range(1).select(F.lit("").alias("part"), nothing.alias("path"), nothing.alias("root"))
    blocks = _with_paths(made.top.layers[0], block_paths(made.top, summit, "merkle-top-paths"))
    paths = _map(blocks, _paths_below(made.top.levels), _PATH, 1000).select("block", "path")
    return made.numbered.join(paths, F.col("rank") == F.col("block")).select(
        F.col("source").alias("part"), "path", F.col("leaf").alias("root")
    )


def proofs(docs: DataFrame, levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per document: its leaf, its source's root, the root of all, and its proof.

    ``proof_sha256`` is H of the siblings from the leaf up. ``folded_root`` is folded from the leaf that
    was tampered with, or else the leaf itself, and the original siblings; ``place`` is the leaf's rank.
    """
    made = manifest(docs, levels)
    tops = stored(source_paths(made), "merkle-source-paths")
    above = block_paths(made.sources, tops, "merkle-paths")
    rows = _map(_with_paths(made.sources.layers[0], above), _proof_rows(levels), _PROOF, 5000)
    root = F.lit(made.root).cast("string")
    return rows.select(
        "doc_id", "source", "place", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
