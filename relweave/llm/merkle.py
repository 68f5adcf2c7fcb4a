"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and an authentication path for every document by fractal traversal."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.llm.common import stored, tidied

#: Nodes in a run, which become one node of the next level.
RUN = 16
#: Levels of the tree below a block's root: an aligned block has RUN**BLOCK_LEVELS leaves at most.
BLOCK_LEVELS = 3
#: Leaves whose paths are sent at once.
PATHS_AT_ONCE = 256

PATH = "array<struct<left:string,right:string>>"


def hashed(text: Column) -> Column:
    """Lower-case hex sha256 of a text's UTF-8 bytes."""
    return F.sha2(text.cast("binary"), 256)


def field(value: Column) -> Column:
    """A value with its length in UTF-8 bytes before it; `-` if null. Two rows have the same fields only if their values are the same."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return hashed(F.concat(*map(field, values)))


def ranked(rows: DataFrame, by: list[str], within: str | None) -> DataFrame:
    """rows (stored) with `rank`: the number of rows before each, among those with the same `within` (null is a value), in the order of `by`; rows that are equal in all of them stand in any order.

    Rows are dealt out by ranges of (within, by) and written in order, with their places in their tasks; each task's first place and number of rows of each `within` then give the rest. A hot `within` is so many ranges as it needs, and no window holds its rows."""
    order = [*([within] if within else []), *by]
    # Equal rows are told apart, so that a range can end among them.
    placed = rows.withColumn("_tie", F.xxhash64(F.monotonically_increasing_id()))
    placed = placed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie").drop("_tie").withColumn("_place", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("_task", F.shiftright("_place", 33)), "ranges")
    key = F.col(within) if within else F.lit(None).cast("string")
    tasks = placed.groupBy(key.alias("_w"), F.col("_task").alias("_t")).agg(F.min("_place").alias("_first"), F.count("*").alias("_n"))
    # A row for each task and value of `within` in it, about as many as tasks.
    before = F.coalesce(F.sum("_n").over(W.partitionBy("_w").orderBy("_t").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    tasks = stored(tasks.withColumn("_before", before), "tasks")
    met = placed.join(tasks, key.eqNullSafe(F.col("_w")) & (F.col("_task") == F.col("_t")))
    return met.withColumn("rank", F.col("_place") - F.col("_first") + F.col("_before")).drop("_place", "_task", "_w", "_t", "_first", "_n", "_before")


class Fractal:
    """Successive authentication paths of one block's leaves.

    Each level of the block has an existing subtree: the run of nodes beside the current leaf's ancestor. While leaves pass, the run that comes after it on that level is made piece by piece - its desired subtree - so that it is whole when the traversal gets there, and takes the existing one's place. At any time a level has two runs of nodes, however many leaves the block has; inner nodes are made from the leaves when they are wanted, each once for the first runs and once for the desired ones."""

    def __init__(self, leaves: list[str], levels: int) -> None:
        self.leaves, self.levels, self.at = leaves, levels, 0
        self.existing = [self._run(level, 0) for level in range(levels)]
        self.desired: list[list[str]] = [[] for _ in range(levels)]

    def _size(self, level: int) -> int:
        """Nodes of a level."""
        return -(-len(self.leaves) // RUN**level)

    def _node(self, level: int, k: int) -> str:
        """The k-th node of a level, from its leaves."""
        return self.leaves[k] if level == 0 else digest("".join(self._run(level - 1, k)))

    def _run(self, level: int, k: int) -> list[str]:
        return [self._node(level, i) for i in range(k * RUN, min((k + 1) * RUN, self._size(level)))]

    def root(self) -> str:
        return digest("".join(self.existing[-1])) if self.levels else self.leaves[0]

    def paths(self) -> Iterator[tuple[list[str], list[str]]]:
        """For each leaf: what stands left and right of its ancestors in their runs, level by level."""
        for t in range(len(self.leaves)):
            left, right = [], []
            for level in range(self.levels):
                run, k = self.existing[level], t // RUN**level % RUN
                left.append("".join(run[:k]))
                right.append("".join(run[k + 1 :]))
            yield left, right
            self._advance(t)

    def _advance(self, t: int) -> None:
        """Each level's desired run grows by one node for every RUN**level leaves; at a run's end it becomes the existing one."""
        for level in range(self.levels):
            step = RUN**level
            if (t + 1) % step == 0:
                k = t // (step * RUN) + 1  # the next run of this level
                i = k * RUN + t // step % RUN
                if i < self._size(level):
                    self.desired[level].append(self._node(level, i))
                if (t + 1) % (step * RUN) == 0:
                    self.existing[level], self.desired[level] = self.desired[level], []


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def levels_of(n: int) -> int:
    """Levels above n nodes until one remains."""
    levels = 0
    while n > 1:
        n, levels = -(-n // RUN), levels + 1
    return levels


def _blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[str]]]:
    """Of batches in the order of source, block and rank: each block's rows and leaves."""
    held: list[pa.RecordBatch] = []
    for b in rows:
        ids = b.column("tree").to_pylist()
        blocks = b.column("block").to_pylist()
        a = 0
        for z in range(1, b.num_rows + 1):
            if z == b.num_rows or (ids[z], blocks[z]) != (ids[a], blocks[a]):
                part = b.slice(a, z - a)
                if held and (held[0].column("tree")[0].as_py(), held[0].column("block")[0].as_py()) != (ids[a], blocks[a]):
                    yield held, [x for h in held for x in h.column("leaf").to_pylist()]
                    held = []
                held.append(part)
                a = z
    if held:
        yield held, [x for h in held for x in h.column("leaf").to_pylist()]


def _levels(head: pa.RecordBatch, n: int) -> int:
    """A block that is its source's only one ends at its own root; blocks of larger sources all have BLOCK_LEVELS levels."""
    return head.column("full")[0].as_py() or levels_of(n)


def _roots(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held, leaves in _blocks(rows):
        root = Fractal(leaves, _levels(held[0], len(leaves))).root()
        yield pa.RecordBatch.from_arrays([pa.array([held[0].column(k)[0].as_py()], t) for k, t in (("tree", pa.int64()), ("block", pa.int64()))] + [pa.array([root])], ["tree", "block", "node"])


def _paths(keep: list[str]):
    """Each leaf's kept columns with its path below the block's root, followed by the block's own path."""

    def lists(rows: list[list[tuple[str, str]]]) -> pa.Array:
        ends = [0]
        for r in rows:
            ends.append(ends[-1] + len(r))
        flat = [x for r in rows for x in r]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array([x for x, _ in flat], pa.string()), pa.array([x for _, x in flat], pa.string())], ["left", "right"]))

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, leaves in _blocks(rows):
            # The block's own path and roots come on the row of its first leaf alone.
            head = held[0].slice(0, 1).to_pylist()[0]
            upper = [(x["left"], x["right"]) for x in head["upper"]]
            paths = Fractal(leaves, _levels(held[0], len(leaves))).paths()
            for h in held:
                for at in range(0, h.num_rows, PATHS_AT_ONCE):
                    part = h.slice(at, PATHS_AT_ONCE)
                    own = [[*zip(*next(paths), strict=True), *upper] for _ in range(part.num_rows)]
                    same = [pa.array([head[k]] * part.num_rows, pa.string()) for k in ("subroot", "root")]
                    yield pa.RecordBatch.from_arrays([*(part.column(k) for k in [*keep, "rank", "leaf"]), *same, lists(own)], [*keep, "rank", "leaf", "subroot", "root", "path"])

    return run


def _runs(nodes: DataFrame) -> DataFrame:
    """(tree, place, run): the runs of nodes (tree, place, node), at most RUN in each."""
    return nodes.groupBy("tree", F.floor(F.col("place") / RUN).alias("place")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "node"))), lambda x: x.node).alias("run"))


def reduced(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(runs of each level, top): nodes (tree, place, node) are reduced run by run until each tree has one node, which top (tree, node) has. A level is written before the next; their number is the logarithm of the largest tree's nodes."""
    levels, tops = [], []
    while True:
        nodes = stored(nodes, "nodes")
        size = nodes.groupBy("tree").agg(F.count("*").alias("n"))
        lone = stored(size.where("n = 1").select(F.col("tree").alias("t")), "lone")
        tops.append(nodes.join(lone, F.col("tree") == F.col("t")).select("tree", "node"))
        runs = stored(_runs(nodes.join(lone, F.col("tree") == F.col("t"), "left_anti")), "runs")
        if runs.isEmpty():
            break
        levels.append(runs)
        nodes = runs.select("tree", "place", hashed(F.array_join("run", "")).alias("node"))
    top = tops[0]
    for more in tops[1:]:
        top = top.unionByName(more)
    return levels, stored(top, "tops")


def proved(levels: list[DataFrame], above: DataFrame) -> DataFrame:
    """(tree, place, path) of the first nodes of reduced(): from each to the top of its tree, followed by the path that `above` (tree, path) has for that tree. From the top down, a level at a time: a node's path is what stands beside it in its run, and then its run's own path."""
    known = above.select("tree", F.lit(0).cast("bigint").alias("place"), "path")
    for runs in reversed(levels):
        # Trees that end below this level keep their path until theirs comes.
        met = runs.join(known, ["tree", "place"]).select("tree", "place", "path", F.posexplode("run").alias("k", "node"), "run")
        side = lambda a, n: F.array_join(F.slice("run", a, n), "")
        own = F.struct(side(F.lit(1), F.col("k")).alias("left"), side(F.col("k") + 2, F.lit(RUN)).alias("right"))
        down = met.select("tree", (F.col("place") * RUN + F.col("k")).alias("place"), F.concat(F.array(own), "path").alias("path"))
        waiting = known.join(runs.select("tree").distinct(), "tree", "left_anti")
        known = stored(down.unionByName(waiting), "paths")
    return known


def manifest(leaves: DataFrame, tree: str, by: list[str], keep: list[str]) -> DataFrame:
    """keep, rank (of the leaf in its tree, from 0), leaf, subroot (of its tree), root (of all), path: a row for each row of leaves (leaf, the columns tree, by and keep).

    A tree's leaves stand in the order of `by` (nulls first; leaves equal in it by their digests), the trees in the order of their names (null first, by UTF-8 bytes). While several nodes remain, every RUN consecutive ones, the last run fewer, become the digest of their digests' texts. path: for each level up to the root, the texts of the digests left and right of the leaf's ancestor in its run; an ancestor that is alone in its run has empty ones. folded() goes that way.

    - a null tree is a tree like others; repeated rows: leaves of their own; a tree of one leaf: the leaf is its subroot; one tree: its subroot is the root; an empty table: no rows
    Leaves are ranked by ranges and their trees cut into aligned blocks, each of which one task holds at a time and traverses; upper levels are reduced and proved as tables, and reach each block with its first leaf."""
    # Stored, as dealing out by ranges reads its rows twice.
    first = ranked(stored(leaves.select(*dict.fromkeys([*keep, tree, *by, "leaf"])), "leaves"), [*by, "leaf"], tree)
    first = stored(first, "ranked")
    names = first.groupBy(F.col(tree).alias("name")).agg(F.count("*").alias("leaves"))
    names = stored(ranked(names, ["name"], None).select("name", "leaves", F.col("rank").alias("tree")), "trees")
    size = RUN**BLOCK_LEVELS
    cut = first.join(names, F.col(tree).eqNullSafe(F.col("name"))).withColumns({"_k": F.col("tree")}).drop(*({tree} - set(keep)), "name")
    cut = cut.select(*[F.col(f"`{k}`") for k in keep], "rank", "leaf", F.col("_k").alias("tree"), F.floor(F.col("rank") / size).alias("block"), F.when(F.col("leaves") > size, BLOCK_LEVELS).alias("full"))
    dealt = lambda df: df.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    roots = dealt(cut.select("tree", "block", "full", "rank", "leaf")).mapInArrow(tidied(_roots), "tree bigint, block bigint, node string")
    levels, subroots = reduced(roots.select("tree", F.col("block").alias("place"), "node"))
    tops, root = reduced(subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"), "node"))
    above = proved(tops, root.select("tree", F.array().cast(PATH).alias("path"))).select(F.col("place").alias("tree"), "path")
    upper = proved(levels, above).select("tree", F.col("place").alias("block"), F.col("path").alias("upper"))
    roots_of = subroots.select("tree", F.col("node").alias("subroot"), F.lit(0).cast("bigint").alias("zero")).join(root.select(F.col("tree").alias("zero"), F.col("node").alias("root")), "zero").drop("zero")
    upper = stored(upper.join(roots_of, "tree").withColumn("rank", F.col("block") * size), "upper")
    met = cut.join(upper, ["tree", "block", "rank"], "left")
    kinds = ", ".join(f"`{k}` {leaves.schema[k].dataType.simpleString()}" for k in keep)
    return dealt(met).mapInArrow(tidied(_paths(keep)), f"{kinds}, rank bigint, leaf string, subroot string, root string, path {PATH}")


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and a path give."""
    return F.aggregate(path, start, lambda node, side: hashed(F.concat(side.left, node, side.right)))


def siblings(path: Column) -> Column:
    """All digests of a path as one text, level by level and from left to right."""
    return F.array_join(F.transform(path, lambda side: F.concat(side.left, side.right)), "")
