"""Embedding near-dedup: spherical k-means cells, blocked cosine products within cells, one representative per group."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from relweave.llm.common import grouped, stored, tidied
from relweave.llm.components import components

#: Vectors that the centroids are fitted on: so many per cell, and at most so many bytes of them on the driver.
FIT_PER_CELL, FIT_BYTES = 32, 64 << 20
#: Vectors of the largest label in a cell on average, where that makes more cells than half the root of their number; cells at most, which bounds the centroids broadcast (1 MB for 64 dimensions).
CELL_ROWS, MAX_CELLS = 2500, 2048
#: Rows in a block of a cell at most, about, and bytes of a block's vectors in double precision.
BLOCK_ROWS, BLOCK_BYTES = 4096, 64 << 20
#: Vectors that a task remembers, to send equal ones on once.
REMEMBERED = 100_000
#: Dimensions of a sketch: a projection in which no two vectors are further apart than they are, in steps of 1/127.
SKETCH = 16


@dataclass
class Cells:
    """Unit centroids for vectors of dimension `dim`, and the orthonormal projection of the sketches."""

    dim: int
    centroids: np.ndarray
    projection: np.ndarray
    reach: float  # distance of unit vectors whose cosine is the bound

    def home(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        dots = x @ self.centroids.T
        return dots.argmax(1), dots

    def guests(self, home: np.ndarray, dots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for each lower cell whose border with the row's own is within reach: of a linked pair in two cells, the one in the higher cell is a guest in the other's."""
        c = self.centroids
        gap = np.sqrt(np.maximum(2 - 2 * (c @ c.T), 0))
        near = (dots[np.arange(len(home)), home][:, None] - dots <= (self.reach + 1e-9) * gap[home] + 1e-9) & (np.arange(len(c)) < home[:, None])
        return np.nonzero(near)

    def sketches(self, x: np.ndarray) -> np.ndarray:
        return np.rint(x @ self.projection * 127).astype(np.int8)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k unit centroids of unit rows; starts from rows spread over the sample, an empty cell keeps its centroid."""
    k = max(1, min(k, len(x)))
    c = x[np.linspace(0, len(x) - 1, k).astype(int)].copy()
    for _ in range(rounds):
        at = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, x)
        norm = np.linalg.norm(sums, axis=1)
        c[norm > 0] = sums[norm > 0] / norm[norm > 0, None]
    return c


def units(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The unit vectors in double precision; None where a vector is null, empty, zero or holds null or non-finite parts."""
    n = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False)
    ends = np.cumsum(n)
    for a, z in zip((ends - n).tolist(), ends.tolist(), strict=True):
        v = values[a:z]
        top = np.abs(v).max() if len(v) and np.isfinite(v).all() else 0.0
        if top > 0:
            v = v / top  # neither overflow nor underflow in the norm
            yield v / np.sqrt(v @ v)
        else:
            yield None


def _digest(unit: np.ndarray) -> bytes:
    return hashlib.blake2b(unit.tobytes(), digest_size=16).digest()


def _homes(cells: Cells, found: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Of unit vectors: their cells (0 for those of other lengths than the centroids'), and the (row, cell) of guests."""
    out, guests = np.zeros(len(found), np.int32), []
    like = np.array([i for i, v in enumerate(found) if len(v) == cells.dim], np.int64)
    if len(like) and len(cells.centroids) > 1:
        home, dots = cells.home(np.stack([found[i] for i in like]))
        out[like] = home
        row, cell = cells.guests(home, dots)
        guests = list(zip(like[row].tolist(), cell.tolist(), strict=True))
    return out, guests


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray | None]]]:
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            p = b.slice(at, 4096)
            yield p, list(units(p.column("embedding")))


def _place(shared):
    """Rows with their cell and the digest of their unit vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, found in _parts(batches):
            at = [i for i, v in enumerate(found) if v is not None]
            home, _ = _homes(shared.value, [found[i] for i in at])
            cell: list[int | None] = [None] * len(found)
            digest: list[bytes | None] = [None] * len(found)
            for k, i in enumerate(at):
                cell[i], digest[i] = int(home[k]), _digest(found[i])
            dim = [None if v is None else len(v) for v in found]
            yield pa.RecordBatch.from_arrays([p.column("vec_id"), p.column("label"), pa.array(dim, pa.int32()), pa.array(cell, pa.int32()), pa.array(digest, pa.binary())], ["vec_id", "label", "dim", "cell", "digest"])

    return run


def _once(batches: Iterator[pa.RecordBatch], cells: Cells) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[bytes], np.ndarray, list[tuple[int, int]]]]:
    """The rows with label, id and a usable vector, with their unit vectors, digests, cells and guests. Equal ones of a label come once a task while they are remembered, so that a vector with a third of all rows costs few rows a task."""
    met: set[tuple[int, bytes]] = set()
    for p, found in _parts(batches):
        rows, digests = [], []
        for i, (v, label, vec_id) in enumerate(zip(found, p.column("label").to_pylist(), p.column("vec_id").to_pylist(), strict=True)):
            if v is None or label is None or vec_id is None:
                continue
            key = (label, _digest(v))
            if key not in met:
                if len(met) >= REMEMBERED:
                    met.clear()
                met.add(key)
                rows.append(i)
                digests.append(key[1])
        if rows:
            vectors = [found[i] for i in rows]
            yield p.take(pa.array(rows)), vectors, digests, *_homes(cells, vectors)


def _vectors(shared):
    """Vectors in the type they came in, by label, cell and digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for p, found, digests, home, _ in _once(batches, shared.value):
            yield pa.RecordBatch.from_arrays([p.column("label"), pa.array([len(v) for v in found], pa.int32()), pa.array(home), pa.array(digests, pa.binary()), p.column("embedding")], ["label", "dim", "cell", "digest", "embedding"])

    return run


def _sketch(shared):
    """A row for each vector in its own cell and in each that it is a guest in, with its sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = shared.value
        for p, found, digests, home, guests in _once(batches, cells):
            like = [i for i, v in enumerate(found) if len(v) == cells.dim]
            if not like:
                continue
            sketch = dict(zip(like, cells.sketches(np.stack([found[i] for i in like])), strict=True))
            rows = [(i, int(home[i]), True) for i in like] + [(i, c, False) for i, c in guests]
            at = [i for i, _, _ in rows]
            yield pa.RecordBatch.from_arrays(
                [p.column("label").take(pa.array(at)), pa.array([c for _, c, _ in rows], pa.int32()), pa.array([digests[i] for i in at], pa.binary()), pa.array([own for _, _, own in rows]), pa.array([sketch[i].tobytes() for i in at], pa.binary())],
                ["label", "cell", "digest", "own", "sketch"],
            )

    return run


def _wanted(reach: float):
    """Guests with a sketch as near to one of a block's own vectors as a linked one's must be: only they are compared. A block's own rows come first and are held, its guests pass by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        own: list[np.ndarray] = []
        for b in batches:
            cols = [b.column(k).to_numpy() for k in ("label", "cell", "block")]
            mine = b.column("own").to_numpy(zero_copy_only=False)
            new = np.append(True, np.any([c[1:] != c[:-1] for c in cols], axis=0) | (mine[1:] != mine[:-1]))
            cuts = [*np.flatnonzero(new).tolist(), b.num_rows] if b.num_rows else []
            for a, z in zip(cuts, cuts[1:], strict=False):
                now = tuple(c[a] for c in cols)
                if now != key:
                    key, own = now, []
                x = np.frombuffer(b"".join(b.column("sketch").slice(a, z - a).to_pylist()), np.int8).reshape(z - a, -1).astype(np.float32) / 127
                if mine[a]:
                    own.append(x)
                    continue
                if not own:
                    continue
                own = [np.concatenate(own)]
                # Steps of 1/127 move each sketch by half a step a dimension at most.
                far = (reach + np.sqrt(x.shape[1]) / 127 + 1e-4) ** 2
                square = (own[0] * own[0]).sum(1)
                hit = np.concatenate([((y * y).sum(1)[:, None] + square[None, :] - 2 * (y @ own[0].T) <= far).any(1) for y in (x[k : k + 1024] for k in range(0, len(x), 1024))])
                if hit.any():
                    yield b.select(["label", "cell", "digest"]).take(pa.array(a + np.flatnonzero(hit)))

    return run


def _products(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, ["label", "dim", "cell", "x", "y"]):
            # Rows with a count say what a class is; the others bring its vector, from each task that met it.
            digest, said = t.column("digest").to_pylist(), t.column("copies").is_valid().to_numpy()
            classes = np.flatnonzero(said)
            place = {digest[i]: k for k, i in enumerate(classes.tolist())}
            bearer = {place[digest[i]]: i for i in np.flatnonzero(~said).tolist()}
            if len(place) != len(classes) or len(bearer) != len(classes):
                raise RuntimeError("a block lacks a vector")
            if len(classes) < 2:
                continue
            m = np.stack(list(units(t.column("embedding").take(pa.array([bearer[k] for k in range(len(classes))])).combine_chunks())))
            known = t.select(["label", "digest", "copies", "rep", "own", "side"]).take(pa.array(classes)).combine_chunks()
            copies, rep, own, side = (known.column(k).to_numpy() for k in ("copies", "rep", "own", "side"))
            same = t.column("x")[0].as_py() == t.column("y")[0].as_py()
            n_links = np.zeros(len(m), np.int64)
            comp = np.arange(len(m))
            for a in range(0, len(m), 512):
                z = min(a + 512, len(m))
                hit = m[a:z] @ m.T >= cosine
                # Two rows that are both guests here meet in a cell of their own.
                hit &= own[a:z, None] | own[None, :]
                if not same:
                    hit &= side[a:z, None] != side[None, :]
                hit[np.arange(z - a), np.arange(a, z)] = False
                n_links[a:z] = hit @ copies
                for i in np.flatnonzero(hit.any(1)):
                    near = np.unique(np.append(comp[hit[i]], comp[a + i]))
                    if len(near) > 1:
                        comp[np.isin(comp, near)] = near[0]
            least = np.full(len(m), np.iinfo(np.int64).max)
            np.minimum.at(least, comp, rep)
            yes = np.flatnonzero(n_links)
            linked = known.select(["label", "digest"]).take(pa.array(yes))
            yield pa.RecordBatch.from_arrays([*(linked.column(k).combine_chunks() for k in ("label", "digest")), pa.array(rep[yes]), pa.array(least[comp][yes]), pa.array(n_links[yes])], ["label", "digest", "a", "b", "n"])

    return run


def _blocks(placing: DataFrame) -> DataFrame:
    """In how many blocks a cell's vectors are."""
    room = F.greatest(F.lit(1), F.least(F.lit(BLOCK_ROWS), F.floor(F.lit(BLOCK_BYTES) / (F.col("dim") * 8))))
    return placing.groupBy("label", "dim", "cell").agg(F.count("*").alias("n")).select("label", "dim", "cell", F.ceil(F.col("n") / room).cast("int").alias("blocks"))


def _side(blocks: str) -> Column:
    return F.pmod(F.xxhash64("digest"), F.col(blocks)).cast("int")


def _fitted(usable: DataFrame, cosine: float) -> Cells:
    """Cells for the most frequent length of vectors: as many as its largest label needs, fitted on a sample by a hash of the id, whose bound is FIT_BYTES."""
    reach = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    sizes = usable.groupBy(F.size("embedding").alias("dim"), "label").agg(F.count("*").alias("n")).groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most")).orderBy(F.desc("n"), "dim").limit(1).collect()
    if not sizes or not sizes[0].dim:
        return Cells(0, np.zeros((0, 1)), np.zeros((0, 1)), reach)
    dim, n, most = sizes[0]
    k = min(MAX_CELLS, max(2, round(most**0.5 / 2), round(most / CELL_ROWS)), max(2, (8 << 20) // (8 * dim)))
    projection = np.linalg.qr(np.random.default_rng(1).normal(size=(dim, min(SKETCH, dim))))[0]
    want = max(64, min(FIT_PER_CELL * k, FIT_BYTES // (8 * dim)))
    at = usable.where(F.size("embedding") == dim)
    if n > want:
        at = at.where(F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003)) < int(1_000_003 * want / n) + 1)
    rows = at.select("vec_id", "embedding").orderBy("vec_id").limit(2 * want).toArrow()
    x = [v for v in units(rows.column("embedding").combine_chunks()) if v is not None]
    return Cells(dim, spherical_kmeans(np.unique(np.stack(x), axis=0), k) if x else np.zeros((1, dim)), projection, reach)


def numbered(rows: DataFrame) -> DataFrame:
    """rows with labels that are numbers: whole ones as they are, others (text, say) by a table of the distinct ones."""
    if isinstance(rows.schema["label"].dataType, (ByteType, ShortType, IntegerType, LongType)):
        return rows.withColumn("label", F.col("label").cast("bigint"))
    names = stored(rows.select("label").where("label is not null").distinct().withColumn("number", F.monotonically_increasing_id()), "labels")
    return rows.join(names, "label", "left").select("vec_id", F.col("number").alias("label"), "embedding")


def near_duplicates(rows: DataFrame, cosine: float = 0.98) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one for each row of rows (vec_id, embedding, label; other columns are ignored).

    Vectors are linked when their labels are equal and not null, their lengths are equal, and their cosine in double precision is at least `cosine`.
    - labels of any type that can be compared: equal values are equal labels
    - vectors that are null, empty, zero, or hold null or non-finite parts: no links, kept
    - null vec_id: no links, component_id and kept null
    - a vec_id on several rows: each row counts as a vector, with its own n_links; what any of them is linked with is in the id's component
    - equal vectors of a label: compared once, all linked with each other
    - empty table: no rows

    Cells only spread the work: a vector is also a guest in each lower cell whose border is nearer than the distance that `cosine` allows, so that no pair is lost. Guests are first met by their sketches, of a byte a dimension, and only those near some vector of the cell are compared with it. Cells are compared in pairs of blocks; of the links only counts and one link per row and block are written. Vectors travel once, in the type they came in, and once more for each further block of their cell."""
    spark = rows.sparkSession
    base = numbered(rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", "embedding"))
    usable = base.where("vec_id is not null and label is not null and embedding is not null")
    cells = _fitted(usable, cosine)
    shared = spark.sparkContext.broadcast(cells)
    kind = rows.schema["embedding"].dataType.simpleString()
    placed = stored(base.mapInArrow(tidied(_place(shared)), "vec_id bigint, label bigint, dim int, cell int, digest binary"), "placed")
    known = placed.where("digest is not null and label is not null and vec_id is not null")
    classes = stored(known.groupBy("label", "dim", "cell", "digest").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")), "classes")
    vectors = usable.mapInArrow(tidied(_vectors(shared)), f"label bigint, dim int, cell int, digest binary, embedding {kind}")
    placing = classes.withColumn("own", F.lit(True))
    if len(cells.centroids) > 1:
        sketches = usable.mapInArrow(tidied(_sketch(shared)), "label bigint, cell int, digest binary, own boolean, sketch binary")
        block = F.explode(F.when(F.col("own"), F.array(_side("blocks"))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
        met = sketches.join(_blocks(classes.where(F.col("dim") == cells.dim)).drop("dim"), ["label", "cell"]).withColumn("block", block).select("label", "cell", "block", "digest", "own", "sketch")
        met = met.repartition("label", "cell", "block").sortWithinPartitions("label", "cell", "block", F.desc("own"))
        guests = stored(met.mapInArrow(tidied(_wanted(cells.reach)), "label bigint, cell int, digest binary").distinct(), "guests")
        placing = placing.unionByName(guests.join(classes.drop("cell"), ["label", "digest"]).withColumn("own", F.lit(False)))
        vectors = vectors.unionByName(vectors.drop("cell").join(guests, ["label", "digest"]))
    blank = {"embedding": kind, "rep": "bigint", "copies": "bigint", "own": "boolean"}
    both = placing.withColumn("embedding", F.lit(None).cast(kind)).unionByName(vectors.withColumns({c: F.lit(None).cast(t) for c, t in blank.items() if c != "embedding"}))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("side")).alias("x"), F.greatest(k, F.col("side")).alias("y")))
    keys = ["label", "dim", "cell", "x", "y"]
    met = both.join(stored(_blocks(placing), "blocks"), ["label", "dim", "cell"]).withColumn("side", _side("blocks")).withColumn("p", F.explode(pairs))
    met = met.select("label", "dim", "cell", "p.x", "p.y", "digest", "side", *blank).repartition(*keys).sortWithinPartitions(*keys)
    links = stored(met.mapInArrow(tidied(_products(cosine)), "label bigint, digest binary, a bigint, b bigint, n bigint"), "links")
    # Ids that stand for several classes join them.
    several = known.select("vec_id", "label", "digest").distinct().groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    doubled = known.join(several, "vec_id", "left_semi").join(classes.select("label", "digest", "rep"), ["label", "digest"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    roots = components(links.select("a", "b").unionByName(doubled))
    counts = links.groupBy("label", "digest").agg(F.sum("n").alias("n"))
    counted = classes.join(counts, ["label", "digest"], "left").join(roots.withColumnRenamed("id", "rep"), "rep", "left")
    # Stored, so that the join reads plain rows and Spark can divide the rows of a frequent vector among tasks.
    counted = stored(counted.select("label", "digest", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("root", "rep").alias("root")), "counted")
    out = placed.join(counted, ["label", "digest"], "left")
    linked = F.col("root").isNotNull() & F.col("vec_id").isNotNull()
    component = F.when(linked, F.col("root")).otherwise(F.col("vec_id"))
    return out.select("vec_id", F.when(linked, F.col("n")).otherwise(0).cast("bigint").alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
