"""Near-duplicate documents: HyperMinHash sketches, banding, an estimate, then confirmation on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import LOWER, WORD_SPACE, Sets, dropped, grouped, mix, shingles, slices, stored, text_buffer, tidied, whole_groups, word_hashes
from relweave.llm.components import components, with_more

#: log2 of the number of buckets, and bits of mantissa kept beside the count of leading zeros.
BUCKET_BITS, MANTISSA_BITS = 7, 10
#: Registers in a band. At similarity 0.8 all 32 bands miss with probability (1 - 0.8^4)^32 < 1e-7.
BAND_ROWS = 4
#: A cluster of more documents or shingles than this is compared in blocks.
BLOCK_DOCS, BLOCK_SHINGLES = 2000, 2_000_000
#: Sets of up to SHORT shingles leave registers empty, and a band with one filled register is met by all that share one shingle. They have bands of whole minima; longer ones have bands of registers, and those that may link across the border have both.
SHORT = 512
_VALUE_BITS = 53
#: Odd factors: each orders the hashes of a set anew.
_FACTORS = np.random.default_rng(9).integers(1 << 62, 1 << 63, 32 * BAND_ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of n lower-cased words."""
    buf, offsets = text_buffer(column)
    words, at = word_hashes(LOWER[buf], offsets, WORD_SPACE)
    return [np.unique(shingles(words[a:b], n)) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """A row of 16-bit registers for each set: of the least value in each bucket 1 + its leading zeros, and the mantissa bits after its first one; 0 where nothing fell."""
    buckets = 1 << BUCKET_BITS
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    least = np.full(len(sets) * buckets, 2.0**_VALUE_BITS)
    np.minimum.at(least, row * buckets + (flat & np.uint64(buckets - 1)).astype(np.int64), ((flat >> np.uint64(64 - _VALUE_BITS)).astype(np.float64) + 0.5))
    part, exponent = np.frexp(least)
    zeros = np.clip(_VALUE_BITS - exponent, 0, 62)
    mantissa = ((part - 0.5) * 2 * (1 << MANTISSA_BITS)).astype(np.int64)
    out = np.where(least < 2.0**_VALUE_BITS, ((zeros + 1) << MANTISSA_BITS) | mantissa, 0)
    return out.astype(np.uint16).reshape(len(sets), buckets)


def band_keys(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and 64-bit keys of all bands in which at least one register is filled."""
    parts = regs.astype(np.uint64).reshape(len(regs), regs.shape[1] // BAND_ROWS, BAND_ROWS)
    key = np.zeros(parts.shape[:2], np.uint64)
    for i in range(BAND_ROWS):
        key = key << np.uint64(16) | parts[:, :, i]
    row, band = np.nonzero(key)
    return row, mix(mix(key[row, band]) + band.astype(np.uint64)).view(np.int64)


def short_keys(sets: list[np.ndarray], percent: int) -> list[bytes]:
    """Of each set the 64-bit keys of its bands of whole minima: two sets of similarity s share a band with probability s^4, however few shingles they have and however common those are. Empty for sets that link with none of up to SHORT shingles, and for those without any."""
    sizes = np.array([len(s) for s in sets], np.int64)
    some = np.flatnonzero((sizes > 0) & (sizes * percent <= SHORT * 100))
    out = [b""] * len(sets)
    if len(some):
        flat = np.concatenate([sets[i] for i in some])
        starts = np.cumsum(sizes[some]) - sizes[some]
        keys = np.zeros((len(some), len(_FACTORS) // BAND_ROWS), np.uint64)
        for k, factor in enumerate(_FACTORS):
            keys[:, k // BAND_ROWS] = mix(keys[:, k // BAND_ROWS] + np.minimum.reduceat(flat * factor, starts))
        keys = mix(keys + np.arange(1, keys.shape[1] + 1, dtype=np.uint64))
        for i, row in zip(some.tolist(), keys, strict=True):
            out[i] = row.tobytes()
    return out


def estimate(one: np.ndarray, others: np.ndarray, n: int | np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of one sketch with others, less the matches expected by collision of compressed registers; and the number of buckets filled in either."""
    filled = ((others != 0) | (one != 0)).sum(1)
    same = ((others == one) & (one != 0)).sum(1)
    ratio = np.minimum(n, sizes) / np.maximum(np.maximum(n, sizes), 1)
    chance = 0.169919487159739093975315012348 * 2.0 ** (BUCKET_BITS - MANTISSA_BITS) * 4 * ratio / (1 + ratio) ** 2
    return np.maximum(same - chance, 0) / np.maximum(filled, 1), filled


def confirmed(one: np.ndarray, sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets have 100 * intersection >= percent * union with one."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    at = np.minimum(np.searchsorted(one, flat), len(one) - 1)
    hits = np.concatenate([[0], np.cumsum(one[at] == flat)])
    ends = np.cumsum(sizes)
    both = hits[ends] - hits[ends - sizes]
    return 100 * both >= percent * (len(one) + sizes - both)


def linked(sets: list[np.ndarray], regs: np.ndarray, percent: int, labels: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """Roots of the components of confirmed links within a block.

    Each row is compared with all rows not yet in its component, so a tight group costs one pass and no link between components is left out. labels: rows that are known to be together. side: only pairs across the two sides matter."""
    n = len(sets)
    known = Sets(n)
    if labels is not None:
        first: dict[int, int] = {}
        for i, x in enumerate(labels.tolist()):
            known.join(first.setdefault(x, i), i)
    sizes = np.array([len(s) for s in sets])
    comp = known.roots()
    for i in range(n):
        rest = np.flatnonzero((comp != comp[i]) & (np.arange(n) > i))
        if side is not None:
            rest = rest[side[rest] != side[i]]
        if not len(rest) or not sizes[i]:
            continue
        rest = rest[likely(regs[i], regs[rest], int(sizes[i]), sizes[rest], percent)]
        for a in range(0, len(rest), 256):
            part = rest[a : a + 256]
            yes = part[confirmed(sets[i], [sets[j] for j in part], percent)]
            if len(yes):
                roots = np.unique(np.append(comp[yes], comp[i]))
                comp[np.isin(comp, roots)] = roots[0]
    return comp


def _sign(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text"):
            sets = shingle_sets(b.column("text"), n)
            regs = registers(sets)
            digest = [s.tobytes() for s in sets]
            digest = [hashlib.blake2b(d, digest_size=16).digest() if d else None for d in digest]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array([r.tobytes() for r in regs], pa.binary()), pa.array(short_keys(sets, percent), pa.binary())], ["doc_id", "n_shingles", "digest", "regs", "keys"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for at in range(0, b.num_rows, 4096):
            part = b.slice(at, 4096)
            regs = np.frombuffer(b"".join(part.column("regs").to_pylist()), np.uint16).reshape(part.num_rows, -1)
            long = np.flatnonzero(part.column("n").to_numpy() > SHORT)
            row, key = band_keys(regs[long])
            short = part.column("keys").to_pylist()
            key = np.concatenate([key, np.frombuffer(b"".join(short), np.int64)])
            row = np.concatenate([long[row], np.repeat(np.arange(len(short)), [len(k) // 8 for k in short])])
            yield pa.RecordBatch.from_arrays([pa.array(key), part.column("rep").take(pa.array(row))], ["band", "rep"])


def estimated(regs: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Roots of the components of rows whose estimates allow a link; each row is compared with all rows not yet in its component."""
    comp = np.arange(len(regs))
    for i in range(len(regs)):
        rest = np.flatnonzero(comp != comp[i])
        rest = rest[rest > i]
        if not len(rest):
            continue
        yes = rest[likely(regs[i], regs[rest], int(sizes[i]), sizes[rest], percent)]
        if len(yes):
            roots = np.unique(np.append(comp[yes], comp[i]))
            comp[np.isin(comp, roots)] = roots[0]
    return comp


def likely(one: np.ndarray, others: np.ndarray, n: int | np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether an estimate is not more than six standard errors below the bound, and the sizes allow the link."""
    p = percent / 100
    guess, filled = estimate(one, others, n, sizes)
    filled = np.maximum(filled, 1)
    return (guess >= p - 6 * np.sqrt(p * (1 - p) / filled) - 2 / filled) & (np.minimum(sizes, n) * 100 >= percent * np.maximum(sizes, n))


def _refine(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in whole_groups(batches, "band"):
            band, rep, size = (t.column(c).to_numpy() for c in ("band", "rep", "n"))
            regs = np.frombuffer(b"".join(t.column("regs").to_pylist()), np.uint16).reshape(len(rep), -1)
            first = np.flatnonzero(np.append(True, band[1:] != band[:-1]))
            count = np.diff(np.append(first, len(band)))
            lead = np.repeat(first, count)
            fits = np.concatenate([likely(regs[lead[a : a + 8192]], regs[a : a + 8192], size[lead[a : a + 8192]], size[a : a + 8192], percent) for a in range(0, len(rep), 8192)])
            fits[first] = True
            to = np.where(fits, rep[lead], rep)
            # Buckets in which some row does not go with the first one: all rows are compared.
            for a, k in zip(first, count, strict=True):
                if k > 2 and not fits[a : a + k].all():
                    to[a : a + k] = rep[a : a + k][estimated(regs[a : a + k], size[a : a + k], percent)]
            yes = to != rep
            yield pa.RecordBatch.from_arrays([pa.array(rep[yes]), pa.array(to[yes])], ["a", "b"])

    return run


def _confirm(n: int, percent: int, across: bool):
    keys = ["cluster", "kind", "x", "y"] if across else ["cluster", "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in grouped(batches, keys):
            ids = t.column("rep").to_numpy()
            sets = shingle_sets(t.column("text").combine_chunks(), n)
            regs = registers(sets)
            if across:
                comp = linked(sets, regs, percent, t.column("root").to_numpy(), t.column("side").to_numpy() if t.column("kind")[0].as_py() == 0 else None)
            else:
                comp = linked(sets, regs, percent)
            least = np.full(len(ids), np.iinfo(np.int64).max)
            np.minimum.at(least, comp, ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(least[comp])], ["a", "b"])

    return run


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of docs (doc_id, text; other columns are ignored).

    A document's set: its distinct runs of n words (white space apart, A-Z lower-cased); all its words as one if it has fewer. Documents are linked when 100 * intersection >= percent * union of the whole sets; component_id is the smallest doc_id that links lead to.

    - null, empty or blank text: n_shingles 0, linked with nothing, kept
    - null doc_id: n_shingles is given, component_id and kept are null, linked with nothing
    - a doc_id on several rows: a document of several texts; what any of them links with is in its component
    - equal texts: one class, of which only the smallest doc_id is compared; nothing is paired within it
    - empty table: no rows

    Sketches: 128 registers of 16 bits; 32 bands of 4 propose clusters, of registers or, in sets of up to SHORT shingles, of whole minima, so that what many short texts share brings none together; in a cluster the corrected estimate, six standard errors below the bound, goes before confirmation. Clusters beyond a block are compared block by block with their first member in each, and then pairs of blocks where more than one component is left."""
    spark = docs.sparkSession
    signed = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(tidied(_sign(n, percent)), "doc_id bigint, n_shingles bigint, digest binary, regs binary, keys binary"), "signed")
    usable = signed.where("digest is not null and doc_id is not null")
    classes = stored(usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"), F.first("keys").alias("keys")), "classes")
    bands = classes.select("rep", "n", "regs", "keys").mapInArrow(tidied(_bands), "band bigint, rep bigint")
    shared = bands.groupBy("band").agg(F.min("rep").alias("b"), F.max("rep").alias("top"), F.count("*").alias("rows")).where("b <> top").drop("top")
    met = stored(bands.join(shared, "band"), "met")
    # Estimates refine buckets of up to a block; what lies in a larger one goes on as it is.
    small = met.where(F.col("rows") <= 2 * BLOCK_DOCS).select("band", "rep").join(classes.select("rep", "n", "regs"), "rep")
    small = small.repartition("band").sortWithinPartitions("band", "rep").mapInArrow(tidied(_refine(percent)), "a bigint, b bigint")
    candidates = met.where(F.col("rows") > 2 * BLOCK_DOCS).select(F.col("rep").alias("a"), "b").where("a <> b").union(small)
    several = usable.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc_id")
    clusters = components(candidates).select(F.col("id").alias("rep"), F.col("root").alias("cluster"))
    sizes = classes.groupBy("rep").agg(F.sum("n").alias("n"))
    dropped(met)
    members = clusters.join(sizes, "rep")
    parts = members.groupBy("cluster").agg(F.greatest(F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_DOCS)).cast("int").alias("parts"))
    placed = stored(members.select("rep", "cluster").join(parts, "cluster"), "members")
    x = F.when(F.col("rep") == F.col("cluster"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int")))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").where("text is not null").join(placed, "rep")
    within = texts.withColumn("x", F.explode(x)).select("cluster", "x", "rep", "text").repartition("cluster", "x").sortWithinPartitions("cluster", "x")
    links = stored(within.mapInArrow(tidied(_confirm(n, percent, False)), "a bigint, b bigint"), "confirmed")
    doubled = usable.join(several, "doc_id").join(classes.select("digest", F.col("rep").alias("b")), "digest").select(F.col("doc_id").alias("a"), "b")
    roots = components(links.union(doubled))
    # Of large clusters that are not in one component: the rows outside the largest one meet it and each other, in blocks.
    large = placed.where("parts > 1").join(roots.select(F.col("id").alias("rep"), "root"), "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    most = large.groupBy("cluster", "root").count().groupBy("cluster").agg(F.max(F.struct("count", (-F.col("root")).alias("r"))).alias("m"), F.count("*").alias("roots"), F.sum("count").alias("rows")).where("roots > 1")
    most = most.select("cluster", (-F.col("m.r")).alias("main"), F.ceil((F.col("rows") - F.col("m.count")) / BLOCK_DOCS).cast("int").alias("outs"))
    large = stored(large.join(most, "cluster"), "open")
    if not large.isEmpty():
        own, out_own = (F.pmod(F.xxhash64("rep"), F.col(c)).cast("int") for c in ("parts", "outs"))
        triple = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"))
        outs, ins = F.sequence(F.lit(0), F.col("outs") - 1), F.sequence(F.lit(0), F.col("parts") - 1)
        groups = F.when(F.col("root") == F.col("main"), F.transform(outs, lambda j: triple(0, own, j))).otherwise(F.concat(F.transform(ins, lambda i: triple(0, i, out_own)), F.transform(outs, lambda k: triple(1, F.least(k, out_own), F.greatest(k, out_own)))))
        across = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").where("text is not null").join(large, "rep").withColumn("p", F.explode(groups))
        across = across.select("cluster", "p.kind", "p.x", "p.y", "rep", "text", "root", (F.col("root") == F.col("main")).cast("int").alias("side")).repartition("cluster", "kind", "x", "y").sortWithinPartitions("cluster", "kind", "x", "y")
        more = stored(across.mapInArrow(tidied(_confirm(n, percent, True)), "a bigint, b bigint"), "confirmed")
        roots = with_more(roots, more)
        dropped(more)
    for done in (large, links, placed):
        dropped(done)
    tops = classes.select("digest", "rep").join(roots.withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("root", "rep").alias("root"))
    direct = roots.select(F.col("id").alias("doc_id"), F.col("root").alias("own_root"))
    # Classes of one document and no link need no lookup; the join is on the digest, whose hot values adaptive joins split.
    out = signed.drop("regs", "keys").join(tops, "digest", "left").join(direct, "doc_id", "left")
    component = F.least(F.col("doc_id"), F.coalesce("own_root", "root", "doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (component == F.col("doc_id")).alias("kept"))
