"""What the operators of this subpackage share: tables, folders, Arrow slices, hashed words."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words: space and the controls from tab to carriage return.
WORD_SPACE = np.zeros(256, bool)
WORD_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Everything in ASCII that is neither a letter nor a digit also separates terms.
TERM_SPACE = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_GOLDEN = _U(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir. Where that is unset, a local master gets a temporary folder; any other master is an error, as its executors would each write to a disk of their own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that the driver and all executors share (master: {master})")
        at = _own.setdefault(id(spark.sparkContext), None) or f"file://{tempfile.mkdtemp(prefix='relweave-')}"
        _own[id(spark.sparkContext)] = at
    return at.rstrip("/")


_own: dict[int, str | None] = {}
#: The folder of each session's own tables, and those in it that nothing has dropped yet.
_work: dict[int, str] = {}
_made: dict[int, list[str]] = {}


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), p


def fresh_path(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder, below one folder of this application, which goes when the driver's JVM ends (or with cleared())."""
    me = id(spark.sparkContext)
    if me not in _work:
        _work[me] = f"{shared_dir(spark)}/relweave/{uuid.uuid4().hex}"
        fs, p = _fs(spark, _work[me])
        fs.mkdirs(p)
        fs.deleteOnExit(p)
    path = f"{_work[me]}/{what}-{uuid.uuid4().hex}"
    _made.setdefault(me, []).append(path)
    return path


def stored(df: DataFrame, what: str) -> DataFrame:
    """df, written to the shared folder and read again: its lineage ends there and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, what)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._relweave_path = path
    return out


def dropped(df: DataFrame) -> None:
    """Delete a table made by stored() that nothing needs any more."""
    path = getattr(df, "_relweave_path", None)
    if path:
        _remove(df.sparkSession, path)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)
    made = _made.get(id(spark.sparkContext), [])
    if path in made:
        made.remove(path)


def marked(spark: SparkSession) -> int:
    """How many tables there are now, for cleared()."""
    return len(_made.get(id(spark.sparkContext), []))


def cleared(spark: SparkSession, since: int = 0, but: str | None = None) -> None:
    """Delete the tables made since a mark: all that operators left for their lazy results, once those are written elsewhere."""
    for path in _made.get(id(spark.sparkContext), [])[since:]:
        if path != but:
            _remove(spark, path)


def crc_mod(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n; null stays null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of text at most (a longer text comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, nulls as empty, and the len+1 offsets."""
    column = column.fill_null("").cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes (the public splitmix64 constants)."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h ^= h >> _U(27)
    h *= _U(0x94D049BB133111EB)
    h ^= h >> _U(31)
    return h


_places = np.zeros(0, np.uint64)


def places(n: int) -> np.ndarray:
    """An odd 64-bit multiplier for each place in a word."""
    global _places
    if len(_places) < n:
        _places = mix((np.arange(max(n, 256), dtype=np.uint64) + _U(1)) * _GOLDEN) | _U(1)
    return _places


def word_spans(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the words; the ends of texts also end words."""
    gap = space[buf]
    start = ~gap
    last = start.copy()
    if len(buf):
        start[1:] &= gap[:-1]
        last[:-1] &= gap[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(buf))]
        start[cuts[~gap[cuts]]] = True
        last[cuts[~gap[cuts - 1]] - 1] = True
    begin = np.flatnonzero(start)
    return begin, np.flatnonzero(last) - begin + 1


def word_hashes(buf: np.ndarray, offsets: np.ndarray, space: np.ndarray = WORD_SPACE, step: int = 4 << 20) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word, and len(texts)+1 offsets into them.

    The sum of byte * multiplier of its place, mixed with the length; computed a few MB at a time, so that memory per text byte is that of the words alone."""
    begin, length = word_spans(buf, offsets, space)
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        to = max(at + 1, int(np.searchsorted(begin, begin[at] + step)))
        b, n = begin[at:to], length[at:to]
        ends = np.cumsum(n)
        place = np.arange(ends[-1]) - np.repeat(ends - n, n)
        value = buf[place + np.repeat(b, n)].astype(np.uint64)
        value += _U(1)
        value *= places(int(n.max()))[place]
        out[at:to] = mix(np.add.reduceat(value, ends - n) + n.astype(np.uint64) * _GOLDEN)
        at = to
    return out, np.searchsorted(begin, offsets)


_TURN = [_U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F), _U(0x165667B19E3779F9), _U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F), _U(0xE7037ED1A0B428DB), _U(0x8EBC6AF09C88C6E3), _U(0x589965CC75374CC3)]


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of n words in one text; of all its words if it has fewer; none if it has none."""
    if not len(words):
        return words
    k = min(n, len(words))
    size = len(words) - k + 1
    return _run_hashes([words[i : i + size] for i in range(k)])


def shingles_at(words: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """The hashes that shingles() gives for the runs of n words that begin at starts."""
    return _run_hashes([words[starts + i] for i in range(n)])


def _run_hashes(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]), len(columns), np.uint64) * _TURN[-1]
    for i, w in enumerate(columns):
        h += mix(w ^ _TURN[i % 8]) * _TURN[(i + 1) % 8]
    return mix(h)


def grouped(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Of batches that are sorted by keys: a table for each key, also where its rows come in several batches."""
    parts: list[pa.RecordBatch] = []
    held: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).cast(pa.int64()).fill_null(-(2**62)).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        cuts = [*np.flatnonzero(new).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(c[a] for c in cols)
            if held is not None and key != held:
                yield pa.Table.from_batches(parts)
                parts = []
            held = key
            parts.append(batch.slice(a, b - a))
    if parts:
        yield pa.Table.from_batches(parts)


def whole_groups(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Of batches that are sorted by key: tables that hold each key's rows together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(key).to_numpy(zero_copy_only=False)
        if held and held[-1].column(key)[-1].as_py() != col[0]:
            yield pa.Table.from_batches(held)
            held = []
        last = int(np.flatnonzero(col != col[-1])[-1]) + 1 if (col != col[-1]).any() else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def returned() -> None:
    """Give memory that is free again back to the system: idle workers stay beside the JVM, and their memory counts."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """run, after which a worker returns its memory."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        returned()

    return outer


def crc32_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


class Sets:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return int(x)

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)

    def roots(self) -> np.ndarray:
        while True:
            up = self.up[self.up]
            if (up == self.up).all():
                return up
            self.up = up


def write_blobs(blobs: DataFrame, path: str, tail: str) -> None:
    """Each row's binary `blob` becomes a file of its own under path, followed by the bytes of `tail`.

    Spark's text writer does it: its commit protocol leaves whole files only, also after lost executors, and path may be in any store that Spark writes to. The writer ends a row with lineSep, hence the tail, which the file formats here allow for."""
    blobs.select(F.col("blob").cast("string").alias("value")).write.option("lineSep", tail).option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_blobs(spark: SparkSession, path: str, glob: str = "part-*") -> DataFrame:
    """path, length, content of each file, read through Spark."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
