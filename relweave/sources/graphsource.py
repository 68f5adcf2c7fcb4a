"""Triples as a data source of Spark: N-Triples read by ranges of bytes and by predicate, and written under a commit."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlparse

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from relweave.schemas import TRIPLE

NAME = "relweave_triples"
#: Bytes of a file that a task reads, if no option says otherwise; bytes of lines that a writing task holds.
RANGE_BYTES, HELD_BYTES = 64 << 20, 16 << 20
#: A line of N-Triples, in the syntax of Arrow's expressions.
LINE = r'^\s*(?P<s><[^>]*>|_:\S+)\s+<(?P<p>[^>]*)>\s+(?:(?P<ref><[^>]*>|_:\S+)|"(?P<text>(?:[^"\\]|\\.)*)"(?:@(?P<lang>[A-Za-z0-9-]+)|\^\^<(?P<datatype>[^>]*)>)?)\s*\.\s*(?:#.*)?$'
#: Escapes of literals; the backslash first when it is written, and by way of NUL when it is read.
ESCAPES = (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))


def store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system that path is in, for drivers and workers alike, and the path in it: local, HDFS or an object store, as Arrow knows them."""
    if urlparse(path).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(path).path
    return pafs.FileSystem.from_uri(path)


@dataclass
class Range(InputPartition):
    """Lines that begin in [begin, end) of a file, all of one predicate where that is known."""

    file: str
    begin: int
    end: int

    def __init__(self, file: str, begin: int, end: int) -> None:
        super().__init__((file, begin, end))
        self.file, self.begin, self.end = file, begin, end


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int, int]]  # file, predicate, bytes, rows


def entries(path: str) -> list[tuple[str, str | None, int]]:
    """(file, predicate, bytes) below path: those that commits name, or, where there are no commits, all N-Triples files, whose predicates are not known. A list of files, not of triples."""
    fs, at = store(path)
    commits = fs.get_file_info(pafs.FileSelector(f"{at}/_commits", allow_not_found=True))
    if commits:
        out = []
        for c in commits:
            if c.path.endswith(".json"):
                with fs.open_input_stream(c.path) as f:
                    out += [(f"{at}/{name}", predicate, size) for name, predicate, size, _ in json.loads(f.read())["files"]]
        return sorted(out)
    info = fs.get_file_info(at)
    found = [info] if info.type == pafs.FileType.File else fs.get_file_info(pafs.FileSelector(at, recursive=True, allow_not_found=True))
    return sorted((i.path, None, i.size) for i in found if i.type == pafs.FileType.File and (i is info or i.path.endswith((".nt", ".txt"))) and "/_" not in i.path[len(at) :])


class Reader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int) -> None:
        self.path, self.range_bytes = path, range_bytes
        self.wanted: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equalities and lists on the predicate; Spark does the rest."""
        for f in filters:
            values = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else None
            if values is not None and f.attribute == ("p",) and all(isinstance(v, str) for v in values):
                self.wanted = values if self.wanted is None else self.wanted & values
            else:
                yield f

    def partitions(self) -> Sequence[Range]:
        """Ranges of the files that may hold a wanted predicate; one empty range where there are none."""
        out = []
        for file, predicate, size in entries(self.path):
            if self.wanted is None or predicate is None or predicate in self.wanted:
                out += [Range(file, a, min(a + self.range_bytes, size)) for a in range(0, size, self.range_bytes)]
        return out or [Range("", 0, 0)]

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        fs, _ = store(self.path)
        for lines in whole_lines(fs, partition):
            batch = parsed(lines)
            if self.wanted is not None:
                batch = batch.filter(pc.is_in(batch.column("p"), pa.array(sorted(self.wanted), pa.string())))
            if batch.num_rows:
                yield batch


def whole_lines(fs: pafs.FileSystem, r: Range, step: int = 4 << 20) -> Iterator[pa.Array]:
    """The lines that begin in a range, some MB at a time. The line that the range begins within belongs to the one before; the last one is read to its end."""
    with fs.open_input_file(r.file) as f:
        size = f.size()
        at = max(r.begin - 1, 0)
        f.seek(at)
        rest, skipping = b"", r.begin > 0
        while at < size:
            data = f.read(min(step, max(r.end - at, 1 << 16)))
            if not data:
                break
            base = at - len(rest)
            at += len(data)
            data = rest + data
            if skipping:
                cut = data.find(b"\n")
                if cut < 0:
                    rest = data
                    continue
                data, base, skipping = data[cut + 1 :], base + cut + 1, False
            if base >= r.end:
                return
            # Up to the last whole line; beyond the range's end, up to the end of the line that crosses it.
            stop = data.find(b"\n", r.end - 1 - base) if at >= r.end else data.rfind(b"\n")
            if at >= size and (stop < 0 or at < r.end):
                stop = len(data)
            if stop < 0:
                rest = data
                continue
            text = data[:stop].decode()
            kept = [x for x in text.split("\n") if x.strip() and not x.lstrip().startswith("#")]
            if kept:
                yield pa.array(kept, pa.string())
            if at >= r.end:
                return
            rest = data[stop + 1 :]


def parsed(lines: pa.Array) -> pa.RecordBatch:
    """TRIPLE columns of lines, by one expression over all of them; a ValueError names the first that is none."""
    got = pc.extract_regex(pc.replace_substring(lines, "\r", ""), LINE)
    if got.null_count:
        raise ValueError(f"no N-Triples line: {lines[pc.index(pc.is_null(got), True).as_py()].as_py()}")
    part = lambda name: pc.struct_field(got, name)
    bare = lambda x: pc.replace_substring_regex(x, "^<|>$", "")
    text = pc.replace_substring(part("text"), "\\\\", "\0")
    for meant, written in ESCAPES[1:]:
        text = pc.replace_substring(text, written, meant)
    text = pc.replace_substring(text, "\0", "\\")
    ref, none = part("ref"), pa.scalar(None, pa.string())
    literal = pc.equal(ref, "")
    kind = pc.if_else(literal, "literal", pc.if_else(pc.starts_with(ref, "_:"), "blank", "iri"))
    blank = lambda x: pc.if_else(pc.equal(x, ""), none, x)
    return pa.RecordBatch.from_arrays([bare(part("s")), part("p"), pc.if_else(literal, text, bare(ref)), kind, blank(part("datatype")), blank(part("lang"))], list(TRIPLE.names))


def written(batch: pa.RecordBatch) -> pa.Array:
    """A line for each triple."""
    s, p, o, kind, datatype, lang = (batch.column(c).cast(pa.string()) for c in TRIPLE.names)
    join = lambda *parts: pc.binary_join_element_wise(*parts, "")
    ref = lambda x: pc.if_else(pc.starts_with(x, "_:"), x, join("<", x, ">"))
    text = o
    for meant, form in ESCAPES:
        text = pc.replace_substring(text, meant, form)
    tail = pc.if_else(pc.is_valid(lang), join("@", pc.fill_null(lang, "")), pc.if_else(pc.is_valid(datatype), join("^^<", pc.fill_null(datatype, ""), ">"), ""))
    return join(ref(s), " <", p, "> ", pc.if_else(pc.equal(kind, "literal"), join('"', text, '"', tail), ref(o)), " .\n")


class Writer(DataSourceArrowWriter):
    """Tasks write files of one predicate each under names that no other attempt has; what the driver then puts in place is one entry that names the files of the attempts that count. Readers see all of it or nothing."""

    def __init__(self, path: str, overwrite: bool) -> None:
        self.path, self.overwrite, self.id = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, at = store(self.path)
        held: dict[str, list[str]] = {}
        files: list[tuple[str, str, int, int]] = []
        size = 0

        def flush() -> None:
            for predicate, lines in held.items():
                name = f"data/{self.id}/{uuid.uuid4().hex}.nt"
                data = "".join(lines).encode()
                with fs.open_output_stream(f"{at}/{name}") as f:
                    f.write(data)
                files.append((name, predicate, len(data), len(lines)))
            held.clear()

        fs.create_dir(f"{at}/data/{self.id}")
        for batch in iterator:
            for predicate, line in zip(batch.column("p").to_pylist(), written(batch).to_pylist(), strict=True):
                if line is None:
                    raise ValueError("a triple needs s, p, o and o_kind")
                held.setdefault(predicate, []).append(line)
                size += len(line)
            if size >= HELD_BYTES:
                flush()
                size = 0
        flush()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, at = store(self.path)
        before = [c.path for c in fs.get_file_info(pafs.FileSelector(f"{at}/_commits", allow_not_found=True))]
        fs.create_dir(f"{at}/_commits")
        fs.create_dir(f"{at}/_waiting")
        with fs.open_output_stream(f"{at}/_waiting/{self.id}.json") as f:
            f.write(json.dumps({"files": [x for m in messages if m for x in m.files]}).encode())
        fs.move(f"{at}/_waiting/{self.id}.json", f"{at}/_commits/{self.id}.json")
        if self.overwrite:
            for path in before:
                fs.delete_file(path)
                old = f"{at}/data/{path.rsplit('/', 1)[-1].removesuffix('.json')}"
                if fs.get_file_info(old).type == pafs.FileType.Directory:
                    fs.delete_dir(old)

    def abort(self, messages: list[Written | None]) -> None:
        fs, at = store(self.path)
        if fs.get_file_info(f"{at}/data/{self.id}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{at}/data/{self.id}")


class Triples(DataSource):
    """Options: path (a file or folder, or what this source wrote), rangebytes (bytes a task reads)."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return TRIPLE

    def reader(self, schema: StructType) -> Reader:
        return Reader(self.options["path"], int(self.options.get("rangebytes", RANGE_BYTES)))

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if list(schema.names) != list(TRIPLE.names):
            raise ValueError(f"triples have the columns {', '.join(TRIPLE.names)}")
        return Writer(self.options["path"], overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Triples)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_graph(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """TRIPLE rows of N-Triples at path, in any store that drivers and workers reach by Arrow. A filter on `p` by equality or a list reaches the source: of what write_graph() wrote, only files of these predicates are opened."""
    register(spark)
    return spark.read.format(NAME).option("rangebytes", range_bytes).load(path)


def write_graph(triples: DataFrame, path: str, mode: str = "append") -> None:
    """Write TRIPLE rows, predicates apart. A write is seen as a whole or not at all, whatever tasks are lost or run twice. Nulls in s, p, o or o_kind are an error. Rows are dealt out by predicate and a few parts of the subjects, so that a task writes few files and a frequent predicate is several tasks'."""
    register(triples.sparkSession)
    dealt = triples.select(*TRIPLE.names).repartition("p", F.pmod(F.xxhash64("s"), F.lit(16)))
    dealt.write.format(NAME).mode(mode).option("path", path).save()
