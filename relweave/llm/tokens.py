"""Token files: independent zstandard frames of documents' token ids, with a trailing seek table and a checksum per frame."""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from functools import cache
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.llm.common import fresh_path, read_blobs, returned, slices, stored, tidied, write_blobs

#: Ids in a frame before it is closed (a longer document has a frame of its own), and frame bytes in a file before the next one begins.
FRAME_IDS, FILE_BYTES = 1 << 16, 8 << 20
#: Words whose ids a worker keeps at most, the earliest met (about 40 MB).
CACHE_WORDS = 200_000

# Fixed values of the zstandard container: numbers that begin a skippable frame, and a frame.
SKIPPABLE, TABLE_SKIPPABLE, FOOTER = 0x184D2A50, 0x184D2A5E, 0x52575453
#: What ends a file: a skippable frame without content, which any zstandard reader passes over.
TAIL = struct.pack("<II", SKIPPABLE, 0).decode("latin-1")


class Known(dict):
    """Strings numbered in the order they are first asked for, and the ids of each."""

    def __init__(self) -> None:
        self.new: list[str] = []
        self.ids = np.zeros(1 << 16, np.uint32)
        self.at = np.zeros(1, np.int64)

    def __missing__(self, text: str) -> int:
        self[text] = n = len(self)
        self.new.append(text)
        return n

    def numbers(self, texts: Iterable[str], count: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, texts), np.int64, count)

    def learn(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        """Ids of the strings in `new`, in their order."""
        used = int(self.at[-1])
        while used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : used + len(flat)] = flat
        self.at = np.concatenate([self.at, used + np.cumsum(sizes)])
        self.new = []

    def sizes(self, numbers: np.ndarray) -> np.ndarray:
        return self.at[numbers + 1] - self.at[numbers]

    def shrink(self, most: int) -> None:
        """Forget the latest beyond `most`: what is frequent came early."""
        while len(self) > most:
            self.popitem()
        self.at = self.at[: most + 1]


def runs(flat: np.ndarray, at: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of flat that begin at `at` of these numbers and have these sizes, one after another; some tens of thousands at a time, so that little is held beside the result."""
    out, step, done = np.empty(int(sizes.sum()), np.uint32), 1 << 16, 0
    for a in range(0, len(numbers), step):
        n = sizes[a : a + step]
        ends = np.cumsum(n)
        total = int(ends[-1])
        out[done : done + total] = flat[np.arange(total) + np.repeat(at[numbers[a : a + step]] - (ends - n), n)]
        done += total
    return out


class WordEncoder:
    """A tokenizer that knows the words it has met.

    Tokenizers that mark the ends of words and lower the case drop white space, so a text's ids are those of its words between blanks, one after another. Arrow divides the texts and finds their distinct words; words of letters, with or without a mark behind, are known by their letters in lower case, other words as they are. New words of letters are encoded many in one text, whose ids the marked ends divide again. With tokenizers of other kinds whole texts are encoded."""

    #: Letters that stay one letter each when a text is normalised, and marks that make a piece of their own.
    LETTERS, MARKS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", ".,;:!?"

    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        suffix = spec["model"].get("end_of_word_suffix")
        self.by_word = bool(suffix) and "Lowercase" in json.dumps(spec["normalizer"])
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.known = Known()
        flat, sizes = self.each(list(self.MARKS))
        self.by_word &= bool((sizes == 1).all())
        self.mark_ids, self.marks = flat, pa.array(list(self.MARKS), pa.large_string())
        self.plain = f"^[{self.LETTERS}]+[{self.MARKS}]?$"

    def each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and how many are of each text."""
        flats, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(texts), 512):  # a library's encoding of one text takes a kilobyte
            got = [e.ids for e in self.tokenizer.encode_batch_fast(texts[a : a + 512], add_special_tokens=False)]
            sizes.append(np.fromiter(map(len, got), np.int64, len(got)))
            flats.append(np.fromiter(chain.from_iterable(got), np.uint32, int(sizes[-1].sum())))
        return np.concatenate(flats), np.concatenate(sizes)

    def together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same of words of letters: each is one piece or more, so as many ends as words are an end for each."""
        flat, _ = self.each([" ".join(words)])
        ends = np.flatnonzero(self.ends[flat]) + 1
        return (flat, np.diff(ends, prepend=0)) if len(ends) == len(words) else self.each(words)

    def learn(self) -> None:
        new = self.known.new
        letters = np.fromiter(map(str.isalpha, new), bool, len(new))
        words = list(compress(new, letters))
        parts = [self.together(words[a : a + 256]) for a in range(0, len(words), 256)] + [self.each(list(compress(new, ~letters)))]
        flat, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
        # Words of letters came first, the others after them; now in the order of their numbers.
        order = np.argsort(np.concatenate([np.flatnonzero(letters), np.flatnonzero(~letters)]))
        self.known.learn(runs(flat, np.cumsum(sizes) - sizes, order, sizes[order]), sizes[order])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of an array of texts without nulls, and len(texts)+1 offsets into them."""
        if not self.by_word:
            flat, sizes = self.each(texts.to_pylist())
            return flat, np.concatenate([[0], np.cumsum(sizes)])
        split = pc.split_pattern(pc.replace_substring(texts.cast(pa.large_string()), "\n", " "), " ")
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])
        coded = split.flatten().dictionary_encode()
        distinct, words = coded.dictionary, coded.indices.to_numpy()
        plain = pc.match_substring_regex(distinct, self.plain)
        keys = pc.if_else(plain, pc.utf8_rtrim(pc.utf8_lower(distinct), self.MARKS), distinct).dictionary_encode()
        mark = pc.if_else(plain, pc.index_in(pc.utf8_slice_codeunits(distinct, -1), self.marks), None).fill_null(-1).to_numpy()
        names = keys.dictionary.to_pylist()
        base = self.known.numbers(names, len(names))[keys.indices.to_numpy()]
        if self.known.new:
            self.learn()
        # The ids of each distinct word: those of its letters, and its mark's.
        n_base = self.known.sizes(base)
        sizes = n_base + (mark >= 0)
        at = np.concatenate([[0], np.cumsum(sizes)])
        flat = np.empty(int(at[-1]), np.uint32)
        flat[np.arange(int(n_base.sum())) + np.repeat(at[:-1] - (np.cumsum(n_base) - n_base), n_base)] = runs(self.known.ids, self.known.at, base, n_base)
        flat[at[1:][mark >= 0] - 1] = self.mark_ids[mark[mark >= 0]]
        self.known.shrink(CACHE_WORDS)
        n = sizes[words]
        return runs(flat, at, words, n), np.concatenate([[0], np.cumsum(n)])[ends]


class FileBuilder:
    """Builds one file: frames of whole documents, then the seek table."""

    def __init__(self) -> None:
        self.frames: list[bytes] = []
        self.table: list[bytes] = []
        self.bytes = 0
        self.docs = 0
        self.ids: list[np.ndarray] = []
        self.names: list[int | None] = []
        self.pending = 0
        self.packer = zstandard.ZstdCompressor(level=1)

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.names.append(name)
        self.pending += len(ids)
        if self.pending >= FRAME_IDS:
            self.close_frame()

    def close_frame(self) -> None:
        """Frame: ids as little-endian unsigned 32-bit integers. Its entry in the table: offset, packed and unpacked size, crc32 of the frame, number of documents; then of each document whether it has an id, the id, and its number of token ids."""
        if not self.names:
            return
        raw = np.concatenate(self.ids).astype("<u4").tobytes()
        frame = self.packer.compress(raw)
        docs = np.array([(n is not None, n or 0, len(i)) for n, i in zip(self.names, self.ids, strict=True)], "<i8")
        self.table.append(struct.pack("<QQQIQ", self.bytes, len(frame), len(raw), zlib.crc32(frame), len(docs)) + docs.tobytes())
        self.frames.append(frame)
        self.bytes += len(frame)
        self.docs += len(docs)
        self.ids, self.names, self.pending = [], [], 0

    def finish(self, order: int) -> bytes:
        """All bytes of the file but its tail. Footer: order of the file, number of frames, crc32 of the table, size of the table, magic number."""
        self.close_frame()
        table = zstandard.ZstdCompressor(level=3).compress(b"".join(self.table))
        footer = struct.pack("<qQIQI", order, len(self.frames), zlib.crc32(table), len(table), FOOTER)
        return b"".join(self.frames) + struct.pack("<II", TABLE_SKIPPABLE, len(table) + len(footer)) + table + footer


class TokenFile:
    """Reads a file through read_at(offset, size), of which it asks only the table and the frames that hold what is wanted."""

    def __init__(self, size: int, read_at: Callable[[int, int], bytes]) -> None:
        n = struct.calcsize("<qQIQI")
        self.read_at = read_at
        self.order, n_frames, crc, length, magic = struct.unpack("<qQIQI", read_at(size - len(TAIL) - n, n))
        if magic != FOOTER:
            raise ValueError("no token file: its footer is missing")
        table = read_at(size - len(TAIL) - n - length, length)
        if zlib.crc32(table) != crc:
            raise ValueError("the seek table is damaged")
        raw = zstandard.ZstdDecompressor().decompress(table)
        self.frames: list[tuple[int, int, int, int, np.ndarray]] = []
        at, head = 0, struct.calcsize("<QQQIQ")
        for _ in range(n_frames):
            offset, packed, unpacked, check, docs = struct.unpack_from("<QQQIQ", raw, at)
            at += head
            self.frames.append((offset, packed, unpacked, check, np.frombuffer(raw, "<i8", docs * 3, at).reshape(docs, 3)))
            at += docs * 24

    def frame(self, i: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """(doc_id, ids) of the documents of a frame, whose checksum is verified."""
        offset, packed, unpacked, check, docs = self.frames[i]
        data = self.read_at(offset, packed)
        if zlib.crc32(data) != check:
            raise ValueError(f"frame {i} is damaged")
        ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(data, max_output_size=unpacked), "<u4")
        at = 0
        for known, name, n in docs.tolist():
            yield (name if known else None), ids[at : at + n]
            at += n

    def documents(self, wanted: set[int | None] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """Documents in the file's order; of frames without a wanted one nothing is read."""
        for i, (*_, docs) in enumerate(self.frames):
            if wanted is None or any((name if known else None) in wanted for known, name, _ in docs.tolist()):
                yield from ((name, ids) for name, ids in self.frame(i) if wanted is None or name in wanted)


@cache
def encoder_for(path: str) -> WordEncoder:
    """A worker's encoder of a vocabulary file: one for all its tasks (this function is found by its name, so its memory outlives a task's closure)."""
    encoder = WordEncoder(path)
    returned()
    return encoder


def _files(tokenizer: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder = encoder_for(tokenizer)
        part = TaskContext.get().partitionId()
        order, file = part << 32, FileBuilder()
        for b in slices(batches, "text"):
            ids, at = encoder.encode(b.column("text"))
            for i, name in enumerate(b.column("doc_id").to_pylist()):
                file.add(name, np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)))
                if file.bytes >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([file.finish(order)], pa.binary())], ["blob"])
                    order, file = order + 1, FileBuilder()
        if file.names or file.docs:
            yield pa.RecordBatch.from_arrays([pa.array([file.finish(order)], pa.binary())], ["blob"])

    return run


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Encode each whole text of docs (doc_id, text; other columns are ignored), append end_id, and write token files to path in ascending doc_id order.

    - null and empty texts: the end id alone; null doc_id: first; repeated rows: each is written, equal ids in the order of their texts
    - an empty table writes no file
    tokenizer is the path of a vocabulary file of the tokenizers library, on every executor. A file's footer holds its place in the order, so files are ordered whatever their names."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    write_blobs(rows.mapInArrow(tidied(_files(tokenizer, end_id)), "blob binary"), path, TAIL)


def _documents(wanted: frozenset[int] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                data = memoryview(b.column("content")[k].as_buffer())
                if not len(data):
                    continue
                file = TokenFile(len(data), lambda at, n, data=data: bytes(data[at : at + n]))
                start, row = 0, 0
                for f, (*_, docs) in enumerate(file.frames):
                    n = docs[:, 2]
                    ends = start + np.cumsum(n)
                    keep = np.arange(len(docs)) if wanted is None else np.array([i for i, (known, name, _) in enumerate(docs.tolist()) if known and name in wanted], np.int64)
                    # A frame without a wanted document is neither decompressed nor verified.
                    if len(keep):
                        got = [(name, zlib.crc32(ids.tobytes())) for name, ids in file.frame(f)]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([file.order] * len(keep), pa.int64()), pa.array(row + keep), pa.array([got[i][0] for i in keep.tolist()], pa.int64()), pa.array((ends - n)[keep]), pa.array(n[keep]), pa.array([got[i][1] for i in keep.tolist()], pa.int64())],
                            ["file", "row", "doc_id", "in_file", "n_tokens", "ids_crc32"],
                        )
                    start, row = int(ends[-1]), row + len(docs)

    return run


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for k in range(b.num_rows):
            data = memoryview(b.column("content")[k].as_buffer())
            if len(data):
                file = TokenFile(len(data), lambda at, n, data=data: bytes(data[at : at + n]))
                yield pa.RecordBatch.from_arrays([pa.array([file.order]), pa.array([sum(int(docs[:, 2].sum()) for *_, docs in file.frames)])], ["file", "n"])


def read(spark: SparkSession, path: str, wanted: Iterable[int] | None = None) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document in the token files at path, or of the wanted doc ids alone, of which only the frames that hold them are decompressed: how many ids stand before its own, their number, and the crc32 of those ids as little-endian unsigned 32-bit integers.

    Files are decoded once, and summed in their order by a window over one row per file."""
    files = read_blobs(spark, path).select("content")
    only = None if wanted is None else frozenset(wanted)
    rows = stored(files.mapInArrow(tidied(_documents(only)), "file bigint, row bigint, doc_id bigint, in_file bigint, n_tokens bigint, ids_crc32 bigint"), "read")
    sums = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")) if only is None else files.mapInArrow(tidied(_lengths), "file bigint, n bigint")
    before = F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return rows.join(sums.select("file", before.cast("bigint").alias("before")), "file").select("doc_id", (F.col("before") + F.col("in_file")).alias("start"), "n_tokens", "ids_crc32")


def written(docs: DataFrame, tokenizer: str, end_id: int = 1, path: str | None = None) -> DataFrame:
    """Write docs as token files (to a new folder in the shared one by default) and read them back."""
    path = path or fresh_path(docs.sparkSession, "tokens")
    write(docs, path, tokenizer, end_id)
    return read(docs.sparkSession, path)
