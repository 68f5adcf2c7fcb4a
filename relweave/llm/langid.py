"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import mix, slices, stored, text_buffer, tidied

#: Hash buckets of the n-grams; n-grams are of 3 characters of the lower-cased text, blanks and controls as blanks.
BUCKETS = 1 << 16
#: Characters whose n-grams are held at once.
PIECE = 1 << 18
#: Labelled documents that the counts come from, about. With fewer labelled documents all are used.
TRAIN_DOCS = 20_000
#: Labelled documents of a language that are used at least, about, however many languages there are.
LEAST_DOCS = 100
#: Languages that are scored at once: with it a broadcast matrix is at most 256 * 65,536 * 4 bytes = 64 MB. More languages make more matrices, one after another.
MAX_LANGUAGES = 256
SMOOTHING = 0.5


def gram_buckets(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Text numbers and bucket numbers of all n-grams of all texts, some hundred thousand characters at a time."""
    low = pc.utf8_lower(column.fill_null("").cast(pa.large_string()))
    buf, _ = text_buffer(low)
    chars = np.frombuffer(buf.tobytes().decode().encode("utf-32-le"), np.uint32)
    ends = np.cumsum(pc.utf8_length(low).to_numpy(zero_copy_only=False))
    for a in range(0, len(chars), PIECE):
        # An n-gram belongs to the text it begins in; those that run over its end are left out.
        c = np.maximum(chars[a : a + PIECE + 2], 32).astype(np.uint64)
        at = np.arange(a, a + max(0, len(c) - 2))
        text = np.searchsorted(ends, at, "right")
        whole = at + 3 <= ends[text]
        # Code points have 21 bits, so a run of three is a 63-bit number.
        run = (c[:-2] << np.uint64(42)) | (c[1:-1] << np.uint64(21)) | c[2:]
        yield text[whole], (mix(run[whole]) & np.uint64(BUCKETS - 1)).astype(np.int64)


def gram_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Sparse counts: distinct (text, bucket) in this order, and how often each comes; a text may go on in the next piece."""
    for text, bucket in gram_buckets(column):
        key, n = np.unique(text * BUCKETS + bucket, return_counts=True)
        yield key // BUCKETS, key % BUCKETS, n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for b in slices(batches, "text"):
        lang = np.array(b.column("lang").to_pylist(), object)
        for text, bucket, n in gram_counts(b.column("text")):
            for x in set(lang[np.unique(text)].tolist()):
                mine = (lang == x)[text]
                if x not in sums:
                    sums[x] = np.zeros(BUCKETS, np.int64)
                sums[x] += np.bincount(bucket[mine], n[mine], minlength=BUCKETS).astype(np.int64)
    for lang, x in sums.items():
        full = np.flatnonzero(x)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(full), pa.string()), pa.array(full), pa.array(x[full])], ["lang", "bucket", "n"])


class LanguageBlock:
    """Log probabilities of n-gram buckets by language, and of the languages."""

    def __init__(self, languages: list[str], log_p: np.ndarray, prior: np.ndarray) -> None:
        self.languages, self.log_p, self.prior = languages, log_p, prior

    def scores(self, column: pa.Array) -> np.ndarray:
        """A row for each text: the logarithms of the languages' probabilities with the text: its sparse n-gram counts times the matrix."""
        out = np.tile(self.prior, (len(column), 1))
        step = max(1, (8 << 20) // (8 * max(1, len(self.languages))))
        for text, bucket, n in gram_counts(column):
            for a in range(0, len(text), step):
                rows = text[a : a + step]
                first = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
                out[rows[first]] += np.add.reduceat(self.log_p[bucket[a : a + step]].astype(np.float64) * n[a : a + step, None], first, axis=0)
        return out


class LanguageModel:
    """Counts (lang, bucket, n) in the shared folder, and the learned languages by name with their log probabilities."""

    def __init__(self, counts: DataFrame, languages: list[str], prior: np.ndarray) -> None:
        self.counts, self.languages, self.prior = counts, languages, prior

    def blocks(self) -> Iterator[LanguageBlock]:
        """MAX_LANGUAGES languages after another, by name."""
        for a in range(0, len(self.languages), MAX_LANGUAGES):
            languages = self.languages[a : a + MAX_LANGUAGES]
            place = {x: i for i, x in enumerate(languages)}
            c = np.zeros((BUCKETS, len(languages)), np.float64)
            kept = self.counts.where(F.col("lang").isin(languages)).toArrow()
            c[kept.column("bucket").to_numpy(), np.array([place[x] for x in kept.column("lang").to_pylist()], np.int64)] = kept.column("n").to_numpy()
            yield LanguageBlock(languages, np.log((c + SMOOTHING) / (c.sum(0) + SMOOTHING * BUCKETS)).astype(np.float32), self.prior[a : a + MAX_LANGUAGES])


def quota(sizes: list[int], train_docs: int, least: int) -> float:
    """Documents that a language may give, so that all give about train_docs together and those with fewer give all."""
    left, share = float(train_docs), float(train_docs)
    for k, n in enumerate(sorted(sizes)):
        share = left / (len(sizes) - k)
        if n > share:
            break
        left -= n
    return max(share, least)


def fit(docs: DataFrame, train: Column | None = None, train_docs: int = TRAIN_DOCS, least: int = LEAST_DOCS) -> LanguageModel | None:
    """A model from text and lang of the rows for which train holds; None if there is no such row with a language and text.

    Labelled rows beyond train_docs are thinned to about that many by a hash of doc_id (if there is one) and text (the documented bound): languages give the same number each, but rare ones all their rows, and none is thinned below about `least`. The languages' probabilities are those of all labelled rows. Counts are summed on the executors, and the driver gets a count for each language, and for each language and bucket of a block."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    if train is not None:
        rows = rows.where(F.coalesce(train, F.lit(False)))
    of = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not of:
        return None
    total = sum(of.values())
    if total > train_docs:
        most = quota(list(of.values()), train_docs, least)
        thin = [(x, int(1_000_003 * most / n)) for x, n in of.items() if n > most]
        if thin:
            part = docs.sparkSession.createDataFrame(thin, "lang string, _lid_part int")
            key = F.xxhash64(*(["doc_id"] if "doc_id" in docs.columns else []), "text")
            rows = rows.join(F.broadcast(part), "lang", "left").where(F.col("_lid_part").isNull() | (F.pmod(key, F.lit(1_000_003)) < F.col("_lid_part")))
    counts = stored(rows.select("text", "lang").mapInArrow(tidied(_count), "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "grams")
    languages = sorted(of)
    n = np.array([of[x] for x in languages], np.float64)
    return LanguageModel(counts, languages, np.log(n / n.sum()))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for b in slices(batches, "_lid_text"):
            s = block.scores(b.column("_lid_text"))
            best = s.argmax(1)
            top = s[np.arange(len(s)), best]
            # The sum of all languages' probabilities so far, and the best of them: on a tie the first stays.
            total = top + np.log(np.exp(s - top[:, None]).sum(1))
            was, was_total = (b.column(c).to_numpy(zero_copy_only=False) for c in ("_lid_top", "_lid_total"))
            lang = [block.languages[k] if new else old for k, new, old in zip(best.tolist(), (top > was).tolist(), b.column("_lid_lang").to_pylist(), strict=True)]
            own = {"_lid_lang": pa.array(lang, pa.string()), "_lid_top": pa.array(np.maximum(top, was)), "_lid_total": pa.array(np.logaddexp(total, was_total))}
            yield pa.RecordBatch.from_arrays([own.get(c, b.column(i)) for i, c in enumerate(b.schema.names)], b.schema.names)

    return run


def identify(docs: DataFrame, model: LanguageModel | None, keep: list[str] | None = None, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The `keep` columns of docs (default: all but those named in `out`, which are replaced) with lang_pred and score, under the names in `out`, for each row's whole text.

    - lang_pred: a learned language, the most probable, the first by name on a tie; `und` if the text is null or has no letter (Unicode category L), or nothing was learned
    - score: its posterior probability, 0 to 1; 0 for `und`
    - repeated rows are scored alike; an empty table gives no rows; other columns pass through, whatever their names
    Blocks of the model are broadcast, bounded by MAX_LANGUAGES and BUCKETS; with more than one the rows are stored between them."""
    columns = keep or [c for c in docs.columns if c not in out]
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    least = F.lit(float("-inf"))
    ready = docs.select(*(F.col(f"`{c}`") for c in columns), F.coalesce("text", F.lit("")).alias("_lid_text"), letter.alias("_lid_letter"), F.lit(None).cast("string").alias("_lid_lang"), least.alias("_lid_top"), least.alias("_lid_total"))
    for k, block in enumerate(model.blocks() if model else ()):
        if k:
            ready = stored(ready, "languages")
        ready = ready.mapInArrow(tidied(_score(docs.sparkSession.sparkContext.broadcast(block))), ready.schema)
    known = F.col("_lid_letter") & F.col("_lid_lang").isNotNull()
    return ready.select(*(F.col(f"`{c}`") for c in columns), F.when(known, F.col("_lid_lang")).otherwise("und").alias(out[0]), F.when(known, F.exp(F.col("_lid_top") - F.col("_lid_total"))).otherwise(0.0).alias(out[1]))
