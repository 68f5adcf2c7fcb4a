"""Benchmark decontamination: a BM25 index of test items, their questions and answers with block maxima, queried by every document; then question and answer overlap."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import TERM_SPACE, shingles, shingles_at, slices, text_buffer, tidied, word_hashes

#: BM25's saturation and length weight.
K1, B = 1.2, 0.75
#: Words in a run, and share of an item's runs (or of its question's) that a document must hold.
RUN, OVERLAP = 5, 0.8
#: Share of a question's runs that is enough where the answer has OVERLAP of its own.
HALF = 0.5
#: Entries in a block, and bytes of text in an index at most (some 25,000 items of 300 bytes, about 100 MB as an index): what is beyond makes more indexes, which are broadcast one after another.
BLOCK_ENTRIES, INDEX_BYTES = 16, 8 << 20
#: Cells of the table of texts and blocks that bounds are summed in at once, about.
CELLS_AT_ONCE = 1 << 20
#: Document frequencies of items' terms are counted in a table of this many hashed places.
DF_PLACES = 1 << 20


def term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words without marks, and len(texts)+1 offsets into them."""
    return word_hashes(*text_buffer(pc.utf8_lower(column.fill_null("").cast(pa.large_string()))), TERM_SPACE)


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's question and answer: what stands before and after `Answer:`, or the last question mark, or else its last sentence apart from the others."""
    m = re.search(r"(?i)\banswer\s*:", text)
    if m and m.start():
        return text[: m.start()], text[m.end() :]
    at = text.rfind("?")
    if at >= 0:
        return text[: at + 1], text[at + 1 :]
    m = list(re.finditer(r"[.!]\s+", text.rstrip()))
    return (text[: m[-1].end()], text[m[-1].end() :]) if m else (text, "")


@dataclass
class Index:
    """BM25 postings of entries: items, and their questions and answers where those count by themselves. An impact is a share of what its entry needs to be retrieved, so an entry is retrieved at 1."""

    terms: np.ndarray
    maybe: np.ndarray  # by the terms' low bits: whether there is any
    ids: list[int | None]
    runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # of each item: runs of the whole, the question and the answer
    sizes: list[tuple[int, int, int]]  # and how many words these have
    top: np.ndarray  # by term: the greatest impact in any entry
    block_ptr: np.ndarray  # by term: its blocks, and the greatest impact in each
    block_id: np.ndarray
    block_top: np.ndarray
    ptr: np.ndarray  # by term: its entries, and its impact in each
    entry: np.ndarray
    impact: np.ndarray
    item: np.ndarray  # by entry: its item
    n_blocks: int
    weights: list[tuple[np.ndarray, np.ndarray]]  # of each item: its terms, and their shares of its score with itself
    step: np.ndarray  # of each item: the words of the longest one of its class of lengths

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the words that are terms, and the terms' numbers."""
        return looked_up(self.terms, self.maybe, hashes)


def looked_up(known: np.ndarray, maybe: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the hashes that are known, and their numbers."""
    at = np.flatnonzero(maybe[(hashes & np.uint64(len(maybe) - 1)).astype(np.int64)])
    t = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
    yes = known[t] == hashes[at]
    return at[yes], t[yes]


def low_bits(known: np.ndarray) -> np.ndarray:
    maybe = np.zeros(1 << 20, bool)
    maybe[(known & np.uint64(len(maybe) - 1)).astype(np.int64)] = True
    return maybe


def spread(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the lists that ptr marks, those of rows: which of rows each entry is of, and its place."""
    n = ptr[rows + 1] - ptr[rows]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(np.arange(len(rows)), n), np.arange(total) + np.repeat(ptr[rows] - (ends - n), n)


def build(items: list[tuple[int | None, str]], df: np.ndarray, n_items: int, mean_words: float) -> Index:
    """An index of items with words; df, n_items and mean_words are of all items, so that scores don't depend on how items are divided among indexes."""
    texts = [t for _, t in items]
    words, at = term_hashes(pa.array(texts, pa.large_string()))
    per = [words[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
    terms = np.unique(words)
    maybe = low_bits(terms)
    idf = np.log1p((n_items - df[(terms % np.uint64(DF_PLACES)).astype(np.int64)] + 0.5) / (df[(terms % np.uint64(DF_PLACES)).astype(np.int64)] + 0.5))
    parts = [question_and_answer(t) for t in texts]
    q, qa = term_hashes(pa.array([x for x, _ in parts], pa.large_string()))
    s, sa = term_hashes(pa.array([x for _, x in parts], pa.large_string()))
    asked, told = ([x[a:z] for a, z in zip(at[:-1], at[1:], strict=True)] for x, at in ((q, qa), (s, sa)))
    runs = [tuple(np.unique(shingles(x, RUN)) for x in three) for three in zip(per, asked, told, strict=True)]
    lengths = [tuple(map(len, three)) for three in zip(per, asked, told, strict=True)]

    def weighed(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The terms of words, and the share that each has of the BM25 score of the words with themselves."""
        t, tf = np.unique(np.searchsorted(terms, words), return_counts=True)
        w = np.maximum(idf[t], 1e-6) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
        return t, w / w.sum()

    t_all, e_all, w_all, item = [], [], [], []
    for i, (whole, question, answer) in enumerate(zip(per, asked, told, strict=True)):
        # What kind_of() accepts: OVERLAP of the whole, of the question, or of the answer beside its question.
        for words in (whole, question if len(question) >= RUN else None, answer if len(answer) >= RUN and len(question) else None):
            if words is not None:
                t, w = weighed(words)
                t_all.append(t)
                e_all.append(np.full(len(t), len(item)))
                w_all.append(w / least_score(np.searchsorted(terms, words), t, w))
                item.append(i)
    t, e, w = map(np.concatenate, (t_all, e_all, w_all))
    order = np.lexsort((e, t))
    t, e, w = t[order], e[order], w[order]
    n_blocks = len(item) // BLOCK_ENTRIES + 1
    pair, start = np.unique(t * n_blocks + e // BLOCK_ENTRIES, return_index=True)
    block_t, block_id = np.divmod(pair, n_blocks)
    top = np.zeros(len(terms))
    np.maximum.at(top, t, w)
    level = np.maximum(np.ceil(np.log2(np.maximum([len(x) for x in per], 1))), 4).astype(int)
    step = np.array([max(len(x) for x, k in zip(per, level, strict=True) if k == c) for c in range(level.max() + 1) if c in level])[np.searchsorted(np.unique(level), level)]
    by_term = np.arange(len(terms) + 1)
    return Index(terms, maybe, [i for i, _ in items], runs, lengths, top, np.searchsorted(block_t, by_term), block_id, np.maximum.reduceat(w, start), np.searchsorted(t, by_term), e, w, np.array(item), n_blocks, [weighed(x) for x in per], step)


def least_score(words: np.ndarray, terms: np.ndarray, shares: np.ndarray) -> float:
    """The score that an entry (its words as numbers of terms; its terms and their shares of its own score) has at least with any text that holds OVERLAP of its runs.

    Of m distinct runs, u = m - OVERLAP * m may be missing. A term is missing from the text only if all runs with it are, so only if they are u or fewer; and as a run has RUN words, the runs of all missing terms together, counted term by term, are RUN * u or fewer. What can be lost is then at most what the terms give that have the greatest share for each run, until so many runs are used up."""
    k = min(RUN, len(words))
    windows = np.unique(np.lib.stride_tricks.sliding_window_view(words, k), axis=0)
    missing = len(windows) - int(np.ceil(OVERLAP * len(windows) - 1e-9))
    member = np.unique(np.stack([np.repeat(np.arange(len(windows)), k), windows.ravel()]), axis=1)[1]
    n = np.bincount(np.searchsorted(terms, member), minlength=len(terms))
    can = np.flatnonzero(n <= missing)
    order = can[np.argsort(-shares[can] / n[can], kind="stable")]
    used = np.cumsum(n[order])
    whole = used <= k * missing
    lost = float(shares[order][whole].sum())
    if not whole.all():
        j = int(np.argmin(whole))
        lost += float(shares[order[j]]) * (k * missing - (int(used[j - 1]) if j else 0)) / int(n[order[j]])
    return max(1 - lost - 1e-9, 1e-6)


def retrieve(index: Index, words: np.ndarray, at: np.ndarray) -> list[tuple[int, int]]:
    """(text, item) of all items of which an entry reaches its least score with a text.

    Block-max WAND for many texts at once: texts whose terms' greatest impacts together stay below 1 have no pivot and are left; of the others, blocks of entries whose maxima stay below it are skipped; only what is left is scored. A text counts as a whole, however far apart in it an item's parts stand."""
    place, term = index.lookup(words)
    if not len(place):
        return []
    n_terms = len(index.terms)
    h, t = np.divmod(np.unique((np.searchsorted(at, place, "right") - 1) * n_terms + term), n_terms)
    bound = np.bincount(h, index.top[t], minlength=len(at) - 1)
    texts = np.flatnonzero(bound >= 1)
    first = np.searchsorted(h, np.arange(len(at)))
    out: set[tuple[int, int]] = set()
    many = max(1, CELLS_AT_ONCE // index.n_blocks)
    for a in range(0, len(texts), many):
        some = texts[a : a + many]
        rows, where = spread(first, some)
        owner, posting = spread(index.block_ptr, t[where])
        sums = np.bincount(rows[owner] * index.n_blocks + index.block_id[posting], index.block_top[posting], minlength=len(some) * index.n_blocks).reshape(len(some), index.n_blocks)
        open_ = sums >= 1
        for k in np.flatnonzero(open_.any(1)).tolist():
            d = int(some[k])
            _, e = spread(index.ptr, t[first[d] : first[d + 1]])
            e = e[open_[k][index.entry[e] // BLOCK_ENTRIES]]
            score = np.bincount(index.entry[e], index.impact[e])
            out |= {(d, int(i)) for i in index.item[np.flatnonzero(score >= 1)]}
    return sorted(out)


def best_score(index: Index, words: np.ndarray, item: int) -> float:
    """The best BM25 score of a passage of one text with an item, as a share of the item's own. Passages are twice as long as the longest item of the class, in steps of that length, so any item of it is whole in one of them."""
    impact = np.zeros(len(index.terms))
    impact[index.weights[item][0]] = index.weights[item][1]
    place, term = index.lookup(words)
    place, term = place[impact[term] > 0], term[impact[term] > 0]
    half = place // int(index.step[item])
    # A half is in the passage that it begins and in the one before.
    passage, term = np.divmod(np.unique(np.concatenate([half, half + 1]) * len(index.terms) + np.concatenate([term, term])), len(index.terms))
    return float(np.bincount(passage, impact[term]).max()) if len(passage) else 0.0


def kind_of(index: Index, item: int, whole: float, question: float, answer: float) -> str | None:
    """What of an item a text holds, by the shares of runs: `question and answer`, the `question`, the `answer` with half of its question, or the `whole` in another way; None if it is not held. A question or answer of fewer than RUN words is no evidence by itself."""
    _, n_question, n_answer = index.sizes[item]
    asked = n_question >= RUN and question >= OVERLAP
    told = n_answer >= RUN and answer >= OVERLAP
    if asked:
        return "question and answer" if told else "question"
    if told and question >= HALF:
        return "answer"
    return "whole" if whole >= OVERLAP else None


def verified(index: Index, column: pa.Array) -> list[tuple[int, int, float, float, float, float, str]]:
    """(text, item, score, overlap, question overlap, answer overlap, kind) of the items that a text holds."""
    words, at = term_hashes(column)
    found = retrieve(index, words, at)
    if not found:
        return []
    # Only runs all of whose words are terms can be an item's.
    place, _ = index.lookup(words)
    start = place[: 1 - RUN][place[RUN - 1 :] - place[: 1 - RUN] == RUN - 1] if len(place) >= RUN else place[:0]
    text = np.searchsorted(at, start, "right") - 1
    start = start[start + RUN <= at[text + 1]]
    runs, first = shingles_at(words, start, RUN), np.searchsorted(start, at)
    out = []
    for doc, group in groupby(found, lambda x: x[0]):
        own, known = words[at[doc] : at[doc + 1]], np.sort(runs[first[doc] : first[doc + 1]])
        for _, item in group:
            share = [held(known, own, x, n) for x, n in zip(index.runs[item], index.sizes[item], strict=True)]
            kind = kind_of(index, item, *share)
            if kind:
                out.append((doc, item, best_score(index, own, item), *share, kind))
    return out


def held(runs: np.ndarray, words: np.ndarray, wanted: np.ndarray, size: int) -> float:
    """Share of a part's runs among a text's sorted ones; a part of fewer than RUN words (size) is one run, which is looked for at its own length."""
    if not size:
        return 0.0
    if size < RUN:
        return float(len(words) >= size and wanted[0] in shingles(words, size))
    if not len(runs):
        return 0.0
    at = np.minimum(np.searchsorted(runs, wanted), len(runs) - 1)
    return float((runs[at] == wanted).mean())


def indexes(items: DataFrame) -> Iterator[Index]:
    """Indexes of all items (item_id, text) with words; each holds a bounded number of items and bytes, and items come to the driver one by one, ordered by id and text."""
    rows = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null").orderBy("item_id", "text")

    def groups() -> Iterable[list[tuple[int | None, str]]]:
        group, size = [], 0
        for r in rows.toLocalIterator():
            group.append((r.item_id, r.text))
            size += len(r.text)
            if size >= INDEX_BYTES:
                yield group
                group, size = [], 0
        if group:
            yield group

    df, n, total = np.zeros(DF_PLACES, np.int32), 0, 0
    for group in groups():
        words, at = term_hashes(pa.array([t for _, t in group], pa.large_string()))
        for a, b in zip(at[:-1], at[1:], strict=True):
            df[np.unique((words[a:b] % np.uint64(DF_PLACES)).astype(np.int64))] += 1
            n += int(b > a)
            total += int(b - a)
    if not n:
        return
    for group in groups():
        _, at = term_hashes(pa.array([t for _, t in group], pa.large_string()))
        group = [x for x, size in zip(group, np.diff(at), strict=True) if size]
        if group:
            yield build(group, df, n, total / n)


def _matches(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in slices(batches, "text"):
            got = verified(index, b.column("text"))
            if got:
                ids = b.column("doc_id").take(pa.array([x[0] for x in got]))
                yield pa.RecordBatch.from_arrays([ids, pa.array([index.ids[x[1]] for x in got], pa.int64()), *(pa.array([x[k] for x in got], pa.float64()) for k in (2, 3, 4, 5)), pa.array([x[6] for x in got])], ["doc_id", "item_id", "score", "overlap", "question_overlap", "answer_overlap", "kind"])

    return run


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, overlap, question_overlap, answer_overlap, kind): a row for each row of docs (doc_id, text) and each row of items (item_id, text) that it holds; other columns are ignored.

    Each document is a query; an item is retrieved if the document has the score with it, with its question or with its answer that any text must have which holds OVERLAP of its runs (least_score). What is retrieved is verified: by the shares of the distinct runs of RUN words of the item, of its question and of its answer that are in the whole document, it is held if the question is (OVERLAP or more), or the answer with HALF of its question, or else OVERLAP or more of the whole (see kind_of). Case and marks between words don't matter.

    - null or empty texts, and items without words: no rows; null ids stay null; repeated rows: a row each; an empty table on either side: no rows
    The corpus is read once for every INDEX_BYTES of items' text."""
    spark = docs.sparkSession
    schema = "doc_id bigint, item_id bigint, score double, overlap double, question_overlap double, answer_overlap double, kind string"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], schema)
    for k, index in enumerate(indexes(items)):
        found = rows.mapInArrow(tidied(_matches(spark.sparkContext.broadcast(index))), schema)
        out = found if k == 0 else out.unionByName(found)
    return out


def _clean(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for b in slices(batches, "text"):
            bad = {x[0] for x in verified(index, b.column("text"))}
            yield b.take(pa.array([i for i in range(b.num_rows) if i not in bad], pa.int64())) if bad else b

    return run


def cleaned(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item (see contaminated)."""
    for index in indexes(items):
        docs = docs.mapInArrow(tidied(_clean(docs.sparkSession.sparkContext.broadcast(index))), docs.schema)
    return docs
