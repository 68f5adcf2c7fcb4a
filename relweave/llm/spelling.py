"""Spelling variants: words one edit apart, by a positional q-gram index with a count filter, and the frequent form that each stands for."""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relweave.llm.common import LOWER, dropped, slices, stored, tidied

#: Code points in a gram. A word of n code points, padded, has n + Q - 1 grams; one edit changes Q of them at most.
Q = 3
#: Code points and occurrences of a word at least; how many times as frequent a form is.
MIN_LENGTH, MIN_COUNT, TIMES = 7, 2, 10
#: Words counted in a task before they are sent on.
HELD = 200_000
#: Places of hashed grams: the table of their frequencies has so many numbers (8 MB), whatever the words.
GRAMS = 1 << 20
#: Words of a posting list that are compared at once; longer lists are divided and their parts met in pairs.
LIST_WORDS = 2048

# What a word is made of, and the case that is folded.
RUNS = "[A-Za-zÀ-ÿ]{%d,}"
FOLD = {i: int(LOWER[i]) for i in range(65, 91)}


def _counted(changed: int, least: int):
    """(word, n): how often each word comes in a task's texts."""
    runs = re.compile(RUNS % least)

    def told(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for b in slices(batches, "text"):
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                # Plain texts are folded at once; in others only their distinct words, as each code point is looked up.
                plain = text.isascii()
                for word, n in Counter(runs.findall(text.lower() if plain else text)).items():
                    if not plain:
                        word = word.lower() if word.isascii() else word.translate(FOLD)
                    h = zlib.crc32(word.encode(), begun) if changed else 1
                    if changed and h % changed == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < least:
                            continue
                    held[word] += n
            if len(held) >= HELD:
                yield told(held)
                held = Counter()
        if held:
            yield told(held)

    return run


def vocabulary(docs: DataFrame, changed: int = 31, least: int = MIN_LENGTH, count: int = MIN_COUNT) -> DataFrame:
    """(word, n): the words of docs (doc_id, text), as long as `least` code points and found `count` times or more.

    Words are maximal runs of Latin letters, A-Z in lower case. changed: of every so many pairs of document and word, by crc32 of `<doc_id>:<word>` (null id: empty), one loses a code point, which makes variants to be found; 0 for none. Null texts have no words."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    words = rows.mapInArrow(tidied(_counted(changed, least)), "word string, n bigint")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= count)


def grams(word: str) -> list[int]:
    """The hashed grams of a padded word, by place. Grams that share a hash only make more candidates."""
    p = [0] * (Q - 1) + [ord(c) for c in word] + [0] * (Q - 1)
    return [(p[i] * 0x9E3779B1 ^ p[i + 1] * 0x85EBCA77 ^ p[i + 2] * 0xC2B2AE3D) * 0x27D4EB2F >> 7 & (GRAMS - 1) for i in range(len(p) - Q + 1)]


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(GRAMS, np.int64)
    for b in batches:
        for word in b.column("word").to_pylist():
            np.add.at(n, grams(word), 1)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at])], ["gram", "n"])


def gram_ranks(words: DataFrame) -> np.ndarray:
    """The rank of each hashed gram, rare ones first; GRAMS numbers, however many words there are."""
    n = np.zeros(GRAMS, np.int64)
    table = words.select("word").mapInArrow(tidied(_frequencies), "gram int, n bigint").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    n[table.column("gram").to_numpy()] = table.column("n").to_numpy()
    rank = np.empty(GRAMS, np.int32)
    rank[np.argsort(n, kind="stable")] = np.arange(GRAMS, dtype=np.int32)
    return rank


def _postings(shared):
    """A row for each list that a word is in: of its rarest grams, enough that words one edit apart share a list.

    Lists are kept by gram, length and place. A word is in those of its own length (`own`) and, as the shorter one of a pair, in those of words longer by one, at its gram's place and the next. Of two words one edit apart, the longer (or either) with m code points, m - 1 grams are the same: so all but Q of its own grams, and all but Q - 1 of a shorter one's. One more than that in the order of rarity must meet. at: the gram's place in the word; earlier: the places of its rarer grams, as 32-bit numbers."""

    def prefix(word: str, rank: np.ndarray, size: int) -> tuple[list[int], list[int]]:
        g = grams(word)
        order = sorted(range(len(g)), key=lambda i: (rank[g[i]], i))
        last = rank[g[order[size - 1]]]
        return g, [i for i in order if rank[g[i]] <= last]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank = shared.value
        for b in batches:
            out: list[tuple[int, int, int, bool, str, int, int, bytes]] = []
            for word, n in zip(b.column("word").to_pylist(), b.column("n").to_pylist(), strict=True):
                m = len(word)
                g, own = prefix(word, rank, Q + 1)
                rarer = np.array(own, "<i4").tobytes()
                out += [(g[i], m, i, True, word, n, i, rarer[: 4 * r]) for r, i in enumerate(own[: Q + 1])]
                out += [(g[i], m + 1, k, False, word, n, i, rarer[: 4 * r]) for r, i in enumerate(own[:Q]) for k in (i, i + 1)]
            cols = list(zip(*out, strict=True)) if out else [()] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["gram", "length", "place", "own", "word", "n", "at", "earlier"])

    return run


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes b of a."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def near_in(words: list[tuple[bool, str, int, int, int, bytes]], length: int, apart: bool) -> Iterator[tuple[int, int]]:
    """Pairs of places in one list (own, word, n, side, at, earlier) of words one edit apart; own ones have `length` code points, others one less, and all have the list's gram.

    Own words are indexed by gram and place. A pair is met in the list of the first of the probe's rare grams that its partner has: so the list's gram is the same, the earlier ones are not, and of the others so many fewer may differ - Q, or Q - 1 for shorter probes, without the earlier ones. Any partner is then in one of that many posting lists and one more, so the shortest are taken. They hold ascending numbers and are merged by a heap; a word met there is a candidate if it has as many grams at the probe's places as one edit leaves; candidates are verified."""
    padded = [("\0" * (Q - 1) + w[1] + "\0" * (Q - 1)) for w in words]
    of = [[p[i : i + Q] for i in range(len(p) - Q + 1)] for p in padded]
    index: list[dict[str, list[int]]] = [{} for _ in range(length + Q - 1)]
    for k, w in enumerate(words):
        if w[0]:
            for at, g in zip(index, of[k], strict=True):
                if g in at:
                    at[g].append(k)
                else:
                    at[g] = [k]
    for k, (own, word, _, side, at, earlier) in enumerate(words):
        rarer = memoryview(earlier).cast("i").tolist() if earlier else []
        left = (Q if own else Q - 1) - len(rarer) + 1
        if left < 1:
            continue
        a, known = of[k], {at, *rarer}
        if own:
            lists = [p[g] for p, g in zip(index, a, strict=True)]
            rest = sorted([(len(x), i) for i, x in enumerate(lists) if i not in known])[:left]
            # Of two own words the first probes.
            shortest = [lists[i] for _, i in rest if lists[i][-1] > k]
        else:
            pairs = [(p.get(g, ()), q.get(g, ())) for p, q, g in zip(index, index[1:], a, strict=False)]
            rest = sorted([(len(x) + len(y), i) for i, (x, y) in enumerate(pairs) if i not in known])[:left]
            shortest = [x for _, i in rest for x in pairs[i] if x]
        if not shortest:
            continue
        for j, _ in groupby(heapq.merge(*shortest) if len(shortest) > 1 else shortest[0]):
            # Parts of a divided list only meet each other.
            if (own and j <= k) or (apart and words[j][3] == side):
                continue
            b = of[j]
            for i in rarer:
                if a[i] == b[i] or (not own and a[i] == b[i + 1]):
                    break
            else:
                same = sum(map(eq, a, b)) if own else sum(x == y or x == z for x, y, z in zip(a, b, b[1:], strict=False))
                if same >= length - 1 and one_edit(word, words[j][1]):
                    yield k, j


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, n_a, b, n_b) of pairs of words one edit apart, list by list."""
    key: tuple | None = None
    words: list[tuple[bool, str, int, int, int, bytes]] = []
    out: list[tuple[str, int, str, int]] = []

    def done() -> None:
        if len(words) > 1 and any(w[0] for w in words):
            out.extend((words[i][1], words[i][2], words[j][1], words[j][2]) for i, j in near_in(words, key[1], key[3] != key[4]))

    for b in batches:
        if not b.num_rows:
            continue
        cols = [b.column(c).to_numpy() for c in ("gram", "length", "place", "x", "y")]
        rows = list(zip(*(b.column(c).to_pylist() for c in ("own", "word", "n", "side", "at", "earlier")), strict=True))
        cuts = [0, *(1 + np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0))).tolist(), len(rows)]
        for a, z in zip(cuts, cuts[1:], strict=False):
            now = tuple(int(c[a]) for c in cols)
            if now != key:
                done()
                key, words = now, []
            words += rows[a:z]
        if len(out) >= 10_000:
            yield _pairs(out)
            out.clear()
    done()
    yield _pairs(out)


def _pairs(out: list[tuple[str, int, str, int]]) -> pa.RecordBatch:
    cols = list(zip(*out, strict=True)) if out else [()] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.string(), pa.int64()), strict=True)], ["a", "n_a", "b", "n_b"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b): each pair of words (word, n; no word twice) that differ by exactly one inserted, deleted or replaced code point, once. Words need 2 * Q + 1 code points or more, so that pairs share grams.

    A list of more than LIST_WORDS words is divided by a hash, and each two of its parts meet in a task of their own: no task holds more than two parts."""
    spark = words.sparkSession
    words = words.where(F.length("word") > 2 * Q)
    shared = spark.sparkContext.broadcast(gram_ranks(words))
    lists = stored(words.mapInArrow(tidied(_postings(shared)), "gram int, length int, place int, own boolean, word string, n bigint, at int, earlier binary"), "postings")
    key = ["gram", "length", "place"]
    # Lists without two words, or without one of their length, have no pairs.
    sizes = lists.groupBy(*key).agg(F.count("*").alias("c"), F.max("own").alias("any")).where("c > 1 and any")
    parts = sizes.select(*key, F.ceil(F.col("c") / LIST_WORDS).cast("int").alias("parts"))
    side = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")
    met = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(k, F.col("side")).alias("x"), F.greatest(k, F.col("side")).alias("y")))
    placed = lists.join(stored(parts, "parts"), key).withColumn("side", side).withColumn("p", F.explode(met)).select(*key, "p.x", "p.y", "own", "word", "n", "side", "at", "earlier")
    placed = placed.repartition(*key, "x", "y").sortWithinPartitions(*key, "x", "y", "word")
    return stored(placed.mapInArrow(tidied(_near), "a string, n_a bigint, b string, n_b bigint").distinct(), "near")


def followed(forms: DataFrame) -> DataFrame:
    """(word, root) of forms (word, form): each word's last form. A form is more frequent than its word, so there are no rings; each round goes twice as far as the one before."""
    now = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        step = now.select(F.col("word").alias("w"), F.col("root").alias("next"))
        after = stored(now.join(step, F.col("root") == F.col("w"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        dropped(now)
        now = after
        if now.where("moved").isEmpty():
            return now.drop("moved")


def variants(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n): one row for each row of words (word, n).

    n_near: other words one edit apart. form: the most frequent of them (ties: the smallest by code points) if it is `times` as frequent as the word or more, else null; form_n: its n. root: the last of the forms that begin with the word's; the word itself if it has none.
    - null words are left out; a word must not come twice; words shorter than 2 * Q + 1 code points have no near ones; an empty table: no rows"""
    words = stored(words.where("word is not null").select("word", F.col("n").cast("bigint").alias("n")), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("n_b").alias("m")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other"), F.col("n_a").alias("m")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("m")).alias("m"), "other")).alias("best"))
    met = words.join(best, "word", "left")
    yes = -F.col("best.m") >= F.col("n") * times
    met = stored(met.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(yes, F.col("best.other")).alias("form"), F.when(yes, -F.col("best.m")).alias("form_n")), "forms")
    roots = followed(met.where("form is not null"))
    return met.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
