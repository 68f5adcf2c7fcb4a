"""Quality rules: statistics of whole texts, fixed rules on them, and robust multivariate outliers per language and source. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.llm.common import dropped, stored

WORD = r"[^\x20\x09-\x0D]+"
#: Words in a window; two equal ones in a text are a repetition.
WINDOW = 8
#: Fixed rules: words at least, and percent of the words that repetitions may cover.
MIN_WORDS, MAX_REPEATED = 20, 30
#: Documents that an estimate needs: smaller groups share one per language, and those languages one for all.
MIN_GROUP = 50
#: Share of a group's documents that an estimate rests on.
SUPPORT = 0.75
#: Steps in one unit of a transformed statistic. Statistics are whole numbers of steps, so that sums of them and of their products are exact in any order (up to 10^10 documents in a group).
STEPS = 1024
#: Spread that each transformed statistic has at least (in units): statistics that are the same nearly everywhere reject nobody for less.
FLOORS = (0.5, 0.1, 0.35, 1.0, 1.0)
#: Slices of a squared distance's doubling, by which the nearest documents are found.
SLICES = 32
#: Concentration steps at most.
MOST_ROUNDS = 8

# Quantiles of the chi-squared distribution with 5 degrees of freedom, at SUPPORT and at 0.99999.
CHI_SUPPORT, CHI_REJECT = 6.6257, 30.8562

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
P = len(FLOORS)
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


def let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many of an array of words lie in windows that the array holds twice or more, the first included.

    Windows are compared by a hash of 64 bits. Where all differ, as in most texts, nothing more is done; otherwise they are sorted with their places, equal neighbours keep theirs, and of places in order each covers the words up to the next one, a window's length at most."""
    def hashed(h: Column, width: int = 1) -> Column:
        """Hashes of windows twice as wide, or as wide as wanted, from two that begin so far apart."""
        step = min(width, window - width)
        pairs = lambda a: F.zip_with(F.slice(a, F.lit(1), F.size(a) - step), F.slice(a, F.lit(1 + step), F.size(a) - step), lambda x, y: F.xxhash64(x, y))
        return let(h, pairs) if width + step == window else hashed(let(h, pairs), width + step)

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = lambda s: F.array_distinct(F.flatten(F.filter(neighbours(s, lambda a, b: F.when(a.h == b.h, F.array(a.i, b.i))), lambda x: x.isNotNull())))
        upto = lambda p: F.aggregate(neighbours(p, lambda a, b: F.least(b - a, F.lit(window))), F.lit(window), lambda acc, x: acc + x)
        return let(let(placed, lambda s: F.sort_array(twice(s))), upto)

    hashes = hashed(F.transform(words, lambda w: F.xxhash64(w)))
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))).cast("bigint")


def neighbours(items: Column, body) -> Column:
    """body of each element and the next."""
    return F.zip_with(F.slice(items, F.lit(1), F.size(items) - 1), F.slice(items, F.lit(2), F.size(items) - 1), body)


def duplicate_lines(text: Column) -> tuple[Column, Column]:
    """Lines with a word, and those of them that equal an earlier one."""
    counts = let(F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")), lambda lines: F.struct(F.size(lines).alias("n"), (F.size(lines) - F.size(F.array_distinct(lines))).alias("dup")))
    return counts.n.cast("bigint"), counts.dup.cast("bigint")


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_lines, and STATS): a row for each row of docs (doc_id, text, lang, source). Null text: as empty."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = lambda ws: F.struct(F.size(ws).cast("bigint").alias("n_words"), F.length(F.array_join(ws, "")).cast("bigint").alias("word_chars"), repeated_words(ws).alias("n_repeat_words"))
    n_lines, n_dup = duplicate_lines(text)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), told).alias("w"), F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"), F.struct(n_lines.alias("n"), n_dup.alias("dup")).alias("l"))
    return rows.select("doc_id", "lang", "source", "w.n_words", "w.word_chars", "n_symbols", F.col("l.dup").alias("n_dup_lines"), "w.n_repeat_words", F.col("l.n").alias("n_lines"))


def vector() -> list[Column]:
    """The transformed statistics, in whole steps: length, letters a word, and shares of symbols, repeated lines and repeated words, all as logarithms."""
    share = lambda part, whole: F.log1p(F.col(part) * 100 / F.greatest(F.col(whole), F.lit(1)))
    units = [F.log1p("n_words"), F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))), share("n_symbols", "word_chars"), share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")]
    return [F.round(u * STEPS).cast("bigint").alias(f"x{k}") for k, u in enumerate(units)]


def keyed(rows: DataFrame, least: int) -> DataFrame:
    """rows with `key`: their language and source if those have `least` rows; else one for all such sources of the language, or of all languages; null where even those are too few."""
    sizes = rows.groupBy("lang", "source").agg(F.count("*").alias("n"))
    small = F.when(F.col("n") < least, F.col("n")).otherwise(0)
    sizes = sizes.withColumn("rest", F.sum(small).over(W.partitionBy("lang")))
    few = F.when((F.col("n") < least) & (F.col("rest") < least), F.col("n")).otherwise(0)
    # A row for each language and source: the window without a key holds no more.
    sizes = sizes.withColumn("last", F.sum(few).over(W.partitionBy()))
    told = lambda *names: F.to_json(F.struct(*[F.col(n) for n in names]))
    key = F.when(F.col("n") >= least, F.concat(F.lit("2"), told("lang", "source"))).when(F.col("rest") >= least, F.concat(F.lit("1"), told("lang"))).when(F.col("last") >= least, F.lit("0"))
    sizes = stored(sizes.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), key.alias("key")), "groups")
    return rows.join(sizes, F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))).drop("_l", "_s")


def quartiles(rows: DataFrame) -> DataFrame:
    """(key, n, and for each statistic its median m and spread s) from counts of its values: exact, and a frequent value is one row a task."""
    long = rows.select("key", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"x{k}").alias("x")) for k in range(P)])).alias("v")).groupBy("key", "v.k", "v.x").agg(F.count("*").alias("n"))
    by = W.partitionBy("key", "k")
    long = long.withColumn("upto", F.sum("n").over(by.orderBy("x"))).withColumn("all", F.sum("n").over(by))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("x")))
    each = long.groupBy("key", "k").agg(at(0.25).alias("a"), at(0.5).alias("m"), at(0.75).alias("z"), F.max("all").alias("n"))
    floor = F.element_at(F.array(*[F.lit(f * STEPS) for f in FLOORS]), F.col("k") + 1)
    spread = F.greatest((F.col("z") - F.col("a")) / 1.349, floor)
    return each.groupBy("key").agg(F.max("n").alias("n"), *[F.max(F.when(F.col("k") == k, v)).alias(f"{name}{k}") for k in range(P) for name, v in (("m", F.col("m").cast("double")), ("s", spread))])


def moments(names: list[str]) -> list[Column]:
    """Exact sums c, t0..., u0_0... of whole numbers and of their products."""
    return [F.count("*").alias("c"), *[F.sum(x).alias(f"t{k}") for k, x in enumerate(names)], *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"u{i}_{j}") for i, j in LOWER]]


def whitened(rows: DataFrame, keep: list[str], centre: list[str], cov: dict[tuple[int, int], str]) -> DataFrame:
    """keep, the centre c0..., and the lower triangle w that turns deviations from it into uncorrelated ones of spread 1; det: the logarithm of the determinant. Each statistic's floor is added to its variance, so the matrix can be factored.

    Cholesky's factor f, column by column, then its inverse by forward substitution; each line may name what lines before it made."""
    less = lambda parts: "".join(f" - {x}" for x in parts)
    lines = [f"{c} AS c{k}" for k, c in enumerate(centre)]
    lines += [f"{v} + {(FLOORS[i] * STEPS) ** 2 if i == j else 0.0}D AS v{i}_{j}" for (i, j), v in cov.items()]
    for j in range(P):
        lines.append(f"sqrt(greatest(v{j}_{j}{less(f'f{j}_{k} * f{j}_{k}' for k in range(j))}, 0.001D)) AS f{j}_{j}")
        lines += [f"(v{i}_{j}{less(f'f{i}_{k} * f{j}_{k}' for k in range(j))}) / f{j}_{j} AS f{i}_{j}" for i in range(j + 1, P)]
    for i, j in LOWER:
        lines.append(f"1D / f{i}_{i} AS w{i}_{j}" if i == j else f"(0D{less(f'f{i}_{k} * w{k}_{j}' for k in range(j, i))}) / f{i}_{i} AS w{i}_{j}")
    det = " + ".join(f"ln(f{i}_{i})" for i in range(P))
    return rows.selectExpr(*keep, *lines, f"2 * ({det}) AS det").select(*keep, *[f"c{k}" for k in range(P)], *[f"w{i}_{j}" for i, j in LOWER], "det")


def covariance(i: int, j: int) -> str:
    """From moments c, t, u."""
    return f"u{i}_{j} / c - (t{i} / c) * (t{j} / c)"


def distance() -> Column:
    """The squared Mahalanobis distance of a row x0... from its estimate c0..., w."""
    parts = [" + ".join(f"w{i}_{j} * (x{j} - c{j})" for j in range(i + 1)) for i in range(P)]
    return F.expr(" + ".join(f"pow({part}, 2D)" for part in parts))


def starts(rows: DataFrame) -> DataFrame:
    """Three first estimates of each group (key, start, n, centre, w): medians with the statistics' own spreads; with the covariance of the tangent-bounded deviations; and with that of their directions."""
    centre = stored(quartiles(rows), "quartiles")
    z = [(F.col(f"x{k}") - F.col(f"m{k}")) / F.col(f"s{k}") for k in range(P)]
    norm = F.sqrt(sum((v * v for v in z), F.lit(0.0)))
    kinds = [[F.tanh(v) for v in z], [F.when(norm > 0, v / norm).otherwise(0.0) for v in z]]
    bounded = rows.join(centre, "key").select("key", F.explode(F.array(*[F.struct(F.lit(s + 1).alias("start"), *[F.round(v * STEPS).cast("bigint").alias(f"y{k}") for k, v in enumerate(vs)]) for s, vs in enumerate(kinds)])).alias("b"))
    bounded = bounded.select("key", "b.*").groupBy("key", "start").agg(*moments([f"y{k}" for k in range(P)])).join(centre, "key")
    medians = [f"m{k}" for k in range(P)]
    more = whitened(bounded, ["key", "start", "n"], medians, {(i, j): f"({covariance(i, j)}) * s{i} * s{j} / {STEPS**2}D" for i, j in LOWER})
    plain = whitened(centre.withColumn("start", F.lit(0)), ["key", "start", "n"], medians, {(i, j): f"s{i} * s{j}" if i == j else "0D" for i, j in LOWER})
    return plain.unionByName(more)


def concentrated(rows: DataFrame, fits: DataFrame, support: float) -> DataFrame:
    """The next estimates: of each group and start, from the documents nearest to the one before, `support` of them or a few more.

    Counts and moments are summed by slices of the distance, in one pass and before the shuffle; the slices up to the one that holds the last document wanted make the new estimate. `edge` is where that slice ends."""
    near = rows.join(fits, "key").withColumn("slice", F.floor(F.log2(1 + distance()) * SLICES))
    per = near.groupBy("key", "start", "n", "slice").agg(*moments([f"x{k}" for k in range(P)]))
    order = W.partitionBy("key", "start").orderBy("slice")
    per = per.withColumn("before", F.coalesce(F.sum("c").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).where(F.col("before") < F.col("n") * support)
    names = ["c", *[f"t{k}" for k in range(P)], *[f"u{i}_{j}" for i, j in LOWER]]
    met = per.groupBy("key", "start", "n").agg(F.max("slice").alias("last"), *[F.sum(c).alias(c) for c in names])
    met = met.withColumn("edge", F.pow(F.lit(2.0), (F.col("last") + 1) / SLICES) - 1)
    return whitened(met, ["key", "start", "n", "edge"], [f"t{k} / c" for k in range(P)], {(i, j): covariance(i, j) for i, j in LOWER})


def estimates(rows: DataFrame, support: float = SUPPORT, rounds: int = MOST_ROUNDS) -> DataFrame:
    """(key, n, edge, c0..., w..., det): the minimum-covariance-determinant estimate of each key of rows (key, x0...), the best of the starts after concentration. Steps go on until no determinant changes, or `rounds`; each is written to the shared folder."""
    fits = stored(starts(rows).withColumn("edge", F.lit(0.0)), "fits")
    sign = None
    for _ in range(rounds):
        after = stored(concentrated(rows, fits.drop("det", "edge"), support), "fits")
        dropped(fits)
        fits = after
        mark = fits.agg(F.count("*"), F.sum(F.hash("key", "start", F.round("det", 6)).cast("bigint"))).first()
        if mark == sign:
            break
        sign = mark
    best = fits.groupBy("key").agg(F.min(F.struct("det", "start")).alias("b")).select(F.col("key").alias("k"), F.col("b.start").alias("s"))
    return stored(fits.join(best, (F.col("key") == F.col("k")) & (F.col("start") == F.col("s"))).drop("k", "s"), "estimates")


def judged(docs: DataFrame, least: int = MIN_GROUP, support: float = SUPPORT, reject: float = CHI_REJECT) -> DataFrame:
    """(doc_id, STATS, base_failed, distance, kept): one row for each row of docs (doc_id, text, lang, source; other columns are ignored).

    base_failed: fewer than MIN_WORDS words, or more than MAX_REPEATED percent of them in repetitions. distance: the squared Mahalanobis distance of the transformed statistics from the estimate of the document's language and source, which rests on the documents that pass the fixed rules; scaled so that the share `support` of them has the distance that normal ones would have, but never enlarged. kept: passes the fixed rules and is not beyond `reject`.

    - null text: as empty, so it fails; null doc_id, lang or source: values like others; repeated rows: documents of their own; an empty table: no rows
    - groups with fewer than `least` passing documents are judged with the other small ones of their language, or of all; where even they are too few, by the fixed rules alone (distance null)
    - sums are exact, so reruns agree
    Statistics are made in one pass and stored; no text is ever shuffled."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    rows = stored(statistics(docs).withColumn("base_failed", failed), "statistics")
    passing = stored(keyed(rows.where("not base_failed").select("doc_id", "lang", "source", *STATS, *vector()), least), "vectors")
    fits = estimates(passing.where("key is not null").select("key", *[f"x{k}" for k in range(P)]), support)
    scale = F.greatest(F.col("edge") / CHI_SUPPORT, F.lit(1.0))
    held = passing.join(fits.drop("n", "start", "det"), "key", "left").select("doc_id", *STATS, F.lit(False).alias("base_failed"), (distance() / scale).alias("distance"))
    held = held.withColumn("kept", F.coalesce(F.col("distance") <= reject, F.lit(True)))
    lost = rows.where("base_failed").select("doc_id", *STATS, "base_failed", F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
    return held.unionByName(lost)
