"""Mixing sources to target weights by a low-discrepancy schedule. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.llm.common import stored

#: Words in a block.
BLOCK_WORDS = 512
#: Slots in a chunk of the schedule: ranks are counted within chunks and then across them.
CHUNK_SLOTS = 4096
#: Rows of a bucket of the prefix sums, about (more where there would be more than 2^20 buckets).
BUCKET_ROWS = 250
#: The golden ratio's fraction, which makes the points of the schedule.
GOLDEN = 0.6180339887498949
#: How often a source is repeated at most.
REPEATS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def targets(sources: DataFrame, cycle: tuple[int, ...] = (5, 2, 1), repeats: int = REPEATS) -> DataFrame:
    """sources (source, source_size) with weight and target.

    Sources by code point, null last, weigh as the cycle says. Targets share the sum of all sizes by weight and stop at repeats * source_size; the excess goes to the others by weight until none is above: the level at which the rest share is found from sums over the sources ordered by where they stop. The window without a key holds a row per source."""
    order = W.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*map(F.lit, cycle)), F.pmod(F.row_number().over(order) - 1, F.lit(len(cycle))).cast("int") + 1).cast("double")
    ranked = sources.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * repeats).cast("double")).withColumn("stop", F.col("cap") / F.col("weight"))
    by = W.orderBy("stop", F.col("source").isNull(), "source")
    before = by.rowsBetween(W.unboundedPreceding, -1)
    rest = by.rowsBetween(W.currentRow, W.unboundedFollowing)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest)
    levels = ranked.withColumn("level", level).withColumn("n", F.row_number().over(by))
    # The first source, in that order, that stays under where it stops; up to rounding none may, and then all stop.
    under = F.min_by("level", F.when(F.col("level") <= F.col("stop"), F.col("n"))).over(everything)
    levels = levels.withColumn("at", F.coalesce(under, F.max("stop").over(everything)))
    return levels.select("source", "source_size", "weight", F.least(F.col("cap"), F.col("at") * F.col("weight")).alias("target"))


def prefix(df: DataFrame, key: str, order: list[Column], bucket: Column, value: str, out: str) -> DataFrame:
    """df with `out`: the sum of value over the rows of its key that come before.

    In two steps, so that a key with a third of all rows is spread over its buckets (which must be in the order's order): within buckets, and over the buckets' sums."""
    df = df.withColumn("_bucket", bucket)
    sums = df.groupBy(key, "_bucket").agg(F.sum(value).alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(W.partitionBy(key).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("_before", before).select(F.col(key).alias("_key"), F.col("_bucket").alias("_b"), "_before")
    within = F.coalesce(F.sum(value).over(W.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inner = df.withColumn("_within", within)
    return inner.join(sums, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_bucket") == F.col("_b"))).withColumn(out, (F.col("_within") + F.col("_before")).cast("bigint")).drop("_bucket", "_within", "_key", "_b", "_before")


def schedule(sources: DataFrame) -> DataFrame:
    """(slot, sid, rank): which block of which source comes at each slot, from sources (sid, quota, lo, hi).

    Slot i falls at frac((i + 1) * golden ratio) of the sum of all targets; the source whose interval [lo, hi) holds it gives its next block. Ranks are counted in chunks of slots and summed across chunks. Points are spread so evenly that a source's share of any first slots is its share of the whole but for a few; so a source's quota is used up some slots before the end or some blocks are left over. Slots of a source that has given its quota go to the blocks that are left, those of the first sources first; every slot below the sum of quotas has one block."""
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    # A plain range: the planner knows its size and never broadcasts it, as it would rows that it takes for few because a sequence is exploded.
    slots = spark.range(0, total).select(F.floor(F.col("id") / CHUNK_SLOTS).alias("chunk"), F.col("id").alias("slot"))
    point = (F.col("slot") + 1) * F.lit(GOLDEN)
    slots = slots.withColumn("u", point - F.floor(point))
    # The sources' intervals are cut at a fixed grid, so that slots find theirs by an equal cell and not by a range join.
    grid = 1024
    cells = sources.where("hi > lo").withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * grid), F.floor(F.least(F.col("hi"), F.lit(1 - 1e-12)) * grid)))).select("sid", "quota", "lo", "hi", "cell")
    chosen = slots.withColumn("cell", F.floor(F.col("u") * grid)).join(cells, "cell").where("u >= lo and u < hi").select("chunk", "slot", "sid", "quota")
    counts = chosen.groupBy("chunk", "sid").agg(F.count("*").alias("n"))
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("sid").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    ranked = chosen.withColumn("r", F.row_number().over(W.partitionBy("chunk", "sid").orderBy("slot")) - 1).join(counts.select("chunk", "sid", "before"), ["chunk", "sid"])
    ranked = stored(ranked.select("slot", "sid", "quota", (F.col("r") + F.col("before")).alias("rank")), "slots")
    given = ranked.groupBy("sid").agg(F.count("*").alias("given"))
    # Few of either, by the points' discrepancy: windows without a key number them.
    left = sources.join(given, "sid", "left").where("quota > coalesce(given, 0)").select("sid", F.explode(F.sequence(F.coalesce("given", F.lit(0)), F.col("quota") - 1)).alias("rank"))
    left = left.withColumn("k", F.row_number().over(W.orderBy("sid", "rank")))
    free = ranked.where("rank >= quota").select("slot", F.row_number().over(W.orderBy("slot")).alias("k"))
    return ranked.where("rank < quota").select("slot", "sid", "rank").unionByName(left.join(free, "k").select("slot", "sid", "rank"))


def mix(docs: DataFrame, block: int = BLOCK_WORDS, cycle: tuple[int, ...] = (5, 2, 1), repeats: int = REPEATS, seed: str = "mix", key: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(per document, blocks): what the mix of docs (doc_id, text, source; other columns are ignored) takes, and its blocks.

    Per document, one row for each row of docs: row, doc_id, size (words), source_size, target, taken (words the mix takes, repeats counted), first_slot (of its blocks in the schedule; null if none) and n_blocks. Blocks: slot, sid (number of the source), rank, row, doc_id, pass (which repeat of its source's words, from 0), from_word, n_words: which words of which documents each block holds. row is the column `key` of docs, a long that no two rows share, or else a number given here.

    A source's documents stand in the order of a hash of seed and doc_id, its words are repeated as often as its target needs, and cut into blocks of equal length; the block of rank r goes to the source's r-th slot, and the last one is cut at the target, rounded to a word. So each source gives its target, and no document more than `repeats` times its words.
    - null text, texts without words: size 0, taken 0; null doc_id or source: values like others (sources: last)
    - repeated rows: documents of their own, in any order among themselves; empty table: no rows"""
    row = F.col(f"`{key}`").cast("bigint") if key else F.monotonically_increasing_id()
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), words(F.col("text")).alias("size"))
    rows = rows.withColumn("place", F.md5(F.concat(F.lit(seed + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary")))
    rows = stored(rows, "sizes")
    per_source = stored(targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, repeats).withColumn("sid", F.row_number().over(W.orderBy(F.col("source").isNull(), "source"))), "targets")
    whole = F.greatest(F.sum("target").over(W.partitionBy()), F.lit(1.0))
    upto = F.sum("target").over(W.orderBy("sid"))
    plan = per_source.withColumn("hi", upto / whole).withColumn("goal", F.round("target").cast("bigint")).withColumn("quota", F.ceil(F.col("goal") / block).cast("bigint"))
    plan = plan.withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("sid")), F.lit(0.0))).withColumn("hi", F.when(F.col("sid") == F.max("sid").over(W.partitionBy()), 1.0).otherwise(F.col("hi")))
    plan = stored(plan, "plan")
    sourced = rows.join(plan.select(F.col("source").alias("s"), "source_size", "target", "sid", "goal"), F.col("source").eqNullSafe(F.col("s"))).drop("s", "source")
    # Buckets follow the order of the hash and their number the rows, so none holds more than some hundreds of any source; the result doesn't depend on it.
    buckets = max(1, min(1 << 20, rows.count() // BUCKET_ROWS))
    bucket = F.floor(F.conv(F.substring("place", 1, 8), 16, 10).cast("double") / 4294967296.0 * buckets)
    placed = prefix(sourced.where("size > 0"), "sid", [F.col("place"), F.col("doc_id"), F.col("size"), F.col("row")], bucket, "size", "start")
    # Each repeat of a document, cut where its source's words stop, and then at the blocks.
    passes = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))))
    passes = passes.withColumn("a", F.col("start") + F.col("pass") * F.col("source_size")).withColumn("z", F.least(F.col("a") + F.col("size"), F.col("goal"))).where("a < z")
    pieces = passes.withColumn("rank", F.explode(F.sequence(F.floor(F.col("a") / block), F.floor((F.col("z") - 1) / block))))
    at, to = F.greatest(F.col("a"), F.col("rank") * block), F.least(F.col("z"), (F.col("rank") + 1) * block)
    pieces = pieces.select("sid", "rank", "row", "doc_id", "pass", (at - F.col("a")).alias("from_word"), (to - at).alias("n_words"))
    blocks = schedule(plan.select("sid", "quota", "lo", "hi")).join(pieces, ["sid", "rank"]).select("slot", "sid", "rank", "row", "doc_id", "pass", "from_word", "n_words")
    # A document's pieces of one pass lie in blocks of their own; of two passes, in one block only if its source is shorter than a block.
    taken = blocks.groupBy("row").agg(F.sum("n_words").alias("taken"), F.min("slot").alias("first_slot"), F.size(F.collect_set("rank")).cast("bigint").alias("n_blocks"))
    per_doc = sourced.select("row", "doc_id", "size", "source_size", "target").join(taken, "row", "left")
    return per_doc.select("row", "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"), "first_slot", F.coalesce("n_blocks", F.lit(0)).cast("bigint").alias("n_blocks")), blocks
