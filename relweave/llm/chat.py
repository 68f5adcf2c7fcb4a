"""Chat formatting in budgeted windows with loss masks. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from relweave.llm.common import stored

#: Tokens in a window, and of those for repeated history; tokens are estimated from characters by default.
BUDGET, HISTORY = 2048, 256
CHARS_PER_TOKEN, TURN_TOKENS = 4, 4
#: Turns of a conversation beyond which its prefix sums are taken in two steps, over ranges of its turns; the result is the same.
LONG = 4096
#: What a long turn adds to a span's number: more than all shorter turns can.
CUT = 1 << 32

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>\n"


def escaped(text: Column) -> Column:
    r"""`<|` becomes `<\|`, and a `<` with backslashes before `|` gets one more: no control string is left, and nothing is lost."""
    return F.regexp_replace(text, r"<(\\*+)\|", r"<$1\\|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*+)\|", r"<$1|")


def escaped_role(role: Column) -> Column:
    """A role stands in a line of its own, so line breaks are percent-encoded too."""
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("<|"), F.lit("<%7C"))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def estimated_tokens(shown: Column) -> Column:
    """Tokens of a turn as it is formatted, from its characters: four of them a token, and four tokens a turn."""
    return F.ceil(F.length(shown) / CHARS_PER_TOKEN) + TURN_TOKENS


def _shown(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), escaped_role(role), F.lit("\n"), escaped(text), F.lit(END))


def windows(rows: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = estimated_tokens) -> DataFrame:
    """(conv_id, window, text, tokens, over, repeated, loss, none, c) from rows (conv_id, turn, role, text; other columns are ignored).

    A conversation's turns stand in the order of turn (nulls last), role and text; `window` orders its windows. `tokens` counts a formatted turn's tokens. A window has `budget` tokens: the system turn (the first turn, if its role is system), as many of the last turns of the span before as fit in `history`, and its own span of whole turns. Prefix sums over the conversation choose the spans: of the room that the system turn and history leave, turns up to a quarter long begin in the same three quarters; a longer turn has a span of its own. So a window keeps to the budget, unless a single turn is longer than the room: `over` tells. repeated: how many turns at its beginning came in earlier windows; loss: array<struct<start, end>> in code points, the texts of assistant turns that are not repeated. none and c (whether conv_id is null, and conv_id or 0) are what windows lie by in their tasks.

    - null text or role: empty; null conv_id: one conversation like others; gaps in turn, equal and null ones only order the turns
    - repeated rows: turns of their own; empty table: no rows
    A conversation lies in one task and its texts are dealt out once. Those of more than LONG turns are ranged by their turns instead, sums are taken within ranges and across them, and only their windows are put together: no task holds more of them than ranges or windows."""
    turns = rows.select(F.col("conv_id").isNull().alias("none"), F.coalesce(F.col("conv_id").cast("bigint"), F.lit(0)).alias("c"), F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = turns.withColumn("late", F.col("turn").isNull())
    long = stored(turns.groupBy("none", "c").agg(F.count("*").alias("turns")).where(F.col("turns") > LONG).select("none", "c"), "long")
    if long.isEmpty():
        return _formatted(_short(turns, budget, history, tokens), budget)
    some = _formatted(_short(turns.join(long, ["none", "c"], "left_anti"), budget, history, tokens), budget)
    return some.unionByName(_formatted(_ranged(turns.join(long, ["none", "c"], "left_semi"), budget, history, tokens), budget))


def _measured(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """turns (tokens, lead, is_lead) with what their spans are summed from."""
    room = F.greatest(F.lit(budget - history) - F.col("lead"), F.lit(1))
    turns = turns.withColumn("room", room).withColumn("most", F.greatest(F.floor(F.col("room") / 4), F.lit(1)))
    turns = turns.withColumn("is_long", (~F.col("is_lead") & (F.col("tokens") > F.col("most"))).cast("bigint"))
    return turns.withColumn("short", F.when(F.col("is_lead") | (F.col("is_long") == 1), 0).otherwise(F.col("tokens")).cast("bigint"))


def _span() -> Column:
    """The span of a turn, from sums up to and with it: each long turn ends the span before it and begins one of its own."""
    return F.when(~F.col("is_lead"), (2 * F.col("longs") - F.col("is_long")) * CUT + F.floor((F.col("shorts") - F.col("short")) / F.greatest(F.col("room") - F.col("most"), F.lit(1))))


def _again(history: int) -> Column:
    """Whether a turn comes again as history of the next span."""
    return ~F.col("is_lead") & F.col("next").isNotNull() & (F.col("end") - F.col("all") + F.col("tokens") <= history)


def _short(turns: DataFrame, budget: int, history: int, tokens: Callable[[Column], Column]) -> DataFrame:
    """Turns with their spans, by windows over whole conversations."""
    inside = W.partitionBy("none", "c").orderBy("late", "turn", "role", "text")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    shown = _shown(F.col("role"), F.col("text"))
    turns = turns.withColumn("n", F.row_number().over(inside).cast("bigint")).withColumn("head", F.first(F.when(F.col("role") == "system", shown)).over(upto))
    turns = turns.withColumn("tokens", tokens(shown).cast("bigint")).withColumn("lead", F.when(F.col("head").isNotNull(), tokens(F.col("head")).cast("bigint")).otherwise(0))
    turns = _measured(turns.withColumn("is_lead", F.col("head").isNotNull() & (F.col("n") == 1)), budget, history)
    turns = turns.withColumns({"all": F.sum("tokens").over(upto), "longs": F.sum("is_long").over(upto), "shorts": F.sum("short").over(upto)}).withColumn("span", _span())
    turns = turns.withColumn("span", F.coalesce("span", F.lead("span").over(inside), F.lit(0)))
    spans = W.partitionBy("none", "c").orderBy("span")
    turns = turns.withColumn("end", F.max("all").over(spans.rangeBetween(0, 0))).withColumn("next", F.min("span").over(spans.rangeBetween(1, W.unboundedFollowing)))
    return turns.select("none", "c", "n", "role", "text", "head", "lead", "is_lead", "tokens", "span", "next", _again(history).alias("again"))


def _ranged(turns: DataFrame, budget: int, history: int, tokens: Callable[[Column], Column]) -> DataFrame:
    """The same, by ranges of turns: what is summed are rows without texts, within a range and then across the ranges of a conversation."""
    order = ["none", "c", "late", "turn", "role", "text"]
    ranges = turns.withColumn("tie", F.xxhash64(F.monotonically_increasing_id())).repartitionByRange(*order, "tie").sortWithinPartitions(*order, "tie").drop("tie", "late", "turn")
    ranges = stored(ranges.withColumn("n", F.monotonically_increasing_id()), "ranges")
    shown = _shown(F.col("role"), F.col("text"))
    firsts = ranges.groupBy("none", "c").agg(F.min("n").alias("first"))
    heads = ranges.join(firsts.select(F.col("first").alias("n")), "n", "left_semi").where("role = 'system'").select("none", "c", shown.alias("head"), tokens(shown).cast("bigint").alias("lead"))
    firsts = stored(firsts.join(heads, ["none", "c"], "left").withColumn("lead", F.coalesce("lead", F.lit(0))), "heads")
    slim = ranges.select("none", "c", "n", F.shiftright("n", 33).alias("range"), tokens(shown).cast("bigint").alias("tokens"))
    slim = slim.join(firsts.select("none", "c", "first", "lead", F.col("head").isNotNull().alias("led")), ["none", "c"]).withColumn("is_lead", F.col("led") & (F.col("n") == F.col("first")))
    slim = stored(_measured(slim, budget, history).drop("first", "led"), "measured")
    across = W.partitionBy("none", "c").orderBy("range")  # a row for each range that the conversation is in
    sums = {"all": "tokens", "longs": "is_long", "shorts": "short"}
    before = slim.groupBy("none", "c", "range").agg(*[F.sum(x).alias(k) for k, x in sums.items()])
    before = before.select("none", "c", "range", *[F.coalesce(F.sum(k).over(across.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(f"{k}_before") for k in sums])
    inside = W.partitionBy("none", "c", "range").orderBy("n")
    upto = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = slim.withColumns({k: F.sum(x).over(upto) for k, x in sums.items()}).join(before, ["none", "c", "range"])
    summed = stored(summed.withColumns({k: F.col(k) + F.col(f"{k}_before") for k in sums}).withColumn("span", _span()).drop(*[f"{k}_before" for k in sums]), "summed")
    # The system turn goes with the first of the others.
    least = summed.groupBy("none", "c").agg(F.coalesce(F.min("span"), F.lit(0)).alias("least"))
    summed = summed.join(least, ["none", "c"]).withColumn("span", F.coalesce("span", "least"))
    # What follows a turn at its range's end is the next range's first.
    after = summed.groupBy("none", "c", "range").agg(F.min("span").alias("own")).select("none", "c", "range", F.lead("own").over(across).alias("after"))
    spans = summed.withColumn("follows", F.lead("span").over(inside)).join(after, ["none", "c", "range"]).withColumn("follows", F.coalesce("follows", "after"))
    spans = spans.groupBy("none", "c", "span").agg(F.max("all").alias("end"), F.max(F.when(F.col("follows") > F.col("span"), F.col("follows"))).alias("next"))
    known = summed.join(stored(spans, "spans"), ["none", "c", "span"]).select("n", "lead", "is_lead", "tokens", "span", "next", _again(history).alias("again"))
    # A head comes with a span's first turn alone.
    begins = summed.groupBy("none", "c", "span").agg(F.min("n").alias("n")).join(firsts.where("head is not null").select("none", "c", "head"), ["none", "c"]).select("n", "head")
    return ranges.join(known, "n").join(begins, "n", "left").select("none", "c", "n", "role", "text", "head", "lead", "is_lead", "tokens", "span", "next", "again")


def _formatted(turns: DataFrame, budget: int) -> DataFrame:
    """Windows of turns (none, c, n, role, text, head, lead, is_lead, tokens, span, next, again)."""
    shown = _shown(F.col("role"), F.col("text"))
    kind = lambda span, part: F.struct(span.alias("span"), F.lit(part).alias("part"))
    # part: 1 history, 2 the window's own turns.
    own = turns.withColumn("to", F.explode(F.when(F.col("again"), F.array(kind(F.col("span"), 2), kind(F.col("next"), 1))).otherwise(F.array(kind(F.col("span"), 2)))))
    own = own.select("none", "c", "to.span", F.when(F.col("to.part") == 2, F.col("head")).alias("head"), "lead", "is_lead", "tokens", F.struct("to.part", "n", shown.alias("shown"), F.length(escaped(F.col("text"))).alias("chars"), "role").alias("t"))
    made = own.groupBy("none", "c", "span").agg(F.array_sort(F.collect_list("t")).alias("turns"), F.sum("tokens").alias("tokens"), F.max("lead").alias("lead"), F.when(F.max("is_lead"), "").otherwise(F.coalesce(F.first("head", ignorenulls=True), F.lit(""))).alias("head"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    end = lambda acc, t: acc.at + F.length(t.shown) - len(END)
    mask = lambda acc, t: F.when((t.part == 2) & (t.role == "assistant"), F.array(F.struct((end(acc, t) - t.chars).alias("start"), end(acc, t).alias("end")))).otherwise(none)
    loss = F.aggregate("turns", F.struct(F.length("head").alias("at"), none.alias("loss")), lambda acc, t: F.struct((acc.at + F.length(t.shown)).alias("at"), F.concat(acc.loss, mask(acc, t)).alias("loss")), lambda acc: acc.loss)
    total = F.col("tokens") + F.when(F.col("head") != "", F.col("lead")).otherwise(0)
    return made.select(
        F.when(~F.col("none"), F.col("c")).alias("conv_id"), F.col("span").alias("window"), F.concat("head", F.array_join(F.transform("turns", lambda t: t.shown), "")).alias("text"),
        total.alias("tokens"), (total > budget).alias("over"), (F.size(F.filter("turns", lambda t: t.part < 2)) + (F.col("head") != "").cast("int")).alias("repeated"), loss.alias("loss"), "none", "c",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """formatted with turns, loss_texts and chars, from windows' text, repeated and loss alone: array<struct<role, text>> of the turns that are not repeated, the texts under the mask, both unescaped, and the length of the text."""
    pieces = F.split("text", r"<\|im_end\|>\n", -1)
    fresh = F.slice(pieces, F.col("repeated") + 1, F.size(pieces) - F.col("repeated") - 1)
    body = lambda p: F.substring(p, F.lit(len(START) + 1), F.length(p))
    turn = lambda p: F.struct(unescaped_role(F.substring_index(body(p), "\n", 1)).alias("role"), unescaped(F.substring(body(p), F.instr(body(p), "\n") + 1, F.length(p))).alias("text"))
    return formatted.withColumns({"turns": F.transform(fresh, turn), "loss_texts": F.transform("loss", lambda s: unescaped(F.substring(F.col("text"), s.start + 1, s.end - s.start))), "chars": F.length("text")})


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: n_turns, turns_sha256 (role, line break, text, line break of each turn), loss_chars, loss_sha256, formatted_chars.

    A hash is one over all texts of a conversation, so its windows are put together where they lie and hashed; that holds for conversations of up to 2 GB."""
    told = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    back = read_back(formatted).select("none", "c", F.size("turns").alias("n"), F.struct("window", told.alias("told"), F.array_join("loss_texts", "").alias("loss")).alias("w"), "chars")
    whole = back.groupBy("none", "c").agg(F.sum("n").cast("bigint").alias("n"), F.sum("chars").cast("bigint").alias("chars"), F.array_sort(F.collect_list("w")).alias("w"))
    whole = whole.select("none", "c", "n", "chars", F.array_join("w.told", "").alias("told"), F.array_join("w.loss", "").alias("loss"))
    hashed = lambda text: F.sha2(F.col(text).cast("binary"), 256)
    return whole.select(F.when(~F.col("none"), F.col("c")).alias("conv_id"), F.col("n").alias("n_turns"), hashed("told").alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"), hashed("loss").alias("loss_sha256"), F.col("chars").alias("formatted_chars"))
