"""Column functions: everything here is a native expression that stays inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How sure a predicate of each type makes an edge, and what identifier columns add.
BASE_CONFIDENCE = {"eq_column_column": 0.60, "casted_eq": 0.75, "eq_expression": 0.70, "range_or_inequality": 0.55, "function_based": 0.50, "composite_predicate": 0.65}
UNKNOWN_CONFIDENCE, ID_BONUS, KEY_PAIR_BONUS, CONFIDENCE_CAP = 0.45, 0.10, 0.15, 0.95


def ratio(part: Column, whole: Column, empty: float = 0.0) -> Column:
    """part / whole as double; `empty` where whole is not positive or null."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(empty))


def number(value: Column, missing: float = 0.0) -> Column:
    """A double from a string or number; blanks, NaN and what isn't a number are missing."""
    x = value.cast("string").try_cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(missing)).otherwise(x)


def ident(name: Column) -> Column:
    """An identifier without blanks and quotes around it, in upper case."""
    return F.upper(F.regexp_replace(F.trim(name), r'^"+|"+$', ""))


def table_ident(name: Column) -> Column:
    """The last part of a dotted name; UNKNOWN if there is none."""
    parts = F.filter(F.split(name, r"\."), lambda p: F.trim(p) != "")
    return F.when(F.size(parts) > 0, ident(F.element_at(parts, -1))).otherwise(F.lit("UNKNOWN"))


def is_id(column: Column) -> Column:
    return column == "ID"


def is_key_like(column: Column) -> Column:
    """Ends with _ID."""
    return column.endswith("_ID")


def confidence(kind: Column, left: Column, right: Column) -> Column:
    """Confidence of an edge from its predicate's type and its columns' names."""
    base = F.coalesce(F.create_map(*[F.lit(x) for pair in BASE_CONFIDENCE.items() for x in pair])[kind], F.lit(UNKNOWN_CONFIDENCE))
    one = lambda c: F.when(is_id(c) | is_key_like(c), ID_BONUS).otherwise(0.0)
    pair = F.when((is_id(left) & is_key_like(right)) | (is_id(right) & is_key_like(left)), KEY_PAIR_BONUS).otherwise(0.0)
    return F.round(F.least(base + F.when(kind == "eq_column_column", one(left) + one(right) + pair).otherwise(0.0), F.lit(CONFIDENCE_CAP)), 6)


def frequency_boosted(conf: Column, frequency: Column, boosts: tuple[tuple[int, float], ...] = ((10, 0.10), (5, 0.05))) -> Column:
    """conf with what repetition adds (the first boost whose count is reached), capped, to four places."""
    add = F.lit(0.0)
    for least, boost in reversed(boosts):
        add = F.when(frequency >= least, boost).otherwise(add)
    return F.round(F.least(conf + add, F.lit(CONFIDENCE_CAP)), 4)


def strip_comments(sql: Column) -> Column:
    """SQL text without line and block comments."""
    return F.regexp_replace(F.regexp_replace(sql, r"(?m)--.*?$", ""), r"(?s)/\*.*?\*/", "")


def evidence(file: Column, block: Column, kind: Column, predicate: Column, most: int = 220) -> Column:
    """File (if any), block, type and predicate in one line; the predicate's white space collapsed, `most` characters of it."""
    snippet = F.substring(F.trim(F.regexp_replace(predicate, r"\s+", " ")), 1, most)
    return F.concat_ws(" | ", F.when(file != "", file), block, kind, snippet)


def class_name(table: Column) -> Column:
    """CamelCase singular of a table's name: each part between underscores is made singular by its ending."""

    def singular(p: Column) -> Column:
        less = lambda n: F.substring(p, F.lit(1), F.length(p) - n)
        return (
            F.when(p.endswith("IES"), F.concat(less(3), F.lit("Y")))
            .when(p.endswith("SSES") | p.endswith("XES") | p.endswith("CHES") | p.endswith("SHES"), less(2))
            .when(p.endswith("S") & ~p.endswith("SS"), less(1))
            .otherwise(p)
        )

    part = lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, F.lit(2), F.length(p))))
    return F.array_join(F.transform(F.split(F.upper(table), "_"), lambda p: part(singular(p))), "")


def quality_flag(match_rate: Column, pk_unique_rate: Column, fk_null_rate: Column) -> Column:
    """critical, warning or ok; missing rates count as the worst."""
    match, unique, null = number(match_rate), number(pk_unique_rate), number(fk_null_rate, 1.0)
    return F.when((match < 0.5) | (null > 0.5), "critical").when((match < 0.9) | (unique < 0.9) | (null > 0.2), "warning").otherwise("ok")


def auto_approved(text: Column) -> Column:
    return F.coalesce(F.contains(F.lower(text), F.lit("[auto-approved]")), F.lit(False))


def suggested_class(n_in: Column, n_out: Column, total: Column, bridge: Column) -> Column:
    """A table's class from its degrees: '' where nothing fits."""
    n_in, n_out, total, bridge = (F.coalesce(c.cast("double"), F.lit(0.0)) for c in (n_in, n_out, total, bridge))
    return (
        F.when(total == 0, "")
        .when((total >= 4) & (bridge >= 0.45) & (n_in >= 2) & (n_out >= 2), "bridge")
        .when((n_in >= 3) & (n_out <= 1), "fact")
        .when((n_out >= 3) & (n_in <= 1), "dimension")
        .when(total <= 2, "entity")
        .otherwise("")
    )
