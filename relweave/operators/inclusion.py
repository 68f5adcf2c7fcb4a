"""Which columns' values are among which others': of all columns at once by an inverted index of values, or about as well by sketches that are stored and merged."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, ByteType, DataType, DateType, DecimalType, IntegerType, LongType, NumericType, ShortType, StringType, TimestampNTZType, TimestampType

from relweave.operators.profile import Candidate, common_type

_EXACT = (ByteType, ShortType, IntegerType, LongType, DecimalType)
_TIMES = (DateType, TimestampType, TimestampNTZType)
#: Columns in a word of a value's bitmap.
BITS = 62
#: Entries of a sketch, as a power of two: its relative error is about 1 / sqrt(2^LG_ENTRIES).
LG_ENTRIES = 12
#: Standard errors that the stated bound of a sketch's figure has.
ERRORS = 4


@dataclass(frozen=True)
class Key:
    """A column's values as they are compared with those of other columns of a family, as text."""

    table: str
    column: str
    family: str
    kind: DataType

    def text(self) -> Column:
        return F.col(f"`{self.column}`").cast(self.kind).cast("string")


def families(tables: dict[str, DataFrame], columns: Iterable[tuple[str, str]]) -> list[Key]:
    """The columns' keys. Whole numbers and decimals are compared with each other exactly; where there are floats, all numbers are compared with these as doubles; dates and timestamps as timestamps; text with text, booleans with booleans. Other types have no keys."""
    of = {(t, c): tables[t].schema[c].dataType for t, c in dict.fromkeys(columns)}
    groups: dict[str, list[tuple[str, str]]] = {"exact": [], "float": [], "time": [], "text": [], "bool": []}
    floats = [k for k, v in of.items() if isinstance(v, NumericType) and not isinstance(v, _EXACT)]
    for k, v in of.items():
        if isinstance(v, NumericType):
            if isinstance(v, _EXACT):
                groups["exact"].append(k)
            if floats:
                groups["float"].append(k)
        else:
            name = "time" if isinstance(v, _TIMES) else "text" if isinstance(v, StringType) else "bool" if isinstance(v, BooleanType) else None
            if name:
                groups[name].append(k)
    out = []
    for name, members in groups.items():
        if members:
            kind = reduce(common_type, [of[k] for k in members])
            out += [Key(*k, name, common_type(kind, kind)) for k in members]
    return out


def comparable(tables: dict[str, DataFrame], a: Key, b: Key) -> bool:
    """Whether a pair is to be taken from the two keys' family: pairs without a float come from the exact one."""
    if a.family != b.family or (a.table, a.column) == (b.table, b.column):
        return False
    return a.family != "float" or any(not isinstance(tables[k.table].schema[k.column].dataType, _EXACT) for k in (a, b))


def value_index(tables: dict[str, DataFrame], keys: list[Key]) -> DataFrame:
    """(family, value, w0, w1...): each value with a bitmap of the keys that have it. One scan of each table, and one exchange by value of what is left of it in each task: a value that is frequent in many columns is one row a task."""
    words = range(-(-len(keys) // BITS))
    rows = []
    for name in dict.fromkeys(k.table for k in keys):
        mine = [F.struct(F.lit(k.family).alias("family"), k.text().alias("value"), F.lit(i).alias("key")) for i, k in enumerate(keys) if k.table == name]
        rows.append(tables[name].select(F.explode(F.array(*mine)).alias("v")).select("v.*").where("value is not null"))
    bit = lambda w: F.when(F.floor(F.col("key") / BITS) == w, F.expr(f"shiftleft(1L, key % {BITS})")).otherwise(F.lit(0).cast("bigint"))
    return reduce(DataFrame.unionByName, rows).groupBy("family", "value").agg(*[F.bit_or(bit(w)).alias(f"w{w}") for w in words])


def inclusion_matrix(tables: dict[str, DataFrame], columns: Iterable[tuple[str, str]]) -> DataFrame:
    """(table_a, col_a, table_b, col_b, a_distinct, b_distinct, common, a_in_b): for each ordered pair of different columns that share a value, how many distinct values each has and how many they share, nulls apart.

    Values are counted by their bitmaps: however many values there are, the pairs come from the distinct bitmaps, each once with its count.
    - columns without rows or values, and pairs without a shared value: no rows; a column named twice counts once; columns are compared as families() says
    A scan of each table and one exchange by value give all pairs."""
    keys = families(tables, columns)
    spark = next(iter(tables.values())).sparkSession
    schema = "table_a string, col_a string, table_b string, col_b string, a_distinct bigint, b_distinct bigint, common bigint, a_in_b double"
    if not keys:
        return spark.createDataFrame([], schema)
    index = value_index(tables, keys)
    words = [c for c in index.columns if c.startswith("w")]
    maps = index.groupBy(*words).agg(F.count("*").alias("n"))
    set_in = lambda k, w: F.transform(F.filter(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda i: F.getbit(F.col(w), i) == 1), lambda i: i + k * BITS)
    held = F.flatten(F.array(*[set_in(k, w) for k, w in enumerate(words)]))
    pairs = maps.select("n", held.alias("held")).select("n", F.explode("held").alias("a"), "held").select("n", "a", F.explode("held").alias("b")).groupBy("a", "b").agg(F.sum("n").alias("common"))
    # A row for each pair of keys that belong together: as many as the schema has, not the data.
    wanted = spark.createDataFrame([(i, j, a.table, a.column, b.table, b.column) for i, a in enumerate(keys) for j, b in enumerate(keys) if comparable(tables, a, b)], "a int, b int, table_a string, col_a string, table_b string, col_b string")
    own = lambda x: pairs.where("a = b").select(F.col("a").alias(x), F.col("common").alias(f"{x}_distinct"))
    out = pairs.join(F.broadcast(wanted), ["a", "b"]).join(own("a"), "a").join(own("b"), "b")
    return out.select("table_a", "col_a", "table_b", "col_b", "a_distinct", "b_distinct", "common", (F.col("common") / F.col("a_distinct")).alias("a_in_b"))


SKETCH = "table_name string, column_name string, family string, total_rows bigint, non_null_count bigint, hll binary, theta binary"


def column_sketches(tables: dict[str, DataFrame], columns: Iterable[tuple[str, str]]) -> DataFrame:
    """SKETCH rows, one for each column and family: counts, a HyperLogLog sketch and a theta sketch of its values. All of a table's come from one aggregate over one scan; what travels is a few sketches a task. Rows of several parts of a table, or of several days, go through merged()."""
    keys = families(tables, columns)
    out = []
    for name in dict.fromkeys(k.table for k in keys):
        mine = [k for k in keys if k.table == name]
        made = tables[name].agg(F.count("*").alias("rows"), *[x for i, k in enumerate(mine) for x in (F.count(f"`{k.column}`").alias(f"c{i}"), F.hll_sketch_agg(k.text(), LG_ENTRIES).alias(f"h{i}"), F.theta_sketch_agg(k.text(), LG_ENTRIES).alias(f"t{i}"))])
        rows = F.array(*[F.struct(F.lit(name).alias("table_name"), F.lit(k.column).alias("column_name"), F.lit(k.family).alias("family"), F.col("rows").alias("total_rows"), F.col(f"c{i}").alias("non_null_count"), F.col(f"h{i}").alias("hll"), F.col(f"t{i}").alias("theta")) for i, k in enumerate(mine)])
        out.append(made.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, out)


def merged(sketches: DataFrame) -> DataFrame:
    """SKETCH rows of the same column and family as one."""
    return sketches.groupBy("table_name", "column_name", "family").agg(F.sum("total_rows").alias("total_rows"), F.sum("non_null_count").alias("non_null_count"), F.hll_union_agg("hll").alias("hll"), F.theta_union_agg("theta", LG_ENTRIES).alias("theta"))


def sketch_profile(tables: dict[str, DataFrame], sketches: DataFrame, candidates: Iterable[Candidate]) -> DataFrame:
    """(from_table, from_column, to_table, to_column, a_distinct, b_distinct, common, a_in_b, common_error): about what value_overlap() finds, from sketches alone; `tables` only for the columns' types.

    Distinct counts are the HyperLogLog estimates, whose relative error is 1.04 / sqrt(2^LG_ENTRIES); the shared values come from the intersection of the theta sketches. common_error: ERRORS standard errors of it, sqrt(common * union / entries), which bounds it but for about one in 10,000; sketches of fewer values than they have entries are exact.
    - candidates whose ends have no family in common (text against numbers, say): no row; columns without values: 0 and a_in_b 0"""
    found = list(candidates)
    spark = sketches.sparkSession
    keys = families(tables, [p for e in found for p in ((e.from_table, e.from_column), (e.to_table, e.to_column))])
    by = {(k.table, k.column, k.family): k for k in keys}
    rows = []
    for e in found:
        for family in dict.fromkeys(k.family for k in keys):
            a, b = by.get((e.from_table, e.from_column, family)), by.get((e.to_table, e.to_column, family))
            if a and b and (comparable(tables, a, b) or (a == b and family != "float")):
                rows.append((e.from_table, e.from_column, e.to_table, e.to_column, family))
                break
    wanted = spark.createDataFrame(rows, "from_table string, from_column string, to_table string, to_column string, family string")
    side = lambda t, c, x: sketches.select(F.col("table_name").alias(t), F.col("column_name").alias(c), "family", F.hll_sketch_estimate("hll").alias(f"{x}_distinct"), F.col("theta").alias(f"{x}_theta"))
    both = wanted.join(side("from_table", "from_column", "a"), ["from_table", "from_column", "family"]).join(side("to_table", "to_column", "b"), ["to_table", "to_column", "family"])
    common, union = F.theta_sketch_estimate(F.theta_intersection("a_theta", "b_theta")), F.theta_sketch_estimate(F.theta_union("a_theta", "b_theta", LG_ENTRIES))
    error = F.when(union <= 2**LG_ENTRIES, 0.0).otherwise(ERRORS * F.sqrt(F.greatest(common, F.lit(1)).cast("double") * union / 2**LG_ENTRIES))
    out = both.withColumn("common", common).withColumn("common_error", error)
    rate = F.when(F.col("a_distinct") > 0, F.least(F.col("common") / F.col("a_distinct"), F.lit(1.0))).otherwise(0.0)
    return out.select("from_table", "from_column", "to_table", "to_column", "a_distinct", "b_distinct", "common", rate.alias("a_in_b"), "common_error")


#: A sampled profile first looks at so many times the share of values that the estimate says.
SLACK = 2.0


def edge_profile_sampled(tables: dict[str, DataFrame], candidates: Iterable[Candidate], values: int = 1000) -> DataFrame:
    """(from_table, from_column, to_table, to_column, sample_values, sample_rows, match_count, match_rate, pk_distinct, pk_total, pk_unique_rate, fk_null_rate): a profile on coordinated samples of values.

    The sample of an edge is the `values` distinct values of its child column with the smallest md5 of their text, all their rows, and at the other end all rows of the values up to the same hash: so a value in the sample is there at both ends or not at all, and matches and uniqueness are exact for it. Values are those of common_type(); the null rate is of all rows.
    - fewer distinct values than wanted: all; columns without values: zeros, null rate 1 without rows; ties of the hash belong to the sample together
    No rows are gathered: one aggregate per child table estimates its columns' distinct values; hashes beyond `SLACK` times the share wanted are left before anything is dealt out, and the cut is found among what remains, some times `values` an edge. A cut is one hash an edge, and comes to the driver."""
    found = list(candidates)
    kinds = {e: common_type(tables[e.from_table].schema[e.from_column].dataType, tables[e.to_table].schema[e.to_column].dataType) for e in found}
    text = lambda column, e: F.col(f"`{column}`").try_cast(kinds[e]).cast("string")
    # The first 32 bits of md5 as a number.
    place = lambda h: F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")
    stats: dict[Candidate, tuple[int, int, int]] = {}
    for name in dict.fromkeys(e.from_table for e in found):
        mine = [e for e in found if e.from_table == name]
        row = tables[name].agg(F.count("*").alias("n"), *[x for i, e in enumerate(mine) for x in (F.count(f"`{e.from_column}`").alias(f"c{i}"), F.approx_count_distinct(text(e.from_column, e), 0.05).alias(f"d{i}"))]).first()
        stats |= {e: (row["n"], row[f"c{i}"], row[f"d{i}"]) for i, e in enumerate(mine)}
    hashed = lambda df, column, e: df.select(text(column, e).alias("v")).where("v is not null").withColumn("h", F.md5(F.col("v").cast("binary")))

    share = {e: min(1.0, SLACK * values / max(stats[e][2], 1)) for e in found}

    def cuts(some: list[Candidate]) -> dict[Candidate, tuple[str, int]]:
        """The hash of the last value of each edge's sample, and how many values that is. A share holds some times `values` at most, whatever the column has."""
        rows = []
        for e in some:
            near = hashed(tables[e.from_table], e.from_column, e)
            near = near if share[e] >= 1 else near.where(place(F.col("h")) < int(share[e] * 2**32))
            rows.append(near.select(F.lit(found.index(e)).alias("e"), "h").distinct())
        got = reduce(DataFrame.unionByName, rows).groupBy("e").agg(F.slice(F.sort_array(F.collect_list("h")), 1, values).alias("hs"))
        return {found[r.e]: (r.last, r.n) for r in got.select("e", F.element_at("hs", -1).alias("last"), F.size("hs").alias("n")).collect()}

    got, short = {}, found
    while short:
        got |= cuts(short)
        # An estimate that was too high by more than the slack: twice the share then.
        short = [e for e in short if share[e] < 1 and got.get(e, ("", 0))[1] < values]
        share |= {e: min(1.0, 2 * share[e]) for e in short}
    out = []
    for e in found:
        cut = got.get(e, ("", 0))[0]
        at = lambda df, column, e=e, cut=cut: hashed(df, column, e).where(F.col("h") <= cut).groupBy("v").agg(F.count("*").alias("n"))
        child, parent = at(tables[e.from_table], e.from_column), at(tables[e.to_table], e.to_column).select(F.col("v").alias("p"), F.col("n").alias("m"))
        met = child.join(parent, F.col("v") == F.col("p"), "full")
        total = lambda x, name: F.coalesce(F.sum(F.expr(x)), F.lit(0)).cast("bigint").alias(name)
        rows, non_null, _ = stats[e]
        one = met.agg(F.count("v").alias("sample_values"), total("n", "sample_rows"), total("if(p is null, 0, n)", "match_count"), F.count("p").alias("pk_distinct"), total("m", "pk_total"))
        rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
        out.append(one.select(
            F.lit(e.from_table).alias("from_table"), F.lit(e.from_column).alias("from_column"), F.lit(e.to_table).alias("to_table"), F.lit(e.to_column).alias("to_column"), "sample_values", "sample_rows", "match_count", rate("match_count", "sample_rows").alias("match_rate"),
            "pk_distinct", "pk_total", rate("pk_distinct", "pk_total").alias("pk_unique_rate"), F.lit(1 - non_null / rows if rows else 1.0).alias("fk_null_rate"),
        ))
    return reduce(DataFrame.unionByName, out)
