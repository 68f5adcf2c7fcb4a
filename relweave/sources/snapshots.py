"""Tables with a history: each write is a snapshot of its time, seen from one rename on; readers take the one of a time."""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from relweave.session import filesystem

ENTRY = "stamp string, data string, rows bigint, schema string, name string"


def stamp_of(at: datetime) -> str:
    return at.astimezone(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ")


def write_snapshot(df: DataFrame, root: str, at: datetime) -> str:
    """Write df as the snapshot of `at` below root, in any store that Spark writes to; its name.

    The rows go to a folder of their own, data/ts=<time>-<id>, and then an entry is written beside the manifest's folder and moved into it: until that one rename readers see what was there before, and a writer that dies leaves nothing but a folder without an entry. Two writers never touch the same names. The rows are counted while they are written."""
    spark = df.sparkSession
    name = f"{stamp_of(at)}-{uuid.uuid4().hex}"
    counted = Observation(name)
    df.observe(counted, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/data/ts={name}")
    entry = {"stamp": stamp_of(at), "data": f"data/ts={name}", "rows": counted.get["rows"], "schema": df.schema.json(), "name": name}
    fs, waiting = filesystem(spark, f"{root}/waiting/{name}.json")
    out = fs.create(waiting, True)
    out.write(bytearray((json.dumps(entry) + "\n").encode()))
    out.close()
    _, folder = filesystem(spark, f"{root}/manifest")
    fs.mkdirs(folder)
    _, to = filesystem(spark, f"{root}/manifest/{name}.json")
    if not fs.rename(waiting, to):
        raise OSError(f"{root}: the entry of snapshot {name} could not be put in place")
    return name


def snapshots(spark: SparkSession, root: str) -> DataFrame:
    """ENTRY rows, a row for each snapshot; none where nothing was written yet."""
    fs, folder = filesystem(spark, f"{root}/manifest")
    if not fs.exists(folder):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).option("mode", "FAILFAST").json(f"{root}/manifest")


def as_of(spark: SparkSession, root: str, at: datetime | None = None) -> DataFrame:
    """The rows of the last snapshot of `at` or before (None: of the last one); of two of one time, the one with the greater name. A LookupError where there is none."""
    found = snapshots(spark, root)
    if at is not None:
        found = found.where(F.col("stamp") <= stamp_of(at))
    last = found.agg(F.max(F.struct("stamp", "name", "data", "schema")).alias("x")).first().x
    if last is None:
        raise LookupError(f"{root} has no snapshot of {'any time' if at is None else at.isoformat()}")
    return spark.read.schema(StructType.fromJson(json.loads(last.schema))).parquet(f"{root}/{last.data}")


def expire(spark: SparkSession, root: str, before: datetime, keep: int = 1) -> int:
    """Forget the snapshots before a time but for the last `keep` of all, and remove their rows; how many. Entries go first, so no reader finds one without rows; a reader that has found one already may fail. Folders of that time that no entry names, left by writers that died, go too."""
    rows = sorted((r.stamp, r.name, r.data) for r in snapshots(spark, root).select("stamp", "name", "data").collect())  # a row a snapshot
    old = [r for r in (rows[: len(rows) - keep] if keep else rows) if r[0] < stamp_of(before)]
    fs, data = filesystem(spark, f"{root}/data")
    for _, name, _ in old:
        fs.delete(filesystem(spark, f"{root}/manifest/{name}.json")[1], False)
    named = {r[2].rsplit("ts=", 1)[1] for r in rows if r not in old}
    if fs.exists(data):
        for status in fs.listStatus(data):
            name = status.getPath().getName().removeprefix("ts=")
            if name not in named and name.split("-")[0] < stamp_of(before):
                fs.delete(status.getPath(), True)
    return len(old)
