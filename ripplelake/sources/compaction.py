"""Compaction of streamed tables.

A streaming file sink writes a few files per micro-batch, so a day of a table
ends as thousands of small ones.  ``compact`` rewrites the files whose rows all lie in closed
days (before ``closed_before``) into a few files a day, and commits the result
as one new manifest beside the table:

    <table>            the sink's folder, with its own log; never changed by ``compact``
    <table>_compact/   v=<n>-<token>/compact_day=<date>/...   data of compaction n
                       manifests/<n>.json   days -> compaction that holds them, files covered

Readers (``read``) take the last manifest's days and the sink's files that it
doesn't cover, so every row is read once: before the manifest exists nothing has changed,
afterwards the covered files are left out.  A compaction that is killed leaves a
folder that no manifest names, and its number is taken again under another token.  Rows that come late
for a compacted day are read from their own files until the next compaction, which
rewrites the days they touch and no others.

The sink's log lists every file since the start.  With ``retention`` (see
``sinks.write_stream``) it forgets files older than that; their rows are then
read from the compacted days, provided that ``compact`` runs more often than that.
``expire`` deletes covered files that the log no longer lists and
the days of compactions that no manifest uses any more.

Scale: what passes the driver is file names, as in Spark's own file listing: those the
log holds and the last manifest covers.  Rows are dealt by day, large days in parts
(``REBALANCE``), so no task holds a whole day.

Defined cases: a table without a sink log or without closed files is left as it is
(no manifest); rows whose day is null (a streamed Gold table has none) keep
their file out of every compaction; repeated rows are kept as they are.  One
compaction runs at a time; a second one fails before its manifest is written.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.gold import as_date
from . import publish

DAY = "compact_day"
SINK_LOG = "_spark_metadata"

#: Day of a row in the streamed tables.
SILVER_DAY = "make_date(event_year, event_month, event_day)"
BRONZE_DAY = "make_date(ingest_year, ingest_month, ingest_day)"
WINDOW_DAY = "to_date(window_start)"


def _folder(path: str) -> str:
    return path.rstrip("/") + "_compact"


def last(spark: SparkSession, path: str) -> dict:
    """The last committed manifest: number, days (date -> compaction), files covered."""
    names = [n for n, _ in publish.children(spark, f"{_folder(path)}/manifests") if n.endswith(".json")]
    if not names:
        return {"number": -1, "days": {}, "covered": []}
    return json.loads(publish._read(spark, f"{_folder(path)}/manifests/{max(names)}"))


def _listed(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, str]:
    """Files of the sink's log: path below the table -> full path."""
    fs, log = publish._fs(spark, f"{path.rstrip('/')}/{SINK_LOG}")
    if not fs.exists(log):
        return {}
    marker = "/" + path.rstrip("/").rsplit("/", 1)[1] + "/"
    files = spark.read.schema(schema).parquet(path).inputFiles()
    return {unquote(f.rsplit(marker, 1)[1]): f for f in files}


def _of_files(spark: SparkSession, path: str, schema: T.StructType, files: list[str]) -> DataFrame:
    """Rows of some of the table's files; named one by one, so the sink's log is not asked."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*[unquote(f) for f in files])


def _of_days(spark: SparkSession, path: str, schema: T.StructType, days: dict[str, str]) -> DataFrame:
    """Rows of compacted days."""
    if not days:
        return spark.createDataFrame([], schema)
    folders = [f"{_folder(path)}/{v}/{DAY}={day}" for day, v in sorted(days.items())]
    return spark.read.schema(schema).parquet(*folders)


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table's rows, each once: compacted days and the files not yet compacted.

    A sink without a log (nothing written yet) and without compactions is an empty table.
    """
    manifest = last(spark, path)
    covered = set(manifest["covered"])
    tail = [full for name, full in sorted(_listed(spark, path, schema).items()) if name not in covered]
    parts = []
    if manifest["days"]:
        parts.append(_of_days(spark, path, schema, manifest["days"]))
    if tail or not parts:
        parts.append(_of_files(spark, path, schema, tail))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.select(*schema.names)


def closed_files(spark: SparkSession, path: str, schema: T.StructType, files: dict[str, str], day: Column,
                 closed_before) -> tuple[list[str], set[str]]:
    """Those of the files whose rows all lie before the date, and the days they hold.

    Both follow from one pass that reads the day's columns only and adds up per file.
    """
    limit = as_date(closed_before)
    marker = path.rstrip("/").rsplit("/", 1)[1]
    rows = _of_files(spark, path, schema, list(files.values()))
    per_file = (rows.groupBy(F.col("_metadata.file_path").alias("file"), day.alias("day"))
                .agg(F.count(F.lit(1)).alias("n")).groupBy("file")
                .agg(F.max("day").alias("newest"), F.bool_or(F.col("day").isNull()).alias("undated"),
                     F.collect_set("day").alias("days")))
    closed = per_file.filter(~F.col("undated") & (F.col("newest") < F.lit(limit)))
    names, days = [], set()
    for r in closed.select("file", "days").toLocalIterator():
        names.append(unquote(r.file.rsplit(f"/{marker}/", 1)[1]))
        days |= {str(d) for d in r.days}
    return sorted(names), days


def compact(spark: SparkSession, path: str, schema: T.StructType, day: str, closed_before) -> dict | None:
    """Rewrite the closed files not yet compacted; returns the new manifest, None if there is nothing to do.

    ``day``: SQL expression of a row's day.  Days that the files touch are merged
    with what earlier compactions hold of them.
    """
    before = last(spark, path)
    covered = set(before["covered"])
    listed = _listed(spark, path, schema)
    fresh = {name: full for name, full in listed.items() if name not in covered}
    if not fresh:
        return None
    names, days = closed_files(spark, path, schema, fresh, F.expr(day), closed_before)
    if not names:
        return None
    number = before["number"] + 1
    held = {d: v for d, v in before["days"].items() if d in days}
    rows = _of_files(spark, path, schema, [fresh[n] for n in names])
    if held:
        rows = rows.unionByName(_of_days(spark, path, schema, held))
    version = f"v={number}-{uuid.uuid4().hex[:8]}"
    (rows.withColumn(DAY, F.expr(day)).hint("rebalance", DAY)
     .write.partitionBy(DAY).parquet(f"{_folder(path)}/{version}"))
    # Files that neither the log lists nor the disk needs any more drop out of the manifest.
    kept = [n for n in before["covered"] if n in listed or _exists(spark, f"{path}/{n}")]
    manifest = {"number": number, "days": before["days"] | {d: version for d in sorted(days)},
                "covered": sorted({*kept, *names})}
    if not publish._create(spark, f"{_folder(path)}/manifests/{number:08d}.json", json.dumps(manifest)):
        raise publish.PublishConflict(f"another compaction of {path} took number {number}")
    return manifest


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = publish._fs(spark, path)
    return fs.exists(p)


def expire(spark: SparkSession, path: str, schema: T.StructType) -> int:
    """Delete what no reader of the last manifest needs: covered files that the sink's log has
    forgotten, and days of earlier compactions that were written again.  Returns their number.

    Run it when no reader of an earlier manifest is under way.
    """
    manifest, gone = last(spark, path), 0
    listed = _listed(spark, path, schema)
    for name in manifest["covered"]:
        if name not in listed and _exists(spark, f"{path}/{name}"):
            fs, p = publish._fs(spark, f"{path}/{name}")
            gone += bool(fs.delete(p, False))
    for version, _ in publish.children(spark, _folder(path)):
        if not version.startswith("v=") or int(version[2:].split("-")[0]) > manifest["number"]:
            continue
        for name, _ in publish.children(spark, f"{_folder(path)}/{version}"):
            if manifest["days"].get(name.partition("=")[2]) != version:
                fs, p = publish._fs(spark, f"{_folder(path)}/{version}/{name}")
                gone += bool(fs.delete(p, True))
    return gone
