"""Publishing the days of a run in one step.

A daily run writes all its tables into a staging folder first.  Its manifest
(run, tables, touched days and their files) is then created as one new file:
that is the commit.  After it the staged files are moved into their day folders
and the files they supersede are removed, table by table.  A run that is
killed before the commit leaves the tables as they were; one killed after it
is finished by ``settle``, which the next run and the lake's readers call.

A table's days are either replaced (``replace``: Gold, dead letter, Silver
rebuilt from Bronze) or shared by runs (``append``: Silver): a run's files are
named after it, so a rerun supersedes its own files and no others, and late rows
join a day without touching what is there.

The layout stays ``column=value`` folders that any Parquet reader and the catalog
understand.  One run publishes at a time: manifests are numbered, and a number
that another run took meanwhile is an error before anything is moved.  Readers
that bypass ``settle`` may see a day half moved while a run publishes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MANIFESTS = "_manifests"


class PublishConflict(RuntimeError):
    """Another run committed in between, or rows of this run were superseded."""


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def children(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is a folder) of a folder's visible children; none if there is no such folder."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(p)]
    return sorted(x for x in found if x[0][0] not in "._")


def files_by_day(spark: SparkSession, path: str, depth: int = 3) -> dict[str, list[str]]:
    """Data files of every partition folder, by the folder's path below ``path``."""
    days = [""]
    for _ in range(depth):
        days = [f"{d}/{name}".lstrip("/") for d in days for name, folder in children(spark, f"{path}/{d}") if folder]
    return {d: [name for name, folder in children(spark, f"{path}/{d}") if not folder] for d in days}


@dataclass
class Manifest:
    """What one run publishes.  ``tables``: folder below the base -> mode, schema and the files of each day."""

    run: str
    staging: str
    tables: dict[str, dict] = field(default_factory=dict)
    number: int = -1

    def add(self, spark: SparkSession, folder: str, mode: str, schema: T.StructType | None, days: set[str]) -> None:
        """``days``: touched partition folders; those without a staged file are emptied."""
        found = files_by_day(spark, f"{self.staging}/{folder}")
        self.tables[folder] = {"mode": mode, "schema": schema.json() if schema else None,
                               "days": {d: found.get(d, []) for d in sorted(days | set(found))}}

    def prefix(self) -> str:
        return f"run-{self.run}-"


def manifests(spark: SparkSession, base: str) -> list[Manifest]:
    """All committed manifests in order."""
    out = []
    for name, _ in children(spark, f"{base}/{MANIFESTS}"):
        if name.endswith(".json"):
            out.append(Manifest(**json.loads(_read(spark, f"{base}/{MANIFESTS}/{name}"))))
    return sorted(out, key=lambda m: m.number)


def last_of(spark: SparkSession, base: str, run: str) -> Manifest | None:
    return next((m for m in reversed(manifests(spark, base)) if m.run == run), None)


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with the text under a name that must be new; readers see it whole or not at all."""
    fs, p = _fs(spark, path)
    fs.mkdirs(p.getParent())
    draft = p.getParent().suffix(f"/.{p.getName()}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    return not fs.exists(p) and fs.rename(draft, p)


def commit(spark: SparkSession, base: str, manifest: Manifest, seen: int) -> None:
    """Make the manifest the one after number ``seen``, then move its files."""
    manifest.number = seen + 1
    text = json.dumps(vars(manifest), indent=1)
    if not _create(spark, f"{base}/{MANIFESTS}/{manifest.number:08d}.json", text):
        raise PublishConflict(f"another run published number {manifest.number}; run {manifest.run} again")
    _move(spark, base, manifest)


def settle(spark: SparkSession, base: str) -> None:
    """Finish committed manifests whose files have not all been moved."""
    names = {name for name, _ in children(spark, f"{base}/{MANIFESTS}")}
    open_ = sorted(n for n in names if n.endswith(".json") and n.replace(".json", ".done") not in names)
    for name in open_:
        _move(spark, base, Manifest(**json.loads(_read(spark, f"{base}/{MANIFESTS}/{name}"))))


def settle_above(spark: SparkSession, path: str) -> None:
    """``settle`` for the lake that the table at ``path`` lies in (two folders up)."""
    settle(spark, path.rstrip("/").rsplit("/", 2)[0])


def _move(spark: SparkSession, base: str, m: Manifest) -> None:
    """Move the manifest's files into place; every step may have been done before."""
    for folder, table in m.tables.items():
        for day, files in table["days"].items():
            fs, target = _fs(spark, f"{base}/{folder}/{day}")
            new = {m.prefix() + name for name in files}
            if files:
                fs.mkdirs(target)
            for name in files:
                source, to = _fs(spark, f"{m.staging}/{folder}/{day}/{name}")[1], _fs(spark, f"{target}/{m.prefix()}{name}")[1]
                if fs.exists(source) and not fs.exists(to) and not fs.rename(source, to):
                    raise OSError(f"{source} could not be moved to {to}")
            old = [name for name, folder_ in children(spark, str(target)) if not folder_ and name not in new
                   and (table["mode"] == "replace" or name.startswith(m.prefix()))]
            for name in old:
                fs.delete(_fs(spark, f"{target}/{name}")[1], False)
            if fs.exists(target) and not children(spark, str(target)):
                fs.delete(target, True)
        if not any(files_by_day(spark, f"{base}/{folder}").values()) and table["days"] and table["schema"]:
            _keep_schema(spark, f"{base}/{folder}/{next(iter(table['days']))}", table["schema"])
    _create(spark, f"{base}/{MANIFESTS}/{m.number:08d}.done", "")
    fs, staging = _fs(spark, m.staging)
    fs.delete(staging, True)


def _keep_schema(spark: SparkSession, day: str, schema: str) -> None:
    """A table that has lost its last row keeps an empty file, so that it can still be read."""
    empty = spark.createDataFrame([], T.StructType.fromJson(json.loads(schema)))
    empty.coalesce(1).write.mode("overwrite").parquet(day)


def schema_of(df: DataFrame, partitions: list[str]) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name not in partitions])
