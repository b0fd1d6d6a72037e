"""Streamed tables: compaction, retention of the sink's log, and dedup of a hot id."""
import json
import os
import time

import pytest
from conftest import make_event
from pyspark.sql import functions as F

from ripplelake.operators.silver import dedup_events, dedup_stream
from ripplelake.schemas import SILVER_SCHEMA
from ripplelake.session import scratch_path
from ripplelake.sources import compaction, publish
from ripplelake.sources.sinks import write_stream
from ripplelake.streaming.pipeline import lake_paths, run_streaming_pipeline, silver_stream

DAY = compaction.SILVER_DAY


class Feed:
    """A pipeline up to Silver that takes one file of events at a time."""

    def __init__(self, spark):
        self.spark = spark
        self.src, self.base, self.ck = (scratch_path(spark, f"feed-{x}") for x in ("src", "lake", "ck"))
        os.makedirs(self.src)
        self.table, self.sent = lake_paths(self.base, self.ck)["silver"][0], 0

    def send(self, *days, only=("silver",)):
        with open(f"{self.src}/part-{self.sent}.json", "w") as out:
            for d in days:
                self.sent += 1
                out.write(json.dumps(make_event(event_id=f"e{self.sent}", timestamp=f"2024-01-{d:02d}T10:00:00+00:00")) + "\n")
        run_streaming_pipeline(self.spark, self.src, self.base, self.ck, available_now=True, only=list(only)).await_all()

    def compact(self, before):
        return compaction.compact(self.spark, self.table, SILVER_SCHEMA, DAY, before)

    def ids(self):
        rows = compaction.read(self.spark, self.table, SILVER_SCHEMA).select("event_id", "event_day").collect()
        return sorted((r.event_id, r.event_day) for r in rows)


def test_rows_are_equal_before_between_and_after(spark, monkeypatch):
    f = Feed(spark)
    assert f.compact("2024-02-01") is None  # nothing written yet
    for _ in range(3):
        f.send(1, 2, 5)
    before = f.ids()
    assert len(before) == 9
    with monkeypatch.context() as m:  # killed before its manifest: nothing changed
        m.setattr(publish, "_create", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            f.compact("2024-01-05")
    assert f.ids() == before
    first = f.compact("2024-01-05")
    assert sorted(first["days"]) == ["2024-01-01", "2024-01-02"] and f.ids() == before
    days = compaction._of_days(spark, f.table, SILVER_SCHEMA, first["days"])
    assert days.count() == 6 and len(days.inputFiles()) == 2  # six files of the sink before
    assert f.compact("2024-01-05") is None  # nothing new
    f.send(1, 6)  # a late row for a compacted day
    after = f.ids()
    assert len(after) == 11 and set(before) < set(after)
    second = f.compact("2024-01-05")
    assert second["days"]["2024-01-02"] == first["days"]["2024-01-02"]  # not touched, not written again
    assert second["days"]["2024-01-01"] != first["days"]["2024-01-01"] and f.ids() == after
    assert compaction.expire(spark, f.table, SILVER_SCHEMA) == 1 + 2  # the first one's day 1; the killed one's two days
    assert f.ids() == after
    compaction.compact(spark, f.table, SILVER_SCHEMA, DAY, "2024-02-01")
    assert f.ids() == after


def test_a_second_compaction_at_once_fails(spark, monkeypatch):
    f = Feed(spark)
    f.send(1)
    before, real = f.ids(), compaction.last
    first = f.compact("2024-01-05")
    with monkeypatch.context() as m:
        m.setattr(compaction, "last", lambda *a: {"number": -1, "days": {}, "covered": []})
        with pytest.raises(publish.PublishConflict):
            f.compact("2024-01-05")
    assert real(spark, f.table) == first and f.ids() == before


def test_retention_forgets_compacted_files(spark):
    """Files that the log has forgotten are read from the compacted days and can be deleted."""
    f = Feed(spark)
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    out, ck = scratch_path(spark, "kept-table"), scratch_path(spark, "kept-ck")

    def run(**kw):
        silver = spark.readStream.schema(SILVER_SCHEMA).parquet(f.table)
        write_stream(silver, out, ck, ["event_year", "event_month", "event_day"], available_now=True, **kw).awaitTermination()

    def ids():
        return sorted(r.event_id for r in compaction.read(spark, out, SILVER_SCHEMA).collect())

    try:
        f.send(1)
        f.send(2)
        run()
        compaction.compact(spark, out, SILVER_SCHEMA, DAY, "2024-01-05")
        time.sleep(4)
        f.send(3)
        run(retention="4s")
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")
    listed = compaction._listed(spark, out, SILVER_SCHEMA)
    assert len(listed) == 1 and ids() == ["e1", "e2", "e3"]
    assert compaction.expire(spark, out, SILVER_SCHEMA) == 2 and ids() == ["e1", "e2", "e3"]
    assert compaction.compact(spark, out, SILVER_SCHEMA, DAY, "2024-01-05")["covered"] == sorted(listed)
    assert ids() == ["e1", "e2", "e3"]


def test_unpartitioned_gold_by_window_day(spark):
    f = Feed(spark)
    for d in (1, 2, 3, 5):
        f.send(d, only=("gold-users",))
    table = lake_paths(f.base, f.ck)["gold-users"][0]
    schema = spark.read.parquet(table).schema
    before = sorted(map(str, compaction.read(spark, table, schema).collect()))
    made = compaction.compact(spark, table, schema, compaction.WINDOW_DAY, "2024-01-03")
    assert sorted(made["days"]) == ["2024-01-01", "2024-01-02"]
    assert sorted(map(str, compaction.read(spark, table, schema).collect())) == before and len(before) >= 3


def test_dedup_of_a_hot_id(spark):
    """A third of the rows have one id: no task of the second step sees more than a row per part."""
    src = scratch_path(spark, "hot-src")
    events = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("e"), "id")).alias("k"))
    template = json.dumps(make_event(event_id="@", timestamp="2024-01-01T10:00:00+00:00"))
    events.repartition(12).select(F.replace(F.lit(template), F.lit("@"), F.col("k"))).write.text(src)

    def run(name, dedup):
        rows = silver_stream(spark.readStream.text(src).withColumnRenamed("value", "data"))
        q = (dedup(rows).writeStream.format("memory").queryName(name)
             .option("checkpointLocation", scratch_path(spark, "hot-ck")).trigger(availableNow=True).start())
        q.awaitTermination()
        steps = next(p["stateOperators"] for p in q.recentProgress if p["numInputRows"])
        return spark.table(name), steps

    out, steps = run("hot_case", lambda s: dedup_events(s, within_watermark=True))
    assert out.count() == out.select("event_id").distinct().count() == 2001
    first, second = (x["numRowsUpdated"] for x in sorted(steps, key=lambda x: -x["numRowsUpdated"]))
    assert second == 2001 and 2001 <= first <= 2000 + 12  # of 1000 copies one per task goes on
    out, _ = run("hot_one_part", lambda s: dedup_stream(s, parts=1))
    assert out.count() == 2001
