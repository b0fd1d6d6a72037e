"""Data quality: the daily DQ report (E0), declarative expectation suites
(E1-E9), layer validation (E10) and the gate (E11).

Every check is compiled into aggregates: a whole suite is **one** pass over
the data (plus one grouped pass per uniqueness rule), instead of one Spark
job per check.  Results are small frames (one row per expectation, per
partition day), never collected rows of data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.money import share_pct
from ..schemas import DQ_NULL_EVENT_ID_PCT, VALID_DEVICE_TYPES, VALID_EVENT_TYPES
from .gold import for_run_date


class DataQualityError(RuntimeError):
    """Raised by the gate when a report breaches its thresholds."""


# ---------------------------------------------------------------------------
# DQ report
# ---------------------------------------------------------------------------
def dq_report(silver: DataFrame, run_date=None) -> DataFrame:
    """Completeness / uniqueness / validity report.

    With ``run_date``: one row for that day (``NO_DATA`` when empty).
    Without: one row per event day.  All metrics come from a single
    aggregate.  Duplicate ids = rows - distinct ids, where NULL counts as one
    distinct value (as ``dropDuplicates`` keeps one NULL row).
    """
    aggs = [
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(F.col("event_id").isNull()).alias("_null_id"),
        F.count_if(F.col("user_id").isNull()).alias("_null_user"),
        F.count_if(F.col("event_timestamp").isNull()).alias("_null_ts"),
        (F.countDistinct("event_id")
         + F.coalesce(F.max(F.col("event_id").isNull().cast("int")), F.lit(0))).alias("_distinct_ids"),
        F.count_if(F.col("price").isNotNull() & (F.col("price") <= 0)).alias("invalid_price_count"),
        F.count_if((F.col("event_type") == "purchase") & F.col("revenue").isNull())
         .alias("purchases_missing_revenue"),
    ]
    if run_date is not None:
        d = for_run_date(silver, run_date)
        g = d.agg(*aggs).withColumn("run_date", F.lit(str(run_date)))
    else:
        g = (silver.groupBy(F.date_format("event_date", "yyyy-MM-dd").alias("run_date")).agg(*aggs))
    total = F.col("total_records")
    has = total > 0

    def pct(c: str) -> Column:
        return F.when(has, share_pct(c, total, 3))

    dup = F.when(has, total - F.col("_distinct_ids"))
    status = (F.when(~has, F.lit("NO_DATA"))
              .when((F.col("_null_id") == 0) & (F.col("_null_user") == 0) & (dup == 0)
                    & (F.col("invalid_price_count") == 0), F.lit("PASS"))
              .otherwise(F.lit("WARN")))
    return g.select(
        "run_date", "total_records",
        pct("_null_id").alias("null_event_id_pct"),
        pct("_null_user").alias("null_user_id_pct"),
        pct("_null_ts").alias("null_timestamp_pct"),
        dup.alias("duplicate_event_ids"),
        F.when(has, F.col("invalid_price_count")).alias("invalid_price_count"),
        F.when(has, F.col("purchases_missing_revenue")).alias("purchases_missing_revenue"),
        status.alias("status"),
    )


# ---------------------------------------------------------------------------
# Expectation suites
# ---------------------------------------------------------------------------
# Suites as data (fixed values of the quality contract).
SILVER_SUITE = {
    "suite_name": "silver_events_suite",
    "expectations": [
        ("expect_column_values_to_not_be_null", {"column": "event_id", "mostly": 1.0}),
        ("expect_column_values_to_not_be_null", {"column": "user_id", "mostly": 1.0}),
        ("expect_column_values_to_not_be_null", {"column": "event_timestamp", "mostly": 1.0}),
        ("expect_column_values_to_not_be_null", {"column": "event_type", "mostly": 1.0}),
        ("expect_column_values_to_be_unique", {"column": "event_id"}),
        ("expect_column_values_to_be_in_set", {"column": "event_type", "value_set": VALID_EVENT_TYPES}),
        ("expect_column_values_to_be_in_set", {"column": "device_type", "value_set": VALID_DEVICE_TYPES}),
        ("expect_column_values_to_be_between", {"column": "price", "min_value": 0.01, "max_value": 50000.0,
                                                "mostly": 0.99}),
        ("expect_column_values_to_be_between", {"column": "quantity", "min_value": 1, "max_value": 100,
                                                "mostly": 0.99}),
        ("expect_column_values_to_be_between", {"column": "revenue", "min_value": 0.0, "max_value": 500000.0,
                                                "mostly": 0.99}),
        ("expect_column_to_exist", {"column": "event_id"}),
        ("expect_column_to_exist", {"column": "event_timestamp"}),
        ("expect_column_to_exist", {"column": "user_id"}),
        ("expect_table_row_count_to_be_between", {"min_value": 1000, "max_value": 50_000_000}),
        ("expect_column_value_lengths_to_equal", {"column": "country", "value": 2, "mostly": 0.99}),
    ],
}
GOLD_SALES_SUITE = {
    "suite_name": "gold_sales_suite",
    "expectations": [
        ("expect_column_values_to_not_be_null", {"column": "total_revenue"}),
        ("expect_column_values_to_be_between", {"column": "total_revenue", "min_value": 0}),
        ("expect_column_values_to_be_between", {"column": "total_orders", "min_value": 0}),
        ("expect_column_values_to_be_between", {"column": "avg_order_value", "min_value": 0, "max_value": 50000}),
        ("expect_column_values_to_not_be_null", {"column": "window_start"}),
    ],
}

RESULT_COLUMNS = ["suite", "run_date", "expectation_index", "expectation_type", "column",
                  "element_count", "unexpected_count", "success"]


def _outside(c: Column, kw: dict) -> Column:
    """Non-null value outside an inclusive [min, max] (either side open)."""
    cond = F.lit(False)
    if kw.get("min_value") is not None:
        cond = cond | (c < F.lit(kw["min_value"]))
    if kw.get("max_value") is not None:
        cond = cond | (c > F.lit(kw["max_value"]))
    return c.isNotNull() & cond


def _element_and_unexpected(etype: str, kw: dict, columns: list[str]) -> tuple[Column, Column] | None:
    """(evaluated, unexpected) aggregates for a row-level expectation."""
    col = kw.get("column")
    if etype == "expect_column_to_exist":
        return F.lit(1).cast("long"), F.lit(0 if col in columns else 1).cast("long")
    if etype == "expect_table_row_count_to_be_between":
        n = F.count(F.lit(1))
        return n, _outside(n, kw).cast("long")
    if col not in columns:
        # A missing column fails the rule instead of failing the whole suite.
        return F.lit(1).cast("long"), F.lit(1).cast("long")
    c = F.col(col)
    if etype == "expect_column_values_to_not_be_null":
        return F.count(F.lit(1)), F.count_if(c.isNull())
    if etype == "expect_column_values_to_be_in_set":
        return F.count(c), F.count_if(c.isNotNull() & ~c.isin(*kw["value_set"]))
    if etype == "expect_column_values_to_be_between":
        return F.count(c), F.count_if(_outside(c, kw))
    if etype == "expect_column_value_lengths_to_equal":
        return F.count(c), F.count_if(c.isNotNull() & (F.length(c) != F.lit(kw["value"])))
    if etype == "expect_column_values_to_be_unique":
        return None
    raise ValueError(f"unknown expectation {etype}")


def run_suite(df: DataFrame, suite: dict, run_date: str | None = None, by: str | None = None) -> DataFrame:
    """Evaluate a suite; one result row per expectation (per ``by`` value).

    ``by`` (e.g. ``event_date``) validates every partition day in the same
    pass.  ``mostly``: success when (evaluated - unexpected) / evaluated >=
    mostly; zero evaluated rows pass, but for the row count itself.
    """
    keys = [F.date_format(F.col(by), "yyyy-MM-dd").alias("run_date")] if by else []
    label = F.col("run_date") if by else F.lit(run_date).cast("string")
    structs, aggs = [], []
    for i, (etype, kw) in enumerate(suite["expectations"]):
        pair = _element_and_unexpected(etype, kw, df.columns)
        if pair is None:
            aggs.append(F.count(F.col(kw["column"])).alias(f"_e{i}"))
            aggs.append(F.lit(None).cast("long").alias(f"_u{i}"))
        else:
            aggs += [pair[0].alias(f"_e{i}"), pair[1].alias(f"_u{i}")]
        structs.append(F.struct(F.lit(i).alias("expectation_index"), F.lit(etype).alias("expectation_type"),
                                F.lit(kw.get("column")).cast("string").alias("column"),
                                F.col(f"_e{i}").cast("long").alias("element_count"),
                                F.col(f"_u{i}").cast("long").alias("unexpected_count")))
    base = df.groupBy(*keys).agg(*aggs) if by else df.agg(*aggs)
    long = base.select(label.alias("run_date"), F.explode(F.array(*structs)).alias("r")).select("run_date", "r.*")
    for rows in _repeated_values(df, suite, label, keys, by):
        long = long.unionByName(rows)
    return _judged(long, suite)


def _repeated_values(df: DataFrame, suite: dict, label: Column, keys: list[Column], by: str | None) -> list[DataFrame]:
    """One frame per uniqueness rule with the rows of values that occur more than once."""
    found = []
    for i, (etype, kw) in enumerate(suite["expectations"]):
        if etype != "expect_column_values_to_be_unique" or kw["column"] not in df.columns:
            continue
        c = kw["column"]
        grp_keys = ([F.col(by)] if by else []) + [F.col(c)]
        per_value = df.filter(F.col(c).isNotNull()).groupBy(*grp_keys).agg(F.count(F.lit(1)).alias("_n"))
        dup_rows = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("long")
        u = (per_value.groupBy(*keys).agg(dup_rows.alias("unexpected_count")) if by
             else per_value.agg(dup_rows.alias("unexpected_count")))
        found.append(u.select(
            label.alias("run_date"), F.lit(i).alias("expectation_index"), F.lit(etype).alias("expectation_type"),
            F.lit(c).alias("column"), F.lit(None).cast("long").alias("element_count"), "unexpected_count"))
    return found


def observe_suite(df: DataFrame, suite: dict) -> tuple[DataFrame, Callable[[DataFrame, str | None], DataFrame]]:
    """E8 at write time: the frame with the suite's one-pass rules observed, and a
    function that gives the results once the frame has been written.

    The write's own pass counts what the rules need; the function reads only
    the columns with uniqueness rules of the written table.  Results equal
    ``run_suite`` over that table.
    """
    obs, seen, fixed = Observation(suite["suite_name"]), {}, {}
    for i, (etype, kw) in enumerate(suite["expectations"]):
        column = kw.get("column")
        if etype == "expect_column_to_exist" or (column and column not in df.columns):
            fixed[i] = (1, 0 if column in df.columns else 1)
        elif etype == "expect_column_values_to_be_unique":
            seen[f"_e{i}"] = F.count(F.col(column))
        else:
            seen[f"_e{i}"], seen[f"_u{i}"] = _element_and_unexpected(etype, kw, df.columns)

    def results(written: DataFrame, run_date: str | None = None) -> DataFrame:
        got = obs.get if seen else {}
        rows = [(run_date, i, etype, kw.get("column"), *fixed.get(i, (got.get(f"_e{i}"), got.get(f"_u{i}"))))
                for i, (etype, kw) in enumerate(suite["expectations"])]
        long = written.sparkSession.createDataFrame(
            rows, "run_date string, expectation_index int, expectation_type string, column string, "
                  "element_count long, unexpected_count long")
        for repeated in _repeated_values(written, suite, F.lit(run_date).cast("string"), [], None):
            long = long.unionByName(repeated)
        return _judged(long, suite)

    return (df.observe(obs, *[c.alias(n) for n, c in seen.items()]) if seen else df), results


def _judged(long: DataFrame, suite: dict) -> DataFrame:
    """A result row per expectation from its parts."""
    merged = (long.groupBy("run_date", "expectation_index", "expectation_type", "column")
                  .agg(F.sum("element_count").alias("element_count"),
                       F.coalesce(F.sum("unexpected_count"), F.lit(0)).cast("long").alias("unexpected_count")))
    mostly = F.lit(1.0)
    for i, (etype, kw) in enumerate(suite["expectations"]):
        if "mostly" in kw:
            mostly = F.when(F.col("expectation_index") == i, F.lit(float(kw["mostly"]))).otherwise(mostly)
    ok = ((F.col("element_count") == 0) & (F.col("unexpected_count") == 0)) | (
        (F.col("element_count") - F.col("unexpected_count")).cast("double")
        >= mostly * F.col("element_count").cast("double"))
    return merged.select(F.lit(suite["suite_name"]).alias("suite"), "run_date", "expectation_index", "expectation_type",
                         "column", "element_count", "unexpected_count", ok.alias("success"))


def suite_summary(results: DataFrame) -> DataFrame:
    """Per suite and run: passed, evaluated, failed, success % (1 dp) and
    the failed expectations as ``type:column`` text (sorted)."""
    failed = ~F.col("success")
    return (results.groupBy("suite", "run_date").agg(
        F.bool_and("success").alias("passed"),
        F.count(F.lit(1)).alias("evaluated"),
        F.count_if(failed).alias("failed"),
        F.array_join(F.array_sort(F.collect_list(F.when(
            failed, F.concat_ws(":", "expectation_type", F.coalesce("column", F.lit("")))))), ";")
         .alias("failed_expectations"))
        .withColumn("success_pct", share_pct(F.col("evaluated") - F.col("failed"),
                                             F.greatest(F.col("evaluated"), F.lit(1)), 1)))


def validate_layers(spark: SparkSession, run_date: str | None,
                    silver_loader: Callable[[], DataFrame] | None = None,
                    gold_loader: Callable[[], DataFrame] | None = None,
                    layer: str = "all", by: str | None = None, base: str | None = None,
                    expected_days: list[str] | None = None) -> DataFrame:
    """Run the Silver and/or Gold sales suite, over ``base``'s tables of
    ``run_date`` where no loader is given.  Errors while loading or reading count as a
    failed suite, and a table without rows gets its row of results also with
    ``by``.  Adds ``overall_passed`` over all returned rows.

    With ``by``, a day of ``expected_days`` that the table lacks is a failed suite of its own.

    Suites run here: one row per suite (and day with ``by``) reaches the driver."""
    if layer not in ("silver", "gold", "all"):
        raise ValueError(f"layer {layer!r} is neither silver nor gold")
    if base is not None:
        from ..sources.readers import load_layer
        silver_loader = silver_loader or (lambda: load_layer(spark, base, "silver", "cleaned_events", run_date))
        gold_loader = gold_loader or (lambda: load_layer(spark, base, "gold", "sales_metrics", run_date))
    found: list[tuple] = []
    plan = []
    if layer in ("silver", "all"):
        plan.append((SILVER_SUITE, silver_loader, by))
    if layer in ("gold", "all"):
        plan.append((GOLD_SALES_SUITE, gold_loader, None))
    for suite, loader, key in plan:
        try:
            if loader is None:
                raise ValueError("no loader")
            df = loader()
            rows = suite_summary(run_suite(df, suite, run_date, by=key)).collect()
            rows = rows or suite_summary(run_suite(df, suite, run_date)).collect()
            found += [(*[r[c] for c in _SUMMARY_SCHEMA.fieldNames()[:-1]], None) for r in rows]
            if key:
                found += [(suite["suite_name"], day, False, 0, 0, "", 0.0, "no rows for this day")
                          for day in sorted(set(expected_days or ()) - {r["run_date"] for r in rows})]
        except Exception as exc:  # noqa: BLE001 -- a load error is a failed suite
            found.append((suite["suite_name"], None if run_date is None else str(run_date), False, 0, 0, "", 0.0,
                          f"{type(exc).__name__}: {exc}"))
    return (spark.createDataFrame(found, _SUMMARY_SCHEMA)
            .withColumn("overall_passed", F.lit(all(row[2] for row in found))))


_SUMMARY_SCHEMA = T.StructType([
    T.StructField("suite", T.StringType()), T.StructField("run_date", T.StringType()),
    T.StructField("passed", T.BooleanType()), T.StructField("evaluated", T.LongType()),
    T.StructField("failed", T.LongType()), T.StructField("failed_expectations", T.StringType()),
    T.StructField("success_pct", T.DoubleType()), T.StructField("error", T.StringType()),
])


# ---------------------------------------------------------------------------
# gate
# ---------------------------------------------------------------------------
def dq_gate_issues(report: DataFrame, pct: float = DQ_NULL_EVENT_ID_PCT) -> DataFrame:
    """Rows of a DQ report that breach the gate, with the reasons."""
    issues = F.concat_ws("; ",
                         F.when(F.col("null_event_id_pct") > pct,
                                F.concat(F.lit("null_event_id_pct="), F.col("null_event_id_pct").cast("string"))),
                         F.when(F.col("duplicate_event_ids") > 0,
                                F.concat(F.lit("duplicate_ids="), F.col("duplicate_event_ids").cast("string"))),
                         F.when(F.col("status") == "NO_DATA", F.lit("NO_DATA")))
    return (report.select("run_date", "total_records", issues.alias("issues"))
                  .filter(F.col("issues") != ""))


def dq_gate(report: DataFrame, pct: float = DQ_NULL_EVENT_ID_PCT) -> DataFrame:
    """Fail closed.  Raises ``DataQualityError`` if any report row
    breaches the gate or the report is missing/empty; returns the report.

    One row of totals reaches the driver; ``dq_gate_issues`` is the full list.
    """
    if report is None:
        raise DataQualityError("DQ report missing")
    nulls, dups = F.col("null_event_id_pct") > pct, F.col("duplicate_event_ids") > 0
    empty = F.col("status") == "NO_DATA"
    bad = nulls | dups | empty
    r = report.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad"),
        F.min(F.when(bad, F.col("run_date"))).alias("first"), F.max(F.when(bad, F.col("run_date"))).alias("last"),
        F.count_if(nulls).alias("nulls"), F.max(F.when(nulls, F.col("null_event_id_pct"))).alias("worst"),
        F.count_if(dups).alias("dups"), F.sum(F.when(dups, F.col("duplicate_event_ids"))).alias("ids"),
        F.count_if(empty).alias("empty")).first()
    if r["bad"]:
        reasons = [text for n, text in ((r["nulls"], f"null_event_id_pct on {r['nulls']} day(s), worst={r['worst']}"),
                                        (r["dups"], f"duplicate_ids={r['ids']} on {r['dups']} day(s)"),
                                        (r["empty"], f"NO_DATA on {r['empty']} day(s)")) if n]
        raise DataQualityError(f"DQ check failed on {r['bad']} day(s), {r['first']} to {r['last']}: "
                               + "; ".join(reasons))
    if not r["rows"]:
        raise DataQualityError("DQ report is empty")
    return report


__all__ = ["DataQualityError", "dq_report", "SILVER_SUITE", "GOLD_SALES_SUITE", "run_suite", "suite_summary",
           "validate_layers", "dq_gate_issues", "dq_gate"]
