"""Gold roll-ups on the 4-row sample, segment boundaries, conversion rate."""
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import make_event, raw_frame
from ripplelake.functions.money import conversion_rate
from ripplelake.functions.rules import segment
from ripplelake.operators import gold
from ripplelake.operators.silver import raw_to_silver


@pytest.fixture(scope="module")
def sample(spark):
    rows = [
        make_event(event_id="1", user_id="U001", session_id="s1", event_type="purchase", product_id="P001",
                   product_name="MacBook Pro", price=999.99, quantity=1, revenue=999.99,
                   timestamp="2026-03-18T10:00:00+00:00"),
        make_event(event_id="2", user_id="U002", session_id="s2", event_type="add_to_cart", product_id="P001",
                   product_name="MacBook Pro", price=999.99, quantity=1, revenue=None, device_type="desktop",
                   country="GB", timestamp="2026-03-18T10:05:00+00:00"),
        make_event(event_id="3", user_id="U003", session_id="s3", event_type="page_view", product_id=None,
                   product_name=None, category=None, price=None, quantity=None, revenue=None,
                   timestamp="2026-03-18T11:00:00+00:00"),
        make_event(event_id="4", user_id="U001", session_id="s4", event_type="purchase", product_id="P002",
                   product_name="iPhone", price=499.99, quantity=2, revenue=999.98,
                   timestamp="2026-03-18T12:00:00+00:00"),
    ]
    return raw_to_silver(raw_frame(spark, rows))


def test_sample_totals(sample):
    assert sample.count() == 4
    assert sample.filter("event_type = 'purchase'").count() == 2
    assert sample.filter("country = 'US'").count() == 3


def test_revenue_metrics(sample):
    rm = gold.revenue_metrics(sample)
    tot = rm.agg(F.sum("total_revenue"), F.sum("total_orders")).first()
    assert round(tot[0], 2) == 1999.97 and tot[1] == 2
    assert rm.agg(F.countDistinct("report_date")).first()[0] == 1
    buyers = sample.filter("event_type = 'purchase'").select("user_id").distinct().count()
    assert buyers == 1


def test_top_products_rank(sample):
    tp = gold.top_products(sample).orderBy("revenue_rank").collect()
    assert [r["product_id"] for r in tp] == ["P001", "P002"]
    assert tp[0]["conversion_rate"] == 1.0 and tp[1]["conversion_rate"] == 1.0  # 0 carts -> /1


def test_user_segments(sample):
    seg = {r["user_id"]: r for r in gold.user_segments(sample).collect()}
    assert seg["U001"]["user_segment"] == "vip" and seg["U001"]["daily_spend"] == 1999.97
    assert seg["U003"]["user_segment"] == "casual_browser"


SEGMENTS = [(600, 1, "vip"), (500.01, 1, "vip"), (500, 1, "high_value"), (250, 1, "high_value"),
            (100.01, 1, "high_value"), (100, 1, "buyer"), (50, 1, "buyer"), (0.01, 1, "buyer"),
            (0, 15, "engaged_browser"), (0, 3, "casual_browser")]


def test_segment_boundaries(spark):
    df = spark.createDataFrame([(float(s), e) for s, e, _ in SEGMENTS], "spend double, events int")
    got = [r[0] for r in df.select(segment("spend", "events", "daily")).collect()]
    assert got == [x for _, _, x in SEGMENTS]


def test_cohort_segments(spark):
    df = spark.createDataFrame([(250.0, 1), (150.0, 1), (0.0, 11)], "spend double, events int")
    got = [r[0] for r in df.select(segment("spend", "events", "cohort")).collect()]
    assert got == ["high_value", "buyer", "engaged_browser"]


def test_conversion_rate(spark):
    df = spark.createDataFrame([(3, 10), (5, 0), (10, 10), (0, 10)], "p int, c int")
    got = [r[0] for r in df.select(conversion_rate("p", "c")).collect()]
    assert got == [0.3, 5.0, 1.0, 0.0]
    unguarded = [r[0] for r in df.select(conversion_rate("p", "c", guard=False)).collect()]
    assert unguarded[1] is None


def test_flags_and_helpers(spark, sample):
    from ripplelake.operators.silver import filter_valid, quality_flags
    raw = raw_frame(spark, [make_event(), make_event(event_id="z", device_type=None),
                            make_event(event_id="w", price=-1.0)])
    flagged = quality_flags(raw)
    assert [r["_is_valid_record"] for r in flagged.orderBy("event_id").collect()] == [True, False, False]
    assert filter_valid(flagged).count() == 1 and "_is_valid_record" not in filter_valid(flagged).columns
    tp = gold.top_products(sample)
    ranked = gold.global_rank(tp, "revenue").orderBy("rank").collect()
    assert ranked[0]["rank"] == 1 and ranked[0]["product_id"] == "P001"
    pos = gold.position(tp, [F.desc("revenue")]).orderBy("position").collect()
    assert [r["position"] for r in pos] == [1, 2]


def test_many_views_low_conversion(spark):
    from ripplelake.plans import analytics

    rows = [("few", 10, 0.0), ("enough", 11, 0.09), ("converts", 90, 0.1), ("most", 12, 0.0), ("tie", 11, 0.05)]
    products = spark.createDataFrame(
        [(n, n, "2026-03-18", views, 1, rate, 5.0) for n, views, rate in rows],
        "product_id string, product_name string, report_date string, product_views long, purchase_count long, "
        "conversion_rate double, revenue double")
    got = analytics.run_query(spark, "q03", {"gold_top_products": products}).collect()
    assert [(r["product_name"], r["conversion_pct"]) for r in got] == [("most", 0.0), ("enough", 9.0), ("tie", 5.0)]


def test_global_rank_by_ranges(spark):
    """Equal to the plain window, ties across ranges and NULL included, without a single task for all rows."""
    import random
    r = random.Random(4)
    df = spark.createDataFrame([(i, r.choice([None, 1, 1, 1, 2, 5, i])) for i in range(500)], "id long, v long").repartition(6)
    w = Window.orderBy(F.desc("v"))
    want = {(x["id"], x["rank"], x["dense"]) for x in df.withColumn("rank", F.rank().over(w)).withColumn(
        "dense", F.dense_rank().over(w)).collect()}
    got = gold.global_rank(gold.global_rank(df, "v"), "v", name="dense", dense=True)
    assert {(x["id"], x["rank"], x["dense"]) for x in got.collect()} == want
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
    order = [F.desc_nulls_last("v"), F.asc("id")]
    placed = gold.position(df, order)
    assert "SinglePartition" not in placed._jdf.queryExecution().executedPlan().toString()
    assert {(x["id"], x["position"]) for x in placed.collect()} == {
        (x["id"], x["position"]) for x in df.withColumn("position", F.row_number().over(Window.orderBy(*order))).collect()}
    assert gold.global_rank(df.limit(0), "v").count() == gold.position(df.limit(0), order).count() == 0


def test_global_rank_makes_its_input_once(spark):
    """Two ranks of one frame: what the frame is made of runs once, not for every pass over it."""
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def value(i):
        made.add(1)
        return i % 7

    df = spark.range(0, 200, 1, 4).select("id", value("id").alias("v"))
    got = gold.global_rank(gold.global_rank(df, "v"), "v", name="dense", dense=True).collect()
    assert made.value == 200
    assert {(r["v"], r["dense"]) for r in got} == {(v, 7 - v) for v in range(7)}
