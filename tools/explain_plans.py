"""Print ``explain("formatted")`` of the headline plans over a written Silver
table (what the scale notes in the README are checked against).

Usage: python tools/explain_plans.py [sf_dir] > plans.txt
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from ripplelake.operators import gold, quality
    from ripplelake.operators.silver import dedup_events
    from ripplelake.plans import analytics
    from ripplelake.plans.tables import PipelineTables
    from ripplelake.session import build_session, scratch_path
    from ripplelake.sources import readers, sinks

    spark = build_session(shuffle_partitions=8)
    path = scratch_path(spark, "explain-silver")
    sinks.write_silver(PipelineTables(spark, sf_dir).silver_events, path)
    silver = readers.load_silver(spark, path)
    day = readers.load_silver(spark, path, "2024-01-15")
    revenue = gold.revenue_metrics(silver)
    plans = {
        "revenue_metrics (D1)": revenue,
        "top_products (D3, partial WindowGroupLimit)": gold.top_products(silver),
        "top_products_cohort (D4, Expand for 3 distinct counts)": gold.top_products_cohort(silver),
        "user_segments for one day (partition pruning)": gold.user_segments(day),
        "dq_report (E0, one scan)": quality.dq_report(silver),
        "q05 (share of total after aggregation)": analytics.run_query(
            spark, "q05", {"gold_revenue_metrics": revenue}),
        "q08 (TakeOrderedAndProject)": analytics.run_query(spark, "q08", {"gold_revenue_metrics": revenue}),
        "dedup_events (partial min(struct) before the exchange)": dedup_events(silver),
    }
    for name, df in plans.items():
        print(f"===== {name}")
        df.explain("formatted")
    spark.stop()


if __name__ == "__main__":
    main()
