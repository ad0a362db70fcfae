"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line.

Protocol: every query runs twice to completion into a null sink. The first run is cold: nothing that
an earlier query staged is used again. The second is the figure reported for the query.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyhouse import catalogue
from tallyhouse.session import local_session

HEADLINE = [
    "v1_monthly_sales",
    "v2_customer_cohorts",
    "v3_orders_enriched",
    "d1_overview_kpis",
    "d3_trends_monthly",
    "d5_yearly_revenue",
    "d6_top_categories",
    "d7_pareto_sellers",
    "d8_seller_scoring",
    "d9_rfm_segmentation",
    "d10_cohorts_retention",
    "d11_ltv_cohorts",
    "d12_new_vs_recurring",
    "p7_raw_gaps",
    "p8_raw_gap_stats",
    "p10_gaps_by_dominant_type",
    "x3_revenue_by_state",
    "x5_customer_quintiles",
    "x7_top_products_share",
    "x9_top_sellers_per_state",
    "k1_repeat_rate",
    "k11_next_purchase",
    "k12_rank_in_category",
    "k15_delivered_item_count",
    "k16_latest_rows_projected",
    "k17_items_with_status_mean",
    "k20_rows_with_month_total",
    "c6_clean_geolocation",
    "c11_clean_products",
    "s7_four_phase_job",
    "m14_fact_orders",
    "p1_gap_stats",
    "r2_describe",
    "q4_referential",
    "l6_months",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    warm, cold = {}, {}
    for name in HEADLINE:
        catalogue.forget()
        for times in (cold, warm):
            start = time.perf_counter()
            catalogue.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = lambda times: round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total(warm), "unit": "sec", "queries": warm, "sf": sf, "cold_total": total(cold), "cold": cold}))


if __name__ == "__main__":
    main()
