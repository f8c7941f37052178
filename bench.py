"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from resight.registry import QUERIES, grouped
from resight.session import local_session
from resight.sources import driver

HEADLINE = [
    "d2_photos_without_side",
    "d5_base_clean_listing",
    "d6_label_conflicts",
    "d7_label_history",
    "d12_final_listing",
    "d13_primary_ids",
    "d16_social_supplement",
    "d20_encounters_per_day",
    "d21_label_summary",
    "d23_timeline_wide",
    "d24_conflict_patterns",
    "d27_keyword_timeline",
    "d28_label_mismatch",
    "d31_consolidated",
    "d32_evidence_for_year",
    "d36_rating_results",
    "d37_rating_comparison",
    "d38_individual_year_metadata",
    "d40_mark_shares",
    "w2_fill_down_up",
    "w4_sessionize",
    "s4_nested_json_scan",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, int(cpus))
    started = time.time()
    for make in (driver.listing, driver.tagged_listing, driver.auto_responses, grouped.base, grouped.corrections):
        make(spark, folder).count()  # start-up; the inputs derived from the given tables are stored
    warm_up = time.time() - started
    times: dict[str, float] = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
                "prepare_sec": round(warm_up, 3),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
