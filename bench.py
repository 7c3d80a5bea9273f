"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from regweave.plans import load_queries
from regweave.session import local_session

# The headline queries: one per operator family of the reference's three builds.
HEADLINE = (
    "registry_merge", "station_rollup", "usi_join", "register_join", "longest_prefix", "list_enrich", "list_pages",
    "activity_flag", "geo_fallback", "grid6", "scd2_three", "asof_attribution", "stable_ids", "interval_ids", "title_case",
    "date_normalise", "address_scrub", "location_scrub", "email_redact", "line_entries", "html_rows", "fixed_width",
    "csv_by_name", "json_flatten", "alias_attach", "alias_shadow", "network_doc", "keep_last_good", "unchanged_dates",
    "point_in_polygon", "cell_coverage", "same_name_union",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(cpus), memory=os.environ.get("BENCH_MEMORY", "16g"))
    queries, _ = load_queries()
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, total wall clock", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
