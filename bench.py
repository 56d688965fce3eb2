"""Time the headline queries: one JSON line with seconds per query and their sum.

Reads ``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8). Every query
is run whole, into the ``noop`` sink, building its plan included.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "e1_catalog_to_report", "x01_weight_quantity", "x03_units_per_carton", "x06_packaging_type",
    "a02_by_packaging", "a03_total_units", "a04_duplicate_serials", "a06_by_supplier",
    "a07_in_several_catalogs", "a08_only_in_one_catalog", "d01_dedup_keep_first", "d04_upsert_last",
    "d09_dense_ids", "t01_title_cosine", "t01_long_text_cosine", "t05_decision", "t08_top_five",
    "t10_retrieve_candidates", "t11_match_summary", "h01_result_list", "h05_description",
    "h07_visible_text", "h09_scraped_products",
]


def main() -> None:
    from checks.queries import QUERIES
    from shelfmark.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "shelfmark-bench")
    spark.read.parquet(f"{sf_dir}/part.parquet").groupBy("p_brand").count().collect()  # start the session
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
