"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from blotterlake.catalog.queries import QUERIES
from blotterlake.session import local_session

HEADLINE = (
    "prepare_incidents", "hourly_counts", "radar_series", "unit_time_hist", "unit_time_kde",
    "fuzzy_match", "cascade_methods", "classify_incidents", "profile_columns", "surrogate_id",
    "clean_documents", "token_counts", "nb_documents_lang", "network_edges",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not part of any query
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
