"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from linktally.session import build_session
from suite.queries import QUERIES

HEADLINES = (
    "links_exploded",
    "url_normalized",
    "url_domain",
    "shares",
    "domain_month",
    "domains_total",
    "domains_by_month_wide",
    "orders_monthly_rollup",
    "lineitem_month_totals",
    "platform_link_month",
    "platform_links_wide",
    "metadata_inner",
    "links_with_channel",
    "channels",
    "rejected_rows",
    "csv_roundtrip",
    "shares_stored",
    "pipeline_channels",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/orders.parquet").count()  # start-up is not part of any query
    seconds = {}
    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
