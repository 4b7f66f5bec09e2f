"""Time the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` set the tables and the cores.

Prints one JSON line. Every query runs whole, into a sink that takes all rows
and keeps none; the better of two runs counts, since the first one compiles.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weftwork import catalog  # noqa: E402
from weftwork.session import build_session  # noqa: E402

HEADLINE = [
    "q_link_placed",
    "q_entity_customer",
    "q_direction",
    "q_fanout",
    "q_batch_fanout",
    "q_dedup",
    "q_dates",
    "q_entity_cells",
    "q_link_search_doc",
    "q_cells_latest",
    "q_resource_exclusion",
    "q_watchlist",
    "q_task_counts",
    "q_pair_links",
    "q_two_hop",
    "q_dossier",
    "q_stream_transform",
    "q_stream_load",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="16g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = catalog.load(), {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            queries[name].build(spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(min(runs), 3)
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
