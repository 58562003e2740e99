"""Times the headline queries and the life of a bulk table; prints one JSON line.

BENCH_SF_DIR   folder of the sales tables      (default /root/testdata/sf0.1)
BENCH_CPUS     local cores                     (default 8)
BENCH_BULK     rows of the bulk table          (default 10,000,000)
BENCH_RUNS     runs per query, the best counts (default 2)

Every query is run whole into Spark's no-op sink. The bulk steps are timed once each, on a new
folder, and include putting the rewritten table in place.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from tableflow.plans.bulk import is_third, numbered_texts
from tableflow.queries import REGISTRY
from tableflow.session import build_session
from tableflow.sources.catalog import Schema
from tableflow.sources.tables import series

HEADLINE = (
    "category_filter_join", "category_filter_semi", "store_revenue_join", "topk_actors_join",
    "genre_year_long", "genre_year_correlated", "genre_year_case", "top_staff_own",
    "top_staff_lastdate", "top_staff_chain", "most_rented_subquery", "most_rented_cte",
    "inactivity_subquery", "max_gap", "having_two_distinct", "anti_composite", "composite_join",
    "resolve_keys_fanout", "update_many", "delete_selected", "cascade_delete", "insert_new_rows",
    "assign_ids", "audit_unique", "audit_fk", "audit_check", "marketplace_items",
    "load_marketplace", "add_films_and_actors", "rent_and_pay",
)
PREFIX = "bulk_row_with_a_prefix"


def timed(job) -> float:
    start = time.perf_counter()
    job()
    return round(time.perf_counter() - start, 3)


def bulk_steps(spark, rows: int) -> tuple[dict[str, float], dict[str, int]]:
    """Seconds and table size in bytes after each step."""
    schema = Schema(spark, "bench")
    name, seconds, sizes = "bulk", {}, {}
    steps = {
        "bulk_create": lambda: schema.create_as(name, numbered_texts(series(spark, 1, rows), PREFIX)),
        "bulk_delete_third": lambda: schema.delete(name, is_third(PREFIX)),
        "bulk_compact": lambda: schema.compact(name, 128 << 20),
        "bulk_truncate": lambda: schema.truncate(name),
    }
    expected = {"bulk_create": rows, "bulk_delete_third": rows - rows // 3,
                "bulk_compact": rows - rows // 3, "bulk_truncate": 0}
    for step, job in steps.items():
        seconds[step] = timed(job)
        size = schema.footprint(name).first()
        sizes[step] = size.total_bytes
        assert size.row_count == expected[step], (step, size)
    return seconds, sizes


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rows = int(os.environ.get("BENCH_BULK", 10_000_000))
    runs = int(os.environ.get("BENCH_RUNS", 2))
    spark = build_session("bench", master=f"local[{cpus}]", settings={
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="run-"),
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        return timed(lambda: REGISTRY[name](spark, folder).write.format("noop")
                     .mode("overwrite").save())

    run("two_column_counts")  # start-up is not part of any query
    queries, sizes = bulk_steps(spark, rows)
    for name in sys.argv[1:] or HEADLINE:
        queries[name] = min(run(name) for _ in range(runs))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(queries.values()), 3),
                      "unit": "sec", "queries": queries, "sf": os.path.basename(folder.rstrip("/")),
                      "bulk_rows": rows, "bulk_bytes": sizes, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
