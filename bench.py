"""Time the headline queries and print one JSON line: the better of two runs of each.

BENCH_SF_DIR  folder of the tables (default: sf0.1)
BENCH_CPUS    local cores (default: 8)
BENCH_ONLY    comma-separated query names (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from quarrymill.plans import QUERIES  # noqa: E402
from quarrymill.session import local_session  # noqa: E402

HEADLINE = [
    "customers",
    "rpt_events",
    "agg_group",
    "agg_filter",
    "join_inner_equi",
    "join_left_chain",
    "filter_gt_max",
    "surrogate_key",
    "customer_order_counts",
    "customer_activity",
    "write_append",
    "write_replace",
    "write_merge",
    "publish_table",
    "publish_incremental",
    "load_stream",
    "stream_load",
    "scan_csv_seed",
    "scan_csv_split",
    "scan_jsonl",
    "scan_api_pages",
    "infer_csv_types",
    "infer_json_types",
    "apply_clickhouse_types",
    "test_unique",
    "run_column_tests",
    "graph_descendants",
    "graph_ancestors",
    "dangling_refs",
    "page_chain_audit",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_ONLY", "").split(",") if n] or HEADLINE
    scratch = tempfile.mkdtemp(prefix="quarrymill-bench-")
    spark = local_session(
        cores,
        int(cores) if cores.isdigit() else 8,
        **{"spark.sql.warehouse.dir": f"{scratch}/warehouse", "spark.checkpoint.dir": f"{scratch}/shared"},
    )

    seconds = {}
    for name in names:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall-clock of the headline queries, better of two runs each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
