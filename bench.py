"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma-separated names; default the headline ones).
Rows are materialised by a noop write; a query's figure is the median of its warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "word_vocabulary",
    "encode_words",
    "pack_sequences",
    "pack_sequences_long",
    "pack_chunks",
    "pack_chunks_by_source",
    "pack_chunks_split",
    "explode_blocks",
    "ratio_split",
    "shuffle_blocks",
    "mix_datasets",
    "chat_render",
    "source_jsonl_zst",
    "chunk_files",
    "shard_files",
    "corpus_totals",
    "power_threshold",
    "tail_cutoff",
    "run_energy",
    "energy_report_tokens",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from catalog.queries import QUERIES
    from quern.session import DEFAULTS

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", cpus)
    )
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    cold, warm = {}, {}
    for name in names:
        cold[name] = round(once(name), 3)
        warm[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
        print(f"{name}: cold {cold[name]} warm {warm[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_warm_seconds",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
