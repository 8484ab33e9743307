"""Time the headline queries, one per operator family; prints one JSON line.

``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) and ``BENCH_CPUS`` (default 8) set tables and cores. The first
two queries run once unmeasured to warm the JVM up; each query is measured from building the plan to the last row, three
times, of which the median counts. ``plan`` has the median seconds of building plans alone.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

from catalog import QUERIES

HEADLINES = [
    "flagship_event_samples",
    "flatten_standard",
    "flatten_with_schema",
    "arrays_to_samples",
    "descend_through_elements",
    "split_nested_arrays",
    "path_extraction",
    "key_value_text",
    "column_text_documents",
    "block_regex_fields",
    "csv_text",
    "exposition_label_samples",
    "exposition_raw_samples",
    "bean_grouping",
    "bean_compression",
    "csv_files_scanned",
    "stream_rates",
    "response_envelopes",
    "page_sequence_until_empty",
    "html_tables",
    "keys_rename_and_replace",
    "wide_plane_keys",
    "timestamp_conversion",
    "sub_parse",
    "formulas",
    "formulas_on_columns",
    "sample_exclude_filter",
    "wide_plane_filter",
    "merge_per_group",
    "join_with_secondaries",
    "lookup_fan_out",
    "dedupe_lookups",
    "metric_typing",
    "metric_rate_and_positive_delta",
    "dimensional_payloads",
    "batches_per_entity",
    "labelled_queries",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("samplecraft-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> tuple[float, float]:
        start = time.perf_counter()
        df = QUERIES[name](spark, sf_dir)
        built = time.perf_counter() - start
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start, built

    for name in HEADLINES[:2]:
        run(name)
    times, plans = {}, {}
    for name in HEADLINES:
        runs = [run(name) for _ in range(3)]
        times[name], plans[name] = (round(median(r[k] for r in runs), 3) for k in (0, 1))
        print(f"{name} {times[name]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times, "plan": plans, "sf": sf})
    )
    spark.stop()


if __name__ == "__main__":
    main()
