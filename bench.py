"""Headline queries on the sample tables; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from checks import adapter  # noqa: E402
from checks.queries import QUERIES, enriched  # noqa: E402
from storyloom.plans.enrich import enrich  # noqa: E402
from storyloom.session import build_session  # noqa: E402

# whole-table work on the raw texts, then reports over the finished table
HEADLINE = [
    "clean_text", "processed_text", "lemmas_long", "entities_long", "sentiment_full", "text_features",
    "duplicate_rows", "length_describe", "sample_by_group", "kpis", "top_tokens", "top_org", "label_by_product",
    "label_by_org", "corr_matrix", "box_words", "hist_length", "csv_import", "incremental_enrich",
    "lineitem_describe",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}
    # the first run also loads and compiles; the second is the steady rate
    for name in ("enrich_first_run", "enrich_all"):
        start = time.time()
        run(enrich(adapter.complaints(spark, sf_dir, joined=True), adapter.TABLES))
        times[name] = round(time.time() - start, 3)
    start = time.time()
    enriched(spark, sf_dir)
    times["write_finished_table"] = round(time.time() - start, 3)
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    for name in HEADLINE:
        start = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - start, 3)
    sys.stdout.flush()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "documents": rows,
                "enrich_rows_per_sec": round(rows / times["enrich_all"], 1),
            }
        )
    )


if __name__ == "__main__":
    main()
