"""Time the headline queries; prints one JSON line.

`BENCH_SF_DIR` names the tables and `BENCH_CPUS` the number of cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from pyspark.sql import SparkSession

from checks.queries import QUERIES

HEADLINE = (
    "validate_documents",
    "chunk_documents",
    "chunk_documents_small",
    "chunk_embeddings",
    "index_rows",
    "delete_by_doc_id",
    "message_outcomes",
    "stream_backfill",
    "bm25_search",
    "knn_search",
    "knn_cells",
    "hybrid_search",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # one small run, so that the start of the JVM and of the Python workers is not counted
    QUERIES["chunk_embeddings"](spark, sf_dir).limit(1).collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale.group(1)) if scale else sf_dir,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
