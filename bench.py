"""Time the headline queries; prints one JSON line.

Each query is planned and run in full into a no-op sink. ``BENCH_SF_DIR`` names the tables,
``BENCH_CPUS`` the local cores. One small query warms the JVM up first.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sheafline.checks import CHECKS  # noqa: E402
from sheafline.session import build_session  # noqa: E402

HEADLINE = (
    "host_harvest",
    "graph_to_arc",
    "mapper_registry",
    "jsonld_triples",
    "jsonld_blocks",
    "graph_publications",
    "iso_roundtrip",
    "record_to_arc",
    "record_comments",
    "processing_table",
    "iso_arrays",
    "solr_docs",
    "sitemap_urls",
    "sitemap_tree",
    "url_dedup",
    "robots_allowed",
    "polite_schedule",
    "final_attempt",
    "outcome_counts",
    "counts_final",
    "client_errors",
    "run_report",
    "page_cut",
    "page_stop",
    "dc_fallback",
    "catalog_filter",
    "slug_titles",
    "stream_counts",
)


def session(cpus: str) -> SparkSession:
    """Local session sized for the bench machine."""
    return build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.driver.memory": "16g",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )


def main() -> None:
    """Run and report."""
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    CHECKS["host_counts"].run(spark, sf_dir).count()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        CHECKS[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
