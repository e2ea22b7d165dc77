"""Times headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import time

from pyspark.sql import SparkSession

from reportloom.plans import queries as plans

HEADLINE = ("quality_gate_status", "doc_line_index", "section_split", "audit_size_stats", "audit_missing_patterns", "compare_size_top20", "clean_quality_score", "region_merge", "chapter_bounds", "response_text")


def main() -> None:
    sf, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    plans.QUERIES["quality_gate_status"](spark, sf).count()  # starts the JVM's compilation
    took = {}
    for name in HEADLINE:
        began = time.perf_counter()
        plans.QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf}))


if __name__ == "__main__":
    main()
