"""Seconds of the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

import json
import os
import sys
import tempfile
import time
from pathlib import Path

ROOT = Path(__file__).resolve().parent
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
sys.path.insert(0, str(ROOT))

NAMES = ("near_copies", "chunk_links", "unanswered", "segments", "graders", "overlap_pairs", "match_records", "matching", "leaderboard", "responses", "template_matches", "user_features", "cohesion")


def main():
    from pyspark.sql import SparkSession

    from threadline.plans import QUERIES

    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    at = tempfile.mkdtemp(prefix="spark-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", f"file://{at}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{at}/warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    took = {}
    for name in NAMES:
        began = time.time()
        QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - began, 2)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(took.values()), 2), "unit": "sec", "queries": took, "sf": Path(path).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
