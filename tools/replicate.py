"""Build an N-fold replica of a scale factor's message tables, for growth measurements with bench.py.

Usage: python tools/replicate.py SRC_SF_DIR DST_DIR COPIES
       BENCH_SF_DIR=DST_DIR python bench.py

``documents`` and ``events`` are copied COPIES times with ids shifted per copy, so each copy joins only to
itself; ``customer``, ``nation`` and ``benchmark`` are shared, which makes hot customers COPIES times hotter.
Write DST_DIR to a scratch folder; nothing here belongs in the repository.
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    src, dst, copies = sys.argv[1], sys.argv[2], int(sys.argv[3])
    from pyspark.sql import functions as F

    from geotally.session import build_session

    spark = build_session("local[8]", 8, extra={"spark.driver.memory": "8g"})
    events = spark.read.parquet(f"{src}/events.parquet")
    span = events.agg(F.max("event_id")).first()[0] + 1  # id shift per copy, larger than any id
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    docs = spark.read.parquet(f"{src}/documents.parquet").select("*", copy)
    (docs.withColumn("doc_id", F.col("doc_id") + F.col("copy") * span).drop("copy")
         .repartition(max(8, copies * 2)).write.parquet(f"{dst}/documents.parquet"))
    (events.select("*", copy).withColumn("event_id", F.col("event_id") + F.col("copy") * span).drop("copy")
           .repartition(max(8, copies)).write.parquet(f"{dst}/events.parquet"))
    for name in ("customer", "nation", "benchmark"):
        spark.read.parquet(f"{src}/{name}.parquet").write.parquet(f"{dst}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()
