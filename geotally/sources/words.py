"""Word-list sources: stopwords from a text file (one word per line) or from a fixed list."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """``word string``: one stopword per line of a text file (lines kept verbatim, duplicates removed)."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def word_list(spark: SparkSession, words: Iterable[str]) -> DataFrame:
    """``word string`` from an in-memory list, as a JVM-side literal (no Python worker is involved)."""
    lits = [F.lit(w) for w in words]
    arr = F.array(*lits) if lits else F.array().cast("array<string>")
    return spark.range(1).select(F.explode(arr).alias("word"))
