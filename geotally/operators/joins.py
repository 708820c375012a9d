"""Stopword removal (anti join) and vocabulary restriction (semi join).

No side is marked for broadcast here: the planner does that from sizes in bytes, and AQE from what it measures. On token
streams the join must not be followed by a grouping on the same word (Spark would reuse the join's partitioning, and all
rows of a frequent word would meet in one task): the analyses count first, which combines a frequent word
to one row per task and key, and join the counted rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_stopwords(words: DataFrame, stopwords: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows whose ``word_col`` is no stopword (left anti join: duplicates on the left stay, those in the list don't matter)."""
    listed = stopwords.select(F.col(stopwords.columns[0]).alias("__sw"))
    return words.join(listed, F.col(word_col) == F.col("__sw"), "left_anti")


def keep_vocabulary(words: DataFrame, vocabulary: DataFrame, word_col: str = "word") -> DataFrame:
    """Rows whose ``word_col`` occurs in ``vocabulary`` (left semi join: duplicates in it don't matter)."""
    listed = vocabulary.select(F.col(vocabulary.columns[0]).alias("__vw"))
    return words.join(listed, F.col(word_col) == F.col("__vw"), "left_semi")
