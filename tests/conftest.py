"""Sessions of the tests."""

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from helpers import GOLDEN_TRAINING, message, messages_df  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from geotally.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def golden_messages(spark):
    return messages_df(spark, [message(t, place=p) for p, t in GOLDEN_TRAINING])
