"""The message table: 13 positional columns, typed once at the source."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and positions of the tab-separated message format.
UTC_TIME = "utc_time"                  # 0, epoch milliseconds
COUNTRY_NAME = "country_name"          # 1
COUNTRY_CODE = "country_code"          # 2
PLACE_TYPE = "place_type"              # 3
PLACE_NAME = "place_name"              # 4
LANGUAGE = "language"                  # 5
USER_SCREEN_NAME = "user_screen_name"  # 6
USERNAME = "username"                  # 7
TIMEZONE_OFFSET = "timezone_offset"    # 8, seconds
NUMBER_OF_FRIENDS = "number_of_friends"  # 9
TEXT = "tweet_text"                    # 10
LATITUDE = "latitude"                  # 11
LONGITUDE = "longitude"                # 12

MESSAGE_SCHEMA = T.StructType([
    T.StructField(UTC_TIME, T.LongType()),
    T.StructField(COUNTRY_NAME, T.StringType()),
    T.StructField(COUNTRY_CODE, T.StringType()),
    T.StructField(PLACE_TYPE, T.StringType()),
    T.StructField(PLACE_NAME, T.StringType()),
    T.StructField(LANGUAGE, T.StringType()),
    T.StructField(USER_SCREEN_NAME, T.StringType()),
    T.StructField(USERNAME, T.StringType()),
    T.StructField(TIMEZONE_OFFSET, T.IntegerType()),
    T.StructField(NUMBER_OF_FRIENDS, T.IntegerType()),
    T.StructField(TEXT, T.StringType()),
    T.StructField(LATITUDE, T.DoubleType()),
    T.StructField(LONGITUDE, T.DoubleType()),
])

MESSAGE_COLUMNS = [f.name for f in MESSAGE_SCHEMA.fields]

# Lengths of the text in characters and in single-space words, where a source takes them at its scan.
TEXT_CHARS = "text_chars"
TEXT_WORDS = "text_words"
