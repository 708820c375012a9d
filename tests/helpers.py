"""Test data shared by the test modules."""

from geotally import schema as S

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def message(text, place="NewYork", utc=1500000000123, country="United States", code="US", ptype="city",
            lang="en", screen="Invented Screen", user="invented_user", offset=-18000, friends=17,
            lat=12.5, lon=-34.25):
    return (utc, country, code, ptype, place, lang, screen, user, offset, friends, text, lat, lon)


def messages_df(spark, rows):
    return spark.createDataFrame(rows, S.MESSAGE_SCHEMA)


# Training rows of the golden prediction set (place, text); all other columns are invented.
GOLDEN_TRAINING = [
    ("NewYork", "empire state building"),
    ("NewYork", "big empire state"),
    ("NewYork", "new york state"),
    ("London", "big ben"),
    ("London", "big state building"),
]
