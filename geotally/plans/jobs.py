"""File-to-file batch jobs: the eight descriptive analyses and the place predictor.

Each job reads messages (tab-separated text or Parquet), runs one declarative plan and writes tab-separated
lines from the executors. Usage from the command line::

    python -m geotally analyses -m messages.tsv -o out/ [--stopwords sw.txt] [--sample]
    python -m geotally predict -t training.tsv -i inputs.txt -o predictions/ [-s]
    python -m geotally convert -m messages.tsv -o messages.parquet [--partition-by country_code]
    python -m geotally convert -m 'messages.tsv.gz.part*' --gz-parts -o messages.parquet
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.text import FIELD_SEP
from ..operators import bayes, stats, words
from ..session import written_table
from ..sources import sinks, tsv
from ..sources.archives import read_archive_messages
from ..sources.words import read_stopwords, word_list


def load_messages(spark: SparkSession, path: str, fmt: str = "tsv", on_bad: str = "fail",
                  sample: bool | float = False, seed: int | None = None) -> DataFrame:
    if fmt == "parquet":
        m = tsv.read_parquet(spark, path)
        if sample:
            m = m.sample(False, tsv.SAMPLE_FRACTION if sample is True else float(sample), seed)
        return m
    if on_bad == "quarantine":
        raise ValueError("use tsv.read_messages directly to receive the quarantined lines")
    return tsv.read_messages(spark, path, on_bad, sample, seed)


def write_profile(m: DataFrame, out: str, mode: str = "errorifexists") -> None:
    """``label<TAB> value`` lines in report order."""
    rep = stats.profile_report(m)
    sinks.write_lines(rep, F.concat("label", F.lit(FIELD_SEP + " "), "value"), out, ["pos"], single_file=True,
                      mode=mode)


def write_count_by(m: DataFrame, key: str, out: str, mode: str = "errorifexists") -> None:
    counts = stats.count_by(m, key, ordered=False)
    sinks.write_tsv(counts, out, [key, "n"], order_by=[F.desc("n"), F.asc(key)], mode=mode)


def write_centroids(m: DataFrame, out: str, key: str = S.COUNTRY_NAME, min_count: int = 10,
                    mode: str = "errorifexists") -> None:
    cent = stats.centroid_by(m, key, min_count)
    sinks.write_tsv(cent, out, [key, S.LATITUDE, S.LONGITUDE], order_by=[key], mode=mode)


def write_peak_hours(m: DataFrame, out: str, key: str = S.COUNTRY_NAME, mode: str = "errorifexists") -> None:
    peak = stats.peak_local_hour(m, key)
    sinks.write_tsv(peak, out, [key, "hour", "n"], order_by=[key], mode=mode)


def write_city_counts(m: DataFrame, out: str, country_code: str = "US", place_type: str = "city",
                      mode: str = "errorifexists") -> None:
    counts = stats.filtered_count_by(m, S.PLACE_NAME, country_code, place_type, ordered=False)
    sinks.write_tsv(counts, out, [S.PLACE_NAME, "n"], order_by=[F.desc("n"), F.asc(S.PLACE_NAME)], mode=mode)


def write_word_counts(m: DataFrame, stopwords: DataFrame, out: str, country_code: str = "US",
                      mode: str = "errorifexists") -> None:
    counts = words.word_counts(m, stopwords, country_code, ordered=False)
    sinks.write_tsv(counts, out, ["word", "n"], order_by=[F.desc("n"), F.asc("word")], mode=mode)


def write_top_words(m: DataFrame, stopwords: DataFrame, out: str, top_places: int = 5, top_words: int = 10,
                    country_code: str = "US", place_type: str = "city", mode: str = "errorifexists") -> None:
    lines = words.wide_lines(words.top_words_in_top_groups(
        m, stopwords, S.PLACE_NAME, top_places, top_words, country_code, place_type))
    sinks.write_lines(lines, F.col("line"), out, [F.desc("place_n"), F.asc(S.PLACE_NAME)], single_file=True,
                      mode=mode)


def run_analyses(spark: SparkSession, messages: DataFrame, out_dir: str, stopwords: DataFrame | None = None,
                 country_code: str = "US", mode: str = "errorifexists") -> None:
    """All descriptive analyses into ``out_dir/result_<n>``.

    The input is read and parsed once, into a typed table in the shared folder; each analysis then reads only its
    columns of that table, which is dropped at the end.
    """
    sw = stopwords if stopwords is not None else word_list(spark, [])
    base = out_dir.rstrip("/")
    with written_table(messages, "messages") as m:
        write_profile(m, f"{base}/result_1", mode)
        write_count_by(m, S.COUNTRY_NAME, f"{base}/result_2", mode)
        write_centroids(m, f"{base}/result_3", mode=mode)
        write_peak_hours(m, f"{base}/result_4", mode=mode)
        write_city_counts(m, f"{base}/result_5", country_code, mode=mode)
        write_word_counts(m, sw, f"{base}/result_6", country_code, mode=mode)
        write_top_words(m, sw, f"{base}/result_7", country_code=country_code, mode=mode)
        sinks.write_tsv(stats.profile(m), f"{base}/result_8", single_file=True, mode=mode)


def predict_files(spark: SparkSession, training: str, inputs: str, output: str, sample: bool | float = False,
                  seed: int | None = None, training_format: str = "tsv", full_model: str | None = None,
                  mode: str = "errorifexists", with_text: bool = True) -> DataFrame:
    """Fit on ``training``, predict a place for every line of ``inputs``, write one line per input: the input's text and
    its answer, or the bare answer if ``with_text`` is off (for a single input).

    With ``full_model`` (a directory written by ``PlaceModel.save``) the stored model is used; otherwise a
    model restricted to the inputs' words is fitted and written once to the shared checkpoint folder.
    Returns the (lazy) predictions DataFrame; evaluating it again recomputes from the written model.
    """
    # Numbered from lines that were written once: every later use sees the same numbers.
    ins = tsv.read_inputs(spark, inputs)
    batch = bayes.prepare_inputs(ins)
    if full_model:
        model = bayes.PlaceModel.load(spark, full_model)
    else:
        m = load_messages(spark, training, training_format, sample=sample, seed=seed)
        model = bayes.fit_and_write_place_model(m, vocabulary=batch.vocabulary(), name="predict-model")
    pred = bayes.predict_place(model, batch)
    sinks.write_predictions(pred, output, mode=mode, inputs=ins if with_text else None)
    return pred


def main(argv: list[str] | None = None) -> None:
    from ..session import build_session

    parser = argparse.ArgumentParser(prog="geotally", description="Geo-message analytics on Spark")
    sub = parser.add_subparsers(dest="cmd", required=True)
    a = sub.add_parser("analyses", help="run the descriptive analyses")
    a.add_argument("-m", "--messages", required=True)
    a.add_argument("-o", "--output", required=True)
    a.add_argument("--format", default="tsv", choices=["tsv", "parquet"])
    a.add_argument("--stopwords")
    a.add_argument("--country-code", default="US")
    a.add_argument("-s", "--sample", action="store_true")
    p = sub.add_parser("predict", help="predict a place for each input line")
    p.add_argument("-t", "--training", required=True)
    p.add_argument("-i", "--input", required=True)
    p.add_argument("-o", "--output", required=True)
    p.add_argument("--format", default="tsv", choices=["tsv", "parquet"])
    p.add_argument("-s", "--sample", action="store_true")
    p.add_argument("--master", default=None)
    a.add_argument("--master", default=None)
    c = sub.add_parser("convert", help="convert tab-separated messages to Parquet once")
    c.add_argument("-m", "--messages", required=True)
    c.add_argument("-o", "--output", required=True)
    c.add_argument("--gz-parts", action="store_true", help="the files are parts of gzip archives, cut by bytes")
    c.add_argument("--archive-pattern", help="its first group tells the archive from a part's name (else all are one)")
    c.add_argument("--on-bad", default="fail", choices=["fail", "null"])
    c.add_argument("--partition-by", nargs="*", default=[])
    c.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = build_session(args.master) if args.master else SparkSession.builder.getOrCreate()
    if args.cmd == "convert":
        m = (read_archive_messages(spark, args.messages, args.on_bad, args.archive_pattern) if args.gz_parts
             else tsv.read_messages(spark, args.messages, args.on_bad))
        tsv.write_parquet(m, args.output, partition_by=tuple(args.partition_by))
    elif args.cmd == "analyses":
        m = load_messages(spark, args.messages, args.format, sample=args.sample)
        sw = read_stopwords(spark, args.stopwords) if args.stopwords else None
        run_analyses(spark, m, args.output, sw, args.country_code)
    else:
        predict_files(spark, args.training, args.input, args.output, sample=args.sample,
                      training_format=args.format)


if __name__ == "__main__":
    main()
