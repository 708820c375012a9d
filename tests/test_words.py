"""Word analyses: tokenising rules, stopwords, exactly-N top words, ties."""

from helpers import message, messages_df
from geotally.operators import words
from geotally.sources.words import word_list


def test_length_is_tested_before_lowercasing(spark):
    # 'İx' has 2 code points (dropped) although its lower-case form has 3.
    m = messages_df(spark, [message("İx Abc ab abcd")])
    got = sorted(r.word for r in words.word_tokens(m).collect())
    assert got == ["abc", "abcd"]


def test_word_counts_drop_stopwords_and_rank(spark):
    rows = [message("The cat and THE dog"), message("cat cat dog the"), message("cat", code="GB")]
    m = messages_df(spark, rows)
    got = [(r.word, r.n) for r in words.word_counts(m, word_list(spark, ["the", "and"])).collect()]
    assert got == [("cat", 3), ("dog", 2)]


def test_newlines_and_punctuation_stay_in_tokens(spark):
    m = messages_df(spark, [message("foo,\nbar baz!")])
    got = sorted(r.word for r in words.word_tokens(m).collect())
    assert got == ["baz!", "foo,\nbar"]


def test_top_words_exactly_n_with_word_ties(spark):
    text = " ".join(f"w{i:02d}" for i in range(15))  # 15 words, all with count 1 per message
    rows = [message(text, place="P")] * 2 + [message("zzz zzz", place="P")]
    m = messages_df(spark, rows)
    out = words.top_words_in_top_groups(m, word_list(spark, []), top_groups_n=5, top_words_n=10).collect()
    assert [r.word for r in out] == [f"w{i:02d}" for i in range(10)]
    assert [r.r for r in out] == list(range(1, 11))
    assert all(r.n == 2 and r.place_n == 3 for r in out)


def test_top_places_ties_go_to_lower_name(spark):
    rows = []
    for place, n in [("E", 3), ("D", 3), ("C", 2), ("B", 2), ("A", 1), ("F", 2)]:
        rows += [message("hello", place=place)] * n
    m = messages_df(spark, rows)
    top = [(r.place_name, r.place_n) for r in words.top_groups(m, top=5).collect()]
    assert top == [("D", 3), ("E", 3), ("B", 2), ("C", 2), ("F", 2)]


def test_place_with_only_stopwords_is_absent(spark):
    rows = [message("the the", place="A")] * 3 + [message("hello", place="B")]
    m = messages_df(spark, rows)
    out = words.top_words_in_top_groups(m, word_list(spark, ["the"])).collect()
    assert {r.place_name for r in out} == {"B"}


def test_wide_lines_format(spark):
    rows = [message("aaa bbb aaa", place="P")] * 2 + [message("ccc", place="Q")]
    m = messages_df(spark, rows)
    tw = words.top_words_in_top_groups(m, word_list(spark, []))
    lines = [r.line for r in words.wide_lines(tw).collect()]
    assert lines == ["P\taaa\t4\tbbb\t2\t", "Q\tccc\t1\t"]
