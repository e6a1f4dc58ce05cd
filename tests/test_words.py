from pyspark.sql import functions as F

from tests.golden import FILTER_COUNTS, FILTER_LINE, WORD_LINES as WORDS
from tidewater import sources
from tidewater.operators import words as W
from tidewater.operators.checks import ContentMismatch, expect_rows


def _words(spark, lines, **kw):
    df = sources.from_strings(spark, lines)
    return [r.word for r in W.tokenize(df, "value", **kw).collect()]


def test_tokenizer_cases(spark):
    assert _words(spark, [" some  input  words "]) == ["some", "input", "words"]
    assert _words(spark, [" "]) == []
    assert _words(spark, [" some ", " input", " words"]) == ["some", "input", "words"]


def test_tokenizer_unicode_letters(spark):
    assert _words(spark, ["Étion dans, çouelle-über 42x"]) == ["Étion", "dans", "çouelle", "über", "x"]


def test_apostrophe_variant(spark):
    assert _words(spark, ["ungovern'd robbers' know't"], keep_apostrophes=True) == [
        "ungovern'd", "robbers'", "know't"]




def test_count_words_golden(spark):
    counts = W.count_words(sources.from_strings(spark, WORDS))
    assert {r.word: r.n for r in counts.collect()} == {"hi": 5, "there": 1, "sue": 2, "bob": 2}


def test_format_counts(spark):
    counts = W.count_words(sources.from_strings(spark, WORDS))
    assert sorted(r.value for r in W.format_counts(counts).collect()) == [
        "bob: 2", "hi: 5", "sue: 2", "there: 1"]


def test_filter_full_match_and_check(spark):
    line = FILTER_LINE + " Flourishes"
    counts = W.count_words(sources.from_strings(spark, [line]))
    got = W.filter_words(counts)
    expected = spark.createDataFrame(FILTER_COUNTS, "word string, n long")
    expect_rows(got, expected)
    m = W.filter_metrics(counts).first()
    assert (m.matched_words, m.unmatched_words) == (2, 4)


def test_expect_rows_raises(spark):
    df = spark.createDataFrame([("a", 1)], "word string, n long")
    exp = spark.createDataFrame([("a", 2)], "word string, n long")
    try:
        expect_rows(df, exp)
    except ContentMismatch:
        return
    raise AssertionError("mismatch not detected")


def test_line_metrics_java_blank(spark):
    df = sources.from_strings(spark, ["", " \t ", "abc", "a b"])
    m = W.line_metrics(df).first()
    assert (m.n_lines, m.empty_lines, m.sum_len, m.min_len, m.max_len) == (4, 2, 9, 0, 3)


def test_lengths_and_long_form(spark):
    df = sources.from_strings(spark, ["To be, or not"])
    r = W.line_lengths(df).first()
    assert (r.len, r.len_nospace) == (13, 10)
    tags = {x.tag: x.len for x in W.lengths_long(df).collect()}
    assert tags == {"length": 13, "length_nospace": 10}


def test_lines_of_splits_like_a_line_reader(spark):
    df = spark.createDataFrame([("a\nb\r\nc\n",)], "text string")
    assert [r.value for r in sources.lines_of(df, "text").collect()] == ["a", "b", "c"]


def test_windowed_count_keys(spark):
    df = spark.createDataFrame([("2024-01-01 00:01:00", "a b"), ("2024-01-01 00:11:00", "a")],
                               "ts string, value string").withColumn("ts", F.col("ts").cast("timestamp"))
    c = W.count_words(df, extra_keys=[F.window("ts", "10 minutes").alias("window")])
    got = sorted((r.window.start.minute, r.word, r.n) for r in c.collect())
    assert got == [(0, "a", 1), (0, "b", 1), (10, "a", 1)]


def test_event_time_assignment(spark):
    from tidewater.functions.time import hashed_event_time, random_event_time
    from tidewater.operators.windows import assign_event_time
    df = sources.from_strings(spark, [f"line {i}" for i in range(200)])
    lo, hi = 1_704_067_200_000, 1_704_067_200_000 + 3_600_000
    r = assign_event_time(df, random_event_time(lo, hi, seed=1)).agg(
        F.min(F.unix_millis("ts")).alias("a"), F.max(F.unix_millis("ts")).alias("b")).first()
    assert lo <= r.a and r.b < hi
    h1 = [x.ts for x in assign_event_time(df, hashed_event_time(lo, hi, "value")).collect()]
    h2 = [x.ts for x in assign_event_time(df, hashed_event_time(lo, hi, "value")).collect()]
    assert h1 == h2 and len(set(h1)) > 150
    d = assign_event_time(df, random_event_time()).agg(F.count("ts").alias("n")).first()
    assert d.n == 200


def test_digest_event_time(spark):
    import hashlib

    from tidewater.functions.time import digest_event_time
    lo, hi = 1_000_000, 8_000_000
    rows = [("a", 1), (None, 2), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "k string, n int").select("k", "n", F.unix_millis(digest_event_time(lo, hi, "k", "n")).alias("ms"))
    for r in df.collect():
        text = f"{r.k or ''}\x1f{'' if r.n is None else r.n}"
        assert r.ms == lo + int(hashlib.md5(text.encode()).hexdigest()[:13], 16) % (hi - lo)
