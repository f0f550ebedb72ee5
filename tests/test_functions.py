"""Literal inputs and outputs of the column functions."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from signalpost.functions import series as S
from signalpost.functions import text, times, values


def column(spark, items, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expr(F.col("v"))).collect()]


def test_clean_count(spark):
    items = ["1,234", "1.2만", "3만", "12.7", "", None, "abc", "0.3만", "nan", "1만5"]
    assert column(spark, items, values.clean_count) == [1234, 12000, 30000, 12, None, None, None, 3000, None, 100005]


def test_strip_prefix_and_suffix(spark):
    assert column(spark, ["조회 12", "12"], values.strip_prefix) == ["12", "12"]
    items = ["hi - dc App", "hi- dc official App", "- dc App hi", "hi"]
    assert column(spark, items, values.strip_suffix) == ["hi", "hi", "- dc App hi", "hi"]


def test_coerce_long(spark):
    assert column(spark, ["7", " 8 ", "x", "9.9", None], values.coerce_long) == [7, 8, None, 9, None]


def test_clean_url(spark):
    rows = spark.createDataFrame([("u?a=1&bm=2&c=3", "b"), ("u?a&search_pos=9", "d"), ("u?a&bm=2", "d")], "url string, s string")
    got = rows.select(values.clean_url(F.col("url"), F.col("s"), {"d": "&search_pos=", "b": "&bm="})).collect()
    assert [r[0] for r in got] == ["u?a=1", "u?a", "u?a&bm=2"]


def test_parse_dt_notations(spark):
    rows = [("a", "2024.01.05"), ("b", "2024.01.05. 09:30"), ("c", "2024.01.05 (금) 09:30"), ("d", "2024-01-05 09:30"),
            ("e", "2024-01-05 09:30:10+09:00"), ("f", "Fri, 05 Jan 2024 09:30:10 +0900"), ("d", "05/01/2024"), ("g", "2024.01.05 (09:30)")]
    formats = {"a": [times.DOT_DATE], "b": [times.DOT_DATE_TIME], "c": [times.DOT_TIME], "d": [times.DASH_TIME],
               "e": [times.ISO_ZONE], "f": ["dd MMM yyyy HH:mm:ss Z"], "g": [times.DOT_TIME_IN_PARENTHESES]}
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, s string, v string")
    got = [r[0] for r in df.orderBy("i").select(times.parse_dt(F.col("v"), F.col("s"), formats).cast("string")).collect()]
    assert got == ["2024-01-05 00:00:00", "2024-01-05 09:30:00", "2024-01-05 09:30:00", "2024-01-05 09:30:00",
                   "2024-01-05 00:30:10", "2024-01-05 00:30:10", None, "2024-01-05 09:30:00"]


def test_dates(spark):
    assert column(spark, ["2024-01-05 10:00", " 2024.01.05. x"], times.date_part_text) == ["2024-01-05", "2024.01.05."]
    asof = "2024-01-31 00:00"
    days = [dt.date(2023, 11, 1), dt.date(2023, 11, 2), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert column(spark, days, lambda c: times.last_days(c, asof, 90, closed=True), "date") == [False, True, True, False]
    assert column(spark, days, lambda c: times.last_days(c, asof, 90), "date") == [False, True, True, True]


def test_boost(spark):
    df = spark.createDataFrame([(100, dt.datetime(2024, 1, 30, 22), dt.date(2024, 1, 30)), (100, dt.datetime(2024, 1, 28, 23), dt.date(2024, 1, 28))],
                               "v long, t timestamp, d date")
    got = [r[0] for r in df.select(times.boost(F.col("v"), F.col("t"), F.col("d"), "2024-01-31 00:00")).collect()]
    assert got[0] == pytest.approx(100 * (1.2 ** -2 * 3 + 1)) and got[1] == 100


def test_tag_issues(spark):
    dictionary = [("b", ["xx", "yy"]), ("a", ["yy"]), ("none", ["qq"])]
    assert column(spark, ["..yy.xx", "XX", "xx"], lambda c: text.tag_issues(c, dictionary)) == [["b", "a"], [], ["b"]]


def test_search_and_keywords(spark):
    items = ["red car fast", "red car slow", "blue car", "red bus fast"]
    keep = column(spark, items, lambda c: text.search(c, ["red"], ["slow"], ["car", "bus"], "d c"))
    assert keep == [True, False, False, False]
    assert column(spark, ["A.B", "aXb", "zz"], lambda c: text.any_keyword([c], ["a.b"])) == [True, False, False]


def test_mentions_and_lexicon(spark):
    assert column(spark, ["aaaa", "b", ""], lambda c: text.mentions(c, F.lit("aa"))) == [2, 0, 0]
    assert column(spark, [" bad good  bad\nworse", "badly", None], lambda c: text.lexicon_count([c, c], ["bad", "worse"])) == [6, 0, 0]


def test_weighted_terms(spark):
    df = spark.createDataFrame([("1", "Fire fire", "fire smoke", "x")], "id string, title string, body string, comments string")
    once = {(r.term, r.weight) for r in text.weighted_terms(df, {"title": 5, "body": 2, "comments": 0}).collect()}
    assert once == {("fire", 5), ("fire", 2), ("smoke", 2)}
    every = text.weighted_terms(df, {"title": 5, "body": 2, "comments": 0}, distinct=False).groupBy("term").agg(F.sum("weight")).collect()
    assert dict(every) == {"fire": 12, "smoke": 2}


def test_parse_reply(spark):
    items = ['{"car_name":"A","issue":"True","topic":"t","summary":"s"}', 'So: {"issue":"False","topic":"t"}\nend', "nothing", "{broken}", None]
    got = column(spark, items, text.parse_reply)
    assert [tuple(g) for g in got] == [("A", True, "t", "s"), (None, False, "t", ""), (None, False, None, None),
                                       (None, False, None, None), (None, False, None, None)]


def test_first_url_and_labels(spark):
    assert column(spark, ['["a","b"]', "[]", None], values.first_url) == ["a", None, None]
    assert column(spark, ['["a"]', "[]", None], values.has_label) == [True, False, False]


def test_shift_and_rescale(spark):
    df = spark.sql("select array(named_struct('upload_date', date'2024-01-30', 'norm_graph_score', 1.5D)) s, array(0D, 5D, 10D) a, array(2D, 4D) b")
    row = df.select(S.shift_series(F.col("s"), F.lit(3)).alias("m"), S.rescale(F.col("a"), F.col("b")).alias("r"),
                    S.rescale(F.array(F.lit(1.0), F.lit(1.0)), F.col("b")).alias("flat")).first()
    assert row.m[0].upload_date == "2024-02-02" and row.r == [2.0, 3.0, 4.0] and row.flat == [None, None]


def test_poisson(spark):
    ks = [0, 1, 9, 255, 256, 1000]
    got = column(spark, ks, lambda c: S.log_factorial(c), "long")
    assert got == pytest.approx([math.lgamma(k + 1) for k in ks], rel=1e-13)
    got = column(spark, [9, 300], lambda c: S.poisson_pmf(c, F.lit(10.0)), "long")
    assert got == pytest.approx([math.exp(k * math.log(10) - 10 - math.lgamma(k + 1)) for k in (9, 300)], rel=1e-9)


def test_unicode_blanks_and_empty_keyword_list(spark):
    from signalpost.functions import text
    df = spark.createDataFrame([("k", "bad\u3000x\u00a0bad  bad")], "key string, t string")
    assert df.select(text.lexicon_count([F.col("t")], ["bad"])).first()[0] == 3
    lexicon = spark.createDataFrame([("bad",)], "word string")
    assert text.lexicon_count_by_join(df, "key", ["t"], lexicon, "word", "n").first()["n"] == 3
    assert df.filter(text.any_keyword([F.col("t")], [])).count() == 0


def test_threads_are_cut_by_their_own_length(spark):
    from signalpost.operators import windows
    df = spark.createDataFrame([("p", n, "top" if n == 9998 else f"r{n}") for n in range(9998, 10002)], "post string, pos bigint, text string")
    whole = windows.threads(df, "post", "pos", F.col("text") == "top", "text").collect()
    assert [(r["part"], r["comments"], r["text"]) for r in whole] == [(0, 4, "top\nr9999\nr10000\nr10001")]
    cut = windows.threads(df, "post", "pos", F.col("text") == "top", "text", limit=3).orderBy("part").collect()
    assert [(r["part"], r["comments"]) for r in cut] == [(0, 3), (1, 1)]


def test_long_case_names_and_links_of_split_lists(spark):
    from signalpost.plans import serving
    name = "x" * 70
    cases = spark.createDataFrame([(name, "e", "2024-01-01")], "recommend_car_name string, recommend_issue string, d string").withColumn(
        "recommend_start_date", F.to_date("d"))
    news = spark.createDataFrame([("u", "e", f"a {name} b", "2024-01-10"), ("v", "e", "x" * 69, "2024-01-10")], "url string, issue string, car_name string, d string").withColumn(
        "upload_date", F.to_date("d"))
    assert [r["url"] for r in serving.case_news(cases, news, "2024-03-01 00:00").collect()] == ["u"]
    lists = spark.createDataFrame([("c", "e", "2024-01-02", 0, '["m","n"]'), ("c", "e", "2024-01-02", 1, '["b","z"]'), ("c", "e", "2024-01-01", 0, '["a"]')],
                                  "car_name string, issue string, upload_date string, part int, url string")
    assert serving.trigger_link(lists).first()["url"] == "b"
