"""Many patterns in one reading, against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from signalpost.functions import matching, text
from signalpost.plans import ingest

SF = "/root/testdata/sf0.001"


def texts():
    local = random.Random(8)
    letters = "abc é그랜　"
    return [None, "", "aaaa"] + ["".join(local.choice(letters) for _ in range(local.randint(0, 60))) for _ in range(200)] + ["b" * 50_000 + "cab"]


@pytest.mark.parametrize("piece_bytes", [1 << 20, 60])
def test_labels_of_overlapping_patterns(spark, piece_bytes):
    local = random.Random(9)
    patterns = [("", 0, "empty"), (None, 1, "null"), ("a", 2, "x"), ("aa", 2, "x"), ("aa", 3, "y"), ("cab", 4, None), ("그랜", 5, "z"), ("zz", 6, "never")]
    patterns += [("".join(local.choice("abcé") for _ in range(local.randint(2, 4))), 10 + i, f"p{i}") for i in range(30)]
    data = list(enumerate(texts()))
    df = spark.createDataFrame(data, "position int, t string").repartition(4)
    dictionary = spark.createDataFrame(patterns, "pattern string, position int, label string")
    got = {r["position"]: [tuple(x) for x in r["found"]] for r in matching.find_labels(df, "t", dictionary, "found", piece_bytes).collect()}
    for key, value in data:
        want = {(p, name) for w, p, name in patterns if w and value is not None and w in value}
        assert sorted(got[key]) == sorted(want, key=lambda x: (x[0], x[1] or "")) and len(set(got[key])) == len(got[key])


@pytest.mark.parametrize("piece_bytes", [1 << 20, 40])
def test_words_of_a_lexicon(spark, piece_bytes):
    data = [(i, t, None if i % 3 else "ab c") for i, t in enumerate(texts())]
    lexicon = ["a", "b", "c", "ab", "é", "aaaa", "그", "", None, "a"]
    df = spark.createDataFrame(data, "k int, t string, u string").repartition(3)
    words = spark.createDataFrame([(w,) for w in lexicon], "word string")
    got = {r["k"]: r["n"] for r in matching.count_words(df, ["t", "u"], words, "word", "n", piece_bytes).collect()}
    for k, t, u in data:
        tokens = [x for x in re.split(r"[\s　]+", " ".join(x for x in (t, u) if x is not None)) if x]
        assert got[k] == sum(x in set(lexicon) for x in tokens), (t, u)


def test_empty_dictionary(spark):
    df = spark.createDataFrame([("a b",)], "t string")
    none = spark.createDataFrame([], "pattern string, position int, label string")
    assert matching.find_labels(df, "t", none).first()["labels"] == []
    assert matching.count_words(df, ["t"], none.select("pattern"), "pattern", "n").first()["n"] == 0


@pytest.mark.parametrize("name", ["b16_dictionary_tags_by_join", "b28_lexicon_count_by_join"])
def test_texts_are_not_shuffled(spark, name):
    assert "Exchange" not in entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def test_texts_reach_the_counting_worker_in_small_lots(spark):
    df = spark.createDataFrame([(i, "a b\u3000a\x1ca") for i in range(300)], "k int, t string").coalesce(1)
    counted = matching.count_words(df, ["t"], spark.createDataFrame([("a",), ("a\x1ca",)], "word string"), "word", "n")
    assert {r["n"] for r in counted.collect()} == {2}  # a file separator is no blank
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython ") == 1 and "Arrow" not in plan


def test_tags_of_repeated_keys(spark):
    posts = spark.createDataFrame([("k", "the cat"), ("k", None), ("k", "none")], "url string, text string")
    dictionary = spark.createDataFrame([(1, "b", ["cat"]), (0, "a", ["the ", "x"])], "position int, defect_type string, keywords array<string>")
    assert sorted(r["issue"] for r in ingest.tag_by_table(posts, "url", "text", dictionary).collect()) == ['["a","b"]', "[]", "[]"]
    assert posts.select(text.lexicon_count([F.col("text")], ["cat"]).alias("n")).agg(F.sum("n")).first()[0] == 1
