"""Readers, writers, pages and streams on small files."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from signalpost.schemas import CRAWL
from signalpost.sources import crawl, dictionaries, feeds, pages, sinks
from signalpost.sources.posts import jdbc_options
from signalpost.streaming.ingest import crawl_stream, run_to_folder

HEAD = ",".join(CRAWL.names)
ROW = '2024-01-01,10:00,"a, ""quoted""\ntitle",body,,1,2,{source},{car},http://x/{n}'


def put(path, *lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_crawl_grid_reads_what_is_there(spark, tmp_path):
    root, start, end = str(tmp_path), "2024-01-01 00:00", "2024-01-01 05:59"
    for n, (source, car) in enumerate([("bb", "k1"), ("dc", "k1"), ("dc", "other"), ("zz", "k1")]):
        put(tmp_path / crawl.crawl_path("", "community", source, start, end, car)[1:], HEAD, ROW.format(source=source, car=car, n=n))
    df = crawl.read_crawl_csv(spark, root, ["bb", "dc", "none"], ["k1", "k2"], start, end)
    got = crawl.with_path_provenance(df).orderBy("Url").collect()
    assert [(r.path_source, r.path_car, r.Url) for r in got] == [("bb", "k1", "http://x/0"), ("dc", "k1", "http://x/1")]
    assert got[0].Title == 'a, "quoted"\ntitle' and got[0].Comment is None and str(got[0].range_end) == "2024-01-01 05:59:00"
    assert crawl.read_crawl_csv(spark, root, ["none"], ["k1"], start, end).collect() == []
    assert crawl.read_crawl_csv(spark, root + "/nowhere", ["bb"], ["k1"], start, end).columns == CRAWL.names


def test_merge_csv_dir(spark, tmp_path):
    put(tmp_path / "a" / "1.csv", "post_id,x", "0,1")
    put(tmp_path / "a" / "2.csv", "post_id,x", "0,2")
    put(tmp_path / "b" / "1.csv", "x,y", "3,z")
    got = crawl.merge_csv_dir(spark, [(f"{tmp_path}/a/*.csv", T.StructType.fromDDL("post_id string, x string")),
                                      (f"{tmp_path}/b/*.csv", T.StructType.fromDDL("x string, y string"))])
    assert sorted(map(tuple, got.collect()), key=str) == [("1", None), ("2", None), ("3", "z")]


def test_dictionary_cases_and_words(spark, tmp_path):
    put(tmp_path / "d.json", json.dumps([{"defect_type": "e", "keywords": ["a", "b"]}, {"defect_type": "f", "keywords": []}], indent=2))
    assert [(r.defect_type, r.keywords) for r in dictionaries.read_dictionary(spark, f"{tmp_path}/d.json").select("defect_type", "keywords").collect()] == [("e", ["a", "b"]), ("f", [])]
    put(tmp_path / "k.json", json.dumps([{"car_name": "c", "defect_type": "e", "keywords": [], "news_dates": ["2024-01-05"]}]))
    assert str(dictionaries.read_known_cases(spark, f"{tmp_path}/k.json").first().news_dates[0]) == "2024-01-05"
    put(tmp_path / "w.txt", " bad ", "", "worse")
    assert [r.word for r in dictionaries.read_word_list(spark, f"{tmp_path}/w.txt").collect()] == ["bad", "", "worse"]


def test_feed_window(spark):
    item = "<item><title>{0}</title><link>l{0}</link><pubDate>{1}</pubDate><description>d</description></item>"
    payload = "<rss><channel><title>c</title>" + "".join(item.format(i, d) for i, d in enumerate(
        ["2024-01-05 09:30:00", "2024-01-05 08:30:00", "2024-01-05 10:00:00"])) + "</channel></rss>"
    df = spark.createDataFrame([(payload,)], "payload string")
    items = feeds.parse_feed(df, "payload").withColumn("t", F.to_timestamp("pub_date"))
    now = F.lit("2024-01-05 10:00:00").cast("timestamp")
    assert sorted(r.link for r in feeds.recent_items(items, "t", now).collect()) == ["l0", "l2"]


PAGE = """<html><head><style>p{}</style><script>var t="<p>no</p>";</script></head><body><div class="ad x">buy</div>
<article><h1>Big &amp; <b>bold</b></h1><p>One<br>two <span class="view">7</span><p>Three<div class="ad">ad</div></article></body></html>"""


def test_page_fields(spark):
    df = spark.createDataFrame([(1, PAGE), (2, None)], "id int, html string")
    rules = {"title": "article h1", "body": "article p", "view": "span.view", "like": "span.like"}
    got = {r.id: r for r in pages.extract_pages(df, "html", rules, [".ad"], missing="N/A").collect()}
    assert (got[1].title, got[1].body, got[1].view, got[1].like) == ("Big & bold", "Onetwo 7\nThree", "7", "N/A")
    assert got[2].title == "N/A"


def test_page_fields_by_id_with_date_and_comments(spark):
    html = ('<div id="main" class="x y"><em id="at">2024-01-05 10:30</em><p id="body">News</p></div><div class="main"><em id="other">no</em></div>'
            '<ul id="replies"><li class="reply">one</li><li class="reply">two</li></ul><li class="reply">elsewhere</li>')
    df = spark.createDataFrame([(1, html)], "id int, html string")
    rules = {"date": "div#main em#at", "body": "p#body", "comments": "#replies li.reply", "none": "#reply"}
    got = pages.extract_pages(df, "html", rules, [], missing="N/A").first()
    assert (got.date, got.body, got.comments, got.none) == ("2024-01-05 10:30", "News", "one\ntwo", "N/A")


def test_pages_reach_a_worker_in_small_lots_without_their_other_columns(spark):
    rows = [(None, "x", PAGE), (2**60 + 1, None, PAGE)]  # a number that no double holds, beside a null
    df = spark.createDataFrame(rows, "id bigint, `a.b` string, html string").coalesce(1)
    found = pages.extract_pages(df, "html", {"title": "article h1"}, [])
    assert [tuple(r) for r in found.collect()] == [(None, "x", "Big & bold"), (2**60 + 1, None, "Big & bold")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython ") == 1 and "Arrow" not in plan and "Pandas" not in plan


def test_links_are_made_absolute(spark):
    html = '<nav><a href="/a">A</a><a href="http://y/b">B</a></nav><a href="/c">C</a>'
    df = spark.createDataFrame([("http://x.com/list?p=1", html)], "url string, html string")
    assert [(r.link, r.title) for r in pages.extract_links(df, "html", "url").collect()] == [("http://x.com/a", "A"), ("http://y/b", "B")]


def test_json_and_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("a\n\"b\",", ""), (None, "x")], "p string, q string")
    sinks.write_csv(df, f"{tmp_path}/c")
    sinks.write_json(df, f"{tmp_path}/j")
    back = spark.read.schema(df.schema).options(**crawl.CSV).csv(f"{tmp_path}/c")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert sorted(map(str, spark.read.schema(df.schema).json(f"{tmp_path}/j").collect())) == sorted(map(str, df.collect()))


def test_jdbc_options_split_the_scan():
    got = jdbc_options("jdbc:x", "post", "upload_date", "2024-01-01", "2024-02-01", 8, user="u")
    assert got["numPartitions"] == "8" and got["partitionColumn"] == "upload_date" and got["user"] == "u"


def test_consumed_files_are_archived(spark, tmp_path):
    for n in range(3):
        put(tmp_path / "in" / f"{n}.csv", HEAD, ROW.format(source="s", car="k", n=n))
    stream = crawl_stream(spark, f"{tmp_path}/in/*.csv", f"{tmp_path}/archive", 1)
    assert run_to_folder(stream, f"{tmp_path}/out", f"{tmp_path}/state").count() == 3
    moved = list((tmp_path / "archive").rglob("*.csv"))
    assert len(moved) + len(list((tmp_path / "in").glob("*.csv"))) == 3 and moved


def test_trigger_alerts_are_dealt_into_messages(spark):
    from signalpost.plans import serving
    rows = [(f"car{i % 7}", f"issue{i}", "2024-01-19") for i in range(900)]
    triggers = spark.createDataFrame(rows, "car_name string, issue string, upload_date string").withColumn("upload_date", F.to_date("upload_date"))
    got = serving.trigger_alerts(triggers, "http://charts/?", "2024-01-20 00:00").collect()
    assert 1 < len(got) <= 5 and sum(r["entries"] for r in got) == 900
    lines = [line for r in got for line in r["text"].split("\n\n")[1:]]
    assert sorted(lines) == sorted(f"{c} - {i}\nhttp://charts/?car_name={c}&issue={i}" for c, i, _ in rows)
