"""Queries against their SQL, the neighbour search and the pipeline against plain versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute_pii
import corpus_pipeline
from signalpost import scale
from signalpost.llm import ann, queries
from test_text_operators import SCHEMA, contamination_brute, near_brute, rows
from tools.compare import connect, rows_of

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_matches_sql(spark, name):
    df = queries.QUERIES[name](spark, SF)
    cursor = connect(SF).execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op5_decontaminate", "op8_personal_data"])
def test_native_queries_run_no_python(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"))


def test_neighbours(spark):
    local = np.random.default_rng(3)
    points = local.normal(size=(1500, 8)).round(2)
    points[200:700] = points[200]  # a third of all vectors are the same
    data = [(i, [float(x) for x in p], i % 3) for i, p in enumerate(points)]
    odd = [(2000, None, 0), (2100, [0.0] * 8, 0), (2200, [1.0, None] * 4, 0), (2300, [float("nan")] + [1.0] * 7, 0), (2400, [1.0] * 3, 0), (None, [1.0] * 8, 0),
           (200, [float(x) for x in points[200]], 0)]
    frame = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<double>, rank int").repartition(4)
    found, info = ann.search(frame)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(got) == list(range(0, 1500, 100)) and info["recall"] >= 0.97
    hits = 0
    for q, near in got.items():
        gaps = np.sqrt(((points - points[q]) ** 2).sum(axis=1))
        best = sorted((d, i) for i, d in enumerate(gaps) if i != q)[:10]
        assert [n for n, _, _ in sorted(near)] == list(range(1, 11))
        assert all(abs(s - gaps[v]) < 1e-12 for _, v, s in near)
        assert [(s, v) for _, v, s in sorted(near)] == sorted((s, v) for _, v, s in near)
        hits += len({v for _, v, _ in near} & {i for _, i in best})
    assert hits >= 0.95 * 150
    assert ann.search(frame.limit(0))[0].collect() == [] and ann.search(frame.filter("vec_id = 2100"))[0].collect() == []


def test_every_query_meets_every_vector_once_in_bounded_groups(spark):
    index = spark.createDataFrame([(i, [1.0], i % 2) for i in range(600)], "id bigint, v array<double>, leaf bigint")
    wanted = spark.createDataFrame([(i, [1.0], 0) for i in range(400)], "id bigint, v array<double>, leaf bigint")
    groups = {}
    for r in ann.meetings(index, wanted, 50).collect():
        groups.setdefault((r["leaf"], r["block"], r["part"]), ([], []))[r["query"]].append(r["id"])
    assert len(groups) == 6 * 8 and all(len(vectors) < 100 and len(queries) < 100 for vectors, queries in groups.values())
    pairs = [(q, v) for vectors, queries in groups.values() for q in queries for v in vectors]
    assert len(pairs) == len(set(pairs)) == 400 * 300


def test_pipeline_stages(spark, tmp_path):
    data = rows()
    docs = spark.createDataFrame(data, SCHEMA).repartition(3)
    clean = corpus_pipeline.near_duplicates(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    kept = {r["doc_id"] for r in clean.collect()}
    assert kept == {k[0] for k in near_brute(data, 5, 80) if k[3]} | {None}
    spark.createDataFrame([(1, " ".join(data[-10][1].split()[:12]))], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = [(1, " ".join(data[-10][1].split()[:12]))]
    left = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    bad = {k[0] for k in contamination_brute(data, items) if k[5]}
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {r[0] for r in data} - bad
    private = spark.createDataFrame([(1, "x a@b.cd y", "en", "s", 10), (2, "none", "en", "s", 4), (None, None, None, None, None)],
                                    "doc_id bigint, text string, lang string, source string, n_chars bigint")
    out = sorted((tuple(r) for r in corpus_pipeline.personal_data(spark, private, "").collect()), key=str)
    assert out == [(1, "x [EMAIL] y", "en", "s", 11), (2, "none", "en", "s", 4), (None, None, None, None, None)]
    assert not brute_pii.spans(out[0][1])
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


@pytest.mark.parametrize("small", [True, False])
def test_decontamination_of_rows_without_or_with_repeated_id(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(scale, "is_small", lambda df: False)
    dirty = "one two three four five six seven eight nine ten"
    data = [(None, f"x {dirty} y"), (None, "clean"), (1, f"{dirty} z"), (1, "clean too"), (1, None), (2, dirty), (3, "other")]
    spark.createDataFrame([(1, dirty)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = corpus_pipeline.decontaminate(spark, spark.createDataFrame(data, "doc_id bigint, text string"), str(tmp_path))
    assert sorted(map(tuple, left.collect()), key=str) == sorted([data[1], data[3], data[4], data[6]], key=str)


def test_pipeline(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert ids <= {r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()}
    assert out.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 1024").count() == 0
