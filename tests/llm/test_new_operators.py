"""Whitening, ranked search and mixing against plain versions."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalpost.llm import mixing, ranked, whitening

# --- whitening


def plain_whitening(vectors):
    x = np.array([[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors], dtype=object)
    n = len(x)
    total = x.sum(axis=0)
    centred = np.array([[float(n * v - s) / n for v, s in zip(row, total)] for row in x])
    values, turned = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, total)) for row in x]
    return n, deviation, centred, values[::-1], turned[:, ::-1]


def test_whitening_equals_a_plain_one(spark):
    local = np.random.default_rng(5)
    points = (local.normal(size=(300, 12)) * local.uniform(0.2, 4, 12)).astype(np.float32)
    points[100:200] = points[100]  # a third of all rows are the same
    data = [(None if i == 7 else i, [float(c) for c in p], 0, "x") for i, p in enumerate(points)] + [(100, [float(c) for c in points[100]], 0, "x")]
    odd = [(900, None, 0, ""), (901, [1.0] * 11 + [None], 0, ""), (902, [1.0] * 11 + [float("nan")], 0, ""), (903, [float("inf")] * 12, 0, ""),
           (904, [1.0] * 5, 0, ""), (905, [], 0, ""), (906, [1e300] * 12, 0, "")]
    frame = spark.createDataFrame(data + odd, "vec_id bigint, embedding array<double>, component int, n string").repartition(5)
    got = whitening.whiten(frame).collect()
    n, deviation, centred, values, turned = plain_whitening([d[1] for d in data])
    assert len(got) == n * 12 and {r["n"] for r in got} == {n}
    by_row = {}
    for r in got:
        by_row.setdefault(r["vec_id"], {}).setdefault(r["component"], []).append(r)
    assert set(by_row) == {d[0] for d in data} and len(by_row[100][1]) == 2
    signs = {}
    for at, (key, *_) in enumerate(data):
        for component, rows in by_row[key].items():
            want = centred[at] @ turned[:, component - 1] / math.sqrt(values[component - 1])
            for r in rows:
                assert r["deviation"] == deviation[at]
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-8
                if abs(want) > 1e-3:
                    assert signs.setdefault(component, r["whitened"] * want > 0) == (r["whitened"] * want > 0)
                assert abs(r["explained"] - values[component - 1] / values.sum()) < 1e-10
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_has_no_component_without_spread(spark):
    schema = "vec_id bigint, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.5, 2.0]) for i in range(5)], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i, -1.0 * i]) for i in range(9)], schema)).collect()
    assert len(line) == 9 and all(r["component"] == 1 and abs(r["explained"] - 1) < 1e-12 for r in line)


def test_deviation_is_exact_or_null(spark):
    data = [(0, [1e13, 1.0]), (1, [2.0, 3.0]), (2, [-5e9, 0.5]), (3, [7.0, 0.25])]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whiten(spark.createDataFrame(data, "vec_id bigint, embedding array<double>")).collect()}
    _, want, *_ = plain_whitening([d[1] for d in data])
    assert got == {i: (w if w < 1 << 63 else None) for i, w in enumerate(want)}


@pytest.mark.parametrize("size", [1, 2, 7, 24])
def test_factor_and_rotations(size):
    local = np.random.default_rng(size)
    a = local.normal(size=(size + 3, size)) * 10.0 ** local.uniform(-2, 2, size)
    scatter = a.T @ a
    factor = whitening.pivoted_cholesky(scatter)
    assert np.allclose(factor @ factor.T, scatter, rtol=1e-12, atol=1e-12 * scatter.max())
    values, vectors = whitening.jacobi(factor)
    assert np.allclose(values, np.linalg.eigvalsh(scatter)[::-1], rtol=1e-9)
    assert np.allclose(vectors.T @ vectors, np.eye(size), atol=1e-10)


# --- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return [t.translate(UPPER) for t in TERM.findall(text or "")]


def plain_search(docs, items):
    cut = [(i, terms_of(t)) for i, t in docs]
    documents, total = sum(1 for _, t in cut if t), sum(len(t) for _, t in cut)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms_of(text))
    out = set()
    for item, terms in wanted.items():
        df = {t: sum(1 for _, d in cut if t in d) for t in terms}
        found = []
        for key, words in cut:
            score = 0
            for t in terms & set(words):
                w = math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1)))
                tf = words.count(t)
                score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * len(words) * documents) // total)))
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(found)[:10], 1):
            out.add((item, rank, key, -score))
    return out


def search_rows():
    local = np.random.default_rng(11)
    names = [f"w{i}" for i in range(60)] + ["straße", "Ünder", "ABC", "x1"]
    odds = 1 / np.arange(1, len(names) + 1)

    def text(size):
        return " ".join(local.choice(names, size, p=odds / odds.sum()))

    docs = [(i, text(int(local.integers(0, 60)))) for i in range(700)]
    docs += [(1000 + i, "w7, w50; W51 w52!") for i in range(150)]  # copies with equal scores
    docs += [(2000, text(20_000)), (2001, None), (2002, ""), (2003, "  \n.,"), (None, "w50 w51 w52 w7"), (3, "w50 w51")]
    items = [(k, text(12)) for k in range(15)] + [(50, "w50 w51 w52"), (51, None), (52, "unheard of"), (None, "STRASSE straße ünder"), (53, "abc abc w60"), (53, "w59")]
    return docs, items


def test_search_equals_scoring_every_document(spark):
    docs, items = search_rows()
    frame = spark.createDataFrame([(i, t, "w50", i) for i, t in docs], "doc_id bigint, text string, term string, shard bigint").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, rank int")
    want = plain_search(docs, items)
    for shard_bytes in (2000, 1 << 20):
        index = ranked.build(frame, shard_bytes=shard_bytes)
        got = [tuple(r) for r in ranked.search(index, asked, query_block=7).select("item_id", "rank", "doc_id", "score").collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert index.documents.count() == len(docs)


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    none = docs.filter("doc_id > 5")
    assert ranked.search(ranked.build(none), items).count() == 0
    assert ranked.search(ranked.build(spark.createDataFrame([(1, None)], docs.schema)), items).count() == 0
    assert ranked.search(ranked.build(docs), items.limit(0)).count() == 0
    assert [r["doc_id"] for r in ranked.search(ranked.build(docs), items).collect()] == [1]
    named = spark.createDataFrame([("p", "a b"), (None, "a")], "doc_id string, text string")
    assert [r["doc_id"] for r in ranked.search(ranked.build(named), items).orderBy("rank").collect()] in ([None, "p"], ["p", None], [])


def test_block_maxima_leave_blocks_packed():
    local = np.random.default_rng(2)
    texts = [" ".join(["common"] * int(local.integers(1, 4)) + [f"f{j}" for j in range(int(local.integers(3, 40)))]) for _ in range(6000)]
    for at in range(0, 6000, 400):
        texts[at] = "rare rare " + texts[at]
    import pyarrow as pa

    batch, lengths = ranked._shard_rows(0, pa.array(texts))
    held = pa.Table.from_batches([batch])
    lists = ranked._lists(held, lengths.astype(np.int64), len(texts), int(lengths.sum()))
    seen = {}
    best = ranked.best_documents([lists["rare"].weighed(6000), lists["common"].weighed(3), lists["f2"].weighed(2)], len(texts), np.arange(len(texts)), 10, seen=seen)
    scores = []
    for place, text in enumerate(texts):
        words = text.split()
        share = {t: int(ranked._share(np.int64(words.count(t)), np.int64(len(words)), len(texts), int(lengths.sum()))) for t in ("rare", "common", "f2")}
        scores.append((-sum(w * share[t] for t, w in (("rare", 6000), ("common", 3), ("f2", 2))), place))
    assert best == [(-s, p) for s, p in sorted(scores)[:10]]
    assert seen["unpacked"] < seen["blocks"] and seen["rejected"] > 0


def test_packed_numbers():
    numbers = np.array([0, 1, 127, 128, 16383, 16384, 2097151, 2097152, 2**31 - 1])
    data, begin = ranked._packed(numbers)
    assert ranked._unpacked(data.tobytes()).tolist() == numbers.tolist() and begin[-1] == len(data)


# --- mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    out, left, open_names = {}, sum(sizes.values()), set(names)
    while open_names:
        level = left / sum(weight[s] for s in open_names)
        above = {s for s in open_names if level * weight[s] > 3 * sizes[s]}
        if not above:
            return out | {s: level * weight[s] for s in open_names}
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= 3 * sizes[s]
        open_names -= above
    return out


def mixing_rows():
    local = np.random.default_rng(4)
    rows, key = [], 0
    for source, count, widest in (("hot", 2000, 30), ("Z", 40, 200), ("a", 60, 9), (None, 30, 50), ("é", 3, 5), ("", 10, 20), ("empty", 4, 0)):
        for _ in range(count):
            rows.append((key, " ".join(["w"] * int(local.integers(0, widest + 1))), source))
            key += 1
    return rows + [(key, "word " * 5000, "Z"), (key + 1, None, "Z"), (None, "a b c", "hot"), (None, "a b c", "hot"), (5, "x y", "a"), (5, "x y", "a")]


def test_mix_meets_its_targets(spark):
    rows = mixing_rows()
    frame = spark.createDataFrame([(k, t, s, 1, "z") for k, t, s in rows], "doc_id bigint, text string, source string, size int, part string").repartition(6)
    mixed = mixing.mix(frame)
    got = mixed.collect()
    sizes, widest = {}, {}
    for _, text, source in rows:
        size = len(WORD.findall(text or ""))
        sizes[source] = sizes.get(source, 0) + size
        widest[source] = max(widest.get(source, 0), size)
    want = plain_targets(sizes)
    assert len(got) == len(rows) and abs(sum(want.values()) - sum(sizes.values())) < 1e-6
    by_size = {size: s for s, size in sizes.items()}
    assert len(by_size) == len(sizes)
    taken = {}
    for r in got:
        source = by_size[r["source_size"]]
        assert abs(r["target"] - want[source]) < 1e-6 and 0 <= r["copies"] <= 3
        if sizes[source]:
            step = min(want[source] / sizes[source], 3)
            assert math.floor(step - 1e-6) <= r["copies"] <= math.ceil(step + 1e-6)
        taken[source] = taken.get(source, 0) + r["copies"] * r["size"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(widest[source] / 2, 1), source
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(frame.repartition(2)).collect()), key=str)


def test_mix_of_nothing_and_of_empty_texts(spark):
    schema = "doc_id bigint, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema)).count() == 0
    got = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema)).collect()
    assert [(r["size"], r["source_size"], r["target"], r["copies"]) for r in got] == [(0, 0, 0.0, 0)] * 2


def test_copies_are_emitted(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), f"s{i % 2}", i) for i in range(100)], "doc_id bigint, text string, source string, copies int")
    mixed = mixing.mix(docs)
    out = mixing.copies_of(docs.drop("copies"), mixed)
    counts = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert counts == {r["doc_id"]: r["copies"] for r in mixed.filter(F.col("copies") > 0).collect()}
