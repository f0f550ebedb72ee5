"""Near-duplicate detection by circulant MinHash.

Two permutations of a universe of cells are fixed.  The first scatters the cells of a document's shingles; the
second, read at one cell and the cells after it, gives the values of all signature coordinates, so that coordinate
k uses the second permutation shifted by k.  Coordinates are cut into bands; documents that share a band are
candidates, and every link is confirmed on the full sets.

Work is done on classes of equal sets.  Within a bucket all members are compared with one leader.  Where members are still in different
components afterwards, the largest component stays in place, in blocks of bounded size, and only members of the others are sent to its blocks;
then components are merged and the same is done with the others.  No pair is listed before it is confirmed and no group is held in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import BLANK_WORD, cut_words, mix, shingle_hashes, slices, stored
from signalpost.scale import measured_join

CELLS = 1 << 20
BANDS, ROWS = 32, 4
BLOCK = 256


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for part in slices(batches, "text"):
        words = cut_words(part.column("text"), BLANK_WORD)
        runs, first = shingle_hashes(words.hashes(), words.first, size)
        yield part, [np.unique(runs[a:b]) for a, b in zip(first[:-1], first[1:])]


def _key(values: np.ndarray) -> bytes | None:
    """128-bit name of a set; two sets have the same name only if they are equal, but for chance of 2^-64."""
    if not len(values):
        return None
    with np.errstate(over="ignore"):
        one = mix(values).sum(dtype=np.uint64)
        two = mix(values * np.uint64(0xD1B54A32D192ED03) + np.uint64(7)).sum(dtype=np.uint64)
    return int(one).to_bytes(8, "big") + int(two).to_bytes(8, "big")


def signatures(values: np.ndarray, scatter: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Circulant signature of one set: smallest value per coordinate over the set's cells."""
    cells = np.unique(scatter[(mix(values) >> np.uint64(44)).astype(np.int64)])
    out = windows[cells[:2048]].min(axis=0)
    for at in range(2048, len(cells), 2048):
        np.minimum(out, windows[cells[at:at + 2048]].min(axis=0), out=out)
    return out


def permutations(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(20240131))
    scatter, values = rng.permutation(CELLS).astype(np.int32), rng.permutation(CELLS).astype(np.int32)
    circle = np.concatenate([values, values[:coordinates]])
    return scatter, np.lib.stride_tricks.sliding_window_view(circle, coordinates)


def prints(docs: DataFrame, size: int) -> DataFrame:
    """Per document: number of shingles, name of its set, and the hash of each band (null without words)."""
    def run(batches):
        scatter, windows = permutations(BANDS * ROWS)
        for part, sets in _sets(batches, size):
            bands = []
            for values in sets:
                if not len(values):
                    bands.append(None)
                    continue
                rows = signatures(values, scatter, windows).reshape(BANDS, ROWS).astype(np.uint64)
                with np.errstate(over="ignore"):
                    h = np.arange(BANDS, dtype=np.uint64)
                    for k in range(ROWS):
                        h = mix(h * np.uint64(0xD1B54A32D192ED03) ^ rows[:, k])
                bands.append(h.astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(v) for v in sets], pa.int64()), pa.array([_key(v) for v in sets], pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], ["id", "n", "node", "bands"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n bigint, node binary, bands array<bigint>")


def _full_sets(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(node, values) of the given classes, made again from the text of one document of each."""
    def run(batches):
        for part, sets in _sets(batches, size):
            keep = [i for i, v in enumerate(sets) if _key(v) == part.column("node")[i].as_py()]
            yield pa.RecordBatch.from_arrays(
                [part.column("node").take(pa.array(keep, pa.int64())), pa.array([sets[i].astype(np.int64) for i in keep], pa.list_(pa.int64()))],
                ["node", "values"])

    texts = measured_join(docs, nodes.select("id", "node"), ["id"], F.col("id")).select("node", "text")
    return stored(texts.mapInArrow(run, "node binary, values array<bigint>"), "sets")


def close(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the Jaccard similarity of two sorted sets is ``percent`` or more, in whole numbers."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def _confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full sets are close."""
    def run(batches):
        for batch in batches:
            rows = zip(batch.column("va"), batch.column("vb"))
            same = [close(x.values.to_numpy(), y.values.to_numpy(), percent) for x, y in rows]
            yield batch.select(["a", "b"]).filter(pa.array(same, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("values").alias("va"))
    right = sets.select(F.col("node").alias("b"), F.col("values").alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb").mapInArrow(run, "a binary, b binary")


def _confirm_blocks(grouped: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of one group (bucket, low, high) that lie in different components, one per pair of components and group.

    If the members of a group have two values of ``block``, only pairs of different blocks are compared.  Members that an earlier
    link of the group has joined are not compared again.
    """
    def run(table: pa.Table) -> pa.Table:
        nodes, comps = table.column("node").to_pylist(), table.column("comp").to_pylist()
        blocks = table.column("block").to_pylist()
        values = [v.values.to_numpy() for chunk in table.column("values").chunks for v in chunk]
        top = {c: c for c in comps}

        def find(c):
            while top[c] != c:
                top[c] = top[top[c]]
                c = top[c]
            return c

        out, crossed = [], len(set(blocks)) == 2
        order = sorted(range(len(nodes)), key=lambda i: len(values[i]))
        for k, i in enumerate(order):
            for j in order[k + 1:]:
                if 100 * len(values[i]) < percent * len(values[j]):
                    break
                if crossed and blocks[i] == blocks[j]:
                    continue
                a, b = find(comps[i]), find(comps[j])
                if a != b and close(values[i], values[j], percent):
                    top[a] = b
                    out.append((nodes[i], nodes[j]))
        return pa.table({"a": pa.array([x for x, _ in out], pa.binary()), "b": pa.array([y for _, y in out], pa.binary())})

    rows = grouped.join(sets, "node").select("bucket", "low", "high", "node", "comp", "block", "values")
    return rows.groupBy("bucket", "low", "high").applyInArrow(run, "a binary, b binary")


def _grouped(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups in which members (bucket, node, comp) of mixed buckets meet, and the members that have to be looked at again afterwards.

    A bucket of at most ``BLOCK`` members is one group.  In a larger one whose largest component has half of the members or more, that component is
    dealt into blocks, each member into one, and the others are copied to each of these blocks; the others have then to meet among themselves.  Without such
    a component, each pair of blocks is a group.
    """
    sizes = members.groupBy("bucket", "comp").agg(F.count("*").alias("size"))
    shape = sizes.groupBy("bucket").agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("members"), F.count("*").alias("kinds"))
    rows = stored(members.join(shape.filter("kinds > 1"), "bucket"), "mixed")
    one = rows.filter(F.col("members") <= BLOCK).select("bucket", "node", "comp", F.lit(0).alias("block"), F.lit(0).alias("low"), F.lit(0).alias("high"))
    large = rows.filter(F.col("members") > BLOCK)
    led = large.filter(F.col("top.size") * 2 >= F.col("members")).withColumn("blocks", F.ceil(F.col("top.size") / F.lit(BLOCK)).cast("int"))
    own = led.filter(F.col("comp") == F.col("top.comp")).select(
        "bucket", "node", "comp", F.lit(0).alias("block"), F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("low"), F.lit(-1).alias("high"))
    others = led.filter(F.col("comp") != F.col("top.comp"))
    sent = others.select("bucket", "node", "comp", F.lit(1).alias("block"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("low"), F.lit(-1).alias("high"))
    count = F.ceil(F.col("members") / F.lit(BLOCK)).cast("int")
    even = large.filter(F.col("top.size") * 2 < F.col("members")).withColumn("block", F.pmod(F.xxhash64("node"), count).cast("int"))
    even = even.withColumn("other", F.explode(F.sequence(F.lit(0), count - 1)))
    even = even.select("bucket", "node", "comp", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    return one.union(own).union(sent).union(even), others.select("bucket", "node")


def components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """(node, comp): the smallest node that each node of an undirected graph reaches.

    Alternates large stars and small stars until every node points at the centre of a star.  Sums are
    combined before the shuffle and hot centres are split by the skew join.
    """
    def star(table: DataFrame, large: bool) -> DataFrame:
        both = table.select("u", "v").union(table.select(F.col("v"), F.col("u"))) if large else table
        centre = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        rows = both.join(centre, "u")
        if large:
            return rows.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        return rows.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))

    def tidy(table: DataFrame) -> DataFrame:
        return table.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = stored(tidy(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))), purpose)
    mark = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
    while True:
        now = stored(tidy(star(tidy(star(now, True)), False)), purpose)
        after = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if after == mark:
            break
        mark = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("comp")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``df``: ``key``, ``n_shingles``, ``component_id`` (smallest key reachable) and ``kept``.

    Words are runs of bytes other than ASCII white space, with A-Z lower-cased; a set holds the distinct runs of
    ``size`` words.  Two documents are linked if 100 * common >= ``percent`` * united.  Candidates come from 32
    bands of 4 coordinates: a pair at 0.8 shares none with probability 5e-8.

    Null or empty texts have an empty set and are linked with nothing.  Repeated rows are copies of each other: each
    gets the row of its text, so rows that repeat a key and text are kept or left together.  A null key is never
    kept and never names a component while another key is there; a text that only null keys have is linked
    with its copies alone.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    marked = stored(prints(docs, size), "prints")
    classes = stored(marked.filter("n > 0").groupBy("node").agg(
        F.min("id").alias("id"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")

    in_band = classes.select("node", "n", F.explode("bands").alias("bucket"))
    buckets = stored(in_band.groupBy("bucket").agg(
        F.count("*").alias("members"), F.min(F.struct("node", "n")).alias("leader")).filter("members > 1"), "buckets")
    members = stored(in_band.join(buckets, "bucket"), "members")
    fits = F.lit(100) * F.least("n", "leader.n") >= F.lit(percent) * F.greatest("n", "leader.n")
    pairs = stored(members.filter(fits & (F.col("node") != F.col("leader.node")))
                   .select(F.col("node").alias("a"), F.col("leader.node").alias("b")).distinct(), "pairs")
    larger = members.filter("members > 2").select("node").distinct()
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(larger).distinct()
    named = classes.filter(F.col("id").isNotNull()).select("node", "id")
    sets = _full_sets(docs, named.join(wanted, "node", "left_semi"), size)
    edges = stored(_confirm(pairs, sets, percent), "edges")
    found = stored(components(edges), "found")

    left = members.filter("members > 2").select("bucket", "node")
    while True:  # what is left of a bucket halves each time
        labelled = left.join(found, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
        grouped, left = _grouped(labelled)
        more = stored(_confirm_blocks(grouped, sets, percent), "more")
        if not more.isEmpty():
            edges = edges.union(more)
            found = stored(components(edges), "found")
        if left.isEmpty():
            break

    names = classes.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    least = names.groupBy("comp").agg(F.min("id").alias("component_id"), F.count("*").alias("parts"))
    # Only classes with several documents or a link need a lookup; all other documents are their own component.
    named = stored(names.join(least, "comp").filter("copies > 1 or parts > 1").select("node", "component_id"), "names")
    out = marked.join(named, "node", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("component_id").isNotNull(), F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
