"""Ranked lexical search by an inverted index with block maxima.

``build`` cuts the documents into shards of bounded size and writes, for every term of a shard, its postings in compressed blocks.  A block
carries the best (occurrences, document length) pairs in it, so the largest score of the block is known for any corpus statistics without
unpacking it.  ``search`` answers queries shard by shard with MaxScore: lists whose summed bounds stay below the tenth best score are not
essential, documents come from the essential lists alone, and the block maxima of the other lists reject most of them before a block is
unpacked.  The ten best of each shard are merged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from signalpost.llm.common import PLAIN_WORD, cut_words, stored

SHARD_BYTES, BLOCK = 8 << 20, 128
LAST = np.iinfo(np.int64).max


@dataclass
class Index:
    """``blocks``: one row per block of postings; ``documents``: one row per document with its length in terms; both by shard."""

    blocks: DataFrame
    documents: DataFrame


def _packed(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in groups of seven bits, low group first, and where each number starts."""
    width = np.ones(len(numbers), dtype=np.int64)
    for k in range(1, 5):
        width += numbers >= 1 << (7 * k)
    begin = np.r_[0, np.cumsum(width)]
    out = np.zeros(begin[-1], dtype=np.uint8)
    for k in range(5):
        has = width > k
        more = np.where(width[has] > k + 1, 128, 0)
        out[begin[:-1][has] + k] = (numbers[has] >> (7 * k)) & 127 | more
    return out, begin


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(raw < 128)
    begin = np.r_[0, ends[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(begin, ends - begin + 1)
    return np.add.reduceat((raw & 127).astype(np.int64) << (7 * place), begin)


def _shard_rows(shard: int, texts: pa.Array) -> tuple[pa.RecordBatch | None, np.ndarray]:
    """Blocks of all terms of some texts, if they have any, and the length of each text in terms."""
    words = cut_words(texts, PLAIN_WORD)
    lengths = np.diff(words.first)
    if not len(words.start):
        return None, lengths
    hashes = words.hashes()
    order = np.lexsort((words.text, hashes))
    term, doc = hashes[order], words.text[order]
    edge = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (doc[1:] != doc[:-1])])
    tf = np.diff(np.r_[edge, len(term)])
    sample, term, doc = order[edge], term[edge], doc[edge].astype(np.int64)  # one row per posting from here on
    heads = np.flatnonzero(np.r_[True, term[1:] != term[:-1]])
    inside = np.arange(len(term)) - np.repeat(heads, np.diff(np.r_[heads, len(term)]))
    block_edge = np.flatnonzero(inside % BLOCK == 0)
    block = np.repeat(np.arange(len(block_edge)), np.diff(np.r_[block_edge, len(term)]))
    gap = doc - np.where(inside % BLOCK == 0, 0, np.r_[0, doc[:-1]])
    data, begin = _packed(np.c_[gap, tf].ravel())
    starts = begin[::2][np.r_[block_edge, len(term)]]
    # Best pairs of a block: sorted by falling occurrences, a pair stays if its document is shorter than all before it.
    n = lengths[doc].astype(np.int64)
    best = np.lexsort((n, -tf, block))
    coded = n[best] - (block[best] << 31)  # later blocks are lower, so the running minimum starts anew with each
    best = best[np.r_[True, coded[1:] < np.minimum.accumulate(coded)[:-1]]]
    pairs = np.r_[0, np.cumsum(np.bincount(block[best], minlength=len(block_edge)))].astype(np.int32)
    last = np.r_[block_edge[1:], len(term)] - 1
    names = [bytes(words.data[words.start[w]:words.end[w]]) for w in sample[heads]]
    term_of_block = np.searchsorted(heads, block_edge, side="right") - 1
    text = pa.array(names, pa.binary()).cast(pa.string()).take(pa.array(term_of_block))
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(len(block_edge), shard)), text, pa.array(doc[block_edge].astype(np.int32)), pa.array(doc[last].astype(np.int32)),
        pa.array((last - block_edge + 1).astype(np.int32)),
        pa.ListArray.from_arrays(pa.array(pairs), pa.array(tf[best].astype(np.int64))), pa.ListArray.from_arrays(pa.array(pairs), pa.array(n[best])),
        pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(block_edge), [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())],
        names=["shard", "term", "first", "last", "count", "best_tf", "best_n", "postings"]), lengths


def _shards(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[pa.Array, pa.Array]]:
    """Runs of rows whose texts have about ``most`` bytes, one row at least; keys and texts."""
    keys, texts, size = [], [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("_text")), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most - size, side="right")))
            keys.append(batch.column("_id").slice(at, to - at))
            texts.append(pc.cast(batch.column("_text").slice(at, to - at), pa.large_string()))
            size += int(ends[to - 1]) - before
            at = to
            if size >= most or (at < batch.num_rows and size + sizes[at] > most):
                yield pa.concat_arrays(keys), pa.concat_arrays(texts)
                keys, texts, size = [], [], 0
    if keys:
        yield pa.concat_arrays(keys), pa.concat_arrays(texts)


def build(docs: DataFrame, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> Index:
    """Index of all whole texts.

    Terms are runs of ASCII letters (A-Z lower-cased), digits and everything outside ASCII; terms of a shard are told apart by 64-bit hashes.
    A shard holds about ``shard_bytes`` of text, one document at least, so it fits a task whatever the texts are; it is part of one input partition and
    nothing is shuffled.  Null or empty texts have no terms.  Every row is a document of its own, also with a null or repeated key.
    Other columns are not read.
    """
    kind = dict(docs.select(F.col(key).alias("_id")).dtypes)["_id"]
    key_type = pa.string() if kind == "string" else pa.int64()
    kind = "string" if kind == "string" else "bigint"

    def index(batches):
        task = TaskContext.get().partitionId()
        for number, (keys, texts) in enumerate(_shards(batches, shard_bytes)):
            shard = (task << 32) + number
            blocks, lengths = _shard_rows(shard, texts)
            count = len(keys)
            # Rows of documents have no term, rows of blocks no place.
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(count, shard)), pa.nulls(count, pa.string()), pa.nulls(count, pa.int32()), pa.nulls(count, pa.int32()), pa.nulls(count, pa.int32()),
                 pa.nulls(count, pa.list_(pa.int64())), pa.nulls(count, pa.list_(pa.int64())), pa.nulls(count, pa.binary()),
                 pa.array(np.arange(count, dtype=np.int32)), pa.array(lengths.astype(np.int64)), keys.cast(key_type)], names=NAMES)
            for at in range(0, blocks.num_rows if blocks is not None else 0, 10_000):
                piece = blocks.slice(at, 10_000)
                yield pa.RecordBatch.from_arrays([*piece.columns, pa.nulls(piece.num_rows, pa.int32()), pa.nulls(piece.num_rows, pa.int64()),
                                                  pa.nulls(piece.num_rows, key_type)], names=NAMES)

    both = stored(docs.select(F.col(key).cast(kind).alias("_id"), F.col(text).alias("_text")).mapInArrow(
        index, "shard bigint, term string, first int, last int, count int, best_tf array<bigint>, best_n array<bigint>, postings binary, "
               f"place int, n bigint, id {kind}"), "index")
    return Index(both.filter("term IS NOT NULL").drop("place", "n", "id"), both.filter("place IS NOT NULL").select("shard", "place", "n", "id"))


# Columns of the stored index.
NAMES = ["shard", "term", "first", "last", "count", "best_tf", "best_n", "postings", "place", "n", "id"]


def query_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """Distinct terms of each query; rows with the same key are one query."""
    def cut(batches):
        for batch in batches:
            words = cut_words(batch.column("_text"), PLAIN_WORD)
            names = [bytes(words.data[a:b]) for a, b in zip(words.start, words.end)]
            yield pa.RecordBatch.from_arrays([batch.column("_id").take(pa.array(words.text)), pa.array(names, pa.binary()).cast(pa.string())], names=["item", "term"])

    plain = queries.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
    return plain.mapInArrow(cut, f"item {dict(plain.dtypes)['_id']}, term string").distinct()


class _List:
    """Postings of one term in one shard: bounds of its blocks, and blocks unpacked when they are first needed."""

    def __init__(self, weight: int, first, last, bounds, postings, share):
        self.weight, self.first, self.last = weight, first, last
        self.bounds = bounds  # largest share of each block
        self.most = int(bounds.max()) * weight
        self.postings, self.share, self.open = postings, share, {}

    def block(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block, and their shares of the weight."""
        if number not in self.open:
            both = _unpacked(self.postings[number])
            docs = np.cumsum(both[::2])
            self.open[number] = docs, self.share(both[1::2], docs)
        return self.open[number]

    def between(self, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Documents from ``low`` to below ``high``, block by block."""
        for number in range(int(np.searchsorted(self.last, low)), int(np.searchsorted(self.first, high))):
            docs, shares = self.block(number)
            a, b = np.searchsorted(docs, [low, high])
            yield docs[a:b], shares[a:b] * self.weight

    def block_of(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the block that may hold each document, and its bound; the bound is 0 where no block does."""
        number = np.minimum(np.searchsorted(self.last, docs), len(self.last) - 1)
        held = (self.first[number] <= docs) & (docs <= self.last[number])
        return number, np.where(held, self.bounds[number] * self.weight, 0)

    def scores(self, docs: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """Scores of documents (rising) within their blocks."""
        out = np.zeros(len(docs), dtype=np.int64)
        cuts = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True])
        for a, b in zip(cuts[:-1], cuts[1:]):
            held, shares = self.block(int(numbers[a]))
            at = np.minimum(np.searchsorted(held, docs[a:b]), len(held) - 1)
            out[a:b] = np.where(held[at] == docs[a:b], shares[at] * self.weight, 0)
        return out


def best_documents(lists: list[_List], count: int, rank: np.ndarray, k: int, window: int = 2048, seen: dict | None = None) -> list[tuple[int, int]]:
    """The ``k`` documents with the largest sums over the lists, as (score, place); equal scores by rising ``rank``.

    A document can still enter the heap while its bound is not below the k-th score, so ties are never lost.
    """
    lists = sorted(lists, key=lambda x: x.most)
    upto = np.cumsum([x.most for x in lists])
    heap: list[tuple[int, int, int]] = []  # (-score, rank, place), sorted
    for low in range(0, count, window):
        least = -heap[-1][0] if len(heap) == k else 1
        split = int(np.searchsorted(upto, least))  # lists before it cannot reach the k-th score together
        if split == len(lists):
            break
        sums = np.zeros(window, dtype=np.int64)
        for x in lists[split:]:
            for docs, scores in x.between(low, low + window):
                sums[docs - low] += scores
        docs = np.flatnonzero(sums)
        sums, docs = sums[docs], docs + low
        if split:
            keep = sums + upto[split - 1] >= least
            docs, sums = docs[keep], sums[keep]
        if split and len(docs):
            numbers, bounds = zip(*[x.block_of(docs) for x in lists[:split]])
            rest = np.cumsum(bounds, axis=0)
            for at in range(split - 1, -1, -1):
                keep = sums + rest[at] >= least
                if seen is not None:
                    seen["rejected"] = seen.get("rejected", 0) + int((~keep).sum())
                docs, sums, rest = docs[keep], sums[keep], rest[:, keep]
                numbers = [x[keep] for x in numbers]
                if not len(docs):
                    break
                own = rest[at] - (rest[at - 1] if at else 0) > 0
                if own.any():
                    sums[own] += lists[at].scores(docs[own], numbers[at][own])
        keep = sums >= least
        docs, sums = docs[keep], sums[keep]
        if len(docs):
            first = np.lexsort((rank[docs], -sums))[:k]
            heap = sorted(heap + [(-int(sums[i]), int(rank[docs[i]]), int(docs[i])) for i in first])[:k]
    if seen is not None:
        seen["unpacked"] = seen.get("unpacked", 0) + sum(len(x.open) for x in lists)
        seen["blocks"] = seen.get("blocks", 0) + sum(len(x.last) for x in lists)
    return [(-s, doc) for s, _, doc in heap]


def _share(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """Part of a term's weight that a document gets, in billionths of 1000: rises with occurrences, falls with length."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // terms))


def search(index: Index, queries: DataFrame, key: str = "item_id", text: str = "text", k: int = 10, query_block: int = 2000) -> DataFrame:
    """The ``k`` best documents of each query: key, rank, doc_id, score.

    All numbers are whole but the logarithm of a weight.  Queries are answered ``query_block`` at a time, and only their terms and weights are sent to all
    tasks.  Per shard a task holds the blocks of these terms and the lengths of the documents.  Queries without a known term, null or
    empty ones, give no rows; rows with the same key are one query; terms that stand in every document may weigh nothing.  Equal scores are
    ranked by rising document key, null last.
    """
    terms = stored(query_terms(queries, key, text), "query_terms")
    stats = index.documents.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("terms")).first()
    kinds = dict(terms.dtypes) | dict(index.documents.dtypes)
    schema = f"number bigint, id {kinds['id']}, score bigint"
    keys = terms.select("item").distinct().withColumn("number", F.row_number().over(Window.orderBy("item")).cast("bigint"))
    keys = stored(keys, "query_numbers")
    count = keys.count()
    documents, total = stats["documents"], stats["terms"] or 0
    found = None
    for low in range(0, count if total else 0, query_block):
        part = terms.join(F.broadcast(keys.filter(F.col("number").between(low + 1, low + query_block))),
                          terms["item"].eqNullSafe(keys["item"])).select("number", "term")
        answers = _answers(index, part, documents, total, k, schema)
        found = answers if found is None else found.unionByName(answers)
    if found is None:
        found = queries.sparkSession.createDataFrame([], schema)
    place = Window.partitionBy("number").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(keys), "number").select(F.col("item").alias(key), "rank", F.col("id").alias("doc_id"), "score")


def _answers(index: Index, terms: DataFrame, documents: int, total: int, k: int, schema: str) -> DataFrame:
    """Best documents of each shard for one block of queries, whose number of terms bounds what is sent."""
    asked = stored(terms, "asked")
    wanted = F.broadcast(asked.select("term").distinct())
    blocks = stored(index.blocks.join(wanted, "term"), "asked_blocks")
    df = blocks.groupBy("term").agg(F.sum("count").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * documents + 2).cast("double") / (2 * F.col("df") + 1).cast("double"))).cast("bigint")
    weights = df.select("term", weight.alias("weight")).filter("weight > 0")
    lookup: dict[int, list[tuple[str, int]]] = {}
    for r in asked.join(weights, "term").collect():  # terms of one block of queries
        lookup.setdefault(r["number"], []).append((r["term"], r["weight"]))
    shared = asked.sparkSession.sparkContext.broadcast(lookup)
    text_key = "string" in schema

    def answer(held: pa.Table, lengths: pa.Table) -> pa.Table:
        order = np.argsort(lengths["place"].to_numpy())
        n = lengths["n"].to_numpy()[order]
        ids = lengths["id"].combine_chunks().take(pa.array(order))
        by_id = pc.sort_indices(ids, null_placement="at_end").to_numpy()
        rank = np.empty(len(n), dtype=np.int64)
        rank[by_id] = np.arange(len(n))
        lists = _lists(held, n, documents, total)
        out = ([], [], [])
        for number, wanted_terms in shared.value.items():
            own = [lists[t].weighed(w) for t, w in wanted_terms if t in lists]
            for score, place in best_documents(own, len(n), rank, k) if own else []:
                out[0].append(number), out[1].append(place), out[2].append(score)
        return pa.table([pa.array(out[0], pa.int64()), ids.take(pa.array(out[1], pa.int64())).cast(pa.string() if text_key else pa.int64()), pa.array(out[2], pa.int64())],
                        names=["number", "id", "score"])

    return stored(blocks.groupBy("shard").cogroup(index.documents.groupBy("shard")).applyInArrow(answer, schema), "answers")


class _Postings:
    """Blocks of one term; lists of several queries share what is unpacked."""

    def __init__(self, first, last, bounds, postings, share):
        self.parts, self.open = (first, last, bounds, postings, share), {}

    def weighed(self, weight: int) -> _List:
        out = _List(weight, *self.parts)
        out.open = self.open
        return out


def _lists(held: pa.Table, n: np.ndarray, documents: int, total: int) -> dict[str, _Postings]:
    """Postings of all terms of a shard, with the bounds of their blocks."""
    if not held.num_rows:
        return {}
    held = held.sort_by([("term", "ascending"), ("first", "ascending")]).combine_chunks()
    columns = {name: held[name].combine_chunks() for name in held.column_names}
    tf, length = columns["best_tf"].flatten().to_numpy(), columns["best_n"].flatten().to_numpy()
    sizes = pc.list_value_length(columns["best_tf"]).to_numpy()
    bounds = np.maximum.reduceat(_share(tf, length, documents, total), np.r_[0, np.cumsum(sizes)[:-1]])
    first, last = columns["first"].to_numpy(), columns["last"].to_numpy()
    names = columns["term"].to_pylist()
    cuts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]] + [len(names)]
    postings = columns["postings"]

    def share(tf, docs):
        return _share(tf, n[docs], documents, total)

    return {names[a]: _Postings(first[a:b], last[a:b], bounds[a:b], postings[a:b].to_pylist(), share) for a, b in zip(cuts[:-1], cuts[1:])}
