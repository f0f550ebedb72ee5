"""Language model scores from a log-frequency Bloom filter.

Counts of words and word pairs are quantised to steps of a half or a third (1, 2, 3, 4, 6, 8, 12 ...); what has level q is put into the
filter q times, with its level.  A count is read back by asking for level 1, 2 and so on until the filter says no, so an error is small
and high counts cost few bits.  The filter has the same number of bits per entry at every size.  It is broadcast in parts of a bounded
size, each for a range of words with all pairs that end in them, and every part is asked in a reading of the texts of its own.  The logarithm
of a pair's probability is a difference of two terms, of which one depends on the pair and its last word and the other on its first word, so the
readings only have to be summed.  Exact counts for the base score come from a bounded broadcast table for frequent words, and for all
others that the filter holds from a join.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import BLANK_WORD, cut_words, mix, slices, stored

END, START = np.uint64(1), np.uint64(2)  # hashes of the end and the start of a text
KEEP = 1 << 20  # tokens counted at once in a task
HEAD = 1 << 18
BITS = 8.0  # bits of the filter per entry
BUCKET_KEYS = 500_000
CELL_BITS = 12
CELLS = 1 << CELL_BITS
STEPS = np.sort(np.r_[1, 2 ** np.arange(1, 48), 3 * 2 ** np.arange(47)])  # smallest count of level 1, 2, 3 ...
LEVELS = len(STEPS)
LEAST = np.r_[0, STEPS].astype(float)  # smallest and largest count of level 0, 1, 2 ...
MOST = np.r_[0, STEPS[1:] - 1, 2 * STEPS[-1]].astype(float)


def cell(words: np.ndarray) -> np.ndarray:
    """The part of all words that a word belongs to, from 0 to ``CELLS`` - 1."""
    return (mix(words) >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hashes of pairs; their highest bits are the cell of the word on the right."""
    with np.errstate(over="ignore"):
        low = mix(left * np.uint64(0xD1B54A32D192ED03) ^ right) >> np.uint64(CELL_BITS)
    return cell(right).astype(np.uint64) << np.uint64(64 - CELL_BITS) | low


def tokens(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts with their ends, the token before each, and where texts begin."""
    words = cut_words(part.column("text"), BLANK_WORD)
    count = np.diff(words.first)
    first = np.r_[0, np.cumsum(count + 1)]
    out = np.empty(first[-1], np.uint64)
    ends = np.zeros(first[-1], bool)
    ends[first[1:] - 1] = True
    out[~ends], out[ends] = words.hashes(), END
    before = np.empty_like(out)
    before[1:] = out[:-1]
    before[first[:-1]] = START
    return out, before, first


def level(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(STEPS, counts, side="right")


def count_ngrams(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of words (size 1) and pairs (size 2): rows (bucket, size, keys, counts) with packed arrays.

    Keys are counted where they are read, dealt into buckets by hash and summed per bucket.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[list] = [[], []]

        def flush() -> Iterator[pa.RecordBatch]:
            for order in (1, 2):
                if not kept[order - 1]:
                    continue
                keys, counts = np.unique(np.concatenate(kept[order - 1]), return_counts=True)
                kept[order - 1].clear()
                number = bucket_of(keys, buckets)
                order_of = np.argsort(number, kind="stable")
                number, keys, counts = number[order_of], keys[order_of], counts[order_of]
                cuts = np.flatnonzero(np.diff(number)) + 1
                starts, stops = np.r_[0, cuts], np.r_[cuts, len(keys)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[starts]), pa.array(np.full(len(starts), order, np.int32)),
                     pa.array([keys[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
                     pa.array([counts[a:b].astype("<i4").tobytes() for a, b in zip(starts, stops)], pa.binary())],
                    ["bucket", "size", "keys", "counts"])

        size = 0
        for part in slices(batches, "text"):
            now, before, _ = tokens(part)
            kept[0].append(now)
            kept[1].append(pair(before, now))
            size += len(now)
            if size > KEEP:
                yield from flush()
                size = 0
        yield from flush()

    def add(table: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_py(), np.uint64) for x in table.column("keys")])
        counts = np.concatenate([np.frombuffer(x.as_py(), "<i4") for x in table.column("counts")]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sums = np.add.reduceat(counts, first)
        return pa.table({"bucket": table.column("bucket")[:1], "size": table.column("size")[:1], "keys": pa.array([keys[first].tobytes()], pa.binary()),
                         "counts": pa.array([sums.tobytes()], pa.binary()), "different": pa.array([len(first)], pa.int64()),
                         "total": pa.array([int(sums.sum())], pa.int64())})

    parts = docs.mapInArrow(run, "bucket bigint, size int, keys binary, counts binary")
    summed = parts.groupBy("bucket", "size").applyInArrow(
        add, "bucket bigint, size int, keys binary, counts binary, different bigint, total bigint")
    return stored(summed, "counts")


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(keys) >> np.uint64(33)).astype(np.int64) * buckets >> 31


def place(keys: np.ndarray, q: int, probe: int, size: np.ndarray) -> np.ndarray:
    """Bit of a key at a level, by double hashing."""
    with np.errstate(over="ignore"):
        one = mix(keys + np.uint64(q) * np.uint64(0xA0761D6478BD642F))
        return ((one + np.uint64(probe) * (mix(one) | np.uint64(1))) % size.astype(np.uint64)).astype(np.int64)


@dataclass(frozen=True)
class Span:
    """A part of the filter: words of the cells from ``low`` to below ``high``, and piece ``piece`` of ``pieces`` of the pairs that end in them."""

    low: int = 0
    high: int = CELLS
    piece: int = 0
    pieces: int = 1

    def words(self, words: np.ndarray) -> np.ndarray:
        number = cell(words)
        return (number >= self.low) & (number < self.high)

    def pairs(self, pairs: np.ndarray) -> np.ndarray:
        number = (pairs >> np.uint64(64 - CELL_BITS)).astype(np.int64)
        inside = (number >= self.low) & (number < self.high)
        return inside if self.pieces == 1 else inside & (mix(pairs ^ np.uint64(self.pieces)) % np.uint64(self.pieces) == self.piece)


def spans(words: np.ndarray, pairs: np.ndarray, most: int) -> list[Span]:
    """Parts of at most about ``most`` entries each, from the entries of words and of pairs per cell.

    Cells in a row make a part; a cell with more entries than that (a very common word ends many different pairs) is cut by its
    pairs, and all of its words are in each piece.
    """
    out, low, held = [], 0, 0
    for at, (some, more) in enumerate(zip(words.tolist(), pairs.tolist())):
        if held and held + some + more > most:
            out.append(Span(low, at))
            low, held = at, 0
        if some + more > most:
            count = -(-more // max(1, most - some, most // 2))
            out += [Span(at, at + 1, piece, count) for piece in range(count)]
            low, held = at + 1, 0
        else:
            held += some + more
    return out + [Span(low, CELLS)] if low < CELLS or not out else out


@dataclass
class Filter:
    """Bits of all buckets one after the other, words and pairs apart; a key is looked for in the bits of its bucket."""

    buckets: int
    probes: int
    begin: np.ndarray  # first byte of bucket b and size s at 2 b + s - 1
    bits: np.ndarray  # its number of bits
    body: np.ndarray

    def levels(self, keys: np.ndarray, order: int) -> np.ndarray:
        """Quantised count of each key: how many levels in a row the filter says to hold."""
        part = 2 * bucket_of(keys, self.buckets) + order - 1
        size, begin = self.bits[part], self.begin[part] * 8
        out = np.zeros(len(keys), np.int64)
        live = np.flatnonzero(size > 0)
        for q in range(1, LEVELS + 1):
            for probe in range(self.probes):
                at = begin[live] + place(keys[live], q, probe, size[live])
                live = live[(self.body[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1]
            if not len(live):
                break
            out[live] = q
        return out


def probes_of(rate: float) -> int:
    return max(1, round(rate * 0.693))


def packed_bits(keys: np.ndarray, levels: np.ndarray, rate: float) -> tuple[int, np.ndarray]:
    """Number of bits of one bucket, and the bits in bytes, with ``rate`` bits for each level of each key."""
    size = max(8, int(levels.sum() * rate))
    bits = np.zeros(size, bool)
    for q in range(1, int(levels.max()) + 1):
        some = keys[levels >= q]
        for probe in range(probes_of(rate)):
            bits[place(some, q, probe, np.full(len(some), size))] = True
    return size, np.packbits(bits, bitorder="little")


def build_filter(counts: DataFrame, buckets: int, span: Span = Span(), bits_per_entry: float = BITS) -> Filter:
    """The part of the filter for a span, with ``bits_per_entry`` bits for each level of each key; the spans bound its size."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, sizes, bodies = [], [], []
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_py(), np.uint64)
                order = batch.column("size")[i].as_py()
                mine = span.words(keys) if order == 1 else span.pairs(keys)
                if not mine.any():
                    continue
                levels = level(np.frombuffer(batch.column("counts")[i].as_py(), np.int64)[mine])
                size, body = packed_bits(keys[mine], levels, bits_per_entry)
                parts.append(2 * batch.column("bucket")[i].as_py() + order - 1)
                sizes.append(size)
                bodies.append(body.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(bodies, pa.binary())], ["part", "bits", "body"])

    rows = counts.mapInArrow(fill, "part bigint, bits bigint, body binary").toArrow()  # bounded by the span
    order = np.argsort(rows.column("part").to_numpy())
    body = np.concatenate([np.frombuffer(rows.column("body")[int(i)].as_py(), np.uint8) for i in order] or [np.zeros(1, np.uint8)])
    begin, bits = np.zeros(2 * buckets, np.int64), np.zeros(2 * buckets, np.int64)
    at = rows.column("part").to_numpy()[order]
    bits[at] = rows.column("bits").to_numpy()[order]
    ends = np.cumsum((bits + 7) // 8)
    begin[1:] = ends[:-1]
    return Filter(buckets, probes_of(bits_per_entry), begin, bits, body)


def entries_per_cell(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Levels of words and of pairs, summed per cell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, CELLS), np.int64)
        for batch in batches:
            for size, keys, values in zip(batch.column("size").to_pylist(), batch.column("keys"), batch.column("counts")):
                keys = np.frombuffer(keys.as_py(), np.uint64)
                number = cell(keys) if size == 1 else (keys >> np.uint64(64 - CELL_BITS)).astype(np.int64)
                np.add.at(sums[size - 1], number, level(np.frombuffer(values.as_py(), np.int64)))
        size, number = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(size), pa.array(number), pa.array(sums[size, number])], ["size", "cell", "n"])

    out = np.zeros((2, CELLS), np.int64)
    rows = counts.select("size", "keys", "counts").mapInArrow(run, "size bigint, cell bigint, n bigint")
    for r in rows.groupBy("size", "cell").agg(F.sum("n").alias("n")).collect():  # at most 2 * CELLS rows
        out[r["size"], r["cell"]] = r["n"]
    return out[0], out[1]


def _unpacked(counts: DataFrame, least: int | None = None, below: int | None = None) -> DataFrame:
    """(key, count) of words with a level of at least ``least``, or below ``below``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                keys = np.frombuffer(batch.column("keys")[i].as_py(), np.int64)
                values = np.frombuffer(batch.column("counts")[i].as_py(), np.int64)
                keep = level(values) >= least if least is not None else level(values) < below
                yield pa.RecordBatch.from_arrays([pa.array(keys[keep]), pa.array(values[keep])], ["key", "count"])

    return counts.filter("size = 1").select("keys", "counts").mapInArrow(run, "key bigint, count bigint")


def _levels(counts: DataFrame) -> dict[int, int]:
    """Number of words per level."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(64, np.int64)
        for batch in batches:
            for values in batch.column("counts"):
                sums += np.bincount(level(np.frombuffer(values.as_py(), np.int64)), minlength=64)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], ["level", "n"])

    rows = counts.filter("size = 1").select("counts").mapInArrow(run, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    return {r["level"]: r["n"] for r in rows.collect()}  # at most 64 rows


def score(df: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text", most_bytes: int = 48 << 20, head: int = HEAD,
          weight: float = 4.0, bits: float = BITS) -> DataFrame:
    """Per row of ``df``: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score`` (log10 probabilities).

    Words are runs of bytes other than ASCII white space, A-Z lower-cased; the end of each text is a token too.  ``base_score`` is the
    smoothed word model with exact counts.  ``score`` is the pair model, all counts read from the filter: (pair + ``weight`` * word
    model) / (first word + ``weight``).  A pair and a word count as the smallest count of their level and a first word as the largest of
    its level, so the probabilities after a word sum to at most 1 but for false answers of the filter; a pair is never
    counted higher than its last word.  The filter has ``bits`` bits for each level of each key and is broadcast in parts of about ``most_bytes``,
    one reading of the texts for each.

    Null and empty texts are the end token alone.  Without training rows all counts are 0.  Rows that repeat a key, and rows with a null
    key, are scored each on its own.
    """
    train = training.select(F.col(text).alias("text"))
    n_docs, amount = train.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    buckets = max(8, -(-amount // (3 * BUCKET_KEYS)))  # about BUCKET_KEYS words and pairs in each
    counts = count_ngrams(train, buckets)
    got = counts.filter("size = 1").agg(F.sum("different").alias("v"), F.sum("total").alias("n")).first()
    kinds, total = got["v"] or 0, got["n"] or 0
    amounts, cut, held = _levels(counts), LEVELS + 1, 0
    while cut > 1 and held + amounts.get(cut - 1, 0) <= head:
        cut -= 1
        held += amounts.get(cut, 0)
    top = _unpacked(counts, least=cut).toArrow()  # at most ``head`` rows
    order = np.argsort(top.column("key").to_numpy().view(np.uint64))
    frequent = (top.column("key").to_numpy().view(np.uint64)[order], top.column("count").to_numpy()[order])
    base = 0.5 * (kinds + 1) + total

    docs = df.select(F.col(key).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text"))
    kind = docs.schema["id"].dataType.simpleString()
    sums = "copies bigint, n_tokens bigint, known bigint, logs double, score double"
    reading = f"id {kind}, hash bigint, {sums}, rare array<bigint>, times array<bigint>"
    parts = None
    for span in spans(*entries_per_cell(counts), int(8 * most_bytes / bits)):
        bloom = build_filter(counts, buckets, span, bits)
        sent = df.sparkSession.sparkContext.broadcast((bloom, frequent))  # bounded by ``most_bytes`` and ``head``
        part = stored(docs.mapInArrow(_reader(sent, span, weight, base, n_docs), reading), "scored")
        sent.destroy()
        parts = part if parts is None else parts.union(part)
    asked = parts.filter(F.size("rare") > 0).select("id", "hash", F.explode(F.arrays_zip("rare", "times")).alias("r")).select(
        "id", "hash", F.col("r.rare").alias("key"), F.col("r.times").alias("times"))
    rare = asked.join(stored(_unpacked(counts, below=cut), "rare"), "key", "left").select(
        "id", "hash", F.lit(0).cast("bigint").alias("copies"), F.lit(0).cast("bigint").alias("n_tokens"),
        F.when(F.col("count").isNotNull(), F.col("times")).otherwise(0).alias("known"),
        (F.col("times") * F.log10(F.coalesce("count", F.lit(0)) + 0.5)).alias("logs"), F.lit(0.0).alias("score"))
    names = ["copies", "n_tokens", "known", "logs", "score"]
    out = parts.drop("rare", "times").unionByName(rare).groupBy("id", "hash").agg(*[F.sum(c).alias(c) for c in names])
    each = out.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")))  # rows with the same key and text were summed
    constant = float(np.log10(base))
    whole = {c: F.expr(f"{c} div copies") for c in ("n_tokens", "known")}
    return each.select(
        F.col("id").alias(key), whole["n_tokens"].alias("n_tokens"), whole["known"].alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") / F.col("copies") - whole["n_tokens"] * constant).alias("base_score"), (F.col("score") / F.col("copies")).alias("score"))


def _reader(sent, span: Span, weight: float, base: float, n_docs: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What the words of one span add to the sums of each text; words that are not frequent but held by the filter are listed with their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bloom, (head_keys, head_counts) = sent.value
        for part in slices(batches, "text"):
            now, before, first = tokens(part)
            count = part.num_rows
            text = np.repeat(np.arange(count), np.diff(first))
            words, at = np.unique(now, return_inverse=True)
            mine = np.flatnonzero(span.words(words)[at])
            text, now, before = text[mine], now[mine], before[mine]
            words, at = np.unique(now, return_inverse=True)
            held = bloom.levels(words, 1)

            def added(texts: np.ndarray, values: np.ndarray | None = None) -> np.ndarray:
                return np.bincount(texts, weights=values, minlength=count).astype(np.int64 if values is None else float)

            keys = pair(before, now)
            some = slice(None) if span.pieces == 1 else np.flatnonzero(span.pairs(keys))
            pairs, where = np.unique(keys[some], return_inverse=True)
            last = held[at[some]]
            both = np.minimum(bloom.levels(pairs, 2)[where], last)
            score = added(text[some], np.log10(LEAST[both] + weight * (LEAST[last] + 0.5) / base))
            if span.piece:  # the words of the cell were summed with the first piece
                yield _sums(part, score=score)
                continue
            ends = now == END
            score -= added(text, np.log10(np.where(ends, n_docs, MOST[held[at]]) + weight))
            exact = np.zeros(len(words), np.int64)
            if len(head_keys):
                found = np.minimum(np.searchsorted(head_keys, words), len(head_keys) - 1)
                exact = np.where(head_keys[found] == words, head_counts[found], 0)
            rare = ((exact == 0) & (held > 0))[at]
            cases, times = np.unique(text[rare] * len(words) + at[rare], return_counts=True)
            edges = np.searchsorted(cases, np.arange(count + 1) * len(words))
            yield _sums(part, copies=added(text[ends]), n_tokens=added(text), known=added(text[(exact > 0)[at]]),
                        logs=added(text[~rare], np.log10(exact + 0.5)[at[~rare]]), score=score,
                        rare=pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(words[cases % max(1, len(words))].view(np.int64))),
                        times=pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(times.astype(np.int64))))

    return run


def _sums(part: pa.RecordBatch, **columns) -> pa.RecordBatch:
    """Rows of a reading; sums that are not given are 0, and lists are null."""
    none = np.zeros(part.num_rows, np.int64)
    layout = {"copies": none, "n_tokens": none, "known": none, "logs": none.astype(float), "score": none.astype(float),
              "rare": pa.nulls(part.num_rows, pa.list_(pa.int64())), "times": pa.nulls(part.num_rows, pa.list_(pa.int64()))}
    filled = {name: columns.get(name, empty) for name, empty in layout.items()}
    return pa.RecordBatch.from_pydict({"id": part.column("id"), "hash": part.column("hash"), **{k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in filled.items()}})
