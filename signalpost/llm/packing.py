"""Best-fit packing of tokenised documents, certified by lower bounds.

Documents are cut into pieces of at most one sequence.  Pieces are dealt into groups of bounded size; each group packs its pieces by
best fit decreasing and computes a lower bound of its number of sequences from dual feasible functions.  Groups above their
bound, and the emptiest sequence of every other group, give back their unfinished sequences; those pieces are dealt anew and
packed again, until the total meets the bound of all pieces or an exchange saves nothing.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import slices, stored

CAPACITY = 1024
GROUP = 1 << 16
CACHED = 100_000
PIECE = "row bigint, id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"


class _Dashed(Exception):
    """The text has white space after a blank, so it can't be encoded word by word."""


class _Encoder(dict):
    """Token ids, as bytes, of a blank and the word after it.

    The byte-level scheme always begins a token at a blank before a word, so a text is encoded word by word and each word once; a text
    with other white space after a blank is encoded whole.  Ids are those of the tokenizer file: its vocabulary is read from
    there, its words are merged by rank, and texts are cut at its added tokens first.
    """

    def __init__(self, path: str):
        super().__init__()
        import tiktoken
        from tokenizers import Tokenizer

        loaded = Tokenizer.from_file(path)
        added = loaded.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that take in what is around them are not known here")
        special = set(added)
        self.added = {t.content: array("I", [i]).tobytes() for i, t in added.items()}
        self.cut = re.compile("(" + "|".join(re.escape(c) for c in sorted(self.added, key=len, reverse=True)) + ")") if self.added else None
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        signs = {chr(b): b for b in visible} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in visible)}
        ranks = {bytes(signs[c] for c in word): i for word, i in loaded.get_vocab(with_added_tokens=True).items() if i not in special}
        form = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.encode = tiktoken.Encoding("file", pat_str=form, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, word: str) -> bytes:
        if not word or word[0].isspace():
            raise _Dashed
        if len(self) >= CACHED:
            self.clear()
        ids = array("I", self.encode(" " + word)).tobytes()
        self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self.between(text)
        return b"".join(self.added.get(part) or self.between(part) for part in self.cut.split(text) if part)

    def between(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        first, *words = text.split(" ")
        try:
            return array("I", self.encode(first)).tobytes() + b"".join(map(self.__getitem__, words))
        except _Dashed:
            return array("I", self.encode(text)).tobytes()


def pieces(docs: DataFrame, tokenizer: str, end: int, capacity: int) -> DataFrame:
    """Pieces of each document: (row, id, piece, start, length, ids_crc32), where ``row`` numbers the documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, closing = _Encoder(tokenizer), array("I", [end]).tobytes()
        for part in slices(batches, "text"):
            at, piece, start, length, crc = [], [], [], [], []
            for i, text in enumerate(part.column("text").to_pylist()):
                ids = encoder.ids(text or "") + closing
                low, number = 0, 0
                high = (len(ids) // 4 - 1) % capacity + 1
                while low < len(ids) // 4:
                    at.append(i)
                    piece.append(number)
                    start.append(low)
                    length.append(high - low)
                    crc.append(zlib.crc32(ids[4 * low:4 * high]))
                    low, high, number = high, high + capacity, number + 1
            keys = part.select(["row", "id"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*keys.columns, pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["row", "id", "piece", "start", "length", "ids_crc32"])

    rows = docs.withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(run, PIECE.format(kind=docs.schema["id"].dataType.simpleString()))


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Least number of sequences that dual feasible functions prove; ``counts`` is the number of pieces per length."""
    sizes = np.arange(capacity + 1, dtype=np.int64)
    counts = counts.astype(np.int64)
    amount = np.cumsum(counts * sizes)
    number = np.cumsum(counts)
    best = -(-int(amount[-1]) // capacity)
    for t in range(1, capacity // 2 + 1):  # lengths over capacity - t fill a sequence, lengths below t count nothing
        full = int(number[-1] - number[capacity - t])
        some = int(amount[capacity - t] - amount[t - 1])
        best = max(best, full - (-some // capacity))
    for k in range(1, 33):  # lengths rounded to parts of a sequence
        scaled = (k + 1) * sizes
        value = np.where(scaled % capacity == 0, k * sizes, scaled // capacity * capacity)
        best = max(best, -(-int((counts * value).sum()) // (k * capacity)))
    return best


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence and offset of each piece by best fit decreasing, and the room left in each sequence."""
    order = np.argsort(-lengths, kind="stable")
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    open_ones: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms, some = [], 0  # bit r of ``some``: a sequence has room r
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fitting = some >> length
        if fitting:
            room = length + (fitting & -fitting).bit_length() - 1
            number = open_ones[room].pop()
            if not open_ones[room]:
                some &= ~(1 << room)
        else:
            room, number = capacity, len(rooms)
            rooms.append(0)
        sequence[i], offset[i] = number, capacity - room
        rooms[number] = room - length
        open_ones[room - length].append(number)
        some |= 1 << (room - length)
    return sequence, offset, np.array(rooms, np.int64)


def _pack(items: DataFrame, number: int, groups: int, capacity: int) -> DataFrame:
    columns = [f.name for f in items.schema]

    def run(table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        sequence, offset, rooms = best_fit(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        emptiest = int(np.argmax(rooms))
        group = table.column("group")[0].as_py()
        back = (rooms > 0) & ((len(rooms) > bound) | (np.arange(len(rooms)) == emptiest))
        first = np.zeros(len(lengths), bool)
        first[np.unique(sequence, return_index=True)[1]] = True
        return table.select(columns).append_column("sequence_id", pa.array((number << 55) + (group << 18) + sequence)).append_column(
            "offset", pa.array(offset)).append_column("back", pa.array(back[sequence])).append_column("first", pa.array(first))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in items.schema)
    dealt = items.withColumn("group", F.pmod(F.xxhash64("row", "piece", F.lit(number)), F.lit(groups)))
    return dealt.groupBy("group").applyInArrow(run, f"{kinds}, sequence_id bigint, offset bigint, back boolean, first boolean")


def pack(df: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 2, capacity: int = CAPACITY,
         group: int = GROUP, rounds: int = 8) -> DataFrame:
    """Per piece of each document: ``key``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` and ``offset``.

    ``tokenizer`` is the path of a byte-level tokenizer file that every worker can read; ``end`` is added to each document.
    A document longer than a sequence is cut into whole sequences, after a first piece that may be shorter.

    Null and empty texts are one piece with the closing id alone.  Every row is packed on its own, also rows that repeat a key or have
    a null key.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    cut = stored(pieces(docs, tokenizer, end, capacity), "pieces")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in cut.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length] = n
    columns = [F.col("id").alias(key), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    done = [cut.filter(F.col("length") == capacity).withColumn("sequence_id", -1 - F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("bigint"))]
    counts[capacity] = 0
    bound, items, n = lower_bound(counts, capacity), cut.filter(F.col("length") < capacity), int(counts.sum())
    used = before = None
    for number in range(rounds):
        packed = stored(_pack(items, number, max(1, -(-n // group)), capacity), "packed")
        total, back, n_back = packed.agg(F.count_if("first"), F.count_if(F.col("first") & F.col("back")), F.count_if("back")).first()
        if before is not None and total >= before[0]:
            done.append(before[1])
            break
        used = total if used is None else used - before[0] + total
        done.append(packed.filter("NOT back"))
        items, n, before = packed.filter("back").select(*[f.name for f in cut.schema]), n_back, (back, packed.filter("back"))
        if used <= bound or not n_back or number == rounds - 1:
            done.append(packed.filter("back"))
            break
    out = done[0].select(*columns)
    for part in done[1:]:
        out = out.union(part.select(*columns))
    return out
