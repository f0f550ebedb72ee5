"""Stored intermediate tables and a byte-level word cutter shared by the operators."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.session import work_folder

SLICE_BYTES = 2 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Bytes of a word.  Blank words are divided by ASCII white space; plain words are ASCII letters
# (lower-cased before) and digits, and everything outside ASCII.
BLANK_WORD = np.ones(256, dtype=bool)
BLANK_WORD[[9, 10, 11, 12, 13, 32]] = False
PLAIN_WORD = np.zeros(256, dtype=bool)
PLAIN_WORD[48:58] = PLAIN_WORD[97:123] = PLAIN_WORD[128:] = True


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table below the shared folder and read it back: it survives the loss of executors."""
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo ``parts``; a missing key counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly (finaliser of the splitmix generator)."""
    with np.errstate(over="ignore"):
        z = values + np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


@dataclass
class Words:
    """Words of some texts: lower-cased bytes, begin and end of each word, its text, and where texts start."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray  # index of each text's first word, and one past the last word

    def hashes(self, block: int = 1 << 20) -> np.ndarray:
        """64-bit hash of every word, made from running sums over the bytes, a block of bytes at a time."""
        out = np.empty(len(self.start), dtype=np.uint64)
        base, inverse = np.uint64(0x9E3779B97F4A7C15 | 5), pow(0x9E3779B97F4A7C15 | 5, -1, 1 << 64)
        table = mix(np.arange(256, dtype=np.uint64))
        at = 0
        with np.errstate(over="ignore"):
            powers = back = np.ones(1, dtype=np.uint64)
            while at < len(out):
                low = self.start[at]
                to = max(at + 1, int(np.searchsorted(self.end, low + block, side="right")))
                size = int(self.end[to - 1] - low)
                if size > len(powers):
                    powers = np.cumprod(np.r_[np.uint64(1), np.full(size, base)])
                    back = np.cumprod(np.r_[np.uint64(1), np.full(size, np.uint64(inverse))])
                sums = np.zeros(size + 1, dtype=np.uint64)
                np.cumsum(table[self.data[low:low + size]] * powers[:size], out=sums[1:])
                begin, stop = self.start[at:to] - low, self.end[at:to] - low
                out[at:to] = mix((sums[stop] - sums[begin]) * back[begin] + (stop - begin).astype(np.uint64))
                at = to
        return out


def cut_words(column: pa.Array, word: np.ndarray) -> Words:
    """Words of an Arrow string column; ``word`` tells which bytes belong to words.  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    count = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + count + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0]:offsets[-1]] if body is not None else np.empty(0, np.uint8)
    edges = offsets - offsets[0]
    data = LOWER[data]
    inside = word[data]
    begin, stop = inside.copy(), inside.copy()
    if len(data):
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        starts = edges[:-1][edges[:-1] < len(data)]
        begin[starts] = inside[starts]
        stops = edges[1:][edges[1:] > 0] - 1
        stop[stops] = inside[stops]
    start = np.flatnonzero(begin)
    first = np.searchsorted(start, edges)
    return Words(data, start, np.flatnonzero(stop) + 1, np.repeat(np.arange(count), np.diff(first)), first)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of one slice have about ``most`` bytes, and one text at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` words of each text, and the index of each text's first run.

    A text of fewer words, but not none, has one run: the whole text.
    """
    counts = np.diff(first)
    with np.errstate(over="ignore"):
        width = max(0, len(hashes) - size + 1)
        runs = np.full(width, size, dtype=np.uint64)
        for k in range(size):
            runs = mix(runs * np.uint64(0xD1B54A32D192ED03) ^ hashes[k:k + width])
        numbers = np.maximum(counts - size + 1, np.minimum(counts, 1))
        begin = np.r_[0, np.cumsum(numbers)]
        out = np.empty(begin[-1], dtype=np.uint64)
        full = counts >= size
        at = np.repeat(first[:-1][full] - begin[:-1][full], numbers[full])
        places = np.flatnonzero(np.repeat(full, numbers))
        out[places] = runs[places + at]
        for text in np.flatnonzero((counts > 0) & ~full):
            run = np.full(1, counts[text], dtype=np.uint64)
            for value in hashes[first[text]:first[text + 1]]:
                run = mix(run * np.uint64(0xD1B54A32D192ED03) ^ value)
            out[begin[text]] = run[0]
    return out, begin
