"""Many patterns in one reading of a text.

A dictionary table is measured and dealt into pieces of bounded size.  A piece is sent to all tasks and becomes a trie with failure links there,
which is run over every text once, in Arrow batches, or a set if whole words are counted; the texts stay in their task and are never shuffled.
Dictionaries of one piece, nearly all, take one reading; a larger one takes a reading per piece, and the table is stored in between so that a
task holds one piece at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.session import cut

PIECE_BYTES = 2 << 20  # of patterns; a trie has about a hundred times as much
# Fixed value: all blanks of Unicode (property White_Space).
UNICODE_BLANKS = "[\t-\r \u0085   -     　]+"


def pieces_of(table: DataFrame, pattern: str, piece_bytes: int = PIECE_BYTES) -> Iterator[DataFrame]:
    """The rows of a dictionary with a pattern that is not empty, dealt by hash into pieces of about ``piece_bytes``."""
    sound = cut(table.filter(F.length(pattern) > 0))
    size = sound.agg(F.coalesce(F.sum(F.octet_length(pattern) + 16), F.lit(0))).first()[0]
    count = -(-size // piece_bytes)
    for number in range(count):
        yield sound.filter(F.pmod(F.xxhash64(pattern), F.lit(count)) == number)


LABELS = "array<struct<position:bigint,label:string>>"


def _finder(shared: Broadcast):
    """Labels of each text from a sent piece {pattern: [(position, label)]}."""
    kind = pa.list_(pa.struct([("position", pa.int64()), ("label", pa.string())]))

    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        trie = ahocorasick.Automaton()
        for pattern, labels in shared.value.items():
            trie.add_word(pattern, labels)
        trie.make_automaton()
        for batch in batches:
            rows = []
            for value in batch:
                seen = {id(labels): labels for _, labels in trie.iter(value.as_py())} if value.is_valid else {}
                rows.append([{"position": p, "label": name} for p, name in set().union(*seen.values())])
            yield pa.array(rows, kind)

    return found


def _counter(shared: Broadcast):
    """Number of tokens of one text that are among the sent words."""
    def counted(text: str) -> int:
        return sum(map(shared.value.__contains__, re.split(UNICODE_BLANKS, text)))

    return counted


def find_labels(df: DataFrame, text: str, dictionary: DataFrame, out: str = "labels", piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``df`` with the distinct (position, label) of all patterns that are part of the text, sorted.

    ``dictionary`` has (pattern, position, label); a pattern may stand for several labels and a label have several patterns.  Patterns overlap
    freely.  A null text has no labels, empty patterns match nothing.
    """
    df = df.withColumn(out, F.array().cast(LABELS))
    plain = dictionary.select("pattern", F.col("position").cast("bigint").alias("position"), F.col("label").cast("string").alias("label")).distinct()
    for number, piece in enumerate(pieces_of(plain, "pattern", piece_bytes)):
        held: dict[str, list[tuple]] = {}
        for r in piece.collect():  # one piece
            held.setdefault(r["pattern"], []).append((r["position"], r["label"]))
        if not held:
            continue
        df = cut(df) if number else df
        found = F.arrow_udf(_finder(df.sparkSession.sparkContext.broadcast(held)), LABELS)
        df = df.withColumn(out, F.array_union(out, found(F.col(text))))
    return df.withColumn(out, F.array_sort(out))


def count_words(df: DataFrame, cols: list[str], lexicon: DataFrame, word: str, out: str, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``df`` with the number of tokens between blanks, over several text columns, that are words of a lexicon table.

    Texts go to a plain function of one row, of which Spark sends about a hundred at a time: split up, a whole Arrow batch takes several times its size.
    """
    df = df.withColumn(out, F.lit(0).cast("bigint"))
    text = F.concat_ws(" ", *[F.col(c) for c in cols])
    for number, piece in enumerate(pieces_of(lexicon.select(word).distinct(), word, piece_bytes)):
        df = cut(df) if number else df
        sent = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in piece.collect()))  # one piece
        df = df.withColumn(out, F.col(out) + F.udf(_counter(sent), "bigint", useArrow=False)(text))
    return df
