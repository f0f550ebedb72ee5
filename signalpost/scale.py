"""Building blocks that keep joins, lists and running sums spread over many tasks.

Every helper assumes that one key may hold a large share of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from signalpost.functions.matching import find_labels
from signalpost.session import cut

STREAM_SALTS = 16
# A table up to these limits may be sent to every task.
SMALL_ROWS, SMALL_BYTES = 100_000, 32 << 20


def is_small(df: DataFrame) -> bool:
    """Measured check that a stored table may be broadcast; its rows are summed up where they lie."""
    width = F.lit(16 * len(df.columns))
    for field in df.schema:
        kind, col = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind in ("array", "map", "struct"):
            col = F.to_json(F.struct(col))
        if kind in ("string", "binary", "array", "map", "struct"):
            width = width + F.coalesce(F.octet_length(col), F.lit(0))
    rows, size = df.agg(F.count("*"), F.sum(width)).first()
    return rows <= SMALL_ROWS and (size or 0) <= SMALL_BYTES


def measured_join(big: DataFrame, small: DataFrame, on: list[str], spread: Column, how: str = "inner") -> DataFrame:
    """Equi join with a table that is expected, but not known, to be small.

    The table is stored and measured first.  Within the limits it is broadcast, so the big side is not
    shuffled at all; beyond them both sides are shuffled, salted by ``spread``, and sorted.
    """
    small = cut(small)
    if is_small(small):
        return big.join(F.broadcast(small), on, how)
    return salted_join(big.hint("merge"), small, on, spread, how)


def hot_keys(big: DataFrame, on: list[str], tracked: int = 10_000) -> DataFrame:
    """Keys with more than a task's share of the rows: hash of the key, and pieces it has to be cut into.

    Counts come from a sketch that is merged from all tasks, so no key is shuffled.  A share is one of ``spark.sql.shuffle.partitions``
    parts of all rows; a key is hot from half a share on, so there are at most twice as many hot keys as partitions.
    """
    shares = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashes = big.select(F.xxhash64(*on).alias("_hash"))
    top = hashes.agg(F.count("*").alias("_rows"), F.expr(f"approx_top_k(_hash, {min(2 * shares, tracked)}, {tracked})").alias("_top"))
    each = top.select("_rows", F.explode("_top").alias("_t"))
    return each.filter(2 * shares * F.col("_t.count") > F.col("_rows")).select(
        F.col("_t.item").alias("_hash"), F.ceil(2 * shares * F.col("_t.count") / F.col("_rows")).cast("int").alias("_pieces"))


def dealt(big: DataFrame, small: DataFrame, on: list[str], spread: Column, salts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides of a join with a column ``_salt``: hot keys of ``big`` are cut by ``spread``, their rows of ``small`` copied for each piece.

    Keys that are not hot have one piece and are not copied.  With ``salts`` every key has that many pieces; so it has for a stream, which can't be counted.
    """
    salts = STREAM_SALTS if salts is None and big.isStreaming else salts
    if salts is None:
        hot = F.broadcast(hot_keys(big, on))  # at most two rows per partition
        pieces = F.coalesce(F.col("_pieces"), F.lit(1))
        left = big.withColumn("_hash", F.xxhash64(*on)).join(hot, "_hash", "left")
        right = small.withColumn("_hash", F.xxhash64(*on)).join(hot, "_hash", "left")
    else:
        pieces, left, right = F.lit(salts), big, small
    left = left.withColumn("_salt", F.pmod(F.xxhash64(spread), pieces).cast("int"))
    right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0), pieces - 1)))
    return left.drop("_hash", "_pieces"), right.drop("_hash", "_pieces")


def salted_join(big: DataFrame, small: DataFrame, on: list[str], spread: Column,
                how: str = "inner", salts: int | None = None) -> DataFrame:
    """Equi join in which the rows of a hot key of ``big`` are spread over as many tasks as its count asks for.

    ``spread`` is a column of ``big`` that differs within a key.  Hot keys are measured (``hot_keys``), so ``big`` should be cheap to read;
    ``salts`` cuts every key into a fixed number of pieces instead.  ``how`` is inner, left, left_semi or left_anti.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how}")
    left, right = dealt(big, small, on, spread, salts)
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def dyadic_cells(low: Column, high: Column, levels: int = 62) -> Column:
    """Cells (level, number) that together cover the whole numbers from ``low`` to ``high``, at most two per level.

    A cell of level n holds 2^n numbers.  At each level the range inside whole cells is cut on the left if its first cell is odd, on the
    right if its last one is even; what is between belongs to wider cells.
    """
    def at_level(n: Column) -> Column:
        first = -F.call_function("shiftright", -low, n)  # the first whole cell
        end = F.call_function("shiftright", high + 1, n)  # one past the last whole cell
        left = F.when((first < end) & (F.pmod(first, F.lit(2)) == 1), F.struct(n.alias("level"), first.alias("number")))
        right = F.when((first < end) & (F.pmod(end, F.lit(2)) == 1), F.struct(n.alias("level"), (end - 1).alias("number")))
        return F.array_compact(F.array(left, right))

    low, high = low.cast("bigint"), high.cast("bigint")
    # Levels wider than the range hold no whole cell, so only those up to its length are tried.
    widest = F.least(F.ceil(F.log2(F.greatest(high - low, F.lit(0)) + 2.0)).cast("int"), F.lit(levels))
    return F.flatten(F.transform(F.sequence(F.lit(0), widest), at_level))


def interval_join(points: DataFrame, intervals: DataFrame, on: list[str], point: Column,
                  low: Column, high: Column, width: int, spread: Column | None = None,
                  salts: int | None = None) -> DataFrame:
    """Inner join of points with the closed intervals that hold them.

    ``point``, ``low`` and ``high`` are whole numbers (days or seconds).  The axis is cut into cells of ``width`` and of twice, four
    times, ... ``width``; an interval is listed in the few cells of doubling width that cover it, two per width at most, so its rows
    grow with the logarithm of its length.  A point is listed once per width in use, and both meet on the cell.  ``spread`` cuts hot cells.
    """
    left = points.withColumn("_point", point.cast("bigint"))
    right = intervals.withColumn("_low", low.cast("bigint")).withColumn("_high", high.cast("bigint"))
    right = right.filter(F.col("_low") <= F.col("_high")).withColumn(
        "_cell", F.explode(dyadic_cells(F.floor(F.col("_low") / width), F.floor(F.col("_high") / width))))
    in_use = right.agg(F.collect_set(F.col("_cell.level"))).scalar()  # 63 levels at most
    unit = F.floor(F.col("_point") / width).cast("bigint")
    left = left.withColumn("_levels", in_use).withColumn("_cell", F.explode(F.transform("_levels", lambda n: F.struct(
        n.alias("level"), F.call_function("shiftright", unit, n).alias("number"))))).drop("_levels")
    keys = [*on, "_cell"]
    if spread is None:
        joined = left.join(right, keys)
    else:
        joined = salted_join(left, right, keys, spread, salts=salts)
    return joined.filter(F.col("_point").between(F.col("_low"), F.col("_high"))).drop(
        "_cell", "_point", "_low", "_high")


def substrings(col: Column, max_length: int) -> Column:
    """All distinct substrings of a short text, up to ``max_length`` characters."""
    size = F.least(F.length(col), F.lit(max_length))
    return F.array_distinct(F.flatten(F.transform(
        F.when(size > 0, F.sequence(F.lit(1), size)).otherwise(F.array().cast("array<int>")),
        lambda n: F.transform(F.sequence(F.lit(1), F.length(col) - n + 1),
                              lambda at: F.substring(col, at, n)))))


def name_matches(texts: DataFrame, text: str, names: DataFrame, name: str, max_length: int = 64) -> DataFrame:
    """Distinct pairs (text, name) where the short text contains the name, from one reading of the distinct texts."""
    dictionary = names.select(F.col(name).alias("pattern"), F.lit(0).alias("position"), F.col(name).alias("label"))
    found = find_labels(texts.select(text).distinct(), text, dictionary, "_found")
    return found.select(text, F.explode("_found").alias("_f")).select(text, F.col("_f.label").alias(name))


def contains_join(texts: DataFrame, key: str, text: str, words: DataFrame, word: str, gram: int = 4) -> DataFrame:
    """Distinct pairs (key, word) where a long text contains the word, for word tables of any size.

    A word is found by its first ``gram`` characters, which every text that contains it also has;
    the full word is compared afterwards.  Only keys and hashes of the grams leave their task.  ``key``
    is unique in ``texts``.
    """
    heads = cut(words.select(word).distinct().filter(F.length(word) > 0).withColumn(
        "_gram", F.xxhash64(F.substring(word, 1, gram))))
    sizes = heads.agg(F.collect_set(F.least(F.length(word), F.lit(gram)))).scalar()  # at most ``gram`` numbers
    runs = F.flatten(F.transform("_sizes", lambda n: F.regexp_extract_all(
        F.col(text), F.concat(F.lit("(?s)(?=(.{"), n.cast("string"), F.lit("}))")), F.lit(1))))
    hashes = F.array_distinct(F.transform(runs, lambda g: F.xxhash64(g)))
    grams = texts.withColumn("_sizes", sizes).select(key, F.explode(hashes).alias("_gram"))
    pairs = measured_join(grams, heads, ["_gram"], F.col(key)).select(key, word)
    return pairs.join(texts.select(key, text), key).filter(F.contains(F.col(text), F.col(word))).select(key, word).distinct()


def list_in_parts(df: DataFrame, keys: list[str], size: Column, value: str, limit: int = 10_000) -> DataFrame:
    """Sorted lists per key, split in parts of about ``limit`` entries.

    ``size`` is a column with the number of rows of the key.  Keys up to ``limit`` rows give one row
    with ``part`` 0; larger keys give several rows that together hold every value.
    """
    parts = F.greatest(F.ceil(size / F.lit(limit)), F.lit(1)).cast("bigint")
    return (df.withColumn("part", F.pmod(F.xxhash64(F.col(value)), parts))
            .groupBy(*keys, "part")
            .agg(F.sort_array(F.collect_list(value)).alias(value)))


def running_sum(df: DataFrame, keys: list[str], position: str, value: str, out: str,
                span: int = 100_000) -> DataFrame:
    """Running sum of ``value`` by whole-number ``position`` within ``keys``, spread within a key.

    Each key is cut into stretches of ``span`` positions.  The sums of the stretches are small and
    accumulated first; then every stretch runs on its own from its starting sum.
    """
    cut = df.withColumn("_stretch", F.floor(F.col(position) / span))
    totals = cut.groupBy(*keys, "_stretch").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(*keys).orderBy("_stretch").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_stretch").alias("_at"),
                           F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    same = F.col("_stretch").eqNullSafe(F.col("_at"))
    for k in keys:  # rows without a key count as one key
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    inside = Window.partitionBy(*keys, "_stretch").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (cut.join(starts, same)
            .withColumn(out, F.col("_start") + F.sum(value).over(inside))
            .drop("_stretch", "_start", "_at", *[f"_key_{k}" for k in keys]))
