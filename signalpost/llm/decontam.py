"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

Every benchmark item is cut into windows of consecutive words.  A window is a set of short shingles; a document that holds the
window holds all of them, so the rarest shingle alone, the prefix, must be among the document's shingles.  Rarity is counted over the
documents.  Prefixes are joined with the shingles of the documents; a match fixes where the window would begin, and windows that would not
fit into the document are dropped.  What is left is verified by all shingles of the window, which must follow each other in the document: these places
are known from the same reading, so no text is read or moved again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import stored
from signalpost.scale import measured_join

# Fixed value: a plain word is a run of ASCII letters and digits and of characters outside ASCII.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHINGLE = 3


def plain_words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; no words if it is null."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, SMALL), NOT_WORD)
    return F.filter(parts, lambda w: w != "")


def runs(words: Column, size: Column | int) -> Column:
    """Positions from 0 of the runs of ``size`` words; none if there are fewer words."""
    last = F.size(words) - size
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def _shingles(words: Column, size: int) -> Column:
    """Hashes of the runs of ``size`` words, in order: 96 bits, so that equal hashes are equal words in a corpus of any size."""
    def of(at: Column) -> Column:
        run = [F.get(words, at + k) for k in range(size)]
        return F.struct(F.xxhash64(*run).alias("a"), F.hash(*run).alias("b"))

    return F.transform(runs(words, size), of)


def windows(items: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window, words, n) and the items of each (window, item)."""
    words = items.select("item", plain_words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(width))
    each = words.select("item", F.explode(F.transform(runs(F.col("w"), size), lambda i: F.slice(F.col("w"), i + 1, size))).alias("words"))
    each = stored(each.withColumn("window", F.sha2(F.concat_ws(" ", "words"), 256)).distinct(), "windows")
    return each.dropDuplicates(["window"]).select("window", "words", F.size("words").alias("n")), each.select("window", "item")


def occurrences(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """(id, window, n, at): every place where a window begins in a document."""
    sizes = sorted(r[0] for r in texts.select(F.least("n", F.lit(SHINGLE))).distinct().collect())  # at most SHINGLE numbers
    parts = []
    for size in sizes:
        inside = texts.filter(F.least("n", F.lit(SHINGLE)) == size).select(
            "window", "n", F.posexplode(_shingles(F.col("words"), size)).alias("offset", "shingle"))
        parts.append(inside.withColumn("size", F.lit(size)))
    tokens = parts[0]
    for part in parts[1:]:
        tokens = tokens.union(part)
    tokens = stored(tokens, "tokens")
    known = tokens.select("size", "shingle").distinct()
    found = None
    for size in sizes:
        places = docs.select("id", plain_words(F.col("text")).alias("w")).select(
            "id", F.size("w").alias("n_words"), F.posexplode(_shingles(F.col("w"), size)).alias("place", "shingle"))
        hits = measured_join(places, known.filter(F.col("size") == size), ["shingle"], F.xxhash64("id", "place"))
        found = hits if found is None else found.unionByName(hits)
    found = stored(found.select("id", "n_words", "place", "size", "shingle").distinct(), "places")
    counts = found.groupBy("size", "shingle").agg(F.count("*").alias("seen"))
    ranked = tokens.join(counts, ["size", "shingle"], "left").withColumn("seen", F.coalesce("seen", F.lit(0)))
    prefix = ranked.groupBy("window").agg(F.min(F.struct("seen", "shingle", "offset", "size", "n")).alias("p")).select("window", "p.*").filter("seen > 0")
    # Where the rarest shingle says that the window may begin, if it fits there.
    some = measured_join(found, prefix.drop("seen"), ["size", "shingle"], F.xxhash64("id", "place"))
    some = some.withColumn("at", F.col("place") - F.col("offset")).filter("at >= 0 AND at + n <= n_words")
    some = stored(some.select("id", "window", "n", "at", "size").distinct(), "candidates")
    # All shingles of the window must stand at their places.
    asked = measured_join(some, tokens.select("window", "offset", "shingle"), ["window"], F.xxhash64("id", "at"))
    asked = asked.withColumn("place", F.col("at") + F.col("offset"))
    there = asked.join(found.select("id", "place", "size", "shingle"), ["id", "place", "size", "shingle"])
    needed = F.greatest(F.col("n") - F.lit(SHINGLE) + 1, F.lit(1))
    return there.groupBy("id", "window", "n", "at").agg(F.count("*").alias("_there")).filter(F.col("_there") == needed).drop("_there")


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                  item_text: str = "text", width: int = 10) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated``.

    A window is ``width`` consecutive words of an item, or all words of a shorter one; a document word inside any occurrence of a
    window is hit.  Items with an occurring window count, repeated texts each on their own.

    Null and empty texts have no words and are clean; items without words are never found.  Rows that share a key and text get
    the same result; rows that share a key but not the text are told apart by their text.  A null key is a key like others.
    """
    return contamination_of_texts(docs, items, key, text, item, item_text, width).drop("text_hash")


def contamination_of_texts(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id",
                           item_text: str = "text", width: int = 10) -> DataFrame:
    """``contamination`` with ``text_hash`` (64-bit, of the text), by which rows that share a key are told apart."""
    docs = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    docs = docs.withColumn("id", F.struct("id", F.xxhash64("text").alias("h")))
    texts, owners = windows(items.select(F.col(item).alias("item"), F.col(item_text).alias("text")).filter("item IS NOT NULL"), width)
    texts = stored(texts, "texts")
    counted = docs.select("id", F.size(plain_words(F.col("text"))).cast("bigint").alias("n_words"))
    if texts.isEmpty():
        found = counted.select("id", F.lit(0).cast("bigint").alias("n_hit"), F.lit(0).cast("bigint").alias("n_items"), F.lit("").alias("items")).limit(0)
    else:
        hits = stored(occurrences(docs, texts), "hits")
        words = hits.select("id", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("word")).distinct()
        counts = words.groupBy("id").agg(F.count("*").alias("n_hit"))
        # Documents with the same windows, such as copies, share their items: these are listed once per set of windows.
        sets = hits.select("id", "window").distinct().groupBy("id").agg(F.array_sort(F.collect_list("window")).alias("windows"))
        sets = stored(sets.select("id", "windows", F.sha2(F.concat_ws(",", "windows"), 256).alias("set")), "sets")
        single = sets.dropDuplicates(["set"]).select("set", F.explode("windows").alias("window"))
        named = measured_join(single, owners, ["window"], F.col("set")).select("set", F.col("item").cast("string").alias("item")).distinct()
        named = named.groupBy("set").agg(F.count("*").alias("n_items"), F.concat_ws(",", F.array_sort(F.collect_list("item"))).alias("items"))
        listed = measured_join(sets.select("id", "set"), named, ["set"], F.col("id"))
        found = stored(counts.join(listed.select("id", "n_items", "items"), "id"), "contaminated")
    out = counted.join(found.withColumnRenamed("id", "other"), F.col("id").eqNullSafe(F.col("other")), "left")
    none = F.lit(0).cast("bigint")
    return out.select(F.col("id.id").alias(key), F.col("id.h").alias("text_hash"), "n_words", F.coalesce("n_hit", none).alias("n_hit"), F.coalesce("n_items", none).alias("n_items"),
                      F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"))
