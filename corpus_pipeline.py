"""From raw documents to packed training sequences: five stages over the table ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalpost.llm import decontam, langid, neardup, packing, pii
from signalpost.llm.common import stored
from signalpost.llm.queries import table, vocabulary
from signalpost.scale import measured_join

CERTAIN = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is recognised; texts without a letter, or without a language of probability 0.5, go."""
    path = vocabulary("piece_bpe_32k.model")
    model = langid.fit(docs, "lang", "text", "doc_id", path)
    found = langid.identify(docs, model, path)
    return found.filter((F.col("lang_pred") != langid.UNKNOWN) & (F.col("lang_score") >= CERTAIN)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies, once; rows without an id stay."""
    found = neardup.near_duplicates(docs).filter("doc_id IS NOT NULL")
    ids = stored(found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows")), "kept")
    left = measured_join(docs, ids.filter("NOT kept").select("doc_id"), ["doc_id"], F.xxhash64("text"), "left_anti").select(*docs.columns)
    again = stored(ids.filter("kept AND rows > 1").select("doc_id"), "again")
    if again.isEmpty():
        return left
    once = measured_join(left, again, ["doc_id"], F.xxhash64("text"), "left_semi").select(*docs.columns).dropDuplicates(["doc_id", "text"])
    return measured_join(left, again, ["doc_id"], F.xxhash64("text"), "left_anti").select(*docs.columns).union(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that hold no window of a benchmark item."""
    found = decontam.contamination_of_texts(docs, table(spark, sf_dir, "benchmark"))
    bad = stored(found.filter("contaminated").select(F.struct("doc_id", "text_hash").alias("_row")).distinct(), "contaminated")
    rows = docs.withColumn("_row", F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    return measured_join(rows, bad, ["_row"], F.col("doc_id"), "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in the texts by their kind; ``n_chars`` follows."""
    found = pii.personal_data(docs).filter(F.size("spans") > 0).select(
        F.struct("doc_id", "text_hash").alias("_row"), F.col("spans").alias("_spans")).distinct()
    rows = docs.withColumn("_row", F.struct("doc_id", F.xxhash64("text").alias("text_hash")))
    rows = measured_join(rows, stored(found, "spans"), ["_row"], F.col("doc_id"), "left")
    rows = rows.withColumn("_text", F.when(F.col("_spans").isNotNull(), pii.masked(F.col("text"), F.col("_spans"))))
    new = {"text": F.coalesce("_text", "text"), "n_chars": F.coalesce(F.length("_text").cast("bigint"), "n_chars")}
    return rows.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with the sequence and the place in it."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("best_fit_packing", best_fit_packing),
]
# The pieces depend on a trained model and on a tokenizer, which SQL cannot express; tests compare every stage with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
