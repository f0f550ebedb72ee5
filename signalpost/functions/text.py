"""Column expressions over texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.functions.matching import count_words

WORD = r"[\p{L}\p{N}]+"
BLANKS = r"(?U)\s+"  # all blanks of Unicode, not of ASCII alone


def words(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tag_issues(text: Column, dictionary: list[tuple[str, list[str]]]) -> Column:
    """Labels, in dictionary order, of which any keyword is part of the text.

    The dictionary is a parameter of the job, so it sits in the plan as one literal.
    """
    entries = F.array(*[F.struct(F.lit(label).alias("label"), words(keys).alias("keys"))
                        for label, keys in dictionary])
    hits = F.filter(entries, lambda e: F.exists(e["keys"], lambda k: F.contains(text, k)))
    return F.transform(hits, lambda e: e["label"])


def any_keyword(cols: list[Column], keywords: list[str]) -> Column:
    """Any keyword in any column, letters A-Z in either case; without keywords no row."""
    if not keywords:
        return F.lit(False)
    pattern = "(?i)" + "|".join(re.escape(k) for k in keywords)
    found = F.lit(False)
    for col in cols:
        found = found | F.coalesce(col.rlike(pattern), F.lit(False))
    return found


def search(text: Column, all_of: list[str] = (), none_of: list[str] = (), any_of: list[str] = (),
           exact: str | None = None) -> Column:
    """All words, no excluded word, at least one of a list, and an exact phrase; each part optional."""
    keep = F.lit(True)
    for word in all_of:
        keep = keep & F.contains(text, F.lit(word))
    for word in none_of:
        keep = keep & ~F.contains(text, F.lit(word))
    if any_of:
        hit = F.lit(False)
        for word in any_of:
            hit = hit | F.contains(text, F.lit(word))
        keep = keep & hit
    return keep & F.contains(text, F.lit(exact)) if exact else keep


def mentions(text: Column, word: Column) -> Column:
    """Occurrences of a word in a text, not overlapping."""
    gone = F.length(text) - F.length(F.replace(text, word, F.lit("")))
    return F.try_divide(gone, F.length(word)).cast("bigint")


def lexicon_count(cols: list[Column], lexicon: list[str]) -> Column:
    """Blank-separated tokens that are in the lexicon, over several columns."""
    total = F.lit(0)
    for col in cols:
        tokens = F.split(F.coalesce(col, F.lit("")), BLANKS)
        total = total + F.size(F.filter(tokens, lambda t: (t != "") & F.array_contains(words(lexicon), t)))
    return total.cast("bigint")


def lexicon_count_by_join(df: DataFrame, key: str, cols: list[str], lexicon: DataFrame, word: str,
                          out: str) -> DataFrame:
    """The same count for a lexicon kept as a table of any size; every row of ``df`` is kept and no text leaves its task."""
    return count_words(df, cols, lexicon, word, out).select(*df.columns, out)


def terms(text: Column, distinct: bool = True) -> Column:
    """Lower-case letter and digit runs of a text; ``distinct`` keeps each once."""
    found = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD})"), F.lit(1))
    return F.array_distinct(found) if distinct else found


def weighted_terms(df: DataFrame, weights: dict[str, int], distinct: bool = True) -> DataFrame:
    """One row per term of a row's fields, with the weight of the field; weight 0 leaves a field out."""
    fields = F.array(*[F.struct(F.lit(w).cast("bigint").alias("weight"), terms(F.col(c), distinct).alias("_terms"))
                       for c, w in weights.items() if w])
    kept = [c for c in df.columns if c not in weights]
    return df.select(*kept, F.inline(fields)).select(*kept, F.explode("_terms").alias("term"), "weight")


def parse_reply(col: Column) -> Column:
    """Struct (car_name, is_trigger, topic, summary) from free text that holds one JSON object.

    The object runs from the first ``{`` to the last ``}``.  Without a readable object the flag is
    false and the rest null; a missing summary in a readable object is an empty text.
    """
    body = F.regexp_extract(col, r"(?s)(\{.*\})", 1)
    fields = F.from_json(body, "struct<car_name:string,issue:string,topic:string,summary:string,_bad:string>",
                         {"columnNameOfCorruptRecord": "_bad"})
    good = (body != "") & fields["_bad"].isNull()
    return F.struct(
        F.when(good, fields["car_name"]).alias("car_name"),
        F.coalesce(good & (fields["issue"] == "True"), F.lit(False)).alias("is_trigger"),
        F.when(good, fields["topic"]).alias("topic"),
        F.when(good, F.coalesce(fields["summary"], F.lit(""))).alias("summary"))


def relevant_news(df: DataFrame) -> DataFrame:
    """News with the issue flag and a topic other than "none", in either case."""
    return df.filter(F.col("is_trigger") & (F.lower(F.col("topic")) != "none"))
