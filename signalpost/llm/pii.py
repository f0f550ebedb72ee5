"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Entities of fixed form (mail and internet addresses, card and phone numbers) are the seeds.  The words before an entity are
its lexical pattern.  Patterns and the values found behind them form a graph; confidence flows from seeds to patterns and from
patterns to values for some rounds, and values behind trusted patterns that have the shape of an identifier are reported as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import stored

# Forms of the entities, and the order of kinds at one place.  Each begins where the form can begin first (after the last
# match, or at the edge of a run), and repeats are possessive where going back cannot help, so that long runs are read once.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
KINDS = [*FORMS, "id"]
NEEDS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
SHAPE = r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}+"
BEFORE = 48


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    backwards = F.split(F.reverse(digits), "(?!^)(?!$)")
    total = F.aggregate(F.transform(backwards, lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.floor(d.cast("int") * 2 / 10).cast("int") + d.cast("int") * 2 % 10)), F.lit(0), lambda a, b: a + b)
    return total % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (
            F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        size = F.length(_digits(value))
        return F.when((size >= 12) & (size <= 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def matches(text: Column, kind: str, form: str, needs: str, before: int = BEFORE) -> Column:
    """All matches of a form as (start, order, end, kind, value, left), places counted in characters from 0.

    The text between matches comes from splitting at them, so places are running sums of lengths; ``left`` is the end of the
    text before the match.
    """
    number = KINDS.index(kind)
    shape = "array<struct<start:int,order:int,end:int,kind:string,value:string,left:string>>"
    gaps, found = F.split(text, form, -1), F.regexp_extract_all(text, F.lit(form), F.lit(0))
    first = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {shape})").alias("list"))

    def add(acc, pair):
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        entry = F.struct(start.alias("start"), F.lit(number).alias("order"), end.alias("end"), F.lit(kind).alias("kind"),
                         pair["value"].alias("value"), F.right(pair["gap"], F.lit(before)).alias("left"))
        return F.struct(end.alias("at"), F.concat(acc["list"], F.array(entry).cast(shape)).alias("list"))

    pairs = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("value")), lambda p: p["value"].isNotNull())
    return F.when(F.rlike(text, F.lit(needs)), F.aggregate(pairs, first, add)["list"]).otherwise(F.expr(f"cast(array() as {shape})"))


def mentions(docs: DataFrame) -> DataFrame:
    """Per document: its entities in order, and the identifier-shaped tokens outside of them, with the text before each."""
    text = F.coalesce(F.col("text"), F.lit(""))

    def true_ones(kind):
        return F.filter(matches(text, kind, FORMS[kind], NEEDS[kind]), lambda m: _valid(kind, m["value"]))

    lists = [true_ones(kind) for kind in FORMS]
    rows = docs.select("id", F.array_sort(F.concat(*lists)).alias("base"), matches(text, "id", SHAPE, "[0-9]").alias("tokens"))
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (t["start"] < b["end"]) & (b["start"] < t["end"])))
    return rows.select("id", "base", free.alias("tokens"))


def pattern(left: Column) -> Column:
    """The two words or signs before a place, lower-cased; null if there are fewer."""
    parts = F.regexp_extract_all(F.lower(left), F.lit(r"\p{L}+|[^\s\p{L}\p{N}]"), F.lit(0))
    return F.when(F.size(parts) >= 2, F.concat_ws(" ", F.slice(parts, -2, 2)))


def bootstrap(found: DataFrame, support: int, trust: float, rounds: int) -> DataFrame:
    """(pattern, value) of identifiers behind trusted patterns.

    A pattern's confidence is the share of its values that are believed, of at least ``support`` seeds; a value's is the chance
    that one of its patterns is right.  Counts are combined before each shuffle, so that a pattern or value with a large share of all
    mentions is no burden.
    """
    seen = found.select(F.explode(F.concat(F.transform("base", lambda m: F.struct(m["left"].alias("left"), m["value"].alias("value"), F.lit(1.0).alias("seed"))),
                                           F.transform("tokens", lambda m: F.struct(m["left"].alias("left"), m["value"].alias("value"), F.lit(0.0).alias("seed"))))).alias("m"))
    edges = seen.select(pattern(F.col("m.left")).alias("pattern"), F.lower("m.value").alias("value"), F.col("m.seed").alias("seed")).filter(
        "pattern IS NOT NULL").groupBy("pattern", "value").agg(F.max("seed").alias("seed"))
    edges = stored(edges, "edges")
    usable = edges.groupBy("pattern").agg(F.sum("seed").alias("seeds"), F.sum(1 - F.col("seed")).alias("others")).filter(
        (F.col("seeds") >= support) & (F.col("others") > 0)).select("pattern")
    edges = stored(edges.join(usable, "pattern", "left_semi"), "graph")
    values = edges.groupBy("value").agg(F.max("seed").alias("seed")).withColumn("belief", F.col("seed"))
    for _ in range(rounds):
        patterns = edges.join(values.select("value", "belief"), "value").groupBy("pattern").agg(
            (F.sum("belief") / (F.count("*") + 1)).alias("confidence"))
        reached = edges.join(patterns, "pattern").groupBy("value").agg(F.max("seed").alias("seed"), (
            1 - F.exp(F.sum(F.log1p(-F.col("confidence"))))).alias("chance"))
        values = stored(reached.select("value", "seed", F.when(F.col("seed") > 0, 1.0).otherwise(F.col("chance")).alias("belief")), "beliefs")
    patterns = edges.join(values.select("value", "belief"), "value").groupBy("pattern").agg((F.sum("belief") / (F.count("*") + 1)).alias("confidence"))
    good = edges.filter("seed = 0").join(patterns.filter(F.col("confidence") >= trust), "pattern").join(
        values.filter(F.col("belief") >= trust).select("value"), "value", "left_semi")
    return stored(good.select("pattern", "value"), "trusted")


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text", support: int = 5, trust: float = 0.8, rounds: int = 3) -> DataFrame:
    """Per row of ``df``: ``key``, ``text_hash`` (64-bit, of the text), and ``spans``: (start, order, end, kind) in order of place and kind.

    Entities of fixed form are always in the list; kind ``id`` marks identifiers found through their contexts.  A token
    can be such an identifier if it has six characters or more, one of them a digit, and no entity overlaps it.

    Null and empty texts have no spans.  Rows that repeat a key and text get the same spans; rows that share a key only are
    told apart by their text.  A null key is a key like others.
    """
    docs = df.select(F.struct(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("hash")).alias("id"), F.col(text).alias("text"))
    found = stored(mentions(docs), "mentions")
    trusted = bootstrap(found, support, trust, rounds)
    short = lambda m: F.struct(m["start"].alias("start"), m["order"].alias("order"), m["end"].alias("end"), m["kind"].alias("kind"))
    loose = found.filter(F.size("tokens") > 0).select("id", F.explode("tokens").alias("m"))
    loose = loose.select("id", pattern(F.col("m.left")).alias("pattern"), F.lower("m.value").alias("value"), short(F.col("m")).alias("m"))
    more = stored(loose.join(trusted, ["pattern", "value"], "left_semi").groupBy("id").agg(F.collect_set("m").alias("more")), "discovered")
    out = found.join(more.withColumnRenamed("id", "other"), F.col("id").eqNullSafe(F.col("other")), "left")
    spans = F.array_sort(F.concat(F.transform("base", short), F.coalesce("more", F.expr(
        "cast(array() as array<struct<start:int,order:int,end:int,kind:string>>)"))))
    return out.select(F.col("id.key").alias(key), F.col("id.hash").alias("text_hash"), spans.alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by its kind in brackets; a span that begins inside an earlier one is covered by it."""
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc, s):
        inside = s["start"] < acc["at"]
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(
            F.concat(acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).alias("out"))

    return F.aggregate(spans, first, add, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1)))
