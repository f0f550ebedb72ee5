"""Toxicity by a weighted lexicon, matched with an Aho-Corasick automaton after folding disguised letters.

Full-width, mathematical and circled letters, letters that only look like Latin ones and digits in the place of letters are folded; accents stay, as they tell words
of some languages apart.  Lexicon terms are whole words or beginnings of
words that toxic texts of a labelled sample hold more often than others; phrases around a term that only clean texts hold are
exceptions.  Weights of the terms found are summed, set in relation to the length, and turned into a probability.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import stored

# Characters that look like the Latin letter they are folded to, and characters without width.  The letters i and l are one,
# as 1, | and ! stand for both.
LOOKALIKES = {
    "a": "аαɑ@4", "b": "ьв8", "c": "сϲ", "d": "ԁ", "e": "еεє3", "g": "ɡ96", "h": "һн", "i": "іιı1!|lӏⅼ", "j": "ј", "k": "кκ", "m": "м",
    "n": "пη", "o": "оοσ0", "p": "рρ", "s": "ѕ5$", "t": "тτ7", "u": "υս", "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγ", "z": "ᴢ2",
}
WIDTHLESS = "­​‌‍⁠﻿"
FOLD = {ord(c): latin for latin, signs in LOOKALIKES.items() for c in signs} | {ord(c): None for c in WIDTHLESS}
WORD = re.compile(r"[^\W_]+")
SHORT, LONG = 4, 8


def plain(text: str | None) -> tuple[str, int]:
    """Folded words of a text between single blanks, and their number."""
    low = (text or "").lower()
    if not low.isascii():
        low = unicodedata.normalize("NFKC", low).lower()
    words = WORD.findall(low.translate(FOLD))
    return f" {' '.join(words)} ", len(words)


def terms_of(line: str) -> set[str]:
    words = set(line.split())
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in range(SHORT, min(len(w), LONG) + 1)}


@dataclass
class Model:
    weights: dict[str, float]
    exceptions: list[str]
    curve: np.ndarray  # constant, and factors of the logs of the sum and of the density


def automaton(words):
    import ahocorasick

    out = ahocorasick.Automaton()
    for word, value in words:
        out.add_word(word, value)
    if len(out):
        out.make_automaton()
    return out


def hits(line: str, lexicon, exceptions) -> list[tuple[int, str]]:
    """(begin, term) of the lexicon terms in a folded line that no exception phrase covers; the longest term at one place."""
    if not len(lexicon):
        return []
    found: dict[int, str] = {}
    for end, term in lexicon.iter(line):
        begin = end - len(term) + 1
        if len(term) > len(found.get(begin, "")):
            found[begin] = term
    if found and len(exceptions):
        for end, phrase in exceptions.iter(line):
            begin = end - len(phrase) + 1
            for at in [a for a in found if begin <= a and a + len(found[a]) <= end + 1]:
                del found[at]
    return sorted(found.items())


def features(total: np.ndarray, words: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(total), np.log1p(total), np.log1p(100 * total / (words + 20))], axis=1)


def _surplus(toxic, clean, n_toxic, n_clean):
    """Likelihood ratio statistic of a term that is more frequent in toxic texts; 0 for others."""
    share = n_toxic / (n_toxic + n_clean)
    both = toxic + clean
    with np.errstate(divide="ignore", invalid="ignore"):
        value = 2 * (np.where(toxic > 0, toxic * np.log(toxic / (both * share)), 0) + np.where(clean > 0, clean * np.log(clean / (both * (1 - share))), 0))
    return np.where(toxic > both * share, value, 0)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", most_toxic: int = 4000,
        most_clean: int = 12000, least: float = 22.0, candidates: int = 3000, strong: float = 0.1,
        most_terms: int = 500) -> Model:
    """Lexicon, exceptions and curve from a bounded sample of labelled rows (about ``most_toxic`` and ``most_clean`` of them).

    ``least`` is the likelihood ratio a term needs.  Terms are chosen one by one for the toxic texts that no chosen term explains
    yet, so that the other words of a text with many near copies do not become terms; then the remaining terms of at least
    ``strong`` times the highest ratio follow, up to ``most_terms``, the size of the lexicon.  A key or a
    text with several labels is toxic if one of them is 1.
    """
    known = labels.select(F.col(key).alias("id"), F.col(label).cast("int").alias("y")).filter("id IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("id").agg(F.max(F.when(F.col("y") > 0, 1).otherwise(0)).alias("y"))
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    part = F.pmod(F.xxhash64("id", F.lit("toxicity")), F.lit(1 << 30)) / F.lit(1 << 30)
    rate = F.when(F.col("y") == 1, most_toxic / max(1, sizes.get(1, 0))).otherwise(most_clean / max(1, sizes.get(0, 0)))
    chosen = F.broadcast(known.filter(part < rate))  # bounded by the two parameters
    sample = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).filter("text IS NOT NULL").join(chosen, "id").select("text", "y")
    sample = stored(sample.groupBy("text").agg(F.max("y").alias("y")), "labelled")
    n = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
    if not n_toxic or not n_clean:
        return Model({}, [], np.array([8.0 if n_toxic else -8.0, 0.0, 0.0]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                seen = [Counter(), Counter()]
                for t, y in zip(part.column("text").to_pylist(), part.column("y").to_pylist()):
                    seen[y].update(terms_of(plain(t)[0]))
                terms = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([seen[y][t] for t in terms], pa.int64()) for y in (1, 0))],
                                                 ["term", "toxic", "clean"])

    counts = sample.mapInArrow(count, "term string, toxic bigint, clean bigint").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = n_toxic / (n_toxic + n_clean)
    both = F.col("toxic") + F.col("clean")
    ratio = 2 * (F.col("toxic") * F.log(F.col("toxic") / (both * share)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (both * (1 - share)))).otherwise(0.0))
    best = counts.filter((F.col("toxic") >= 3) & (F.col("toxic") > both * share)).withColumn("ratio", ratio).filter(F.col("ratio") >= least)
    best = best.orderBy(F.desc("ratio"), F.desc(F.length("term")), "term").limit(candidates).collect()
    terms = [r["term"] for r in best]
    if not terms:
        return Model({}, [], np.array([np.log(sizes[1] / sizes[0]), 0.0, 0.0]))

    def which(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = {t: i for i, t in enumerate(terms)}
        for batch in batches:
            rows = [sorted(number[t] for t in terms_of(plain(x)[0]) & number.keys()) for x in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(rows, pa.list_(pa.int32()))], ["y", "terms"])

    rows = sample.mapInArrow(which, "y int, terms array<int>").filter(F.size("terms") > 0).toArrow()  # the bounded sample
    y = rows.column("y").to_numpy()
    held = np.zeros((len(y), len(terms)), bool)
    for i, found in enumerate(rows.column("terms").to_pylist()):
        held[i, found] = True
    toxic, clean = held[y == 1], held[y == 0].sum(axis=0).astype(float)
    left = np.ones(len(toxic), bool)
    picked = []
    lengths = np.array([len(t) for t in terms])
    while True:
        support = toxic[left].sum(axis=0).astype(float)
        value = _surplus(support, clean, n_toxic, n_clean)
        value[support < 3] = 0
        top = value.max()
        if top < least:
            break
        i = max(np.flatnonzero(value >= top - 1e-9), key=lambda j: lengths[j])
        picked.append(i)
        left &= ~toxic[:, i]
    total = toxic.sum(axis=0)
    full = _surplus(total.astype(float), clean, n_toxic, n_clean)
    for i in np.argsort(-full, kind="stable"):  # then the strongest others, unless one begins with the other
        if full[i] < strong * full[picked].max() if picked else True:
            break
        if len(picked) < most_terms and not any(terms[i].startswith(terms[j]) or terms[j].startswith(terms[i]) for j in picked):
            picked.append(i)
    weights = {terms[i]: float(np.log(((total[i] + 0.5) / (n_toxic + 1)) / ((clean[i] + 0.5) / (n_clean + 1)))) for i in picked}
    exceptions = _exceptions(sample, weights)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, phrases = automaton((t, t) for t in weights), automaton((p, p) for p in exceptions)
        for batch in batches:
            lines = [plain(x) for x in batch.column("text").to_pylist()]
            sums = [sum(weights[t] for _, t in hits(line, lexicon, phrases)) for line, _ in lines]
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(sums, pa.float64()), pa.array([n for _, n in lines], pa.int64())], ["y", "total", "words"])

    rows = sample.mapInArrow(measure, "y int, total double, words bigint").toArrow()  # the bounded sample
    y = rows.column("y").to_numpy().astype(float)
    x = features(rows.column("total").to_numpy(), rows.column("words").to_numpy())
    weight = np.where(y == 1, sizes[1] / n_toxic, sizes[0] / n_clean)
    curve = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (p - y)) + 0.01 * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(3)
        step = np.linalg.solve(bend, slope)
        curve -= step
        if abs(step).max() < 1e-8:
            break
    return Model(weights, exceptions, curve)


def _exceptions(sample: DataFrame, weights: dict[str, float]) -> list[str]:
    """Phrases (the word at a term, alone or with a neighbour) that three clean texts hold and no toxic one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = automaton((t, t) for t in weights)
        for batch in batches:
            seen = [Counter(), Counter()]
            for t, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                line = plain(t)[0]
                phrases = set()
                for at, _ in hits(line, lexicon, ()):
                    end = line.index(" ", at + 1)
                    before = line.rfind(" ", 0, at)
                    after = line.find(" ", end + 1)
                    phrases.add(line[at:end + 1])
                    if before >= 0:
                        phrases.add(line[before:end + 1])
                    if after >= 0:
                        phrases.add(line[at:after + 1])
                seen[y].update(phrases)
            found = list(seen[0].keys() | seen[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *(pa.array([seen[y][p] for p in found], pa.int64()) for y in (1, 0))],
                                             ["phrase", "toxic", "clean"])

    counts = sample.mapInArrow(run, "phrase string, toxic bigint, clean bigint").groupBy("phrase").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return sorted(r["phrase"] for r in counts.filter("clean >= 3 AND toxic = 0").select("phrase").collect())  # from the bounded sample


def score(df: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``df``: ``key``, ``score`` (0 to 1), ``predicted`` (1 from 0.5), ``weight``, ``n_terms`` and ``terms``.

    Null, empty and wordless texts have no terms and the score of a text without terms.  If one label only was known, every
    score is near that label; without labels it is near 0.  Repeated rows and null keys are scored like others.
    """
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, phrases = automaton((t, t) for t in model.weights), automaton((p, p) for p in model.exceptions)
        for batch in batches:
            sums, words, found = [], [], []
            for t in batch.column("text").to_pylist():
                line, n = plain(t)
                terms = [term for _, term in hits(line, lexicon, phrases)]
                sums.append(sum(model.weights[x] for x in terms))
                words.append(n)
                found.append(terms)
            chance = 1 / (1 + np.exp(-np.clip(features(np.array(sums, float), np.array(words, float)) @ model.curve, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(chance), pa.array((chance >= 0.5).astype(np.int32)), pa.array(sums, pa.float64()),
                 pa.array([len(x) for x in found], pa.int64()), pa.array([sorted({t.strip() for t in x}) for x in found], pa.list_(pa.string()))],
                ["id", "score", "predicted", "weight", "n_terms", "terms"])

    kind = docs.schema["id"].dataType.simpleString()
    out = docs.mapInArrow(run, f"id {kind}, score double, predicted int, weight double, n_terms bigint, terms array<string>")
    return out.withColumnRenamed("id", key)
