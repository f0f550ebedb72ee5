"""Language identification with unigrams marginalised over segmentations.

The pieces of a public vocabulary are fixed.  Each language has a probability for every piece; the probability of a word is the sum over
all ways to write it as a sequence of pieces, computed by the forward algorithm.  Piece probabilities come from expectation
maximisation over the word counts of labelled texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import mix, stored

LONGEST = 16
CACHED = 300_000
UNSCALED = 32
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
START = 0x2581  # fixed value: the sign before a word in the vocabulary


def words_of(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


@dataclass
class Pieces:
    """Hashes of the vocabulary's pieces and of their beginnings, sorted, for looking up all parts of many words at once."""

    hashes: np.ndarray
    rank: np.ndarray  # number of the piece, or -1 for what is only the beginning of one
    size: int  # number of pieces; index ``size`` stands for any character outside the vocabulary

    @classmethod
    def load(cls, path: str) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found = sorted({model.id_to_piece(i) for i in range(model.get_piece_size())
                        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))})
        found = [p for p in found if len(p) <= LONGEST and (len(p) == 1 or LETTERS.fullmatch(p.lstrip(chr(START))))]
        numbers = {p: i for i, p in enumerate(found)}
        begun = sorted({p[:k] for p in found for k in range(1, len(p) + 1)})
        values = np.zeros(len(begun), np.uint64)
        for k in range(LONGEST):
            live = np.array([i for i, p in enumerate(begun) if len(p) > k], np.int64)
            values[live] = _step(values[live], np.array([ord(begun[i][k]) for i in live], np.uint64))
        order = np.argsort(values)
        return cls(values[order], np.array([numbers.get(p, -1) for p in begun], np.int64)[order], len(found))


def _step(value: np.ndarray, char: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(value * np.uint64(0xD1B54A32D192ED03) + char + np.uint64(1))


def parts_of(words: list[str], pieces: Pieces):
    """For words of one length class: (word, begin, length, piece) of every part that is a piece.

    A character that is no piece is one part with the index for unknown characters.
    """
    longest = max(map(len, words)) + 1
    chars = np.zeros((len(words), longest), np.uint64)
    chars[:, 0] = START
    size = np.array([len(w) + 1 for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    chars[:, 1:][np.arange(1, longest)[None, :] < size[:, None]] = flat
    out = []
    for begin in range(longest):
        value = np.zeros(len(words), np.uint64)
        live = np.flatnonzero(size > begin)
        value = value[live]
        for length in range(1, min(LONGEST, longest - begin) + 1):
            keep = size[live] >= begin + length
            live, value = live[keep], value[keep]
            value = _step(value, chars[live, begin + length - 1])
            at = np.searchsorted(pieces.hashes, value)
            at[at == len(pieces.hashes)] = 0
            known = pieces.hashes[at] == value
            rank = pieces.rank[at]
            if length == 1:
                out.append((begin, 1, live, np.where(known & (rank >= 0), rank, pieces.size)))
            live, value, rank = live[known], value[known], rank[known]
            if length > 1 and len(live):
                out.append((begin, length, live[rank >= 0], rank[rank >= 0]))
            if not len(live):
                break
    return size, longest, out


def forward(words: list[str], pieces: Pieces, chance: np.ndarray, counts: np.ndarray | None = None):
    """Log probability of each word in each language; with ``counts`` also the expected number of each piece.

    ``chance`` is (pieces + 1, languages).  Words should have similar lengths.  In words of over ``UNSCALED`` characters values
    are scaled at every place, so that they do not underflow.
    """
    size, longest, parts = parts_of(words, pieces)
    scaled = longest > UNSCALED
    langs = chance.shape[1]
    alpha = np.zeros((longest + 1, len(words), langs))
    alpha[0] = 1.0
    scale = np.zeros((longest + 1, len(words), langs))  # log of what alpha was divided by, up to each place
    by_end: dict[int, list] = {}
    for begin, length, live, rank in parts:
        by_end.setdefault(begin + length, []).append((begin, live, rank))
    for end in range(1, longest + 1):
        scale[end] = scale[end - 1]
        for begin, live, rank in by_end[end]:
            flow = alpha[begin, live] * chance[rank]
            alpha[end, live] += flow * np.exp(scale[begin, live] - scale[end - 1, live]) if scaled else flow
        if not scaled:
            continue
        top = np.where(alpha[end] > 0, alpha[end], 1.0)  # each language by itself: one far behind another must not vanish
        alpha[end] /= top
        scale[end] += np.log(top)
    own = np.arange(len(words))
    with np.errstate(divide="ignore"):
        total = np.log(alpha[size, own]) + scale[size, own]
    if counts is None:
        return total
    beta = np.zeros_like(alpha)
    behind = np.zeros_like(scale)
    beta[size, own] = 1.0
    expected = np.zeros_like(chance)
    by_begin: dict[int, list] = {}
    for begin, length, live, rank in parts:
        by_begin.setdefault(begin, []).append((begin + length, live, rank))
    for begin in range(longest - 1, -1, -1):
        behind[begin] = behind[begin + 1]
        for end, live, rank in by_begin[begin]:
            flow = beta[end, live] * chance[rank]
            beta[begin, live] += flow * np.exp(behind[end, live] - behind[begin + 1, live]) if scaled else flow
            log = scale[begin, live] + behind[end, live] - total[live] if scaled else -total[live]
            share = alpha[begin, live] * flow * np.exp(np.minimum(log, 700)) * counts[live]
            np.add.at(expected, rank, share)
        if not scaled:
            continue
        top = np.where(beta[begin] > 0, beta[begin], 1.0)
        beta[begin] /= top
        behind[begin] += np.log(top)
    return total, expected


def grouped(words: list[str], most: int = 4096) -> Iterator[np.ndarray]:
    """Indexes of words, in groups of similar length and bounded size."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        to = at + 1
        top = sizes[order[at]]
        to = min(len(order), at + max(1, most * 8 // (int(top) + 8)))
        if top > 12:  # long words: cut the group where the length has grown by a quarter
            to = min(to, at + max(1, int(np.searchsorted(sizes[order[at:to]], top * 5 // 4 + 1))))
        yield order[at:to]
        at = to


@dataclass
class Model:
    languages: list[str]
    chance: np.ndarray
    prior: np.ndarray


def fit(df: DataFrame, language: str, text: str, key: str, vocabulary: str, per_language: int = 2000, rounds: int = 3,
        smooth: float = 0.1) -> Model:
    """Piece probabilities of each language, from a bounded sample of labelled rows.

    The sample takes rows by the hash of their key, at a rate per language that gives about ``per_language`` rows.  Word counts are
    a Spark aggregation; each round of the maximisation is one pass over them that returns one row per language and piece.
    """
    labelled = df.select(F.col(key).alias("id"), F.col(text).alias("text"), F.col(language).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row per language
    languages = sorted(sizes)
    pieces = Pieces.load(vocabulary)
    if not languages:
        return Model([], np.zeros((pieces.size + 1, 0)), np.zeros(0))
    rate = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, per_language / sizes[lang]))])
    part = F.pmod(F.xxhash64("id", F.lit("langid")), F.lit(1 << 30)) / F.lit(1 << 30)
    sample = labelled.filter(part < F.element_at(rate, F.col("lang")))
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    words = stored(words.groupBy("lang", "word").count().repartition(F.col("word")), "words")
    chance = np.full((pieces.size + 1, len(languages)), 1.0 / (pieces.size + 1))
    number = {lang: i for i, lang in enumerate(languages)}
    for _ in range(rounds):
        sent = df.sparkSession.sparkContext.broadcast((pieces, chance))  # bounded by vocabulary and languages

        def run(batches, sent=sent, number=number):
            pieces, chance = sent.value
            sums = np.zeros_like(chance)
            for batch in batches:
                texts = batch.column("word").to_pylist()
                lang = np.array([number[x] for x in batch.column("lang").to_pylist()])
                count = batch.column("count").to_numpy()
                for group in grouped(texts):
                    weight = np.zeros((len(group), chance.shape[1]))
                    weight[np.arange(len(group)), lang[group]] = count[group]
                    sums += forward([texts[i] for i in group], pieces, chance, weight)[1]
            piece, lang = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(lang), pa.array(sums[piece, lang])], ["piece", "lang", "n"])

        expected = words.mapInArrow(run, "piece bigint, lang bigint, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n"))
        table = np.full_like(chance, smooth)
        rows = expected.toArrow()  # at most one row per piece and language
        table[rows.column("piece").to_numpy(), rows.column("lang").to_numpy()] += rows.column("n").to_numpy()
        chance = table / table.sum(axis=0)
        sent.unpersist()
    prior = np.array([sizes[lang] for lang in languages], float)
    return Model(languages, chance, np.log(prior / prior.sum()))


def identify(df: DataFrame, model: Model, vocabulary: str, text: str = "text") -> DataFrame:
    """All columns of ``df`` with ``lang_pred`` and ``lang_score``, the posterior probability of that language.

    A text is lower-cased and cut into runs of letters; its log probability is the sum over the words of the whole text, plus the
    log of the language's share in training.  A null text, one without a letter, and every text if nothing was learned, is ``und``
    with score 0.  Of equal languages the first in order of name wins.  Columns of these two names in ``df`` are replaced.
    """
    df = df.drop("lang_pred", "lang_score")
    pieces = Pieces.load(vocabulary)
    sent = df.sparkSession.sparkContext.broadcast((pieces, model))  # bounded by vocabulary and languages
    slot = df.columns.index(text)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, model = sent.value
        place: dict[str, int] = {}
        table = np.empty((1 << 16, len(model.languages)))
        for batch in batches:
            found, score = [], []
            texts = batch.column(slot).to_pylist()
            for at in range(0, len(texts), 256):
                lists = [words_of(t) for t in texts[at:at + 256]]
                if len(place) > CACHED:
                    place.clear()
                fresh = list(set().union(*lists) - place.keys()) if model.languages else []
                base = len(place)
                while base + len(fresh) > len(table):
                    table = np.concatenate([table, np.empty_like(table)])
                for group in grouped(fresh):
                    table[base + group] = forward([fresh[i] for i in group], pieces, model.chance)
                place.update(zip(fresh, range(base, base + len(fresh))))
                for words in lists:
                    if not model.languages or not any(c.isalpha() for w in words[:8] for c in w) and not any(c.isalpha() for w in words for c in w):
                        found.append(UNKNOWN)
                        score.append(0.0)
                        continue
                    rows = np.fromiter(map(place.__getitem__, words), np.int64, len(words))
                    logs = np.maximum(model.prior + table[rows].sum(axis=0), -1e300)  # no language is ruled out for good
                    best = int(np.argmax(logs))
                    found.append(model.languages[best])
                    score.append(float(1.0 / np.exp(np.minimum(logs - logs[best], 0)).sum()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score, pa.float64())],
                                             [*names, "lang_pred", "lang_score"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{kinds}, lang_pred string, lang_score double")
