"""Operators on texts against plain versions, with nulls, empty and very long texts, repeated rows, empty tables and extra columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute_pii
import public_tokenizers
from signalpost.llm import common, decontam, html, langid, license, lm, neardup, packing, pii, toxicity

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, id string, row string, comp string"
BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
rng = random.Random(5)
VOCABULARY = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def rows():
    base = prose(120)
    near = [re.sub(r"\b\w+\b", lambda m, k=k: "changed" if hash_of(m.start(), k) % 60 == 0 else m.group(), base) for k in range(20)]
    texts = [None, "", " \n\t ", "word", "two Words", "a b c", "a b c", base, base, base.upper(), *near, prose(30000), "x" * 200_000, "ünï çødé " * 5]
    texts += [prose(rng.randint(1, 80)) for _ in range(40)]
    out = [(i, t, "en", "s", 1, "n", "i", "r", "c") for i, t in enumerate(texts)]
    out += [(7, texts[7], "en", None, None, None, None, None, None), (None, base, None, None, None, None, None, None, None),
            (None, None, None, None, None, None, None, None, None), (3, "other text of the same key", None, None, None, None, None, None, None)]
    return out


def hash_of(a, b):
    return zlib.crc32(f"{a}-{b}".encode())


@pytest.fixture(scope="module")
def data():
    return rows()


@pytest.fixture(scope="module")
def docs(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def blank_words(text):
    return (text or "").encode().lower().split()


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().lower())


def test_word_cutter():
    texts = ["", None, "Ab cD\x0bé", "x", "y z ", " q", "tail"]
    import pyarrow as pa
    cut = common.cut_words(pa.array(texts), common.BLANK_WORD)
    assert [bytes(cut.data[a:b]) for a, b in zip(cut.start, cut.end)] == [w for t in texts for w in blank_words(t)]
    assert list(cut.first) == [0, 0, 0, 3, 4, 6, 7, 8]
    for block in (1, 3, 1 << 20):
        assert list(cut.hashes(block)) == list(cut.hashes())
    assert len(set(cut.hashes())) == 8
    runs, first = common.shingle_hashes(cut.hashes(), cut.first, 2)
    assert list(first) == [0, 0, 0, 2, 3, 4, 5, 6] and len(set(runs)) == 6


def near_brute(data, size, percent):
    sets = []
    for r in data:
        w = blank_words(r[1])
        sets.append({tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    top = list(range(len(data)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                top[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(data):
        if r[0] is not None:
            least[find(i)].append(r[0])
    out = Counter()
    for i, r in enumerate(data):
        comp = min(least[find(i)], default=None)
        out[r[0], len(sets[i]), comp, r[0] is not None and comp == r[0]] += 1
    return out


def test_near_duplicates(spark, data, docs, none):
    got = Counter(tuple(r) for r in neardup.near_duplicates(docs, size=4).collect())
    assert got == near_brute(data, 4, 80)
    assert neardup.near_duplicates(none).collect() == []


def test_blocks_find_what_leaders_miss(spark, monkeypatch):
    """A chain of documents, each like the next only: links between members of a bucket that are not like its leader."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    words = prose(400).split()
    data = [(k, " ".join(words[8 * k:8 * k + 120])) for k in range(30)]
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(3)
    got = Counter(tuple(r) for r in neardup.near_duplicates(frame, size=3).collect())
    assert got == near_brute(data, 3, 80)


def test_components(spark):
    edges = [(bytes([a]), bytes([a + 1])) for a in range(0, 60)] + [(bytes([100]), bytes([120])), (bytes([110]), bytes([120]))]
    rng.shuffle(edges)
    got = {r["node"][0]: r["comp"][0] for r in neardup.components(spark.createDataFrame(edges, "a binary, b binary")).collect()}
    assert got == {**{n: 0 for n in range(61)}, 100: 100, 110: 100, 120: 100}


def contamination_brute(data, items, width=10):
    wins = defaultdict(set)
    for i, t in items:
        w = plain_words(t)
        if w and i is not None:
            n = min(width, len(w))
            for k in range(len(w) - n + 1):
                wins[tuple(w[k:k + n])].add(i)
    sizes = {len(x) for x in wins}
    out = Counter()
    for r in data:
        w, hit, found = plain_words(r[1]), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in wins:
                    hit |= set(range(k, k + n))
                    found |= wins[tuple(w[k:k + n])]
        ids = ",".join(sorted(map(str, found)))
        out[r[0], len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)] += 1
    return out


def test_decontamination(spark, data, docs, none):
    base = data[7][1].split()
    items = [(1, " ".join(base[5:40])), (2, " ".join(base[5:40])), (3, "Two, WORDS!"), (4, None), (5, "..."), (6, prose(30)), (None, "word"), (10, "a b c")]
    extra = data + [(500 + k, prose(20) + " " + " ".join(base[20:31 + k]) + " " + prose(9), *([None] * 7)) for k in range(4)]
    frame = spark.createDataFrame(extra, SCHEMA).repartition(4)
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, window string")
    got = Counter(tuple(r) for r in decontam.contamination(frame, bench).collect())
    assert got == contamination_brute(extra, items)
    assert {r["contaminated"] for r in decontam.contamination(docs, bench.limit(0)).collect()} == {False}
    assert decontam.contamination(none, bench).collect() == []


PRIVATE = ["mail a.b@c.d.e, _x@y.z_w@v.u and b@c", "1.2.3.4.5.6.7.8 256.1.1.1 010.020.030.040 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112, 0 0 0 0 0 0 0 0 0 0 0 0",
           "+1 (132) 555-1352 +1 2 +49.30.123456-7) x", "é😀 +1 (132) 555-1352 q@r.st 10.0.0.1", "1" * 3000 + "." + "2" * 3000, "a" * 5000 + "@" + "b." * 5000 + "c", "+" * 2000, "5 " * 4000]


def test_personal_data(spark, data, docs, none):
    texts = [*PRIVATE, *[r[1] for r in data]]
    frame = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id bigint, text string, spans string")
    for r in pii.personal_data(frame).collect():
        assert [(s["start"], s["order"], s["end"], s["kind"]) for s in r["spans"]] == brute_pii.spans(texts[r["doc_id"]]), texts[r["doc_id"]]
    assert pii.personal_data(docs).count() == docs.count() and pii.personal_data(none).collect() == []


def test_bootstrapped_identifiers(spark):
    known = [f"see account holder u{i}@mail.org for more" for i in range(60)]
    hidden = [f"see account holder QX-{i:06d}-K for more" for i in range(3)]
    other = [f"the item number AB{i:06d} is ordinary" for i in range(40)] + ["the item number z@y.org is here"]
    frame = spark.createDataFrame(list(enumerate(known + hidden + other)), "doc_id bigint, text string")
    found = pii.personal_data(frame).select("doc_id", F.filter("spans", lambda s: s["kind"] == "id").alias("s"), pii.masked(F.lit("0123456789" * 5), F.col("spans")).alias("m"))
    ids = {r["doc_id"]: r["s"] for r in found.collect() if r["s"]}
    assert set(ids) == {60, 61, 62} and all((s[0]["start"], s[0]["end"]) == (19, 30) for s in ids.values())


def test_masking(spark):
    text = "é mail a@b.cd, 10.0.0.1!"
    frame = pii.personal_data(spark.createDataFrame([(1, text)], "doc_id bigint, text string"))
    assert frame.select(pii.masked(F.lit(text), F.col("spans"))).first()[0] == "é mail [EMAIL], [IP]!"


def test_packing(spark, data, docs, none):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    odd = ["  two  blanks ", "a \n b", "tail ", "three   x", "tab\t x  y", "it's 12,5 % — naïve 漢字 x", "\n\n x", " lead"]
    data = data + [(900 + i, t, *([None] * 7)) for i, t in enumerate(odd)]
    frame = spark.createDataFrame(data, SCHEMA).repartition(4)
    got = packing.pack(frame, BPE, group=30).collect()
    wanted = Counter()
    total = 0
    for r in data:
        ids = tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2]
        total += len(ids)
        low, high, piece = 0, (len(ids) - 1) % 1024 + 1, 0
        while low < len(ids):
            wanted[r[0], piece, low, high - low, zlib.crc32(np.array(ids[low:high], "<u4").tobytes())] += 1
            low, high, piece = high, high + 1024, piece + 1
    assert Counter(tuple(r)[:5] for r in got) == wanted
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(sequences) <= 1.05 * -(-total // 1024) + 2
    assert packing.pack(none, BPE).collect() == []


def test_bounds_and_best_fit():
    for seed in range(20):
        local = np.random.default_rng(seed)
        lengths = local.integers(1, 1024, 200)
        sequence, offset, rooms = packing.best_fit(lengths, 1024)
        filled = np.bincount(sequence, lengths, len(rooms))
        assert (filled + rooms == 1024).all() and (filled <= 1024).all()
        bound = packing.lower_bound(np.bincount(lengths, minlength=1025), 1024)
        assert -(-lengths.sum() // 1024) <= bound <= len(rooms)
    assert packing.lower_bound(np.bincount([513] * 7, minlength=1025), 1024) == 7  # more than the sum alone shows


def test_language_forward():
    """The sum over all segmentations, written out."""
    pieces = langid.Pieces.load(PIECES)
    local = np.random.default_rng(1)
    chance = local.random((pieces.size + 1, 2)) / 1000
    index = {int(h): int(r) for h, r in zip(pieces.hashes, pieces.rank) if r >= 0}

    def number(part):
        value = np.zeros(1, np.uint64)
        for c in part:
            value = langid._step(value, np.array([ord(c)], np.uint64))
        return index.get(int(value[0]), pieces.size if len(part) == 1 else None)

    def total(word):
        sums = [np.ones(2)] + [np.zeros(2) for _ in word]
        for end in range(1, len(word) + 1):
            for begin in range(max(0, end - 16), end):
                n = number(word[begin:end])
                if n is not None:
                    sums[end] = sums[end] + sums[begin] * chance[n]
        return np.log(sums[-1])

    words = ["the", "nation", "größe", "über", "漢字", "abcdefghijkl", "z" * 40]
    for group in langid.grouped(words):
        got = langid.forward([words[i] for i in group], pieces, chance)
        assert np.allclose(got, [total(chr(langid.START) + words[i]) for i in group])


def test_language_id(spark, docs, none):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(table.filter(common.fold("doc_id", 4) != 2), "lang", "text", "doc_id", PIECES, per_language=60, rounds=2)
    found = langid.identify(table.filter(common.fold("doc_id", 4) == 2).limit(120), model, PIECES).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.97 * len(found)
    rows = langid.identify(docs.withColumn("lang_pred", F.lit("x")), model, PIECES).collect()
    assert len(rows) == docs.count()
    assert {r["lang_pred"] for r in rows if not any(c.isalpha() for c in r["text"] or "")} == {"und"}
    assert langid.identify(none, model, PIECES).collect() == []
    empty = langid.fit(none, "lang", "text", "doc_id", PIECES)
    assert {(r["lang_pred"], r["lang_score"]) for r in langid.identify(docs, empty, PIECES).collect()} == {("und", 0.0)}


def test_toxicity(spark, docs, none):
    bad = ["you are a nitwit and worse", "what a N1TW1T he is", "total blockhead here", "those blockheads again"]
    texts = [(i, prose(30) + " " + (bad[i % 4] if i % 3 == 0 else "the blockheadline of the day" if i % 7 == 1 else "") + " " + prose(30)) for i in range(600)]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(600)], "doc_id bigint, toxic int")
    model = toxicity.fit(frame, labels.filter("doc_id < 400"))
    assert not any(x in ("you", "are") for x in model.weights)
    got = {r["doc_id"]: r for r in toxicity.score(frame, model).collect()}
    assert all(got[i]["predicted"] == int(i % 3 == 0) for i in range(400, 600))
    disguised = spark.createDataFrame([(1, "a nіtwіt"), (2, None), (3, "blockheadline"), (4, "")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(disguised, model).collect()} == {1: 1, 2: 0, 3: 0, 4: 0}
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.score(none, model).collect() == []
    untrained = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, untrained).collect()} == {0}


@pytest.mark.parametrize("hidden, word", [
    ("b1ockhead", "blockhead"), ("1oser", "loser"), ("|oser", "loser"), ("!oser", "loser"), ("ki11", "kill"), ("k1ll", "kill"), ("K!LL", "kill"), ("n1tw|t", "nitwit"), ("l0ser", "loser"),
    ("2any", "zany"), ("lo5er", "loser"), ("los3r", "loser"), ("bl4st", "blast"), ("6rim", "grim"), ("9rim", "grim"), ("ni7wit", "nitwit"), ("8lockhead", "blockhead")])
def test_hidden_spellings_fold_like_plain_ones(hidden, word):
    assert toxicity.plain(f"a {hidden} here") == toxicity.plain(f"a {word} here")
    assert toxicity.terms_of(toxicity.plain(hidden)[0]) == toxicity.terms_of(toxicity.plain(word)[0])


def test_hidden_l_is_found(spark):
    texts = [(i, prose(30) + (" you blockhead " if i % 3 == 0 else " ") + prose(30)) for i in range(300)]
    model = toxicity.fit(spark.createDataFrame(texts, "doc_id bigint, text string"),
                         spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id bigint, toxic int"))
    hidden = spark.createDataFrame([(1, "you b1ockhead"), (2, "you b|ockhead"), (3, "the clockhand")], "doc_id bigint, text string")
    assert {r["doc_id"]: r["predicted"] for r in toxicity.score(hidden, model).collect()} == {1: 1, 2: 1, 3: 0}


def test_language_model(spark, data, docs, none):
    train = docs.filter("doc_id % 5 <> 1")
    counts, pairs, n_docs = Counter(), Counter(), 0
    for r in data:
        if r[0] is not None and r[0] % 5 != 1:
            words = [*blank_words(r[1]), None]
            counts.update(words)
            pairs.update(zip([0, *words], words))
            n_docs += 1
    total, kinds = sum(counts.values()), len(counts)
    for head in (1 << 18, 4):
        got = lm.score(docs, train, head=head, most_bytes=1 << 20).collect()
        assert Counter(r["doc_id"] for r in got) == Counter(r[0] for r in data)
        by = defaultdict(list)
        for r in data:
            by[r[0]].append([*blank_words(r[1]), None])
        for r in got:
            want = [(len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 0.5) / (total + 0.5 * (kinds + 1))) for x in w)) for w in by[r["doc_id"]]]
            assert any(a == r["n_tokens"] and b == r["n_known"] and abs(c - r["base_score"]) < 1e-6 * abs(c) for a, b, c in want)
            assert r["train_tokens"] == total and r["score"] < 0
    assert lm.score(none, train).collect() == [] and {r["n_known"] for r in lm.score(docs, none).collect()} == {0}


def test_bloom_filter_reads_back_levels(spark):
    keys = common.mix(np.arange(5000, dtype=np.uint64))
    levels = np.arange(5000) % 6 + 1
    body = [(0, 1, bytes(keys.tobytes()), bytes(lm.STEPS[levels - 1].astype(np.int64).tobytes()))]
    frame = spark.createDataFrame(body, "bucket bigint, size int, keys binary, counts binary")
    bloom = lm.build_filter(frame, 1, bits_per_entry=12)
    read = bloom.levels(keys, 1)
    assert (read >= levels).all() and (read == levels).mean() > 0.95
    assert (bloom.levels(common.mix(np.arange(9000, 14000, dtype=np.uint64)), 1) > 0).mean() < 0.02 and not bloom.levels(keys, 2).any()


def test_spans_hold_every_word_and_pair_once():
    rng = np.random.default_rng(3)
    words, pairs = rng.integers(0, 50, lm.CELLS), rng.integers(0, 400, lm.CELLS)
    pairs[[0, 77, lm.CELLS - 1]] = 50_000  # cells of very common words
    parts = lm.spans(words, pairs, 3000)
    assert parts[0].low == 0 and parts[-1].high == lm.CELLS and [p.low for p in parts if not p.piece][1:] == [p.high for p in parts if p.piece == p.pieces - 1][:-1]
    assert all((words[p.low:p.high].sum() + pairs[p.low:p.high].sum() / p.pieces) <= 3000 for p in parts)
    keys = common.mix(np.arange(20_000, dtype=np.uint64))
    assert (sum(p.pairs(keys).astype(int) for p in parts) == 1).all() and (sum(p.words(keys).astype(int) for p in parts if not p.piece) == 1).all()
    assert lm.spans(words * 0, pairs * 0, 10) == [lm.Span()]


def plain_model(texts):
    """Exact counts, their steps, and the probability of a word (None: the end) after another (0: the start)."""
    words, pairs = Counter(), Counter()
    for text in texts:
        said = [*blank_words(text), None]
        words.update(said)
        pairs.update(zip([0, *said], said))
    base = sum(words.values()) + 0.5 * (len(words) + 1)

    def least(n):
        return max((s for s in lm.STEPS.tolist() if s <= n), default=0)

    def most(n):
        return min(s for s in lm.STEPS.tolist() if s > n) - 1

    def chance(left, right):
        both = min(least(pairs[left, right]), least(words[right]))
        return (both + 4.0 * (least(words[right]) + 0.5) / base) / ((len(texts) if left == 0 else most(words[left])) + 4.0)

    return words, chance


def test_language_model_equals_plain_model_in_any_number_of_parts(spark, data, docs):
    """The score is that of exact counts in steps, whether the filter is sent at once, in ranges of words, or with pieces of a common word's pairs."""
    rows = data + [(None, "same same"), (5, "same same"), (5, "same same"), (5, "other"), (6, "never seen before " * 40), (7, "w1 the w2 the the")]
    frame = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id bigint, text string")
    train = [" ".join(f"w{i} the" for i in range(400)), "same same", "a b a b a b a b a b", None, "", *[r[1] for r in data[3:6]]]
    training = spark.createDataFrame([(t,) for t in train], "text string")
    _, chance = plain_model(train)
    want = sorted((str(i), round(sum(math.log10(chance(a, b)) for a, b in zip([0, *blank_words(t)], [*blank_words(t), None])), 6)) for i, t, *_ in rows)
    parts = lm.spans(*lm.entries_per_cell(lm.count_ngrams(training, 8)), 300)
    assert 3 < len(parts) < 12 and any(p.pieces > 1 for p in parts)
    for size in (1 << 20, 300 * 60 // 8):
        got = lm.score(frame, training, most_bytes=size, bits=60, head=50).collect()
        assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in got) == want


def test_probabilities_after_a_word_sum_to_one_at_most(data):
    words, chance = plain_model([r[1] for r in data])
    for left in [0, *[w for w, _ in words.most_common(60) if w is not None], *[w for w in list(words)[:60] if w is not None], "never seen"]:
        assert 0.3 < sum(chance(left, right) for right in [*words, "unseen"]) <= 1 + 1e-9


def test_license(spark, data, docs, none):
    texts = ["Released under the MIT License. Apache License, Version 2.0 / CC BY-NC", "mit license", "x " * 3000 + license.TEMPLATES["bsd"][0].title() + " y",
             license.TEMPLATES["gpl"][0].replace("either", "any"), "CC BY NC cc by-nc", None, "", license.TEMPLATES["isc"][0].replace("fee", "cost")]
    frame = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id bigint, text string, labels string")
    got = {r["doc_id"]: r for r in license.scan(frame).collect()}
    assert (got[0]["n_base"], got[0]["first_word"], got[0]["last_word"], got[0]["base_labels"]) == (3, 1, 10, "apache-2,cc-by-nc,mit")
    assert got[1]["labels"] == "" and got[1]["first_word"] is None and got[2]["labels"] == "bsd" and got[3]["labels"] == "gpl"
    assert got[4]["n_base"] == 2 and got[5]["n_words"] == got[6]["n_words"] == 0 and got[7]["labels"] == ""
    assert [r["n_words"] for r in license.scan(docs).filter("doc_id = 27").collect()] == [len(plain_words(data[27][1]))]
    assert license.scan(none).collect() == []


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"), ("Released under the GNU Lesser General Public License 2.1", "lgpl"),
    ("licensed under the GNU Affero General Public License", "agpl"), ("It is licensed under the GPLv3.", "gpl"), ("licensed under LGPL", "lgpl"),
    ("licensed under the Mozilla Public License, version 2.0", "mpl-2"), ("licensed under the Mozilla Public License 1.1", "mpl"),
    ("released under the BSD license", "bsd"), ("licensed under the 3-clause BSD license", "bsd"), ("licensed under the BSD-3-Clause license", "bsd"),
    ("governed by a BSD-style license", "bsd"), ("licensed under the ISC License.", "isc"), ("licensed under CC BY 4.0", "cc-by"), ("licensed under CC BY-SA 3.0", "cc-by-sa"),
    ("licensed under a Creative Commons Attribution 4.0 International License", "cc-by"), ("licensed under CC0 1.0", "cc0"),
    ("licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License", "cc-by-nd"),
    ("licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 License", "cc-by-nc-sa"),
    ("licensed under a Creative Commons Attribution-Non Commercial 3.0 License", "cc-by-nc"), ("we like the general public and a license", "")])
def test_license_notices(text, labels):
    look_up = license.finder(license.TEMPLATES, np.zeros(1 << 12, np.int64))
    assert ",".join(sorted(look_up(license.hashes_of(text)))) == labels


@pytest.mark.parametrize("copies, filler", [(1, ""), (8, ""), (40, ""), (1, "merge " * 500), (3, "sublicense noninfringement " * 90)])
def test_license_copies_do_not_share_votes(copies, filler):
    seen = np.arange(1, 1 << 12)  # no two words of the same rarity
    look_up = license.finder(license.TEMPLATES, seen)
    text = filler + (license.TEMPLATES["mit"][0] + " \n " + prose(5) + " ") * copies + license.TEMPLATES["isc"][0] + " " + filler
    assert look_up(license.hashes_of(text)) == {"mit": 1.0, "isc": 1.0}


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>one<p>two", "one\n\ntwo"), ("a<br>b<div hidden>c</div><div style='display: none'>d</div>", "a\nb"),
    ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "- a\n- b\n  - c\n- d"), ("<ol start=3><li>x<li>y</ol>", "3. x\n4. y"),
    ("<table><tr><th>Name<th>N<tr><td>Anna<td>12<tr><td>漢字<td>5</table>", "Name  N\nAnna  12\n漢字  5"), ("<pre> a\n  b</pre>", " a\n  b"),
    ("<script>x</script><title>t</title>y &amp; z", "y & z"), ("<div>" * 3000 + "deep", "deep"), ("<table><tr><td>" * 300 + "deep", "deep"), ("x  \n y", "x y")])
def test_page_text(page, text):
    assert html.page_text(page)[1] == text


@pytest.mark.parametrize("page, text", [
    ("<table><form><tr><td>x<td>y</form></table>z", "x  y\n\nz"), ("<table><tr><form><td>x</td></form></tr></table>", "x"),
    ("<table>before<tr><td>x</table>", "before\n\nx"), ("<table><tr>one<td>x</td>two</tr><div>three</div><tr><td>y</table>after", "onetwo\nthree\n\nx\ny\n\nafter"),
    ("<table><tr><td>x<tr><a href=u>link</a><td>y</table>", "link\n\nx\ny"), ("<table><center><tr><td>x</center></table>", "x"), ("<table><p>p<tr><td>x</table>", "p\n\nx"),
    ("<table><colgroup><col><tr><td>x</table>", "x"), ("<table><tr><table><tr><td>x</table>y", "x\n\ny"), ("<table><tr><td><form>in</form>x</table>", "in\nx"),
    ("<table><select><option>a<tr><td>x</table>", "a\n\nx"), ("<textarea>a\n  b</textarea>", "a\n  b"), ("<textarea>a <b>c</b></textarea>d", "a <b>c</b>d"),
    ("<select><option>a<option selected>b<option>c</select>", "b"), ("<select><option disabled>a<option>b</select>", "b"),
    ("<select multiple><optgroup label=g><option>a<option>b</select>x", "g\na\nb\nx"), ("<select><option label=l>a</select> x", "l x"),
    ("<svg><title>no</title><defs><text>no</text></defs><rect/>no<g><text>a <tspan>b</tspan></text></g><text>c</text></svg>d", "a b\nc\nd")])
def test_text_outside_cells_and_in_controls(page, text):
    assert html.page_text(page)[1] == text


def test_pages(spark):
    frame = spark.createDataFrame([(1, "<title>T</title><p>a<p>b", "t"), (1, None, "t"), (None, "x", "t")], "page_id bigint, html string, title string")
    got = sorted(tuple(r) for r in html.extract(frame).filter("page_id = 1").collect())
    assert got == [(1, "", "", 0, 0), (1, "T", "a\n\nb", 4, 3)]
    assert html.extract(frame.limit(0)).collect() == []
