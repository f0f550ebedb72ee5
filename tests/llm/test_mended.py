"""Cases that were wrong before: numbers in pages, spans, style rules, added tokens, far languages, disguised letters, mixed buckets."""

import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from signalpost.llm import html, langid, neardup, packing, toxicity
from test_text_operators import near_brute

BPE, PIECES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.mark.parametrize("page", ["<ol start='²'><li>x</ol>", "<table><tr><td colspan='²'>x</table>", "<select size='²'><option>x</select>",
                                  f"<ol start='{'9' * 5000}'><li>x</ol>", f"<table><tr><td rowspan='{'9' * 5000}'>x</table>"])
def test_odd_numbers_do_not_end_a_page(page):
    assert "x" in html.page_text(page)[1]


def test_cells_that_span_rows():
    page = "<table><tr><td rowspan=2>A</td><td>B</td></tr><tr><td>C</td></tr><tr><td>D</td><td>E</td></tr></table>"
    assert html.page_text(page)[1].split("\n") == ["A  B", "   C", "D  E"]
    both = "<table><tr><td>1<td rowspan=2 colspan=2>X<td>2</tr><tr><td>3<td>4</tr></table>"
    lines = html.page_text(both)[1].split("\n")
    assert lines[0].index("2") == lines[1].index("4")


def test_rules_of_style_elements():
    page = """<style>/* .p{display:none} */ .h, #gone { color: red; display:none } b.x{visibility:hidden} .back{display:none} .back{display:block}
      @media print { .p { display: none } } div .deep{display:none}</style>
      <p class='a h'>one<p class=p>two<p id=gone>three<p><b class=x>four</b><i class=x>five</i><p class=back>six<p class=h style='display:block'>seven<p class=deep>eight"""
    text = html.page_text(page)[1]
    assert [w for w in "one two three four five six seven eight".split() if w in text] == ["two", "five", "six", "seven", "eight"]


def test_ids_of_texts_with_added_tokens():
    from tokenizers import Tokenizer
    plain, encoder = Tokenizer.from_file(BPE), packing._Encoder(BPE)
    end = "<|endoftext|>"
    local = random.Random(1)
    texts = ["", end, f"x {end} y", f"{end}{end} a", f"a{end}", f" {end} ", f"a \n{end}\n b", "<|endoftext|", f"don't{end}don't"]
    texts += ["".join(local.choice(["a", " ", "word", end, "\n", "é", "7", "'s"]) for _ in range(30)) for _ in range(100)]
    for text in texts:
        ids = np.frombuffer(encoder.ids(text), dtype=np.uint32).tolist()
        assert ids == plain.encode(text, add_special_tokens=False).ids, text


def test_long_words_that_rule_out_each_other(spark):
    docs = [(i, "plain words of one kind are here", "aa") for i in range(30)] + [(100 + i, "слова другого вида стоят здесь", "bb") for i in range(30)]
    frame = spark.createDataFrame([*docs, (900, "a" * 2000 + " " + "ж" * 2000, None), (901, "ж" * 2000 + " q" * 10, None)], "doc_id bigint, text string, lang string")
    model = langid.fit(frame.filter("lang IS NOT NULL"), "lang", "text", "doc_id", PIECES)
    for r in langid.identify(frame, model, PIECES).collect():
        assert 0 <= r["lang_score"] <= 1 and r["lang_pred"] in ("aa", "bb")
        assert r["doc_id"] >= 900 or r["lang_pred"] == r["lang"]


def test_scaling_keeps_far_languages():
    """A word of 600 letters: one language has 0.1 a letter, the other 1e-6; both logs are exact."""
    pieces = langid.Pieces.load(PIECES)
    chance = np.zeros((pieces.size + 1, 2))
    chance[:] = [1e-3, 1e-9]
    short = langid.forward(["ab" * 10], pieces, chance)
    long = langid.forward(["ab" * 300], pieces, chance)
    assert np.isfinite(short).all() and np.isfinite(long).all() and (long[0] < short[0]).all()


@pytest.mark.parametrize("word", ["ｉｄｉｏｔ", "𝐢𝐝𝐢𝐨𝐭", "ⓘⓓⓘⓞⓣ", "idi0t"])
def test_disguised_letters_fold(word):
    assert toxicity.plain(word)[0] == toxicity.plain("idiot")[0]


def test_copies_with_different_labels(spark):
    docs = [(i, "you bad fool " + str(i % 7)) for i in range(40)] + [(100 + i, f"good day number {i}") for i in range(60)] + [(500, "same text"), (501, "same text")]
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(60)] + [(500, 0), (501, 1)]
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    scores = []
    for order in (labels, labels[::-1]):
        model = toxicity.fit(d, spark.createDataFrame(order, "doc_id bigint, toxic int"))
        scores.append(sorted(tuple(r) for r in toxicity.score(d, model).select("doc_id", "score").collect()))
    assert scores[0] == scores[1]


@pytest.mark.parametrize("block", [3, 256])
def test_mixed_buckets(spark, monkeypatch, block):
    """Groups of texts that drift away from their first, so that one leader does not reach all, and a large group of near copies."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    local = random.Random(5)
    data, key = [], 0
    for chain in range(4):
        words = [f"c{chain}w{i}" for i in range(60)]
        for step in range(40):
            words[(step * 7) % 60] = f"n{chain}_{step}"
            data.append((key, " ".join(words)))
            key += 1
    base = [f"b{i}" for i in range(80)]
    for _ in range(60):
        changed = base[:]
        for _ in range(local.randint(0, 4)):
            changed[local.randrange(80)] = f"x{local.randint(0, 5)}"
        data.append((key, " ".join(changed)))
        key += 1
    frame = spark.createDataFrame(data, "doc_id bigint, text string").repartition(5)
    got = Counter(tuple(r) for r in neardup.near_duplicates(frame, size=4).collect())
    assert got == near_brute([(k, t) for k, t in data], 4, 80)
    assert len({g[2] for g in got}) < len(data) / 2
