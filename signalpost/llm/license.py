"""License scan with a positional index of rare template words.

Templates of licences are cut into words; the index lists the places of the rarest words of each template, rarity being counted over
all files: so many that some must be found even if the others are those that may disagree.  Each pair of a place in the file and a place in the index
votes for where the template would begin; templates with enough votes are compared there word by word, and count if enough words agree
and their key phrases occur in the file.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalpost.llm.common import PLAIN_WORD, cut_words, slices

# Phrases that name a licence, characteristic sentences of public licence texts, and the phrases these must hold.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
TEMPLATES = {
    "mit": ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the "
            "software to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software", ["permission is hereby granted free of charge"]),
    "apache-2": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you "
                 "may obtain a copy of the license at", ["apache license version 2"]),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following "
            "conditions are met", ["redistribution and use in source and binary forms"]),
    "gpl": ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as "
            "published by the free software foundation either version 2 of the license or at your option any later version",
            ["gnu general public license"]),
    "lgpl": ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as "
             "published by the free software foundation", ["gnu lesser general public license"]),
    "mpl-2": ("this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
              "this file you can obtain one at", ["mozilla public license"]),
    "isc": ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that "
            "the above copyright notice and this permission notice appear in all copies", ["with or without fee is hereby granted"]),
    "unlicense": ("this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell "
                  "or distribute this software", ["released into the public domain"]),
    "cc-by-nc": ("licensed under cc by nc 4 0", ["cc by nc"]),
    "cc-by-sa": ("this work is licensed under a creative commons attribution sharealike 4 0 international license", ["creative commons attribution sharealike"]),
    "mit-notice": ("released under the mit license see the license file for details", ["under the mit license"]),
    "apache-2-notice": ("licensed under the apache license version 2 0", ["apache license version 2"]),
}
ALIASES = {"mit-notice": "mit", "apache-2-notice": "apache-2"}
# Short notices of any version, (label, notice, key phrase); and the parts of Creative Commons names as they are written.
NOTICES = [
    *[(kind, f"licensed under the gnu {name}general public license", f"gnu {name}general public license")
      for kind, name in (("gpl", ""), ("lgpl", "lesser "), ("lgpl", "library "), ("agpl", "affero "))],
    *[(kind, f"licensed under {the}{kind}{version}", f"under {the}{kind}{version}")
      for kind in ("gpl", "lgpl", "agpl") for the in ("", "the ", "the gnu ") for version in ("", "v2", "v3")],
    ("mpl", "licensed under the mozilla public license", "mozilla public license"), ("mpl", "licensed under mpl", "mpl"),
    *[("mpl-2", f"licensed under {name} 2 0", f"{name} 2".removeprefix("the ")) for name in ("the mozilla public license version", "the mozilla public license v", "the mozilla public license",
                                                                        "the mpl", "mpl", "the mpl version", "the mpl v")],
    ("bsd", "licensed under the bsd license", "bsd license"), ("bsd", "licensed under a bsd style license", "bsd style license"),
    ("bsd", "governed by a bsd style license", "bsd style license"),
    *[("bsd", f"licensed under the bsd {n} clause license", f"bsd {n} clause") for n in "0234"],
    ("isc", "licensed under the isc license", "isc license"),
    ("cc0", "licensed under cc0", "under cc0"), ("cc0", "licensed under the creative commons zero license", "creative commons zero"),
    ("cc0", "licensed under creative commons cc0", "creative commons cc0"),
]
CC_PARTS = {"nc": ["noncommercial", "non commercial"], "sa": ["sharealike", "share alike"], "nd": ["noderivatives", "noderivs", "no derivatives", "no derivs"]}
for kinds in ((), ("sa",), ("nd",), ("nc",), ("nc", "sa"), ("nc", "nd")):
    label = "-".join(("cc-by", *kinds))
    NOTICES.append((label, f"licensed under {label.replace('-', ' ')}", label.replace("-", " ")))
    for parts in product(*(CC_PARTS[k] for k in kinds)):
        name = " ".join(("creative commons attribution", *parts))
        NOTICES += [(label, f"licensed under {a} {name} license", name) for a in ("a", "the")]
for number, (label, notice, phrase) in enumerate(NOTICES):
    TEMPLATES[f"{label}-notice-{number}"], ALIASES[f"{label}-notice-{number}"] = (notice, [phrase]), label
RAREST, SLACK = 3, 3


def hashes_of(line: str) -> np.ndarray:
    return cut_words(pa.array([line]), PLAIN_WORD).hashes()


def phrase_places(words: np.ndarray, text: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Indexes of the words at which a phrase begins, all words of it in one text."""
    places = np.flatnonzero(words == phrase[0])
    for k in range(1, len(phrase)):
        places = places[places + k < len(words)]
        places = places[(words[places + k] == phrase[k]) & (text[places + k] == text[places])]
    return places


def word_frequencies(docs: DataFrame, words: np.ndarray) -> np.ndarray:
    """Number of texts that hold each of the sorted template words, over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(len(words), np.int64)
        for part in slices(batches, "text"):
            cut = cut_words(part.column("text"), PLAIN_WORD)
            found = cut.hashes()
            at = np.minimum(np.searchsorted(words, found), len(words) - 1)
            same = words[at] == found
            pairs = np.unique(cut.text[same] * len(words) + at[same])
            sums += np.bincount(pairs % len(words), minlength=len(words))
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(sums)), pa.array(sums[sums > 0])], ["word", "n"])

    rows = docs.select("text").mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    out = np.zeros(len(words), np.int64)
    for r in rows.collect():  # one row per template word at most
        out[r["word"]] = r["n"]
    return out


def aligned(file: np.ndarray, template: np.ndarray, begin: int) -> float:
    """Share of a template's words that the file has at their place, or at most SLACK words off, in order."""
    found, low = 0, -SLACK
    for k, word in enumerate(template):
        for gap in range(low, SLACK + 1):
            at = begin + k + gap
            if 0 <= at < len(file) and file[at] == word:
                found += 1
                low = max(low, gap)
                break
    return found / len(template)


def template_words(templates: dict) -> np.ndarray:
    """Sorted hashes of the words of all templates."""
    return np.unique(np.concatenate([hashes_of(body) for body, _ in templates.values()]))


def finder(templates: dict, seen: np.ndarray, rarest: int = RAREST, agree: float = 0.8) -> Callable[[np.ndarray], dict[str, float]]:
    """Function from the words of a file to its labels and their agreement; ``seen`` has the rarity of each of ``template_words``."""
    names = list(templates)
    bodies = [hashes_of(templates[n][0]) for n in names]
    keys = [[hashes_of(p) for p in templates[n][1]] for n in names]
    labels = [ALIASES.get(n, n) for n in names]
    named = {(tuple(p.tolist()), label) for label, phrases in zip(labels, keys) for p in phrases}
    longer = {(p, label): [np.array(q, np.uint64) for q, other in named if other != label and len(q) > len(p) and q[:len(p)] == p] for p, label in named}
    words = template_words(templates)
    places = [np.searchsorted(words, body) for body in bodies]
    postings: dict[int, list[tuple[int, int]]] = defaultdict(list)
    least = []
    for t, place in enumerate(places):
        wrong = len(place) - int(np.ceil(agree * len(place) - 1e-9))  # so many words may disagree
        order = np.lexsort((place, seen[place]))
        enough = min(len(place), wrong + rarest)
        chosen = np.isin(place, place[order[:enough]])  # all places of the rarest words
        least.append(max(1, int(chosen.sum()) - wrong))
        for offset in np.flatnonzero(chosen):
            postings[int(words[place[offset]])].append((t, int(offset)))
    votes_for = np.isin(words, np.array(list(postings), np.uint64))
    shares = np.stack([np.bincount(np.searchsorted(words, body), minlength=len(words)) / len(body) for body in bodies])

    def holds(file: np.ndarray, text: np.ndarray, phrase: np.ndarray, label: str) -> bool:
        """Whether a phrase has a place where no longer phrase of another licence begins, as that of CC BY-SA does at CC BY."""
        places = phrase_places(file, text, phrase)
        for other in longer[tuple(phrase.tolist()), label] if len(places) else ():
            places = np.setdiff1d(places, phrase_places(file, text, other))
        return len(places) > 0

    def look_up(file: np.ndarray) -> dict[str, float]:
        at = np.minimum(np.searchsorted(words, file), len(words) - 1)
        known = np.flatnonzero(words[at] == file)
        if not len(known):
            return {}
        held = np.zeros(len(words))
        held[at[known]] = 1
        possible = shares @ held >= agree - 1e-9  # a template agrees at most in the words that the file has anywhere
        if not possible.any():
            return {}
        votes: dict[tuple[int, int], int] = defaultdict(int)
        for place in known[votes_for[at[known]]].tolist():
            for t, offset in postings[int(file[place])]:
                if not possible[t]:
                    continue
                votes[t, (place - offset) // (SLACK + 1)] += 1
        out: dict[str, float] = {}
        text = np.zeros(len(file), np.int64)
        for t, cell in sorted({(t, cell + k) for t, cell in votes for k in (-1, 0, 1)}):
            label = labels[t]
            # Words that agree are SLACK places off at most, so they vote for the cell of the beginning or one beside it.
            if sum(votes.get((t, cell + k), 0) for k in (-1, 0, 1)) < least[t] or out.get(label, 0) == 1:
                continue
            share = max(aligned(file, bodies[t], cell * (SLACK + 1) + k) for k in range(SLACK + 1))
            if share >= agree and all(holds(file, text, p, label) for p in keys[t]):
                out[label] = max(share, out.get(label, 0))
        return out

    return look_up


def scan(df: DataFrame, key: str = "doc_id", text: str = "text", templates: dict | None = None, phrases: dict | None = None,
         rarest: int = RAREST, agree: float = 0.8) -> DataFrame:
    """Per row of ``df``: ``key``, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``, ``labels`` and ``score``.

    Words are runs of ASCII letters (A-Z lower-cased), digits and characters outside ASCII.  Base columns are about the places
    of the fixed phrases; ``labels`` adds the licences whose template agrees in ``agree`` of its words, with every key phrase in the file, at a
    place where no longer key phrase of another licence begins.  A template is
    looked up by as many of its rarest words as may disagree and ``rarest`` more, all places of which count.  ``score`` is 1 with a base label,
    else the best agreement among the labels, else 0.

    Null, empty and wordless texts have no words and no labels.  Repeated rows and null keys are scanned like others.
    """
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    docs = df.select(F.col(key).alias("id"), F.col(text).alias("text"))
    fixed = [(hashes_of(p), label) for p, label in phrases.items()]
    look_up = finder(templates, word_frequencies(docs, template_words(templates)), rarest, agree)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            cut = cut_words(part.column("text"), PLAIN_WORD)
            found = cut.hashes()
            count = part.num_rows
            n_base, first, last = np.zeros(count, np.int64), np.full(count, 1 << 62), np.full(count, -1)
            base: list[set[str]] = [set() for _ in range(count)]
            for phrase, label in fixed:
                places = phrase_places(found, cut.text, phrase)
                own = cut.text[places]
                inside = places - cut.first[own]
                np.add.at(n_base, own, 1)
                np.minimum.at(first, own, inside)
                np.maximum.at(last, own, inside)
                for i in np.unique(own):
                    base[i].add(label)
            more = [look_up(found[a:b]) for a, b in zip(cut.first[:-1], cut.first[1:])]
            none = n_base == 0
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(np.diff(cut.first)), pa.array(n_base), pa.array(first, pa.int64(), mask=none), pa.array(last, pa.int64(), mask=none),
                 pa.array([",".join(sorted(b)) for b in base]), pa.array([",".join(sorted(b | m.keys())) for b, m in zip(base, more)]),
                 pa.array([1.0 if b else max(m.values(), default=0.0) for b, m in zip(base, more)], pa.float64())],
                ["id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, "
                                "score double").withColumnRenamed("id", key)
