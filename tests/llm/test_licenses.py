import random
import re
from collections import Counter

import pytest

from windrow.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    words = WORD.findall((text or "").translate(LOWER))
    places = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


@pytest.fixture(scope="session")
def files(spark):
    texts = [
        "x Released under the MIT License. y " * 3,
        "cc by-nc cc by nc by nc; CC-BY-NC",
        "apache license version 2 under the mit license",
        "under the mit licence", "license " * 1000 + "under the mit license",
        "# Permission is hereby granted, free of charge, to any person obtaining a copy of this SOFTWARE and related documentation files",
        "permission is granted to any person obtaining a copy of this software and associated documentation files",
        "This work is licensed under the GNU General Public License, version 3.",
        "This work is licensed under the GNU General Public License, version 4.",
        "naïve mit license é under the mit license", "", None, "nc", "mit", "version 2 apache license",
    ]
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


@pytest.mark.parametrize("which", ["odd", "documents", "files"])
def test_base_is_brute_force(request, which):
    docs = request.getfixturevalue(which)
    key = lambda r: tuple(map(str, r))
    found = licenses.labelled(docs).collect()
    want = [(r.doc_id, *brute(r.text)) for r in docs.collect()]
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in found), key=key) == sorted(want, key=key)
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")


def test_labels_of_templates(files):
    labels = {r.doc_id: r.labels for r in licenses.labelled(files).collect()}
    assert labels[5] == "mit"  # one word of the notice is another
    assert labels[6] == ""  # the key phrase is not whole
    assert labels[7] == "gpl-3" and labels[8] == ""


def test_the_index_finds_what_a_scan_of_all_places_finds(documents):
    templates = licenses._templates()
    index = licenses.Index(templates, licenses.word_rarity(documents, templates))
    for r in documents.collect():
        words = licenses.words_of(r.text)
        want = []
        for t, one in enumerate(templates):
            for start in range(-len(one.words) + 1, len(words)):
                there = [0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(one.words)]
                if sum(there) >= licenses.LEAST_COVERAGE * len(there) and all(there[i] for i in one.mandatory):
                    want.append((t, start, sum(there) / len(there)))
        assert index.matches(words) == want


GRANT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"


@pytest.mark.parametrize(
    "text, labels",
    [
        (GRANT.replace("any person", "any person or organization"), {"mit"}),
        (GRANT.replace("this software", "software").replace("any person", "each and every person"), {"mit"}),
        (GRANT.replace("hereby granted", "granted"), set()),
        ("Distributed under the Apache 2.0 license.", {"apache-2"}),
        ("// SPDX-License-Identifier: GPL-3.0-or-later", {"gpl-3"}),
        ("# SPDX-License-Identifier: BSD-3-Clause", {"bsd"}),
        ("Redistribution and use in source and binary forms, with or without modification, are", {"bsd"}),
        (f"/* {' * '.join(licenses.MIT_TEXT.replace('AUTHORS', 'PROJECT AUTHORS').splitlines(True))} */", {"mit"}),
        (f"x {licenses.MIT_TEXT} y Licensed under the Apache License, Version 2.0 z", {"mit", "apache-2"}),
        ("the mit license " * 500, set()),
    ],
)
def test_words_put_in_and_left_out(text, labels):
    templates = licenses._templates()
    found = licenses.Index(templates, {}).matches(licenses.words_of(text))
    assert {templates[t].label for t, _, _ in found} == labels


def test_candidates_come_from_the_rare_words_and_miss_nothing():
    """Whatever the IDF, every template that a look at all beginnings verifies is among the candidates; without
    the rare words there are none, and words that do not agree on a place give none."""
    templates = licenses._templates()
    rng = random.Random(4)
    vocabulary = sorted({w for t in templates for w in t.words})
    for _ in range(60):
        one = rng.choice(templates)
        words = list(one.words)
        for _ in range(rng.randrange(3)):
            words.insert(rng.randrange(len(words) + 1), rng.choice(vocabulary))
        for _ in range(rng.randrange(3)):
            words.pop(rng.randrange(len(words)))
        words = [b"x"] * rng.randrange(5) + words + rng.choices(vocabulary, k=10)
        index = licenses.Index(templates, {w: rng.random() for w in vocabulary})
        every = {t for t, x in enumerate(templates) for s in range(-5, len(words)) if index._verified(x, words, s) is not None}
        assert {t for t, _, _ in index.matches(words)} == every
    index = licenses.Index(templates, {})
    words = licenses.words_of(GRANT)
    rare = set(index.postings)
    assert index.candidates(words) and not index.candidates([w if w not in rare else b"x" for w in words])
    mit = next(t for t, x in enumerate(templates) if x.words == tuple(words))
    apart = [w for word in words for w in (word, *[b"x"] * 30)]
    assert mit in index.candidates(words) and mit not in index.candidates(apart)


def test_repeated_rows_and_clashing_names(files, odd):
    twice = files.unionByName(files).selectExpr("*", "'x' AS key", "1 AS matches", "2 AS base", "3 AS n_words")
    want = Counter(map(tuple, licenses.labelled(files).collect()))
    assert Counter(map(tuple, licenses.labelled(twice).collect())) == want + want
    assert licenses.labelled(odd).count() == odd.count()


def test_empty_table(none):
    assert licenses.labelled(none).count() == 0
