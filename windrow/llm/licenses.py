"""Licence scans by a positional index of rare words."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from windrow.llm.shared import as_bytes, mapped

# Phrases whose every place is reported, with their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Label, wording as licences publish it, and the phrases of it that must be there.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge",)),
    ("mit", "Released under the MIT License", ("mit license",)),
    ("apache-2", "Licensed under the Apache License, Version 2.0", ("apache license version 2",)),
    ("apache-2", "Apache License 2.0", ("apache license 2 0",)),
    ("apache-2", "Apache 2.0 License", ("apache 2 0 license",)),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    ("gpl-2", "This work is licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    ("gpl", "under the terms of the GNU General Public License as published by the Free Software Foundation", ("gnu general public license",)),
    ("lgpl", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", ("lesser general public license",)),
    ("agpl", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", ("affero general public license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", ("source and binary forms", "with or without modification")),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("source and binary forms", "with or without modification")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee",)),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("unencumbered software", "public domain")),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License", ("creative commons attribution 4 0",)),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License", ("creative commons attribution sharealike",)),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License", ("attribution noncommercial",)),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0", ("cc by nc",)),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work", ("waived all copyright", "neighboring rights")),
)

# Identifiers of the licence list that stand in a line "SPDX-License-Identifier: ...", with their labels.
IDENTIFIERS = {
    "MIT": "mit",
    "Apache-2.0": "apache-2",
    "GPL-3.0": "gpl-3",
    "GPL-2.0": "gpl-2",
    "LGPL-2.1": "lgpl",
    "LGPL-3.0": "lgpl",
    "AGPL-3.0": "agpl",
    "BSD-2-Clause": "bsd",
    "BSD-3-Clause": "bsd",
    "ISC": "isc",
    "MPL-2.0": "mpl-2",
    "Unlicense": "unlicense",
    "CC-BY-4.0": "cc-by",
    "CC-BY-SA-4.0": "cc-by-sa",
    "CC-BY-NC-4.0": "cc-by-nc",
    "CC0-1.0": "cc0",
}

# Fixed value: the whole text of a licence, as it is published.
MIT_TEXT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation
the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the
Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
DEALINGS IN THE SOFTWARE.
"""

#: Share of a template's words that must stand in order.
LEAST_COVERAGE = 0.8
#: Looked-up words that must agree on where a template stands.
LEAST_AGREEING = 2
#: Words that may stand between a template's words: so many, or one for so many of them.
LEAST_GAPS, WORDS_A_GAP = 3, 8

#: Words are runs of 0-9, a-z and everything beyond ASCII, after lower-casing.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: bytes | str | None) -> list[bytes]:
    data = text.encode() if isinstance(text, str) else text or b""
    return data.translate(_WORD_BYTES).split()


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    #: Phrases that must stand whole, each with its place.
    phrases: tuple[tuple[int, tuple[bytes, ...]], ...]
    #: Whether each place of the phrase counts as a base one: then it is the whole template, without gaps.
    base: bool

    @property
    def mandatory(self) -> tuple[int, ...]:
        """Places of the words of the phrases."""
        return tuple(p + i for p, phrase in self.phrases for i in range(len(phrase)))

    @property
    def gaps(self) -> int:
        return 0 if self.base else max(LEAST_GAPS, len(self.words) // WORDS_A_GAP)

    @property
    def may_lack(self) -> int:
        """Words that a match may lack."""
        return 0 if self.base else int(len(self.words) * (1 - LEAST_COVERAGE) + 1e-9)


def _templates() -> tuple[Template, ...]:
    found = [Template(label, tuple(words_of(p)), ((0, tuple(words_of(p))),), True) for p, label in PHRASES.items()]
    lines = [(label, f"SPDX-License-Identifier: {name}", (f"spdx license identifier {name}",)) for name, label in IDENTIFIERS.items()]
    for label, text, phrases in (*TEMPLATES, *lines, ("mit", MIT_TEXT, ("permission is hereby granted free of charge", "without warranty of any kind"))):
        words, places = words_of(text), []
        for phrase in map(words_of, phrases):
            places.append((next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase), tuple(phrase)))
        found.append(Template(label, tuple(words), tuple(places), False))
    return tuple(found)


def common_length(a: list[bytes], b: list[bytes]) -> int:
    """Words of the longest sequence that stands in both in order."""
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@dataclass
class Index:
    """Postings (template, place) of the words that are looked up: of each template the highest IDF ones.

    They are as many as a match may lack and ``LEAST_AGREEING`` more, so that many stand in any match: it
    cannot be missed.
    """

    templates: tuple[Template, ...]
    idf: dict[bytes, float]
    postings: dict[bytes, list[tuple[int, int]]] = field(init=False)

    def __post_init__(self) -> None:
        self.postings = defaultdict(list)
        for t, template in enumerate(self.templates):
            places = sorted(range(len(template.words)), key=lambda p: (-self.idf.get(template.words[p], math.inf), template.words[p], p))
            for place in places[: template.may_lack + LEAST_AGREEING]:
                self.postings[template.words[place]].append((t, place))
        self.postings = dict(self.postings)

    def candidates(self, words: list[bytes]) -> dict[int, list[int]]:
        """Per template where it may begin: the looked-up words' postings, less their places in the file, are
        intersected.  A beginning stays if ``LEAST_AGREEING`` words of the template tell it, to within its gaps."""
        told: dict[int, dict[int, set[int]]] = defaultdict(lambda: defaultdict(set))
        for at, word in enumerate(words):
            for t, place in self.postings.get(word, ()):
                told[t][at - place].add(place)
        found = {}
        for t, starts in told.items():
            gaps, agreed = self.templates[t].gaps, []
            if len(set().union(*starts.values())) < LEAST_AGREEING:
                continue
            for start in sorted(starts):
                near = set().union(*(starts[s] for s in range(start - gaps, start + gaps + 1) if s in starts))
                if len(near) >= LEAST_AGREEING:
                    agreed.append(start)
            if agreed:
                found[t] = agreed
        return found

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """Template, first word and coverage of each place where a template stands."""
        if len(self.postings.keys() & set(words)) < LEAST_AGREEING:
            return []
        found = []
        for t, starts in self.candidates(words).items():
            template, verified = self.templates[t], []
            for start in starts:
                if (coverage := self._verified(template, words, start)) is not None:
                    in_place = sum(0 <= start + i < len(words) and words[start + i] == w for i, w in enumerate(template.words))
                    verified.append((-in_place, -coverage, start))
            kept: list[tuple[int, int, float]] = []
            for _, coverage, start in sorted(verified):  # of beginnings within the gaps of each other, the best one
                if all(abs(start - other) > 2 * template.gaps for _, other, _ in kept):
                    kept.append((t, start, -coverage))
            found += kept
        return sorted(found)

    def _verified(self, template: Template, words: list[bytes], start: int) -> float | None:
        """Coverage of a template from a beginning on, gaps allowed, or None if it does not stand there."""
        gaps, n = template.gaps, len(template.words)
        low = max(0, start - gaps)
        window = words[low : max(0, start + n + gaps)]
        for place, phrase in template.phrases:
            size = len(phrase)
            near = range(max(low, start + place - gaps), min(len(words) - size, start + place + gaps) + 1)
            if not any(tuple(words[i : i + size]) == phrase for i in near):
                return None
        if len(set(window) & set(template.words)) < LEAST_COVERAGE * len(set(template.words)) - template.may_lack:
            return None
        coverage = common_length(list(template.words), window) / n
        return coverage if coverage >= LEAST_COVERAGE else None


def word_rarity(docs: DataFrame, templates: tuple[Template, ...], text: str = "text") -> dict[bytes, float]:
    """Inverse document frequency of each licence word over all documents.

    The driver gets one count per word of the templates.
    """
    vocabulary = frozenset(w for t in templates for w in t.words)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = defaultdict(int)
        rows = 0
        for batch in batches:
            rows += batch.num_rows
            for data in as_bytes(batch.column("text")):
                for word in vocabulary.intersection(words_of(data)):
                    seen[word] += 1
        yield pa.record_batch({"word": pa.array([b"", *seen], pa.binary()), "n": pa.array([rows, *seen.values()], pa.int64())})

    counts = mapped(docs.select(F.col(text).cast("string").alias("text")), work, "word binary, n long")
    n = {bytes(r["word"]): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = n.pop(b"", 0)
    return {w: math.log((rows + 1) / (n.get(w, 0) + 1)) for w in vocabulary}


def scanned(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words and matches, an array of (label, base, first_word, n_words, coverage).

    A match is a place where at least ``LEAST_COVERAGE`` of a template's words stand in order, few words put in
    between, its mandatory phrases whole.  Every place of a phrase of ``PHRASES`` is a match of its own.  Null
    texts are empty and match nothing.  Each row is a file of its own, repeated or not; its matches are in the
    order of the templates and of their places, and ``first_word`` is below 0 where a file begins within
    a template.  An empty table gives no rows; other columns are not read.
    """
    templates = _templates()
    index = Index(templates, word_rarity(docs, templates, text))
    kind = docs.schema[key].dataType.simpleString()
    match = pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first_word", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for data in as_bytes(batch.column("text")):
                words = words_of(data)
                sizes.append(len(words))
                found.append([(index.templates[t].label, index.templates[t].base, s, len(index.templates[t].words), c) for t, s, c in index.matches(words)])
            yield pa.record_batch({"key": batch.column("key"), "n_words": pa.array(sizes, pa.int64()), "matches": pa.array(found, pa.list_(match))})

    struct = "struct<label string, base boolean, first_word long, n_words long, coverage double>"
    narrow = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return mapped(narrow, work, f"key {kind}, n_words long, matches array<{struct}>").withColumnRenamed("key", key)


def labelled(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_words, n_base, first_word, last_word, base_labels, labels, score (the best coverage).

    Rows as for :func:`scanned`; labels are sorted, each once.
    """
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform("base", lambda m: m["first_word"])
    names = lambda column: F.array_join(F.array_sort(F.array_distinct(F.transform(column, lambda m: m["label"]))), ",")
    return scanned(docs, key, text).withColumn("base", base).select(
        key,
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        names("base").alias("base_labels"),
        names("matches").alias("labels"),
        F.coalesce(F.array_max(F.transform("matches", lambda m: m["coverage"])), F.lit(0.0)).alias("score"),
    )
