import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, strategies as st

from windrow.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, lines = set(), 0
    for line in text.split("\n"):
        lines += bool(WORD.search(line)) and line in seen
        seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), lines, len(covered)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_base_numbers(request, which):
    docs = request.getfixturevalue(which)
    found = rules.rated(docs).collect()
    key = lambda r: (str(r[0]), *r[1:])
    want = sorted(((r.doc_id, *brute(r.text)) for r in docs.collect()), key=key)
    assert sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=key) == want
    for r in found:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)
        assert (r.word_distance is None) == (r.n_words < 50)


@given(st.lists(st.sampled_from(["a", "b", "c", "é"]), max_size=60))
def test_repeated_words(words):
    assert rules.repeated_words([w.encode() for w in words]) == brute(" ".join(words))[4]


@given(st.lists(st.integers(0, 9), min_size=5, max_size=5), st.lists(st.integers(1, 9), min_size=5, max_size=5))
def test_distance(counts, reference):
    got = rules.distances(np.array([counts], float), np.array(reference, float))[0]
    p, q = [[x / max(sum(v), 1) for x in v] for v in (counts, reference)]
    m = [(a + b) / 2 for a, b in zip(p, q, strict=True)]
    kl = lambda x: sum(a * math.log2(a / b) for a, b in zip(x, m, strict=True) if a)
    assert got == pytest.approx(math.sqrt(max(0, (kl(p) + kl(q)) / 2)), abs=1e-6)


def test_references_count_everything(documents, monkeypatch):
    whole = rules.references(documents)
    monkeypatch.setattr(rules, "FLUSH_WORDS", 10)
    parts = rules.references(documents.repartition(7))
    assert {k: (v.words, v.n_words, v.classes.tolist()) for k, v in whole.items()} == {k: (v.words, v.n_words, v.classes.tolist()) for k, v in parts.items()}
    words = Counter(w.encode() for r in documents.collect() for w in WORD.findall(r.text or ""))
    assert whole[rules.ANY].n_words == sum(words.values())
    assert [*whole[rules.ANY].words.items()] == sorted(words.items(), key=lambda x: (-x[1], x[0]))[:200]


def test_keeps_clean_and_drops_junk(spark):
    folder = "/root/testdata/sf0.01"
    found = rules.rated(spark.read.parquet(f"{folder}/documents.parquet")).filter("not base_failed")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) > 0.98 * len(good) and sum(bad) < 0.1 * len(bad)


def test_documents_of_a_rare_language_are_not_judged_by_others(spark):
    """Clean, but with none of the words that make up half of all the others' text."""
    rows = [(i, " ".join(f"the of and to in {w}{i}" for w in "abcdefghijkl"), "en") for i in range(400)]
    rows += [(1000 + i, " ".join(f"слово{j} речь{j * i}" for j in range(60)), "xx") for i in range(3)]
    rows += [(2000, " ".join(f"слово{j} речь{j}" for j in range(60)), "en"), (2001, " ".join(f"слово{j} речь{j}" for j in range(60)), None)]
    found = {r.doc_id: r for r in rules.rated(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i].kept and found[i].word_distance is None and found[i].char_distance is None for i in (1000, 1001, 1002))
    assert found[3].kept and not found[2000].kept and found[2001].word_distance > 0.53


def test_empty_table(none):
    assert rules.rated(none).count() == 0
