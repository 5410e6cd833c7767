from collections import Counter, defaultdict
from math import floor, log

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from windrow.llm import lexical


def terms(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if ord(c) > 127 or (c.isascii() and c.isalnum()):
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(docs, items, top):
    """Every document scored for every item."""
    held = [(key, Counter(found), len(found)) for key, text in docs if (found := terms(text))]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    asked = defaultdict(Counter)
    for key, text in set(items):
        asked[key].update(terms(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for key, c, n in held:
            m = 75 + 25 * n * n_docs // n_terms
            score = sum(
                times * floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m)) for t, times in wanted.items() if c[t]
            )
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        scored.sort(key=lambda x: x[:3])
        out += [(item, i + 1, key, -minus) for i, (minus, _, _, key) in enumerate(scored[:top])]
    return out


def pairs(df, key):
    return [(r[0], r[1]) for r in df.select(key, "text").collect()]


ITEMS = [
    (1, "Alpha gamma, one-two three É"),
    (1, "Alpha gamma, one-two three É"),
    (1, "word of the same id"),
    (2, None),
    (3, " \n"),
    (None, "only here"),
    (4, "nothing of this kind"),
    (5, "epsilon " * 500 + " ".join(f"w{i}" for i in range(200)) + " word"),
    (6, "WORD text é"),
]


@pytest.mark.parametrize("top", [1, 3, 20])
@pytest.mark.parametrize("block", [3, 8192])
def test_odd_rows_against_brute_force(spark, odd, top, block):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'x' AS rank", "2 AS score", "3 AS share")
    got = lexical.ranked(odd, items, top, block_terms=block).collect()
    want = brute(pairs(odd, "doc_id"), ITEMS, top)
    assert Counter(map(tuple, got)) == Counter(want)


def test_empty_tables(spark, odd, none):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    blank = spark.createDataFrame([(1, None), (2, ""), (None, " ")], "doc_id long, text string")
    for docs, asked in ((none, items), (odd, items.limit(0)), (blank, items), (none, items.limit(0))):
        out = lexical.ranked(docs, asked)
        assert out.columns == ["item_id", "rank", "doc_id", "score"]
        assert out.count() == 0


def test_given_tables_under_any_layout(spark, small, documents):
    items = spark.read.parquet(f"{small}/benchmark.parquet")
    want = Counter(brute(pairs(documents, "doc_id"), pairs(items, "item_id"), 20))
    for docs in (documents, documents.repartition(13)):
        assert Counter(map(tuple, lexical.ranked(docs, items).collect())) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.integers(1, 60), st.integers(0, 2**32 - 1))
def test_masks_are_groups_and_bounds_are_safe(n_terms, n_docs, seed):
    rng = np.random.default_rng(seed)
    present = rng.random((n_terms, n_docs)) < rng.choice([0.02, 0.3, 0.9])
    impact = np.where(present, rng.integers(0, 50, (n_terms, n_docs)), 0)
    weight = rng.integers(0, 9, n_terms)
    bits, group = lexical.by_mask(present)
    assert (bits[group].T.astype(bool) == present).all()
    assert len({b.tobytes() for b in bits}) == len(bits)
    none = np.empty(0, np.int64)
    best = lexical.Best(none, none, none.astype(bool))
    keys = rng.permutation(n_docs)
    lexical.search(present, impact, weight, keys, np.zeros(n_docs, bool), best, 5)
    scores = weight @ impact
    want = sorted((-s, k) for s, k in zip(scores.tolist(), keys.tolist()) if s > 0)[:5]
    assert list(zip((-best.scores).tolist(), best.keys.tolist())) == want


def test_masks_that_cannot_matter_are_passed_over():
    present = np.zeros((3, 4000), bool)
    present[0] = True
    present[1, :50] = present[2, :50] = True
    none = np.empty(0, np.int64)
    best = lexical.Best(none, none, none.astype(bool))
    scored = lexical.search(present, present.astype(np.int64) * 10, np.array([1, 5, 5]), np.arange(4000), np.zeros(4000, bool), best, 20)
    assert scored == 50 and best.keys.tolist() == list(range(20))
