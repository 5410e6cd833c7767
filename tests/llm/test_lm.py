import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, strategies as st

from windrow.llm import lm


def brute(rows, target, size):
    """Both models and each row's losses, pair by pair."""
    texts = [(r.doc_id, (r.text or "").encode().split()) for r in rows]
    words = Counter(w for _, t in texts for w in t)
    known = {w: 1 + lm.SHAPES + i for i, (w, _) in enumerate(sorted(words.items(), key=lambda x: (-x[1], x[0]))[: size - 1 - lm.SHAPES])}
    token = lambda w: known.get(w) or 1 + lm.shape(w)
    rows = [(i, list(zip([0, *map(token, t)], [*map(token, t), 0], strict=True))) for i, t in texts]
    n = 1 + lm.SHAPES + len(known)

    def model(some):
        pairs, first, second = Counter(some), Counter(a for a, _ in some), Counter(b for _, b in some)
        q = lambda b: (second[b] + 1) / (len(some) + n)
        return lambda a, b: -math.log((pairs[a, b] + lm.PRIOR * q(b)) / (first[a] + lm.PRIOR))

    background = model([p for _, ps in rows for p in ps])
    aimed = model([p for i, ps in rows if i in target for p in ps])
    return [(i, len(ps), sum(aimed(*p) for p in ps) / len(ps), sum(background(*p) for p in ps) / len(ps)) for i, ps in rows]


@pytest.mark.parametrize("which", ["odd", "documents"])
@pytest.mark.parametrize("size", [lm.VOCABULARY, 100])
def test_same_as_brute_force(spark, request, monkeypatch, which, size):
    docs = request.getfixturevalue(which)
    monkeypatch.setattr(lm.fit, "__defaults__", ("text", "target", size))
    monkeypatch.setattr(lm, "REMEMBERED", 500)
    target = {1, 3, 7, 9, 20, 21, 22}
    found = lm.rated(docs, spark.createDataFrame([(i,) for i in (*target, None)], "doc_id long")).collect()
    want = sorted(brute(docs.collect(), target, size), key=lambda r: (str(r[0]), r[1], r[2]))
    got = sorted(found, key=lambda r: (str(r.doc_id), r.n_tokens, r.target_loss))
    for r, (doc, n, aimed, background) in zip(got, want, strict=True):
        assert (r.doc_id, r.n_tokens) == (doc, n)
        assert (r.target_loss, r.background_loss) == pytest.approx((aimed, background), rel=1e-4)
        assert r.score == pytest.approx(aimed - background, abs=1e-4)


@pytest.mark.parametrize("common", [0, 30])
def test_blocks_places_and_flushes_change_nothing(spark, documents, odd, monkeypatch, common):
    """Small blocks, several places for a common token, pairs scored in the scan, sums handed on early."""
    small = {"COMMON": common, "LOOKED_AT": 1, "BLOCK_PAIRS": 3000, "MOST_ENTRIES": 50, "PART_PAIRS": 4000, "HELD_SUMS": 100, "ADDED": 200, "SCORED": 40, "MOST_TIMES": 1000}
    for name, value in small.items():
        monkeypatch.setattr(lm, name, value)
    for docs in (documents, odd):
        target = {1, 3, 7, 9, 20, 21, 22}
        found = lm.rated(docs.repartition(5), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()
        want = sorted(brute(docs.collect(), target, lm.VOCABULARY), key=lambda r: (str(r[0]), r[1], r[2]))
        got = sorted(found, key=lambda r: (str(r.doc_id), r.n_tokens, r.target_loss))
        for r, (doc, n, aimed, background) in zip(got, want, strict=True):
            assert (r.doc_id, r.n_tokens) == (doc, n)
            assert (r.target_loss, r.background_loss) == pytest.approx((aimed, background), rel=1e-9)


@given(st.binary(min_size=1, max_size=20))
def test_shapes(word):
    assert 0 <= lm.shape(word) < lm.SHAPES


def test_models_are_distributions():
    size = 60
    counts = np.random.default_rng(1).integers(0, 5, size * size)
    assert np.exp(-lm.losses(counts, size).reshape(size, size)).sum(axis=1) == pytest.approx(np.ones(size), abs=1e-4)


def test_good_documents_score_lower(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    learnt = labels.filter("quality = 1 and doc_id % 2 = 0")
    unseen = lm.rated(docs, learnt).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    good, bad = ([r.score for r in unseen if r.quality == q] for q in (1, 0))
    assert np.mean([g < b for g in good for b in bad]) > 0.9


def test_less_common_words_tell_documents_apart(spark):
    """Whatever the number of words: those that only the target has, and others of the same shape."""
    common = " ".join(f"{a}{b}{c}" for a in "bcdfghjklmnp" for b in "aeiouy" for c in "bcdfghjklmnpqrstvwxz" for _ in range(2))
    rows = [(i, f"{common} {'zab zeb' if i < 5 else 'zib zob'}") for i in range(10)] + [(10, common), (11, "zab zeb"), (12, "zib zob")]
    docs = spark.createDataFrame(rows * 2, "doc_id long, text string")
    found = lm.rated(docs, spark.createDataFrame([(i,) for i in range(5)], "doc_id long"))
    scores = {r.doc_id: r.score for r in found.collect()}
    assert found.count() == len(rows) * 2
    assert scores[11] < scores[12] - 1


def test_models_are_not_collected(spark, documents):
    models = lm.fit(documents.withColumn("target", documents["doc_id"] % 2 == 0))
    words = {w for r in documents.collect() for w in (r.text or "").split()}
    assert models.known is None and models.shares.count() > len(words) > lm.SHAPES


def test_empty_tables(spark, none, odd):
    labels = spark.createDataFrame([], "doc_id long")
    assert lm.rated(none, labels).count() == 0
    assert lm.rated(odd, labels).count() == odd.count()
