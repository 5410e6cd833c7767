from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from windrow.llm import exact, quotient


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40), max_size=30), max_size=5), st.sampled_from([0, 1, 6]))
def test_filters_merge_losslessly(parts, block_bits):
    want, filters = Counter(), defaultdict(list)
    for part in parts:
        want.update(part)
        for block, kept in quotient.split(block_bits, *np.unique(np.array(part, np.uint64), return_counts=True)):
            filters[block].append(kept)
    got = Counter()
    for block, some in filters.items():
        fingerprints, counts = quotient.merge(block_bits, block, some)
        assert list(fingerprints) == sorted(set(fingerprints.tolist()))
        again = quotient.read(block_bits, block, quotient.build(block_bits, fingerprints, counts))
        assert again[0].tolist() == fingerprints.tolist() and again[1].tolist() == counts.tolist()
        got.update(dict(zip(fingerprints.tolist(), counts.tolist(), strict=True)))
    assert got == want


@pytest.mark.parametrize("rows", [10**5, 10**6, 10**8, 10**10, 2 * 10**10])
def test_filters_stay_small_at_any_size(rows):
    sources = max(32, rows // 25_000)
    levels = quotient.tree(rows, sources, exact.BLOCK_ROWS, exact.FAN, exact.LEAST_BITS)
    assert len(levels) == (1 if sources <= exact.FAN else 2)
    rng, held, of = np.random.default_rng(1), rows / sources, sources
    for k, level in enumerate(levels):
        meeting = min(exact.FAN, of)
        assert meeting <= level.fan and held * meeting / 2**level.bits <= exact.BLOCK_ROWS  # what one merge holds
        sample = np.unique(rng.integers(0, 2**64, max(1, round(held * min(1, 200_000 / held))), np.uint64))
        # as many blocks as leave each of the sample's filters what it would hold of all
        bits = max(0, level.bits - round(np.log2(max(1, held / len(sample)))))
        some = [f for _, f in quotient.split(bits, sample, np.ones(len(sample), np.int64))]
        if k or rows > 10**6:
            assert len(some) * 20 <= len(sample)  # so that what a row of a filter costs beside its bytes is spread
        assert sum(len(f.occupied) + len(f.run_ends) + len(f.remainders) + len(f.counts) for f in some) <= 11 * len(sample)
        held, of = held * meeting, -(-of // level.fan)
    assert of == 1


@pytest.mark.parametrize("fan", [2, 3])
def test_filters_merged_in_a_tree(spark, fan):
    docs = spark.range(0, 4000, 1, 11).selectExpr("id as doc_id", "concat('text ', if(id % 3 = 0, 7, id % 1500)) as text")
    digest = exact.digests(docs).persist()
    want = {r.fingerprint: r["count"] for r in digest.groupBy("fingerprint").count().filter("count > 1").collect()}
    assert {r.fingerprint: r.times for r in exact.repeated_fingerprints(digest, 4000, fan).collect()} == want
    assert len(quotient.tree(4000, 11, exact.BLOCK_ROWS, fan, 6)) == {2: 4, 3: 3}[fan]


def brute(rows):
    groups = defaultdict(list)
    for r in rows:
        groups["".join(c.lower() if c.isascii() else c for c in r.text or "")].append(r)
    order = lambda i: -1 if i is None else i
    return Counter((r.doc_id, max((x.doc_id for x in g), key=order), len(g)) for g in groups.values() for r in g)


@pytest.mark.parametrize("bits", [64, 4])  # 4: most fingerprints clash, and bytes must tell texts apart
@pytest.mark.parametrize("which", ["odd", "documents"])
def test_same_as_brute_force(request, which, bits):
    docs = request.getfixturevalue(which)
    found = exact.duplicates(docs, bits=bits).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size) for r in found) == brute(docs.collect())
    kept = [r for r in found if r.kept]
    assert len(kept) == len({r.text_sha256 for r in found})
    assert len({r.text_sha256 for r in kept}) == len(kept) and all(r.doc_id == r.keep_id for r in kept)


def test_kept_rows_have_all_columns(odd, none):
    kept = exact.deduplicated(odd)
    assert kept.columns == odd.columns
    texts = ["".join(c.lower() if c.isascii() else c for c in r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({"".join(c.lower() if c.isascii() else c for c in r.text or "") for r in odd.collect()})
    assert exact.deduplicated(none).columns == none.columns
    assert exact.deduplicated(none).count() == exact.duplicates(none).count() == 0


def test_many_copies(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the SAME text', concat('text ', id)) as text")
    found = exact.duplicates(docs).filter("group_size > 1").collect()
    assert {(r.keep_id, r.group_size) for r in found} == {(2997, 1000)} and sum(r.kept for r in found) == 1


def test_clashing_names(odd, clashing):
    out = exact.deduplicated(clashing)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select(odd.columns).collect())) == sorted(map(str, exact.deduplicated(odd).collect()))
