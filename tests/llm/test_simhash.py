from collections import defaultdict

import numpy as np
import pytest
import xxhash

from windrow.llm import components, golay, simhash


def brute_mark(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(marks, bits=4):
    left, label = set(marks), {}
    while left:
        front = [left.pop()]
        group = set(front)
        while front:
            one = front.pop()
            near = {x for x in left if (x ^ one).bit_count() <= bits}
            left -= near
            group |= near
            front.extend(near)
        label.update((x, frozenset(group)) for x in group)
    return label


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_same_as_brute_force(request, which):
    docs = request.getfixturevalue(which).select("doc_id", "text").collect()
    marks = [brute_mark(r.text) for r in docs]
    groups, ids = brute_components(marks), defaultdict(list)
    for r, m in zip(docs, marks, strict=True):
        ids[groups[m]].append(r.doc_id)
    want = sorted(((r.doc_id, m, min((i for i in ids[groups[m]] if i is not None), default=None)) for r, m in zip(docs, marks, strict=True)), key=str)
    found = simhash.near_duplicates(request.getfixturevalue(which)).collect()
    assert sorted(((r.doc_id, r.fingerprint % 2**64, r.component) for r in found), key=str) == want


def test_golay_code_is_perfect():
    table = golay.nearest()
    assert (np.bincount(table) == 2048).all()


@pytest.mark.parametrize("bits", range(5))
def test_keys_are_shared_within_the_distance(bits):
    rng = np.random.default_rng(bits)
    a = rng.integers(0, 2**64, 3000, np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, bits, replace=False):
            b[i] ^= np.uint64(1 << int(bit))
    of = lambda marks: (lambda k, p: [set(k[p == i].tolist()) for i in range(40)])(*simhash.fuzzy_keys(marks[:40]))
    assert all(x & y for x, y in zip(of(a), of(b), strict=True))


def test_chains_link_through_others(spark):
    """Random clusters in which neighbours are four bits apart and ends are far apart."""
    rng, marks = np.random.default_rng(3), []
    for _ in range(30):
        one = int(rng.integers(0, 2**64, dtype=np.uint64))
        for _ in range(12):
            marks.append(one)
            for bit in rng.choice(64, 4, replace=False):
                one ^= 1 << int(bit)
    rows = [(int(np.uint64(m).astype(np.int64)),) for m in marks]
    df = spark.createDataFrame(rows, "fingerprint long").distinct()
    got = defaultdict(set)
    for r in components.components(simhash.links(df)).collect():
        got[r.root].add(r.node % 2**64)
    want = {g for g in brute_components(marks).values() if len(g) > 1}
    assert {frozenset(g) for g in got.values()} == want


def test_one_large_cluster(spark):
    """Thousands of fingerprints around one: links stay in proportion, nothing is lost."""
    rng = np.random.default_rng(5)
    marks = {0x123456789ABCDEF0 ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (4000, 2))}
    df = spark.createDataFrame([(int(np.uint64(m).astype(np.int64)),) for m in marks], "fingerprint long")
    found = simhash.links(df)
    assert found.count() < 200 * len(marks)
    assert components.components(found).groupBy("root").count().collect()[0]["count"] == len(marks)


def test_rows_that_stay(odd, documents, none):
    for docs in (odd, documents):
        found, kept = simhash.near_duplicates(docs).collect(), simhash.deduplicated(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({r.keep for r in found})
    assert simhash.deduplicated(none).count() == simhash.near_duplicates(none).count() == 0


def test_clashing_names(odd, clashing):
    out = simhash.deduplicated(clashing, shingle_words=4, most_bits=4)
    assert out.columns == clashing.columns
    assert sorted(map(str, out.select(odd.columns).collect())) == sorted(map(str, simhash.deduplicated(odd, shingle_words=4, most_bits=4).collect()))
