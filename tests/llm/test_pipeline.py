"""Each stage against brute force on its own input, and all of them together."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from windrow.llm import quality
from windrow.llm.shared import new_folder, written
from windrow.session import names_in
from tests.llm.test_mixing import brute_targets
from tests.llm.test_simhash import brute_components, brute_mark

FOLDER = "/root/testdata/sf0.001"


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def whole(rows):
    return Counter(tuple(r) for r in rows)


@pytest.fixture(scope="module", params=["documents", "odd"])
def stages(request, spark):
    docs = request.getfixturevalue(request.param)
    found = [docs]
    for _, stage in pipeline.STAGES:
        found.append(written(stage(spark, found[-1], FOLDER)))
    return [df.collect() for df in found], [df.columns for df in found], docs


def test_columns(stages):
    _, columns, docs = stages
    assert all(c == docs.columns for c in columns[:-1])


def test_quality(stages, spark):
    (docs, good, *_), _, table = stages
    model = quality.learn(table, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert whole(good) == whole(r for r in docs if model.score((r.text or "").encode()) >= 0.7)


def test_exact(stages):
    (_, docs, kept, *_), _, _ = stages
    assert not whole(kept) - whole(docs)
    best = {}
    for r in docs:
        best[lower(r.text)] = max(best.get(lower(r.text), -1), -1 if r.doc_id is None else r.doc_id)
    assert Counter((lower(r.text), -1 if r.doc_id is None else r.doc_id) for r in kept) == Counter(best.items())


def test_near(stages):
    (_, _, docs, kept, *_), _, _ = stages
    assert not whole(kept) - whole(docs)
    groups = brute_components([brute_mark(r.text) for r in docs])
    least = defaultdict(list)
    for r in docs:
        least[groups[brute_mark(r.text)]].append(r.doc_id)
    want = Counter(min((i for i in ids if i is not None), default=None) for ids in least.values())
    assert Counter(r.doc_id for r in kept) == want


def test_mix(stages):
    (*_, docs, mixed, _), _, _ = stages
    size = lambda r: len((r.text or "").encode().split())
    sizes, largest, got = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in docs:
        sizes[r.source] += size(r)
        largest[r.source] = max(largest[r.source], size(r))
    for r in mixed:
        got[r.source] += size(r)
    for source, target in brute_targets(sizes).items():
        assert abs(got[source] - target) <= largest[source]
    assert whole(docs).keys() >= whole(mixed).keys() and max(whole(mixed).values(), default=0) <= 3


def test_pack(stages):
    (*_, docs, packed), _, _ = stages
    tokenizer = Tokenizer.from_file(public_tokenizers.path(pipeline.TOKENIZER))
    want = Counter()
    for r in docs:
        ids = np.array([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4")
        for at in range(0, len(ids), 2048):
            want[r.doc_id, at // 2048, at, len(ids[at : at + 2048]), zlib.crc32(ids[at : at + 2048].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    bins = defaultdict(list)
    for r in packed:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 2048


def test_run(spark):
    folder = new_folder(spark).rsplit("/", 1)[0]
    before = [n for n in names_in(spark, folder) if n.startswith("table-")]
    found = pipeline.run(spark, FOLDER)
    assert [n for n in names_in(spark, folder) if n.startswith("table-")] == before  # the stages' tables are gone
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and not found.isEmpty()


def test_no_documents(spark, none):
    docs = none
    for _, stage in pipeline.STAGES:
        docs = written(stage(spark, docs, FOLDER))
        assert docs.count() == 0
