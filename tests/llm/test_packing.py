import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from windrow.llm import packing
from windrow.llm.tokens import PlainTokens, WordTokens, of_word_kind, tokens_of

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN, WORDS = Tokenizer.from_file(PATH), WordTokens(PATH)


def brute(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


@settings(max_examples=300, deadline=None)
@given(st.text() | st.lists(st.sampled_from(["It's", "THE!!", "É", "ß,", "...", "a.b", "<|endoftext|>", "x'LL", " ", "é", "7%", "İ", "Straße.", "|", "\x1c"])).map(" ".join))
def test_ids_are_the_tokenizers(text):
    assert np.frombuffer(WORDS.encode(text.encode("utf-8", "ignore")), "<u4").tolist() == brute(text.encode("utf-8", "ignore").decode())[:-1]


def test_other_tokenizers(odd, tmp_path):
    path = public_tokenizers.path("byte_bpe_50k.json")
    assert not of_word_kind(path) and isinstance(tokens_of(path), PlainTokens) and isinstance(tokens_of(PATH), WordTokens)
    with pytest.raises(ValueError, match="word kind"):
        WordTokens(path)
    plain = Tokenizer.from_file(path)
    want = sorted((r.doc_id or -1, [*plain.encode(r.text or "", add_special_tokens=False).ids, 0]) for r in odd.collect())
    got = defaultdict(list)
    pieces = packing.token_pieces(odd.filter("doc_id is null or doc_id not in (3, 9)"), path).collect()
    for r in sorted(pieces, key=lambda r: (r.doc_id or -1, r.start)):
        got[r.doc_id or -1].extend(np.array(r.ids, "<u4").tolist())
    assert {k: v for k, v in got.items() if k > 0} == {k: v for k, v in want if k not in (-1, 3, 9)}
    # a file that asks for texts to be cut short is read without that
    short = json.loads(open(PATH).read()) | {"truncation": {"max_length": 2, "stride": 0, "strategy": "LongestFirst", "direction": "Right"}}
    (tmp_path / "short.json").write_text(json.dumps(short))
    assert tokens_of(str(tmp_path / "short.json")).encode(b"one's, two three") == WORDS.encode(b"one's, two three")


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_pieces_and_places(request, which):
    docs = request.getfixturevalue(which)
    pieces = packing.token_pieces(docs, PATH)
    assert pieces.columns[0] == "doc_id"
    found = packing.packed(pieces).collect()
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r.doc_id].append(brute(r.text))
    got = defaultdict(list)
    for r in found:
        assert r.piece == r.start // 2048 and r.length == len(r.ids) <= 2048
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        got[r.doc_id].append((r.start, r.ids))
    for doc, want in texts.items():
        cut = [(i, ids[i : i + 2048]) for ids in want for i in range(0, len(ids), 2048)]
        assert sorted(cut) == sorted((s, list(i)) for s, i in got.pop(doc))
    assert not got
    by_bin = defaultdict(list)
    for r in found:
        by_bin[r.sequence_id].append((r.offset, r.length, r.filled))
    for parts in by_bin.values():
        at = 0
        for offset, length, filled in sorted(parts):
            assert offset == at and filled == sum(x[1] for x in parts) <= 2048
            at += length
    # best fit leaves no two sequences that fit in one, and comes close to the least number
    total = sum(r.length for r in found)
    least = -(-total // 2048)
    assert len(by_bin) <= 1.02 * least + 1


def test_rounds_join_what_tasks_leave_open(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_ROWS", 100)
    items = spark.range(3000).selectExpr("id", "700 + id % 3 as length").repartition(50)
    found = packing.packed(items).collect()
    assert sorted(r.id for r in found) == list(range(3000))
    assert 1500 <= len({r.sequence_id for r in found}) <= 1515  # two of 700 each


def test_columns_of_the_same_names_are_replaced(spark):
    items = spark.range(10).selectExpr("id", "1000L as length", "'x' as offset", "1 as sequence_id")
    found = packing.packed(items)
    assert found.columns == ["id", "length", "sequence_id", "offset", "filled"] and {r.offset for r in found.collect()} == {0, 1000}


def test_sizes_that_never_fit_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROUND_ROWS", 100)
    found = packing.packed(spark.range(1000).selectExpr("id", "1100L as length")).collect()
    assert len({r.sequence_id for r in found}) == 1000 and {r.offset for r in found} == {0}


def test_sequences_hold_the_ids_in_order(documents, none):
    placed = packing.packed(packing.token_pieces(documents, PATH))
    rows = packing.sequences(placed).collect()
    assert sum(len(r.ids) for r in rows) == sum(len(brute(d.text)) for d in documents.collect())
    for r in rows[:20]:
        assert len(r.ids) == sum(p.length for p in r.pieces) and [p.offset for p in r.pieces] == sorted(p.offset for p in r.pieces)
    assert packing.packed(packing.token_pieces(none, PATH)).count() == 0


@given(st.lists(st.integers(1, 50), max_size=60))
def test_best_fit(sizes):
    bins, places = packing.best_fit(np.array(sizes, np.int64), 50)
    for b in set(bins.tolist()):
        assert sum(s for s, x in zip(sizes, bins, strict=True) if x == b) <= 50
    filled = sorted(sum(s for s, x in zip(sizes, bins, strict=True) if x == b) for b in set(bins.tolist()))
    assert len(filled) < 2 or filled[0] + filled[1] > 50
