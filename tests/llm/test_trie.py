import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest

from windrow.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The trie with every sequence held whole."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    said = {}
    for c, turns in own.items():
        turns.sort()
        h = zlib.crc32(str(c).encode()) % 6
        base = sorted(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), []))
        said[c] = [t[3:] for t in base[:h] + turns[h:]]
    members = defaultdict(list)
    for c, turns in said.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(convs) if len(said[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), up, len(convs), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


def found(spark, rows, **how):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS conv", "'x' AS node", "2 AS digest", "3 AS pos", "4 AS chunk").repartition(3)
    out = trie.trie(df, **how)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return Counter(map(tuple, out.collect()))


ODD = [
    (0, None, "user", "before all"),
    (0, 1, None, "hello"),
    (0, 1, "user", None),
    (0, 2, "user", "É " * 5000),
    (0, 2, "user", "É " * 5000),
    (0, 3, "", ""),
    (0, 3, None, None),
    (1, 0, "user", "hello"),
    (1, None, "user", "hello"),
    (2, 7, "a", "b"),
    (100, 0, "a", "bc"),
    (101, 0, "ab", "c"),
    (205, 0, "no", "base"),
    (205, 1, "no", "base"),
    (205, 2, "no", "base"),
    (None, 1, "of", "none"),
    (-5, 1, "below", "zero"),
    (2**62, 1, "large", "id"),
]


def test_odd_rows(spark):
    assert found(spark, ODD) == brute(ODD)


def test_empty_tables(spark):
    assert found(spark, []) == Counter()
    assert found(spark, [(None, 1, "a", "b")]) == Counter()


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    bare = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 > 2)
    rows = [(bare, 0, "a", "b"), (bare, 1, "a", "c")]
    assert found(spark, rows) == brute(rows) == Counter([(bare, 0, None, 1, 0, 1, 0, hashlib.sha256(str(bare).encode()).hexdigest())])


@pytest.mark.parametrize("block, fan, heavy", [(4, 64, 100_000), (1, 2, 5), (3, 4, 30)])
def test_random_conversations(spark, block, fan, heavy):
    """Long ones, copies, shared prefixes that end within blocks, and as many levels of runs as it takes."""
    rng = random.Random(block)
    rows = []
    for c in list(range(0, 60)) + list(range(100, 130)):
        n = rng.choice([0, 1, 2, 3, 5, 8, 9, 40])
        rows += [(c, t, "user", rng.choice("ab") if t > 6 else "x") for t in range(n)]
    assert found(spark, rows, block=block, fan=fan, heavy_turns=heavy) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rows = [(300, t, "user", f"turn {t % 7}") for t in range(1500)] + [(c, t, "user", f"turn {t % 7}") for c in range(301, 340) for t in range(12)]
    rows += [(400, None, "user", f"no number {t % 40}") for t in range(700)]
    assert found(spark, rows, heavy_turns=100) == brute(rows)


def test_id_lists_are_joined_in_order_over_spans(spark):
    ids = [x * 1000 - 20_000 for x in range(50)] + [9, 10, 100]
    df = spark.createDataFrame([(bytearray(b"n"), i) for i in reversed(ids)] + [(bytearray(b"m"), 7)], "node binary, conv long").repartition(4)
    want = {b"n": ",".join(map(str, sorted(ids))), b"m": "7"}
    got = {bytes(r.node): r.sha256 for r in trie.id_digests(df).collect()}
    assert got == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


def test_given_table(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(spark, rows) == brute(rows)
