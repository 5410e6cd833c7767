"""Prefix trie of conversations: grouped by digests of blocks of turns, refined to turns where blocks diverge."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from windrow.llm.shared import checkpointed, mapped, sized
from windrow.operators.chunks import with_chunks
from windrow.operators.heavy import heaviest

#: Turns of a block.
BLOCK = 4
#: Blocks, or runs of runs, that are chained within one row.
FAN = 64
#: Conversations that share turns with the first of their number.
FAMILY = 100
#: A conversation inherits fewer turns than this.
MOST_INHERITED = 6
#: Conversations of more turns are numbered in chunks.
HEAVY_TURNS = 100_000
#: Conversation ids whose list is put together by one task: two to this power.
ID_BITS = 12

#: The name of the empty prefix.
ROOT = b""
_FIRST_TURN = -(2**63)


def _digest(data: Column) -> Column:
    return F.unhex(F.sha2(data, 256))


def _chain(start: Column, links: Column) -> Column:
    """``start`` and then, for each link, the digest of all before it and of itself."""
    return F.aggregate(links, F.array(start), lambda done, link: F.concat(done, F.array(_digest(F.concat(F.element_at(done, -1), link)))))


def inherited_turns(conv: Column) -> Column:
    return (F.crc32(conv.cast("string").cast("binary")) % MOST_INHERITED).cast("int")


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, digest and length of each row: nothing later reads a text."""
    who, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    content = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, said)
    return conversations.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.coalesce(F.col(turn).cast("long"), F.lit(_FIRST_TURN)).alias("turn"),
        _digest(content.cast("binary")).alias("digest"),
        F.length(said).cast("long").alias("length"),
    )


def numbered(turns: DataFrame, heavy_turns: int = HEAVY_TURNS) -> DataFrame:
    """``turns`` with ``pos``, from 0 within each conversation, by turn and then by digest.

    A conversation is sorted by one task unless it is heavy: then its order is cut into chunks that
    are sorted apart.
    """
    heavy = checkpointed(heaviest(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("n")), ["conv"], "n", heavy_turns).select("conv"), narrow=True)
    order = ["turn", "digest"]
    leading = F.conv(F.substring(F.hex("digest"), 1, 14), 16, 10).cast("long")
    whole = Window.partitionBy("conv").orderBy(*order)
    if heavy.isEmpty():
        return turns.withColumn("pos", F.row_number().over(whole) - 1).drop("turn")
    light = turns.join(F.broadcast(heavy), "conv", "left_anti").withColumn("pos", F.row_number().over(whole) - 1)
    cut = checkpointed(with_chunks(turns.join(F.broadcast(heavy), "conv"), F.col("turn"), leading))
    counted = cut.groupBy("conv", "chunk").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select("conv", "chunk", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("conv", "chunk").orderBy(*order)
    placed = cut.withColumn("at", F.row_number().over(inside) - 1).join(sized(checkpointed(starts, narrow=True)), ["conv", "chunk"])
    return light.drop("turn").unionByName(placed.select("conv", "digest", "length", (F.col("start") + F.col("at")).alias("pos")))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, pos, digest, length) of the rebuilt conversations, and the ids of all.

    Each begins with the first turns of the first conversation of its hundred, as many as its id says,
    and goes on with its own turns after as many.
    """
    base, h = F.col("conv") - F.col("conv") % FAMILY, inherited_turns(F.col("conv"))
    convs = turns.select("conv").distinct()
    first = turns.filter((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST_INHERITED - 1))
    heads = first.groupBy(F.col("conv").alias("of")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "length"))).alias("head"))
    heads = sized(checkpointed(heads, narrow=True))
    given = convs.join(heads, base == F.col("of")).select("conv", F.explode(F.slice("head", 1, h)).alias("t")).select("conv", "t.pos", "t.digest", "t.length")
    taken = F.least(h, F.coalesce(F.size("head"), F.lit(0)))
    own = turns.filter(F.col("pos") >= h).join(heads, base == F.col("of"), "left")
    return given.unionByName(own.select("conv", (F.col("pos") - h + F.greatest(taken, F.lit(0))).alias("pos"), "digest", "length")), convs


def _prefixes(units: DataFrame, fan: int) -> DataFrame:
    """``units`` (conv, at, unit; unit null unless whole) with ``before`` and ``after``: names of the
    sequences of a conversation's units up to each.  Equal names are equal sequences.

    Units are chained within runs of ``fan``, which start from the name of all runs before them: whole
    runs are the units of the next level.  So no row holds more than a run, however long a conversation.
    """
    most = units.agg(F.max("at")).first()[0] or 0
    more = [c for c in units.columns if c not in ("conv", "at", "unit")]
    runs = units.groupBy("conv", F.floor(F.col("at") / fan).alias("run")).agg(F.sort_array(F.collect_list(F.struct("at", "unit", *more))).alias("units"))
    runs = runs.withColumn("links", F.transform(F.filter("units", lambda u: u["unit"].isNotNull()), lambda u: u["unit"]))
    if most < fan:
        runs = runs.withColumn("start", F.lit(ROOT)).withColumn("end", F.lit(None).cast("binary"))
    else:
        runs = checkpointed(runs)
        whole = F.when(F.size("links") == fan, _digest(F.aggregate("links", F.lit(b""), lambda done, link: F.concat(done, link))))
        above = _prefixes(runs.select("conv", F.col("run").alias("at"), whole.alias("unit")), fan)
        runs = runs.join(above.select("conv", F.col("at").alias("run"), F.col("before").alias("start"), F.col("after").alias("end")), ["conv", "run"])
    chained = runs.withColumn("chain", _chain(F.col("start"), F.col("links")))
    one = chained.select("conv", "chain", "end", F.posexplode("units").alias("i", "u"))
    after = F.when(F.col("u.unit").isNotNull(), F.when(F.col("i") == fan - 1, F.coalesce("end", F.element_at("chain", F.col("i") + 2))).otherwise(F.element_at("chain", F.col("i") + 2)))
    return one.select("conv", "u.at", *(f"u.{c}" for c in more), F.element_at("chain", F.col("i") + 1).alias("before"), after.alias("after"))


def blocks(turns: DataFrame, block: int = BLOCK, fan: int = FAN) -> DataFrame:
    """Per conversation and block: conv, at (from 0), turns, before and after (names of the prefixes
    that the block follows and, if it is whole, ends)."""
    at = F.floor(F.col("pos") / block)
    rows = turns.groupBy("conv", at.alias("at")).agg(F.sort_array(F.collect_list(F.struct("pos", "digest", "length"))).alias("turns"))
    content = F.aggregate("turns", F.lit(b""), lambda done, t: F.concat(done, t["digest"]))
    return _prefixes(rows.withColumn("unit", F.when(F.size("turns") == block, _digest(content))), fan)


def _path(block: int) -> Column:
    """Names of a block's prefixes, turn by turn; that of a whole block is the one its followers start from."""
    chain = _chain(F.col("before"), F.transform("turns", lambda t: t["digest"]))
    inner = F.slice(chain, 2, F.size("turns"))
    return F.when(F.size("turns") == block, F.concat(F.slice(inner, 1, block - 1), F.array("after"))).otherwise(inner)


def nodes(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """The trie without its root: node, up (parent), before (where its block starts), depth, place in the
    block (from 1), members, least (member), length of the last turn, path (nodes of the block down to it).

    ``rows`` are :func:`blocks`.  Conversations meet by whole blocks, each different one of which is a row
    with a count.  Where all that go on from a prefix go on with one block, its turns are a chain with the
    same members; only where blocks differ are they taken apart, and grouped again by turn.
    """
    content = F.aggregate("turns", F.lit(b""), lambda done, t: F.concat(done, t["digest"]))
    distinct = (
        rows.groupBy("at", "before", _digest(content).alias("unit"))
        .agg(F.count(F.lit(1)).alias("members"), F.min("conv").alias("least"), F.first("turns").alias("turns"), F.first("after").alias("after"))
        .withColumn("path", _path(block))
    )
    distinct = checkpointed(distinct.select("at", "before", "members", "least", "path", F.transform("turns", lambda t: t["length"]).alias("lengths")))
    split = distinct.groupBy(F.col("before").alias("apart")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("apart")
    marked = distinct.join(sized(checkpointed(split, narrow=True)), F.col("before") == F.col("apart"), "left")
    by_turn = marked.select("apart", "at", "before", "members", "least", "path", F.posexplode("lengths").alias("i", "length")).select(
        "apart",
        F.element_at("path", F.col("i") + 1).alias("node"),
        F.when(F.col("i") == 0, F.col("before")).otherwise(F.try_element_at("path", F.col("i"))).alias("up"),
        "before",
        (F.col("at") * block + F.col("i") + 1).alias("depth"),
        (F.col("i") + 1).alias("place"),
        "members",
        "least",
        "length",
        F.slice("path", 1, F.col("i") + 1).alias("path"),
    )
    by_turn = checkpointed(by_turn)
    chains = by_turn.filter("apart IS NULL").drop("apart")
    met = (
        by_turn.filter("apart IS NOT NULL")
        .groupBy("node", "up", "before", "depth", "place")
        .agg(F.sum("members").alias("members"), F.min("least").alias("least"), F.first("length").alias("length"), F.first("path").alias("path"))
    )
    return chains.unionByName(met)


def _below(trie: DataFrame, block: int) -> DataFrame:
    """Per prefix at which blocks start: name, leaves and saved, summed over all nodes below it.

    The sums go up the tree of blocks by doubling: in each round a prefix adds its sum to that of the
    ancestor as far up as the sum reaches down.  Rounds grow as the logarithm of the longest path.
    """
    own = trie.groupBy(F.col("before").alias("name")).agg(F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"))
    up = trie.filter(F.col("place") == block).select(F.col("node").alias("name"), F.col("before").alias("over"))
    state = checkpointed(own.join(up, "name", "left"), narrow=True)
    while not state.filter("over IS NOT NULL").isEmpty():
        given = state.filter("over IS NOT NULL").groupBy(F.col("over").alias("name")).agg(F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
        # what has reached the root is done; only the rest asks for a higher ancestor
        done = F.col("over").isNull() | (F.col("over") == F.lit(ROOT))
        higher = state.select(F.col("name").alias("over"), F.col("over").alias("next"))
        moved = state.filter(~done).join(higher, "over").unionByName(state.filter(done).withColumn("next", F.lit(None).cast("binary")))
        state = checkpointed(
            moved.join(given, "name", "left").select(
                "name",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("next").alias("over"),
            ),
            narrow=True,
        )
    return state.select("name", "leaves", "saved")


def id_digests(ends: DataFrame) -> DataFrame:
    """node, sha256: of the comma-joined ids of ``ends`` (node, conv) in ascending order.

    Lists are put together for spans of ids, in parallel; the digest of a node reads its lists one after
    another, and holds none but the one at hand.
    """
    spans = ends.groupBy("node", F.shiftright("conv", ID_BITS).alias("span")).agg(F.sort_array(F.collect_list("conv")).alias("convs"))
    lists = spans.select("node", "span", F.array_join(F.transform("convs", lambda c: c.cast("string")), ",").alias("ids"))

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state = None, hashlib.sha256()
        for batch in batches:
            done, shas = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if node == at:
                    state.update(b"," + ids.encode())
                    continue
                if at is not None:
                    done.append(at)
                    shas.append(state.hexdigest())
                at, state = node, hashlib.sha256(ids.encode())
            if done:
                yield pa.record_batch([pa.array(done, pa.binary()), pa.array(shas)], names=["node", "sha256"])
        if at is not None:
            yield pa.record_batch([pa.array([at], pa.binary()), pa.array([state.hexdigest()])], names=["node", "sha256"])

    return mapped(lists.repartition("node").sortWithinPartitions("node", "span"), fold, "node binary, sha256 string")


def trie(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK, fan: int = FAN, heavy_turns: int = HEAVY_TURNS
) -> DataFrame:
    """Per node of the prefix trie of the rebuilt conversations: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256.

    A node is a distinct sequence of first turns, by role and text; the root is the empty one.  Turns go by
    number, null first, and rows of one number by the digest of their content; repeated rows are turns of their own.
    Null role and text are empty.  Rows without a conversation id belong to none and are left out; a
    conversation without turns after rebuilding is a member of the root.  An empty table has no
    nodes.  Other columns are not read.  Names of nodes are SHA-256 chains, so equal ones are equal
    sequences.
    """
    # texts are read once, and numbers given once
    turns = checkpointed(numbered(checkpointed(_turns(conversations, conv, turn, role, text)), heavy_turns))
    together, convs = rebuilt(turns)
    rows = checkpointed(blocks(together, block, fan))
    found = checkpointed(nodes(rows, block))

    last = rows.groupBy("conv").agg(F.max_by(F.struct("before", "after", "turns"), "at").alias("b")).select("conv", "b.before", "b.after", "b.turns")
    last = last.select(F.col("conv").alias("of"), F.element_at(_path(block), -1).alias("node"))
    ends = convs.join(last, F.col("conv") == F.col("of"), "left").select("conv", F.coalesce("node", F.lit(ROOT)).alias("node"))
    digests = id_digests(ends)

    children = found.groupBy(F.col("up").alias("of")).agg(F.count(F.lit(1)).alias("n_children"))
    counted = found.join(children, F.col("node") == F.col("of"), "left").drop("of").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    counted = checkpointed(
        counted.withColumn("leaf", (F.col("n_children") == 0).cast("long")).withColumn("saved", (F.col("members") - 1) * F.col("length"))
    )
    below = checkpointed(_below(counted, block), narrow=True)
    # a node hands its own part, and what lies below its block, to all nodes of the block above it
    under = below.select(F.col("name").alias("of"), F.col("leaves").alias("below_leaves"), F.col("saved").alias("below_saved"))
    parts = counted.join(under, (F.col("node") == F.col("of")) & (F.col("place") == block), "left").select(
        F.explode("path").alias("node"),
        (F.col("leaf") + F.coalesce("below_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("below_saved", F.lit(0))).alias("saved_below"),
    )
    sums = parts.groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved_below").alias("saved_tokens"))
    parents = counted.select(F.col("node").alias("of"), F.col("least").alias("parent_conv_id"))
    inner = counted.filter(F.col("up") != F.lit(ROOT)).join(parents, F.col("up") == F.col("of")).drop("of")
    root = convs.agg(F.min("conv").alias("least"), F.count(F.lit(1)).alias("members")).first()
    n_first = counted.filter(F.col("up") == F.lit(ROOT)).count()
    top = below.filter(F.col("name") == F.lit(ROOT)).first()
    outer = counted.filter(F.col("up") == F.lit(ROOT)).withColumn("parent_conv_id", F.lit(root["least"]).cast("long"))
    columns = ["node", "least", "depth", "parent_conv_id", "members", "n_children", "n_leaves", "saved_tokens"]
    all_nodes = inner.unionByName(outer).join(sums, "node").select(*columns)
    if root["members"]:
        values = (bytearray(ROOT), root["least"], 0, None, root["members"], n_first, top["leaves"] if top else 1, top["saved"] if top else 0)
        kinds = ("binary", "long", "long", "long", "long", "long", "long", "long")
        all_nodes = all_nodes.unionByName(conversations.sparkSession.createDataFrame([values], ", ".join(f"{c} {k}" for c, k in zip(columns, kinds))))
    empty = hashlib.sha256().hexdigest()
    return all_nodes.join(digests, "node", "left").select(
        F.col("least").alias("conv_id"),
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        F.col("members").cast("long").alias("n_convs"),
        F.col("n_children").cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("sha256", F.lit(empty)).alias("ends_sha256"),
    )
