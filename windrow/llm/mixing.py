"""Mixing sources to target weights by distributed prefix sums over hash-random keys.

Everything is DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from windrow.llm.shared import checkpointed, fresh, sized

#: A source is taken at most so many times over.
MOST_EPOCHS = 3
#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (1, 2, 3)
#: A source's keys are cut into so many ranges at least, else into the square root of all rows: then
#: neither the rows of a range nor the ranges of a source are many.
LEAST_RANGES = 16
#: A key of more rows than a range has on average, and than this, is cut by the texts' ties as well.
HEAVY_ROWS = 10_000


def words(text: str = "text") -> Column:
    """Number of runs of other characters than ASCII white space; null has none."""
    return F.regexp_count(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def _order_key(key: str) -> Column:
    return F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")))


def tie_of(text: str) -> Column:
    return F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (source, source_size; one row per source) with ``target``.

    All targets add up to all sizes.  They are shared by weight, none above ``epochs`` times its
    source; what is above is shared again among the rest, which ends at one level per unit of
    weight: sources whose limit lies under the level get their limit, the others level times weight.
    In the order of limit per weight that level is the first that no later source falls under.
    """
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), F.pmod(F.col("place"), F.lit(len(weights))) + 1).cast("long")
    # these windows are over one row per source
    named = Window.orderBy(F.col("source").asc_nulls_last())
    per_weight = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    upto, everything = per_weight.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    none = F.lit(0).cast("long")
    ranked = (
        sizes.withColumn("place", F.row_number().over(named) - 1)
        .withColumn("weight", weight)
        .withColumn("limit", F.lit(epochs) * F.col("source_size"))
        .withColumn("left", F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(upto), none))
        .withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(upto), none))
        .withColumn("holds", F.col("left") * F.col("weight") <= F.col("limit") * F.col("left_weight"))
        .withColumn("level_left", F.min(F.when(F.col("holds"), F.struct(F.col("limit") / F.col("weight"), F.col("source").isNull(), "source", "left", "left_weight"))).over(everything))
    )
    level = F.col("level_left.left").cast("double") / F.col("level_left.left_weight")
    target = F.when(F.col("limit") / F.col("weight") <= level, F.col("limit").cast("double")).otherwise(level * F.col("weight"))
    return ranked.select("source", "source_size", F.when(F.col("level_left").isNull(), F.col("limit").cast("double")).otherwise(target).alias("target"))


def _heavy(rows: DataFrame, ranges: int, most: int) -> DataFrame:
    """at_range, heavy: the keys of more than ``most`` rows by the range they lie in, each with its number
    of cuts and those of its ties that have more than ``most`` rows.  They are fewer than all rows / ``most``."""
    counted = rows.groupBy("order_key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    counted = sized(checkpointed(counted.select("order_key", F.ceil(F.col("n") / most).alias("cuts")), narrow=True))
    copies = rows.join(counted.select("order_key"), "order_key", "left_semi").groupBy("order_key", "tie").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    copies = copies.groupBy(F.col("order_key").alias("copied")).agg(F.collect_list("tie").alias("ties"))
    known = counted.join(copies, F.col("order_key") == F.col("copied"), "left")
    one = F.struct("order_key", "cuts", F.coalesce("ties", F.array().cast("array<string>")).alias("ties"))
    return checkpointed(known.select(_range(ranges).alias("at_range"), one.alias("one")).groupBy("at_range").agg(F.collect_list("one").alias("heavy")), narrow=True)


def _leading(name: str) -> Column:
    """The first 32 bits of a number in hexadecimal digits."""
    return F.conv(F.substring(name, 1, 8), 16, 10).cast("long")


def _range(ranges: int) -> Column:
    return F.floor(_leading("order_key") * ranges / F.lit(1 << 32)).cast("int")


def prefix_sums(rows: DataFrame, ranges: int, most: int = HEAVY_ROWS) -> DataFrame:
    """``rows`` (source, order_key, tie, size, and more) with ``before``: sizes of the source's earlier rows.

    Keys and ties are hash-random hexadecimal digits, so equal cuts of their span are balanced ranges: each is
    sorted by one task, sums per range are added up along the source, and no task sees a whole source.
    A key of more than ``most`` rows stands apart from the keys before and after it in its range, and
    is cut by its ties; so does a tie of more than ``most`` rows, and since its rows are all alike, it is cut
    by where they lie.  ``rows`` should be written, for they are read more than once.
    """
    heavy = sized(_heavy(rows, ranges, most))
    met = rows.withColumn("at", _range(ranges)).withColumn("lies", F.spark_partition_id()).join(heavy, F.col("at") == F.col("at_range"), "left")
    earlier = F.size(F.filter("heavy", lambda x: x["order_key"] < F.col("order_key")))
    own = F.try_element_at(F.filter("heavy", lambda x: x["order_key"] == F.col("order_key")), F.lit(1))
    side = F.when(F.col("heavy").isNull(), 0).otherwise(2 * earlier + own.isNotNull().cast("int"))
    inner = F.when(own.isNull(), 0).otherwise(F.floor(_leading("tie") * own["cuts"] / F.lit(1 << 32))).cast("long")
    is_copy = F.coalesce(F.array_contains(own["ties"], F.col("tie")), F.lit(False))
    copied = F.when(own.isNull(), 0).otherwise(2 * F.size(F.filter(own["ties"], lambda t: t < F.col("tie"))) + is_copy.cast("int"))
    lies = F.when(is_copy, F.col("lies")).otherwise(0)
    cut = met.withColumn("range", F.struct(F.col("at"), side.alias("side"), inner.alias("inner"), copied.alias("copied"), lies.alias("lies"))).drop("at", "at_range", "heavy", "lies")
    part = cut.groupBy("source", "range").agg(F.sum("size").alias("range_size"))
    along = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = part.select(
        F.col("source").alias("from_source"), F.col("range").alias("from_range"), F.coalesce(F.sum("range_size").over(along), F.lit(0)).alias("range_before")
    )
    inside = Window.partitionBy("source", "range").orderBy("order_key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    summed = cut.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    at = F.col("source").eqNullSafe(F.col("from_source")) & (F.col("range") == F.col("from_range"))
    return summed.join(starts, at).withColumn("before", F.col("inside") + F.col("range_before")).drop(
        "inside", "range", "from_source", "from_range", "range_before"
    )


def taken(before: Column, size: Column, total: Column, budget: Column) -> Column:
    """Words taken of a row: whole passes over the source, then the words before the cut.

    The passes of a source follow one another; the budget ends within the last one, at a word.
    """
    passes = F.when(total > 0, F.floor(budget / total)).otherwise(0).cast("long")
    return passes * size + F.greatest(F.lit(0), F.least(size, budget - passes * total - before)).cast("long")


def mixed(docs: DataFrame, rows: int, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row of ``docs``: key, tie, size, source_size, target, taken, before.

    A row's place in its source is given by the MD5 of its key, then its text: the same on every
    run.  The mix takes each source's rows in that order up to its target, rounded down to a word,
    passing over the source again where the target is larger.  ``rows`` is the number of rows, which
    sets how finely the keys are cut, never the result.  Null sources are one source, the last;
    rows without words take nothing; an empty table gives no rows.
    """
    narrow = checkpointed(  # words are counted once
        docs.select(
            F.col(key), F.col(source).cast("string").alias("source"), words(text).alias("size"), _order_key(key).alias("order_key"), tie_of(text).alias("tie")
        )
    )
    per_source = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    per_source = per_source.withColumnRenamed("source", "of_source")
    ranges = max(LEAST_RANGES, isqrt(rows))
    ordered = prefix_sums(narrow, ranges, max(HEAVY_ROWS, rows // ranges))
    out = ordered.join(per_source, F.col("source").eqNullSafe(F.col("of_source")))
    budget = F.floor("target")
    return out.withColumn("taken", taken(F.col("before"), F.col("size"), F.col("source_size"), budget)).select(
        key, "source", "order_key", "tie", "size", "source_size", "target", "taken", "before"
    )


def mixed_documents(docs: DataFrame, rows: int, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the mix takes, as often as it takes them, with all their columns.

    Here a row is taken whole or not: the row at the cut is taken if at least half of it lies before
    it.  A source's rows are in the mix up to one place in their order, so one row per source tells
    all; texts are neither shuffled nor sorted.  Rows that share key and text have one place and go
    together.
    """
    decided = mixed(docs, rows, key, text, source)
    passes = F.when(F.col("source_size") > 0, F.floor(F.floor("target") / F.col("source_size"))).otherwise(0).cast("int")
    rest = F.floor("target") - passes * F.col("source_size") - F.col("before")
    last = F.when((rest > 0) & (2 * rest >= F.col("size")), F.struct("order_key", "tie"))
    of, full, cut, times = fresh(docs, "of_source", "passes", "upto", "times")
    upto = checkpointed(
        decided.groupBy("source").agg(F.max(passes).alias(full), F.max(last).alias(cut)).select(F.col("source").alias(of), full, cut),
        narrow=True,
    )
    place = F.struct(_order_key(key).alias("order_key"), tie_of(text).alias("tie"))
    own = docs[source].cast("string").eqNullSafe(F.col(of))
    has_words = F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    copies = F.when(has_words, F.col(full) + F.coalesce(place <= F.col(cut), F.lit(False)).cast("int")).otherwise(0)
    taken_rows = docs.join(sized(upto), own).withColumn(times, copies).filter(F.col(times) > 0)
    return taken_rows.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*(docs[c] for c in docs.columns))
