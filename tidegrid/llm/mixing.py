"""Mixing sources to target weights along a time-varying curriculum, in DataFrame functions only.

Training time runs from 0 to 1. The rate at which a source is used is its
target times a schedule, here a straight line ``1 + slope (2 t - 1)`` that
integrates to 1. Up to time t a source has used ``target * (t + slope (t^2 - t))``
words: its cumulative demand. Its documents stand in a fixed random order, and
each takes the stretch of the demand that its words cover; the inverse of the
demand at the middle of that stretch is the document's training position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import carried, n_words, restored, stored

#: Fixed values of the mix: weights by the sources' order, words taken per word there, passes at most.
WEIGHTS, BUDGET, PASSES = (3, 1, 2), 1.5, 2
#: Slopes of the schedules by the sources' order: early, even, late.
SLOPES = (-0.5, 0.0, 0.5)
#: Rows of a source that one task sorts, about.
ROWS_PER_BUCKET = 2_000


def _by_rank(values: tuple, rank: Column) -> Column:
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, weights: tuple = WEIGHTS, budget: float = BUDGET, passes: int = PASSES) -> DataFrame:
    """``source, source_size, n, rank, weight, target`` per source.

    ``sizes``: source, size. The budget of words is shared by weight; what goes
    beyond ``passes`` times a source's size is reshared by weight. A source is
    full exactly if its bound per weight is below the common level, so sources
    are taken by that ratio and the level follows from running sums over the
    table of sources, one row each.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", _by_rank(weights, F.col("rank")))
    per = per.withColumn("_bound", F.col("source_size") * float(passes))
    whole = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("_bound") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("_bound").over(before), F.lit(0.0))
    used = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    total = F.sum("source_size").over(whole) * float(budget)
    level = (total - filled) / (F.sum("weight").over(whole) - used)
    per = per.withColumn("_level", level).withColumn("_open", F.col("_bound") > F.col("_level") * F.col("weight"))
    # The first source in that order that is not full sets the level for itself and all behind it.
    final = F.min(F.when(F.col("_open"), F.struct(F.col("_bound") / F.col("weight"), "rank", "_level"))).over(whole)
    target = F.least(F.col("_bound"), F.coalesce(final["_level"] * F.col("weight"), F.col("_bound")))
    return per.select("source", "source_size", "n", "rank", "weight", target.alias("target"))


def position(share: Column, slope: Column) -> Column:
    """The time at which a source has met ``share`` (0 to 1) of its demand: inverse of t + slope (t^2 - t)."""
    a, b = slope, F.lit(1.0) - slope
    root = F.sqrt(F.greatest(b * b + F.lit(4.0) * a * share, F.lit(0.0)))
    return F.when(slope == 0, share).otherwise(F.lit(2.0) * share / (b + root))


def with_sizes(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_size``, the number of words of the text."""
    return docs.withColumn("_size", n_words(F.col("text")))


def assign(sized: DataFrame, keys: DataFrame | None = None, weights: tuple = WEIGHTS, slopes: tuple = SLOPES, budget: float = BUDGET, passes: int = PASSES, seed: str = "mix") -> DataFrame:
    """``sized`` with ``_source_size, _target, _taken, _begin, _slots``; ``_begin``: the words of the source before the row.

    ``sized``: doc_id, source, _size and any other columns; ``keys``: these
    three of the same rows, where they can be read more cheaply. ``_slots`` has
    a struct ``(pass, words, position)`` for each pass that takes words of the
    row; ``_taken`` is their sum, at most ``passes`` times its size. In the last
    pass of a source the row at the bound gives only what is left of the target,
    so each source meets its target to the word. Rows without words take part
    with 0 words; a NULL source is a source of its own, the last one; rows with
    equal or NULL ids are rows of their own.

    The order within a source is that of a hash of the id. A source is cut into
    ranges of that hash by its number of rows, so no task holds a whole source:
    running sums are taken within ranges and over ranges.
    """
    keys = sized if keys is None else keys
    goal = stored(targets(keys.select("source", F.col("_size").alias("size")), weights, budget, passes), "targets")
    goal = goal.select(
        F.struct("source").alias("_of"),  # a struct, so that NULL meets NULL in an equi-join
        F.col("source_size").alias("_source_size"),
        F.col("target").alias("_target"),
        F.round("target").cast("bigint").alias("_goal"),
        _by_rank(slopes, F.col("rank")).alias("_slope"),
        F.ceil(F.col("n") / F.lit(ROWS_PER_BUCKET)).alias("_ranges"),
    )

    def cut(rows: DataFrame) -> DataFrame:
        """With the hash and the number of the hash range: its 28 leading bits, cut into equal ranges."""
        text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")))
        rows = rows.withColumn("_hash", F.md5(text)).withColumn("_of", F.struct("source")).join(goal, "_of")
        bits = F.conv(F.substring("_hash", 1, 7), 16, 10).cast("bigint")
        return rows.withColumn("_range", F.floor(bits * F.col("_ranges") / F.lit(1 << 28)))

    sums = cut(keys.select("doc_id", "source", "_size")).groupBy("_of", "_range").agg(F.sum("_size").alias("_sum"))
    over_ranges = Window.partitionBy("_of").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sums.select("_of", "_range", F.coalesce(F.sum("_sum").over(over_ranges), F.lit(0)).alias("_base")), "ranges")
    inside = Window.partitionBy("_of", "_range").orderBy("_hash", "_size").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut(sized).join(starts, ["_of", "_range"]).withColumn(
        "_at", F.col("_base") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    )

    def slot(p: int) -> Column:
        begin = F.col("_at") + F.lit(p) * F.col("_source_size")
        words = F.greatest(F.least(F.col("_size"), F.col("_goal") - begin), F.lit(0)).cast("bigint")
        share = (begin + words / F.lit(2.0)) / F.greatest(F.col("_goal"), F.lit(1))
        return F.struct(F.lit(p).alias("pass"), words.alias("words"), position(share, F.col("_slope")).alias("position"))

    slots = F.filter(F.array(*(slot(p) for p in range(passes))), lambda s: s["words"] > 0)
    taken = F.aggregate("_slots", F.lit(0).cast("bigint"), lambda n, s: n + s["words"])
    return placed.withColumn("_slots", slots).withColumn("_taken", taken).select(
        *(f"`{c}`" for c in sized.columns), "_source_size", "_target", "_taken", F.col("_at").alias("_begin"), "_slots"
    )


def in_order(passes: DataFrame) -> DataFrame:
    """The training order: rows of one pass of a document each, range-sorted by position (``_at``), id and ``_pass``."""
    order = ["_at", "doc_id", "_pass"]
    return passes.repartitionByRange(*order).sortWithinPartitions(*order)


def decisions(sized: DataFrame) -> DataFrame:
    """``doc_id, source, _size, _source_size, _target, _taken, _first`` per row of ``sized``, from the stored training order.

    What a row gives and its first position are taken from its places in that
    order; rows without a place give no words. The words before a row tell rows
    of a source with words apart.
    """
    of = ["doc_id", "source", "_size", "_source_size", "_target", "_begin"]
    rows = stored(assign(sized).select(*of, "_slots"), "assigned")
    placed = rows.withColumn("_slot", F.explode("_slots"))
    placed = placed.select(*of, F.col("_slot.words").alias("_words"), F.col("_slot.pass").alias("_pass"), F.col("_slot.position").alias("_at"))
    order = stored(in_order(placed), "training-order")
    found = order.groupBy(*of).agg(F.sum("_words").alias("_taken"), F.min_by("_at", "_pass").alias("_first"))
    none = rows.where(F.size("_slots") == 0).select(*of, F.lit(0).cast("bigint").alias("_taken"), F.lit(None).cast("double").alias("_first"))
    return found.unionByName(none).drop("_begin")


def first_words(text: Column, size: Column, words: Column) -> Column:
    """The text itself, or its first ``words`` words joined by spaces where it gives fewer than ``size``."""
    found = F.slice(F.regexp_extract_all(text, F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1)), F.lit(1), words.cast("int"))
    return F.when(words >= size, text).otherwise(F.array_join(found, " "))


def mixed(docs: DataFrame, whole: bool = False, **how) -> DataFrame:
    """The training order: one row for each pass of each document, range-sorted by position.

    In the columns of ``docs``; the text of a row at a source's bound is cut to
    the words that the mix takes, or with ``whole`` taken uncut if that is nearer
    to the target, and else left out. Rows that the mix does not take are not there.
    """
    others = [c for c in docs.columns if c != "text"]
    sized = with_sizes(docs.select("doc_id", "source", "text", *carried(others)))
    keys = stored(sized.select("doc_id", "source", "_size"), "sizes")
    rows = assign(sized, keys, **how).where(F.size("_slots") > 0).withColumn("_slot", F.explode("_slots"))
    if whole:
        rows = rows.where(F.col("_slot.words") * 2 >= F.col("_size")).withColumn("_text", F.col("text"))
    else:
        rows = rows.withColumn("_text", first_words(F.col("text"), F.col("_size"), F.col("_slot.words")))
    numbered = [f"_c{i}" for i in range(len(others))]
    out = stored(rows.select("doc_id", F.col("_slot.position").alias("_at"), F.col("_slot.pass").alias("_pass"), "_text", *numbered), "mixed")
    back = dict(zip(others, restored(others), strict=True)) | {"text": F.col("_text").alias("text")}
    return in_order(out).select(*(back[c] for c in docs.columns))
