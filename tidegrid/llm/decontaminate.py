"""Benchmark decontamination: containment search with size-partitioned MinHash sketches, in DataFrame functions only.

An item is found in a document if at least 80 % of the item's distinct
five-word shingles are among the document's. Items are partitioned by their
number of shingles; all items of a partition have a MinHash sketch of the same
length, their k smallest shingle hashes. With n shingles in an item at most
``n - ceil(0.8 n)`` may be missing from a document that contains it, so k above
that number for the largest n of the partition makes sure that at least one
value of the sketch is met: candidates lose nothing. What the shared sketch
values leave is verified on the shingles themselves.

An item of fewer than five words is one shingle of just that many words, and is
looked for among the documents' shingles of the same length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, stored

SHINGLE, SIMILARITY = 5, 0.8


def normal_words(text: Column) -> Column:
    """Lower-case words of letters, marks and digits; NULL and empty texts have none."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{M}\p{N}]+")
    return F.array_remove(parts, "")


def text_key(text: Column) -> Column:
    """128 bits of hash that stand for a text."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def shingles_of(words: Column, size: int) -> Column:
    """The shingles of a word array, each a struct of its words in order; fewer words have none."""
    starts = F.greatest(F.size(words) - F.lit(size - 1), F.lit(0))
    return F.arrays_zip(*(F.slice(words, F.lit(1 + i), starts).alias(f"w{i}") for i in range(size)))


def shingle_hash(size: int, shingle: str = "_s") -> Column:
    return F.xxhash64(F.lit(size), *(F.col(f"{shingle}.w{i}") for i in range(size)))


def shingle_hashes(df: DataFrame, size: int, *keys: str) -> DataFrame:
    """``keys, _h``: one row per shingle of the words ``_w``."""
    return df.select(*keys, F.explode(shingles_of(F.col("_w"), size)).alias("_s")).select(*keys, shingle_hash(size).alias("_h"))


def shingle_texts(words: Column, size: int) -> Column:
    """The distinct shingles of a word array as strings."""
    return F.array_distinct(F.transform(shingles_of(words, size), lambda s: F.concat_ws(" ", *(s[f"w{i}"] for i in range(size)))))


def _by_size(df: DataFrame, sizes: list[int], size: str, value) -> Column:
    """``value(m)`` for the rows whose ``size`` is m."""
    return F.coalesce(*(F.when(F.col(size) == m, value(m)) for m in sizes))


def _partition(n: Column) -> Column:
    """Partition number of items with ``n`` shingles: sizes above 2^(p-1), up to 2^p."""
    return F.ceil(F.log2(n.cast("double"))).cast("int")


def item_words(items: DataFrame) -> DataFrame:
    """``item, item_id, m, _w`` per different text with words of each item: its key, words, and the length of its shingles."""
    rows = items.where(F.col("item_id").isNotNull()).select("item_id", text_key(F.col("text")).alias("item"), normal_words(F.col("text")).alias("_w"))
    return rows.where(F.size("_w") > 0).dropDuplicates(["item_id", "item"]).withColumn("m", F.least(F.size("_w"), F.lit(SHINGLE)))


def sketches(words: DataFrame, sizes: list[int], similarity: float = SIMILARITY) -> DataFrame:
    """``item, m, n, part, sketch`` per different text: the smallest shingle hashes, as many as its size partition needs."""
    texts = words.dropDuplicates(["item"])
    rows = reduce(DataFrame.unionByName, (shingle_hashes(texts.where(F.col("m") == m), m, "item", "m") for m in sizes))
    whole = rows.groupBy("item", "m").agg(F.sort_array(F.collect_set("_h")).alias("hashes"))
    sized = whole.withColumn("n", F.size("hashes")).withColumn("part", _partition(F.col("n")))
    largest = F.pow(F.lit(2.0), F.col("part"))
    length = (largest - F.ceil(F.lit(similarity) * largest - F.lit(1e-9)) + 1).cast("int")
    return sized.select("item", "m", "n", "part", F.slice("hashes", F.lit(1), length).alias("sketch"))


def contained(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``key, item_id, contained``: the share of each item in each text (by ``text_key``) that holds enough of it.

    The largest share where an item has several texts. The sketches are joined
    to the documents' shingles by an equi-join; Spark broadcasts them only while
    their table is below its size threshold. Pairs are made only where a sketch
    value is met, and of equal texts one is verified.
    """
    words = stored(item_words(items), "item-words")
    sizes = sorted(r.m for r in words.select("m").distinct().collect())  # five at most
    if not sizes:
        return docs.select(text_key(F.col("text")).alias("key"), F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("contained")).limit(0)
    probe = stored(sketches(words, sizes, similarity).select("item", "m", F.explode("sketch").alias("_h")), "item-probes")
    texts = docs.select(text_key(F.col("text")).alias("key"), normal_words(F.col("text")).alias("_w"))
    met = reduce(
        DataFrame.unionByName,
        (shingle_hashes(texts, m, "key").join(probe.where(F.col("m") == m).select("item", "_h"), "_h").select("key", "item") for m in sizes),
    )
    pairs = stored(met.distinct(), "candidates")

    # Verification: the shingles of each candidate's text against those of its item.
    suspects = docs.select(text_key(F.col("text")).alias("key"), "text").join(pairs.select("key").distinct(), "key", "left_semi")
    suspects = suspects.groupBy("key").agg(F.any_value("text").alias("text")).select("key", normal_words(F.col("text")).alias("_w"))
    wanted = _by_size(words, sizes, "m", lambda m: shingle_texts(F.col("_w"), m))
    wanted = stored(words.dropDuplicates(["item"]).select("item", "m", wanted.alias("_wanted")), "item-shingles")
    held = _by_size(words, sizes, "m", lambda m: F.size(F.array_intersect("_wanted", shingle_texts(F.col("_w"), m))))
    share = (held / F.size("_wanted")).alias("contained")
    both = pairs.join(wanted, "item").join(suspects, "key").select("key", "item", share).where(F.col("contained") >= similarity - 1e-12)
    found = both.join(words.select("item", "item_id"), "item").groupBy("key", "item_id").agg(F.max("contained").alias("contained"))
    found = stored(found, "contained")
    discard(probe, pairs, wanted, words)
    return found


def contained_items(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, contained`` for each item of which at least ``similarity`` is in a document.

    ``docs``: doc_id, text; ``items``: item_id, text; other columns are not
    looked at. Each row of ``docs`` is a document; of rows that share an id, and
    of rows without one, the largest share counts. All different texts of an
    item are searched; an item without an id takes no part. Repeated rows count
    once. Texts without words match nothing. An item of one to four words is
    found wherever these words follow each other.
    """
    found = contained(docs, items, similarity)
    rows = docs.select("doc_id", text_key(F.col("text")).alias("key")).join(found, "key")
    return rows.groupBy("doc_id", "item_id").agg(F.max("contained").alias("contained"))


def without_leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that contain no item, in its columns.

    Rows are told apart by their texts, so a row without an id is searched like
    any other, and a clean row stays though another one with its id goes.
    """
    leaks = stored(contained(docs, items, similarity).select("key").distinct(), "leaks")
    columns = [F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(docs.columns)]
    rows = docs.select(text_key(F.col("text")).alias("key"), *columns).join(leaks, "key", "left_anti")
    return rows.select(*(F.col(f"_c{i}").alias(c) for i, c in enumerate(docs.columns)))
