"""SimHash near-duplicates by pigeonring filtering.

A fingerprint of 64 bits is cut into four segments in a ring. If two
fingerprints differ in at most 3 bits, the differences of the segments sum to
at most 3, so there is a start from which each chain of 1, 2, 3 and 4
consecutive segments stays within its share of the budget: 3/4, 6/4, 9/4 and
12/4, that is 0, 1, 2 and 3 whole bits. Chains of two segments are found by an
equi-join on 32 bits: the first segment as it is, of the second either all bits
or all but one set bit, which is cleared. (Of two segments that differ in one
bit, one has the bit set; cleared, it equals the other.) Longer chains and the
full Hamming distance are tested on what the join finds.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm import resemblance
from tidegrid.llm.common import join_groups, stored
from tidegrid.llm.components import smallest_reachable

SEED = 42
DISTANCE = 3
_SEGMENTS, _WIDTH = 4, 16
_MASK = (1 << _WIDTH) - 1


def fingerprint(text: str | None, size: int = 3) -> int:
    """Bit i is 1 if it is set in over half the hashes of the word shingles; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < size:
        shingles, n = [b" ".join(words)], 1
    else:
        n = len(words) - size + 1
        shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), dtype=">u8", count=n)
    set_bits = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 1 << 14):  # blocks: the bits of a very long text are not held at once
        bits = np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(set_bits * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``doc_id, fp`` (a signed long with the 64 bits) of each row."""

    def work(parts):
        for b in parts:
            values = np.fromiter((fingerprint(t.as_py(), size) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.record_batch([b.column(0), pa.array(values.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return rows.mapInArrow(work, "doc_id long, fp long")


def _segment(fp: Column, i: int) -> Column:
    return F.shiftrightunsigned(fp, _WIDTH * (i % _SEGMENTS)).bitwiseAND(F.lit(_MASK))


def _chain_key(start: int, first: Column, second: Column) -> Column:
    """Both segments and the start of the chain in one long."""
    return F.lit(start << 2 * _WIDTH) + F.shiftleft(first, _WIDTH) + second


def _cleared_keys(start: int) -> Column:
    """The chain keys of ``fp`` with one set bit of the second segment cleared, one for each such bit."""
    first, second = _segment(F.col("fp"), start), _segment(F.col("fp"), start + 1)
    bits = F.array(*(F.lit(1 << i).cast("bigint") for i in range(_WIDTH)))
    return F.transform(
        F.filter(bits, lambda bit: second.bitwiseAND(bit) != 0), lambda bit: _chain_key(start, first, second - bit)
    )


def _apart(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _chain_holds(a: Column, b: Column, start: int) -> Column:
    """Each chain from this start stays within its share."""
    diff = [_apart(_segment(a, start + k), _segment(b, start + k)) for k in range(3)]
    return (diff[0] == 0) & (diff[0] + diff[1] <= 1) & (diff[0] + diff[1] + diff[2] <= 2)


def near_pairs(distinct: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the distinct ``fp`` that differ in 1 to 3 bits, each once, in either order."""
    whole = F.array(
        *(_chain_key(s, _segment(F.col("fp"), s), _segment(F.col("fp"), s + 1)) for s in range(_SEGMENTS))
    )
    less = F.concat(*(_cleared_keys(s) for s in range(_SEGMENTS)))
    held = distinct.select(F.col("fp").alias("a"), F.explode(whole).alias("key"))
    same = distinct.select(F.col("fp").alias("b"), F.explode(whole).alias("key"))
    cleared = distinct.select(F.col("fp").alias("b"), F.explode(less).alias("key"))
    a, b = F.col("a"), F.col("b")
    start = F.shiftrightunsigned(F.col("key"), 2 * _WIDTH)
    # Of several starts that hold, the first one reports the pair.
    first = F.coalesce(*(F.when(_chain_holds(a, b, s), F.lit(s)) for s in range(_SEGMENTS)))
    exact = (_apart(a, b) <= DISTANCE) & (first == start)
    # Spark takes the exploded keys for no more than the fingerprints and would broadcast them: up to 64 for each.
    return (
        held.join(same.hint("merge"), "key").where((a < b) & exact).select("a", "b")
        .unionByName(held.join(cleared.hint("merge"), "key").where((a != b) & exact).select("a", "b"))
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 3) -> DataFrame:
    """``doc_id, fp, component_id`` per row of ``docs``; ``size``: words of a shingle.

    ``component_id`` is the smallest id reachable over links of at most 3 bits.
    Copies meet in their fingerprint before any join, so a large group of equal
    texts is one row of it. NULL and empty texts have fingerprint 0 and are
    linked like any other; repeated ids stay repeated; a NULL id is no
    candidate for the smallest (a component of NULL ids only has NULL). Other
    columns are not looked at.
    """
    prints = stored(fingerprints(docs, doc_id, text, size), "simhash")
    groups = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")), "simhash-groups")
    pairs = near_pairs(groups.select("fp"))
    linked = smallest_reachable(pairs, groups.select(F.col("fp").alias("node"), F.col("least").alias("value")))
    found = groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
    found = stored(found.select("fp", "rows", F.coalesce("value", "least").alias("component_id")), "simhash-found")
    return join_groups(prints, found, "fp", "rows").select("doc_id", "fp", "component_id")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """Of each group of near copies the row with the smallest ``doc_id``, in the columns of ``docs``.

    Near copies are the components of the fingerprints of their five-word
    shingles (``near_duplicates``), all of whose links hold, and texts that
    share at least 80 % of these shingles, which fingerprints can miss and which
    are found on whole shingle sets (``resemblance``); or texts that are linked
    over others by either. Rows without an id come after all others. Of
    rows with the smallest id the one with the smallest hash of its columns
    stays, once. Ids play no part in matching: rows that share an id, or have
    none, are rows of their own. NULL and empty texts are copies of each other.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    row = F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit("row"), *columns).alias("b"))  # 128 bits
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), row.alias("hash"))
    texts = docs.select(resemblance.text_key(F.col("text")).alias("node"), "text", place.alias("place"))
    texts_only = texts.select("node", "text")
    close = near_duplicates(texts_only, "node", "text", resemblance.SHINGLE).where("doc_id != component_id")
    first = stored(close.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")).distinct(), "fingerprint-pairs")
    linked = resemblance.groups(texts_only, first=first)
    best = texts.groupBy("node").agg(F.min("place").alias("place"))
    group = F.coalesce("root", "node").alias("root")
    keep = best.join(linked, "node", "left").groupBy(group).agg(F.min("place").alias("place"))
    keep = stored(keep.select(F.col("place.hash").alias("_hash")), "kept-rows")
    rows = docs.select(row.alias("_hash"), F.struct(*columns).alias("_row"))
    return rows.join(keep, "_hash", "left_semi").groupBy("_hash").agg(F.any_value("_row").alias("_row")).select("_row.*")
