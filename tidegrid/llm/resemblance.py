"""Texts that share at least 80 % of their five-word shingles, found without loss by prefix filtering.

The shingles of each text stand in one fixed order. Two texts of Jaccard
similarity t or more share a shingle among the first ``n - ceil(t n) + 1`` of
each, n being the number of distinct shingles of the text; so an equi-join on
these prefixes meets every pair, and the similarity is then taken on the whole
sets. Any order is right. The one here has shingles last that are common among
all texts, so a passage that many texts quote makes no pairs of them.

In a large group of near copies all pairs would meet. So pairs that are linked
otherwise, such as those of close fingerprints, are put together first; then texts
that are not linked yet are compared with one other text each, the smallest holder of most of the shingles
that they share with it. In further rounds the holders of each shingle are dealt
into small bins by a hash that changes from round to round, and each text is
compared with one of another group that it meets in them. Pairs of
texts that are linked by then need no further test, as only components matter;
what shares a shingle and is not linked is tested pair by pair.

Shingles that the same texts have, such as those of a passage, are one key with
a weight. Before whole sets are compared, sketches of one to two bits a shingle
(the parity of the number of shingles per bit) tell most pairs apart that are
not alike: two sets differ in at least as many shingles as their sketches in bits.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import discard, stored
from tidegrid.llm.components import with_links

SHINGLE, SIMILARITY = 5, 0.8
SEED = 42
#: The order of shingles: a shingle that as many texts of one task have is common; the commonest ones are listed.
COMMON, COMMONEST = 8, 50_000
#: Rounds in which texts are dealt into bins, at most; texts of a bin, at most on average.
ROUNDS, BIN = 3, 4
#: A round that links fewer of the pairs it tests is the last one.
WORTH = 0.02


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """The distinct hashes of the word shingles, ascending; a text of fewer words, or of none, is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = max(len(words) - size + 1, 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else [b" ".join(words)]
    return np.unique(np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles), dtype=np.uint64, count=n).view(np.int64))


def _lists(parts, columns: dict, make):
    """Arrow batches of ``make(values)`` per row, with the list last: rows are gathered up to about a million list entries."""
    kinds = list(columns.values())

    def batch(rows):
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(columns))

    for b in parts:
        rows, held = [], 0
        for values in zip(*b.columns, strict=True):
            rows.append(make(*values))
            held += len(rows[-1][-1])
            if held > 1 << 20:
                yield batch(rows)
                rows, held = [], 0
        if rows:
            yield batch(rows)


_HASHES = pa.list_(pa.int64())


def sketch(hashes: np.ndarray) -> bytes:
    """The parity of the number of hashes per bit, for as many bits as there are hashes, up to the next power of two."""
    bits = 1 << max(len(hashes) - 1, 63).bit_length()
    return np.packbits(np.bincount(hashes & (bits - 1), minlength=bits) & 1).tobytes()


def apart(a: bytes, b: bytes) -> int:
    """The number of bits in which two sketches differ; the larger one is folded to the size of the other."""
    few = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(np.frombuffer(x, dtype=np.uint8).reshape(-1, few), axis=0) for x in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def prefix_length(n: int, similarity: float = SIMILARITY) -> int:
    return n - int(np.ceil(similarity * n - 1e-9)) + 1


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _common(texts: DataFrame) -> np.ndarray:
    """The shingles that most texts have, ascending. It only spares work, so counts are taken where texts lie."""

    def work(parts):
        seen, times = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)

        def summed(h, n):
            found, place = np.unique(h, return_inverse=True)
            return found, np.bincount(place, weights=n, minlength=len(found)).astype(np.int64)

        for b in _lists(parts, {"h": _HASHES}, lambda t: (shingle_hashes(t.as_py()),)):
            h, n = np.unique(b.column(0).flatten().to_numpy(), return_counts=True)
            again = n > 1  # what a batch has once is rare, or will be met again
            seen, times = summed(np.concatenate([seen, h[again]]), np.concatenate([times, n[again]]))
            if len(seen) > 1 << 20:
                seen, times = seen[times >= COMMON], times[times >= COMMON]
        often = times >= COMMON
        if often.any():
            yield pa.record_batch([pa.array(seen[often]), pa.array(times[often])], names=["h", "n"])

    counts = texts.select("text").mapInArrow(work, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    found = counts.orderBy(F.desc("n"), "h").limit(COMMONEST).select("h").collect()
    return np.sort(np.array([r.h for r in found], dtype=np.int64))


def _prefixes(texts: DataFrame, common: np.ndarray, similarity: float) -> DataFrame:
    """``node, n, sketch, prefix`` per row."""

    def prefix(node, text):
        h = shingle_hashes(text.as_py())
        n = prefix_length(len(h), similarity)
        if not len(common):
            return node.as_py(), len(h), sketch(h), h[:n]
        last = np.isin(h, common, assume_unique=True)
        return node.as_py(), len(h), sketch(h), np.concatenate([h[~last], h[last]])[:n]

    def work(parts):
        yield from _lists(parts, {"node": pa.int64(), "n": pa.int32(), "sketch": pa.binary(), "prefix": _HASHES}, prefix)

    return texts.select("node", "text").mapInArrow(work, "node long, n int, sketch binary, prefix array<long>")


def _close(pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose sketches do not tell them apart; a pair that is similar enough is among them."""
    share = (1 - similarity) / (1 + similarity)  # of both sizes, by which the sets may differ

    def work(parts):
        for part in parts:
            a, b, n, m, s, t = part.columns
            sizes = share * (n.to_numpy() + m.to_numpy()) + 1e-6
            differ = np.fromiter((apart(x.as_py(), y.as_py()) for x, y in zip(s, t, strict=True)), dtype=np.int64, count=len(a))
            yield pa.record_batch([a, b], names=["a", "b"]).filter(pa.array(differ <= sizes))

    one, other = (sketches.select(F.col("node").alias(c), F.col("n").alias(f"_n{c}"), F.col("sketch").alias(f"_s{c}")) for c in "ab")
    met = pairs.join(one, "a").join(other, "b").select("a", "b", "_na", "_nb", "_sa", "_sb")
    return met.mapInArrow(work, "a long, b long")


def _alike(texts: DataFrame, pairs: DataFrame, sketches: DataFrame, similarity: float) -> DataFrame:
    """The ``pairs`` (a, b) whose whole sets of shingles are similar enough."""
    pairs = stored(_close(pairs, sketches, similarity), "close-pairs")

    def work(parts):
        yield from _lists(parts, {"node": pa.int64(), "s": _HASHES}, lambda node, t: (node.as_py(), shingle_hashes(t.as_py())))

    nodes = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    theirs = texts.join(nodes, "node", "left_semi").dropDuplicates(["node"]).select("node", "text")
    sets = stored(theirs.mapInArrow(work, "node long, s array<long>"), "shingle-sets")
    both = (
        pairs.join(sets.select(F.col("node").alias("a"), F.col("s").alias("_a")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("s").alias("_b")), "b")
        .select("a", "b", F.size("_a").alias("_n"), F.size("_b").alias("_m"), F.size(F.array_intersect("_a", "_b")).alias("_c"))
    )
    enough = F.col("_c") >= F.lit(similarity) * (F.col("_n") + F.col("_m") - F.col("_c")) - F.lit(1e-9)
    found = stored(both.where(enough).select("a", "b"), "links")
    discard(sets, pairs)
    return found


def _sizes_fit(n: Column, m: Column, similarity: float) -> Column:
    return F.least(n, m) >= F.lit(similarity) * F.greatest(n, m) - F.lit(1e-9)


def _may_reach(n: Column, m: Column, met: Column, similarity: float) -> Column:
    """Whether texts of these sizes whose prefixes have ``met`` shingles in common can be similar enough.

    What both have behind the prefix that ends first is at most that text's rest.
    """
    rest = F.greatest(*(F.ceil(F.lit(similarity) * c - F.lit(1e-9)) - 1 for c in (n, m)))
    return met + rest >= F.lit(similarity / (1 + similarity)) * (n + m) - F.lit(1e-6)


def _one_pair_each(named: DataFrame, similarity: float) -> DataFrame:
    """``a, b``: per group one pair of texts, with the group that holds most of the shared shingles first.

    ``named``: key, weight, node, n, root. Per shingle the smallest group has one text to compare with.
    """
    ones = named.groupBy("key").agg(F.min(F.struct("root", "node", "n")).alias("one"), F.max("root").alias("other"))
    ones = ones.where("one.root != other").select("key", "one")
    met = named.join(ones, "key").where((F.col("root") != F.col("one.root")) & _sizes_fit(F.col("n"), F.col("one.n"), similarity))
    met = met.groupBy("root", F.col("one.node").alias("a"), F.col("node").alias("b")).agg(F.sum("weight").alias("c"))
    best = met.groupBy("root").agg(F.max_by(F.struct("a", "b"), F.struct("c", -F.col("a"), -F.col("b"))).alias("_p"))
    return best.select("_p.a", "_p.b")


def _met(rows: DataFrame, keys: list[str], similarity: float) -> DataFrame:
    """``a, b, n_a, n_b, count``: pairs of texts of different groups that meet in ``keys``, with the weight of these; a < b."""
    a, b = (rows.select(*keys, *(F.col(c).alias(f"{c}_{s}") for c in ("weight", "node", "n", "root", "held"))) for s in "ab")
    fit = (F.col("node_a") < F.col("node_b")) & (F.col("root_a") != F.col("root_b"))
    fit = fit & _sizes_fit(F.col("n_a"), F.col("n_b"), similarity)
    # No pair has more in common than what either text shares at all.
    fit = fit & _may_reach(F.col("n_a"), F.col("n_b"), F.least("held_a", "held_b"), similarity)
    # The stored rows take up little as files: Spark would broadcast more than it sees.
    met = a.join(b.hint("merge"), keys).where(fit).groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "n_a", "n_b")
    return met.agg(F.sum("weight_a").alias("count"))


def _binned_pairs(named: DataFrame, tested: DataFrame, turn: int, similarity: float) -> DataFrame:
    """``a, b``: for each text the one of another group that it shares most with among those in its bins and has not been compared with.

    A key has as many bins, a power of two, as leave ``BIN`` or fewer texts in each on average, so pairs grow with the rows.
    """
    held = named.groupBy("key").agg(F.count(F.lit(1)).alias("_c"))
    bins = held.select("key", F.pow(F.lit(2.0), F.greatest(F.ceil(F.log2(F.col("_c") / BIN)), F.lit(0))).cast("long").alias("_bins"))
    rows = named.join(bins, "key").withColumn("_bin", F.pmod(F.xxhash64("node", F.lit(turn)), F.col("_bins")))
    met = _met(rows, ["key", "_bin"], similarity).join(tested.hint("merge"), ["a", "b"], "left_anti")
    pair, by = F.struct("a", "b"), F.struct("count", F.xxhash64("a", "b", F.lit(turn)))
    ends = met.select(pair.alias("_p"), by.alias("_by"), F.explode(F.array("a", "b")).alias("node"))
    return ends.groupBy("node").agg(F.max_by("_p", "_by").alias("_p")).select("_p.a", "_p.b").distinct()


def groups(texts: DataFrame, similarity: float = SIMILARITY, first: DataFrame | None = None) -> DataFrame:
    """``node, root`` for the texts that have a link; ``texts``: node (``text_key``), text, repeated as they may be.

    ``first``: links ``a, b`` of nodes that hold whatever their shingles, each at most once.
    """
    rows = stored(_prefixes(texts, _common(texts), similarity), "prefixes")
    distinct = rows.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"))
    # Dealt out by shingle once: the shingles of several texts are found where they lie.
    dealt = distinct.select("node", "n", F.explode("prefix").alias("key")).repartition("key")
    holders = (F.count(F.lit(1)).alias("_c"), F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64(F.lit(SEED), "node")).alias("_y"))
    several = dealt.groupBy("key").agg(*holders).where("_c > 1")
    # Of shingles with the same holders one stays.
    several = several.groupBy("_c", "_x", "_y").agg(F.min("key").alias("key"), F.count(F.lit(1)).alias("weight"))
    held = stored(dealt.join(several.select("key", "weight").hint("shuffle_hash"), "key"), "shared-shingles")
    shared = rows.select("node", "n", "sketch").join(held.select("node").distinct(), "node", "left_semi")
    sketches = stored(shared.groupBy("node").agg(F.any_value("n").alias("n"), F.any_value("sketch").alias("sketch")), "sketches")
    discard(rows)

    tested = label = None
    open_ = held.withColumn("root", F.col("node"))
    for turn in range(-1 if first is not None else 0, ROUNDS + 1):
        if turn == -1:
            pairs = first
        elif turn == 0:
            pairs = stored(_one_pair_each(open_, similarity), "first-pairs")
        else:
            pairs = stored(_binned_pairs(open_, tested, turn, similarity), "first-pairs")
        ordered = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        tested = stored(ordered if tested is None else tested.unionByName(ordered), "tested-pairs")
        links = first if turn == -1 else _alike(texts, pairs, sketches, similarity)
        worth = turn < 1 or links.count() > WORTH * pairs.count()
        before, label = label, stored(with_links(label, links), "first-groups")
        if before is not None:
            discard(before, open_)
        named = held.join(label, "node", "left").select("key", "weight", "node", "n", F.coalesce("root", "node").alias("root"))
        # What is left open: shingles that several groups hold.
        mixed = named.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r != s").select("key")
        named = named.join(mixed, "key", "left_semi")
        open_ = stored(named.join(named.groupBy("node").agg(F.sum("weight").alias("held")), "node"), "open-shingles")
        if not worth:
            break

    # Pairs of different groups: each is counted with all shingles that both prefixes have.
    met = _met(open_, ["key"], similarity)
    close = _may_reach(F.col("n_a"), F.col("n_b"), F.col("count"), similarity)
    left = stored(met.where(close).select("a", "b").join(tested.distinct().hint("merge"), ["a", "b"], "left_anti"), "open-pairs")
    discard(held, open_)
    return with_links(label, _alike(texts, left, sketches, similarity))
