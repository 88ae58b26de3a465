"""Divergence of sources by their terms: segment trees whose equal subtrees are one node.

Per language the kept terms get numbers, frequent ones first, and a group's
counts are the leaves of a segment tree over these numbers. Equal subtrees are
one node, within a tree and among the trees of a task (hash-consing): most
stretches of the tail hold the same few small counts. To price two groups, both
trees are walked at once from the root; pairs of nodes that are met again are
not walked again but counted, so a pair of equal nodes is priced once however
often it occurs (the memo), and of leaves only the different pairs of counts
are priced.

The numbers are cut into blocks, each a subtree, and the groups of a language
into tiles; a task has one block of two tiles, so neither a vocabulary nor a
language is ever in one task, and prices of blocks are added up. Prices are
whole numbers throughout.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import stored

LEAST_DOCS = 10
UNIT = 1_000_000_000
TOP = 10
#: Terms of a block and groups of a tile: what a task holds.
BLOCK, TILE = 1 << 13, 64
#: Different terms that a counting task remembers at most before it hands them on.
REMEMBERED = 300_000
_SLICE = 1 << 20
#: Pairs of nodes that a task walks at a time, about.
_WALK = 1 << 21
_PAD = -1

#: Letters in lower case; other characters below U+0080 part terms; bytes of all others stand for themselves.
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def _words(text: bytes):
    """The terms of a text, in lists of those of about a megabyte."""
    plain, at = text.translate(_PLAIN), 0
    while at < len(plain):
        end = at + _SLICE
        end = plain.find(b" ", end) if end < len(plain) else -1
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n, docs``: occurrences and documents per group and term (in UTF-8).

    Each group also has a row of the empty term with no occurrences, so groups
    without terms are there. NULL text, lang and source are empty ones.
    """

    def rows(counts: dict, within: dict) -> pa.RecordBatch:
        found = [(*g, t, n, within[g][t]) for g, c in counts.items() for t, n in c.items()]
        found += [(*g, b"", 0, 0) for g in counts]
        types = (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
        return pa.record_batch(columns, names=["lang", "source", "term", "n", "docs"])

    def work(parts):
        counts: dict[tuple, Counter] = {}
        within: dict[tuple, Counter] = {}
        for b in parts:
            for lang, source, text in zip(b["lang"].to_pylist(), b["source"].to_pylist(), b["text"].cast(pa.binary()), strict=True):
                g = lang, source
                if g not in counts:
                    counts[g], within[g] = Counter(), Counter()
                own: set[bytes] = set()
                for words in _words(text.as_py()):
                    counts[g].update(words)
                    own.update(words)
                within[g].update(own)
            if sum(map(len, counts.values())) > REMEMBERED:
                yield rows(counts, within)
                counts, within = {}, {}
        if counts:
            yield rows(counts, within)

    plain = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    parts = plain.mapInArrow(work, "lang string, source string, term binary, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def vocabulary(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang, term, total, id``: the terms in enough documents of their language, numbered from 0 by falling total, then term.

    Terms are range-sorted; numbers are counted within parts and over parts.
    """
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("total"), F.sum("docs").alias("docs"))
    kept = kept.where((F.col("docs") >= least_docs) & (F.length("term") > 0)).drop("docs")
    order = [F.col("lang"), F.col("total").desc(), F.col("term")]
    placed = stored(kept.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "terms")
    before = Window.partitionBy("lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("size"))
    bases = sizes.select("lang", "part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("lang", "part").orderBy(F.col("total").desc(), "term")
    return placed.join(bases, ["lang", "part"]).select("lang", "term", "total", (F.col("base") + F.row_number().over(inside) - 1).alias("id"))


class Trees:
    """Segment trees over rows of counts of the same length; equal subtrees of any of them are one node."""

    def __init__(self, counts: np.ndarray):
        n = counts.shape[1]
        size = 1 << max(n - 1, 0).bit_length()
        padded = np.full((len(counts), size), _PAD, dtype=np.int64)
        padded[:, :n] = counts
        #: Counts by leaf number.
        self.values, ids = np.unique(padded, return_inverse=True)
        ids = ids.reshape(padded.shape)
        #: Children by node number, per level from the leaves up.
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.leaves = ids
        below = len(self.values)
        while ids.shape[1] > 1:
            pairs, ids_up = np.unique(ids[:, 0::2] * below + ids[:, 1::2], return_inverse=True)
            self.levels.append((pairs // below, pairs % below))
            ids, below = ids_up.reshape(len(ids), -1), len(pairs)
        self.roots = ids[:, 0]

    def sizes(self) -> list[int]:
        """Nodes per level, from the leaves up."""
        return [len(self.values), *(len(a) for a, _ in self.levels)]

    def leaf_pairs(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The different pairs of leaves of the trees ``a[i]`` and ``b[i]``: i, leaf of a, leaf of b, how often.

        Each level takes a pair of nodes once per ``i``, with the number of places at which it stands.
        """
        of, x, y, times = np.arange(len(a)), self.roots[a], self.roots[b], np.ones(len(a), dtype=np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            left, right = self.levels[level]
            of, times = np.concatenate([of, of]), np.concatenate([times, times])
            x, y = np.concatenate([left[x], right[x]]), np.concatenate([left[y], right[y]])
            k = len(self.values) if level == 0 else len(self.levels[level - 1][0])
            met, place = np.unique((of * k + x) * k + y, return_inverse=True)
            summed = np.zeros(len(met), dtype=np.int64)
            np.add.at(summed, place, times)
            of, x, y, times = met // (k * k), met // k % k, met % k, summed
        return of, x, y, times


def shares(values: np.ndarray, total: int, terms: int) -> np.ndarray:
    """The share of each count of a group in billionths, exact: 1 + floor(UNIT (c + 2) / (total + 2 terms))."""
    return np.array([1 + UNIT * (int(c) + 2) // (total + 2 * terms) for c in values], dtype=np.int64)


def price(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


def pair_prices(trees: Trees, share: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The price of each pair of trees ``a[i], b[i]``; ``share``: per tree and leaf number."""
    out = np.zeros(len(a), dtype=np.int64)
    step = max(1, _WALK // trees.leaves.shape[1])
    for at in range(0, len(a), step):
        of, x, y, times = trees.leaf_pairs(a[at : at + step], b[at : at + step])
        f = price(share[a[at + of], x], share[b[at + of], y])
        f[trees.values[x] == _PAD] = 0
        np.add.at(out, at + of, f * times)
    return out


def top_terms(trees: Trees, share: np.ndarray, a: int, whole: int, by_name: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and prices of the terms that tree ``a`` has more of than ``whole``: dearest first, then by name."""
    k = len(trees.values)
    met, place = np.unique(trees.leaves[a] * k + trees.leaves[whole], return_inverse=True)
    x, y = met // k, met % k
    p, q = share[a, x], share[whole, y]
    counts = (trees.values[x] > 0) & (p > q)
    f = np.where(counts, price(p, q), -1)[place][: len(by_name)]
    found = np.flatnonzero(f >= 0)
    found = found[np.lexsort((by_name[found], -f[found]))][:top]
    return found, f[found]


_PRICED = "part string, lang string, source string, item binary, value long"


def _priced(top: int):
    def work(key, t):
        first, second = key[2].as_py(), key[3].as_py()
        lang, rows = key[0].as_py(), t.to_pylist()
        rows.sort(key=lambda r: (r["idx"] < 0, r["idx"]))  # the language itself comes last
        size, terms = rows[0]["size"], rows[0]["terms"]
        counts = np.zeros((len(rows), size), dtype=np.int64)
        for i, r in enumerate(rows):
            if r["at"]:
                counts[i, r["at"]] = r["n"]
        trees = Trees(counts)
        share = np.stack([shares(np.maximum(trees.values, 0), r["total"], terms) for r in rows])
        groups = [i for i, r in enumerate(rows) if r["idx"] >= 0]
        tile = np.array([rows[i]["tile"] for i in groups])
        i, j = np.triu_indices(len(groups), 1)
        mine = (tile[i] == first) & (tile[j] == second)
        i, j = i[mine], j[mine]
        values = pair_prices(trees, share, i, j).tolist()
        names = [r["source"] for r in rows]
        out = []
        for a, b, v in zip(i.tolist(), j.tolist(), values, strict=True):
            out += [("pair", lang, names[a], names[b].encode(), v), ("pair", lang, names[b], names[a].encode(), v)]
        if first == second:
            words = rows[-1]["names"]
            by_name = np.empty(size, dtype=np.int64)
            by_name[sorted(range(size), key=words.__getitem__)] = np.arange(size)
            for a in groups:
                for at, f in zip(*(v.tolist() for v in top_terms(trees, share, a, len(rows) - 1, by_name, top)), strict=True):
                    out.append(("term", lang, names[a], words[at], f))
        columns = list(zip(*out, strict=True)) or [()] * 5
        types = (pa.string(), pa.string(), pa.string(), pa.binary(), pa.int64())
        return pa.table([pa.array(c, ty) for c, ty in zip(columns, types, strict=True)], names=["part", "lang", "source", "item", "value"])

    return work


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """``lang, source, part, item, value, rank``.

    ``docs``: text, lang, source (NULL is empty; other columns are not looked
    at; repeated rows are documents of their own). Part ``pair``: the price of
    each other source of the language. Part ``term``: the ``top`` terms that a
    source has a larger share of than its language has. Languages without kept
    terms have pairs of price 0; a source that is alone in its language has none.
    An empty table gives no rows.
    """
    counts = stored(term_counts(docs), "term-counts")
    words = stored(vocabulary(counts, least_docs), "vocabulary")
    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("total").alias("lang_total"))
    named = stored(counts.join(words.select("lang", "term", "id"), ["lang", "term"]).select("lang", "source", "id", "n"), "kept-counts")
    totals = named.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = counts.select("lang", "source").distinct().withColumn("idx", F.row_number().over(by_source) - 1)
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = stored(
        groups.select(
            "lang", "source", "idx", F.floor(F.col("idx") / tile).cast("int").alias("tile"), F.coalesce("total", F.lit(0)).alias("total"),
            F.coalesce("terms", F.lit(0)).alias("terms"), "lang_total",
            F.max(F.floor(F.col("idx") / tile)).over(Window.partitionBy("lang")).cast("int").alias("last"),
        ), "groups",
    )

    # One row per group and block, and one per language and block, with the counts that are not 0.
    at = (F.col("id") % block).cast("int").alias("at")
    number = F.floor(F.col("id") / block).cast("int").alias("block")

    def packed(rows: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
        lists = rows.groupBy(*keys, "block").agg(F.sort_array(F.collect_list(F.struct(*values))).alias("_cells"))
        return lists.select(*keys, "block", *(F.col(f"_cells.{c}").alias(c) for c in values))

    of_groups = packed(named.select("lang", "source", number, at, "n"), ["lang", "source"], ["at", "n"])
    of_langs = packed(words.select("lang", number, at, F.col("total").alias("n"), F.col("term").alias("names")), ["lang"], ["at", "n", "names"])
    blocks = F.explode(F.sequence(F.lit(0), F.ceil(F.col("terms") / block).cast("int") - 1)).alias("block")
    size = F.least(F.lit(block), F.col("terms") - F.col("block") * block).cast("int").alias("size")
    facts = ["lang", "block", "idx", "tile", "source", "total", "terms", size, "at", "n", "names"]
    some = groups.where(F.col("terms") > 0).select("*", blocks).join(of_groups, ["lang", "source", "block"], "left")
    pair_of_tiles = F.explode(
        F.transform(F.sequence(F.lit(0), F.col("last")), lambda u: F.struct(F.least(u, F.col("tile")).alias("ti"), F.greatest(u, F.col("tile")).alias("tj")))
    ).alias("_p")
    cells = some.withColumn("names", F.lit(None).cast("array<binary>")).select(*facts, pair_of_tiles)
    per_lang = groups.select("lang", "terms", "lang_total", "tile").distinct().join(of_langs, "lang")
    whole = per_lang.withColumns({"idx": F.lit(-1), "source": F.lit(""), "total": F.col("lang_total")}).select(
        *facts, F.struct(F.col("tile").alias("ti"), F.col("tile").alias("tj")).alias("_p")
    )
    tasks = cells.unionByName(whole).select("*", F.col("_p.ti").alias("ti"), F.col("_p.tj").alias("tj")).drop("_p")
    priced = tasks.groupBy("lang", "block", "ti", "tj").applyInArrow(_priced(top), _PRICED)

    bare = groups.where(F.col("terms") == 0)
    others = bare.select("lang", F.col("source").cast("binary").alias("item"))
    nothing = bare.join(others, "lang").where(F.col("source").cast("binary") != F.col("item")).select(
        F.lit("pair").alias("part"), "lang", "source", "item", F.lit(0).cast("long").alias("value")
    )
    found = priced.unionByName(nothing).groupBy("part", "lang", "source", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("part", "lang", "source").orderBy(F.col("value").desc(), "item")
    terms = found.where(F.col("part") == "term").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = found.where(F.col("part") == "pair").withColumn("rank", F.row_number().over(order))
    both = stored(pairs.unionByName(terms), "divergence")
    return both.select("lang", "source", "part", F.col("item").cast("string").alias("item"), "value", "rank")
