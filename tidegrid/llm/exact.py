"""Exact de-duplication with an index of live texts: cuckoo filters over text digests, verified on bucketed content.

A text's key is the SHA-256 of its normalised form. Keys are dealt to shards by
their last bytes. A shard has a cuckoo filter (16-bit prints, four slots a
bucket, two buckets a print) and its content: per live key the number of rows
and the row that stays, in buckets by the key. A key that the filter does not
hold is new, without a look at the content; a hit is verified against the
whole keys of its bucket. A key leaves the filter when its last row is deleted.
Where an insertion finds no slot, the filter is built again at twice the size
from the stored keys, as prints alone do not tell the buckets of a larger one.

An index is three tables in the shared folder: rows (doc_id, place, key),
groups (shard, key, n, first row) and filters (shard, bits, prints). ``insert``
and ``delete`` make a new index of them; the old one stays as it was.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm.common import stored

SLOTS = 4
KICKS = 200
#: Keys that a shard tests against its filter at a time.
CHUNK = 4_096
#: Rows of one shard, about: what a task holds of the index.
ROWS_PER_SHARD = 1 << 16
#: A key with more than this share of all rows is hot; there are at most as many hot keys as the number says.
HOT_KEYS = 2_000

_ROWS = "doc_id long, place long, key binary"
_GROUPS = "shard int, key binary, n long, doc_id long, place long"
_FILTERS = "shard int, bits int, prints binary"


class CuckooFilter:
    """Prints of 64-bit hashes: no false negatives, few false positives, deletion.

    ``bits``: there are 2^bits buckets. The same hash can be inserted as often
    as both of its buckets have slots.
    """

    def __init__(self, bits: int, slots: np.ndarray | None = None):
        self.bits = bits
        self.slots = np.zeros((1 << bits, SLOTS), dtype=np.uint16) if slots is None else slots

    @classmethod
    def for_keys(cls, n: int) -> CuckooFilter:
        """A filter that ``n`` keys fill to at most four fifths."""
        return cls(max(int(np.ceil(np.log2(max(n, 1) * 1.25 / SLOTS))), 0))

    def _places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Print, first and second bucket; the second one follows from the first and the print, and the other way round."""
        prints = (hashes >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = (hashes & np.uint64((1 << self.bits) - 1)).astype(np.int64)
        return prints, first, self._other(first, prints)

    def _other(self, bucket, prints):
        return bucket ^ ((prints.astype(np.int64) * 0x5BD1E995) & ((1 << self.bits) - 1))

    def contains(self, hashes: np.ndarray) -> np.ndarray:
        prints, a, b = self._places(hashes)
        return ((self.slots[a] == prints[:, None]) | (self.slots[b] == prints[:, None])).any(axis=1)

    def insert(self, hashes: np.ndarray) -> bool:
        """False if a print found no slot; the filter is then of no more use and must be built again, larger."""
        prints, a, b = self._places(hashes)
        for p, i, j in zip(prints, a.tolist(), b.tolist(), strict=True):
            if not (self._put(p, i) or self._put(p, j) or self._kick(p, i)):
                return False
        return True

    def _put(self, p, bucket: int) -> bool:
        row = self.slots[bucket]
        for s in range(SLOTS):
            if not row[s]:
                row[s] = p
                return True
        return False

    def _kick(self, p, bucket: int) -> bool:
        """Moves prints to their other buckets until one has a slot; which one moves goes round, so runs agree."""
        for k in range(KICKS):
            s = k % SLOTS
            p, self.slots[bucket, s] = self.slots[bucket, s], p
            bucket = int(self._other(np.int64(bucket), p))
            if self._put(p, bucket):
                return True
        return False

    def delete(self, hashes: np.ndarray) -> None:
        """Takes out one print of each hash; only hashes that were inserted may be deleted."""
        prints, a, b = self._places(hashes)
        for p, i, j in zip(prints, a.tolist(), b.tolist(), strict=True):
            for bucket in (i, j):
                found = np.flatnonzero(self.slots[bucket] == p)
                if len(found):
                    self.slots[bucket, found[0]] = 0
                    break
            else:
                raise KeyError("a hash that was never inserted")


def _hashes(keys: list[bytes]) -> np.ndarray:
    """The first eight bytes of each key."""
    return np.frombuffer(b"".join([k[:8] for k in keys]), dtype="<u8")


class Shard:
    """A filter and the content of its live keys, in buckets by the first bytes of the key."""

    def __init__(self, groups: list[tuple], filter_: CuckooFilter | None = None, expected: int = 0):
        self.buckets: dict[bytes, dict[bytes, list]] = {}
        self.n = self.resized = self.verified = 0
        for key, *rest in groups:
            self.buckets.setdefault(key[:2], {})[key] = rest
            self.n += 1
        self.filter = filter_
        if filter_ is None:
            self._build(CuckooFilter.for_keys(max(self.n, expected)).bits)

    def keys(self) -> list[bytes]:
        return [k for bucket in self.buckets.values() for k in bucket]

    def _build(self, bits: int) -> None:
        """The filter anew from the stored keys, twice as large until all of them fit."""
        hashes = _hashes(self.keys())
        while True:
            self.filter = CuckooFilter(bits)
            if self.filter.insert(hashes):
                return
            bits += 1

    def _find(self, key: bytes) -> list | None:
        self.verified += 1
        return self.buckets.get(key[:2], {}).get(key)

    def add(self, keys: list[bytes], news: list[list]) -> None:
        """Adds ``[rows, doc_id, place]`` to each key; the same key may come several times."""
        for at in range(0, len(keys), CHUNK):
            once: dict[bytes, list] = {}
            for key, new in zip(keys[at : at + CHUNK], news[at : at + CHUNK], strict=True):
                once[key] = _merged(once[key], new) if key in once else list(new)
            self._add(list(once), list(once.values()))

    def _add(self, keys: list[bytes], news: list[list]) -> None:
        """Different keys: what the filter does not hold is new, a hit is looked up in its bucket."""
        hashes = _hashes(keys)
        fresh = ~self.filter.contains(hashes)
        for i in np.flatnonzero(~fresh).tolist():
            found = self._find(keys[i])
            if found is None:
                fresh[i] = True
            else:
                found[:] = _merged(found, news[i])
        for i in np.flatnonzero(fresh).tolist():
            self.buckets.setdefault(keys[i][:2], {})[keys[i]] = news[i]
            self.n += 1
        if not self.filter.insert(hashes[fresh]):
            self.resized += 1
            self._build(self.filter.bits + 1)

    def replace(self, keys: list[bytes], news: list[list | None]) -> None:
        """Sets what is left of each key; a key with nothing left goes from the content and the filter."""
        for key, new in zip(keys, news, strict=True):
            if new is not None:
                self.buckets[key[:2]][key] = list(new)
                continue
            del self.buckets[key[:2]][key]
            self.n -= 1
            self.filter.delete(_hashes([key]))

    def groups(self) -> list[tuple]:
        return [(k, *v) for bucket in self.buckets.values() for k, v in bucket.items()]


def _merged(a: list, b: list) -> list:
    """``[rows, doc_id, place]`` of two parts of a group."""
    return [a[0] + b[0], *min(a[1:], b[1:], key=_first)]


def _first(row: list) -> tuple:
    """Order of rows of equal text: by id, rows without one last, then by place."""
    return row[0] is None, row[0] or 0, row[1]


@dataclass(frozen=True)
class Index:
    rows: DataFrame
    groups: DataFrame
    filters: DataFrame
    shards: int


def normalised(text: Column) -> Column:
    """Each run of ASCII white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, place, key`` per row, stored; ``place`` tells rows apart that are alike in all columns."""
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("place"),
        F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("key"),
    )
    return stored(rows, "exact-rows")


def _shard(key: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(shards)).cast("int")


def _partial(rows: DataFrame, shards: int) -> DataFrame:
    """``shard, key, n, doc_id, place``: what each Arrow batch holds of a key, so a hot key is a row per batch at most."""

    def work(parts):
        for b in parts:
            t = pa.Table.from_batches([b])
            t = t.sort_by([("shard", "ascending"), ("key", "ascending"), ("none", "ascending"), ("doc_id", "ascending"), ("place", "ascending")])
            found = t.group_by(["shard", "key"], use_threads=False).aggregate([("key", "count"), ("doc_id", "first"), ("place", "first")])
            yield from pa.table(
                [found[c] for c in ("shard", "key", "key_count", "doc_id_first", "place_first")],
                names=["shard", "key", "n", "doc_id", "place"],
            ).to_batches()

    dealt = rows.select(_shard(F.col("key"), shards).alias("shard"), "key", F.col("doc_id").isNull().alias("none"), "doc_id", "place")
    return dealt.mapInArrow(work, _GROUPS)


def _lists(t: pa.Table) -> tuple[list[bytes], list[list]]:
    rest = (t[c].to_pylist() for c in ("n", "doc_id", "place"))
    return t["key"].to_pylist(), [list(x) for x in zip(*rest, strict=True)]


def _load(table: pa.Table) -> Shard:
    """The shard as it was: its groups, and its filter in the row that has one."""
    mine = table.filter(pc.is_valid(table["key"]))
    keys, rest = _lists(mine)
    held = table.filter(pc.is_valid(table["prints"]))
    filter_ = None
    if held.num_rows:
        bits = held["bits"][0].as_py()
        filter_ = CuckooFilter(bits, np.frombuffer(held["prints"][0].as_py(), dtype="<u2").reshape(-1, SLOTS).copy())
    return Shard([(k, *r) for k, r in zip(keys, rest, strict=True)], filter_)


_STATE = pa.schema(
    [("shard", pa.int32()), ("key", pa.binary()), ("n", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64()), ("bits", pa.int32()), ("prints", pa.binary())]
)
_STATE_DDL = f"{_GROUPS}, bits int, prints binary"


def _dump(shard: int, s: Shard) -> pa.Table:
    """One row per group and one row with the filter."""
    groups = s.groups()
    columns = list(zip(*groups, strict=True)) if groups else [(), (), (), ()]
    m = len(groups) + 1
    data = [[shard] * m, *([*c, None] for c in columns), [None] * (m - 1) + [s.filter.bits], [None] * (m - 1) + [s.filter.slots.astype("<u2").tobytes()]]
    return pa.table([pa.array(v, f.type) for v, f in zip(data, _STATE, strict=True)], schema=_STATE)


def _state(index: Index) -> DataFrame:
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("key", "binary"), ("n", "long"), ("doc_id", "long"), ("place", "long"))]
    groups = index.groups.select("shard", "key", "n", "doc_id", "place", F.lit(None).cast("int").alias("bits"), F.lit(None).cast("binary").alias("prints"))
    return groups.unionByName(index.filters.select("shard", *nothing, "bits", "prints"))


def _changed(index: Index | None, rows: DataFrame, changes: DataFrame, shards: int, work) -> Index:
    """The index after ``work(shard, changes)`` in each shard that has changes; the others stay as they are."""

    def both(key, new, old):
        s = _load(old) if old.num_rows else Shard([], expected=0)
        if new.num_rows:
            work(s, new)
        number = key[0].as_py()
        return _dump(number, s)

    def fresh(key, new):
        s = Shard([])
        work(s, new)
        return _dump(key[0].as_py(), s)

    if index is None:
        out = changes.groupBy("shard").applyInArrow(fresh, _STATE_DDL)
    else:
        out = changes.groupBy("shard").cogroup(_state(index).groupBy("shard")).applyInArrow(both, _STATE_DDL)
    state = stored(out, "exact-state")
    return Index(
        rows,
        state.where(F.col("key").isNotNull()).select("shard", "key", "n", "doc_id", "place"),
        state.where(F.col("prints").isNotNull()).select("shard", "bits", "prints"),
        shards,
    )


def build(docs: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> Index:
    """An index of ``docs`` (doc_id, text; other columns are not looked at). An empty table makes an empty index."""
    rows = keyed(docs)
    return _inserted(None, rows, rows, max(1, -(-rows.count() // rows_per_shard)))


def insert(index: Index, docs: DataFrame) -> Index:
    """The index with the rows of ``docs`` as well; their places follow those that are there."""
    last = index.rows.agg(F.coalesce(F.max("place"), F.lit(-1))).first()[0]
    rows = keyed(docs).withColumn("place", F.col("place") + F.lit(last + 1))
    return _inserted(index, index.rows.unionByName(rows), rows, index.shards)


def _inserted(index: Index | None, rows: DataFrame, new: DataFrame, shards: int) -> Index:
    def work(s: Shard, t: pa.Table) -> None:
        s.add(*_lists(t))

    return _changed(index, rows, _partial(new, shards), shards, work)


def delete(index: Index, ids: DataFrame) -> Index:
    """The index without the rows whose ``doc_id`` is in ``ids``; ids that it does not have are passed over.

    A group whose row that stays is deleted keeps the next one; a text without
    rows is no longer live.
    """
    gone = ids.select("doc_id").distinct()
    rows = stored(index.rows.join(gone, "doc_id", "left_anti"), "exact-rows")
    touched = index.rows.join(gone, "doc_id", "left_semi").select("key").distinct()
    left = _partial(rows.join(touched, "key", "left_semi"), index.shards)
    none = touched.select(_shard(F.col("key"), index.shards).alias("shard"), "key", F.lit(0).cast("long").alias("n"), *(F.lit(None).cast("long").alias(c) for c in ("doc_id", "place")))

    def work(s: Shard, t: pa.Table) -> None:
        left: dict[bytes, list | None] = {}
        for key, new in zip(*_lists(t), strict=True):
            old = left.setdefault(key, None)
            if new[0]:
                left[key] = new if old is None else _merged(old, new)
        s.replace(list(left), list(left.values()))

    return _changed(index, rows, left.unionByName(none), index.shards, work)


def known(index: Index, docs: DataFrame) -> DataFrame:
    """``doc_id, key, keep_id, group_size`` for the rows of ``docs`` whose text is live in the index.

    Rows meet the filters first; only hits are joined to the bucketed content.
    """

    def work(key, new, held):
        t = new.select(["doc_id", "key", "shard"])
        if not held.num_rows or not new.num_rows:
            return t.slice(0, 0)
        filter_ = CuckooFilter(held["bits"][0].as_py(), np.frombuffer(held["prints"][0].as_py(), dtype="<u2").reshape(-1, SLOTS))
        return t.filter(pa.array(filter_.contains(_hashes(t["key"].to_pylist()))))

    rows = keyed(docs).withColumn("shard", _shard(F.col("key"), index.shards))
    keys = rows.select("shard", "key").distinct().withColumn("doc_id", F.lit(None).cast("long"))
    hits = keys.groupBy("shard").cogroup(index.filters.groupBy("shard")).applyInArrow(work, "doc_id long, key binary, shard int")
    live = index.groups.join(hits.select("shard", "key"), ["shard", "key"], "left_semi")
    return rows.join(live.select("key", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size")), "key").select("doc_id", "key", "keep_id", "group_size")


def decisions(index: Index) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, key`` per live row.

    ``keep_id`` is the smallest id of the rows with equal text, NULL where none
    has one; exactly one row of each group is kept, the first by id and place.
    A hot key, with more than one in ``HOT_KEYS`` of all rows, is handed to the
    rows by broadcast; there cannot be more than ``HOT_KEYS`` of them. All other
    rows meet their group in an equi-join.
    """
    total = index.rows.count()
    found = index.groups.select("key", F.col("doc_id").alias("keep_id"), F.col("n").alias("group_size"), F.col("place").alias("_kept_at"))
    is_hot = F.col("group_size") * F.lit(HOT_KEYS) > F.lit(total)
    hot = F.broadcast(found.where(is_hot))
    by_hot = index.rows.join(hot, "key")
    others = index.rows.join(F.broadcast(found.where(is_hot).select("key")), "key", "left_anti").join(found.where(~is_hot), "key")
    both = by_hot.unionByName(others)
    return both.select("doc_id", "keep_id", "group_size", (F.col("place") == F.col("_kept_at")).alias("kept"), "key")


def filter_stats(spark: SparkSession, index: Index) -> DataFrame:
    """``shard, keys, slots``: how full each filter is."""
    slots = (F.length("prints") / F.lit(2)).cast("bigint")
    return index.filters.select("shard", slots.alias("slots")).join(index.groups.groupBy("shard").agg(F.count(F.lit(1)).alias("keys")), "shard", "left")
