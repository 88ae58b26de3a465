"""The cuckoo-filter index: the filter, insertion, deletion, lookups and what the query returns."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import exact

DOCS = "doc_id long, text string"


def test_filter_holds_what_was_inserted_and_not_what_was_deleted():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 1 << 63, 20_000).astype(np.uint64))
    f = exact.CuckooFilter.for_keys(len(hashes))
    assert f.insert(hashes) and f.contains(hashes).all()
    others = np.setdiff1d(rng.integers(0, 1 << 63, 50_000).astype(np.uint64), hashes)
    assert f.contains(others).mean() < 0.002
    f.delete(hashes[:5_000])
    assert f.contains(hashes[5_000:]).all() and f.contains(hashes[:5_000]).mean() < 0.002
    with pytest.raises(KeyError):
        f.delete(others[~f.contains(others)][:1])


def test_filter_says_when_it_overflows():
    f = exact.CuckooFilter(1)
    assert f.insert(np.full(2 * exact.SLOTS, 5, dtype=np.uint64)) and not f.insert(np.array([5], dtype=np.uint64))


def test_shard_grows_from_its_stored_keys():
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(9_000)]
    s = exact.Shard([])
    s.add(keys + keys[:100], [[1, i, i] for i in range(9_000)] + [[2, None, -1]] * 100)
    assert s.resized >= 2 and s.n == 9_000 and s.filter.contains(exact._hashes(keys)).all()
    got = {k: r for k, *r in s.groups()}
    assert all(got[k] == [3 if i < 100 else 1, i, i] for i, k in enumerate(keys))
    # The same first eight bytes again and again: a print can stand only eight times.
    s = exact.Shard([])
    with_one_print = [keys[0][:8] + bytes([i]) * 24 for i in range(8)]
    s.add(with_one_print, [[1, i, 0] for i in range(8)])
    assert s.n == 8 and s.filter.contains(exact._hashes(with_one_print)).all()


def plain(docs):
    groups = {}
    for d, t in docs:
        key = re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
        groups.setdefault(hashlib.sha256(key.encode()).digest(), []).append(d)
    out = []
    for key, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        first = sorted(ids, key=lambda i: (i is None, i or 0))
        out += [(d, least, len(ids), n == 0, key.hex()) for n, d in enumerate(first)]
    return sorted(out, key=str)


def rows_of(index):
    got = exact.decisions(index).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, bytes(r.key).hex()) for r in got), key=str)


def corpus(seed=3):
    r = random.Random(seed)
    texts = [f"text {i} " + "x" * r.randint(0, 30) for i in range(300)]
    docs = [(d, r.choice(texts)) for d in r.sample(range(10_000), 700)]
    docs += [(20_000 + i, "hot\t \ncopy") for i in range(400)] + [(30_000, "hot copy"), (30_001, " hot copy"), (30_002, "hot copy ")]
    docs += [(40_000, None), (40_001, ""), (40_002, " "), (40_003, "\x0b\x0c\r"), (40_004, "\xa0"), (40_005, "\x1c")]
    docs += [(None, "no id"), (None, "no id"), (None, texts[0]), (50_000, "twice"), (50_000, "twice"), (50_000, "other"), (60_000, "w " * 300_000)]
    return docs


@pytest.mark.parametrize("per_shard", [50, 1 << 16])
def test_decisions_equal_plain_groups(spark, per_shard, monkeypatch):
    monkeypatch.setattr(exact, "HOT_KEYS", 5)  # the hot copy goes its own way
    docs = corpus()
    df = spark.createDataFrame(docs, DOCS).repartition(7).withColumn("key", F.lit("clash")).withColumn("place", F.lit(1))
    index = exact.build(df, per_shard)
    assert rows_of(index) == plain(docs)
    assert index.shards == (1 if per_shard > 100 else -(-len(docs) // 50))


def test_empty_table(spark):
    index = exact.build(spark.createDataFrame([], DOCS))
    assert rows_of(index) == []
    docs = corpus()[:50]
    assert rows_of(exact.insert(index, spark.createDataFrame(docs, DOCS))) == plain(docs)


def test_inserting_and_deleting_equals_building_anew(spark):
    docs = [d for d in corpus() if d[0] is not None]
    first, second = docs[::2], docs[1::2]
    index = exact.insert(exact.build(spark.createDataFrame(first, DOCS), 200), spark.createDataFrame(second, DOCS))
    assert rows_of(index) == plain(docs)
    # All rows of some groups, the rows that stay of others, and ids that are not there.
    gone = {d for d, _ in docs if d % 3 == 0 or d >= 40_000} | {20_000, 20_001, 999_999}
    less = exact.delete(index, spark.createDataFrame([(d,) for d in [*gone, *gone]], "doc_id long"))
    left = [d for d in docs if d[0] not in gone]
    assert rows_of(less) == plain(left)
    assert rows_of(exact.insert(less, spark.createDataFrame(docs[:200], DOCS))) == plain(left + docs[:200])
    assert rows_of(index) == plain(docs)  # the old index is as it was
    stats = exact.filter_stats(spark, less).agg(F.sum("keys")).first()[0]
    assert stats == len({k for *_, k in plain(left)})


def test_lookups_find_live_texts_only(spark):
    docs = [(1, "a b"), (2, "a  b"), (3, "c"), (4, None)]
    index = exact.delete(exact.build(spark.createDataFrame(docs, DOCS)), spark.createDataFrame([(1,), (3,)], "doc_id long"))
    asked = spark.createDataFrame([(10, "a\tb"), (11, "c"), (12, ""), (13, "new"), (14, "a b")], DOCS)
    got = exact.known(index, asked).select("doc_id", "keep_id", "group_size").collect()
    assert sorted(map(tuple, got)) == [(10, 2, 1), (12, 4, 1), (14, 2, 1)]
