"""Token shards, WARC archives, mixing and the pipeline."""

import gzip
import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidegrid.llm import files, mixing, registry, tokens, warc
from tidegrid.llm.common import stored, table
from tidegrid.session import work_dir

DOCS = "doc_id long, text string"
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("n,top", [(0, 1), (1, 1), (7, 2), (511, 3), (512, 70000), (3000, 49408)])
def test_wavelet_matrix(n, top):
    rng = np.random.default_rng(n)
    v = rng.integers(0, top, n).astype(np.uint32)
    raw = tokens.dump(v, [None, *range(3)], np.array([0, n, 0, 0]))
    shard = tokens.Shard(raw)
    wm = shard.matrix
    assert (wm.values() == v).all() and shard.doc_ids == [None, 0, 1, 2] and shard.lengths.tolist() == [0, n, 0, 0]
    for i in rng.integers(0, n, 20) if n else []:
        assert wm.access(int(i)) == v[i]
    for x in {0, 1, top, 1 << 20, *v[:10].tolist()}:
        places = np.flatnonzero(v == x)
        for end in (0, n // 3, n, n + 5):
            assert wm.rank(x, end) == (places < end).sum()
        assert [wm.select(x, j) for j in range(len(places) + 1)][-5:] == [*places.tolist(), None][-5:]
    with pytest.raises(IndexError):
        wm.access(n)


def test_words_from_memory_equal_whole_texts():
    path = tokens.vocabulary()
    whole, encoder = Tokenizer.from_file(path), tokens.WordEncoder(path, most=5_000)
    r = random.Random(1)
    parts = [*"abcXYZ'sté.,!?0 12\n\t", "́", "̈", "é", "K", "İ", "ß", "Σς", "ẛ̣", "가", "ᄀ", "🙂", "‍", "\x1c", "\x85", "\xa0", "　", "<|endoftext|>", " <|startoftext|> ", "'ll", "ﬁ"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(3000)]
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(raw, dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids + [2], text


def test_texts_parted_in_pieces_of_any_size(monkeypatch):
    path = tokens.vocabulary()
    whole = Tokenizer.from_file(path)
    r = random.Random(3)
    parts = [*"abXY 12\n\t.,!_<|>'", "é", "×", "÷", "İ", "»", "=\u0338", "e\u0301", "ſ", "<|endoftext|>", "日本", "\x00", "\x7f", "\x1c"]
    texts = [None, "", " ", *("".join(r.choice(parts) for _ in range(r.randint(0, 60))) for _ in range(400)), None]
    for piece in (1, 100, 1 << 23):
        monkeypatch.setattr(tokens, "_PIECE", piece)
        for text, raw in zip(texts, tokens.WordEncoder(path).encode(texts), strict=True):
            assert np.frombuffer(raw, dtype="<u4").tolist() == whole.encode(text or "", add_special_tokens=False).ids + [2], text


def test_memory_of_pieces_is_bounded():
    encoder = tokens.WordEncoder(tokens.vocabulary(), most=20_000)
    for i in range(40):
        list(encoder.encode([f"word{chr(97 + i % 26) * (i // 26 + 1)} " + " ".join("".join(p) for p in zip("abcdefgh" * 9, "qrstuv" * 12, chr(97 + i % 26) * 72))]))
        assert encoder._held <= 20_000 and len(encoder._young) + len(encoder._old) < 250


def test_plain_words_take_the_short_way():
    path = tokens.vocabulary()
    whole, encoder = Tokenizer.from_file(path), tokens.WordEncoder(path)
    texts = [c + "a" + d + "." + c for c in map(chr, range(0x20, 0x260)) for d in ("B", "İ", "é")]
    texts += [c * 2 + m for c in "aZéŉǅſ" for m in map(chr, range(33, 127))]
    for text, raw in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(raw, dtype="<u4").tolist() == whole.encode(text, add_special_tokens=False).ids + [2], text


def plain_tokens(docs):
    tok, at, out = Tokenizer.from_file(tokens.vocabulary()), 0, []
    for d, t in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = tok.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        at += len(ids)
    return out


def test_tokens_round_trip(spark, monkeypatch):
    r = random.Random(2)
    docs = [(d, " ".join(r.choice(("the", "Word", "naïve", "x,y")) for _ in range(r.randint(0, 60)))) for d in r.sample(range(1000), 300)]
    docs += [(2000, None), (2001, ""), (None, "no id"), (2002, "again"), (2002, "again"), (2003, "long " * 60_000)]
    monkeypatch.setattr(tokens, "SHARD_TOKENS", 500)
    df = spark.createDataFrame(docs, DOCS).repartition(5).withColumn("start", F.lit("clash")).withColumn("file", F.lit(1))
    assert sorted(map(tuple, tokens.round_trip(df, tokens.vocabulary()).collect()), key=str) == sorted(plain_tokens(docs), key=str)
    assert tokens.round_trip(df.limit(0), tokens.vocabulary()).count() == 0


def test_occurrences_in_files(spark):
    docs = spark.createDataFrame([(1, "the cat"), (2, "a the the"), (3, "dog")], DOCS)
    folder = work_dir(spark, "shards")
    shards = stored(tokens.write_shards(docs, folder, tokens.vocabulary(), shard_tokens=3), "index")
    the = Tokenizer.from_file(tokens.vocabulary()).encode("the", add_special_tokens=False).ids[0]
    found = tokens.find_token(spark, folder, shards, the).collect()
    assert sum(x.n for x in found) == 3 and {x.position for x in found if x.n} == {0, 1}


def test_token_query_on_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    assert sorted(map(tuple, registry.op2_tokens(spark, SF).collect())) == sorted(plain_tokens(docs))


PAGES = "page_id long, url string, html string"


def odd_pages():
    big, other = "é" * 600, "b" * 1000
    rows = [(1, "http://a/1", big), (5, "http://a/5", big), (3, None, big), (2, "http://b", other), (4, "http://c", None), (6, "http://d", ""),
            (7, "http://e\r\nX-Evil: 1", "x"), (8, "http://f", "x"), (9, "u", "b" * 999), (10, "u", "b" * 999), (None, "n", other), (11, "r", "z" * 2000), (11, "r", "z" * 2000)]
    return rows + [(None, "n", "q" * 1500)] * 2 + [(100 + i, "hot", "h" * 3000) for i in range(200)] + [(400, "l", "w " * 300_000)]


def test_archives_round_trip(spark):
    rows = odd_pages()
    df = spark.createDataFrame(rows, PAGES).repartition(4).withColumn("payload", F.lit(1)).withColumn("offset", F.lit("x"))
    first = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= 1000:
            first[h] = max(first.get(h, p), p)
    want = []
    for p, u, h in rows:
        raw = (h or "").encode()
        to = first.get(h) if first.get(h) != p else None
        u = u and u.replace("\r", "%0D").replace("\n", "%0A")
        want.append((p, u, "revisit" if to is not None else "response", len(raw), hashlib.sha1(raw).hexdigest(), to))
    assert sorted(map(tuple, warc.round_trip(spark, df).collect()), key=str) == sorted(want, key=str)
    assert warc.round_trip(spark, df.limit(0)).count() == 0


def test_selected_records_and_whole_files(spark):
    folder = work_dir(spark, "warc")
    index = warc.archive(spark, spark.createDataFrame(odd_pages(), PAGES), folder, roll_mb=1)
    got = warc.read(index.where("page_id IN (2, 7, 400)")).collect()
    assert {(r.page_id, r.block.decode()) for r in got} == {(2, "b" * 1000), (7, "x"), (400, "w " * 300_000)}
    n = 0
    for (uri,) in index.select("file").distinct().collect():
        raw = gzip.decompress(files.open_file(uri).read())
        while raw:
            head, block = warc.parse(raw)
            raw = raw[raw.index(b"\r\n\r\n") + 4 + len(block) + 4 :]
            n += 1
    assert n == index.count() == len(odd_pages())


def test_neighbouring_ranges_become_one_read():
    index = [("a", 0, 10), ("a", 10, 5), ("a", 100, 5), ("b", 105, 5), ("b", 130, 10)]
    assert warc.coalesced(index, 20, 1000) == [("a", 0, 15, [(0, 10), (10, 5)]), ("a", 100, 105, [(100, 5)]), ("b", 105, 140, [(105, 5), (130, 10)])]
    assert len(warc.coalesced(index, 1000, 10)) == 5


def plain_targets(sizes):
    """Sources in order, filled round by round."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = 2.0 * sizes[s]
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def mix_rows():
    r = random.Random(3)
    names = ["b", "a", "Z", "é", None, "", "only empty", "one"]
    rows = [(d, "w " * r.choice((0, 1, 5, 40, 300)), r.choice(names[:6])) for d in range(400)]
    return rows + [(1000, None, "a"), (1001, "x\x1cy z", "one"), (1002, "", "only empty"), (1003, "w", "a"), (1003, "w", "a"), (None, "w w", "b"), (None, None, None), (1004, "w " * 60_000, "b")]


@pytest.mark.parametrize("per_range", [20_000, 7])
def test_mix_meets_its_targets(spark, monkeypatch, per_range):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", per_range)
    rows = mix_rows()
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumn("target", F.lit("clash"))
    sized = mixing.with_sizes(df)
    got = mixing.assign(sized).collect()
    assert len(got) == len(rows)
    sizes = {}
    for d, t, s in rows:
        n = len((t or "").encode().split())
        sizes[s] = sizes.get(s, 0) + n
    want = plain_targets(sizes)
    taken = {}
    for x in got:
        assert x._size == len((x.text or "").encode().split())
        assert x._source_size == sizes[x.source] and abs(x._target - want[x.source]) < 1e-6
        assert 0 <= x._taken <= 2 * x._size and x._taken == sum(s.words for s in x._slots)
        assert all(0 <= s.position <= 1 for s in x._slots)
        taken[x.source] = taken.get(x.source, 0) + x._taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in want)
    again = mixing.assign(sized.repartition(3)).collect()
    key = lambda x: (str(x.doc_id), str(x.text), x._taken, str(x._slots))
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_decisions_come_from_the_sorted_training_order(spark, monkeypatch):
    rows = mix_rows()
    sized = mixing.with_sizes(spark.createDataFrame(rows, DOCS + ", source string")).drop("text")
    orders = []

    def in_order(passes, plain=mixing.in_order):
        out = plain(passes)
        orders.append([r["_at"] for r in out.collect()])
        return out

    monkeypatch.setattr(mixing, "in_order", in_order)
    got = [tuple(r) for r in mixing.decisions(sized).select("doc_id", "source", "_size", "_taken", "_first").collect()]
    places = [(r.doc_id, r.source, r["_size"], r["_taken"], min((s.position for s in r["_slots"]), default=None)) for r in mixing.assign(sized).collect()]
    assert sorted(got, key=str) == sorted(places, key=str) and len(got) == len(rows)
    assert len(orders) == 1 and orders[0] == sorted(orders[0]) and len(orders[0]) > len(rows)


def test_schedules_integrate_to_one(spark):
    share = spark.range(101).select((F.col("id") / 100).alias("u"))
    for slope in (-0.9, -0.5, 0.0, 0.5, 0.9):
        for r in share.select("u", mixing.position(F.col("u"), F.lit(slope)).alias("t")).collect():
            assert abs(r.t + slope * (r.t**2 - r.t) - r.u) < 1e-9


def test_mixed_order_and_texts(spark):
    rows = mix_rows()
    df = spark.createDataFrame(rows, DOCS + ", source string").withColumn("_at", F.lit("clash")).select("source", "_at", "text", "doc_id")
    got = mixing.mixed(df)
    assert got.columns == df.columns
    found = got.collect()
    words = lambda rows: sum(len((t or "").split()) for t in rows)
    total = words(t for _, t, _ in rows)
    assert abs(words(r.text for r in found) - 1.5 * total) <= 10
    texts = {}
    for d, t, _ in rows:
        texts.setdefault(d, []).append(t or "")
    assert all(any(" ".join(t.split()).startswith(" ".join(r.text.split())) for t in texts[r.doc_id]) for r in found)
    assert mixing.mixed(df.limit(0)).count() == 0


def test_pipeline_stages(spark):
    docs = table(spark, SF, "documents")
    before = {r.doc_id: r for r in docs.collect()}
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_dedup", "decontaminate", "mix", "tokens"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, SF), name)
        assert after.columns == docs.columns
        rows = after.collect()
        assert rows and {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
        if name != "mix":
            assert all(r == before[r.doc_id] for r in rows) and len({r.doc_id for r in rows}) == len(rows)
        docs = after
    last = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted(tuple(r)[2:] for r in corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect())
    assert got == sorted(x[2:] for x in plain_tokens(last))
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(tuple(r)[2:] for r in whole) == got


def test_the_pipeline_mixes_whole_texts(spark):
    rows = mix_rows()
    found = corpus_pipeline.mix(spark, spark.createDataFrame(rows, DOCS + ", source string"), SF).collect()
    assert {tuple(r) for r in found} <= set(rows)
    sizes, taken, longest = {}, {}, {}
    for d, t, s in rows:
        n = len((t or "").encode().split())
        sizes[s], longest[s] = sizes.get(s, 0) + n, max(longest.get(s, 0), n)
    for r in found:
        taken[r.source] = taken.get(r.source, 0) + len(r.text.encode().split())
    assert all(abs(taken.get(s, 0) - v) <= longest[s] / 2 + 1 for s, v in plain_targets(sizes).items())


def test_shards_keep_the_order_of_the_mix(spark):
    r = random.Random(8)
    rows = [(d, "w " * r.randint(1, 40), r.choice("abc")) for d in range(300)]
    docs = stored(corpus_pipeline.mix(spark, spark.createDataFrame(rows, DOCS + ", source string"), SF), "mix")
    place = F.struct("_metadata.file_name", "_metadata.row_index")
    want = [x.doc_id for x in docs.select("doc_id", place.alias("p")).orderBy("p").collect()]
    got = [x.doc_id for x in corpus_pipeline.tokens(spark, docs, SF).orderBy("start").collect()]
    assert got == want and want != sorted(want)


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
