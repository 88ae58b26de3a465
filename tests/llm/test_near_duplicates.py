"""SimHash, components, decontamination and line de-duplication against plain versions."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tidegrid.llm import components, decontaminate, lines, resemblance, simhash

DOCS = "doc_id long, text string"


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(pairs, values):
    root = {k: k for k in values}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a, b in pairs:
        root[find(a)] = find(b)
    least = {}
    for k, v in values.items():
        least[find(k)] = min(least.get(find(k), v), v)
    return {k: least[find(k)] for k in values}


@pytest.mark.parametrize("text", ["", None, "A", "a B", "x  Y\tz\x1cq", "Ünï coded wörds are here", " word" * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_is_that_of_the_builtin_hash(spark):
    one = spark.sql("SELECT xxhash64('a b c') AS h").first().h
    assert simhash.fingerprint("a b C") == one % (1 << 64)


def test_pairs_equal_brute_force(spark):
    r = random.Random(1)
    prints = {r.getrandbits(64) for _ in range(60)} | {0, (1 << 64) - 1}
    for base in list(prints)[:25]:
        for _ in range(12):
            x = base
            for _ in range(r.randint(1, 5)):
                x ^= 1 << r.randrange(64)
            prints.add(x)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    got = simhash.near_pairs(spark.createDataFrame([(p,) for p in signed], "fp long")).collect()
    want = {
        frozenset((a, b)) for i, a in enumerate(signed) for b in signed[:i]
        if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3
    }
    assert {frozenset((x.a, x.b)) for x in got} == want
    assert len(got) == len(want)


def test_exploded_chain_keys_are_not_broadcast(spark, tmp_path):
    """A stored table of fingerprints is below the threshold when its keys, up to 68 times as many, are not."""
    spark.range(2000).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/prints")
    pairs = simhash.near_pairs(spark.read.parquet(f"{tmp_path}/prints"))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") >= 2


def test_texts_that_share_shingles_meet_without_broadcast(spark, tmp_path):
    rows = spark.range(3000).select((F.col("id") % 900).alias("key"), F.lit(1).alias("weight"), F.col("id").alias("node"), F.lit(9).alias("n"), F.col("id").alias("root"), F.lit(9).alias("held"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    tested = rows.select(F.col("node").alias("a"), F.col("root").alias("b"))
    for met in (resemblance._met(rows, ["key"], 0.8), resemblance._binned_pairs(rows, tested, 1, 0.8)):
        plan = met._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [key" in plan
        assert not any("node_a" in x or "LeftAnti" in x for x in plan.splitlines() if "BroadcastHashJoin" in x)


def test_components_equal_union_find(spark):
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(r.randrange(100, 200), r.randrange(100, 200)) for _ in range(60)]
    values = {n: (n * 7919) % 1009 for e in edges for n in e}
    got = components.smallest_reachable(
        spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame(list(values.items()), "node long, value long")
    )
    want = plain_components(edges, values)
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert {x.node: x.value for x in got.collect()} == {n: v for n, v in want.items() if n in linked}


def near_texts():
    r = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    out = []
    for d in range(40):
        text = [r.choice(words) for _ in range(120)]
        out.append((d, " ".join(text)))
        if d % 3 == 0:
            out.append((d + 100, " ".join(text)))
            text[r.randrange(120)] = "other"
            out.append((d + 200, " ".join(text)))
    return out + [(300, None), (301, ""), (302, " \n"), (303, "one"), (303, "one"), (None, "one"), (304, "x " * 30000)]


def test_further_links_move_known_components_only(spark, monkeypatch):
    r = random.Random(6)
    edges = [(r.randint(1, 400), r.randint(1, 400)) for _ in range(330)]
    want, label = plain_components(edges, {i: i for e in edges for i in e}), None
    worked = []
    plain = components.components
    monkeypatch.setattr(components, "components", lambda e: worked.append(e.where("a != b").distinct().count()) or plain(e))
    for part in (edges[:250], edges[250:300], edges[300:], [], edges[:100]):
        label = components.with_links(label, spark.createDataFrame(part, "a long, b long"))
    got = label.collect()
    assert {x.node: x.root for x in got} == want and len(got) == len(want)
    assert worked[1] <= 50 and worked[2] <= 30 and worked[3:] == [0, 0]  # known links are not gone through again


def test_groups_start_no_components_anew(spark, monkeypatch):
    """Each turn works on the links that it has found, not on all links so far."""
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words[:39] + [f"x{k}"]) for k in range(30)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(resemblance.text_key(F.col("text")).alias("node"), "text")
    edges = []
    plain = components.components
    monkeypatch.setattr(components, "components", lambda e: edges.append(e.where("a != b").distinct().count()) or plain(e))
    assert resemblance.groups(df).select("root").distinct().count() == 1
    assert edges[0] >= 29 and sum(edges[1:]) == 0


def test_sketches_never_tell_more_apart_than_there_is():
    r = random.Random(12)
    for n, m, shared in ((1, 1, 0), (1, 1, 1), (40, 50, 39), (70, 60, 60), (130, 128, 110), (900, 1100, 870), (2100, 2040, 0)):
        both = [r.getrandbits(64) - (1 << 63) for _ in range(shared)]
        a, b = (np.array(both + [r.getrandbits(64) - (1 << 63) for _ in range(k - shared)], dtype=np.int64) for k in (n, m))
        found = resemblance.apart(resemblance.sketch(a), resemblance.sketch(b))
        assert found == resemblance.apart(resemblance.sketch(b), resemblance.sketch(a)) <= len(set(a.tolist()) ^ set(b.tolist()))
        assert found > 0 or n == m == shared


def test_texts_of_one_passage_meet_once_and_whole_sets_are_not_read(spark, monkeypatch):
    r = random.Random(13)
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(passage + [f"t{k}-{r.random()}" for _ in range(60)]) for k in range(6)]
    df = spark.createDataFrame([(t,) for t in texts], "text string").select(resemblance.text_key(F.col("text")).alias("node"), "text").repartition(2)
    rows, plain = {}, resemblance.stored

    def stored(df, name):
        out = plain(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(resemblance, "stored", stored)
    assert resemblance.groups(df).count() == 0
    assert rows["tested-pairs"] >= 5 and rows["shingle-sets"] == 0
    assert rows["shared-shingles"] < 40  # a passage is a key for each set of texts that have it in their prefixes


def test_near_duplicates_equal_brute_force(spark):
    docs = near_texts()
    df = spark.createDataFrame(docs, DOCS).withColumn("fp", F.lit("clash")).withColumn("component_id", F.lit(1))
    got = sorted(map(tuple, simhash.near_duplicates(df).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t in docs]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if bin(prints[i] ^ prints[j]).count("1") <= 3]
    big = 10**9
    least = plain_components(pairs, {i: big if d is None else d for i, (d, _) in enumerate(docs)})
    want = [(d, p - (1 << 64) if p >> 63 else p, least[i]) for i, ((d, _), p) in enumerate(zip(docs, prints, strict=True))]
    assert got == sorted(want, key=str)


def test_one_of_each_group_stays(spark):
    df = spark.createDataFrame(near_texts(), DOCS).withColumn("_row", F.lit(1))
    got = simhash.one_of_each_group(df)
    assert got.columns == df.columns
    ids = [x.doc_id for x in got.collect()]
    assert {d for d in range(40)} <= set(ids) and not {d + 100 for d in range(0, 40, 3)} & set(ids)
    assert ids.count(300) == 1 and ids.count(303) == 1 and not {301, 302} & set(ids)
    assert None not in ids  # the row without an id has the text of another one


def five_words(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))}


def similar_texts():
    """Copies with more and more words changed, around a similarity of 0.8, some with a common passage before them."""
    r = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    passage, out = [r.choice(words) for _ in range(12)], []
    for d in range(60):
        text = (passage if d % 2 else []) + [r.choice(words) for _ in range(r.choice((6, 30, 120, 400)))]
        out.append((d, " ".join(text)))
        for k in range(1, 4):
            for _ in range(max(1, len(text) // 90)):
                text[r.randrange(len(text))] = r.choice(words)
            out.append((100 * k + d, " ".join(text)))
    hot = [r.choice(words) for _ in range(150)]
    for k in range(40):
        copy = list(hot)
        copy[r.randrange(150)] = f"x{k}"
        out.append((1000 + k, " ".join(copy)))
    return out + [(2000, "a b"), (2001, "A  b"), (2002, "a c"), (2003, None), (2004, " \n")]


@pytest.mark.parametrize("common", [2, 10**6])
def test_near_copies_equal_brute_force(spark, monkeypatch, common):
    monkeypatch.setattr(resemblance, "COMMON", common)  # read in tasks forked from this process
    docs = similar_texts()
    sets = {d: five_words(t) for d, t in docs}
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-12]
    least = plain_components(pairs, {d: d for d in sets})
    got = simhash.one_of_each_group(spark.createDataFrame(docs, DOCS).repartition(3))
    assert sorted(x.doc_id for x in got.collect()) == sorted(set(least.values()))
    far = [(a, b) for a, b in pairs if bin(plain_fingerprint(dict(docs)[a]) ^ plain_fingerprint(dict(docs)[b])).count("1") > 3]
    assert len(far) > 20 and len(set(least.values())) > 60


def test_near_copies_are_linked_by_fingerprints_first(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    docs = [(d, " ".join([*words[:380], f"x{d}"])) for d in range(3)] + [(3, "quite another text of some words"), (4, None)]
    calls = []

    def groups(texts, similarity=resemblance.SIMILARITY, first=None, plain=resemblance.groups):
        calls.append({frozenset(r) for r in first.collect()})
        return plain(texts, similarity, first)

    monkeypatch.setattr(resemblance, "groups", groups)
    got = simhash.one_of_each_group(spark.createDataFrame(docs, DOCS))
    prints = [simhash.fingerprint(t, resemblance.SHINGLE) for _, t in docs[:3]]
    assert max((a ^ b).bit_count() for a in prints for b in prints) <= simhash.DISTANCE
    assert len(calls) == 1 and len(calls[0]) == 2
    assert sorted(r.doc_id for r in got.collect()) == [0, 3, 4]


def test_links_of_fingerprints_hold_where_sets_share_less(spark):
    """Operator 3's components are left out nowhere: two texts whose fingerprints are close, and a third linked by its shingles."""
    line = " ".join(f"w{i}" for i in range(12))
    a, b = (" ".join([line] * 60 + [f"{c}{i}" for i in range(6)]) for c in "ab")
    docs = [(1, a), (2, b), (3, b + " more"), (4, "a text of its own without any of these words")]
    sets = [five_words(t) for _, t in docs]
    assert len(sets[0] & sets[1]) < 0.6 * len(sets[0] | sets[1]) and len(sets[1] & sets[2]) > 0.8 * len(sets[1] | sets[2])
    prints = [simhash.fingerprint(t, resemblance.SHINGLE) for _, t in docs]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.DISTANCE < (prints[0] ^ prints[3]).bit_count()
    got = simhash.one_of_each_group(spark.createDataFrame(docs, DOCS))
    assert sorted(r.doc_id for r in got.collect()) == [1, 4]


def test_rows_that_share_an_id_are_rows_of_their_own(spark):
    r = random.Random(7)
    a, b, c = (" ".join(r.choices([f"w{i}" for i in range(300)], k=40)) for _ in range(3))
    docs = [(1, a), (1, b), (2, b + " more"), (3, c), (3, c), (4, c + " more"), (5, a)]
    got = simhash.one_of_each_group(spark.createDataFrame(docs, DOCS))
    assert sorted(map(tuple, got.collect())) == sorted([(1, a), (1, b), (3, c)])


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each_group(none).count() == 0
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contained_items(none, items).count() == 0
    some = spark.createDataFrame([(1, "a b c d e f")], DOCS)
    assert decontaminate.without_leaks(some, items).count() == 1
    assert lines.without_repeats(none).count() == 0


def words_of(text):
    import regex

    return [w for w in regex.split(r"[^\p{L}\p{M}\p{N}]+", (text or "").lower()) if w]


def grams(text, m=5):
    w = words_of(text)
    return {tuple(w[i : i + m]) for i in range(len(w) - m + 1)}


def plain_contained(docs, items):
    """Largest share per (doc_id, item_id) over all rows and all texts of an item."""
    want = {}
    for i, t in {(i, t) for i, t in items if i is not None and words_of(t)}:
        m = min(5, len(words_of(t)))
        g = grams(t, m)
        for d, text in docs:
            share = len(g & grams(text, m)) / len(g)
            if share >= 0.8 - 1e-12:
                want[d, i] = max(round(share, 9), want.get((d, i), 0))
    return want


def test_contained_items_equal_brute_force(spark):
    r = random.Random(4)
    vocabulary = [f"v{i}" for i in range(80)]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice((1, 3, 4, 5, 6, 9, 20, 45, 90))))) for i in range(60)]
    docs = []
    for d in range(120):
        text = [r.choice(vocabulary) for _ in range(r.randint(0, 300))]
        for _ in range(r.randint(0, 3)):
            part = r.choice(items)[1].split()
            for _ in range(r.randint(0, 3)):
                part[r.randrange(len(part))] = r.choice(vocabulary)
            at = r.randint(0, len(text))
            text[at:at] = [w.upper() + "," if r.random() < 0.3 else w for w in part]
        docs.append((d, " ".join(text)))
    docs += [(500, None), (501, ""), (502, "?!"), (None, items[0][1]), (503, items[1][1]), (504, items[2][1] + " " + "z " * 20000)]
    items += [(100, None), (101, ""), (None, "v1 v2"), (items[5][0], items[5][1])]
    df = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit(7)).withColumn("contained", F.lit(0.0))
    got = decontaminate.contained_items(df, spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(3)))
    want = plain_contained(docs, items)
    assert {(x.doc_id, x.item_id): round(x.contained, 9) for x in got.collect()} == want
    assert len(want) > 20 and any(len(words_of(dict(items)[i])) < 5 for _, i in want) and any(d is None for d, _ in want)


def test_short_items_shared_ids_and_rows_without_id(spark):
    items = [(7, "the capital of france"), (7, "what is the largest planet of the solar system"), (8, "Oslo"), (9, "two words"), (9, "other two"), (None, "no item id here at all")]
    docs = [
        (1, "Tell me: THE capital, of France! please"), (2, "x what is the largest planet of the solar system y"), (3, "in oslo city"), (3, "a clean row of the same id"),
        (None, "about two words"), (None, "clean text"), (4, "capital of france"), (5, "other two words"), (6, "no item id here at all"), (6, "no item id here at all"),
    ]
    df, them = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    got = {(x.doc_id, x.item_id): round(x.contained, 9) for x in decontaminate.contained_items(df, them).collect()}
    assert got == plain_contained(docs, items) and set(got) == {(1, 7), (2, 7), (3, 8), (None, 9), (5, 9)}
    kept = sorted(map(tuple, decontaminate.without_leaks(df, them).collect()), key=str)
    assert kept == sorted([(3, "a clean row of the same id"), (None, "clean text"), (4, "capital of france"), *docs[-2:]], key=str)


def test_leaks_go_and_others_stay(spark):
    item = "some words that make up a test item of ten words here"
    docs = [(1, "before " * 50 + item.upper() + " after"), (2, "clean text " * 20), (None, item), (3, None)]
    df = spark.createDataFrame(docs, DOCS).withColumn("source", F.lit("s"))
    got = decontaminate.without_leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert got.columns == df.columns and sorted(map(str, (x.doc_id for x in got.collect()))) == ["2", "3"]


def test_each_text_of_an_item_id_is_searched(spark):
    first, second = "a text of one test item with some words", "then another text under the same item id here"
    docs = [(1, "x " + first), (2, "y " + second), (3, "clean text of other words only")]
    items = spark.createDataFrame([(7, first), (7, second), (None, docs[2][1])], "item_id long, text string")
    assert [x.doc_id for x in decontaminate.without_leaks(spark.createDataFrame(docs, DOCS), items).collect()] == [3]


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] or a[i + 1 :] == b[i:] or a[i:] == b[i + 1 :]


def test_lines_equal_brute_force(spark):
    r = random.Random(5)
    base = ["".join(r.choice("abcde é") for _ in range(r.randint(8, 30))) for _ in range(40)]

    def changed(s):
        i, kind = r.randrange(len(s) + 1), r.randrange(3)
        return s[:i] + ("" if kind == 1 else r.choice("abcé")) + s[i + (kind > 0) :]

    docs = []
    for d in range(120):
        ls = []
        for _ in range(r.randint(0, 8)):
            x = r.choice(base)
            for _ in range(r.randrange(4)):
                x = changed(x)
            ls.append(r.choice(["", " ", "\t"]) + x + r.choice(["", " "]))
        docs.append((d, "\n".join(ls)))
    long = "long line " * 6000
    docs += [(500, None), (501, ""), (502, "\n\n"), (503, long), (504, long[:-1] + "x"), (505, long + "\n\n" + long)]
    space = " \t\n\r\x0b\x0c"
    first = {}
    for d, t in docs:
        for n, line in enumerate((t or "").split("\n")):
            if line.strip(space):
                first.setdefault(line.strip(space), (d, n))
    gone = {
        c for c in first
        if len(c) >= 12 and any(len(o) >= 12 and first[o] < first[c] and near(c, o) for o in first)
    }

    def kept(d, t):
        out = []
        for n, line in enumerate(t.split("\n")):
            c = line.strip(space)
            if not c or (first[c] == (d, n) and c not in gone):
                out.append(line)
        return "\n".join(out)

    df = spark.createDataFrame([(*x, "a", 1) for x in docs] + [(None, "a line without an id", "a", 1)], DOCS + ", line string, line_no int")
    got = lines.without_repeats(df)
    assert got.columns == df.columns
    found = {x.doc_id: x.text for x in got.collect()}
    assert found.pop(None) == "a line without an id"
    assert found == {d: None if t is None else kept(d, t) for d, t in docs}
    assert len(gone) > 50


def test_lines_of_rows_that_share_an_id_or_have_none(spark):
    """Each row is a document of its own: a line goes if another row, or another line of it, has it first."""
    a, b, c, d = "the first line of all", "a line of its own here", "another line of its own", "yet another one of them"
    docs = [(1, f"{a}\n{b}"), (1, f"{c}\n{a}"), (2, d + "\n" + c + "!"), (None, f"{b}x\nnew words without id"), (None, "new words without id"), (3, None), (3, a)]
    got = sorted(((x.doc_id, x.text) for x in lines.without_repeats(spark.createDataFrame(docs, DOCS).repartition(4)).collect()), key=str)
    rest = [t for i, t in got if i is None]
    assert [x for x in got if x[0] is not None] == [(1, c), (1, f"{a}\n{b}"), (2, d), (3, ""), (3, None)]
    assert sorted(rest) == ["", "new words without id"]


def test_short_lines_are_compared_if_asked(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, "abd\nxyz"), (3, "a"), (4, "")], DOCS)
    assert [x.text for x in lines.without_repeats(docs).orderBy("doc_id").collect()] == ["abc", "abd\nxyz", "a", ""]
    assert [x.text for x in lines.without_repeats(docs, least_chars=0).orderBy("doc_id").collect()] == ["abc", "xyz", "a", ""]
