"""The divergence audit against plain sums over all kept terms, and its trees against what they stand for."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegrid.llm import divergence

DOCS = "doc_id long, text string, lang string, source string"


def words(text):
    out, now = [], ""
    for c in text + " ":
        if ord(c) > 127 or c.isascii() and c.isalpha():
            now += c.lower() if c.isascii() else c
        elif now:
            out.append(now)
            now = ""
    return out


def plain(docs, least=10, top=10):
    counts, within, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in docs:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        own = words(text or "")
        counts[lang, source].update(own)
        within[lang].update(set(own))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in within[lang].items() if n >= least]
        total = {t: sum(counts[lang, s][t] for s in sources) for t in kept}

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        of = {s: share(counts[lang, s]) for s in sources}
        q = share(total)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(of[s][t], of[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(of[s][t], q[t])) for t in kept if counts[lang, s][t] and of[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, v, i + 1) for i, (item, v) in enumerate(found if part == "pair" else found[:top])]
    return sorted(out)


def corpus(seed):
    r = random.Random(seed)
    pool = [*"abcdefghij", "Über", "ÜBER", "naïve", "日本", "Ⅷ", "x1y", "don't", "İ", "A-b", "ß"] + [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(9) for j in range(9)]
    docs = []
    for d in range(500):
        lang = r.choices(["en", "de", "", None, "rare"], [6, 3, 1, 1, 0.1])[0]
        n = r.choice([0, 1, 5, 30, 80])
        text = r.choice([" ", "\t", ", ", "\x00", "_"]).join(r.choices(pool, [1 / (i + 1) for i in range(len(pool))], k=n))
        docs.append((d, text, lang, r.choice(["s0", "s0", "s0", "s1", "s2", "S", "\xe9", None, ""])))
    docs += [(900, None, "en", "only null"), (901, "a " * 700_000, "en", "long"), (902, "unique words here", "rare", "s1"), (903, "more unique", "rare", "s2")]
    return docs + docs[:20]


@pytest.mark.parametrize("block,tile", [(8, 2), (32, 3), (1 << 13, 64)])
def test_equals_plain_sums(spark, monkeypatch, block, tile):
    monkeypatch.setattr(divergence, "_SLICE", 100)  # read where functions run in this process
    docs = corpus(block)
    df = spark.createDataFrame(docs, DOCS).repartition(6).withColumn("n", F.lit("clash")).withColumn("idx", F.lit(1))
    got = [tuple(x) for x in divergence.audit(df, block=block, tile=tile).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert sorted(got) == plain(docs)


def test_no_kept_terms_and_no_rows(spark):
    docs = [(i, "a b", "en", f"s{i % 3}") for i in range(9)] + [(20, None, None, None)]
    got = divergence.audit(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(tuple(r) for r in got) == plain(docs) and {r.value for r in got} == {0}
    assert divergence.audit(spark.createDataFrame([], DOCS)).count() == 0


def test_slices_of_a_text_are_all_of_it(monkeypatch):
    r = random.Random(4)
    text = " ".join("".join(r.choices("abÜ", k=r.randint(1, 9))) for _ in range(500)).encode()
    whole = text.translate(divergence._PLAIN).split()
    for size in (1, 7, 64, 1 << 20):
        monkeypatch.setattr(divergence, "_SLICE", size)
        assert [w for part in divergence._words(text) for w in part] == whole


def test_equal_subtrees_are_one_node():
    counts = np.array([[1, 0, 1, 0, 1, 0, 1, 0], [1, 0, 1, 0, 1, 0, 0, 0], [0] * 8])
    trees = divergence.Trees(counts)
    assert trees.sizes() == [2, 2, 3, 3]  # leaves 0 and 1; (1,0) and (0,0); and so on
    of, x, y, times = trees.leaf_pairs(np.array([0, 0]), np.array([1, 2]))
    seen = {(int(i), int(trees.values[a]), int(trees.values[b])): int(n) for i, a, b, n in zip(of, x, y, times, strict=True)}
    assert seen == {(0, 1, 1): 3, (0, 0, 0): 4, (0, 1, 0): 1, (1, 1, 0): 4, (1, 0, 0): 4}


@pytest.mark.parametrize("n", [1, 2, 3, 31, 64])
def test_walk_prices_each_pair_as_a_plain_sum(n, monkeypatch):
    rng = np.random.default_rng(n)
    counts = rng.geometric(0.6, (7, n)) - 1
    monkeypatch.setattr(divergence, "_WALK", 64)  # several rounds
    trees = divergence.Trees(counts)
    share = np.stack([divergence.shares(np.maximum(trees.values, 0), int(c.sum()), n) for c in counts])
    dense = np.stack([divergence.shares(c, int(c.sum()), n) for c in counts])
    a, b = np.triu_indices(7, 1)
    assert divergence.pair_prices(trees, share, a, b).tolist() == [int(divergence.price(dense[i], dense[j]).sum()) for i, j in zip(a, b, strict=True)]
