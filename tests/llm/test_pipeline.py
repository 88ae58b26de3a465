"""Each stage of the pipeline, and all of it, against plain versions on a small corpus with planted cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_models import plain_features
from test_near_duplicates import five_words, plain_components, plain_contained
from test_outputs import plain_targets, plain_tokens

import corpus_pipeline
from tidegrid.llm import rules
from tidegrid.llm.common import stored

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, _size string, item_id int, row double"
ITEM = "which planet of the solar system has the largest number of known moons today"


def corpus():
    r = random.Random(11)
    words = [a + b for a in ("ba", "ko", "ti", "mu", "re") for b in ("lan", "dor", "vis", "pek", "sun", "gra")]

    def prose(n):
        out = []
        while len(out) < n:
            part = [r.choice(words) for _ in range(r.randint(6, 14))]
            out += [part[0].capitalize(), *part[1:-1], part[-1] + r.choice([".", ".", "?", ","])]
        return " ".join(out)

    rows = []
    for d in range(150):
        rows.append((d, prose(r.randint(20, 90)), r.choice("ab"), r.choice(["s0", "s0", "s1", "s2", None])))
    for d in range(150, 200):  # junk
        rows.append((d, " ".join(r.choice(["!!!", "$$$", "BUY", "|", "NOW!!!", "100%", "***"]) for _ in range(40)), "a", "s1"))
    for d in range(200, 230):  # near and exact copies
        text = rows[d - 200][1].split()
        if d % 2:
            text[len(text) // 2] = "changed"
        rows.append((d, " ".join(text), "a", "s2"))
    rows += [(300 + k, f"{prose(20)} {ITEM.upper()}, {prose(20)}", "a", "s0") for k in range(5)]
    long = prose(20_000)
    rows += [(None, prose(40), "a", "s0"), (None, f"{prose(30)} {ITEM}", "a", "s0"), (None, rows[3][1], "a", "s0"), (7, prose(50), "a", "s1"), (7, rows[7][1], "b", "s2")]
    rows += [(400, long, "b", "s1"), (401, None, "a", "s0"), (402, "", None, None), (403, " \n", "a", "s1"), (404, rows[0][1], "a", "s0"), (404, rows[0][1], "a", "s0")]
    rows = [(d, t, lang, s, len(t or ""), f"clash {i % 3}", i % 2, 0.5) for i, (d, t, lang, s) in enumerate(rows)]
    return rows + [rows[5], rows[5]]


def labels():
    return [(d, int(not 150 <= d < 200), 0) for d in range(0, 230)]


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(corpus(), COLUMNS).repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels(), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (None, "no id"), (2, None)], "item_id int, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def plain_quality(spark, rows, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = rules.train(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    import math

    def score(text):
        x = plain_features(text)
        z = model.bias
        for rule, w in zip(model.rules, model.weights, strict=True):
            z += w if all((x[model.names[f]] > t) == above for f, above, t in rule.conditions) else 0.0
        return 1 / (1 + math.exp(-z))

    return [r for r in rows if score(r[1]) >= rules.CUT]


def plain_groups(rows):
    sets = [five_words(r[1]) for r in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-12]
    least = plain_components(pairs, {i: i for i in range(len(rows))})
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(least[i], []).append(rows[i])
    return list(groups.values())


def plain_mix(rows):
    """How often each row is taken: whole, and if at least half of it lies before the bound."""
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + size(r[1])
    out = []
    for source, target in plain_targets(sizes).items():
        mine = sorted((hashlib.md5(f"mix:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), size(r[1]), r) for r in rows if r[3] == source)
        at, goal = 0, round(target)
        for _, n, r in mine:
            for begin in (at, at + sizes[source]):
                words = max(min(n, goal - begin), 0)
                if words and words * 2 >= n:
                    out.append(r)
            at += n
    return out


def test_stages_equal_plain_versions(spark, sf):
    docs, rows = spark.read.parquet(f"{sf}/documents.parquet"), corpus()
    kept = stored(STAGES["quality"](spark, docs, sf), "quality")
    want = plain_quality(spark, rows, sf)
    assert kept.columns == docs.columns and rows_of(kept) == sorted(want, key=str)
    junk = {r[0] for r in rows if r[0] is not None and 150 <= r[0] < 200}
    assert len(junk & {r[0] for r in want}) < 5 and len(want) > 150

    once = stored(STAGES["near_dedup"](spark, kept, sf), "near_dedup")
    groups = plain_groups(want)
    got = rows_of(once)
    assert once.columns == docs.columns and len(got) == len(groups)
    for g in groups:  # one row of each group: one with the smallest id
        least = min(g, key=lambda r: (r[0] is None, r[0] or 0))[0]
        assert sum(got.count(r) for r in set(g)) == 1 and any(r in got for r in g if r[0] == least)

    clean = stored(STAGES["decontaminate"](spark, once, sf), "decontaminate")
    leaks = {d for d, _ in plain_contained([(i, r[1]) for i, r in enumerate(got)], [(1, ITEM)])}
    assert rows_of(clean) == [r for i, r in enumerate(got) if i not in leaks] and len(leaks) >= 5

    mixed = stored(STAGES["mix"](spark, clean, sf), "mix")
    assert mixed.columns == docs.columns and rows_of(mixed) == sorted(plain_mix(rows_of(clean)), key=str)

    found = STAGES["tokens"](spark, mixed, sf)
    texts = [(r.doc_id, r.text) for r in mixed.collect()]
    assert sorted(tuple(r)[2:] for r in found.collect()) == sorted(x[2:] for x in plain_tokens(texts))
    whole = corpus_pipeline.run(spark, sf).collect()
    assert sorted(tuple(r)[2:] for r in whole) == sorted(tuple(r)[2:] for r in found.collect())


def test_stages_remove_what_the_one_before_has_stored(spark, sf, monkeypatch):
    from tidegrid.llm import common

    app = spark.sparkContext.applicationId
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    first = STAGES["near_dedup"](spark, docs, sf)
    mine = list(common._stages[app])
    kept = stored(first, "near_dedup")
    assert mine and first.count() == kept.count()
    # Rows that nobody has stored are still read from there: these folders stay.
    STAGES["decontaminate"](spark, first, sf)
    assert first.count() == kept.count()
    common._stages[app] = mine
    STAGES["decontaminate"](spark, kept, sf)
    fs = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(mine[0]).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert not any(fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)) for p in mine)


def test_an_empty_corpus_stays_empty(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").where(F.lit(False))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name)
        assert docs.count() == 0
    assert STAGES["tokens"](spark, docs, sf).count() == 0
