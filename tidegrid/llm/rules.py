"""Quality classifier: a sparse rule ensemble over text statistics.

Small boosted trees are grown on a bounded labelled sample. Every path from a
root to a node is a conjunctive rule; a lasso logistic regression keeps few of
them. The kept rules become one Spark column, so scoring is a projection.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import WORD, carried, hashed_sample, held_out, restored

FOLDS, FOLD, CUT = 5, 0, 0.3


def statistics(text: Column) -> dict[str, Column]:
    """What the rules look at, computed over the whole text; NULL counts as empty."""
    text = F.coalesce(text, F.lit(""))

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    lines = F.split(text, "\n", -1)
    return {
        "chars": F.length(text).cast("double"),
        "words": F.size(words).cast("double"),
        "distinct_words": F.size(F.array_distinct(words)).cast("double"),
        "lines": F.size(lines).cast("double"),
        "distinct_lines": F.size(F.array_distinct(lines)).cast("double"),
        "upper": count(r"\p{Lu}"),
        "digits": count("[0-9]"),
        "stops": count(r"[.?]"),
        "shouts": count("!"),
        "commas": count("[,;:]"),
        "bars": count(r"\|"),
        "marks": count(r"[$%&*#@^~<>{}=+_/\\-]"),
        "dots": count(r"\.\.\."),
    }


def features(stats: dict[str, Column]) -> dict[str, Column]:
    """The counts as shares, so that a rule holds for short and long texts alike."""
    chars, words, lines = (F.greatest(stats[n], F.lit(1.0)) for n in ("chars", "words", "lines"))
    shares = {f"{n}_share": stats[n] / chars for n in ("upper", "digits")}
    shares |= {f"{n}_per_word": stats[n] / words for n in ("stops", "shouts", "commas", "bars", "marks")}
    return shares | {
        "dots_per_line": stats["dots"] / lines,
        "word_length": stats["chars"] / words,
        "line_length": stats["chars"] / lines,
        "new_words": stats["distinct_words"] / words,
        "new_lines": stats["distinct_lines"] / lines,
        "words": stats["words"],
    }


def with_features(df: DataFrame, text: str = "text", prefix: str = "_f_") -> tuple[DataFrame, list[str]]:
    """``df`` and the features of its text as further columns with this prefix."""
    df = df.withColumns({f"_s_{n}": c for n, c in statistics(F.col(f"`{text}`")).items()})
    stats = {n[3:]: F.col(n) for n in df.columns if n.startswith("_s_")}
    found = features(stats)
    df = df.withColumns({prefix + n: c for n, c in found.items()}).drop(*(f"_s_{n}" for n in stats))
    return df, list(found)


@dataclass(frozen=True)
class Rule:
    """All conditions (feature, above, threshold) hold: feature > threshold, or <= if not above."""

    conditions: tuple[tuple[int, bool, float], ...]

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), dtype=bool)
        for f, above, t in self.conditions:
            out &= (x[:, f] > t) == above
        return out


@dataclass(frozen=True)
class RuleModel:
    names: tuple[str, ...]
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            z += w * rule.holds(x)
        return 1 / (1 + np.exp(-z))

    def column(self, prefix: str = "_f_") -> Column:
        """The score as an expression over the feature columns."""
        z = F.lit(self.bias)
        for rule, w in zip(self.rules, self.weights, strict=True):
            tests = [
                F.col(prefix + self.names[f]) > t if above else F.col(prefix + self.names[f]) <= t
                for f, above, t in rule.conditions
            ]
            z = z + F.when(reduce(Column.__and__, tests), F.lit(w)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def _tree_rules(x: np.ndarray, grad: np.ndarray, cuts: list[np.ndarray], depth: int, leaf: int) -> tuple[list[Rule], np.ndarray]:
    """The paths of one tree fitted to ``grad`` by least squares, and its prediction."""
    rules, fit = [], np.zeros(len(x))

    def grow(rows: np.ndarray, path: tuple) -> None:
        if path:
            rules.append(Rule(path))
        mean = grad[rows].mean()
        best, split = 1e-12, None
        if len(path) < depth and len(rows) >= 2 * leaf:
            total = grad[rows].sum()
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                # Rows at most each cut: a histogram of the cuts, summed up.
                slot = np.searchsorted(c, x[rows, f], side="left")
                n = np.bincount(slot, minlength=len(c) + 1).cumsum()[:-1]
                s = np.bincount(slot, weights=grad[rows], minlength=len(c) + 1).cumsum()[:-1]
                m = len(rows) - n
                ok = (n >= leaf) & (m >= leaf)
                if not ok.any():
                    continue
                gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1), -np.inf)
                gain -= total**2 / len(rows)
                k = int(gain.argmax())
                if gain[k] > best:
                    best, split = gain[k], (f, float(c[k]))
        if split is None:
            fit[rows] = mean
            return
        f, t = split
        above = x[rows, f] > t
        grow(rows[~above], (*path, (f, False, t)))
        grow(rows[above], (*path, (f, True, t)))

    grow(np.arange(len(x)), ())
    return rules, fit


def _lasso(r: np.ndarray, y: np.ndarray, penalty: float, rounds: int) -> tuple[np.ndarray, float]:
    """Logistic regression with an L1 penalty by accelerated proximal steps; the bias is free."""
    n, k = r.shape
    a = np.hstack([r, np.ones((n, 1))])
    step = 1 / (0.25 * max(np.linalg.eigvalsh(a.T @ a / n)[-1], 1e-9))
    w = v = np.zeros(k + 1)
    t = 1.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ v, -30, 30)))
        new = v - step * (a.T @ (p - y) / n)
        new[:k] = np.sign(new[:k]) * np.maximum(np.abs(new[:k]) - step * penalty, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return w[:k], float(w[k])


def fit(x: np.ndarray, y: np.ndarray, names: list[str], trees: int = 30, depth: int = 3, penalty: float = 1e-3, seed: int = 7) -> RuleModel:
    """Rules from boosted trees on random halves, then their lasso weights. Without rows of both
    labels there is nothing to part: a constant score."""
    if len(y) == 0 or y.min() == y.max():
        share = 0.5 if len(y) == 0 else float(y[0])
        share = min(max(share, 0.01), 0.99)
        return RuleModel(tuple(names), (), (), float(np.log(share / (1 - share))))
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, 66)[1:-1])) for f in range(x.shape[1])]
    share = y.mean()
    z = np.full(len(y), np.log(share / (1 - share)))
    leaf = max(3, len(y) // 500)
    rules: dict[Rule, None] = {}
    for _ in range(trees):
        rows = rng.random(len(y)) < 0.5
        if rows.sum() < 2:
            continue
        p = 1 / (1 + np.exp(-z))
        found, _ = _tree_rules(x[rows], (y - p)[rows], cuts, depth, leaf)
        rules |= dict.fromkeys(found)
        _, whole = _tree_rules(x, y - p, cuts, depth, leaf)
        z = z + whole
    kept = list(rules)
    r = np.column_stack([q.holds(x) for q in kept]).astype(float) if kept else np.zeros((len(y), 0))
    w, bias = _lasso(r, y.astype(float), penalty, 600)
    chosen = [k for k in range(len(kept)) if abs(w[k]) > 1e-6]
    return RuleModel(tuple(names), tuple(kept[k] for k in chosen), tuple(float(w[k]) for k in chosen), bias)


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000) -> RuleModel:
    """A model from at most ``sample`` labelled rows outside the held-out fold.

    The rows with the smallest hashes of their ids are taken, so the sample is
    the same in each run. Labels that are NULL or neither 0 nor 1 are not used;
    repeated labels and repeated documents count once. At most ``sample`` rows of
    features reach the driver; the list of chosen labels is broadcast, its size
    being bounded by ``sample``.
    """
    usable = labels.select(F.col("doc_id"), F.col(f"`{label}`").cast("int").alias("_y")).where(
        F.col("doc_id").isNotNull() & F.col("_y").isin(0, 1) & ~held_out(F.col("doc_id"), FOLDS, FOLD)
    )
    chosen = hashed_sample(usable.distinct(), "doc_id", sample, "_y")
    rows, names = with_features(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    features = [f"_f_{n}" for n in names]
    # Rows that repeat an id may be many: they are reduced where they lie, and counted against the bound.
    once = rows.select("doc_id", "_y", *features).distinct()
    got = once.orderBy(F.xxhash64("doc_id"), "doc_id", "_y", *features).limit(sample).toPandas()
    got = got.sort_values(["doc_id", "_y", *features])
    return fit(got[features].to_numpy(float), got["_y"].to_numpy(int), names)


def classify(docs: DataFrame, model: RuleModel, score: str = "score") -> DataFrame:
    """``docs`` with the score of each text, in 0 to 1. NULL texts score as empty ones."""
    df, names = with_features(docs)
    return df.withColumn(score, model.column()).drop(*(f"_f_{n}" for n in names))


def kept_by_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs`` that score at least ``cut``, in its columns."""
    model = train(docs, labels)
    scored = classify(docs.select("text", *carried(docs.columns)), model, "_score")
    # A generated column: a filter on the score itself would be taken below the features and repeat them for each rule.
    scored = scored.withColumn("_kept", F.explode(F.array(F.col("_score") >= cut)))
    return scored.where("_kept").select(*restored(docs.columns))
