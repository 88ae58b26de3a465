"""Language identification with error-correcting output codes.

Each language has a codeword of +1 and -1. For each bit a binary classifier
over hashed byte n-grams says which half the text's language belongs to. The
language whose codeword loses least, bits weighted by how reliable their
classifiers proved, is the prediction; a small gap to the runner-up is flagged.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import hashed_sample, held_out

FOLDS, FOLD = 4, 2
BINS = 4096  # hash bins of the n-grams
UNKNOWN = "und"
_PLAIN_LETTER = re.compile("[A-Za-z]")
_MIX = np.uint32(2654435761)


def codewords(n: int, seed: int = 11) -> np.ndarray:
    """``n`` rows of +1 and -1. Up to seven languages: all ways to part them in two; beyond, random ones, far apart."""
    if n < 2:
        return np.ones((n, 1))
    if n <= 7:
        columns = [(1, *rest) for rest in itertools.product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=float).T
    bits = int(np.ceil(10 * np.log2(n)))
    rng = np.random.default_rng(seed)
    tries = (rng.choice((-1.0, 1.0), size=(n, bits)) for _ in range(200))

    def least_apart(code: np.ndarray) -> float:
        gram = code @ code.T
        return (bits - (gram - 2 * bits * np.eye(n)).max()) / 2

    return max(tries, key=least_apart)


def profile(text: str, bins: int = BINS) -> np.ndarray:
    """Shares of hashed byte bigrams and trigrams of the lower-cased letters, words parted by spaces; length 1."""
    letters = re.sub(r"[\W\d_]+", " ", text.lower())
    raw = np.frombuffer(f" {letters} ".encode("utf-8", "surrogatepass"), dtype=np.uint8).astype(np.uint32)
    out = np.zeros(bins)
    shift = np.uint32(32 - int(np.log2(bins)))
    for at in range(0, len(raw), 1 << 20):  # blocks with an overlap of two bytes: a very long text is not held many times
        part = raw[at : at + (1 << 20) + 2]
        two = (part[:-1] << np.uint32(8)) | part[1:]
        three = (two[:-1] << np.uint32(8)) | part[2:]
        for grams in (two[: 1 << 20], three[: 1 << 20] | np.uint32(1 << 24)):
            out += np.bincount((grams * _MIX) >> shift, minlength=bins)
    out = np.sqrt(out)
    norm = np.sqrt((out * out).sum())
    return out / norm if norm else out


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # languages x bits
    weights: np.ndarray  # bins x bits
    bias: np.ndarray  # bits
    trust: np.ndarray  # bits

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the best language, its share of the belief, and the gap to the second."""
        f = x @ self.weights + self.bias
        # Logistic loss of each bit under each codeword, weighted by the bit's trust.
        loss = np.logaddexp(0, -f[:, None, :] * self.code[None]) @ self.trust
        belief = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        belief /= belief.sum(axis=1, keepdims=True)
        ranked = np.sort(belief, axis=1)
        gap = ranked[:, -1] - ranked[:, -2] if belief.shape[1] > 1 else np.ones(len(x))
        return belief.argmax(axis=1), ranked[:, -1], gap


def has_letter(text: str) -> bool:
    return bool(_PLAIN_LETTER.search(text)) or any(map(str.isalpha, text))


def fit(x: np.ndarray, langs: list[str], rounds: int = 200, penalty: float = 1e-5) -> LanguageModel | None:
    """A model of profiles (one row each) and their languages; None without any."""
    languages = sorted(set(langs))
    if not languages:
        return None
    code = codewords(len(languages))
    y = code[[languages.index(v) for v in langs]]
    check = np.arange(len(x)) % 5 == 4 if len(x) >= 50 else np.zeros(len(x), dtype=bool)
    w, bias = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    a, t = x[~check], y[~check]
    v, vb, k = w, bias, 1.0
    for _ in range(rounds):  # accelerated gradient steps; rows have length 1, so the curvature is at most 1/2
        g = -t / (1 + np.exp(np.clip(t * (a @ v + vb), -30, 30))) / len(a)
        new, new_b = v - 2.0 * (a.T @ g + penalty * v), vb - 2.0 * g.sum(axis=0)
        k2 = (1 + np.sqrt(1 + 4 * k * k)) / 2
        v, vb = new + (k - 1) / k2 * (new - w), new_b + (k - 1) / k2 * (new_b - bias)
        w, bias, k = new, new_b, k2
    seen, right = (x[check], y[check]) if check.any() else (a, t)
    error = ((seen @ w + bias) * right <= 0).mean(axis=0)
    error = np.clip((error * len(seen) + 1) / (len(seen) + 2), 1e-3, 0.499)
    return LanguageModel(tuple(languages), code, w, bias, 0.5 * np.log((1 - error) / error))


def train(docs: DataFrame, sample: int = 1_000) -> LanguageModel | None:
    """A model from at most ``sample`` documents of each language, outside the held-out fold and with a letter.

    Those with the smallest hashes of their ids are taken, so a language that is
    rare in a large corpus is learnt like the others. Rows that are alike in id,
    language and text count once. Profiles are taken of whole texts inside the
    tasks; the driver gets ``sample`` times as many of them as there are
    languages, of a fixed length each, and no text.
    """
    usable = docs.where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"), FOLDS, FOLD)
        & F.col("text").rlike(r"\p{L}")
    )
    usable = usable.select("doc_id", "lang", F.xxhash64("text").alias("_text"), "text")
    # Places first: their texts are fetched once they are chosen. The list that is broadcast is as short as the sample.
    chosen = hashed_sample(usable.drop("text").distinct(), "doc_id", sample, "_text", by="lang")
    keys = ["doc_id", "lang", "_text"]

    def work(parts):
        for b in parts:
            rows = [profile(t.as_py()).astype(np.float32) for t in b.column(3)]
            at = [np.flatnonzero(r) for r in rows]
            yield pa.record_batch(
                [*b.columns[:3], pa.array([i.astype(np.int32) for i in at], pa.list_(pa.int32())),
                 pa.array([r[i] for r, i in zip(rows, at, strict=True)], pa.list_(pa.float32()))],
                names=["doc_id", "lang", "_text", "at", "share"],
            )

    once = usable.join(F.broadcast(chosen), keys).groupBy(*keys).agg(F.any_value("text").alias("text"))
    found = once.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "_text", "text").mapInArrow(work, "doc_id long, lang string, _text long, at array<int>, share array<float>").toArrow()
    places = list(zip(*(found[c].to_pylist() for c in keys), strict=True))
    order = sorted(range(len(places)), key=places.__getitem__)
    x = np.zeros((found.num_rows, BINS))
    for row, i in enumerate(order):
        x[row, found["at"][i].values.to_numpy()] = found["share"][i].values.to_numpy()
    return fit(x, [places[i][1] for i in order])


PREDICTION = "doc_id long, lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: LanguageModel | None, sure: float = 0.2) -> DataFrame:
    """``doc_id, lang_pred, score, ambiguous`` for each row of ``docs`` (doc_id, text).

    ``und`` with score 0 where the text is NULL or has no letter, or where no
    model could be learnt. ``ambiguous``: the two best languages are less than
    ``sure`` apart. Only the text is looked at.
    """

    def work(parts):
        for b in parts:
            texts = [t.as_py() or "" for t in b.column(1)]
            names, scores, doubt = [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
            at = [i for i, t in enumerate(texts) if model and has_letter(t)]
            for block in range(0, len(at), 512):
                rows = at[block : block + 512]
                best, score, gap = model.decode(np.vstack([profile(texts[i]) for i in rows]))
                for i, k, s, g in zip(rows, best, score, gap, strict=True):
                    names[i], scores[i], doubt[i] = model.languages[k], float(s), bool(g < sure)
            yield pa.record_batch(
                [b.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(doubt, pa.bool_())],
                names=["doc_id", "lang_pred", "score", "ambiguous"],
            )

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(work, PREDICTION)
