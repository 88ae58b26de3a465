"""Secret scan: fixed patterns, and strings that pass a battery of randomness tests.

A candidate is a run of 20 or more key characters that holds letters and
digits. Its encoding is inferred from its characters, which gives an alphabet.
Three tests ask whether it looks drawn from that alphabet at random: chi-squared
uniformity over the alphabet, runs above and below the middle, and serial
correlation. The smallest of the three p-values, in quarter decades, is the
candidate's score.

The score is then judged against ordinary text: windows over the words of the
corpus itself, of the same length class, are scored by the same battery. The
share of these that score at least as high is the candidate's p-value; long
candidates are judged by long windows. Benjamini and Hochberg's procedure over
all candidates then bounds the share of false ones among those reported.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import stored

KINDS = ("assign", "access", "hex", "random")
# What each kind looks like. Only ASCII letters fold case.
ASSIGN = re.compile(
    r"((?ai:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 6, 20, 24
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KEY_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")

SCORES = 50  # steps of the score
FALSE_SHARE = 0.01
CLASSES = (20, 24, 32, 40, 64, 128)  # lower ends of the length classes


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of the fixed patterns, leftmost and non-overlapping per kind; matches that are too short are dropped."""
    found, low = [], text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        found += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
    found += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    # A run of hex digits ends where the next character is none, so short runs can be passed over at once.
    found += [("hex", m.start(), m.end()) for m in _LONG_HEX.finditer(text)]
    return in_order(found)


_LONG_HEX = re.compile(HEX.pattern[:-1] + "{%d,}" % HEX_CHARS)


def in_order(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def alphabet(text: str) -> str:
    """The smallest of the usual encodings whose alphabet has all characters."""
    kinds = (
        ("0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
        + ("0123456789abcdefghijklmnopqrstuvwxyz", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", _LETTERS + "0123456789")
    )
    used = set(text)
    return next((a for a in kinds if used <= set(a)), _LETTERS + "0123456789+/-_")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


_erfc = np.vectorize(math.erfc, otypes=[float])


def _two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2))


def randomness(x: np.ndarray, k: int) -> np.ndarray:
    """Smallest p-value of the three tests per row of ``x``: ``n`` draws each from ``0 .. k-1``."""
    m, n = x.shape
    cells = (np.arange(m)[:, None] * k + x).ravel()
    counts = np.bincount(cells, minlength=m * k).reshape(m, k)
    chi = ((counts - n / k) ** 2).sum(axis=1) * k / n
    # With the exact mean and variance for n draws: short strings leave most cells empty.
    z = (chi - (k - 1)) / math.sqrt(2 * (k - 1) * (n - 1) / n)
    p_chi = _erfc(z / math.sqrt(2)) / 2  # an even spread is no evidence against randomness
    # Runs of values in the upper and lower half of the alphabet.
    high = x >= k / 2
    n1 = high.sum(axis=1)
    n2 = n - n1
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 1 + 2 * n1 * n2 / n
    var = (mean - 1) * (mean - 2) / (n - 1)
    p_runs = np.where((n1 > 0) & (n2 > 0), _two_sided((runs - mean) / np.sqrt(np.maximum(var, 1e-9))), 2.0 ** (1 - n))
    # Correlation of neighbours.
    d = x - x.mean(axis=1, keepdims=True)
    spread = (d * d).sum(axis=1)
    r = np.where(spread > 0, (d[:, 1:] * d[:, :-1]).sum(axis=1) / np.where(spread > 0, spread, 1), 1.0)
    p_serial = _two_sided((r + 1 / n) * math.sqrt(n))
    return np.minimum(np.minimum(p_chi, p_runs), p_serial)


def steps(p: np.ndarray) -> np.ndarray:
    """The p-value on a scale of quarter decades, the largest at 1."""
    return np.clip(SCORES - 1 + np.ceil(4 * np.log10(np.maximum(p, 1e-30))), 0, SCORES - 1).astype(int)


def score(text: str) -> int:
    """Step of a string under its inferred alphabet; padding does not count."""
    text = text.rstrip("=")
    letters = alphabet(text)
    return int(steps(randomness(np.array([[letters.index(c) for c in text]]), len(letters)))[0])


def length_class(n: int) -> int:
    return sum(n >= c for c in CLASSES) - 1


def candidates(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[int, int, int, int]]:
    """``(start, end, class, score)`` of key-like runs that no span of the fixed patterns touches."""
    out = []
    for m in KEY_RUN.finditer(text):
        s, e = m.span()
        run = m[0]
        if not (any(c.isdigit() for c in run) and any(c.isalpha() for c in run)):
            continue
        if any(a < e and s < b for _, a, b in spans):
            continue
        out.append((s, e, length_class(e - s), score(run)))
    return out


_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[[ord(c) for c in _LETTERS]] = True
_MIXED = np.zeros(256, dtype=np.int64)  # place in the alphabet of letters and digits
_MIXED[[ord(c) for c in _LETTERS]] = np.arange(52)
_CYCLE = np.cumsum((0, *CLASSES))


def windows(text: str) -> list[np.ndarray]:
    """The text's ASCII letters cut into consecutive windows of the class lengths in turn: per class an array of rows.

    What the last turn leaves is cut into windows of the shortest length.
    """
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    letters = raw[_IS_LETTER[raw]]
    whole = len(letters) // _CYCLE[-1]
    block, rest = letters[: whole * _CYCLE[-1]].reshape(whole, _CYCLE[-1]), letters[whole * _CYCLE[-1] :]
    fitting = int(np.searchsorted(_CYCLE, len(rest), side="right")) - 1  # windows of the last, broken turn
    out = [block[:, a:b] for a, b in zip(_CYCLE, _CYCLE[1:], strict=False)]
    for k in range(fitting):
        out[k] = np.vstack([out[k], rest[None, _CYCLE[k] : _CYCLE[k + 1]]])
    tail = rest[_CYCLE[fitting] :]
    n = len(tail) // CLASSES[0]
    out[0] = np.vstack([out[0], tail[: n * CLASSES[0]].reshape(n, CLASSES[0])])
    return out


def count_ordinary(rows: list[list[np.ndarray]], null: dict[tuple[int, int], int]) -> None:
    """Adds the windows' scores per class to ``null``. Windows in one case have an alphabet of 36, others one of 62."""
    for k in range(len(CLASSES)):
        x = np.vstack([r[k] for r in rows])
        upper = (x < ord("a")).sum(axis=1)
        for mask, size, shift in (
            (upper == 0, 36, ord("a") - 10), (upper == x.shape[1], 36, ord("A") - 10), ((upper > 0) & (upper < x.shape[1]), 62, None),
        ):
            part = x[mask]
            codes = _MIXED[part] if shift is None else part.astype(np.int64) - shift
            for at in range(0, len(codes), 4096):
                got = np.bincount(steps(randomness(codes[at : at + 4096], size)), minlength=SCORES)
                for s in np.flatnonzero(got):
                    null[k, int(s)] = null.get((k, int(s)), 0) + int(got[s])


def scan(docs: DataFrame, false_share: float = FALSE_SHARE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each row of ``docs`` (doc_id, text).

    ``spans``: all spans as ``kind:start:end``, those of the fixed patterns and,
    with kind ``random``, those of the battery; code points, end exclusive,
    comma-joined by start. NULL and empty texts have none; repeated ids stay
    repeated; other columns are not looked at. The windows of ordinary text are
    counted per class and score before they are shuffled, so what leaves a task
    is bounded.
    """

    def work(parts):
        for b in parts:
            rows, plain, null = [], [], {}
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                text = text or ""
                spans = base_spans(text)
                rows.append((doc, joined(spans), candidates(text, spans)))
                plain.append(windows(text))
            if plain:
                count_ordinary(plain, null)
            cols = list(zip(*rows, strict=True)) if rows else [(), (), ()]
            counted = [[(k, s, n) for (k, s), n in sorted(null.items())] if i == 0 else None for i in range(len(rows))]
            yield pa.record_batch(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], _CANDIDATES), pa.array(counted, _COUNTS)],
                names=["doc_id", "base", "candidates", "ordinary"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    schema = (
        "doc_id long, base string, candidates array<struct<start: int, end: int, class: int, score: int>>,"
        " ordinary array<struct<class: int, score: int, n: long>>"
    )
    scanned = stored(rows.mapInArrow(work, schema), "secrets")
    limit = thresholds(scanned, false_share)
    # At most one row per length class: the table is collected as a literal.
    least = {r["class"]: r["least"] for r in limit.collect()}
    passing = F.lit(False)
    chosen = F.filter(
        "candidates",
        lambda c: _any(passing, [(c["class"] == k) & (c["score"] >= s) for k, s in sorted(least.items())]),
    )
    base = F.filter(F.split("base", ","), lambda s: s != "")
    count = lambda kind: F.size(F.filter(base, lambda s: s.startswith(f"{kind}:"))).cast("bigint")
    added = F.transform(chosen, lambda c: F.concat(F.lit("random:"), c["start"], F.lit(":"), c["end"]))
    ordered = F.array_sort(F.transform(F.concat(base, added), _sortable))
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2("base", 256).alias("base_sha256"),
        F.array_join(F.transform(ordered, lambda s: s["span"]), ",").alias("spans"),
    )


_CANDIDATES = pa.list_(pa.struct([(n, pa.int32()) for n in ("start", "end", "class", "score")]))
_COUNTS = pa.list_(pa.struct([("class", pa.int32()), ("score", pa.int32()), ("n", pa.int64())]))


def _any(first, tests):
    for t in tests:
        first = first | t
    return first


def _sortable(span):
    parts = F.split(span, ":")
    kind = F.array_position(F.array(*(F.lit(k) for k in KINDS)), parts[0])
    return F.struct(parts[1].cast("int").alias("start"), kind.alias("kind"), span.alias("span"))


def thresholds(scanned: DataFrame, false_share: float) -> DataFrame:
    """``class, least``: the smallest score that is reported, per length class with one.

    The p-value of a score is the share of ordinary windows of its class that
    reach it, with one added to both counts. All windows here run over at most
    ``SCORES`` rows per class.
    """
    null = (
        scanned.select(F.explode("ordinary").alias("o")).groupBy("o.class", "o.score").agg(F.sum("o.n").alias("n_null"))
    )
    seen = (
        scanned.select(F.explode("candidates").alias("c")).groupBy("c.class", "c.score").agg(F.count(F.lit(1)).alias("n"))
    )
    both = seen.join(null, ["class", "score"], "full").fillna(0, ["n", "n_null"])
    above = Window.partitionBy("class").orderBy(F.col("score").desc())
    p = (F.sum("n_null").over(above) + 1) / (F.sum("n_null").over(Window.partitionBy("class")) + 1)
    scored = both.withColumn("p", p)
    # Benjamini-Hochberg: the largest p with p <= share * (candidates with such a p or smaller) / all candidates.
    by_p = Window.orderBy("p")
    scored = scored.withColumn("_rank", F.sum("n").over(by_p)).withColumn("_all", F.sum("n").over(Window.partitionBy()))
    good = (F.col("n") > 0) & (F.col("p") <= F.col("_rank") * false_share / F.col("_all"))
    scored = scored.withColumn("_level", F.max(F.when(good, F.col("p"))).over(Window.partitionBy()))
    return scored.where("n > 0 and p <= _level").groupBy("class").agg(F.min("score").alias("least"))
