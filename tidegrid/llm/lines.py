"""Line de-duplication by a deletion-neighbourhood join.

Two lines within one edit (a character put in, left out or replaced) become
equal when at most one character is deleted from each. So every line gives, as
hashed keys, itself and its variants with one character deleted, and lines that
share a key are candidates; the edit distance is then verified.

Most lines have no near line at all. A first pass spares them their variants:
of two lines within one edit, the shorter one's first or second half stands
unchanged at the start or the end of the other, so only lines that share such a
half with another line go on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import carried, restored, stored

#: Shorter lines are only equal or different by default: one edit changes too much of them. An argument; with 0 every
#: line is compared, and lines of a few characters, which are within one edit of very many others, cost most.
LEAST_CHARS = 12
EDITS = 1
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def content(line: Column) -> Column:
    """What is compared: the line without white space at its ends."""
    return F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))


def row_key() -> Column:
    """128 bits of hash of a row's id and text: rows that share an id are told apart by it."""
    return F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), F.col("text"))))


def line_rows(docs: DataFrame) -> DataFrame:
    """``row, doc_id, line_no, line`` of all lines with content, from 0; ``docs``: doc_id, text."""
    lines = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    rows = docs.select(row_key().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.posexplode(lines).alias("line_no", "line"))
    return rows.select("row", "doc_id", "line_no", content(F.col("line")).alias("line")).where("line != ''")


def _line_key(line: Column) -> Column:
    """128 bits of hash."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _halves(line: Column) -> Column:
    """Keys of the unchanged half that a near line shares, for a shorter line of this length or of one less."""
    n = F.length(line)
    out = []
    for less in (0, 1):
        m = n - less  # characters of the shorter line
        half = F.floor(m / 2).cast("int")
        out.append(F.xxhash64(F.lit("start"), m, F.substring(line, F.lit(1), half)))
        rest = (m - half).cast("int")
        out.append(F.xxhash64(F.lit("end"), m, F.substring(line, n - rest + 1, rest)))
    return F.array_distinct(F.array(*out))


def deletion_keys(text: str) -> np.ndarray:
    """Hashes of the text with each one character left out, by position: from sums of prefixes and suffixes."""
    x = np.array(list(map(ord, text)), dtype=np.uint64) + np.uint64(1)
    n = len(x)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, _BASE)]), dtype=np.uint64)
        before = np.concatenate([[np.uint64(0)], np.cumsum(x * power[:n], dtype=np.uint64)])
        after = (before[n] - before[1:]) * np.uint64(_inverse())  # characters behind move one place down
        return _mixed(before[:n] + after)


def whole_key(text: str) -> int:
    x = np.array(list(map(ord, text)), dtype=np.uint64) + np.uint64(1)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(x), _BASE)]), dtype=np.uint64)
        return int(_mixed(np.array([(x * power[: len(x)]).sum(dtype=np.uint64)], dtype=np.uint64))[0])


def _inverse() -> int:
    """The odd base's inverse modulo 2^64."""
    return pow(int(_BASE), -1, 1 << 64)


def _mixed(h: np.ndarray) -> np.ndarray:
    """The finishing steps of a common 64-bit mixer, so that all bits count."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        return h ^ (h >> np.uint64(29))


VARIANT = "id long, doc_id long, line_no int, key long, at int"


def _variants(lines: DataFrame) -> DataFrame:
    """Per line (id, doc_id, line_no, line) the keys of the line itself (at -1) and of it without its character ``at``."""

    names, kinds = ["id", "doc_id", "line_no", "key", "at"], (pa.int64(), pa.int64(), pa.int32())

    def batch(b, at, keys):
        n = [len(k) for k in keys]
        of = [b.column(i).take(pa.array(np.repeat(at, n))).cast(kinds[i]) for i in range(3)]
        place = np.concatenate([np.arange(-1, m - 1, dtype=np.int32) for m in n])
        return pa.record_batch([*of, pa.array(np.concatenate(keys)), pa.array(place)], names=names)

    def work(parts):
        for b in parts:
            at, keys, held = [], [], 0
            for i, line in enumerate(b.column(3).to_pylist()):
                at.append(i)
                keys.append(np.concatenate([[np.uint64(whole_key(line))], deletion_keys(line)]).view(np.int64))
                held += len(keys[-1])
                if held > 1 << 18:
                    yield batch(b, at, keys)
                    at, keys, held = [], [], 0
            if keys:
                yield batch(b, at, keys)

    return lines.select("id", "doc_id", "line_no", "line").mapInArrow(work, VARIANT)


def _order(*last: str) -> Column:
    """Places in order: by ``doc_id``, those without one last, then line number."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no", *last)


def later_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``row, line_no`` of every line that an earlier equal line, or an earlier line within one edit, repeats.

    ``row`` is the ``row_key``. Order is by ``doc_id``, then line number; rows
    without an id come last, and what is level then goes by hashes. Whether a
    line goes depends on the first places of the different lines only: a line
    goes everywhere if a line within one edit of it first stands earlier; else
    it stays at its first place. (The earlier line may itself go, if a third one
    precedes it.) Rows that are alike in id and text are one row.
    """
    rows = line_rows(docs.select("doc_id", "text"))
    keyed = rows.select(
        "row", "doc_id", "line_no", _line_key(F.col("line")).alias("line_key"),
        F.when(F.length("line") >= least_chars, _halves(F.col("line"))).alias("halves"),
    )
    # The hash of a line stands for it.
    keyed = stored(keyed.withColumn("id", F.xxhash64("line_key.a", "line_key.b")), "lines")
    place = _order("id", "row")
    firsts = stored(
        keyed.groupBy("line_key", "id").agg(F.min(place).alias("first"), F.any_value("halves").alias("halves"), F.count(F.lit(1)).alias("n")),
        "first-lines",
    )
    # The small sides below are joined by hash at every size, so that shuffles grow with the input and not by steps.
    # A half that very many lines begin with is counted before the shuffle, and joined, not dealt out: adaptive
    # execution can split it there.
    halves = firsts.select("id", F.explode("halves").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("half")
    near = halves.join(shared, "half", "left_semi").select("id").distinct()
    near = stored(firsts.join(near.hint("shuffle_hash"), "id", "left_semi").select("id", "first.row", "first.doc_id", "first.line_no"), "near-places")
    # Only documents in which such a line first stands are cut into lines again.
    theirs = docs.select("doc_id", "text", row_key().alias("row")).join(near.select("row").distinct().hint("shuffle_hash"), "row", "left_semi")
    lines = line_rows(theirs).select("row", "line_no", "line").join(near.hint("shuffle_hash"), ["row", "line_no"])
    lines = stored(lines.groupBy("id", "doc_id", "line_no").agg(F.any_value("line").alias("line")), "near-lines")
    # Of the variants, too, only those go on that another line shares; runs of a letter repeat a key within a line.
    dealt = _variants(lines).repartition("key")
    several = dealt.groupBy("key").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a != b").select("key")
    known = stored(dealt.join(several.hint("shuffle_hash"), "key", "left_semi"), "shared-variants")
    # An order over lines: by the place where each first stands.
    known = known.select("id", "key", "at", _order("id").alias("o"))
    deleted = known.where("at >= 0")
    # Lines that lack the same character place and are else equal: all of them are within one replacement.
    replaced = deleted.groupBy("key", "at").agg(F.min("o").alias("o"), F.count(F.lit(1)).alias("c")).where("c > 1")
    by_change = deleted.select("id", "key", "at").join(replaced.select("key", "at", F.col("o.id").alias("other")), ["key", "at"])
    # A line that is another one less a character.
    whole = known.where("at < 0").select("key", F.col("id").alias("w"), F.col("o").alias("wo"))
    longer = deleted.join(whole, "key").where("id != w")
    shorter_first = longer.groupBy("id").agg(F.min("wo").alias("o"))
    longer_first = longer.groupBy(F.col("w").alias("id")).agg(F.min("o").alias("o"))
    pairs = (
        by_change.where("id != other").select("id", "other")
        .unionByName(shorter_first.select("id", F.col("o.id").alias("other")))
        .unionByName(longer_first.select("id", F.col("o.id").alias("other"))).distinct()
    )
    a = lines.select("id", _order("id").alias("first"), "line")
    b = lines.select(F.col("id").alias("other"), _order("id").alias("other_first"), F.col("line").alias("other_line"))
    both = pairs.join(a, "id").join(b, "other").where("other_first < first")
    distance = F.levenshtein(F.col("line"), F.col("other_line"), EDITS)
    gone = stored(both.where((distance >= 0) & (distance <= EDITS)).select("id").distinct(), "near-repeats")

    marked = firsts.join(gone.withColumn("gone", F.lit(True)), "id", "left")
    marked = marked.where("n > 1 OR gone").select("line_key", "first", "gone")
    again = keyed.select("line_key", "id", "row", "doc_id", "line_no").join(marked.hint("shuffle_hash"), "line_key")
    late = F.coalesce("gone", F.lit(False)) | ~place.eqNullSafe(F.col("first"))
    return again.where(late).select("row", "line_no")


def without_repeats(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """``docs`` without their repeated lines (see ``later_lines``), in the same columns and rows.

    Blank lines stay. A text loses nothing but whole lines; NULL stays NULL.
    Rows that share a ``doc_id``, and rows without one, are documents of their own.
    """
    late = later_lines(docs, least_chars).groupBy("row").agg(F.collect_set("line_no").alias("_late"))
    others = [c for c in docs.columns if c != "text"]
    split = docs.select(row_key().alias("row"), F.split("text", "\n", -1).alias("_lines"), *carried(others))
    rows = split.join(late.hint("shuffle_hash"), "row", "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.coalesce("_late", F.array().cast("array<int>")))
    text = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    back = dict(zip(others, restored(others), strict=True)) | {"text": F.when(F.col("_lines").isNotNull(), text).alias("text")}
    return rows.select(*(back[c] for c in docs.columns))
