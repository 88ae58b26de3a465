"""Token ids in one wavelet-matrix file per shard.

A shard holds the ids of consecutive documents as bit planes, from the highest
bit down; after each plane the values with bit 0 move before those with bit 1,
in order. With the ones counted before each block of a plane, a token is read,
occurrences are counted and the j-th one is found in one step per plane.

File: magic, length of the header, header (JSON: tokens, width, zeros per
plane, first position per document, places of the sections), then the sections,
each compressed on its own: document ids, document lengths, and per plane its
bits and its block counts.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidegrid.llm.common import stored
from tidegrid.llm.files import NewFile
from tidegrid.session import own_root, work_dir

END_ID = 2
MAGIC = b"WMTOKEN2"
BLOCK = 512  # bits between two counts of ones
SHARD_TOKENS = 1 << 21


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of a public vocabulary, the same on the driver and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _ones_before(bits: np.ndarray) -> np.ndarray:
    """Ones before each block of a plane, and in all at the end."""
    pad = -len(bits) % BLOCK
    per = np.pad(bits, (0, pad)).reshape(-1, BLOCK).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(per)])


class WaveletMatrix:
    """Access, rank and select over the ids of a shard."""

    def __init__(self, n: int, planes: list[np.ndarray], zeros: list[int], counts: list[np.ndarray]):
        self.n, self.planes, self.zeros, self.counts = n, planes, zeros, counts

    @classmethod
    def build(cls, values: np.ndarray) -> WaveletMatrix:
        width = max(int(values.max()).bit_length(), 1) if len(values) else 1
        planes, zeros, counts = [], [], []
        v = values.astype(np.uint16) if width <= 16 else values
        for level in range(width - 1, -1, -1):
            bits = (v >> level) & 1 == 1
            planes.append(np.packbits(bits))
            zeros.append(int(len(v) - np.count_nonzero(bits)))
            counts.append(_ones_before(bits))
            v = np.concatenate([v[~bits], v[bits]])
        return cls(len(values), planes, zeros, counts)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        block = i // BLOCK
        start = block * BLOCK
        part = np.unpackbits(self.planes[level][start >> 3 : (i + 7) >> 3], count=i - start) if i > start else ()
        return int(self.counts[level][block]) + int(np.sum(part, dtype=np.int64))

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for level, zeros in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            value = value << 1 | bit
            i = zeros + ones if bit else i - ones
        return value

    def _range(self, value: int, end: int) -> tuple[int, int]:
        """Where the occurrences of ``value`` before ``end`` stand behind the last plane."""
        if value < 0 or value.bit_length() > len(self.planes):
            return 0, 0
        a, b = 0, end
        for level, zeros in enumerate(self.zeros):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            ones_a, ones_b = self._rank1(level, a), self._rank1(level, b)
            a, b = (zeros + ones_a, zeros + ones_b) if bit else (a - ones_a, b - ones_b)
        return a, b

    def rank(self, value: int, end: int) -> int:
        """Occurrences of ``value`` among the first ``end`` tokens."""
        a, b = self._range(value, min(max(end, 0), self.n))
        return b - a

    def _select_bit(self, level: int, bit: int, j: int) -> int:
        """Place of the j-th (from 0) bit of this kind in a plane."""
        counts = self.counts[level]
        if not bit:
            counts = np.minimum(np.arange(len(counts)) * BLOCK, self.n) - counts
        block = int(np.searchsorted(counts, j, side="right")) - 1
        start = block * BLOCK
        part = np.unpackbits(self.planes[level][start >> 3 : (start + BLOCK) >> 3], count=min(BLOCK, self.n - start))
        return start + int(np.flatnonzero(part == bit)[j - int(counts[block])])

    def select(self, value: int, j: int) -> int | None:
        """Position of the j-th (from 0) occurrence of ``value``, or None."""
        a, b = self._range(value, self.n)
        if not 0 <= j < b - a:
            return None
        i = a + j
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = value >> (len(self.zeros) - 1 - level) & 1
            i = self._select_bit(level, bit, i - self.zeros[level] if bit else i)
        return i

    def values(self) -> np.ndarray:
        """All ids in order: the planes undone from the last to the first."""
        kind = np.uint16 if len(self.planes) <= 16 else np.uint32
        v = np.zeros(self.n, dtype=kind)
        for level in range(len(self.planes) - 1, -1, -1):
            bits = np.unpackbits(self.planes[level], count=self.n).astype(bool)
            up = np.empty_like(v)
            zeros = self.zeros[level]
            up[~bits], up[bits] = v[:zeros], v[zeros:]
            v = up | (bits.astype(kind) << kind(len(self.planes) - 1 - level))
        return v.astype(np.uint32)


def dump(values: np.ndarray, doc_ids: list[int | None], lengths: np.ndarray) -> bytes:
    """The bytes of a shard file."""
    wm = WaveletMatrix.build(values)
    known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
    ids = np.array([d or 0 for d in doc_ids], dtype="<i8")
    sections = [ids, known, np.asarray(lengths, dtype="<u8")]
    for plane, counts in zip(wm.planes, wm.counts, strict=True):
        sections += [plane, counts.astype("<u8")]
    squeeze = zstandard.ZstdCompressor(level=1)
    packed = [squeeze.compress(s.tobytes()) for s in sections]
    places = np.concatenate([[0], np.cumsum([len(p) for p in packed])]).tolist()
    head = json.dumps({"n": wm.n, "docs": len(doc_ids), "zeros": wm.zeros, "places": places}).encode()
    return b"".join([MAGIC, len(head).to_bytes(4, "little"), head, *packed])


class Shard:
    """A shard file in memory; planes are unpacked when first used."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC:
            raise ValueError("not a shard file")
        size = int.from_bytes(raw[8:12], "little")
        self.head = json.loads(raw[12 : 12 + size])
        self._raw, self._base = raw, 12 + size
        self.n, self.docs = self.head["n"], self.head["docs"]
        known = self._section(1, np.uint8)
        self.doc_ids = [int(d) if k else None for d, k in zip(self._section(0, "<i8"), known, strict=True)]
        self.lengths = self._section(2, "<u8").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])

    def _section(self, i: int, kind) -> np.ndarray:
        a, b = self.head["places"][i : i + 2]
        return np.frombuffer(zstandard.ZstdDecompressor().decompress(self._raw[self._base + a : self._base + b]), dtype=kind)

    @property
    def matrix(self) -> WaveletMatrix:
        if not hasattr(self, "_wm"):
            zeros = self.head["zeros"]
            planes = [self._section(3 + 2 * i, np.uint8) for i in range(len(zeros))]
            counts = [self._section(4 + 2 * i, "<u8").astype(np.int64) for i in range(len(zeros))]
            self._wm = WaveletMatrix(self.n, planes, zeros, counts)
        return self._wm


# Kinds of bytes. Letters: ASCII ones and those up to U+023F, whose first UTF-8 byte is C3 to C8. Such letters,
# digits and ASCII marks other than the apostrophe are parted by the tokenizer just where their kind changes, each
# digit for itself. A word with any other byte is left to the tokenizer as it is.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_SPACES = b"\t\n\x0b\x0c\r "
_APOSTROPHE = ord("'")


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[33:127] = _MARK
    kinds[list(_SPACES)] = _SPACE
    kinds[list(range(65, 91)) + list(range(97, 123)) + list(range(0x80, 0xC0)) + list(range(0xC3, 0xC9))] = _LETTER
    kinds[48:58] = _DIGIT
    kinds[_APOSTROPHE] = _OTHER
    return kinds


_KINDS = _kinds()
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], dtype=np.uint8)
#: Of the letters' range the characters that are no letters (multiplication and division sign) or grow when lower-cased.
_ODD = tuple(c.encode() for c in "\u00d7\u00f7\u0130")
#: Bytes of text that are parted at a time, about.
_PIECE = 2 << 20


def _byte_letters() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit integers."""
    return struct.pack(f"<{len(ids)}I", *ids)


class WordEncoder:
    """Whole texts by the tokenizer, pieces that occur again from memory.

    The tokenizer drops white space and never joins what it parts, so the ids
    of a text are those of its pieces: runs of letters, single digits, runs of
    marks, and whole words where these rules do not hold. Texts are parted and
    ids put together in arrays; the tokenizer sees different pieces only.
    Pieces are remembered in two generations: when the younger one has ``most``
    bytes, about, it becomes the older one, and what is met again moves over.
    """

    def __init__(self, path: str, most: int = 64 << 20):
        from tokenizers import Tokenizer

        self._tok, self._most = Tokenizer.from_file(path), most
        self._young: dict[bytes, bytes] = {}
        self._old: dict[bytes, bytes] = {}
        self._held = 0
        self._letters = _byte_letters()
        self._kinds = _KINDS.copy()
        # Added tokens are found in the raw text, so words that could hold one stay whole.
        for token in self._tok.get_added_tokens_decoder().values():
            first = token.content.encode()[0]
            self._kinds[[first] if first in range(33, 48) or first in range(58, 65) else slice(33, None)] = _OTHER
        self._others = np.flatnonzero(self._kinds == _OTHER).astype(np.uint8).tobytes()

    def _whole(self, text: str) -> bytes:
        return _packed(self._tok.encode(text, add_special_tokens=False).ids)

    def _ids(self, piece: bytes) -> bytes:
        """The ids of a piece of which nothing is remembered."""
        if piece.isalpha():
            return self._model(piece.decode("ascii"))
        letters = len(piece.translate(None, self._others)) == len(piece) and not any(o in piece for o in _ODD)
        text = piece.decode("utf-8", "replace")
        if piece.isascii() or not letters:
            return self._whole(text)
        return self._model("".join(map(self._letters.__getitem__, text.lower().encode())))

    def _model(self, spelt: str) -> bytes:
        return _packed([t.id for t in self._tok.model.tokenize(spelt)])

    def _of(self, piece: bytes) -> bytes:
        ids = self._young.get(piece)
        if ids is None:
            ids = self._old.pop(piece, None)
            if ids is None:
                ids = self._ids(piece)
            self._young[piece] = ids
            self._held += len(piece) + len(ids) + 200  # what a dictionary holds beside them
            if self._held > self._most:
                self._old, self._young, self._held = self._young, {}, 0
        return ids

    def _pieces(self, raw: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of the texts that begin at ``starts`` in ``raw``, and the number of pieces before each text."""
        kinds = self._kinds[raw]
        for odd in _ODD:
            kinds[:-1][(raw[:-1] == odd[0]) & (raw[1:] == odd[1])] = _OTHER
        begins = np.zeros(len(raw) + 1, dtype=bool)
        begins[starts] = True
        begins = begins[:-1]
        begins[1:] |= kinds[:-1] == _SPACE
        at = np.flatnonzero(begins & (kinds != _SPACE))  # where words begin
        whole = np.zeros(len(raw), dtype=bool)
        if len(at) and (kinds == _OTHER).any():
            odd_word = np.logical_or.reduceat(kinds == _OTHER, at)
            ends = np.append(at[1:], len(raw))
            for i in np.flatnonzero(odd_word).tolist():
                whole[at[i] : ends[i]] = True  # white space behind the word does no harm
        parted = np.zeros(len(raw), dtype=bool)
        parted[1:] = kinds[1:] != kinds[:-1]
        parted |= kinds == _DIGIT
        parted &= ~whole
        parted |= begins
        kept = kinds != _SPACE
        raw = np.where(whole, raw, _LOWER[raw])[kept]
        parted = parted[kept]
        first = np.flatnonzero(parted)
        offsets = np.append(first, len(raw)).astype(np.int32)
        pieces = pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
        kept_before = np.concatenate([[0], np.cumsum(kept)])[starts]
        return pieces, np.searchsorted(first, kept_before)

    def encode_texts(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of consecutive texts, each with the end id behind it, and their numbers; NULL is empty."""
        texts = pc.fill_null(texts.cast(pa.binary()), b"")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // _PIECE
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield self._encode(texts.slice(a, b - a), sizes[a:b])

    def _encode(self, texts: pa.Array, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = np.cumsum(sizes) - sizes
        raw = np.frombuffer(b"".join(texts.to_pylist()), dtype=np.uint8)
        pieces, before = self._pieces(raw, starts)
        coded = pieces.dictionary_encode()
        known = [END_ID.to_bytes(4, "little"), *map(self._of, coded.dictionary.to_pylist())]
        flat = np.frombuffer(b"".join(known), dtype="<u4")
        n = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        first = np.cumsum(n) - n
        # The end id stands behind the pieces of each text.
        ends = np.append(before[1:], len(pieces))
        order = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, ends, 0)
        counts = n[order]
        upto = np.cumsum(counts)
        ids = flat[np.repeat(first[order] - (upto - counts), counts) + np.arange(upto[-1])]
        last = upto[ends + np.arange(len(ends))]
        return ids, np.diff(last, prepend=0)

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text and the end id, as little-endian unsigned 32-bit integers."""
        for ids, lengths in self.encode_texts(pa.array(list(texts), pa.string())):
            yield from (x.astype("<u4").tobytes() for x in np.split(ids, np.cumsum(lengths)[:-1]))


@lru_cache(maxsize=1)
def _encoder(path: str) -> WordEncoder:
    """One per worker process, so its memory serves the tasks that follow."""
    return WordEncoder(path)


def write_shards(docs: DataFrame, folder: str, tokenizer: str, shard_tokens: int = SHARD_TOKENS, order: list[Column] | None = None) -> DataFrame:
    """Writes the shards of ``docs`` (doc_id, text) and returns ``task, seq, file, first_id, docs, tokens`` per shard.

    Rows are range-sorted by ``order``, or else by ``doc_id`` (NULL first; rows
    with the same id by a hash of the text). A task writes its rows in order and starts a new file
    when one has ``shard_tokens`` ids, so memory does not grow with the task.
    The files are written when the result is computed; store it before use.
    """

    def work(parts):
        task = TaskContext.get()
        part = task.partitionId() if task else 0
        encoder, seq = _encoder(tokenizer), 0
        ids: list[int | None] = []
        blobs: list[np.ndarray] = []
        lengths: list[int] = []
        size = 0

        def close():
            nonlocal seq, size
            values = np.concatenate(blobs)
            out = NewFile(folder, f"tokens-{part:05d}-{seq:05d}", ".wm")
            out.write(dump(values, ids, np.array(lengths, dtype=np.int64)))
            out.close()
            row = pa.record_batch(
                [pa.array([v], t) for v, t in zip((part, seq, out.name, len(ids), len(values)), _SHARD_TYPES, strict=True)],
                names=["task", "seq", "file", "docs", "tokens"],
            )
            seq, size = seq + 1, 0
            for held in (ids, blobs, lengths):
                held.clear()
            return row

        for b in parts:
            docs_ids, at = b.column(0).to_pylist(), 0
            for values, counts in encoder.encode_texts(b.column(1)):
                taken = 0  # ids of this piece that are in a file or waiting for one
                for n in counts.tolist():
                    ids.append(docs_ids[at])
                    lengths.append(n)
                    at, size = at + 1, size + n
                    if size >= shard_tokens:
                        upto = size - sum(map(len, blobs)) + taken
                        blobs.append(values[taken:upto])
                        taken = upto
                        yield close()
                if taken < len(values):
                    blobs.append(values[taken:])
        if ids:
            yield close()

    by_id = F.col("doc_id").asc_nulls_first()
    given = [c.alias(f"_o{i}") for i, c in enumerate(order or [])]
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", *given)
    dealt = [F.col(f"_o{i}") for i in range(len(given))] or [by_id]
    within = dealt if given else [by_id, F.xxhash64("text")]
    return rows.repartitionByRange(*dealt).sortWithinPartitions(*within).select("doc_id", "text").mapInArrow(
        work, "task int, seq int, file string, docs long, tokens long"
    )


_SHARD_TYPES = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())


def with_starts(shards: DataFrame) -> DataFrame:
    """``shards`` with ``start``, the tokens of all shards before: running sums over tasks, then within each."""
    tasks = shards.groupBy("task").agg(F.sum("tokens").alias("_sum"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = tasks.select("task", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("task").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_base") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))
    return shards.join(bases, "task").withColumn("start", start).drop("_base")


DOCUMENT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read_documents(spark: SparkSession, folder: str, shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files that ``shards`` (file, start) names."""

    def work(parts):
        for b in parts:
            starts, blobs = b.column(0).to_pylist(), b.column(1)
            for i, base in enumerate(starts):
                shard = Shard(blobs[i].as_py())
                raw = shard.matrix.values().astype("<u4").tobytes()
                at = shard.starts
                crc = [zlib.crc32(memoryview(raw)[4 * a : 4 * e]) for a, e in zip(at, at[1:], strict=False)]
                yield pa.record_batch(
                    [
                        pa.array(shard.doc_ids, pa.int64()), pa.array(at[:-1] + base, pa.int64()),
                        pa.array(shard.lengths, pa.int64()), pa.array(crc, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.wm").load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    )
    return files.join(with_starts(shards).select("file", "start"), "file").select("start", "content").mapInArrow(work, DOCUMENT)


def find_token(spark: SparkSession, folder: str, shards: DataFrame, token: int, nth: int = 0) -> DataFrame:
    """``file, n, position``: occurrences of a token per shard and the place of the nth one there, by rank and select."""

    def work(parts):
        for b in parts:
            for file, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                wm = Shard(blob.as_py()).matrix
                yield pa.record_batch(
                    [pa.array([file]), pa.array([wm.rank(token, wm.n)], pa.int64()), pa.array([wm.select(token, nth)], pa.int64())],
                    names=["file", "n", "position"],
                )

    files = spark.read.format("binaryFile").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")
    return files.join(shards.select("file"), "file", "left_semi").mapInArrow(work, "file string, n long, position long")


def round_trip(docs: DataFrame, tokenizer: str, as_stored: bool = False) -> DataFrame:
    """All documents written as shards into a new folder of the shared root and read back.

    ``docs``: doc_id, text; other columns are not looked at. A NULL or empty
    text has only the end id. Rows with the same id are documents of their own,
    next to each other; rows without an id come first. ``as_stored``: ``docs``
    is read from Parquet files, and documents stand in the order of the rows there.
    """
    spark = docs.sparkSession
    own_root(spark)
    folder = work_dir(spark, "tokens")
    name = F.col("_metadata.file_name")  # files are numbered; as text, the hundred-thousandth would come before the second
    number = F.regexp_extract(name, r"^part-(\d+)", 1).try_cast("long")
    order = [number, name, F.col("_metadata.row_index")] if as_stored else None
    shards = stored(write_shards(docs, folder, tokenizer, order=order), "token-shards")
    if shards.isEmpty():
        return spark.createDataFrame([], DOCUMENT)
    return read_documents(spark, folder, shards)
