"""Words and word hashes of whole Arrow text columns, without a loop over words."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_MIX_A = 0xBF58476D1CE4E5B9
_MIX_B = 0x94D049BB133111EB
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Powers of the base are kept for blocks of this many bytes.
_BLOCK = 1 << 18
#: UTF-8 bytes that separate words: space and tab to carriage return.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(_MIX_A)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(_MIX_B)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and the offset where each text begins.

    The last offset is the end. Null is an empty text.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8, ends[-1] - ends[0], ends[0]), ends - ends[0]


def _powers(base: int, n: int) -> np.ndarray:
    powers = np.full(n, base, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


class Words:
    """The words of a batch of texts: ``start`` and ``end`` in ``data``, ``text`` is the row.

    ``first[r]`` is the first word of row r, ``first[r + 1]`` the one after its last.
    """

    def __init__(self, column, is_word: np.ndarray, fold: np.ndarray | None = None):
        """``is_word`` and ``fold`` are tables over the 256 byte values; ``fold`` replaces bytes."""
        self.raw, self.offsets = text_bytes(column)
        self.data = self.raw if fold is None else fold[self.raw]
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = is_word[self.data]
        begins = inside[1:-1] & ~inside[:-2]
        bounds = self.offsets[(self.offsets < len(self.data))]
        begins[bounds] = inside[1:-1][bounds]  # a word ends with its text
        closes = inside[1:-1] & ~inside[2:]
        lasts = self.offsets[self.offsets > 0] - 1
        closes[lasts] = inside[1:-1][lasts]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, self.offsets)
        self.text = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, most_bytes: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes, or of the first ``most_bytes`` of them."""
        values = mix(np.arange(1, 257, dtype=np.uint64))
        up, down = _powers(_BASE, _BLOCK), _powers(_INVERSE, _BLOCK)
        out = np.zeros(len(self.start), np.uint64)
        # Words begin in their block; the sum runs on to the end of the block's last word.
        for low in range(0, max(len(self.data), 1), _BLOCK):
            a, b = np.searchsorted(self.start, (low, low + _BLOCK))
            if a == b:
                continue
            high = int(self.end[b - 1])
            size = high - low
            if size > len(up):
                up = _powers(_BASE, size)
            sums = np.zeros(size + 1, np.uint64)
            np.cumsum(values[self.data[low:high]] * up[:size], out=sums[1:])
            start, end = self.start[a:b] - low, self.end[a:b] - low
            if most_bytes is not None:
                end = np.minimum(end, start + most_bytes)
            out[a:b] = (sums[end] - sums[start]) * down[start]
        length = self.end - self.start
        if most_bytes is not None:
            length = np.minimum(length, most_bytes)
        return mix(out ^ length.astype(np.uint64))

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def byte_table(outside: bytes) -> np.ndarray:
    """True for each byte value but those given."""
    table = np.ones(256, bool)
    table[list(outside)] = False
    return table


def word_bytes() -> np.ndarray:
    """True for the bytes of words: digits, a-z and all beyond ASCII (after lower-casing)."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x61:0x7B] = table[0x80:] = True
    return table


def lower_table() -> np.ndarray:
    """The byte values with A-Z lower-cased."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    return table


def rolling(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash of each run of ``length`` neighbours; the runs of other texts are not left out."""
    if len(hashes) < length:
        return np.zeros(0, np.uint64)
    n = len(hashes) - length + 1
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * np.uint64(_BASE) + hashes[k : k + n]
    return mix(out)


def within(words: Words, length: int) -> np.ndarray:
    """The positions where a run of ``length`` words begins that stays in its text."""
    n = max(len(words) - length + 1, 0)
    return np.flatnonzero(words.text[:n] == words.text[length - 1 :][:n]) if n else np.zeros(0, np.int64)


def slices(batches, column: str, most_bytes: int = 1 << 20):
    """Record batches cut so that each holds at most ``most_bytes`` of text, or one row.

    Bounds the working memory of a task whatever the batch size and text lengths are.
    """
    for batch in batches:
        at = batch.schema.get_field_index(column)
        column_ = batch.column(at).cast(pa.large_binary())
        sizes = np.nan_to_num(
            pa.compute.binary_length(column_).to_numpy(zero_copy_only=False).astype(float)
        )
        ends = np.cumsum(sizes)
        begin = 0
        while begin < len(sizes):
            base = ends[begin - 1] if begin else 0
            stop = max(int(np.searchsorted(ends, base + most_bytes, "right")), begin + 1)
            yield batch.slice(begin, stop - begin)
            begin = stop


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(df):
    """Let Spark hand texts to tasks in batches of 4 MB, and give back ``df``.

    Its default of 64 MB costs each task several times that outside of the heap. A session that has
    set another size than the default keeps it.
    """
    if df.sparkSession.conf.get(_BATCH_BYTES).rstrip("b") == str(64 << 20):
        df.sparkSession.conf.set(_BATCH_BYTES, "4m")
    return df


def carried(df, columns: list[str] | None = None):
    """``row`` (a struct of the given columns, or all) beside the text as a string.

    Operators hand ``row`` on untouched, so extra columns may have any name and type.
    """
    names = df.columns if columns is None else columns
    return bounded_batches(df).select(
        F.struct(*[df[f"`{c}`"] for c in names]).alias("row"), df["text"].cast("string").alias("text")
    )


def with_row(df, ddl: str) -> StructType:
    """The schema of ``row`` followed by the columns in ``ddl``."""
    return StructType([df.schema["row"], *StructType.fromDDL(ddl).fields])
