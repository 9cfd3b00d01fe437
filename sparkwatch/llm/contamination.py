"""Benchmark decontamination as a prefix-filtered set join over word windows.

Each benchmark item is cut into windows of ``window`` words, an item of fewer words is one
window. A window is a set of word shingles, and a document that holds the window holds all of
them. So it is enough to look for one of them, and the rarest is the cheapest: shingles are
ordered by the number of documents that hold them, and only the first shingle of each window
in that order, its necessary prefix, is joined with the documents. Where it occurs, its
place in the window says where the window must begin; the beginning may not lie before the
document (positional bound) nor its end behind it (length bound). What is left is
verified word by word.

Documents are never shuffled. The benchmark's windows are dealt into blocks of a bounded
number of bytes; a block is sent to all tasks and the documents pass it in one
scan. More blocks mean more passes inside the same scan job and not more memory.
"""

from __future__ import annotations

import hashlib
import math
import pickle
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sparkwatch.llm.text import (
    Words,
    bounded_batches,
    carried,
    lower_table,
    rolling,
    slices,
    with_row,
    word_bytes,
)
from sparkwatch.session import written_table

#: Bytes of item text in one block, which is what a task holds of the benchmark.
BLOCK_BYTES = 16 << 20
_WINDOWS = "item string, place int, size int, words binary, shingles array<long>"


def _windows(items: DataFrame, window: int, shingle: int) -> DataFrame:
    """Distinct windows of each item with the hashes of their shingles."""

    def run(batches):
        for batch in slices(batches, "text"):
            words = Words(batch.column(1), word_bytes(), lower_table())
            hashes = words.hashes()
            out = []
            for r, item in enumerate(batch.column(0).to_pylist()):
                a, b = int(words.first[r]), int(words.first[r + 1])
                if item is None or a == b:
                    continue
                size, seen = min(window, b - a), set()
                short = min(shingle, size)
                grams = rolling(hashes[a:b], short).view(np.int64)
                tokens = [words.word(i) for i in range(a, b)]
                for p in range(b - a - size + 1):
                    key = b" ".join(tokens[p : p + size])
                    if key not in seen:
                        seen.add(key)
                        out.append((item, p, size, key, grams[p : p + size - short + 1].tolist()))
            columns = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(columns[0], pa.string()),
                    pa.array(columns[1], pa.int32()),
                    pa.array(columns[2], pa.int32()),
                    pa.array(columns[3], pa.binary()),
                    pa.array(columns[4], pa.list_(pa.int64())),
                ],
                names=["item", "place", "size", "words", "shingles"],
            )

    wanted = items.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, _WINDOWS)


def _grams(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of ``size`` words that stay in their text, and where they begin."""
    n = max(len(hashes) - size + 1, 0)
    at = np.flatnonzero(words.text[:n] == words.text[size - 1 :][:n])
    return rolling(hashes, size)[at], at


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which values are among the sorted ones of ``of``."""
    if not len(of):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(of, values), len(of) - 1)
    return of[at] == values


def _counted(docs: DataFrame, wanted: list[tuple[int, np.ndarray]]) -> DataFrame:
    """In how many documents each of the wanted shingles occurs."""

    def run(batches):
        total: dict[int, int] = defaultdict(int)
        for batch in slices(batches, "text"):
            words = Words(batch.column(0), word_bytes(), lower_table())
            hashes = words.hashes()
            for size, known in wanted:
                values, at = _grams(words, hashes, size)
                hit = _member(values, known)
                pairs = np.unique(
                    np.stack([values[hit], words.text[at[hit]].astype(np.uint64)]), axis=1
                )
                for value, n in zip(*np.unique(pairs[0], return_counts=True), strict=True):
                    total[int(value)] += int(n)
        values = np.array(list(total), np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.int64()), pa.array(list(total.values()), pa.int64())],
            names=["shingle", "n"],
        )

    return (
        docs.select(F.col("text").cast("string").alias("text"))
        .mapInArrow(run, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
    )


def _block(rows, counts: dict[int, int], shingle: int) -> dict:
    """The join table of a block: by prefix shingle, the windows and where it lies in them."""
    items = sorted({r.item for r in rows})
    code = {item: i for i, item in enumerate(items)}
    table: dict[int, dict[int, list]] = {}
    for r in rows:
        grams = [int(x) & (2**64 - 1) for x in r.shingles]
        rare = min(range(len(grams)), key=lambda i: (counts.get(grams[i], 0), i))
        if counts.get(grams[rare], 0):
            by_size = table.setdefault(min(shingle, r.size), {})
            by_size.setdefault(grams[rare], []).append((rare, r.size, bytes(r.words), code[r.item]))
    return {
        "items": items,
        "sizes": [
            (size, np.array(sorted(t), np.uint64), [t[k] for k in sorted(t)])
            for size, t in sorted(table.items())
        ],
    }


def _joined(block: dict, last: bool, share: int):
    """Adds to each document the words that the block's windows hit and the items found.

    Text and findings go on to the next block; the last block gives the result.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            words = Words(batch.column(0), word_bytes(), lower_table())
            hashes = words.hashes()
            rows = [pickle.loads(x) if x else ([], set()) for x in batch.column(1).to_pylist()]
            for size, prefix, windows in block["sizes"]:
                values, at = _grams(words, hashes, size)
                hit = np.flatnonzero(_member(values, prefix))
                which = np.searchsorted(prefix, values[hit])
                for place, k in zip(at[hit].tolist(), which.tolist(), strict=True):
                    row = int(words.text[place])
                    for offset, length, key, item in windows[k]:
                        begin = place - offset
                        if begin < words.first[row] or begin + length > words.first[row + 1]:
                            continue
                        spans, found = rows[row]
                        if key == b" ".join(words.word(i) for i in range(begin, begin + length)):
                            start = begin - int(words.first[row])
                            if not spans or spans[-1] != (start, start + length):
                                spans.append((start, start + length))
                            found.add(block["items"][item])
            n_words = np.diff(words.first)
            if last:
                yield _summary(batch.column(2), n_words, rows, share)
                continue
            state = [pickle.dumps((sorted(set(s)), f)) if s else None for s, f in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(state, pa.binary()), batch.column(2)],
                names=["text", "state", "row"],
            )

    return run


def _summary(row: pa.Array, n_words: np.ndarray, rows: list, share: int) -> pa.RecordBatch:
    """The result of documents from the spans and items found in each."""
    n_hit, digest, spans_out = [], [], []
    for spans, found in rows:
        hit, end = 0, 0
        spans = sorted(set(spans))
        for x, y in spans:
            hit += max(0, y - max(x, end))
            end = max(end, y)
        n_hit.append(hit)
        digest.append(hashlib.sha256(",".join(sorted(found)).encode()).hexdigest())
        spans_out.append([{"start": x, "end": y} for x, y in spans])
    bad = [h > 0 and share * h >= n for h, n in zip(n_hit, n_words.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            row, pa.array(n_words), pa.array(n_hit, pa.int64()), pa.array([len(f) for _, f in rows], pa.int64()),
            pa.array(digest, pa.string()), pa.array(bad, pa.bool_()),
            pa.array(spans_out, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ],
        names=["row", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    window: int = 13,
    shingle: int = 5,
    share: int = 20,
    block_bytes: int = BLOCK_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """How far benchmark ``items`` (item_id, text) occur in ``docs`` (doc_id, text).

    Per row of ``docs``: ``row`` (the columns in ``carry``, or all), n_words, n_hit (words inside an occurrence of a window),
    n_items (items with a window in it), items_sha256 (of those item_ids, sorted as strings and
    joined by commas), contaminated (n_hit > 0 and ``share`` * n_hit >= n_words) and spans, the
    occurrences (word numbers, end exclusive).

    Words are maximal runs of ASCII digits, ASCII letters (lower-cased) and other non-ASCII
    characters. Null and empty texts have no words: such documents are clean, such items
    never occur. An item without item_id takes no part. Items of equal text all count, equal
    item_ids count once. Rows of ``docs`` each give a row, whether they repeat or have no doc_id.
    Other columns are not read. Both tables are read more than once, so they should be stored.
    """
    bounded_batches(docs)
    windows = written_table(_windows(items, window, shingle), "windows")
    size = windows.agg(F.sum(F.length("words") + 8 * F.size("shingles") + 64)).first()[0] or 0
    n_blocks = max(1, math.ceil(size / block_bytes))
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("item", "place"), F.lit(n_blocks)))
    blocks = []
    for b in range(n_blocks):
        # Bounded by block_bytes: a block is what one task may hold of the benchmark.
        rows = dealt.where(F.col("block") == b).drop("block").collect()
        by_size = defaultdict(set)
        for r in rows:
            by_size[min(shingle, r.size)].update(int(x) & (2**64 - 1) for x in r.shingles)
        wanted = [(k, np.array(sorted(v), np.uint64)) for k, v in sorted(by_size.items())]
        counts = {r.shingle & (2**64 - 1): r.n for r in _counted(docs, wanted).collect()} if rows else {}
        blocks.append(_block(rows, counts, shingle))
    state = carried(docs, carry).withColumn("state", F.lit(None).cast("binary"))
    row = state.schema["row"]
    shown = (
        "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        "spans array<struct<start:long,end:long>>"
    )
    for block in blocks:
        last = block is blocks[-1]
        schema = StructType([*StructType.fromDDL("text string, state binary").fields, row])
        state = state.select("text", "state", "row").mapInArrow(
            _joined(block, last, share), with_row(state, shown) if last else schema
        )
    return state
