"""Alignment of the tokens that two public tokenizers make of the same text.

Both token sequences cut the same bytes. One state vector holds a pointer into the A tokens and one
into the B tokens of every text of a batch; each step links the two tokens that all pointers
are at, and moves on the one that ends first, or both with a cut where they end together.
Texts that have come to their end leave the state vector. A long text takes several places in it, each
of which begins at a cut, so that the number of steps does not follow the longest text.

How many documents hold a pair of token ids linked is counted by Spark over all batches. A batch
sends each of its pairs once with its number of documents, and each pair's count comes back to it.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from sparkwatch.llm.text import carried, slices, text_bytes
from sparkwatch.session import written_table

#: Text of one batch; its distinct pairs are what a batch asks for.
BATCH_BYTES = 2 << 20
#: Text that is handed to a tokenizer at once.
_CALL_BYTES = 1 << 18
#: A tokens of one place in the state vector.
LANE = 512
#: Words that a tokenizer remembers in a task; beyond them it starts anew.
_WORDS = 1 << 18
_SPACE = "▁"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


#: A single space between two characters that are not white space themselves.
_CUT = re.compile(r"(?<=[!-~\w]) (?=[!-~\w])")


class Encoder:
    """A tokenizer: ``token(i)`` gives the bytes of an id, ``encode(texts)`` all ids and how many each text has.

    Where ``parts`` is true, no token of the vocabulary reaches over a single space into what is before it, so
    a text has the tokens of its words, and each word is encoded once as long as it is remembered.
    """

    parts = False

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self._known: dict[str, int] = {}
        self._first, self._ids = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def table(self) -> pa.Array:
        return pa.array([self.token(i) for i in range(self.size)], pa.large_binary())

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        split = [_CUT.split(t) for t in texts] if self.parts else [[t] for t in texts]
        words = list(chain.from_iterable(split))
        if len(self._known) > _WORDS:
            self._forget()
        new = [w for w in dict.fromkeys(words) if w not in self._known]
        fresh = self.whole(new)
        self._known.update(zip(new, range(len(self._known), len(self._known) + len(new)), strict=True))
        ends = self._first[-1] + np.cumsum(np.fromiter(map(len, fresh), np.int64, len(fresh)))
        self._first = np.concatenate([self._first, ends])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(fresh), np.int32)])
        at = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
        size = self._first[at + 1] - self._first[at]
        before = np.concatenate([[0], np.cumsum(size)])
        ids = self._ids[np.repeat(self._first[at] - before[:-1], size) + np.arange(before[-1])]
        text_ends = before[np.cumsum([len(w) for w in split])] if split else before[:0]
        return ids.astype(np.int64), np.diff(text_ends, prepend=0)


class ByteLevel(Encoder):
    """A byte-level vocabulary in one JSON file. Special tokens in a text are plain text."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self._model = Tokenizer.from_file(path)
        self._model.encode_special_tokens = True
        self._letters = byte_letters()
        self.size = self._model.get_vocab_size()
        # The byte-level pattern never has a token go on over a space after something else.
        rules = json.loads(self._model.to_str())
        before = rules["pre_tokenizer"] or {}
        self.parts = rules["normalizer"] is None and before.get("type") == "ByteLevel" and bool(before.get("use_regex"))

    def token(self, i: int) -> bytes:
        return bytes(self._letters[c] for c in self._model.id_to_token(i) or "")

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._model.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]


class Pieces(Encoder):
    """A model of pieces with byte fallback, which puts a space before a text itself."""

    def __init__(self, path: str):
        super().__init__()
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        self.size = self._model.get_piece_size()
        self.parts = not any(_SPACE in self._model.id_to_piece(i).lstrip(_SPACE) for i in range(self.size))

    def token(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        if self._model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(_SPACE, " ").encode()

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


class _Tokens:
    """Flat token ids of a batch with their end offsets in bytes; a text of other bytes has none."""

    def __init__(self, encoded: list[tuple[np.ndarray, np.ndarray]], table: pa.Array, sizes: np.ndarray):
        self.ids, count = (np.concatenate(x) for x in zip(*encoded, strict=True))
        self.first = np.concatenate([[0], np.cumsum(count)])
        self.end = np.cumsum(sizes[self.ids])
        before = np.concatenate([[0], self.end])
        self.bounds = before[self.first]  # offsets of the texts in the joined bytes of all
        self.joined = text_bytes(table.take(pa.array(self.ids)))[0].data
        self.end -= np.repeat(self.bounds[:-1], count)

    def equals(self, row: int, text: bytes) -> bool:
        return self.joined[self.bounds[row] : self.bounds[row + 1]] == text

    def keep(self, good: np.ndarray) -> None:
        mask = np.repeat(good, np.diff(self.first))
        self.first = np.concatenate([[0], np.cumsum(np.where(good, np.diff(self.first), 0))])
        self.ids, self.end = self.ids[mask], self.end[mask]


def lanes(a_first, a_end, b_first, b_end, size: int = LANE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where the pointers begin and stop: a place for each text, several for one of more A tokens.

    A long text is parted at the first common end after each ``size`` A tokens; the search looks at
    some tokens after each of these only.
    """
    begin_a, begin_b, stop_a, stop_b = [], [], [], []
    for low, high, b_low, b_high in zip(a_first[:-1], a_first[1:], b_first[:-1], b_first[1:], strict=True):
        if low == high:
            continue
        at, b_at = int(low), int(b_low)
        while high - at > size:
            step, ends, own = at + size, None, a_end[low:high]
            while step < high:
                look = own[step - low - 1 : step - low + 63]
                place = b_low + np.searchsorted(b_end[b_low:b_high], look)
                same = np.flatnonzero(b_end[np.minimum(place, b_high - 1)] == look)
                if len(same):
                    ends = step + int(same[0]), int(place[same[0]]) + 1
                    break
                step += 64
            if ends is None or ends[0] >= high:
                break
            begin_a.append(at)
            begin_b.append(b_at)
            at, b_at = ends
            stop_a.append(at)
            stop_b.append(b_at)
        begin_a.append(at)
        begin_b.append(b_at)
        stop_a.append(int(high))
        stop_b.append(int(b_high))
    return tuple(np.array(x, np.int64) for x in (begin_a, begin_b, stop_a, stop_b))


def merge(a_end, b_end, begin_a, begin_b, stop_a) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All links (positions in A and in B) and the positions of the tokens before cuts, in lockstep.

    ``a_end`` and ``b_end`` are byte offsets within a text, whose last ones are equal.
    """
    a, b, stop = begin_a.copy(), begin_b.copy(), stop_a
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        links_a.append(a)
        links_b.append(b)
        ends, other = a_end[a], b_end[b]
        cut = ends == other
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a = a + (ends <= other)
        b = b + (other <= ends)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    if not links_a:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(x) for x in (links_a, links_b, cuts_a, cuts_b))


_MARKS = ("", ",", "|", ";")


def _texts(size: int) -> list[pa.Array]:
    """The decimal text of each id, followed by each of the marks."""
    return [pa.array([f"{i}{mark}" for i in range(size)], pa.large_binary()) for mark in _MARKS]


def _group_digests(a: _Tokens, b: _Tokens, cuts_a: np.ndarray, cuts_b: np.ndarray, texts: pa.Array, sizes: tuple[int, int]) -> list[str]:
    """The digest of ``a1,a2|b1;a3|b2,b3`` per text: one look-up of each token with its mark."""
    ends_a, ends_b = np.zeros(len(a.ids), bool), np.zeros(len(b.ids), bool)
    ends_a[cuts_a] = ends_b[cuts_b] = True
    group_a = np.cumsum(ends_a) - ends_a
    group_b = np.cumsum(ends_b) - ends_b
    mark_a, mark_b = np.where(ends_a, 2, 1), np.where(ends_b, 3, 1)
    mark_b[b.first[1:][np.diff(b.first) > 0] - 1] = 0
    per_mark = sizes[0] + sizes[1]
    code = np.concatenate([mark_a * per_mark + a.ids, mark_b * per_mark + sizes[0] + b.ids])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    joined, offsets = text_bytes(texts.take(pa.array(code[order])))
    bounds = offsets[a.first + b.first]
    data = joined.data
    return [hashlib.sha256(data[s:e]).hexdigest() if e > s else "" for s, e in zip(bounds[:-1], bounds[1:], strict=True)]


def _lists(first: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)


_COUNTS = "n_a long, n_b long, n_groups long, n_links long"
_SPANS = "groups array<struct<a: array<int>, b: array<int>, byte_end: long>>, links array<struct<a: int, b: int>>"
_HELD = f"{_COUNTS}, groups_sha256 string, {_SPANS}, batch long, pair array<int>, times array<int>, pairs array<long>, holders array<int>"


def _spans(a: _Tokens, b: _Tokens, link_a, link_b, cuts, kinds: pa.Schema) -> tuple[pa.Array, pa.Array]:
    """The groups with their token ids and last byte, and the links as token positions, per text."""
    groups, links = [], []
    text = np.searchsorted(a.first, link_a, "right") - 1
    order = np.lexsort((link_b, link_a))
    la, lb, text = link_a[order], link_b[order], text[order]
    at = np.searchsorted(text, np.arange(len(a.first)))
    cuts = np.sort(cuts)
    cut_at = np.searchsorted(cuts, a.first)
    for r in range(len(a.first) - 1):
        s, e = at[r], at[r + 1]
        links.append([{"a": int(x), "b": int(y)} for x, y in zip(la[s:e] - a.first[r], lb[s:e] - b.first[r], strict=True)])
        own, i, j = [], a.first[r], b.first[r]
        for cut in cuts[cut_at[r] : cut_at[r + 1]]:
            end = a.end[cut]
            k = b.first[r] + np.searchsorted(b.end[b.first[r] : b.first[r + 1]], end) + 1
            own.append({"a": a.ids[i : cut + 1].tolist(), "b": b.ids[j:k].tolist(), "byte_end": int(end)})
            i, j = cut + 1, k
        groups.append(own)
    return pa.array(groups, kinds.field("groups").type), pa.array(links, kinds.field("links").type)


def _aligned_batch(texts: pa.Array, first: Encoder, second: Encoder, tables, marks, spans: pa.Schema | None) -> dict:
    rows = len(texts)
    plain = [t or "" for t in texts.to_pylist()]
    ids_a, ids_b = [], []
    size, begin = 0, 0
    for i, t in enumerate(plain):
        size += len(t)
        if size >= _CALL_BYTES or i == rows - 1:
            ids_a.append(first.encode(plain[begin : i + 1]))
            ids_b.append(second.encode(plain[begin : i + 1]))
            size, begin = 0, i + 1
    a, b = _Tokens(ids_a, *tables[0]), _Tokens(ids_b, *tables[1])
    good = np.zeros(rows, bool)
    for r, t in enumerate(plain):
        if t:
            whole = b" " + t.encode()
            good[r] = a.equals(r, whole) and b.equals(r, whole)
    a.keep(good)
    b.keep(good)
    begin_a, begin_b, stop_a, _ = lanes(a.first, a.end, b.first, b.end)
    link_a, link_b, cuts, cuts_b = merge(a.end, b.end, begin_a, begin_b, stop_a)
    text = np.searchsorted(a.first, link_a, "right") - 1
    pairs, place = np.unique(a.ids[link_a] << 32 | b.ids[link_b], return_inverse=True)
    held, times = np.unique(text * max(len(pairs), 1) + place, return_counts=True)
    owner, pair = np.divmod(held, max(len(pairs), 1))
    out = {
        "n_a": np.diff(a.first),
        "n_b": np.diff(b.first),
        "n_groups": np.bincount(np.searchsorted(a.first, cuts, "right") - 1, minlength=rows),
        "n_links": np.bincount(text, minlength=rows),
        "groups_sha256": _group_digests(a, b, cuts, cuts_b, marks, (first.size, second.size)),
        "pair": _lists(np.searchsorted(owner, np.arange(rows + 1)), pa.array(pair, pa.int32())),
        "times": _lists(np.searchsorted(owner, np.arange(rows + 1)), pa.array(times, pa.int32())),
        "pairs": pairs,
        "holders": np.bincount(pair, minlength=len(pairs)),
    }
    groups, links = _spans(a, b, link_a, link_b, cuts, spans) if spans else (pa.nulls(rows), pa.nulls(rows))
    return {**out, "groups": groups, "links": links}


def align_batches(docs: DataFrame, first, second, carry: list[str] | None = None, with_spans: bool = False) -> DataFrame:
    """Per row: ``row``, its counts and digest, and its distinct links by place in its batch's list.

    The batch's list of distinct pairs (A id * 2^32 + B id) and the number of rows that hold each
    stand in the batch's first row.
    """
    rows = carried(docs, carry)
    held = StructType.fromDDL(_HELD)
    kinds = to_arrow_schema(held)

    def run(batches):
        own, other = first(), second()
        tables = []
        for model in (own, other):
            table = model.table()
            tables.append((table, pc.binary_length(table).to_numpy(zero_copy_only=False).astype(np.int64)))
        parts = list(zip(_texts(own.size), _texts(other.size), strict=True))
        marks = pa.concat_arrays([part for pair in parts for part in pair])
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BATCH_BYTES):
            found = _aligned_batch(batch.column(1), own, other, tables, marks, kinds if with_spans else None)
            n = batch.num_rows
            once = np.minimum(np.arange(n + 1), 1) * len(found["pairs"])
            found["pairs"] = _lists(once, pa.array(found["pairs"], pa.int64()))
            found["holders"] = _lists(once, pa.array(found["holders"], pa.int32()))
            found["batch"] = np.full(n, number)
            columns = [batch.column(0)]
            for kind in kinds:
                value = found[kind.name]
                columns.append(value.cast(kind.type) if isinstance(value, pa.Array) else pa.array(value, kind.type))
            yield pa.RecordBatch.from_arrays(columns, names=["row", *kinds.names])
            number += 1

    return rows.mapInArrow(run, StructType([rows.schema["row"], *held.fields]))


def pair_counts(held: DataFrame) -> DataFrame:
    """(pair, n, top): the documents that hold each linked pair; top: no pair of its A id has more."""
    sent = held.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = sent.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum(F.col("p.holders").cast("long")).alias("n"))
    counts = written_table(counts, "pairs")
    most = counts.groupBy(F.shiftright("pair", 32).alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, F.shiftright("pair", 32) == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("top"))


def _weighed(held: pa.Table, pairs: pa.Table) -> pa.Table:
    """Sums over the links of a batch's rows, from the counts of its pairs."""
    order = np.argsort(pairs["pair"].to_numpy())
    n = pairs["n"].to_numpy()[order]
    top = pairs["top"].to_numpy()[order]
    pair = held["pair"].combine_chunks()
    first = np.concatenate([[0], np.cumsum(pair.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
    times = held["times"].combine_chunks().flatten().to_numpy().astype(np.int64)
    at = pair.flatten().to_numpy()
    sums = []
    for each in (times * top[at], times * n[at]):
        total = np.concatenate([[0], np.cumsum(each, dtype=np.int64)])
        sums.append(pa.array(total[first[1:]] - total[first[:-1]], pa.int64()))
    kept = held.drop_columns(["batch", "pair", "times"])
    return kept.append_column("n_best", sums[0]).append_column("count_sum", sums[1])


def aligned(docs: DataFrame, first, second, carry: list[str] | None = None, with_spans: bool = False) -> DataFrame:
    """Per row of ``docs``: ``row`` (the columns in ``carry``, or all) and how its two tokenizations meet.

    ``first`` and ``second`` make an ``Encoder`` in a task. n_a and n_b count tokens, n_groups the parts
    between byte offsets where tokens of both end, n_links the pairs of tokens whose bytes overlap,
    n_best the links whose pair of ids no other pair of its A id exceeds in documents corpus-wide, count_sum
    adds up that number over the links. groups_sha256 is the digest of ``a1,a2|b1;a3|b2,b3``.
    With ``with_spans`` also groups (ids of A and B and last byte) and links (token positions), else null.

    A text that is null or empty, or whose tokens of either kind do not join to a space and the text,
    has zeros and an empty digest. Each row is a document, also where doc_ids repeat or are null;
    texts of any length are aligned whole. Only text is read; other columns may have any name.
    """
    held = written_table(align_batches(docs, first, second, carry, with_spans), "aligned")
    counts = pair_counts(held)
    asked = held.select(F.col("batch").alias("asker"), F.explode("pairs").alias("pair"))
    # A pair that every batch holds is one row for each; AQE splits such a partition.
    answers = asked.join(counts, "pair").select("asker", "pair", "n", "top")
    own = held.drop("pairs", "holders")
    kept = [f for f in own.schema.fields if f.name not in ("batch", "pair", "times")]
    out = StructType([*kept, *StructType.fromDDL("n_best long, count_sum long").fields])
    return own.groupBy("batch").cogroup(answers.groupBy("asker")).applyInArrow(_weighed, out)
