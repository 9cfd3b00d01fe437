"""Removal of word passages that another document holds as well, by level-wise doubling.

A window of ``length`` words can only repeat if the windows of half its length inside it
repeat. So lengths are doubled up to ``length`` (7, 13 for 13 words): at each length the
windows that occur in several documents are found, and only positions whose windows all
may repeat are extended to twice that length, until the last length is reached or no
candidates survive. Of the shorter windows inside a longer one, a single one is
looked up: the one with the smallest hash, which equal windows choose alike.

Work is dealt out in two directions. Documents stay in batches; each batch sends the hashes
of its windows, packed into one array for each bucket of hash values, and a bucket answers
with one bit for each hash. A hash that occurs a million times in a batch is sent once, so
a passage in a third of all documents costs one entry per batch. Texts are shuffled once,
by batch, and all levels read that one exchange.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwatch.llm.text import SPACES, Words, bounded_batches, byte_table, mix, rolling, with_row, within

_MAIL = "batch long, bucket long, hashes binary, more binary, lows binary"
_REPLY = "batch long, bucket long, level int, bits binary"
_SALT = np.uint64(0xD6E8FEB86659FD93)
#: Documents of one batch, and bytes of text in it unless it is a single row.
BATCH_ROWS = 512
BATCH_BYTES = 4 << 20
#: Documents, and bytes of text, to a bucket of hash values.
BUCKET_ROWS = 4096
BUCKET_BYTES = 32 << 20


def levels(length: int, shortest: int = 5) -> list[int]:
    """The window lengths up to ``length``, each at most twice the one before."""
    out = [length]
    while (half := (out[0] + 1) // 2) >= shortest and half < out[0]:
        out.insert(0, half)
    return out


def _smallest(hashes: np.ndarray, at: np.ndarray, reach: int) -> np.ndarray:
    """For each position in ``at``, the index of the smallest of ``reach`` hashes from there."""
    best = at.copy()
    for step in range(1, reach):
        other = at + step
        best = np.where(hashes[other] < hashes[best], other, best)
    return best


class _Batch:
    """The windows of one batch of documents, level by level."""

    def __init__(self, table: pa.Table, lengths: list[int], buckets: int):
        self.ids = pc.fill_null(table["doc_id"], 0).to_numpy()
        self.known = np.flatnonzero(pc.is_valid(table["doc_id"]).to_numpy())
        self.words = Words(table["text"], byte_table(SPACES))
        self.hashes = self.words.hashes()
        self.lengths, self.buckets = lengths, buckets
        self.open = within(self.words, lengths[-1])
        self.open = self.open[np.isin(self.words.text[self.open], self.known)]

    def sent(self, level: int):
        """Distinct (hash, more) of the level's windows, their place by bucket, and each
        open position's index among them."""
        length = self.lengths[level]
        keys = rolling(self.hashes, length)
        last = level + 1 == len(self.lengths)
        # Open positions are where the longest window starts; all windows in it must repeat.
        reach = self.lengths[-1] - length + 1
        step = reach if last else self.lengths[level + 1] - length + 1
        firsts = range(0, reach - step + 1, max(step, 1))
        looks = [_smallest(keys, self.open + f, step) for f in firsts]
        if (reach - step) % max(step, 1):
            looks.append(_smallest(keys, self.open + (reach - step), step))
        index = np.stack(looks) if looks else np.zeros((0, 0), np.int64)
        more = mix(rolling(self.hashes ^ _SALT, length)) if last else np.zeros_like(keys)
        more = more >> np.uint64(32)
        places = np.unique(index)
        if last:
            order = places[np.lexsort((more[places], keys[places]))]
        else:
            order = places[np.argsort(keys[places])]
        new = np.ones(len(order), bool)
        new[1:] = (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])
        group = np.cumsum(new) - 1
        of_place = np.zeros(len(keys) + 1, np.int64)
        of_place[order] = group
        return keys[order[new]], more[order[new]], of_place[index], of_place, order, group

    def lows(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The smallest doc_id of each distinct window."""
        low = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).max)
        np.minimum.at(low, group, self.ids[self.words.text[order]])
        return low

    def several(self, order: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether a distinct window occurs in documents of different ids in this batch."""
        ids = self.ids[self.words.text[order]]
        high = np.full(group[-1] + 1 if len(group) else 0, np.iinfo(np.int64).min)
        np.maximum.at(high, group, ids)
        return high > self.lows(order, group)

    def bucket_cuts(self, keys: np.ndarray) -> np.ndarray:
        """Bounds of the buckets among sorted keys; a bucket is a range of hash values."""
        width = (1 << 64) // self.buckets + 1
        edges = np.array([b * width for b in range(self.buckets)] + [(1 << 64) - 1], np.uint64)
        cuts = np.searchsorted(keys, edges)
        cuts[-1] = len(keys)
        return cuts

    def narrowed(self, replies: dict[tuple[int, int], bytes], until: int) -> None:
        """Keep the open positions whose windows repeat at each level below ``until``."""
        for level in range(until):
            keys, _, index, _, order, group = self.sent(level)
            flags = self.answers(keys, replies, level) | self.several(order, group)
            self.open = self.open[flags[index].all(axis=0)]

    def answers(self, keys, replies, level) -> np.ndarray:
        flags = np.zeros(len(keys), bool)
        cuts = self.bucket_cuts(keys)
        for b in range(self.buckets):
            if (bits := replies.get((level, b))) is not None:
                n = cuts[b + 1] - cuts[b]
                flags[cuts[b] : cuts[b + 1]] = np.unpackbits(
                    np.frombuffer(bits, np.uint8), count=n
                ).astype(bool)
        return flags


def _mail(batch: int, work: _Batch, level: int) -> pa.Table:
    keys, more, _, _, order, group = work.sent(level)
    last = level + 1 == len(work.lengths)
    cuts = work.bucket_cuts(keys)
    out = {"batch": [], "bucket": [], "hashes": [], "more": [], "lows": []}
    lows = work.lows(order, group) if last else None
    for b in np.flatnonzero(np.diff(cuts)):
        x, y = cuts[b], cuts[b + 1]
        out["batch"].append(batch)
        out["bucket"].append(int(b))
        out["hashes"].append(keys[x:y].tobytes())
        out["more"].append(more[x:y].astype(np.uint32).tobytes() if last else b"")
        out["lows"].append(lows[x:y].tobytes() if last else b"")
    return pa.table(out, schema=_schema(_MAIL))


def _first_mail(lengths: list[int], buckets: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        return _mail(key[0].as_py(), _Batch(table, lengths, buckets), 0)

    return run


def _next_mail(lengths: list[int], buckets: int, level: int):
    def run(key: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        work = _Batch(table, lengths, buckets)
        work.narrowed(_replies(told), level)
        return _mail(key[0].as_py(), work, level)

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def _replies(table: pa.Table) -> dict[tuple[int, int], bytes]:
    rows = zip(*(table[c].to_pylist() for c in ("level", "bucket", "bits")), strict=True)
    return {(level, bucket): bits for level, bucket, bits in rows}


def _joined(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table[name].to_pylist()), kind)


def _answered(level: int, last: bool):
    """Reply to the mail of one bucket: which hashes come from several batches, or, at the
    last level, which have a smaller doc_id in another batch."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        keys = _joined(table, "hashes", np.uint64)
        sizes = pc.divide(pc.binary_length(table["hashes"]), 8).to_numpy().astype(np.int64)
        if last:
            more, lows = _joined(table, "more", np.uint32), _joined(table, "lows", np.int64)
            order = np.lexsort((more, keys))
            differs = (keys[order][1:] != keys[order][:-1]) | (more[order][1:] != more[order][:-1])
        else:
            order = np.argsort(keys, kind="stable")
            differs = keys[order][1:] != keys[order][:-1]
        starts = np.flatnonzero(np.r_[True, differs])
        count = np.diff(np.r_[starts, len(keys)])
        flags = np.zeros(len(keys), bool)
        if last:
            least = np.repeat(np.minimum.reduceat(lows[order], starts), count)
            flags[order] = least < lows[order]
        else:
            flags[order] = np.repeat(count > 1, count)
        ends = np.cumsum(sizes)
        bits = [np.packbits(flags[e - n : e]).tobytes() for e, n in zip(ends, sizes, strict=True)]
        out = [table["batch"], table["bucket"], pa.array([level] * len(bits), pa.int32()), bits]
        return pa.table(out, schema=_schema(_REPLY))

    return run


def _removed(work: _Batch, replies: dict) -> np.ndarray:
    """Which words a window covers that also starts in a document with a smaller id."""
    work.narrowed(replies, len(work.lengths) - 1)
    length = work.lengths[-1]
    keys, _, index, _, order, group = work.sent(len(work.lengths) - 1)
    smaller = work.answers(keys, replies, len(work.lengths) - 1)
    gone = np.zeros(len(work.words) + 1, np.int64)
    if len(work.open):
        own = work.ids[work.words.text[work.open]]
        hit = smaller[index[0]] | (work.lows(order, group)[index[0]] < own)
        np.add.at(gone, work.open[hit], 1)
        np.add.at(gone, work.open[hit] + length, -1)
    return np.cumsum(gone[:-1]) > 0


_RESULT = "n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def _results(work: _Batch, table: pa.Table, gone: np.ndarray) -> list[dict]:
    words, out = work.words, []
    raw = words.raw
    for r in range(table.num_rows):
        a, b = words.first[r], words.first[r + 1]
        low, high = words.offsets[r], words.offsets[r + 1]
        flags = gone[a:b]
        kept = np.flatnonzero(~flags) + a
        digest = hashlib.sha256()
        text, spans = table["text"][r].as_py(), []
        if len(kept) == b - a:
            whole = raw[low:high].tobytes()
            digest.update(b" ".join(whole.split()))
        else:
            digest.update(b" ".join(raw[words.start[i] : words.end[i]].tobytes() for i in kept))
            edges = np.flatnonzero(np.diff(np.r_[0, flags.astype(np.int8), 0]))
            cut, pieces = low, []
            for x, y in zip(edges[::2] + a, edges[1::2] + a, strict=True):
                # A removed word takes the white space after it along.
                to = words.start[y] if y < b else high
                pieces.append(raw[cut : words.start[x]].tobytes())
                spans.append({"start": int(x - a), "end": int(y - a)})
                cut = to
            pieces.append(raw[cut:high].tobytes())
            text = b"".join(pieces).decode("utf-8", "replace")
        out.append(
            {
                "text": text,
                "n_words": int(b - a),
                "n_removed": int(flags.sum()),
                "kept_sha256": digest.hexdigest(),
                "spans": spans,
            }
        )
    return out


def batched(docs: DataFrame, names: list[str], batch_rows: int, batch_bytes: int) -> DataFrame:
    """batch, doc_id, row (the columns in ``names``) and text of each row of ``docs``.

    A batch has at most ``batch_rows`` neighbouring rows, of one size class: rows of up to
    ``batch_bytes / 2^fits`` bytes, of which it takes no more than 2^fits. So it holds at most
    ``batch_bytes`` of text, or one row, wherever the long texts lie.
    """
    most = (batch_rows - 1).bit_length()
    size = F.greatest(F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)), F.lit(1))
    rows = docs.select(
        F.monotonically_increasing_id().alias("place"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"),
        F.col("text").cast("string").alias("text"),
        size.cast("long").alias("size"),
    )
    fits = f"least(length(bin(greatest({batch_bytes}L div size, 1L))) - 1, {most})"
    held = f"least({batch_rows}L, shiftleft(1L, {fits}))"
    return rows.select(F.expr(f"(place div {held}) * {most + 1}L + {fits}").alias("batch"), "doc_id", "row", "text")


def remove_repeats(
    docs: DataFrame,
    length: int = 13,
    carry: list[str] | None = None,
    with_text: bool = True,
    batch_rows: int = BATCH_ROWS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Remove words covered by a window of ``length`` words that a smaller doc_id holds too.

    Per row of ``docs`` (doc_id, text): ``row`` (the columns in ``carry``, or all but text),
    text (what is left; unchanged where nothing is removed), n_words, n_removed, kept_sha256
    (of the kept words joined by one space), spans (removed words, end exclusive). Windows are
    judged on the input.
 A null text has no words and stays null; an empty one stays
    empty. A row without doc_id neither loses words nor makes others lose any. Rows that
    repeat a doc_id count as the same document, so they do not remove each other.

    ``docs`` must be a stored table: it is read twice, and rows are batched by their place in
    it (see ``batched``). The windows of the last level are compared by 96 bits of hash.
    """
    lengths = levels(length)
    names = [c for c in docs.columns if c != "text"] if carry is None else carry
    spark = docs.sparkSession
    n_rows, n_bytes = bounded_batches(docs).agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))
    ).first()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(parts, math.ceil(n_rows / BUCKET_ROWS), math.ceil(n_bytes / BUCKET_BYTES))
    texts = batched(docs, names, batch_rows, batch_bytes).repartition(parts, "batch")
    replies = None
    for level in range(len(lengths)):
        if replies is None:
            mail = texts.groupBy("batch").applyInArrow(_first_mail(lengths, buckets), _MAIL)
        else:
            mail = texts.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
                _next_mail(lengths, buckets, level), _MAIL
            )
        last = level + 1 == len(lengths)
        reply = mail.groupBy("bucket").applyInArrow(_answered(level, last), _REPLY)
        replies = reply if replies is None else replies.unionByName(reply)
    shown = ("text string, " if with_text else "") + _RESULT

    def finish(key, table, told):
        work = _Batch(table, lengths, buckets)
        rows = _results(work, table, _removed(work, _replies(told)))
        fields = [
            ("text", pa.string()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
            ("kept_sha256", pa.string()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
        ]
        out = pa.Table.from_pylist(rows, pa.schema(fields if with_text else fields[1:]))
        return out.add_column(0, "row", table["row"])

    return texts.groupBy("batch").cogroup(replies.groupBy("batch")).applyInArrow(
        finish, with_row(texts, shown)
    )
