"""Language-model scores by a weighted automaton with failure arcs.

The model is an n-gram model with hierarchical Dirichlet smoothing (MacKay and Peto 1995):
P(w | h) = (c(hw) + m * P(w | shorter h)) / (c(h) + m), and for single tokens an addition of one half.
It is exactly a backoff automaton. A state is a context that was seen in training; it has an arc for each
token that followed it, with the token's whole probability, and a failure arc to the shorter context with
the weight m / (c(h) + m). A text is read once from left to right: a state vector holds the state of many
texts at once, each step takes their next tokens, goes down failure arcs until one fits, and
adds up the weights. All candidate strengths m are carried side by side, and the strength is the one
under which each training token is likeliest when it is itself left out of the counts.

The counts grow with the corpus and are never in one place. Texts are cut into batches. A batch sends
its distinct n-grams once to buckets of n-grams (64-bit hashes, of which one bit tells single tokens), a
bucket adds up the counts and answers every batch, and a batch builds the part of the automaton that its
texts can reach. A bucket is a range of hashes, so a batch sends them sorted and as differences; all lists of
numbers travel compressed.
"""

from __future__ import annotations

import math
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from sparkwatch.llm.text import SPACES, Words, bounded_batches, byte_table, lower_table, mix, slices
from sparkwatch.session import written_table

#: Text of one batch.
BATCH_BYTES = 8 << 20
#: Hashes and counts that one bucket holds about.
BUCKET_BYTES = 32 << 20
#: Tokens of one place in the state vector; a longer text takes several.
LANE = 256
#: Candidates for the strength of the shorter context.
STRENGTHS = tuple(4.0**k for k in range(10))
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Hashes that stand for the beginning and the end of a text.
_BEGIN, _END = mix(np.array([0x6265, 0x656E], np.uint64))
_BEGIN_KEY = _BEGIN | np.uint64(1)

_BATCH = "batch long, n_tokens long, n_learned long, learns array<boolean>, lengths binary, tokens binary, hashes binary"


def _list_of(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def packed(values: np.ndarray) -> bytes:
    """Whole numbers as their count and compressed bytes: all lowest bytes first, all highest last."""
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(data: bytes, kind) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * size, codec="zstd", asbytes=True)
    return np.frombuffer(planes, np.uint8).reshape(size, n).T.copy().reshape(-1).view(kind)


def token_batches(docs: DataFrame, learns: Column, carry: list[str] | None = None) -> DataFrame:
    """One row per batch: the rows, whether the model learns from them, and their tokens as places in
    the batch's list of distinct word hashes."""
    names = docs.columns if carry is None else carry
    rows = bounded_batches(docs).select(
        F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"),
        docs["text"].cast("string").alias("text"),
        F.coalesce(learns, F.lit(False)).alias("learns"),
    )
    schema = StructType([StructField("rows", ArrayType(rows.schema["row"].dataType)), *StructType.fromDDL(_BATCH).fields])

    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in slices(batches, "text", BATCH_BYTES):
            words = Words(batch.column(1), byte_table(SPACES), lower_table())
            hashes, place, times = np.unique(words.hashes(), return_inverse=True, return_counts=True)
            frequent = np.argsort(-times, kind="stable")  # the smaller the numbers, the fewer the bytes
            rank = np.empty(len(hashes), np.int32)
            rank[frequent] = np.arange(len(hashes))
            lengths = np.diff(words.first)
            learned = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            yield pa.RecordBatch.from_arrays(
                [
                    _list_of(batch.column(0)), pa.array([number]), pa.array([int(lengths.sum()) + len(lengths)]),
                    pa.array([int((lengths[learned] + 1).sum())]), _list_of(batch.column(2)),
                    *[pa.array([packed(x)], pa.binary()) for x in (lengths.astype(np.int32), rank[place], hashes[frequent])],
                ],
                names=schema.names,
            )
            number += 1

    return rows.mapInArrow(run, schema)


class Grams:
    """The distinct runs of 1 to ``order`` tokens in a batch of texts, each with its marks.

    A level is (history, token, suffix) per distinct run, as places in the level below, and
    ``ids`` is the run that ends at each position, or -1.
    """

    def __init__(self, tokens, lengths, hashes, order: int):
        self.width, self.order = len(hashes) + 2, order
        self.end = self.width - 1
        size = lengths.astype(np.int64) + 2
        self.first = np.concatenate([[0], np.cumsum(size)])
        self.seq = np.empty(self.first[-1], np.int64)
        inner = np.ones(len(self.seq), bool)
        inner[self.first[:-1]] = inner[self.first[1:] - 1] = False
        self.seq[inner] = tokens
        self.seq[self.first[:-1]], self.seq[self.first[1:] - 1] = self.end - 1, self.end
        self.text = np.repeat(np.arange(len(size)), size)
        self.place = np.arange(len(self.seq)) - self.first[self.text]
        own = np.concatenate([hashes, [_BEGIN, _END]])
        self.ids, self.levels, self.keys = [self.seq], [(None, np.arange(self.width), None)], [own | np.uint64(1)]
        for level in range(2, order + 1):
            at = np.flatnonzero(self.place >= level - 1)
            below = self.ids[-1]
            code, where, ids = np.unique(below[at - 1] * self.width + self.seq[at], return_index=True, return_inverse=True)
            history, token = np.divmod(code, self.width)
            self.ids.append(np.full(len(self.seq), -1, np.int64))
            self.ids[-1][at] = ids
            self.levels.append((history, token, below[at[where]]))
            key = mix(self.keys[-1][history] * _BASE + own[token] + np.uint64(level))
            self.keys.append(key & ~np.uint64(1))

    def counts(self, learned: np.ndarray) -> list[np.ndarray]:
        """How often each run occurs in the texts that the model learns from."""
        good = learned[self.text]
        return [
            np.bincount(ids[good & (ids >= 0)], minlength=len(keys)) for ids, keys in zip(self.ids, self.keys, strict=True)
        ]

    def dealt(self, n_buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All keys, the order in which buckets get them, and their buckets in that order.

        Both orders are that of the keys: a bucket is one of ``n_buckets`` equal ranges.
        """
        keys = np.concatenate(self.keys)
        order = np.argsort(keys, kind="stable")
        bucket = ((keys[order] >> np.uint64(32)) * np.uint64(n_buckets)) >> np.uint64(32)
        return keys, order, bucket.astype(np.int64)


def _grams(row: dict, order: int) -> tuple[Grams, np.ndarray]:
    """The runs of a row of ``token_batches``, and which of its texts the model learns from."""
    one = lambda name, kind: unpacked(row[name][0].as_py(), kind)
    grams = Grams(one("tokens", np.int32), one("lengths", np.int32), one("hashes", np.uint64), order)
    return grams, row["learns"].flatten().to_numpy(zero_copy_only=False).astype(bool)


_SENT = ["tokens", "lengths", "hashes", "learns"]


def sent_grams(batches: DataFrame, order: int, n_buckets: int) -> DataFrame:
    """(batch, bucket, keys, counts): what each batch asks of each bucket and adds to it; keys as differences."""

    def run(parts):
        for part in parts:
            for i in range(part.num_rows):
                row = {c: part.column(part.schema.get_field_index(c)).slice(i, 1) for c in _SENT}
                grams, learned = _grams(row, order)
                keys, order_, bucket = grams.dealt(n_buckets)
                counts = np.concatenate(grams.counts(learned))[order_].astype(np.int32)
                starts = np.flatnonzero(np.diff(bucket, prepend=-1))
                keys = keys[order_]
                apart = np.diff(keys, prepend=np.uint64(0))
                apart[starts] = keys[starts]
                ends = [*starts[1:], len(keys)]
                cut = lambda x: pa.array([packed(x[a:b]) for a, b in zip(starts, ends, strict=True)], pa.binary())  # noqa: E731, B023
                batch = part.column(part.schema.get_field_index("batch"))[i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(starts), batch)), pa.array(bucket[starts], pa.int64()),
                        cut(apart), cut(counts),
                    ],
                    names=["batch", "bucket", "keys", "counts"],
                )

    return batches.select("batch", *_SENT).mapInArrow(run, "batch long, bucket long, keys binary, counts binary")


def _totals(sent: pa.Table) -> pa.Table:
    """The whole counts of a bucket's keys, for each batch that asks; ``words`` is the vocabulary in it."""
    lists = [np.cumsum(unpacked(x.as_py(), np.uint64), dtype=np.uint64) for x in sent["keys"]]
    counts = np.concatenate([unpacked(x.as_py(), np.int32) for x in sent["counts"]])
    ends = np.cumsum([len(x) for x in lists])
    distinct, place = np.unique(np.concatenate(lists), return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, place, counts)
    words = np.zeros(len(lists), np.int64)
    words[0] = np.count_nonzero((distinct & np.uint64(1) == 1) & (total > 0) & (distinct != _BEGIN_KEY))
    return pa.table({
        "asker": sent["batch"], "bucket": sent["bucket"],
        "totals": pa.array([packed(x) for x in np.split(total[place], ends[:-1])], pa.binary()),
        "words": pa.array(words),
    })


class Automaton:
    """States, arcs and failure arcs for the runs of one batch; weights are log10, one per strength."""

    def __init__(self, grams: Grams, counts: list[np.ndarray], n: int, v: int, strengths):
        m = np.asarray(strengths, float)
        self.width = grams.width
        self.single = np.log10((counts[0] + 0.5) / (n + 0.5 * (v + 1)))
        state = [np.full(len(c), -1, np.int64) for c in counts[: grams.order - 1]]
        known = 1
        fail, back = [np.zeros(1, np.int64)], [np.zeros((1, len(m)))]
        for k, own in enumerate(state):
            _, token, suffix = grams.levels[k]
            seen = np.flatnonzero((counts[k] > 0) & (token != grams.end))
            own[seen] = known + np.arange(len(seen))
            known += len(seen)
            fail.append(state[k - 1][suffix[seen]] if k else np.zeros(len(seen), np.int64))
            back.append(np.log10(m / (counts[k][seen, None] + m)))
        self.fail, self.back = np.concatenate(fail), np.concatenate(back)
        codes, weights, targets = [], [], []
        chance = np.repeat(10 ** self.single[:, None], len(m), axis=1)
        for k in range(grams.order):
            history, token, suffix = grams.levels[k]
            if k:
                chance = (counts[k][:, None] + m * chance[suffix]) / (counts[k - 1][history, None] + m)
                seen = np.flatnonzero(counts[k] > 0)
                source = state[k - 1][history[seen]]
            else:
                seen, source = np.arange(self.width), np.zeros(self.width, np.int64)
            codes.append(source * self.width + token[seen])
            weights.append(np.log10(chance[seen]))
            if k < grams.order - 1:
                target = state[k][seen]
            elif k:
                target = state[k - 1][suffix[seen]]
            else:
                target = np.zeros(len(seen), np.int64)
            targets.append(np.maximum(target, 0))
        code = np.concatenate(codes)
        order = np.argsort(code)
        self.codes, self.weights, self.targets = code[order], np.concatenate(weights)[order], np.concatenate(targets)[order]

    def read(self, seq: np.ndarray, begin: np.ndarray, count_from: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Weights of the tokens from ``count_from`` to ``stop`` of each place, read from ``begin``."""
        total = np.zeros((len(begin), self.weights.shape[1]))
        which, at = np.arange(len(begin)), begin.copy()
        state = np.zeros(len(begin), np.int64)
        gained = np.zeros_like(total)
        while len(which):
            token, counted = seq[at], at >= count_from[which]
            todo = np.arange(len(which))
            while len(todo):
                code = state[todo] * self.width + token[todo]
                arc = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
                hit = self.codes[arc] == code
                done, arc = todo[hit], arc[hit]
                gained[done] += self.weights[arc] * counted[done, None]
                state[done] = self.targets[arc]
                todo = todo[~hit]
                gained[todo] += self.back[state[todo]] * counted[todo, None]
                state[todo] = self.fail[state[todo]]
            at = at + 1
            going = at < stop[which]
            if not going.all():
                total[which[~going]] = gained[~going]
                which, at, state, gained = which[going], at[going], state[going], gained[going]
        return total


def places(grams: Grams, size: int = LANE) -> tuple[np.ndarray, ...]:
    """Begin, first counted position, stop and text of each place of the state vector.

    A place that begins within a text reads the tokens of the longest context first, without counting them.
    After these its state is the one that a reader from the text's beginning has.
    """
    low, high = grams.first[:-1] + 1, grams.first[1:]
    number = -(-(high - low) // size)
    text = np.repeat(np.arange(len(low)), number)
    step = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
    count_from = low[text] + step * size
    begin = np.maximum(count_from - (grams.order - 1), grams.first[text])
    return begin, count_from, np.minimum(count_from + size, high[text]), text


def left_out(grams: Grams, counts, learned, n: int, v: int, strengths) -> np.ndarray:
    """log10 probability of the training tokens, each with itself left out of the counts, per strength."""
    m = np.asarray(strengths, float)
    out = np.zeros(len(m))
    if n < 1 or not learned.any():
        return out
    chance = np.repeat((np.maximum(counts[0] - 0.5, 0.5) / (n - 1 + 0.5 * (v + 1)))[:, None], len(m), axis=1)
    good = learned[grams.text]
    for k in range(grams.order):
        if k:
            history, _, suffix = grams.levels[k]
            less = np.maximum(counts[k] - 1, 0)[:, None]
            chance = (less + m * chance[suffix]) / (np.maximum(counts[k - 1][history] - 1, 0)[:, None] + m)
        at = good & (grams.place > 0) & ((grams.place == k) if k < grams.order - 1 else (grams.place >= k))
        times = np.bincount(grams.ids[k][at], minlength=len(counts[k]))
        seen = times > 0
        out += times[seen] @ np.log10(chance[seen])
    return out


_SCORED = "learns boolean, n_tokens long, n_known long, base_score double, scores array<double>, left_out array<double>"


def _scored(held: pa.Table, answers: pa.Table, order: int, n_buckets: int, n: int, v: int, strengths) -> pa.Table:
    """The rows of one batch with their scores under every strength."""
    row = {c: held[c].combine_chunks() for c in ("rows", *_SENT)}
    grams, learned = _grams(row, order)
    keys, dealt, _ = grams.dealt(n_buckets)
    answers = answers.sort_by("bucket")
    whole = np.empty(len(keys), np.int64)
    whole[dealt] = np.concatenate([unpacked(x.as_py(), np.int64) for x in answers["totals"]])
    counts = np.split(whole, np.cumsum([len(k) for k in grams.keys])[:-1])
    automaton = Automaton(grams, counts, n, v, strengths)
    begin, count_from, stop, text = places(grams)
    scores = np.zeros((len(learned), len(strengths)))
    np.add.at(scores, text, automaton.read(grams.seq, begin, count_from, stop))
    counted = grams.place > 0
    tokens, of = grams.seq[counted], grams.text[counted]
    fit = left_out(grams, counts, learned, n, v, strengths)
    lists = np.concatenate([[0], np.full(len(learned), len(strengths))]).cumsum()
    return pa.table({
        "row": row["rows"].flatten(),
        "learns": pa.array(learned),
        "n_tokens": pa.array(np.diff(grams.first) - 1),
        "n_known": pa.array(np.bincount(of[counts[0][tokens] > 0], minlength=len(learned)).astype(np.int64)),
        "base_score": pa.array(np.bincount(of, automaton.single[tokens], len(learned))),
        "scores": pa.ListArray.from_arrays(pa.array(lists, pa.int32()), pa.array(scores.ravel())),
        "left_out": pa.array([fit.tolist(), *[None] * (len(learned) - 1)], pa.list_(pa.float64())),
    })


def score_language(
    docs: DataFrame, learns: Column, order: int = 2, carry: list[str] | None = None, strengths: tuple[float, ...] = STRENGTHS
) -> DataFrame:
    """Per row of ``docs``: ``row`` (the columns in ``carry``, or all), learns, n_tokens, n_known,
    train_tokens, base_score, score, strength.

    The model learns from the rows where ``learns`` is true (null is false) and scores all. A-Z is lower-cased;
    tokens are the words between white space and one end per text, so a null or empty text has one
    token. n_known counts tokens that occur in training, train_tokens all tokens of training.
    base_score adds up log10((c + 0.5) / (N + 0.5 (V + 1))) and score the logarithms of the ``order``-gram model.
    Rows that repeat count as often as they stand. Without training rows both scores are 0. Among equally
    good strengths the smallest is taken. Texts of any length are scored whole, and other columns are not read.

    One batch with its n-grams is what a task holds. A bucket has one entry per batch for each of its n-grams,
    so the hottest n-gram costs a bucket 12 bytes for every 8 MB of text.
    """
    held = written_table(token_batches(docs, learns, carry), "batches")
    sums = held.agg(F.sum("n_tokens").alias("tokens"), F.sum("n_learned").alias("learned")).first()
    n = sums.learned or 0
    n_buckets = max(1, math.ceil(order * (sums.tokens or 0) * 12 / BUCKET_BYTES))
    sent = sent_grams(held, order, n_buckets).repartition(n_buckets, "bucket")
    answers = sent.groupBy("bucket").applyInArrow(_totals, "asker long, bucket long, totals binary, words long")
    answers = written_table(answers, "totals")
    v = answers.agg(F.sum("words")).first()[0] or 0
    out = StructType([StructField("row", held.schema["rows"].dataType.elementType), *StructType.fromDDL(_SCORED).fields])
    score = partial(_scored, order=order, n_buckets=n_buckets, n=n, v=v, strengths=strengths)
    scored = held.groupBy("batch").cogroup(answers.drop("words").groupBy("asker")).applyInArrow(
        lambda left, right: score(left, right), out
    )
    scored = written_table(scored, "scored")
    fit = scored.where("left_out IS NOT NULL").agg(*[F.sum(F.col("left_out")[k]) for k in range(len(strengths))]).first()
    best = max(range(len(strengths)), key=lambda k: (fit[k] or 0.0, -strengths[k]))
    return scored.select(
        "row", "learns", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score",
        F.col("scores")[best].alias("score"), F.lit(float(strengths[best])).alias("strength"),
    )
