"""Document quality by Bradley-Terry pairwise ranking.

A document's strength is linear in its features. A pair of a good and a bad document is a
match that the good one wins with probability sigmoid(strength difference), so strengths are
learned by logistic loss on feature differences. Strengths have no zero of their own; the
threshold is the quantile of the scores that leaves as large a share below it as the
labels call bad, and a score is sigmoid(strength - threshold).

Every labelled document learns. They are dealt at random into groups, and in a group each good document meets
each bad one. Newton's method goes over the stored groups a few times; a task adds up its groups' slopes and
curvatures, which are added up by row, and the driver holds one matrix of features by features.

Features describe the form of a text and not its subject: shares of letters, capitals, digits,
marks and spaces, lengths, repetition of words and lines, and a hashed histogram of runs of
three bytes in which letters are reduced to their kind. The whole text is read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwatch.llm.text import SPACES, Words, bounded_batches, byte_table, carried, mix, slices, with_row
from sparkwatch.session import written_table

#: Columns of the hashed histogram.
SHAPES = 512
#: Rows of each class that a group of matches holds about.
GROUP_ROWS = 256
#: Steps of the fit at most, and the largest change of a weight that ends it.
_STEPS, _SETTLED = 12, 1e-3
#: Weight of the squared weights in the mean loss of a match.
_RIDGE = 1e-3
#: Parts into which a pass over the strengths cuts the interval of the threshold.
_BINS = 1024
#: Rows of one feature matrix.
_ROWS = 512


def _kinds() -> np.ndarray:
    """Byte values with letters, digits and bytes beyond ASCII reduced to one each."""
    table = np.arange(256, dtype=np.uint64)
    table[0x61:0x7B], table[0x41:0x5B], table[0x30:0x3A], table[0x80:] = 0x61, 0x41, 0x30, 0x80
    return table


def _per_row(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.zeros(len(mask) + 1, np.int64)
    np.cumsum(mask, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def _shared(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, and how often its most frequent one occurs."""
    order = np.lexsort((value, row))
    r, v = row[order], value[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (v[1:] != v[:-1])
    starts = np.flatnonzero(new)
    times = np.diff(np.r_[starts, len(r)])
    top = np.zeros(n)
    np.maximum.at(top, r[starts], times)
    return np.bincount(r[starts], minlength=n), top


def features(column) -> np.ndarray:
    """A row of numbers for each text, without regard to its label, language or source."""
    words = Words(column, byte_table(SPACES))
    data, offsets = words.data, words.offsets
    n = len(offsets) - 1
    size = np.diff(offsets)
    one = np.maximum(size, 1)
    count = np.diff(words.first)
    each = np.maximum(count, 1)
    kinds = _kinds()[data]
    masks = {
        "lower": kinds == 0x61, "upper": kinds == 0x41, "digit": kinds == 0x30,
        "beyond": kinds == 0x80, "space": kinds == 0x20, "line": data == 0x0A,
        "stop": (data == 0x2E) | (data == 0x2C), "tag": (data == 0x3C) | (data == 0x3E),
    }
    marks = ~(masks["lower"] | masks["upper"] | masks["digit"] | masks["beyond"])
    marks &= ~(masks["space"] | masks["line"] | masks["stop"])
    same = np.zeros(len(data), bool)
    same[1:] = data[1:] == data[:-1]
    shares = [_per_row(m, offsets) / one for m in (*masks.values(), marks, same)]
    hashes = words.hashes()
    length = words.end - words.start
    mean = np.bincount(words.text, length, n) / each
    spread = np.sqrt(np.maximum(np.bincount(words.text, length.astype(float) ** 2, n) / each - mean**2, 0))
    distinct, top = _shared(words.text, hashes, n)
    twice = np.zeros(len(hashes), bool)
    twice[1:] = (hashes[1:] == hashes[:-1]) & (words.text[1:] == words.text[:-1])
    lines = Words(column, byte_table(b"\n"))
    line_count = np.maximum(np.diff(lines.first), 1)
    line_distinct, _ = _shared(lines.text, lines.hashes(), n)
    bare = np.zeros(len(data) + 1, np.int64)
    np.cumsum(masks["lower"] | masks["upper"] | masks["beyond"], out=bare[1:])
    letters = bare[words.end] - bare[words.start]
    own = [
        np.log1p(size), np.log1p(count), mean, np.log1p(spread), distinct / each, top / each,
        np.bincount(words.text[twice], minlength=n) / each,
        line_distinct / line_count, np.log1p(count / line_count),
        np.bincount(words.text, letters == 0, n) / each,
        np.bincount(words.text, letters < length, n) / each,
        np.bincount(words.text, length > 20, n) / each,
    ]
    grams = np.zeros((n, SHAPES))
    if len(data) > 2:
        code = mix((kinds[:-2] << np.uint64(16)) | (kinds[1:-1] << np.uint64(8)) | kinds[2:])
        row = np.repeat(np.arange(n), size)
        inside = row[:-2] == row[2:]
        slot = row[:-2][inside] * SHAPES + (code[inside] % np.uint64(SHAPES)).astype(np.int64)
        grams = np.bincount(slot, minlength=n * SHAPES).reshape(n, SHAPES) / one[:, None]
    return np.concatenate([np.stack([*shares, *own], axis=1), np.sqrt(grams)], axis=1).astype(np.float32)


def _blocks(batch):
    """Parts of a batch with a bounded number of rows."""
    return (batch.slice(i, _ROWS) for i in range(0, batch.num_rows, _ROWS))


@dataclass
class Ranking:
    """Weights over features scaled by ``mean`` and ``deviation``, and the score's threshold."""

    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    threshold: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.deviation, -6, 6) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.threshold, -30, 30)))


def _scaled(x: np.ndarray, mean: np.ndarray, deviation: np.ndarray) -> np.ndarray:
    return np.clip((x - mean) / deviation, -6, 6).astype(np.float32)


def match_sums(z: np.ndarray, label: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Of all matches in a group: a row with their number and loss, one with the slope, and the curvature's rows."""
    good, bad = z[label == 1], z[label == 0]
    width = z.shape[1]
    out = np.zeros((width + 2, width))
    if not len(good) or not len(bad):
        return out
    ahead = np.clip((good @ w)[:, None] - (bad @ w)[None, :], -30, 30)
    lost = 1 / (1 + np.exp(ahead))
    out[0, :2] = lost.size, np.log1p(np.exp(-ahead)).sum()
    out[1] = lost.sum(axis=0) @ bad - lost.sum(axis=1) @ good
    spread = (lost * (1 - lost)).astype(np.float32)
    across = good.T @ (spread @ bad)
    out[2:] = (good * spread.sum(axis=1)[:, None]).T @ good + (bad * spread.sum(axis=0)[:, None]).T @ bad
    out[2:] -= across + across.T
    return out


def _fitted(width: int, sums) -> np.ndarray:
    """Weights with the least mean loss; ``sums`` gives ``match_sums`` over all groups for some weights."""
    w, step, least = np.zeros(width), np.zeros(width), np.inf
    for _ in range(_STEPS):
        total = sums(w.astype(np.float32))
        n = total[0, 0]
        if not n:
            return w
        loss = total[0, 1] / n + _RIDGE / 2 * (w @ w)
        if loss > least + 1e-9:  # too far
            step = step / 2
            w = w - step
            continue
        least = loss
        step = -np.linalg.solve(total[2:] / n + _RIDGE * np.eye(width), total[1] / n + _RIDGE * w)
        w = w + step
        if np.abs(step).max() < _SETTLED:
            break
    return w


def fit_ranking(x: np.ndarray, label: np.ndarray, bad_share: float) -> Ranking:
    """Learn from one group in memory, as ``learn_quality`` does from many."""
    good, bad = (label == 1).sum(), (label == 0).sum()
    width = x.shape[1]
    if not good or not bad:
        return Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    mean, deviation = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = _scaled(x, mean, deviation)
    w = _fitted(width, lambda w: match_sums(z, label, w))
    strength = z @ w
    share = np.where(label == 1, (1 - bad_share) / good, bad_share / bad)
    order = np.argsort(strength)
    below = np.cumsum(share[order])
    at = min(int(np.searchsorted(below, bad_share)), len(order) - 2)
    return Ranking(mean, deviation, w, float((strength[order[at]] + strength[order[at + 1]]) / 2))


def clean_labels(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, label) of one row per labelled id.

    Nulls and values other than 0 and 1 are left out, equal labels of a doc_id count once, and a doc_id with
    both labels tells nothing and is left out.
    """
    clean = labels.select("doc_id", F.col(label).cast("int").alias("label")).where(
        "doc_id IS NOT NULL AND label IN (0, 1)"
    )
    clean = clean.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("_last"))
    return clean.where("label = _last").drop("_last")


def labelled_sample(labels: DataFrame, label: str, most: int) -> tuple[DataFrame, float]:
    """At most ``most`` rows (doc_id, label) of each class, and the share of class 0.

    The rows of ``clean_labels`` with the smallest hashes of doc_id are taken, so the sample is the same in each
    run and at each partitioning.
    """
    clean = clean_labels(labels, label)
    counts = {r.label: r.n for r in clean.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        clean.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for k in (0, 1)
    ]
    total = sum(counts.values())
    return parts[0].unionByName(parts[1]), counts.get(0, 0) / total if total else 0.0


def labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """(doc_id, label, text) of the sampled ids, one row each: the text with the smallest hash.

    A doc_id that holds most of the rows is reduced before the shuffle and counts like any other.
    """
    text = F.col("text").cast("string").alias("text")
    found = bounded_batches(docs).select("doc_id", text).join(F.broadcast(sample), "doc_id")  # a bounded sample
    first = found.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text"), "text")).alias("first"))
    return first.select(F.col("doc_id").cast("long"), "label", "first.text")


def match_groups(docs: DataFrame, clean: DataFrame, n_groups: int) -> DataFrame:
    """(labels, x): the labels and features of each group of labelled documents.

    Features are made before the shuffle, as they are smaller than texts. Of rows that repeat a doc_id the one whose
    text has the smallest hash is taken, and all but it go before the shuffle.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            for part in _blocks(batch):
                x = features(part.column(1))
                rows = pa.array([row.tobytes() for row in x], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), rows], names=["doc_id", "hash", "x"])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("doc_id")  # rows arrive in any order
        x = pa.array([b"".join(table["x"].to_pylist())], pa.binary())
        return pa.table({"labels": pa.array([table["label"].to_pylist()], pa.list_(pa.int32())), "x": x})

    text = F.col("text").cast("string")
    rows = bounded_batches(docs).where("doc_id IS NOT NULL").select(
        F.col("doc_id"), F.coalesce(text, F.lit("")).alias("text"), F.xxhash64(text).alias("hash")
    )
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(run, f"doc_id {kind}, hash long, x binary")
    first = rows.groupBy("doc_id").agg(F.min(F.struct("hash", "x")).alias("first"))
    found = first.join(clean, "doc_id").select(
        F.pmod(F.xxhash64("doc_id"), F.lit(n_groups)).alias("group"), "doc_id", "label", "first.x"
    )
    return found.groupBy("group").applyInArrow(packed, "labels array<int>, x binary")


def _group(batch: pa.RecordBatch, i: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    label = np.array(batch.column(0)[i].as_py(), np.int32)
    return np.frombuffer(batch.column(1)[i].as_buffer(), np.float32).reshape(len(label), width), label


def _added(groups: DataFrame, width: int, height: int, sums) -> np.ndarray:
    """``sums(x, label)``, of ``height`` rows, over all groups: added up by each task and then by row."""

    def run(batches):
        total = np.zeros((height, width))
        for batch in batches:
            for i in range(batch.num_rows):
                total += sums(*_group(batch, i, width))
        rows = pa.array([row.tobytes() for row in total], pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(height, dtype=np.int32)), rows], names=["place", "sums"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer()) for x in table["sums"])
        return pa.table({"place": table["place"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    parts = groups.mapInArrow(run, "place int, sums binary")
    rows = parts.groupBy("place").applyInArrow(add, "place int, sums binary").collect()
    total = np.zeros((height, width))
    for r in rows:
        total[r.place] = np.frombuffer(r.sums)
    return total


def quantile_between(strengths: DataFrame, bad_share: float, good: float, bad: float) -> float:
    """The middle between the strength at which the share ``bad_share`` is reached and the next higher one.

    Rows (label, strength) weigh so that the class 0 has this share. Each pass counts in bins and goes on in the one
    where the share is reached, until that holds one value, so the driver sees counts only.
    """
    weight = {1: (1 - bad_share) / good, 0: bad_share / bad}
    low, high = strengths.agg(F.min("strength"), F.max("strength")).first()
    while low < high and (step := (high - low) / _BINS) > 0:
        part = F.least(F.floor((F.col("strength") - low) / step), F.lit(_BINS))
        part = F.when(F.col("strength") < low, -1).when(F.col("strength") > high, _BINS + 1).otherwise(part)
        bins = strengths.groupBy(part.alias("part"), "label").agg(
            F.count("*").alias("n"), F.min("strength").alias("low"), F.max("strength").alias("high")
        )
        share, bounds = np.zeros(_BINS + 3), {}
        for r in bins.collect():
            share[r.part + 1] += weight[r.label] * r.n
            first, last = bounds.get(r.part, (r.low, r.high))
            bounds[r.part] = min(first, r.low), max(last, r.high)
        at = int(np.searchsorted(np.cumsum(share), bad_share - 1e-12)) - 1
        low, high = bounds[at]
    after = strengths.where(F.col("strength") > high).agg(F.min("strength")).first()[0]
    return high if after is None else (high + after) / 2


def learn_quality(docs: DataFrame, labels: DataFrame, label: str = "quality", most: int = GROUP_ROWS) -> Ranking:
    """A ranking fitted on all labelled documents; ``most`` is about the rows of each class in a group of matches.

    Of rows that repeat a doc_id one is taken. With labels of one class or none, every score is 0.5. The
    threshold is the quantile of all their scores at the share that the labels call bad.
    """
    clean = clean_labels(labels, label)
    counts = {r.label: r["count"] for r in clean.groupBy("label").count().collect()}
    total = sum(counts.values())
    width = features(pa.array(["a"])).shape[1]
    none = Ranking(np.zeros(width), np.ones(width), np.zeros(width), 0.0)
    if len(counts) < 2:
        return none
    bad_share = counts[0] / total
    groups = written_table(match_groups(docs, clean, -(-total // (2 * most))), "groups")

    def moments(x, label):
        wide = x.astype(float)
        out = np.zeros((3, width))
        out[0, :2] = (label == 1).sum(), (label == 0).sum()
        out[1], out[2] = wide.sum(axis=0), (wide**2).sum(axis=0)
        return out

    sums = _added(groups, width, 3, moments)
    good, bad = sums[0, :2]
    if not good or not bad:
        return none
    mean = sums[1] / (good + bad)
    deviation = np.sqrt(np.maximum(sums[2] / (good + bad) - mean**2, 0)) + 1e-3
    mean, deviation = mean.astype(np.float32), deviation.astype(np.float32)
    weights = _fitted(
        width,
        lambda w: _added(groups, width, width + 2, lambda x, label: match_sums(_scaled(x, mean, deviation), label, w)),
    )
    model = Ranking(mean, deviation, weights, 0.0)

    def strengths(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                x, label = _group(batch, i, width)
                yield pa.RecordBatch.from_arrays([pa.array(label), pa.array(model.strength(x))], names=["label", "strength"])

    found = written_table(groups.mapInArrow(strengths, "label int, strength double"), "strengths")
    model.threshold = quantile_between(found, bad_share, good, bad)
    return model


def score_quality(docs: DataFrame, model: Ranking, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row`` (the columns in ``carry``, or all), score (0 to 1), predicted (score >= 0.5).

    A null text scores as an empty one. No column but text is read for the score.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            for part in _blocks(batch):
                score = model.score(features(part.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32))],
                    names=["row", "score", "predicted"],
                )

    rows = carried(docs, carry)
    return rows.mapInArrow(run, with_row(rows, "score double, predicted int"))


def fold(doc_id: str, parts: int):
    """crc32 of the id as text, modulo ``parts``; a null id counts as an empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts
