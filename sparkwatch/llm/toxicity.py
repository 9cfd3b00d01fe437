"""Toxic documents and sentences by multiple-instance learning with noisy-or.

A document is a bag of sentences. A sentence is toxic with probability sigmoid(bias + sum
of the weights of its distinct words), and a document is toxic unless all its sentences are
not: 1 - prod(1 - p). Only documents are labelled; the gradient of the document's likelihood
says how much of the blame each sentence gets, and so the model also finds the sentences.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwatch.llm.quality import labelled_sample, labelled_texts
from sparkwatch.llm.text import Words, carried, lower_table, mix, slices, with_row, word_bytes

SLOTS = 1 << 18
#: Labelled rows of each class that the fit takes at most; they are those with the smallest hash.
MOST_LABELLED = 3000
#: A word gets a weight if so many sampled documents hold it, and if its share of the toxic
#: ones exceeds that of the others by so many standard errors. Without that, a bag of hundreds of
#: rare words can always be explained by one that no other document has.
LEAST_DOCUMENTS = 4
STANDARD_ERRORS = 3.5
#: A run of words without an end mark is cut into sentences of so many words.
LONGEST = 64


#: Besides whole words, their beginnings of so many bytes are features, for the forms of a word.
#: They are less certain than words and must lead by more standard errors.
BEGINNINGS = (6, 8)
BEGINNING_ERRORS = 5.0


def sentences(column) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, the sentence of each word, its slots (one row for the word and one for
    each beginning), and the text of each sentence."""
    words = Words(column, word_bytes(), lower_table())
    keys = np.stack([words.hashes(), *[mix(words.hashes(n) + np.uint64(n)) for n in BEGINNINGS]])
    keys[0] %= np.uint64(SLOTS // 2)  # words have the lower half of the slots, beginnings the upper
    keys[1:] = keys[1:] % np.uint64(SLOTS // 2) + np.uint64(SLOTS // 2)
    slot = keys.astype(np.int64)
    ends = np.zeros(len(words.data) + 1, np.int64)
    np.cumsum(np.isin(words.data, np.frombuffer(b".!?\n", np.uint8)), out=ends[1:])
    new = np.ones(len(words), bool)
    mark = ends[words.start]
    new[1:] = (mark[1:] != mark[:-1]) | (words.text[1:] != words.text[:-1])
    begins = np.flatnonzero(new)
    if len(begins):
        place = np.arange(len(words)) - np.repeat(begins, np.diff(np.r_[begins, len(words)]))
        new |= place % LONGEST == 0
    sentence = np.cumsum(new) - 1
    return words, sentence, slot, words.text[np.flatnonzero(new)]


def _distinct(sentence: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(sentence * SLOTS + slot)
    return pairs // SLOTS, pairs % SLOTS


@dataclass
class Blame:
    """The weights of word slots and the bias of a sentence."""

    weights: np.ndarray
    bias: float

    def sentence_scores(self, sentence: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        heavy = self.weights[slot] != 0
        s, f = _distinct(np.broadcast_to(sentence, slot.shape)[heavy], slot[heavy])
        z = self.bias + np.bincount(s, self.weights[f], n)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def noisy_or(p: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return 1 - np.exp(np.bincount(text, np.log1p(-np.minimum(p, 1 - 1e-12)), n))


def fit_blame(
    bags: list[np.ndarray], label: np.ndarray, clean_share: float, rounds: int = 150
) -> Blame:
    """Learn from bags, arrays of sentence number * SLOTS + slot, with a label each."""
    if not len(bags) or not 0 < label.mean() < 1:
        return Blame(np.zeros(SLOTS, np.float32), -6.0)
    words_of = [b % SLOTS for b in bags]
    each = [np.unique(w) for w in words_of]
    held = [
        np.bincount(np.concatenate([w for w, y in zip(each, label, strict=True) if y == k]), minlength=SLOTS)
        for k in (0, 1)
    ]
    n = [int((label == 0).sum()), int((label == 1).sum())]
    both = (held[0] + held[1]) / len(bags)
    error = np.sqrt(both * (1 - both) * (1 / n[0] + 1 / n[1])) + 1e-9
    lead = (held[1] / n[1] - held[0] / n[0]) / error
    needed = np.where(np.arange(SLOTS) < SLOTS // 2, STANDARD_ERRORS, BEGINNING_ERRORS)
    known = (held[0] + held[1] >= LEAST_DOCUMENTS) & (lead >= needed)
    code = np.cumsum(known) - 1
    sentence, feature, text, at = [], [], [], 0
    for i, bag in enumerate(bags):
        own = bag // SLOTS
        n = int(own.max()) + 1 if len(own) else 0
        use = known[bag % SLOTS]
        sentence.append(own[use] + at)
        feature.append(code[(bag % SLOTS)[use]])
        text.append(np.full(n, i))
        at += n
    sentence, feature, text = map(np.concatenate, (sentence, feature, text))
    sentence, feature = sentence.astype(np.int32), feature.astype(np.int32)
    clean = label == 0
    weight = np.where(clean, clean_share / clean.sum(), (1 - clean_share) / (~clean).sum())
    width = int(known.sum())
    per_bag = max(at / len(bags), 1.0)
    w, bias = np.zeros(width), -np.log(per_bag) - 2.0
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for turn in range(1, rounds + 1):
        z = bias + np.bincount(sentence, w[feature], at)
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        whole = noisy_or(p, text, len(bags))
        blame = np.where(clean, 1.0, -(1 - whole) / np.maximum(whole, 1e-6)) * weight
        slope_z = blame[text] * p
        slope = np.empty(width + 1)
        slope[:-1] = np.bincount(feature, slope_z[sentence], width) + 2e-6 * w
        slope[-1] = slope_z.sum()
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        step = 0.1 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-6)
        w, bias = w - step[:-1], bias - step[-1]
        w = np.sign(w) * np.maximum(np.abs(w) - 2e-3, 0)  # most words say nothing
    weights = np.zeros(SLOTS, np.float32)
    weights[known] = w
    return Blame(weights, float(bias))


def learn_toxicity(docs: DataFrame, labels: DataFrame, label: str = "toxic", most: int = MOST_LABELLED) -> Blame:
    """A model fitted on at most ``most`` labelled documents of each class.

    Of rows that repeat a doc_id one is taken, and a doc_id with both labels is left out.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            words, sentence, slot, text = sentences(batch.column(2))
            first = np.searchsorted(text, np.arange(batch.num_rows))
            bags = []
            for r in range(batch.num_rows):
                a, b = words.first[r], words.first[r + 1]
                bags.append(np.unique((sentence[a:b] - first[r]) * SLOTS + slot[:, a:b]).tobytes())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"]
            )

    sample, clean_share = labelled_sample(labels, label, most)
    # At most twice ``most`` rows.
    rows = labelled_texts(docs, sample).mapInArrow(run, "doc_id long, label int, bag binary").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("label", "ascending")])  # they arrive in any order
    bags = [np.frombuffer(b, np.int64) for b in rows["bag"].to_pylist()]
    return fit_blame(bags, rows["label"].to_numpy(), clean_share)


def score_toxicity(docs: DataFrame, model: Blame, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row`` (the columns in ``carry``, or all), score, predicted and the worst sentence.

    ``worst_start`` and ``worst_end`` are its bytes in the UTF-8 text and ``worst_score`` its own
    probability; ``offending`` lists the bytes of every sentence of 0.5 or more. A text without
    words has no sentence, scores 0 and has nulls there; a null text is an empty one.
    """

    def run(batches):
        for batch in slices(batches, "text"):
            n = batch.num_rows
            words, sentence, slot, text = sentences(batch.column(1))
            p = model.sentence_scores(sentence, slot, len(text))
            score = noisy_or(p, text, n)
            begins = np.flatnonzero(np.diff(sentence, prepend=-1))
            start = words.start[begins] - words.offsets[text]
            end = words.end[np.r_[begins[1:], len(words)] - 1] - words.offsets[text] if len(begins) else start
            bounds = np.searchsorted(text, np.arange(n + 1))
            worst, found = [], []
            bad = np.flatnonzero(p >= 0.5)
            cut = np.searchsorted(bad, bounds)
            for r in range(n):
                a, b = bounds[r], bounds[r + 1]
                worst.append(a + int(np.argmax(p[a:b])) if b > a else None)
                found.append([{"start": int(start[i]), "end": int(end[i])} for i in bad[cut[r] : cut[r + 1]]])
            pick = lambda values: [None if i is None else values[i].item() for i in worst]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(score, pa.float64()), pa.array((score >= 0.5).astype(np.int32)),
                    pa.array(pick(start), pa.int64()), pa.array(pick(end), pa.int64()), pa.array(pick(p), pa.float64()),
                    pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                ],
                names=["row", "score", "predicted", "worst_start", "worst_end", "worst_score", "offending"],
            )

    rows = carried(docs, carry)
    shown = (
        "score double, predicted int, worst_start long, worst_end long, worst_score double, "
        "offending array<struct<start:long,end:long>>"
    )
    return rows.mapInArrow(run, with_row(rows, shown))
