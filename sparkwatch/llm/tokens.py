"""Token counts under a unigram vocabulary, by dynamic programming shared in a trie.

The best segmentation of a word under a unigram model follows from the forward scores of its
prefixes: the best score that ends after i characters is the best over the pieces that end there
of the score before the piece plus the piece's own. Words with a common prefix have the same
forward scores along it, so a task inserts its distinct pre-tokens in a trie, computes the
scores once for each node, and stores at the last node of a word the count of its pieces.

The vocabulary is a public one and is not trained here. It is ordered by rank; the log
probability of a piece follows Zipf's law over the ranks. A character that is in no piece falls
back to one token for each of its UTF-8 bytes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sparkwatch.llm.text import SPACES, Words, byte_table, carried, slices, with_row

#: A public vocabulary of 32,000 pieces; another one may be given.
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"  # stands for the white space before a word
#: Nodes and words kept by a task; beyond them it starts anew, with the same results.
MOST_NODES = 1_000_000
#: Longer pre-tokens are counted by the same recursion outside the trie.
LONGEST = 128


@dataclass(frozen=True)
class Unigram:
    """Log probabilities of pieces, the longest piece's length and the penalty of a byte."""

    scores: dict[str, float]
    longest: int
    byte_score: float

    def step(self, text: str, end: int, best: list[float], count: list[int], base: int = 0) -> tuple[float, int]:
        """The best score and its count of pieces at ``end``; lists begin at character ``base``."""
        size = len(text[end - 1].encode("utf-8", "surrogatepass"))
        top, pieces = best[end - 1 - base] + size * self.byte_score, count[end - 1 - base] + size
        for start in range(max(base, end - self.longest), end):
            score = self.scores.get(text[start:end])
            if score is not None:
                value, n = best[start - base] + score, count[start - base] + 1
                if value > top or (value == top and n < pieces):
                    top, pieces = value, n
        return top, pieces

    def count(self, text: str) -> int:
        """The pieces of one pre-token, with memory for the longest piece alone."""
        best, count, base = [0.0], [0], 0
        for end in range(1, len(text) + 1):
            top, pieces = self.step(text, end, best, count, base)
            best.append(top)
            count.append(pieces)
            if len(best) > 2 * self.longest + 2:
                cut = len(best) - self.longest - 1
                best, count, base = best[cut:], count[cut:], base + cut
        return count[-1]


def load_unigram(path: str = VOCABULARY) -> Unigram:
    """Read the pieces of a sentencepiece model in the order of their ids."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (r + 1) for r in range(len(pieces))))
    scores = {p: -math.log(r + 1) - total for r, p in enumerate(pieces)}
    return Unigram(scores, max(map(len, scores)), -2 * math.log(len(pieces) + 1) - total)


@dataclass
class Trie:
    """Forward scores of all prefixes seen so far; node 0 is the root."""

    model: Unigram
    child: dict[tuple[int, str], int] = field(default_factory=dict)
    best: list[float] = field(default_factory=lambda: [0.0])
    pieces: list[int] = field(default_factory=lambda: [0])

    def count(self, text: str) -> int:
        """Insert a pre-token and return the count at its last node."""
        if len(text) > LONGEST:
            return self.model.count(text)
        if len(self.best) > MOST_NODES:
            self.child, self.best, self.pieces = {}, [0.0], [0]
        node, child, path = 0, self.child, [0]
        for end, letter in enumerate(text, 1):
            known = child.get((node, letter))
            if known is None:
                best = [self.best[p] for p in path]
                count = [self.pieces[p] for p in path]
                for last in range(end, len(text) + 1):  # the rest of the path is new too
                    top, pieces = self.model.step(text, last, best, count)
                    best.append(top)
                    count.append(pieces)
                    fresh = len(self.best)
                    child[(node, text[last - 1])] = fresh
                    self.best.append(top)
                    self.pieces.append(pieces)
                    node = fresh
                break
            node = known
            path.append(node)
        return self.pieces[node]


def token_counts(docs: DataFrame, model: Unigram | None = None, carry: list[str] | None = None) -> DataFrame:
    """Per row of ``docs``: ``row`` (the columns in ``carry``, or all), n_pretokens, n_tokens.

    Pre-tokens are the words between white space, each with a mark for the space before it; white
    space is not counted apart. A null or empty text has none. Only text is read.
    """
    model = load_unigram() if model is None else model

    def run(batches):
        trie, known = Trie(model), {}
        for batch in slices(batches, "text"):
            words = Words(batch.column(1), byte_table(SPACES))
            distinct, first, place = np.unique(words.hashes(), return_index=True, return_inverse=True)
            if len(known) > MOST_NODES:
                known = {}
            counts = np.empty(len(distinct), np.int64)
            for i, key in enumerate(distinct.tolist()):
                n = known.get(key)
                if n is None:
                    n = known[key] = trie.count(MARK + words.word(first[i]).decode("utf-8", "replace"))
                counts[i] = n
            total = np.bincount(words.text, counts[place], batch.num_rows).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(words.first)), pa.array(total)],
                names=["row", "n_pretokens", "n_tokens"],
            )

    rows = carried(docs, carry)
    return rows.mapInArrow(run, with_row(rows, "n_pretokens long, n_tokens long"))
