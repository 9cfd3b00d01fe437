"""Best-fit packing of documents into sequences of several permitted lengths.

A document longer than the largest sequence is cut into pieces. Pieces are packed from the longest
to the shortest; each goes to the open bin that it leaves with the least room. If none has room,
a bin is opened, and of the permitted lengths that hold the piece the one with the least
cost per token is taken. When all pieces are placed, each bin shrinks to the shortest
permitted length that holds its contents. So small bins are opened only where they are
cheaper, and shrinking returns what large ones did not use.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sparkwatch.llm.text import SPACES, Words, byte_table, carried, slices, with_row

CAPACITIES = (256, 512, 1024, 2048, 4096)
#: Pieces that are packed together; the last bins of each such load may stay open.
LOAD = 1 << 16


def sequence_cost(capacity: int) -> float:
    """Cost of a sequence: a fixed part, its tokens, and attention over pairs of them."""
    return 64 + capacity + capacity * capacity / 16384


def pack(
    lengths: Sequence[int],
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per piece its bin and offset, and per bin its capacity after shrinking.

    No piece may be longer than the largest capacity. Equal lengths go in the given order.
    """
    sizes = sorted(set(capacities))
    # For each smallest size that holds a piece, the size with the least cost per token.
    opened = [min(sizes[i:], key=lambda c: (cost(c) / c, c)) for i in range(len(sizes))]
    lengths = np.asarray(lengths, np.int64)
    bin_of, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    whole: list[int] = []
    rooms: list[int] = []  # distinct amounts of room, ascending
    by_room: dict[int, list[int]] = {}
    for i in np.argsort(-lengths, kind="stable"):
        n = int(lengths[i])
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = by_room[room].pop()
            if not by_room[room]:
                rooms.pop(at)
                del by_room[room]
        else:
            room = opened[bisect.bisect_left(sizes, n)]
            b = len(used)
            used.append(0)
            whole.append(room)
        bin_of[i], offset[i] = b, used[b]
        used[b] += n
        if left := room - n:
            if left not in by_room:
                by_room[left] = []
                bisect.insort(rooms, left)
            by_room[left].append(b)
    shrunk = np.array([sizes[bisect.bisect_left(sizes, u)] for u in used], np.int64)
    return bin_of, offset, shrunk


def packed(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = sequence_cost,
    carry: list[str] | None = None,
    load: int = LOAD,
) -> DataFrame:
    """Pieces of ``docs`` (text) in bins: ``row``, piece, first_word, n_words, bin, offset, capacity.

    Length is counted in words. Each document has one row for each piece of at most the largest
    capacity; a document without words (null, empty, only spaces) has one row with n_words 0 and a
    null bin. ``bin`` is unique over the result, ``offset`` where the piece begins in it.
    Repeated rows are pieces of their own. ``row`` holds the columns in ``carry``, or all.

    Each task packs its own part of the table in loads of ``load`` pieces and holds nothing else,
    so there is no shuffle and no key that could be hot. Bin numbers depend on how
    the table is split.
    """
    longest = max(capacities)

    def run(batches):
        part, filled = TaskContext.get().partitionId(), 0
        waiting, n_waiting = [], 0
        for batch in slices(batches, "text"):
            count = np.diff(Words(batch.column(1), byte_table(SPACES)).first)
            pieces = np.maximum(-(-count // longest), 1)
            source = np.repeat(np.arange(len(count)), pieces)
            number = np.arange(len(source)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            first = number * longest
            size = np.minimum(count[source] - first, longest)
            for i in range(0, len(source), load):
                s = slice(i, i + load)
                if n_waiting and n_waiting + len(source[s]) > load:
                    done, filled = finished(waiting, part, filled)
                    yield from done
                    waiting, n_waiting = [], 0
                waiting.append((batch.column(0).take(pa.array(source[s])), number[s], first[s], size[s]))
                n_waiting += len(source[s])
        if waiting:
            yield from finished(waiting, part, filled)[0]

    def finished(waiting, part, filled):
        size = np.concatenate([w[3] for w in waiting])
        real = np.flatnonzero(size > 0)
        bin_of, offset, shrunk = pack(size[real], capacities, cost)
        name, place, held = (np.full(len(size), -1, np.int64) for _ in range(3))
        name[real] = bin_of + filled + (part << 33)
        place[real] = offset
        held[real] = shrunk[bin_of] if len(real) else 0
        out, at = [], 0
        for row, number, first, n in waiting:
            s = slice(at, at + len(n))
            none = n == 0
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        row, pa.array(number), pa.array(first), pa.array(n),
                        pa.array(name[s], mask=none), pa.array(place[s], mask=none), pa.array(held[s], mask=none),
                    ],
                    names=["row", "piece", "first_word", "n_words", "bin", "offset", "capacity"],
                )
            )
            at += len(n)
        return out, filled + len(shrunk)

    rows = carried(docs, carry)
    shown = "piece long, first_word long, n_words long, bin long, offset long, capacity long"
    return rows.mapInArrow(run, with_row(rows, shown))
