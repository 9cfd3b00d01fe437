"""Exact top-k by exhaustive term-at-a-time accumulation.

A vector's dimensions are terms. A task inverts its block of candidates into postings, the
weights of the block's rows for each term. Query rows are sparse lists of (term, weight); they
are worked off one term after the other, each term scattering its query weight times its postings
into dense arrays of scores. No candidate is skipped. The k best of each block are
selected and the blocks' lists are merged for each query.

Queries are dealt into blocks of a bounded number of rows, which are sent to all tasks one
after the other. So the memory of a task depends on the two block sizes and not on the data.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwatch.session import written_table

QUERY_ROWS = 4096
CANDIDATE_ROWS = 4096
#: Bounds of a score column.
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def scaled(vectors: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """(vec_id, v): each component times ``scale`` as a double, rounded down to a whole double.

    Rows without id, without vector, or with a component that is null or not finite are left out,
    and an empty vector has score 0 with all.
    """
    product = lambda x: x.cast("double") * F.lit(float(scale))
    small = lambda x: F.abs(product(x)) < F.lit(float(1 << 53))
    # From 2^53 on a double is whole.
    part = F.transform(vector_column, lambda x: F.when(small(x), F.floor(F.when(small(x), product(x))).cast("double")).otherwise(product(x)))
    good = F.forall(
        vector_column,
        lambda x: x.isNotNull() & (F.abs(product(x)) < F.lit(math.inf)),
    )
    rows = vectors.where(F.col(id_column).isNotNull() & F.coalesce(good, F.lit(False)))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), part.alias("v"))


def _matrix(column: pa.ListArray, width: int | None = None) -> np.ndarray:
    """Rows of a list column side by side; a shorter one is filled with zeros. Large numbers are Python's."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    values = column.flatten().to_numpy(zero_copy_only=False)
    large = np.abs(values).max(initial=0) >= 1 << 62
    out = np.zeros((len(column), width), object if large else np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    fits = place < width
    values = values[fits]
    out[row[fits], place[fits]] = [int(x) for x in values.tolist()] if large else values.astype(np.int64)
    return out


def scores(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """All inner products, term by term, in dense arrays of scores.

    The narrowest integers that hold every sum are taken; beyond 64 bits they are Python's.
    """
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * max(queries.shape[1], 1)
    kind = np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object
    postings = np.ascontiguousarray(candidates.T).astype(kind)
    weights = queries.astype(kind)
    out = np.zeros((len(queries), len(candidates)), kind)
    scratch = np.empty(len(candidates), kind)
    filled = postings.astype(bool).any(axis=1)
    for q in range(len(weights)):
        total = out[q]
        for term in np.flatnonzero(weights[q].astype(bool) & filled):
            np.multiply(postings[term], weights[q, term], out=scratch)
            total += scratch
    return out


def _best(row: np.ndarray, ids: np.ndarray, own: int, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to smaller ids, without rows of the query's id."""
    others = ids != own
    if len(row) > k:
        least = -(1 << 5000) if row.dtype == object else np.iinfo(row.dtype).min
        row = np.where(others, row, least)
        cut = np.partition(row, len(row) - k)[len(row) - k]
        others &= row >= cut
    at = np.flatnonzero(others)
    if row.dtype == object:
        return np.array(sorted(at.tolist(), key=lambda i: (-row[i], ids[i]))[:k], np.int64)
    return at[np.lexsort((ids[at], -row[at].astype(np.int64)))][:k]


def _beyond(score: int) -> str:
    """A text that sorts like the score, for scores at or beyond the bounds of a long; else empty."""
    if _LEAST < score < _MOST:
        return ""
    digits = str(abs(score))
    if score < 0:
        return f"0{99999 - len(digits):05d}" + "".join(str(9 - int(d)) for d in digits)
    return f"1{len(digits):05d}{digits}"


def _searched(ids: np.ndarray, queries: np.ndarray, k: int):
    def run(batches):
        held, kept = [], 0
        for batch in batches:
            for i in range(0, batch.num_rows, CANDIDATE_ROWS):
                held.append(batch.slice(i, CANDIDATE_ROWS))
                kept += held[-1].num_rows
                if kept >= CANDIDATE_ROWS:
                    yield from found(pa.Table.from_batches(held))
                    held, kept = [], 0
        if held:
            yield from found(pa.Table.from_batches(held))

    def found(table):
        own = table["vec_id"].to_numpy()
        block = _matrix(table["v"].combine_chunks(), queries.shape[1])
        for i in range(0, len(queries), 256):
            part = scores(queries[i : i + 256], block)
            best = [_best(row, own, ids[i + q], k) for q, row in enumerate(part)]
            at = np.concatenate(best)
            q = np.repeat(np.arange(len(best)), [len(b) for b in best])
            score = part[q, at]
            if score.dtype == object:
                shown = [min(max(s, _LEAST), _MOST) for s in score.tolist()]
                order = [_beyond(s) for s in score.tolist()]
            else:
                shown, order = score.astype(np.int64), [""] * len(score)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i + q]), pa.array(own[at]), pa.array(shown, pa.int64()), pa.array(order, pa.string())],
                names=["query_id", "vec_id", "score", "beyond"],
            )

    return run


def exact_top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The k highest inner products of each query: query_id, rank, vec_id, score.

    Queries are the rows whose id is divisible by ``every``, candidates all rows with another id;
    components are ``scale`` * x rounded down. Ties go to the smaller vec_id. Vectors that
    are null or hold null or non-finite components take no part; missing components of shorter
    vectors count as 0. Rows equal in id and vector count once; an id with several vectors is
    searched with each and found with each. Fewer candidates than k give fewer rows. Ranks follow the exact
    products at any size; a score beyond a long is shown as the nearest long. A component whose product with
    ``scale`` is beyond a double, which no float reaches, counts as not finite.
    """
    n_parts = max(1, math.ceil(vectors.count() / CANDIDATE_ROWS))
    rows = scaled(vectors, scale, id_column, vector_column).distinct().repartition(n_parts)
    rows = written_table(rows, "vectors")
    queries = rows.where(F.col("vec_id") % every == 0)
    n_blocks = max(1, math.ceil(queries.count() / query_rows))
    dealt = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)))
    parts = []
    for b in range(n_blocks):
        # About query_rows rows: a block is what every task holds of the queries.
        block = dealt.where(F.col("block") == b).drop("block").toArrow()
        if block.num_rows:
            matrix = _matrix(block["v"].combine_chunks())
            run = _searched(block["vec_id"].to_numpy(), matrix, k)
            parts.append(rows.mapInArrow(run, "query_id long, vec_id long, score long, beyond string"))
    if not parts:
        return rows.limit(0).selectExpr("vec_id AS query_id", "1 AS rank", "vec_id", "vec_id AS score")
    lists = parts[0]
    for part in parts[1:]:
        lists = lists.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("beyond"), "vec_id")
    ranked = lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
