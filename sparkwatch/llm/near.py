"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set holds the hashes of its distinct word shingles. Its sketch has a fixed
number of coordinates, one per bin. In each round every element of the set is hashed to one
bin; the smallest value of the earliest round stays in a bin. Rounds beyond the number of
bins put every element into one given bin, so a sketch is always full after twice as many
rounds as it has bins. Most sets need few rounds, and the number of coordinates that two
sketches share is concentrated around the Jaccard similarity as tightly as for
independent hashing.

Coordinates are grouped into bands. Documents that agree in a band meet in its bucket and
links are confirmed on the full sets:

1. Documents with equal sets form one class, represented by the smallest id.
2. Every representative in a bucket is compared with the smallest one of the bucket.
3. In a bucket whose members are still in different components, those outside its largest
   component are compared with all others, block by block, and only links become rows.

A bucket with thousands of copies therefore costs one comparison for each copy that is near
the first one and not one for each pair. No comparison that could join two components is left out, so the components
are those of all links that the bands find. With the default bands a pair at the
threshold is missed with a probability of 1.2e-6.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwatch.llm.components import components
from sparkwatch.llm.text import (
    SPACES,
    Words,
    bounded_batches,
    byte_table,
    lower_table,
    mix,
    rolling,
    slices,
)
from sparkwatch.session import written_table

_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_STEP = 0x9E3779B97F4A7C15
#: Documents of a block when members of one bucket are compared.
_BLOCK = 256
SKETCH_SCHEMA = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def shingle_sets(column, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers and hashes of the distinct shingles of each text, sorted, and row bounds.

    A text of fewer words than ``size`` has one shingle, its whole word sequence.
    """
    words = Words(column, byte_table(SPACES), lower_table())
    hashes = words.hashes()
    n_rows = len(words.offsets) - 1
    count = np.diff(words.first)
    n = max(len(hashes) - size + 1, 0)
    inside = words.text[:n] == words.text[size - 1 :][:n]
    owner = [words.text[:n][inside]]
    values = [rolling(hashes, size)[inside]]
    short = count[(count > 0) & (count < size)]
    for length in np.unique(short):
        rows = np.flatnonzero(count == length)
        owner.append(rows)
        values.append(mix(rolling(hashes, int(length))[words.first[rows]] ^ np.uint64(length)))
    owner, values = np.concatenate(owner), np.concatenate(values)
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    owner, values = owner[new], values[new]
    return owner, values, np.searchsorted(owner, np.arange(n_rows + 1))


def sketches(owner: np.ndarray, values: np.ndarray, n_rows: int, size: int) -> np.ndarray:
    """A sketch of ``size`` coordinates for each of the sets; ``owner`` is the set of a value."""
    out = np.full(n_rows * size, _EMPTY)
    for turn in range(2 * size):
        if not len(owner):
            break
        hashed = mix(values + np.uint64((turn + 1) * _STEP & (2**64 - 1)))
        if turn < size:
            place = ((hashed >> np.uint64(40)) % np.uint64(size)).astype(np.int64)
        else:
            place = np.full(len(hashed), turn - size)
        ranked = (hashed & np.uint64((1 << 40) - 1)) | np.uint64(turn << 40)
        np.minimum.at(out, owner * size + place, ranked)
        left = (out.reshape(n_rows, size) == _EMPTY).any(axis=1)[owner]
        owner, values = owner[left], values[left]
    return out.reshape(n_rows, size)


def _bands(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = sketch.reshape(len(sketch), bands, rows)
    key = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2])
    for r in range(rows):
        key = mix(key * np.uint64(31) + parts[:, :, r])
    return key.view(np.int64)


def document_sketches(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per row of ``docs``: set size, a 128-bit hash of the set, and its band keys."""

    def run(batches):
        for batch in slices(batches, "text"):
            n = batch.num_rows
            owner, values, bounds = shingle_sets(batch.column(1), shingle)
            size = np.diff(bounds)
            total = np.zeros((2, len(values) + 1), np.uint64)
            np.cumsum(mix(values), out=total[0, 1:])
            np.cumsum(mix(values ^ np.uint64(_STEP)), out=total[1, 1:])
            sums = total[:, bounds[1:]] - total[:, bounds[:-1]]
            keys = _bands(sketches(owner, values, n, bands * rows), bands, rows)
            keys = keys[size > 0]
            offsets = np.r_[0, np.cumsum(np.where(size > 0, bands, 0))].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size.astype(np.int64)),
                    pa.array(sums[0].view(np.int64)),
                    pa.array(sums[1].view(np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys.ravel())),
                ],
                names=["doc_id", "n_shingles", "set_a", "set_b", "bands"],
            )

    wanted = bounded_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return wanted.mapInArrow(run, SKETCH_SCHEMA)


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have a Jaccard similarity of ``percent`` / 100 or more."""

    def run(batches):
        for batch in slices(batches, "text_b"):
            sets = {}
            for name in ("text_a", "text_b"):
                column = batch.column(batch.schema.get_field_index(name))
                codes = pc.dictionary_encode(column.cast(pa.large_string()))
                _, values, bounds = shingle_sets(codes.dictionary, shingle)
                sets[name] = codes.indices.to_numpy(zero_copy_only=False), values, bounds
            keep = np.zeros(batch.num_rows, bool)
            (row_a, all_a, cut_a), (row_b, all_b, cut_b) = sets["text_a"], sets["text_b"]
            for i, (x, y) in enumerate(zip(row_a, row_b, strict=True)):
                one, two = all_a[cut_a[x] : cut_a[x + 1]], all_b[cut_b[y] : cut_b[y + 1]]
                at = np.searchsorted(one, two)
                both = int((one[np.minimum(at, len(one) - 1)] == two).sum()) if len(one) else 0
                keep[i] = both > 0 and 100 * both >= percent * (len(one) + len(two) - both)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    found = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    found = found.join(
        texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"
    )
    return found.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long").distinct()


def _whole_groups(batches, key: list[str], most_bytes: int):
    """Tables of whole groups; rows arrive sorted by ``key`` and groups are small."""
    held, size = [], 0
    for batch in slices(batches, "text", most_bytes):
        held.append(batch)
        size += batch.nbytes
        if size >= most_bytes:
            table = pa.Table.from_batches(held)
            last = _group_starts(table, key)[-1]
            if last:
                yield table.slice(0, last)
            held = table.slice(last).to_batches()
            size = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def _group_starts(table: pa.Table, key: list[str]) -> np.ndarray:
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in key:
        values = table[name].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _between(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) of members outside their bucket's largest component with the others.

    Both sides are cut into blocks of about _BLOCK documents and a task compares one block
    with another, so a bucket of any size is spread over tasks and only links are rows.
    """
    key = ["bucket", "i", "j"]
    minor = F.col("component") != F.col("main")
    sizes = members.groupBy("bucket").agg(
        F.ceil(F.count("*") / _BLOCK).alias("blocks"), F.ceil(F.count_if(minor) / _BLOCK).alias("minors")
    )
    sized = members.join(sizes, "bucket")
    place = lambda n, salt: F.pmod(F.xxhash64("doc", F.lit(salt)), F.col(n))
    turns = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    sides = sized.select(
        "bucket", place("blocks", 0).alias("i"), turns("minors").alias("j"), F.lit(False).alias("minor"),
        "doc", "component",
    ).unionByName(
        sized.where(minor).select(
            "bucket", turns("blocks").alias("i"), place("minors", 1).alias("j"), F.lit(True).alias("minor"),
            "doc", "component",
        )
    )

    def run(batches):
        for table in _whole_groups(batches, key, 1 << 20):
            codes = pc.dictionary_encode(table["text"].combine_chunks().cast(pa.large_string()))
            owner, values, bounds = shingle_sets(codes.dictionary, shingle)
            code = codes.indices.to_numpy()
            n = np.diff(bounds)
            doc, component = table["doc"].to_numpy(), table["component"].to_numpy()
            is_minor = table["minor"].to_numpy()
            found = set()
            starts = _group_starts(table, key)
            for x, y in zip(starts, np.r_[starts[1:], len(doc)], strict=True):
                rows = np.arange(x, y)
                ours, others = rows[is_minor[x:y]], rows[~is_minor[x:y]]
                if not len(ours) or not len(others):
                    continue
                size = n[code[others]]
                at = np.repeat(bounds[code[others]] - np.cumsum(size) + size, size) + np.arange(size.sum())
                whose = np.repeat(np.arange(len(others)), size)
                theirs = values[at]
                for row in ours:
                    own = values[bounds[code[row]] : bounds[code[row] + 1]]
                    hit = own[np.minimum(np.searchsorted(own, theirs), len(own) - 1)] == theirs
                    both = np.bincount(whose[hit], minlength=len(others))
                    near = 100 * both >= percent * (len(own) + size - both)
                    near &= component[others] != component[row]
                    for other in others[near]:
                        found.add((min(doc[row], doc[other]), max(doc[row], doc[other])))
            pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    wide = sides.join(texts.select(F.col("doc_id").alias("doc"), "text"), "doc")
    dealt = wide.select(*key, "minor", "doc", "component", "text").repartition(*key)
    return dealt.sortWithinPartitions(*key).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    percent: int = 80,
    bands: int = 45,
    rows: int = 6,
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links reach, ``kept`` is true where that is
    the document's own. Columns other than doc_id and text are not read. A null or empty
    text has an empty set and no link; a null doc_id has no link, a null component and is
    kept. Equal texts are linked whatever their order; rows that repeat a doc_id are
    one document in links and give a row each.

    ``docs`` should be a stored table: it is read twice.
    """
    sketched = written_table(document_sketches(docs, shingle, bands, rows), "sketches")
    real = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    same = ["n_shingles", "set_a", "set_b"]
    classes = real.groupBy(same).agg(F.min("doc_id").alias("rep"))
    classes = written_table(classes, "classes")
    reps = real.join(
        classes.withColumnRenamed("rep", "doc_id"), [*same, "doc_id"], "left_semi"
    )
    banded = reps.select(
        F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"), "n_shingles"
    )
    hubs = banded.groupBy("bucket").agg(F.min("doc").alias("hub"), F.max("doc").alias("last"))
    met = written_table(
        banded.join(hubs.where("hub < last").drop("last"), "bucket"), "buckets"
    )
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    texts = written_table(
        texts.join(met.select(F.col("doc").alias("doc_id")).distinct(), "doc_id", "left_semi"),
        "texts",
    )
    longer = F.greatest("n_a", "n_b") * percent <= F.least("n_a", "n_b") * 100
    sizes = met.where("doc = hub").select("bucket", F.col("n_shingles").alias("n_a"))
    stars = (
        met.where("doc <> hub")
        .withColumnRenamed("n_shingles", "n_b")
        .join(sizes.distinct(), "bucket")
        .where(longer)
        .select(F.col("hub").alias("a"), F.col("doc").alias("b"))
        .distinct()
    )
    stars = written_table(stars, "stars")
    links = written_table(confirmed(stars, texts, shingle, percent), "links")
    grouped = components(links)

    # What is left: members of a bucket outside its largest component, against the others.
    members = met.join(
        grouped.select(F.col("node").alias("doc"), "component"), "doc", "left"
    ).select("bucket", "doc", "n_shingles", F.coalesce("component", "doc").alias("component"))
    parts = members.groupBy("bucket", "component").agg(F.count("*").alias("n"))
    largest = parts.groupBy("bucket").agg(
        F.count("*").alias("parts"), F.max(F.struct("n", "component")).alias("top")
    )
    mixed = largest.where("parts > 1").select("bucket", F.col("top.component").alias("main"))
    members = written_table(members.join(mixed, "bucket"), "mixed")
    more = _between(members, texts, shingle, percent)
    joined = grouped.select(F.col("component").alias("a"), F.col("node").alias("b")).unionByName(more)
    final = components(joined)

    named = sketched.drop("bands").join(classes, same, "left").join(
        final.withColumnRenamed("node", "rep"), "rep", "left"
    )
    component = F.when(
        F.col("n_shingles") > 0, F.coalesce("component", "rep")
    ).otherwise(F.col("doc_id"))
    return named.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
