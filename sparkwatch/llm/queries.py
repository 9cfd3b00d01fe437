"""The operators as queries over the given tables, with SQL counterparts where SQL has one."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwatch.llm.alignment import ByteLevel, Pieces, aligned
from sparkwatch.llm.contamination import contamination
from sparkwatch.llm.language import score_language
from sparkwatch.llm.near import near_duplicates
from sparkwatch.llm.packing import packed
from sparkwatch.llm.quality import fold, learn_quality, score_quality
from sparkwatch.llm.sharding import sharded
from sparkwatch.llm.substrings import remove_repeats
from sparkwatch.llm.tokens import token_counts
from sparkwatch.llm.topk import exact_top_k
from sparkwatch.llm.toxicity import learn_toxicity, score_toxicity
from sparkwatch.llm.warc import archived
from sparkwatch.llm.whitening import whitened

#: Vocabulary files of public tokenizers; every worker has them at the same place.
BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _learned(spark: SparkSession, sf: str, parts: int, out: int):
    """Documents, and the labels of the rows whose fold is not ``out``."""
    labels = _table(spark, sf, "labels").where(fold("doc_id", parts) != out)
    return _table(spark, sf, "documents"), labels


def op2_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Quality of every document, learned from the rows that are not held out."""
    docs, labels = _learned(spark, sf, 3, 1)
    scored = score_quality(docs, learn_quality(docs, labels), carry=["doc_id"])
    return scored.select(
        "row.doc_id", (fold("row.doc_id", 3) == 1).alias("held_out"), "score", "predicted"
    )


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document and its worst sentence, learned from rows not held out."""
    docs, labels = _learned(spark, sf, 5, 0)
    scored = score_toxicity(docs, learn_toxicity(docs, labels), carry=["doc_id"])
    return scored.select(
        "row.doc_id", (fold("row.doc_id", 5) == 0).alias("held_out"), "score", "predicted",
        "worst_start", "worst_end", "worst_score",
    )


def op3_contamination(spark: SparkSession, sf: str) -> DataFrame:
    """Benchmark passages in whole documents."""
    docs, items = _table(spark, sf, "documents"), _table(spark, sf, "benchmark")
    return contamination(docs, items, carry=["doc_id"]).select(
        "row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )


def op6_substrings(spark: SparkSession, sf: str) -> DataFrame:
    """Passages of 13 words that a document with a smaller id holds as well."""
    cut = remove_repeats(_table(spark, sf, "documents"), carry=["doc_id"], with_text=False)
    return cut.select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op1_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens of every document under the public vocabulary."""
    counted = token_counts(_table(spark, sf, "documents"), carry=["doc_id"])
    return counted.select("row.doc_id", "n_pretokens", "n_tokens")


def op4_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The 20 best inner products of every twentieth vector."""
    return exact_top_k(_table(spark, sf, "embeddings"))


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    """Pages written to WARC archives and read back."""
    number = lambda c: F.substring(c, len("urn:page:") + 1, 20)
    response = F.col("record_type") == "response"
    return archived(_table(spark, sf, "pages")).select(
        F.expr("try_cast(substring(record_id, 10) AS long)").alias("page_id"),
        F.when(response, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        number("refers_to").cast("long").alias("refers_to"),
    )


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    """Documents in eight shards by jump consistent hashing."""
    return sharded(_table(spark, sf, "documents"), 8)


def op8_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents packed into sequences of 256 to 4096 words."""
    pieces = packed(_table(spark, sf, "documents"), carry=["doc_id"])
    return pieces.select("row.doc_id", "piece", "first_word", "n_words", "bin", "offset", "capacity")


def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Documents linked by a Jaccard similarity of 0.8 on sets of two-word shingles."""
    return near_duplicates(_table(spark, sf, "documents"), shingle=2)


def op11_alignment(
    spark: SparkSession, sf: str, first: str = BYTE_VOCABULARY, second: str = PIECE_VOCABULARY
) -> DataFrame:
    """How the tokens of a byte-level and of a piece vocabulary meet in every document."""
    found = aligned(_table(spark, sf, "documents"), partial(ByteLevel, first), partial(Pieces, second), carry=["doc_id"])
    return found.select(
        "row.doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


def op12_language_model(spark: SparkSession, sf: str) -> DataFrame:
    """Log probability of every document under bigrams of those that are not held out."""
    docs, held_out = _table(spark, sf, "documents"), fold("doc_id", 5) == 1
    return score_language(docs, ~held_out, carry=["doc_id"]).select(
        "row.doc_id", (~F.col("learns")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
        "base_score", "score", "strength",
    )


def op13_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """All embeddings on their eight largest principal components, each with variance 1."""
    found = whitened(_table(spark, sf, "embeddings"))
    # A deviation beyond a long has no place in this column; deviation_exact holds it.
    return found.select(
        "vec_id", "component", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"),
        "whitened", "explained", "identity_error", F.col("deviation").alias("deviation_exact"), "variance",
    )


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 20
"""

OP5_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
),
g AS (
  SELECT page_id, i, CAST('0x' || substr(hex, 5 * i + 1, 5) AS BIGINT) AS bits
  FROM p, (SELECT unnest(generate_series(0, 7)) AS i)
),
d AS (
  SELECT page_id, string_agg(
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((bits >> 15) & 31 AS INTEGER) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((bits >> 10) & 31 AS INTEGER) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((bits >> 5) & 31 AS INTEGER) + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(bits & 31 AS INTEGER) + 1, 1), '' ORDER BY i) AS digest
  FROM g GROUP BY page_id
)
SELECT p.page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN first = p.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> p.page_id THEN first END AS refers_to
FROM p JOIN d USING (page_id)
"""

# DuckDB has no crc32: it is worked out byte by byte from the polynomial.
OP7_SQL = """
WITH RECURSIVE jumps AS (
  SELECT doc_id, n, CAST(doc_id AS HUGEINT) AS key, CAST(0 AS BIGINT) AS shard, CAST(0 AS BIGINT) AS jump
  FROM documents, (SELECT unnest([8, 9]) AS n)
  UNION ALL
  SELECT doc_id, n, key, jump,
         CAST(floor((jump + 1) * (2147483648.0 / CAST((key // 8589934592) + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT doc_id, n, jump,
               (key * 2862933555777941757 + 1) % 18446744073709551616 AS key
        FROM jumps WHERE jump < n)
),
ends AS (SELECT doc_id, n, max(shard) AS shard FROM jumps GROUP BY doc_id, n),
polynomial AS (
  SELECT i, list_reduce(list_concat([CAST(i AS BIGINT)], CAST(generate_series(1, 8) AS BIGINT[])),
    lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
  FROM (SELECT unnest(generate_series(0, 255)) AS i)
),
lookup AS (SELECT list(value ORDER BY i) AS t FROM polynomial),
hexes AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
sums AS (
  SELECT doc_id, n + 1 AS size, xor(list_reduce(
    list_concat([CAST(4294967295 AS BIGINT)],
      list_transform(generate_series(0, n - 1),
        lambda i: CAST((instr('0123456789abcdef', substr(h, CAST(2 * i + 1 AS BIGINT), 1)) - 1) * 16
                + instr('0123456789abcdef', substr(h, CAST(2 * i + 2 AS BIGINT), 1)) - 1 AS BIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1])), CAST(4294967295 AS BIGINT)) AS crc
  FROM hexes, lookup
)
SELECT s.doc_id, CAST(size AS BIGINT) AS size, crc AS text_crc32, 'key' AS law,
       CAST(a.shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY a.shard ORDER BY s.doc_id) - 1 AS slot,
       CAST(b.shard AS INTEGER) AS grown_shard
FROM sums s JOIN ends a ON a.doc_id = s.doc_id AND a.n = 8 JOIN ends b ON b.doc_id = s.doc_id AND b.n = 9
"""

OP3_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
  UNION ALL
  SELECT 'i', CAST(item_id AS VARCHAR),
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
  FROM benchmark
),
items AS (SELECT id, w, least(13, len(w)) AS n FROM w WHERE kind = 'i' AND len(w) > 0),
wins AS (
  SELECT DISTINCT id, n, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT id, n, w, unnest(generate_series(1, len(w) - n + 1)) AS p FROM items)
),
sizes AS (SELECT DISTINCT n FROM wins),
spots AS (
  SELECT id, n, p, array_to_string(w[p:p + n - 1], ' ') AS words
  FROM (SELECT w.id, w.w, sizes.n, unnest(generate_series(1, len(w.w) - sizes.n + 1)) AS p
        FROM w JOIN sizes ON len(w.w) >= sizes.n WHERE kind = 'd')
),
hits AS (
  SELECT s.id AS doc, wins.id AS item, s.p, s.n FROM spots s JOIN wins USING (n, words)
),
covered AS (
  SELECT doc, count(DISTINCT q) AS n_hit
  FROM (SELECT doc, unnest(generate_series(p, p + n - 1)) AS q FROM hits) GROUP BY doc
),
found AS (
  SELECT doc, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names
  FROM hits GROUP BY doc
)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
       coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN covered c ON c.doc = w.id LEFT JOIN found f ON f.doc = w.id
WHERE kind = 'd'
"""

OP6_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
spots AS (
  SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS words
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 12)) AS p FROM w WHERE len(w) >= 13)
),
firsts AS (SELECT words, min(doc_id) AS least FROM spots GROUP BY words),
gone AS (
  SELECT DISTINCT doc_id, unnest(generate_series(p, p + 12)) AS q
  FROM spots JOIN firsts USING (words) WHERE least < doc_id
),
lists AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
places AS (SELECT doc_id, w[p] AS word, p FROM (
  SELECT doc_id, w, unnest(generate_series(1, len(w))) AS p FROM w WHERE len(w) > 0)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text
  FROM places ANTI JOIN gone ON places.doc_id = gone.doc_id AND places.p = gone.q GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words,
       CAST(coalesce(len(lists.qs), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 1, 1))) AS p
        FROM w WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
ranked AS (
  SELECT s.doc_id, s.g, n.n, row_number() OVER (PARTITION BY s.doc_id ORDER BY f.f, s.g) AS r
  FROM s JOIN n USING (doc_id) JOIN (SELECT g, count(*) AS f FROM s GROUP BY g) f USING (g)
),
heads AS (SELECT doc_id, g FROM ranked WHERE r <= n - (4 * n + 4) // 5 + 1),
maybe AS (
  SELECT DISTINCT a.doc_id AS a, b.doc_id AS b
  FROM heads a JOIN heads b ON a.g = b.g AND a.doc_id < b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  WHERE 5 * least(na.n, nb.n) >= 4 * greatest(na.n, nb.n)
),
common AS (
  SELECT a, b, count(*) AS i FROM maybe JOIN s x ON x.doc_id = a
  JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b
),
links AS (
  SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * i >= 80 * (na.n + nb.n - i)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS node, b AS other FROM edges
  UNION
  SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
),
least_of AS (SELECT node, min(other) AS m FROM reach GROUP BY node)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, coalesce(m, w.doc_id)) AS component_id,
       w.doc_id <= coalesce(m, w.doc_id) AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN least_of ON node = w.doc_id
"""

QUERIES = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_quality": (op2_quality, None),
    "op3_contamination": (op3_contamination, OP3_SQL),
    "op4_top_k": (op4_top_k, OP4_SQL),
    "op5_warc": (op5_warc, OP5_SQL),
    "op6_substrings": (op6_substrings, OP6_SQL),
    "op7_sharding": (op7_sharding, OP7_SQL),
    "op8_packing": (op8_packing, None),
    "op9_near_duplicates": (op9_near_duplicates, OP9_SQL),
    "op10_toxicity": (op10_toxicity, None),
    "op11_alignment": (op11_alignment, None),
    "op12_language_model": (op12_language_model, None),
    "op13_whitening": (op13_whitening, None),
}
