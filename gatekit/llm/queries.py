"""The registered queries of the operators: thin, over whole tables.

``queries()`` and ``oracle_sql()`` are added to the driver's lists by ``__spark_entry__``.
"""
from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatekit.llm import alignment, bpe, license_scan, mixing, packing, prefix_trie, quality, setsketch, sharding, substring_dedup, toxicity, vecgraph, warc
from gatekit.llm.common import prepare
from gatekit.session import scratch_dir

SHARDS = 40


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_documents(_table(spark, sf_dir, "documents"))
    lost = F.aggregate("__removed", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", F.col("__removed").alias("removed"), lost.alias("n_removed"), "text")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(_table(spark, sf_dir, "documents"), SHARDS).drop("row_number")


def op6_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), k=3, percent=85)


def op7_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecgraph.vector_links(_table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("__score").alias("score"),
        (F.col("__score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                          pattern=public_tokenizers.PATTERN)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    path = scratch_dir(spark, "warc")
    warc.write(pages, path)
    key = pages.schema["page_id"].dataType
    # responses: what the payload itself says; revisits: headers alone, blocks skipped
    full = warc.read(spark, path).filter(F.col("record_type") == "response").select(
        F.col("page_id").cast(key), F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"), "record_type", F.lit(None).cast(key).alias("refers_to"))
    again = warc.read(spark, path, payload=False).filter(F.col("record_type") == "revisit").select(
        F.col("page_id").cast(key), "payload_bytes", "payload_digest", "record_type",
        F.substring_index("refers_to", ":", -1).cast(key).alias("refers_to"))
    return full.unionByName(again)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(_table(spark, sf_dir, "conversations"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prepared(f: Callable) -> Callable:
    @wraps(f)
    def call(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepare(spark), sf_dir)
    return call


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_packing, op2_quality_rules, op3_license_scan, op4_substring_dedup, op5_sharding, op6_setsketch, op7_vector_graph, op8_toxicity, op9_bpe, op10_warc, op11_prefix_trie, op12_alignment, op13_mixing]
    return {f.__name__: _prepared(f) for f in own}


#: Words of a text as the contracts define them.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_OP2 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, {_WORDS} AS w FROM documents
), base AS (
  SELECT r, doc_id, source, w, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), grams AS (
  SELECT r, i, list_slice(w, i, i + 2) AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM grams QUALIFY count(*) OVER (PARTITION BY r, g) >= 2
), covered AS (
  SELECT r, count(DISTINCT i + k)::BIGINT AS n FROM twice, (VALUES (0), (1), (2)) s(k) GROUP BY r
), m AS (
  SELECT b.r, doc_id, source, n_words, word_chars, n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM base b LEFT JOIN covered c ON b.r = c.r
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [n_words < 50, 100 * n_repeat_words > 50 * n_words, n_symbols > n_words, n_dup_lines * 20 > n_words,
     word_chars > 15 * n_words OR word_chars < 2 * n_words] AS fails
  FROM m
), k AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k
  FROM (SELECT source, unnest(fails) AS failed, unnest(range(5)) AS rule FROM f) GROUP BY source, rule
), prior AS (
  SELECT rule, sum(n) AS N, sum(k) / sum(n) AS m, count(*) AS h, sum(n) - sum(n * n) / sum(n) AS per,
    sum(k * k / n) - sum(k) * sum(k) / sum(n) AS spread,
    (sum(k) - sum(k * k / n)) / greatest(sum(n) - count(*), 1) AS within
  FROM k GROUP BY rule
), weight AS (
  SELECT rule, m, CASE WHEN per > 0 AND (spread - (h - 1) * within) / per > 0
    THEN greatest(m * (1 - m) / ((spread - (h - 1) * within) / per) - 1, 0) ELSE N END AS s FROM prior
), bad AS (
  SELECT source, bool_or((k + m * s) / (n + s) > 0.8) AS host_failed FROM k JOIN weight USING (rule) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT host_failed AS kept
FROM f JOIN bad ON f.source IS NOT DISTINCT FROM bad.source
"""

_OP6 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, list_slice(w, i, i + 2) AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM d WHERE len(w) >= 1)
), n AS (
  SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 85 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), c AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT c.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, c.doc_id = component_id AS kept
FROM c LEFT JOIN n ON n.doc_id = c.doc_id
"""

_OP7 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id <> y.vec_id AND list_cosine_similarity(x.e, y.e) >= 0.9
), n AS (
  SELECT a, count(*)::BIGINT AS n FROM links GROUP BY a
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM reach r LEFT JOIN n ON n.a = r.a GROUP BY r.a
"""

_OP10 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
q AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT q.page_id, payload_bytes, q.payload_digest,
  CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id IS NOT NULL AND page_id <> first_id THEN first_id END AS refers_to
FROM q LEFT JOIN f ON q.payload_digest = f.payload_digest
"""


#: One bit, then one byte, of the CRC-32 of decimal digits.
_BIT = "xor({0} >> 1, CASE WHEN {0} % 2 = 1 THEN 3988292384 ELSE 0 END)"


def _crc32_sql(text: str) -> str:
    steps = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: " + _BIT.format("x") + ")"
    bytes_ = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_}), lambda c, b: {steps}), 4294967295)"


_OP11 = f"""
WITH t AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce("text", '')}} ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (
  SELECT conv_id, own, ({_crc32_sql("CAST(conv_id AS VARCHAR)")} % 6)::BIGINT AS h FROM t
), b AS (
  SELECT h.conv_id, list_concat(coalesce(list_slice(t.own, 1, h), []), coalesce(list_slice(h.own, h + 1, len(h.own)), [])) AS s
  FROM h LEFT JOIN t ON t.conv_id = h.conv_id - h.conv_id % 100
), m AS (
  SELECT conv_id, d, list_slice(s, 1, d) AS p, d = len(s) AS over FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM b)
), n AS (
  SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE over), '')) AS ends_sha256
  FROM m GROUP BY p
), k AS (
  SELECT n.p, count(c.p) AS kids FROM n LEFT JOIN n c ON c.depth = n.depth + 1 AND list_slice(c.p, 1, c.depth - 1) = n.p GROUP BY n.p
), up AS (
  SELECT list_slice(p, 1, e) AS p, sum(CASE WHEN kids = 0 THEN 1 ELSE 0 END) AS leaves,
    sum(CASE WHEN depth = 0 THEN 0 ELSE (n - 1) * length(p[depth].t) END) AS saved
  FROM (SELECT n.p, n.depth, n.n, k.kids, unnest(range(n.depth + 1)) AS e FROM n JOIN k ON k.p = n.p) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, k.kids::BIGINT AS n_children,
  up.leaves::BIGINT AS n_leaves, up.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM n JOIN k ON k.p = n.p JOIN up ON up.p = n.p LEFT JOIN n a ON n.depth > 0 AND a.p = list_slice(n.p, 1, n.depth - 1)
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_quality_rules": _OP2, "op6_setsketch": _OP6, "op7_vector_graph": _OP7, "op10_warc": _OP10, "op11_prefix_trie": _OP11}
