"""The queries op1 to op10 and pipeline over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import bpe, decontam, exact, langid, ngramlm, prefixtree, quality, ranked, recount, rules, sharding, simhash, urls
from sluice.llm.common import id_remainder
from sluice.shared import scratch

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out(scored: DataFrame, n: int, remainder: int) -> DataFrame:
    return scored.withColumn("held_out", id_remainder("doc_id", n) == remainder)


def op1_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit(docs.where(id_remainder("doc_id", 5) != 0), _table(spark, sf_dir, "labels"))
    return _held_out(quality.score(docs, model), 5, 0).select("doc_id", "held_out", "score", "predicted")


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs.where(id_remainder("doc_id", 3) != 1))
    return _held_out(langid.predict(docs, model), 3, 1).select("doc_id", "held_out", "lang_pred", "score")


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(_table(spark, sf_dir, "documents"))


def op4_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramlm.score(_table(spark, sf_dir, "documents"), "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % 7 <> 2")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees of all texts, edited twice: personal data is redacted, then repeated lines are dropped."""
    return recount.counts(recount.edited(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), (recount.personal, recount.repeated_lines)))


def op7_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.cluster(_table(spark, sf_dir, "documents"))


def op10_histogram_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream that is drained, then what its log says of each."""
    at = scratch(spark)
    exact.dedup(exact.documents_stream(spark, sf_dir), f"{at}/log", f"{at}/progress", available_now=True).awaitTermination()
    return exact.classes(spark, f"{at}/log").withColumnRenamed("digest", "text_sha256")


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), 50)


def op13_prefix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    lead = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6
    return prefixtree.tree(_table(spark, sf_dir, "conversations"), lead, F.col("conv_id") - F.col("conv_id") % 100)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_quality_gam": op1_quality_gam, "op2_byte_bpe": op2_byte_bpe, "op3_language_id": op3_language_id, "op4_ngram_trie": op4_ngram_trie, "op5_decontamination": op5_decontamination, "op6_edit_counts": op6_edit_counts, "op7_url_ratio": op7_url_ratio, "op8_simhash": op8_simhash, "op9_quality_rules": op9_quality_rules, "op10_histogram_shards": op10_histogram_shards, "op11_stream_dedup": op11_stream_dedup, "op12_ranked_search": op12_ranked_search, "op13_prefix_tree": op13_prefix_tree}


_WORDS5 = "coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"
_OP5 = f"""WITH d AS (SELECT doc_id, {_WORDS5} AS w FROM documents), b AS (SELECT item_id, {_WORDS5} AS w FROM benchmark),
 win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)),
 dw AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)),
 hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN win USING (n, s)),
 pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
 it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY 1)
 SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)"""


def _op9() -> str:
    repeats = ", ".join(
        f"""r{n} AS (SELECT doc_id, count(*) AS n_words, sum(length(w[p])) AS chars FROM (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS p FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c
 FROM (SELECT doc_id, i, array_to_string(w[i:i + {n - 1}], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM d WHERE len(w) >= {n}))) WHERE c > 1) JOIN d USING (doc_id) GROUP BY 1)"""
        for n in rules.COVERAGE
    )
    columns = ", ".join(f"CAST(coalesce(r{n}.chars, 0) AS BIGINT) AS repeat_chars_{n}" for n in rules.COVERAGE)
    joins = " ".join(f"LEFT JOIN r{n} USING (doc_id)" for n in rules.COVERAGE)
    broken = " ".join(f"WHEN repeat_chars_{n} > {most}::DOUBLE * word_chars THEN 'repeat_{n}'" for n, most in rules.COVERAGE.items())
    return rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents), {repeats},
 l AS (SELECT doc_id, count(*) AS n_lines, count(*) FILTER (rn > 1) AS n_dup_lines, coalesce(sum(chars) FILTER (rn > 1), 0) AS dup_line_chars FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id, line) AS rn, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
 FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) GROUP BY 1),
 m AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
 coalesce(r5.n_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, CAST(coalesce(dup_line_chars, 0) AS BIGINT) AS dup_line_chars, {columns} FROM d LEFT JOIN l USING (doc_id) {joins}),
 v AS (SELECT *, n_words < {rules.LEAST_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
 x AS (SELECT *, CASE WHEN base_failed THEN 'base' {broken} WHEN n_dup_lines > {rules.LINES}::DOUBLE * n_lines THEN 'dup_lines' WHEN dup_line_chars > {rules.LINE_CHARS}::DOUBLE * word_chars THEN 'dup_line_chars' WHEN n_symbols > {rules.SYMBOLS}::DOUBLE * n_words THEN 'symbols' END AS broken FROM v)
 SELECT *, broken IS NULL AS kept FROM x"""


_OP11 = """WITH g AS (SELECT coalesce(text, '') AS t, max(doc_id) AS keep_id, count(*) AS group_size FROM documents GROUP BY 1)
 SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM documents JOIN g ON coalesce(text, '') = t"""


_TERMS = "unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term"
_OP12 = f"""WITH d AS (SELECT doc_id, {_TERMS} FROM documents), q AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, {_TERMS} FROM benchmark)),
 tf AS (SELECT doc_id, term, count(*) AS tf FROM d WHERE term IN (SELECT term FROM q) GROUP BY 1, 2), len AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1), s AS (SELECT count(*)::BIGINT AS nd, sum(n)::BIGINT AS l FROM len),
 w AS (SELECT term, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM tf, s GROUP BY term, nd), m AS (SELECT doc_id, 50 + (50 * n * nd) // l AS m FROM len, s),
 x AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY 1, 2)
 SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM x WHERE score > 0) WHERE rank <= 50"""


_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]), lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))))"
_OP13 = f"""WITH t AS (SELECT conv_id, h, n, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, h) AS pos FROM (SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS h, length(coalesce(text, '')) AS n FROM conversations)),
 c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC} % 6 AS lead FROM (SELECT DISTINCT conv_id FROM t)),
 r AS (SELECT c.conv_id, t.pos, 0 AS own, t.h, t.n FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.lead UNION ALL SELECT c.conv_id, t.pos, 1, t.h, t.n FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.lead),
 p AS (SELECT conv_id, n, row_number() OVER w AS depth, array_to_string(list(h) OVER w, '') AS key FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY own, pos) UNION ALL SELECT conv_id, 0, 0, '' FROM c),
 nd AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n) AS n FROM p GROUP BY 1, 2), l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY 1),
 e AS (SELECT key, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM p JOIN l USING (conv_id, depth) GROUP BY 1),
 k AS (SELECT a.key, count(b.key) AS n_children, any_value(a.n_convs) AS n_convs, any_value(a.n) AS n FROM nd a LEFT JOIN nd b ON b.depth = a.depth + 1 AND left(b.key, length(a.key)) = a.key GROUP BY 1),
 s AS (SELECT a.key, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum((k.n_convs - 1) * k.n) AS BIGINT) AS saved_tokens FROM nd a JOIN k ON left(k.key, length(a.key)) = a.key GROUP BY 1)
 SELECT nd.conv_id, nd.depth, up.conv_id AS parent_conv_id, nd.n_convs, n_children, n_leaves, saved_tokens, coalesce(ends, sha256('')) AS ends_sha256 FROM nd JOIN k USING (key) JOIN s USING (key) LEFT JOIN e USING (key) LEFT JOIN nd up ON nd.depth > 0 AND up.key = left(nd.key, (nd.depth - 1) * 64)"""


def oracle_sql() -> dict[str, str]:
    """SQL expresses the counts of words and windows; the other queries are held against brute force in tests."""
    return {"op5_decontamination": _OP5, "op9_quality_rules": _op9(), "op11_stream_dedup": _OP11, "op12_ranked_search": _OP12, "op13_prefix_tree": _OP13}
