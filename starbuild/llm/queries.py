"""The operators as registered queries, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.llm import (
    content_sort,
    cotraining,
    dual_tree,
    mixing,
    outliers,
    packing,
    pseudonyms,
    sharding,
    simhash,
    suffix_repeats,
    tag_paths,
    token_counts,
    whitening,
)

TOKENIZER = "word_bpe_49k.json"
BYTE_TOKENIZER = "byte_bpe_50k.json"
#: Of the registered query alone, whose tables are invented; no secret.
PUBLIC_KEY = b"pseudonym key, replace it"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hex_print(fp) -> F.Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    scored = outliers.score(_table(spark, folder, "documents"))
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance"]
    return scored.select(*names)


def op2_simhash_vantage_point(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, folder, "documents"))
    return found.select(F.col("id").alias("doc_id"), hex_print("fp").alias("fingerprint"), F.col("component").alias("component_id"))


def op3_label_propagation(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.balanced_shards(_table(spark, folder, "documents"))
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_interval_tree(spark: SparkSession, folder: str) -> DataFrame:
    removed = suffix_repeats.remove_repeats(_table(spark, folder, "documents"))
    spans = (F.size("spans") / 2).cast("long").alias("n_spans")
    return removed.select("doc_id", "n_bytes", "n_removed", spans, "kept_sha256")


def op5_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    return pseudonyms.pseudonymise(_table(spark, folder, "documents"), PUBLIC_KEY).select("row.doc_id", "text", "n_replaced")


def op6_tag_path_ratios(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url", "html")
    return tag_paths.extract(pages).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"), tokenizer_path())


def op8_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    scored = cotraining.score(_table(spark, folder, "documents"), _table(spark, folder, "labels"))
    return scored.withColumnRenamed("id", "doc_id")


def op9_poisson_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    drawn = ["rate", "copies", "copy", "place"]
    # a column of the table that is named like one of these gives way to it
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c.lower() not in drawn]
    return mixing.replicate(docs).select(*kept, *drawn)


def op10_content_sort(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return content_sort.content_sort(docs).select("row.doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op11_bit_sliced_whitening(spark: SparkSession, folder: str) -> DataFrame:
    whitened = whitening.whiten(_table(spark, folder, "embeddings"))
    deviation = F.expr("try_cast(deviation AS bigint)").alias("deviation")
    return whitened.select(F.col("id").alias("vec_id"), "component", "n", deviation, "whitened", "explained", "identity_error")


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, folder, "documents"), tokenizer_path(BYTE_TOKENIZER))
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def op13_dual_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return dual_tree.search(_table(spark, folder, "benchmark"), _table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_robust_outliers,
        op2_simhash_vantage_point,
        op3_label_propagation,
        op4_interval_tree,
        op5_feistel_pseudonyms,
        op6_tag_path_ratios,
        op7_harmonic_packing,
        op8_cotraining,
        op9_poisson_mixing,
        op10_content_sort,
        op11_bit_sliced_whitening,
        op12_token_counts,
        op13_dual_tree_search,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

ORACLE: dict[str, str] = {
    "op13_dual_tree_search": f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_TERMS}') AS terms FROM documents
), sized AS (
  SELECT r, doc_id, len(terms) AS n, sum(len(terms)) OVER ()::BIGINT AS l, count(*) OVER () AS docs
  FROM d WHERE len(terms) > 0
), tf AS (
  SELECT r, term, count(*) AS tf FROM d, unnest(terms) AS t(term) GROUP BY r, term
), w AS (
  SELECT term, floor(1000 * ln((2 * (SELECT max(docs) FROM sized) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM tf GROUP BY term
), items AS (
  SELECT DISTINCT item_id, term FROM benchmark, unnest(regexp_extract_all({_LOWER}, '{_TERMS}')) AS t(term)
), scored AS (
  SELECT i.item_id, s.r, s.doc_id,
         sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * (50 + (50 * s.n * s.docs) // s.l))))::BIGINT AS score
  FROM items i JOIN w USING (term) JOIN tf f USING (term) JOIN sized s USING (r) GROUP BY i.item_id, s.r, s.doc_id
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0
) WHERE rank <= 50""",
    "op10_content_sort": f"""
WITH t AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM t""",
    "op9_poisson_mixing": """
WITH sized AS (
  SELECT source, sum(octet_length(encode(coalesce(text, ''))) + 1)::DOUBLE AS size FROM documents GROUP BY source
), rated AS (
  SELECT source, round(sqrt(size) / (SELECT sum(sqrt(size)) FROM sized) * (SELECT sum(size) FROM sized) / size, 9) AS rate
  FROM sized
), parted AS (
  SELECT source, rate, ceil(rate / 16.0)::BIGINT AS parts, rate / ceil(rate / 16.0) AS mean FROM rated
), terms AS (
  SELECT source, k, exp(k * ln(mean) - mean - CASE WHEN k < 2 THEN 0 ELSE lgamma(k + 1) END) AS term
  FROM parted, range(80) AS r(k)
), cumulated AS (
  SELECT source, k, round(sum(term) OVER (PARTITION BY source ORDER BY k), 12) AS c FROM terms
), drawn AS (
  SELECT d.doc_id, d.source, p.rate, p.parts,
         (('0x' || substr(md5('mix-1:' || d.doc_id || ':' || part), 1, 13))::BIGINT)::DOUBLE / 4503599627370496 AS u
  FROM documents d JOIN parted p USING (source), unnest(range(1, p.parts + 1)) AS x(part)
), counted AS (
  SELECT w.doc_id, w.rate, count(c.k) AS copies
  FROM drawn w JOIN cumulated c ON c.source = w.source AND c.c < w.u GROUP BY w.doc_id, w.rate
)
SELECT d.*, n.rate, n.copies, copy, md5('mix-1:place:' || d.doc_id || ':' || copy) AS place
FROM counted n JOIN documents d USING (doc_id), unnest(range(n.copies)) AS y(copy)""",
}
