"""Registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .conversation_repair import damage, repair_conversations
from .fingerprints import containment, digest, edited_fingerprints
from ..sources.staged import shared_folder
from .hard_negatives import hard_negatives
from .huffman import read_store, write_store
from .license_scan import license_scan
from .line_crf import LineField, held_out, score, train
from .packing import pack_documents
from .piece_sampling import sample_pieces
from .quality_rules import COUNTS, RULES, STOP_WORDS, SYMBOLS, quality_rules
from .simhash import near_duplicates
from .suffix_dedup import remove_repeats
from .token_counts import token_counts
from .warc import derivatives, responses
from .words import SPACES

Query = Callable[[SparkSession, str], DataFrame]

# Documents that score less are judged to be of low quality.
QUALITY = 0.3

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, where SQL can express it, its counterpart."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _rule_sql(rule) -> str:
    top = f"{rule.numerator}::DOUBLE"
    base = f"{rule.denominator}::DOUBLE" if rule.denominator else "1.0"
    tests = []
    if rule.low is not None:
        tests.append(f"{top} < {base} * {float(rule.low)}")
    if rule.high is not None:
        tests.append(f"{top} > {base} * {float(rule.high)}")
    return f"(n_words >= {rule.min_words} AND ({' OR '.join(tests)}))"


_STOPS = ", ".join(f"'{w}'" for w in STOP_WORDS)
RULES_SQL = f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body,
         list_filter(string_split_regex(coalesce(text, ''), '[{SPACES}]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^{SPACES}]')) AS l
  FROM documents),
placed AS (
  SELECT doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] AS k
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM texts)),
again AS (
  SELECT doc_id, i FROM placed QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + o) AS n
  FROM again, (SELECT unnest([0, 1, 2, 3, 4]) AS o) GROUP BY doc_id),
counted AS (
  SELECT t.doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(body) - length(regexp_replace(body, '[{SYMBOLS}]', '', 'g')))::BIGINT AS n_symbols,
         (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines,
         len(list_filter(w, lambda x: lower(x) IN ({_STOPS})))::BIGINT AS n_stop_words,
         len(list_filter(l, lambda x: regexp_matches(x, '(\\.\\.\\.|…)\\s*$')))::BIGINT
           AS n_ellipsis_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '^\\s*[•*-]\\s')))::BIGINT AS n_bullet_lines,
         len(list_filter(generate_series(1, len(w) - 1), lambda i: w[i] = w[i + 1]))::BIGINT
           AS n_adjacent_repeats
  FROM texts t LEFT JOIN covered c ON c.doc_id = t.doc_id),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted)
SELECT doc_id, {", ".join(COUNTS)}, base_failed,
       NOT (base_failed OR {" OR ".join(_rule_sql(r) for r in RULES)}) AS kept
FROM judged
"""


@query("op8_quality_rules", RULES_SQL)
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    judged = quality_rules(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", *COUNTS, "base_failed", F.col("kept"))


@query("op3_best_fit_packing")
def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 2048 ids, one row per piece."""
    packed = pack_documents(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), 2048, 0
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = near_duplicates(table(spark, sf_dir, "documents"), size=3, max_bits=3)
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


@query("op7_document_fingerprints")
def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    found = edited_fingerprints(table(spark, sf_dir, "documents"))
    own, edited = F.col("own_sketch"), F.col("edited_sketch")
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        digest(own).alias("fingerprint"), digest(edited).alias("edited_fingerprint"),
        containment(own, edited).alias("near_edited"),
        containment(own, F.col("next_sketch")).alias("near_next"),
    )


def train_quality(documents: DataFrame, labels: DataFrame) -> LineField:
    """The quality field, from labelled rows that are not held out."""
    marked = documents.select("doc_id", "text").join(labels.select("doc_id", "quality"), "doc_id")
    return train(marked.filter(~held_out(F.col("doc_id"))))


@query("op10_quality_classifier")
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by a field learned from the others' labels."""
    documents = table(spark, sf_dir, "documents")
    field = train_quality(documents, table(spark, sf_dir, "labels"))
    scored = score(documents, field, {"doc_id": F.col("doc_id")})
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= QUALITY).cast("int").alias("predicted"),
    )


@query("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, and whether it exceeds a context of 512."""
    counted = token_counts(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


@query("op5_token_id_store")
def op5_token_id_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written to a store and read back from it."""
    folder = shared_folder(spark, "token-store")
    write_store(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), folder, 2
    )
    return read_store(spark, folder)


@query("op2_sampled_pieces")
def op2_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document, and whether it decodes to its text."""
    sampled = sample_pieces(
        table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"),
        {"doc_id": F.col("doc_id")}, F.col("doc_id"), seed=1, verify="lossless",
    )
    return sampled.select("doc_id", F.size("ids").alias("n_pieces"), "ids_crc32", "ids", "lossless")


@query("op6_warc_derivatives")
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    derived = derivatives(responses(table(spark, sf_dir, "pages")))
    return derived.drop("record")


def document_files(documents: DataFrame) -> DataFrame:
    """Documents as files: a directory per thousand and ten, the first in each its LICENSE."""
    k = F.col("doc_id")
    path = F.concat_ws(
        "/", F.lit("corpus"), F.floor(k / 1000).cast("string"),
        F.when(k % 1000 == 0, F.lit("LICENSE")).otherwise(
            F.concat_ws(
                "/", F.floor(k / 10).cast("string"),
                F.when(k % 10 == 0, F.lit("LICENSE")).otherwise(
                    F.concat(k.cast("string"), F.lit(".txt"))
                ),
            )
        ),
    )
    return documents.select("doc_id", path.alias("path"), "text")


@query("op9_license_scan")
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or that of a directory above."""
    scanned = license_scan(document_files(table(spark, sf_dir, "documents")))
    return scanned.select("doc_id", "path", "license", "score", "license_from", "inherited")


@query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every damaged conversation."""
    damaged, left = damage(table(spark, sf_dir, "conversations"))
    return repair_conversations(damaged, left)


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector, whose labels are partly wrong."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(
        table(spark, sf_dir, "embeddings"), anchor=F.col("id") % 100 == 0, label=label
    )


@query("op13_suffix_dedup")
def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without passages of 100 bytes that start earlier."""
    cut = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"),
    )
