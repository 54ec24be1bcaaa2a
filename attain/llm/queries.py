"""The registered queries of this subpackage and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attain.llm import align, decontam, html, langid, licenses, linedup, lm, minhash, packing, sharding, tokens, vectors, whitening
from attain.llm.common import table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def id_remainder(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(name).cast("string"), F.lit("")), "UTF-8")) % n


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = id_remainder("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model)
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of all documents under a model of four fifths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = id_remainder("doc_id", 5) == 1
    out = lm.score(docs, lm.fit(docs.where(~held_out)))
    return out.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen shards of near equal bytes, by document id."""
    docs = table(spark, sf_dir, "documents")
    size = F.octet_length(F.coalesce("text", F.lit(""))) + 1
    out = sharding.shard(docs, "doc_id", size)
    return out.select("doc_id", "size", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
                      F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold items of the benchmark."""
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents in sequences of 2048 tokens."""
    out = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of whole texts and whole lines."""
    return licenses.scan(table(spark, sf_dir, "documents"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose five-word shingles are three quarters alike."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of embeddings of one label with a cosine of 0.93 or more."""
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages")
    out = html.extract(pages, html.fit(pages))
    return out.select("page_id", "url", "text", "n_chars")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without repeated and near repeated lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.dedup_lines(docs, max_edits=linedup.EDITS, exact_chars=linedup.EXACT_CHARS)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path())


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers over every document."""
    return align.align_documents(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in units of their eight leading components."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    lines = f"regexp_replace(lower(coalesce(text, '')), {_quoted(licenses.COPYRIGHT_LINE)}, '\\1', 'g')"
    lines = f"regexp_replace({lines}, {_quoted(licenses.PUNCTUATION)}, ' ', 'g')"
    for other, ours in licenses.SPELLINGS:
        lines = f"replace({lines}, {_quoted(other)}, {_quoted(ours)})"
    known = ", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in licenses.KNOWN)
    whole = "sha256(trim(regexp_replace(lines, '[ \\n]+', ' ', 'g')))"
    return f"""
WITH known AS (SELECT {whole} AS digest, min(license_id) AS license_id
               FROM (SELECT license_id, {lines} AS lines FROM (VALUES {known}) k(license_id, text)) GROUP BY 1),
base AS (SELECT doc_id, {lines} AS lines FROM documents),
whole AS (SELECT doc_id, {whole} AS digest FROM base),
hits AS (SELECT DISTINCT doc_id, license_id
         FROM (SELECT doc_id, trim(unnest(string_split(lines, chr(10)))) AS line FROM base) l
         JOIN known ON sha256(l.line) = known.digest WHERE l.line <> ''),
listed AS (SELECT doc_id, string_agg(license_id, ',' ORDER BY license_id) AS notice_ids FROM hits GROUP BY 1)
SELECT whole.doc_id, whole.digest, known.license_id, coalesce(notice_ids, '') AS notice_ids
FROM whole LEFT JOIN known ON known.digest = whole.digest LEFT JOIN listed ON listed.doc_id = whole.doc_id"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language": op1_language,
        "op2_language_model": op2_language_model,
        "op3_histogram_sort": op3_histogram_sort,
        "op4_decontamination": op4_decontamination,
        "op5_vector_packing": op5_vector_packing,
        "op6_license_digests": op6_license_digests,
        "op7_minhash": op7_minhash,
        "op8_multi_index": op8_multi_index,
        "op9_main_text": op9_main_text,
        "op10_line_dedup": op10_line_dedup,
        "op11_token_counts": op11_token_counts,
        "op12_alignment": op12_alignment,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {"op6_license_digests": _license_sql()}
