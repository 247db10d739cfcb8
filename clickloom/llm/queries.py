"""Registered queries of this subpackage and their SQL equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    bpe,
    embedding_dedup,
    exact_dedup,
    langid,
    lexical,
    license_scan,
    packing,
    repeats,
    secret_scan,
    simhash,
    toxicity,
    variants,
    warc,
)
from clickloom.llm.common import bounded, remainder, table

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
TOXIC_FROM = 0.7
DAMAGED = 97  # one page in so many is damaged in the audited replica


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), tokenizer_path(), END_ID)
    return packing.pack(pieces)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 3) == 1
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").where("toxic IS NOT NULL")
    learn = docs.select("doc_id", "text").where(~held_out).join(bounded(labels), "doc_id")
    scored = toxicity.score(docs, toxicity.fit(learn))
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= TOXIC_FROM).cast("int").alias("predicted"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The operator leaves unique texts unhashed; the digest column fills that in."""
    docs = table(spark, sf_dir, "documents")
    verdicts = exact_dedup.exact_duplicates(docs, digest_all=True)
    return verdicts.withColumnRenamed("full_hash", "text_sha256").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secret_scan.LEARNED)
    count = [
        F.size(F.filter("spans", lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")
        for kind in secret_scan.KINDS
    ]
    return found.select(
        "doc_id",
        *count,
        F.sha2(F.encode(secret_scan.span_text(base), "UTF-8"), 256).alias("base_sha256"),
        secret_scan.span_text(F.col("spans")).alias("spans"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_decode(table(spark, sf_dir, "documents"), tokenizer_path())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op9_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit a replica of the pages in which some pages have one character changed.

    It is dealt over as many archives as the primary.
    """
    pages = table(spark, sf_dir, "pages")
    files = warc.archive_count(pages)
    fate = F.pmod(F.crc32(F.encode(F.col("page_id").cast("string"), "UTF-8")), F.lit(DAMAGED))
    html = F.coalesce("html", F.lit(""))
    at = F.greatest(F.length(html) / 2, F.lit(1)).cast("int")
    other = F.when(F.substring(html, at, F.lit(1)) == "?", "!").otherwise("?")
    cut = F.overlay(html, other, at)
    damaged = pages.withColumn("html", F.when(fate == 0, cut).otherwise(F.col("html")))
    return warc.audit(warc.to_archive(pages, files=files), warc.to_archive(damaged, files=files))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder("doc_id", 4) == 2
    found = langid.identify(docs, langid.fit(docs.where(~held_out)))
    return found.select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {name: fn for name, fn in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {
        "op5_embedding_dedup": """
            WITH RECURSIVE v AS (
              SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings),
            usable AS (
              SELECT * FROM v WHERE label IS NOT NULL AND len(list_filter(e, lambda x: x <> 0)) > 0
                AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
            links AS (
              SELECT p.vec_id AS a, q.vec_id AS b
              FROM usable p JOIN usable q
                ON p.label = q.label AND len(p.e) = len(q.e) AND p.vec_id <> q.vec_id
              WHERE list_cosine_similarity(p.e, q.e) >= 0.98),
            reach(node, other) AS (
              SELECT vec_id, vec_id FROM v
              UNION SELECT node, b FROM reach JOIN links ON a = other)
            SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
                   min(other) AS component_id, vec_id = min(other) AS kept
            FROM v JOIN reach ON node = vec_id GROUP BY vec_id""",
        "op4_exact_dedup": r"""
            WITH plain AS (
              SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                       AS text_sha256
              FROM documents),
            groups AS (
              SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
              FROM plain GROUP BY 1)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
            FROM plain JOIN groups USING (text_sha256)""",
        "op11_lexical_search": r"""
            WITH cut AS (
              SELECT doc_id, row_number() OVER () AS row_no,
                     unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
              FROM documents),
            held AS (SELECT doc_id, row_no, term, count(*) AS tf FROM cut GROUP BY ALL),
            sizes AS (SELECT row_no, sum(tf)::BIGINT AS n FROM held GROUP BY 1),
            total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS l FROM sizes),
            asked AS (
              SELECT item_id, item_no, term, count(*) AS times FROM (
                SELECT item_id, row_number() OVER () AS item_no,
                       unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark) GROUP BY ALL),
            weights AS (
              SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT AS w
              FROM (SELECT term, count(*) AS df FROM held GROUP BY 1), total),
            scores AS (
              SELECT item_no, item_id, row_no, doc_id,
                     sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * docs) // l))))::BIGINT AS score
              FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (row_no), total
              GROUP BY ALL),
            ranked AS (
              SELECT item_id, doc_id, score,
                     row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS FIRST) AS place
              FROM scores WHERE score > 0)
            SELECT item_id, place::INTEGER AS rank, doc_id, score FROM ranked WHERE place <= 20""",
        "op12_repeat_removal": """
            WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
            starts AS (
              SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d),
            windows AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM starts),
            least AS (SELECT s, min(doc_id) AS m FROM windows GROUP BY s),
            again AS (
              SELECT doc_id, i, coalesce(i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) > 50, true) AS fresh
              FROM windows JOIN least USING (s) WHERE doc_id > m),
            numbered AS (
              SELECT doc_id, i, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM again),
            spans AS (
              SELECT doc_id, span, min(i) AS a, max(i) + 50 AS b FROM numbered GROUP BY ALL),
            cuts AS (
              SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
            kept AS (
              SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans,
                     string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a)
                       || substr(any_value(h), 2 * max(b) + 1) AS k
              FROM cuts JOIN d USING (doc_id) GROUP BY doc_id)
            SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
                   coalesce(n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k, h))) AS kept_sha256
            FROM d LEFT JOIN kept USING (doc_id)""",
    }
