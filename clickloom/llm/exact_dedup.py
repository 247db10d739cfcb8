"""Exact duplicates by progressive refinement: length, prefix hash, full hash.

Every pass runs on DataFrame functions alone. A pass keeps only the groups of
two or more that the pass before left over. What survives a pass is handed on
as a set of hash buckets whose number is fixed (``BUCKETS``), so it can always
be broadcast; a bucket that holds a survivor by chance only costs one more hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, drop_listed, text_or_empty
from clickloom.session import materialize

PREFIX_CHARS = 256
BUCKETS = 1 << 18


def normalised(text: str | Column = TEXT) -> Column:
    """Each run of ASCII white space as one space; null as the empty text.

    The pattern matches only runs that change, which leaves the many single
    spaces alone.
    """
    runs = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
    return F.regexp_replace(text_or_empty(text), runs, " ")


def text_digest(text: str | Column = TEXT) -> Column:
    """SHA-256 of the normalised text in UTF-8, lowercase hex."""
    return F.sha2(F.encode(normalised(text), "UTF-8"), 256)


def _bucket(*keys: str) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _repeated_buckets(frame: DataFrame, *keys: str) -> DataFrame:
    """Buckets that hold a group of two or more rows; at most ``BUCKETS`` rows."""
    groups = frame.groupBy(*keys).count().where("count > 1")
    return F.broadcast(groups.select(_bucket(*keys).alias("_bucket")).distinct())


def exact_duplicates(
    docs: DataFrame, id_col: str = ID, text_col: str = TEXT, digest_all: bool = False
) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, full_hash.

    ``full_hash`` is null where an earlier pass proved the text unique, so it
    was never hashed in full; ``digest_all`` hashes those too, on the same pass
    over the texts, without grouping them. Null texts count as empty; equal texts keep the
    smallest id. Repeated ids are one document: their rows share a verdict. A
    null id never keeps a group that has another id; a group of null ids alone
    has a null keep_id and ``kept`` true. An empty table gives no rows; other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    plain = rows.select("_id", normalised("_text").alias("_plain"))
    heads = materialize(
        plain.select(
            "_id",
            F.length("_plain").alias("_length"),
            F.xxhash64(F.substring("_plain", 1, PREFIX_CHARS)).alias("_prefix"),
        ),
        "dedup-heads",
    )
    lengths = _repeated_buckets(heads, "_length")
    same_length = heads.withColumn("_bucket", _bucket("_length")).join(
        lengths, "_bucket", "left_semi"
    )
    prefixes = _repeated_buckets(same_length, "_length", "_prefix")
    survivors = (
        plain.withColumn("_length", F.length("_plain"))
        .withColumn("_prefix", F.xxhash64(F.substring("_plain", 1, PREFIX_CHARS)))
        .withColumn("_bucket", _bucket("_length", "_prefix"))
        .join(prefixes.withColumn("_again", F.lit(True)), "_bucket", "left")
    )
    full = F.sha2(F.encode("_plain", "UTF-8"), 256)
    full = full if digest_all else F.when(F.col("_again"), full)
    hashed = materialize(survivors.select("_id", "_again", full.alias("full_hash")), "dedup-hashes")
    groups = materialize(
        hashed.where("_again")
        .groupBy(F.col("full_hash").alias("_hash"))
        .agg(F.min("_id").alias("_keep"), F.count("*").alias("_size"))
        .where("_size > 1"),
        "dedup-groups",
    )
    # Both sides are scans of written tables, so a hot group is split by the join itself.
    joined = hashed.join(groups, F.col("full_hash") == F.col("_hash"), "left")
    keep = F.when(F.col("_size").isNotNull(), F.col("_keep")).otherwise(F.col("_id"))
    return joined.select(
        F.col("_id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("_id").eqNullSafe(keep).alias("kept"),
        "full_hash",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """The rows that stay, with all their columns.

    A row goes by its id and its text: another text of the same id is not touched.
    """
    verdicts = exact_duplicates(docs, id_col, text_col)
    dropped = verdicts.where(~F.col("kept")).select(F.col(id_col).alias("_id"), "full_hash")
    return drop_listed(docs, dropped, text_digest(docs[text_col]), id_col)
