"""Merkle fixity audit of WARC records in two replicas.

Every archive has a tree over slots, a record's slot being the hash of its id,
so a record that has grown, is gone or is new changes its own slot and no other.
A slot hashes the ids, lengths and bytes of its records, an inner node the hashes
of up to ``FANOUT`` neighbours, so it stands for a range of slots. Replicas get
trees of the same height and are compared root by root, and only below nodes that
differ the next level is compared, down to the slots; there records are matched
by id. Leaves and nodes are built by DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.session import materialize

FANOUT = 16
RECORDS = 1_000  # about so many in an archive
LINE = "\r\n"


def record_bytes(uri: Column, payload: Column) -> Column:
    """A WARC/1.1 resource record: header, payload and the two line ends after it."""
    body = F.encode(F.coalesce(payload, F.lit("")), "UTF-8")
    head = F.concat(
        F.lit(f"WARC/1.1{LINE}WARC-Type: resource{LINE}WARC-Target-URI: "),
        F.coalesce(uri, F.lit("")),
        F.lit(f"{LINE}WARC-Payload-Digest: sha256:"),
        F.sha2(body, 256),
        F.lit(f"{LINE}Content-Type: text/html{LINE}Content-Length: "),
        F.length(body).cast("string"),
        F.lit(LINE + LINE),
    )
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit(LINE + LINE), "UTF-8"))


def archive_count(pages: DataFrame) -> int:
    """How many archives these pages are dealt over; a replica takes its primary's number."""
    return max(1, pages.count() // RECORDS)


def to_archive(
    pages: DataFrame,
    id_col: str = "page_id",
    uri_col: str = "url",
    payload_col: str = "html",
    files: int | None = None,
) -> DataFrame:
    """Pages as records (file, id, record), dealt over archives by a hash of id and url.

    ``files`` is the number of archives, by default what the number of pages
    asks for; two replicas are dealt alike only over the same number. A null
    url or payload is empty; other columns are ignored. Records of an archive
    are in order of id; rows that repeat an id are ordered by content.
    """
    files = files or archive_count(pages)
    return pages.select(
        F.pmod(F.xxhash64(id_col, uri_col), F.lit(files)).cast("int").alias("file"),
        F.col(id_col).alias("id"),
        record_bytes(F.col(uri_col), F.col(payload_col)).alias("record"),
    )


def leaves(records: DataFrame) -> DataFrame:
    """(file, seq, id, first, last, hash): where each record lies, and its leaf.

    Only ids, lengths and content hashes are shuffled; an archive's records are
    bounded by the writer, so its prefix sum is one group.
    """
    narrow = records.select(
        "file",
        "id",
        F.length("record").cast("long").alias("length"),
        F.sha2("record", 256).alias("content"),
    )
    order = Window.partitionBy("file").orderBy("id", "content")
    last = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0))
    leaf = F.sha2(F.concat_ws(":", "id", "length", "content").cast("binary"), 256)
    return narrow.select(
        "file",
        (F.row_number().over(order) - 1).cast("long").alias("seq"),
        "id",
        (last - F.col("length")).alias("first"),
        last.alias("last"),
        leaf.alias("hash"),
    )


def height(leaf_rows: DataFrame, fanout: int = FANOUT) -> int:
    """Levels above the slots, for about as many slots as the largest archive has records."""
    largest = leaf_rows.groupBy("file").count().agg(F.max("count")).first()[0] or 0
    found = 0
    while fanout**found < largest:
        found += 1
    return found


def slot(id_col: str, slots: int) -> Column:
    return F.pmod(F.xxhash64(id_col), F.lit(slots).cast("long"))


def levels(leaf_rows: DataFrame, above: int, fanout: int = FANOUT) -> list[DataFrame]:
    """Nodes per level (file, node, hash), the slots first, the roots last."""
    parts = F.sort_array(F.collect_list("hash"))
    level = materialize(
        leaf_rows.groupBy("file", slot("id", fanout**above).alias("node")).agg(
            F.sha2(F.array_join(parts, "").cast("binary"), 256).alias("hash")
        ),
        "warc-level",
    )
    found = [level]
    parts = F.sort_array(F.collect_list(F.struct("node", "hash")))
    parts = F.transform(parts, lambda p: F.concat_ws(":", p["node"], p["hash"]))
    for _ in range(above):
        level = materialize(
            level.groupBy("file", F.floor(F.col("node") / fanout).cast("long").alias("parent"))
            .agg(F.sha2(F.array_join(parts, ",").cast("binary"), 256).alias("hash"))
            .withColumnRenamed("parent", "node"),
            "warc-level",
        )
        found.append(level)
    return found


def _unequal(one: DataFrame, two: DataFrame) -> DataFrame:
    names = ("file", "node")
    a = one.select(*names, F.col("hash").alias("_one"))
    b = two.select(*names, F.col("hash").alias("_two"))
    joined = a.join(b, list(names), "full_outer")
    return joined.where(~F.col("_one").eqNullSafe(F.col("_two"))).select(*names)


def _side_by_side(own: DataFrame, other: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(one, two) of leaves that agree in file, id and ``by``, null ids included; else one is null."""
    a = own.select(F.struct(*own.columns).alias("one"))
    b = other.select(F.struct(*other.columns).alias("two"))
    same = F.col("one.id").eqNullSafe(F.col("two.id"))
    for name in ("file", *by):
        same &= F.col(f"one.{name}") == F.col(f"two.{name}")
    return a.join(b, same, "full_outer")


def _numbered(leaf_rows: DataFrame, *by: str) -> DataFrame:
    order = Window.partitionBy("file", "id", *by).orderBy("seq")
    return leaf_rows.withColumn("turn", F.row_number().over(order))


def _damage(own: DataFrame, other: DataFrame) -> DataFrame:
    """(one, two) of the leaves that differ; equal leaves of a repeated id cancel out first."""
    pairs = _side_by_side(_numbered(own, "hash"), _numbered(other, "hash"), ("hash", "turn"))
    left = materialize(pairs.where("one IS NULL OR two IS NULL"), "warc-unmatched")
    rest = [left.where(f"{name} IS NOT NULL").select(f"{name}.*") for name in ("one", "two")]
    return _side_by_side(*(_numbered(rows) for rows in rest), ("turn",))


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Records (file, id, record) that differ between two replicas dealt alike.

    One row per damaged record: file, seq, id, first, last (position and offsets
    in the primary, in the replica where the primary has no such record), state
    (``changed``, ``missing`` from or ``extra`` in the replica) and levels, the
    number of tree levels descended. Records are matched by file and id; of an id
    that repeats, equal records are matched first and the others in their order.
    Equal replicas, empty ones included, give no rows.
    """
    own = materialize(leaves(primary), "warc-leaves")
    other = materialize(leaves(replica), "warc-leaves")
    above = max(height(own, fanout), height(other, fanout))
    one, two = levels(own, above, fanout), levels(other, above, fanout)
    bad = materialize(_unequal(one[above], two[above]), "warc-bad")
    for k in range(above - 1, -1, -1):
        parents = bad.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
        below = [
            level.join(
                parents,
                (F.col("file") == F.col("_f"))
                & (F.floor(F.col("node") / fanout).cast("long") == F.col("_n")),
                "left_semi",
            )
            for level in (one[k], two[k])
        ]
        bad = materialize(_unequal(*below), "warc-bad")
    places = bad.select(F.col("file").alias("_f"), F.col("node").alias("_n"))
    inside = (F.col("file") == F.col("_f")) & (slot("id", fanout**above) == F.col("_n"))
    found = _damage(*(rows.join(places, inside, "left_semi") for rows in (own, other)))
    at = F.coalesce("one", "two")
    state = (
        F.when(F.col("two").isNull(), "missing")
        .when(F.col("one").isNull(), "extra")
        .otherwise("changed")
    )
    return found.select(
        *(at[name].alias(name) for name in ("file", "seq", "id", "first", "last")),
        state.alias("state"),
        F.lit(above + 1).alias("levels"),
    )
