"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Fingerprints within ``RADIUS`` = 3 bits of each other are found without
comparing pairs. The 64 bits fall into three blocks. Two fingerprints that
differ in one to three bits differ somewhere in some block; with that block
masked they differ in at most two of the other bits, so the balls of radius
one around both meet in the middle. Every distinct fingerprint therefore emits,
for each of the three masks, the masked value and its variants with one bit
turned (132 in all), and the variants are shuffled. Fingerprints that share a
variant are verified in full. Within a bucket only a spanning forest of the
verified links leaves the task, which keeps components and never lists all
pairs. Buckets larger than ``BUCKET`` are cut into tiles, and pairs of tiles are
compared as tasks of their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, drop_listed, in_arrow, text_or_empty
from clickloom.llm.components import connected_components
from clickloom.session import materialize

RADIUS = 3
WORDS = 3
SEED = 42
BLOCKS = ((0, 21), (21, 42), (42, 64))
BUCKET = 4096
STEP = 1 << 16


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """Bits set in over half of the shingle hashes; repeats count."""
    cut = text.encode().lower().split()  # bytes: A-Z only, ASCII white space only
    if not cut:
        return 0
    flat = b" ".join(cut)
    ends = np.cumsum([len(w) + 1 for w in cut])
    first = np.concatenate([[0], ends[: max(0, len(cut) - words)]])
    last = ends[min(words, len(cut)) - 1 :] - 1
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, "int64")
    for at in range(0, len(first), STEP):
        places = zip(first[at : at + STEP].tolist(), last[at : at + STEP].tolist())
        hashes = np.array([digest(flat[a:b], seed) for a, b in places], "<u8")
        bits = np.unpackbits(hashes.view("u1").reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype="int64")
    return int(np.packbits(counts * 2 > len(first), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """id, ``fp``, the fingerprint as a signed long, and ``_digest``, a hash of the text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], "u8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps.view("i8")), batch.column(2)],
                names=[id_col, "fp", "_digest"],
            )

    text = text_or_empty(text_col)
    rows = docs.select(id_col, text.alias("_text"), F.xxhash64(text).alias("_digest"))
    return in_arrow(rows, run, f"`{id_col}` {kind}, fp long, _digest long")


def _variants(fps: DataFrame) -> DataFrame:
    """(key, fp): each fingerprint under all its variants."""
    masks, turned = [], []
    for low, high in BLOCKS:
        mask = ~(((1 << high) - 1) ^ ((1 << low) - 1)) & ((1 << 64) - 1)
        bits = [0] + [1 << b for b in range(64) if not low <= b < high]
        masks += [mask] * len(bits)
        turned += bits

    def run(batches):
        both, flips = np.array(masks, "u8"), np.array(turned, "u8")
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fp = batch.column(0).slice(at, 4096).to_numpy().view("u8")
                keys = (fp[:, None] & both[None, :]) ^ flips[None, :]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(keys.ravel().view("i8")),
                        pa.array(np.repeat(fp, len(flips)).view("i8")),
                    ],
                    names=["key", "fp"],
                )

    return fps.select("fp").mapInArrow(run, "key long, fp long")


def _forest(fps: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the links among distinct fingerprints: no pair is listed."""
    links, rest, found = [], np.arange(1, len(fps)), [0]
    while len(rest):
        here = found.pop() if found else int(rest[0])
        if rest[0] == here:
            rest = rest[1:]
        near = np.bitwise_count(fps[rest] ^ fps[here]) <= RADIUS
        for i in rest[near].tolist():
            links.append((here, i))
            found.append(i)
        rest = rest[~near]
    return links


def _links(grouped: DataFrame, keys: list[str], largest: int | None) -> DataFrame:
    """Links within the groups of a frame dealt and sorted by ``keys`` and fp.

    Groups above ``largest`` come back as their own rows, with ``key`` set.
    """
    n = len(keys)

    def groups(batches):
        """Consecutive rows of the same keys; a group may span batches."""
        held: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy() for i in range(n + 1)])
            if held:
                rows = np.concatenate([held[-1], rows], axis=1)
            new = np.flatnonzero((rows[:n, 1:] != rows[:n, :-1]).any(0)) + 1
            last = new[-1] if len(new) else 0
            held = [rows[:, last:]]
            if last:
                yield rows[:, :last], np.concatenate([[0], new[:-1]]), new
        if held and held[-1].shape[1]:
            yield held[-1], np.array([0]), np.array([held[-1].shape[1]])

    def run(batches):
        for rows, starts, ends in groups(batches):
            sizes = ends - starts
            fp, a, b, key = rows[n].view("u8"), [], [], []
            two = starts[sizes == 2]
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= RADIUS]
            pairs = [rows[n][two], rows[n][two + 1]]
            for s, e in zip(starts[sizes > 2].tolist(), ends[sizes > 2].tolist()):
                if largest is not None and e - s > largest:
                    a += rows[n, s:e].tolist()
                    b += rows[n, s:e].tolist()
                    key += rows[0, s:e].tolist()
                    continue
                own = np.unique(rows[n, s:e])
                for i, j in _forest(own.view("u8")):
                    a.append(int(own[i]))
                    b.append(int(own[j]))
                    key.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([pairs[0], np.array(a, "i8")])),
                    pa.array(np.concatenate([pairs[1], np.array(b, "i8")])),
                    pa.array([None] * len(two) + key, pa.int64()),
                ],
                names=["a", "b", "key"],
            )

    return grouped.select(*keys, "fp").mapInArrow(run, "a long, b long, key long")


def _parts(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def near_links(fps: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) among distinct fingerprints ``fp`` that keep all components."""
    parts = _parts(fps)
    dealt = _variants(fps).repartition(parts, "key").sortWithinPartitions("key", "fp")
    found = materialize(_links(dealt, ["key"], bucket).distinct(), "simhash-links")
    links = found.where("key IS NULL").select("a", "b")
    large = found.where("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    sizes = large.groupBy("key").count()
    if sizes.isEmpty():
        return links
    tiles = F.ceil(F.col("count") / bucket).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("_n")).cast("int")
    tiled = (
        large.join(sizes.select(F.col("key").alias("_key"), tiles.alias("_n")),
                   F.col("key") == F.col("_key"))
        .withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
        .select(
            "key",
            F.least("_own", "_other").cast("long").alias("_low"),
            F.greatest("_own", "_other").cast("long").alias("_high"),
            "fp",
        )
    )
    keys = ["key", "_low", "_high"]
    dealt = tiled.repartition(parts, *keys).sortWithinPartitions(*keys, "fp")
    return links.unionByName(_links(dealt, keys, None).select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """One row per document: id, fp, component_id (the smallest id reachable by links).

    Ids are whole numbers that fit a long. Null and empty texts have the fingerprint zero, which links like any other.
    Repeated rows give repeated rows; rows without id have a null component
    unless an id shares their fingerprint's component; an empty table gives no
    rows; other columns are ignored.
    """
    return _with_components(docs, id_col, text_col).select(id_col, "fp", "component_id")


def _with_components(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = materialize(fingerprints(docs, id_col, text_col), "simhash")
    classes = materialize(rows.groupBy("fp").agg(F.min(id_col).alias("_least")), "simhash-classes")
    links = near_links(classes)
    nodes = classes.select(F.col("fp").alias("_fp"), F.col("_least").cast("long").alias("_node"))
    ends = links.join(nodes, F.col("a") == F.col("_fp")).select("b", F.col("_node").alias("_a"))
    ends = ends.join(nodes, F.col("b") == F.col("_fp")).select(
        F.col("_a").alias("a"), F.col("_node").alias("b")
    )
    roots = connected_components(ends)
    known = materialize(
        classes.join(roots, F.col("_least") == F.col("node"), "left").select(
            F.col("fp").alias("_fp"), F.coalesce("root", "_least").alias("component_id")
        ),
        "simhash-components",
    )
    # Two written tables: a fingerprint that many documents share is split by the join.
    return rows.join(known, F.col("fp") == F.col("_fp"), "left")


def drop_near_duplicates(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """The document of each group that has the smallest id, with all its columns.

    A row goes by its id and its text: another text of the same id is not touched.
    """
    found = _with_components(docs, id_col, text_col)
    dropped = found.where(F.col(id_col) != F.col("component_id")).select(
        F.col(id_col).alias("_id"), "_digest"
    )
    return drop_listed(docs, dropped, F.xxhash64(text_or_empty(docs[text_col])), id_col)
