"""Near-duplicate vectors by a pigeonhole join over subspaces.

Unit vectors with cosine c or more are at most ``sqrt(2 - 2c)`` apart. They are
rotated, which spreads that distance over all coordinates, and cut into blocks.
If two vectors exceeded the block's share of the squared distance in every
block, they would exceed the whole: so a range join per block, under a budget
proportional to the block's width, finds every pair. The range join deals
points into cells by their first coordinates of the block; a point visits the
neighbour cells within reach on one side only, so every pair meets once. Cells
keep those pairs that hold the block's whole budget. The union of the blocks'
candidates is verified on the full vectors. Equal vectors are one point with a
count; cells above ``CELL`` rows are cut into tiles whose pairs are tasks of
their own.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.components import connected_components
from clickloom.session import materialize

COSINE = 0.98
BLOCKS = 8
GRID = 3  # coordinates of a block that place a point in a cell
CELL = 4096
CHUNK = 512
SLACK = 1e-9  # rounding of the rotation
SEED = 5

_POINT = "label string, id long, vector array<double>"


def rotation(size: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size]).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def _valid(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Rows that may link: labelled, and a finite vector other than zero."""
    v = F.col("vector")
    size = F.size(v)
    finite = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(
            F.col(label_col).cast("string").alias("label"),
            F.col(id_col).alias("id"),
            F.col(vector_col).cast("array<double>").alias("vector"),
        )
        .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .where((size > 0) & finite)
        .where(F.exists(v, lambda x: x != 0))
    )


def _cells(points: DataFrame, cosine: float) -> DataFrame:
    """(group, cell, home, id, part): a point in its cell and the cells it visits, per block."""
    reach = max(0.0, 2 - 2 * cosine)

    def run(batches):
        for batch in batches:
            labels = batch.column(0).to_pylist()
            ids = batch.column(1).to_pylist()
            by: dict[int, list[int]] = {}
            raw = batch.column(2).to_pylist()
            for i, v in enumerate(raw):
                by.setdefault(len(v), []).append(i)
            for size, rows in by.items():
                x = _units([raw[i] for i in rows]) @ rotation(size)
                for block, at in enumerate(np.array_split(np.arange(size), min(BLOCKS, size))):
                    radius = np.sqrt(reach * len(at) / size + SLACK)
                    group = [f"{labels[i]}|{size}|{block}" for i in rows]
                    yield from _visits(x[:, at], radius, group, [ids[i] for i in rows])

    return points.mapInArrow(
        run, "`group` string, cell string, home boolean, id long, part array<double>"
    )


def _units(rows) -> np.ndarray:
    x = np.array(rows, "f8")
    x = x / np.abs(x).max(1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _visits(part: np.ndarray, radius: float, group: list[str], ids: list[int]):
    width = 2 * radius
    dims = min(GRID, part.shape[1])
    cell = np.floor(part[:, :dims] / width).astype("i8")
    low = part[:, :dims] - cell * width <= radius
    high = (cell + 1) * width - part[:, :dims] <= radius
    for step in itertools.product((-1, 0, 1), repeat=dims):
        if step < (0,) * dims:
            continue  # the pair meets when the other point visits
        ok = np.ones(len(part), bool)
        for d, s in enumerate(step):
            ok &= {0: np.ones(len(part), bool), -1: low[:, d], 1: high[:, d]}[s]
        at = np.flatnonzero(ok)
        if len(at):
            names = [",".join(map(str, c)) for c in (cell[at] + np.array(step)).tolist()]
            flat = part[at]
            ends = np.arange(0, flat.size + 1, flat.shape[1], dtype="int32")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([group[i] for i in at]),
                    pa.array(names),
                    pa.array([not any(step)] * len(at)),
                    pa.array([ids[i] for i in at], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), flat.ravel()),
                ],
                names=["group", "cell", "home", "id", "part"],
            )


def _meet(sorted_rows: DataFrame, cosine: float) -> DataFrame:
    """Pairs within a cell that hold the block's budget; a frame dealt and sorted by cell.

    Columns group, cell, tiles (low, high), tile, home, id, part.
    """
    reach = max(0.0, 2 - 2 * cosine)

    def cells(batches):
        held, key = [], None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:4] != key:
                    if held:
                        yield key, held
                    held, key = [], row[:4]
                held.append(row[4:])
        if held:
            yield key, held

    def run(batches):
        for (group, _, low, high), rows in cells(batches):
            size = int(group.split("|")[-2])
            part = np.array([r[3] for r in rows])
            budget = reach * part.shape[1] / size + SLACK
            tile, home = (np.array([r[k] for r in rows]) for k in (0, 1))
            ids = np.array([r[2] for r in rows], "i8")
            homes = np.flatnonzero(home)
            squares = (part**2).sum(1)
            a, b = [], []
            for at in range(0, len(homes), CHUNK):
                i = homes[at : at + CHUNK]
                apart = squares[i][:, None] + squares[None, :] - 2 * part[i] @ part.T
                near = apart <= budget + 1e-12
                near &= ~home[None, :] | (ids[i][:, None] < ids[None, :])
                if low != high:
                    near &= tile[i][:, None] != tile[None, :]
                x, y = np.nonzero(near)
                a.append(ids[i][x])
                b.append(ids[y])
            if a:
                a, b = np.concatenate(a), np.concatenate(b)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"]
                )

    return sorted_rows.mapInArrow(run, "a long, b long")


def candidate_pairs(points: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """Pairs (a, b) of ids that hold the budget of some block; points: label, id, vector."""
    visits = materialize(_cells(points, cosine), "embedding-cells")
    sizes = visits.groupBy("group", "cell").count().where(F.col("count") > cell)
    tiles = F.ceil(F.col("count") / cell).cast("int")
    large = sizes.select(
        F.col("group").alias("_group"), F.col("cell").alias("_cell"), tiles.alias("_n")
    )
    n = F.coalesce("_n", F.lit(1))
    dealt = (
        visits.join(large, (F.col("group") == F.col("_group")) & (F.col("cell") == F.col("_cell")), "left")
        .withColumn("tile", F.pmod(F.xxhash64("id"), n).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), n - 1)))
        .select(
            "group",
            "cell",
            F.least("tile", "_other").alias("low"),
            F.greatest("tile", "_other").alias("high"),
            "tile",
            "home",
            "id",
            "part",
        )
    )
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = ["group", "cell", "low", "high"]
    met = _meet(dealt.repartition(parts, *keys).sortWithinPartitions(*keys), cosine)
    return met.distinct()


def _verified(pairs: DataFrame, points: DataFrame, cosine: float) -> DataFrame:
    """The candidates whose cosine, in double precision, reaches the limit."""
    left = points.select(F.col("id").alias("_a"), F.col("vector").alias("va"))
    right = points.select(F.col("id").alias("_b"), F.col("vector").alias("vb"))
    both = pairs.join(left, F.col("a") == F.col("_a")).join(right, F.col("b") == F.col("_b"))

    def run(batches):
        for batch in batches:
            one, two = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            keep = np.zeros(batch.num_rows, bool)
            by: dict[int, list[int]] = {}
            for i, v in enumerate(one):
                by.setdefault(len(v), []).append(i)
            for rows in by.values():
                x = _units([one[i] for i in rows])
                y = _units([two[i] for i in rows])
                keep[rows] = (x * y).sum(1) >= cosine
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.select("a", "b", "va", "vb").mapInArrow(run, "a long, b long")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors link when their labels are equal and not null, their lengths are
    equal and their cosine is at least ``cosine``. A vector that is null or
    zero, or holds a null or a number that is not finite, links with nothing:
    no links, its own component. Ids are longs and name one row each; rows that
    repeat an id share the links of all its vectors. An empty table gives no
    rows; other columns are ignored.
    """
    valid = materialize(_valid(vectors, id_col, vector_col, label_col), "embedding-valid")
    alike = materialize(
        valid.groupBy("label", "vector").agg(
            F.min("id").alias("rep"), F.count_distinct("id").alias("copies")
        ),
        "embedding-classes",
    )
    points = alike.select("label", F.col("rep").alias("id"), "vector")
    pairs = materialize(candidate_pairs(points, cosine), "embedding-candidates")
    links = materialize(_verified(pairs, points, cosine), "embedding-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    copies = alike.select(F.col("rep").alias("_rep"), "copies")
    others = (
        both.join(copies, F.col("b") == F.col("_rep"))
        .groupBy(F.col("a").alias("_linked"))
        .agg(F.sum("copies").alias("others"))
    )
    roots = connected_components(links)
    classes = (
        copies.join(others, F.col("_rep") == F.col("_linked"), "left")
        .join(roots, F.col("_rep") == F.col("node"), "left")
        .select(
            "_rep",
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "_rep").alias("component_id"),
        )
    )
    members = valid.join(
        alike.select(F.col("label").alias("_l"), F.col("vector").alias("_v"), "rep"),
        (F.col("label") == F.col("_l")) & (F.col("vector") == F.col("_v")),
    ).select(F.col("id").alias("_id"), "rep")
    found = materialize(
        members.join(classes, F.col("rep") == F.col("_rep")).select(
            "_id", "n_links", "component_id"
        ).distinct(),
        "embedding-members",
    )
    rows = vectors.select(id_col)
    component = F.coalesce("component_id", F.col(id_col).cast("long"))
    return rows.join(found, F.col(id_col) == F.col("_id"), "left").select(
        id_col,
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col(id_col).eqNullSafe(component).alias("kept"),
    )
