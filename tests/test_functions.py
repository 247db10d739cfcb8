import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.functions import clicks, times, vectors


def one(spark, column, value, kind):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(column(F.col("x"))).first()[0]


ISO = "2024-03-05T06:07:08.123456"


@pytest.mark.parametrize(
    "text, lenient, strict",
    [
        (ISO, datetime(2024, 3, 5, 6, 7, 8, 123000), datetime(2024, 3, 5, 6, 7, 8, 123456)),
        ("2024-03-05T06:07:08.123", datetime(2024, 3, 5, 6, 7, 8, 123000), None),
        ("2024-03-05T06:07:08.5", datetime(2024, 3, 5, 6, 7, 8, 500000), None),
        ("2024-03-05T06:07:08", datetime(2024, 3, 5, 6, 7, 8), None),
        (ISO + "Z", datetime(2024, 3, 5, 6, 7, 8, 123000), None),
        ("2024-13-05T06:07:08", None, None),
        ("junk", None, None),
        ("2024", None, None),
        ("1709618828.5", None, None),
        (None, None, None),
    ],
)
def test_event_time(spark, text, lenient, strict):
    assert one(spark, times.parse_event_time, text, "string") == lenient
    assert one(spark, lambda c: times.parse_event_time(c, "strict"), text, "string") == strict


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1704067207.179575", datetime(2024, 1, 1, 0, 0, 7, 179575)),
        ("1704067207", datetime(2024, 1, 1, 0, 0, 7)),
        ("1.704067207E9", datetime(2024, 1, 1, 0, 0, 7)),
        (ISO, datetime(2024, 3, 5, 6, 7, 8, 123456)),
        ("junk", None),
        (None, None),
    ],
)
def test_normalize_timestamp(spark, text, expected):
    assert one(spark, times.normalize_timestamp, text, "string") == expected


def test_missing_time_column_follows_row_order(spark):
    rows = times.with_event_order(spark.createDataFrame([("a",), ("b",)], "x string").coalesce(1))
    assert [r.x for r in rows.orderBy("timestamp").collect()] == ["a", "b"]


def test_month_date_double(spark):
    row = spark.createDataFrame([("2024-05-31", "12.5", "x")], "d string, p string, bad string")
    got = row.select(
        times.month_of(times.to_date(F.col("d"))),
        times.to_double(F.col("p")),
        times.to_double(F.col("bad")),
        times.to_date(F.col("bad")),
    ).first()
    assert tuple(got) == ("2024-05", 12.5, None, None)


def test_vectors(spark):
    df = spark.createDataFrame([("[3.0, 4.0]", [1.0, 2.0])], "t string, b array<double>")
    a, b = vectors.parse_vector(F.col("t")), F.col("b")
    got = df.select(
        vectors.dot(a, b), vectors.l2_norm(a), vectors.unit(a), vectors.blend(a, b, 0.25)
    ).first()
    assert got[0] == 11.0 and got[1] == 5.0
    assert got[2] == pytest.approx([0.6, 0.8])
    assert got[3] == pytest.approx([1.5, 2.5])


def test_logistic(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (-50.0,)], "x double")
    got = [
        tuple(r)
        for r in df.select(
            vectors.sigmoid(F.col("x")), vectors.log_loss(vectors.sigmoid(F.col("x")))
        ).collect()
    ]
    assert got[0] == pytest.approx((0.5, math.log(2)))
    assert got[1][0] == pytest.approx(1 / (1 + math.exp(-10)))
    assert got[2][1] == pytest.approx(math.log(1 + math.exp(10)))


def test_softmax(spark):
    df = spark.createDataFrame([("u", 1.0), ("u", 3.0), ("v", 9.0)], "u string, s double")
    got = {
        (r.u, r.s): r.p
        for r in df.withColumn("p", vectors.softmax(F.col("s"), 2.0, "u")).collect()
    }
    assert got[("v", 9.0)] == 1.0
    assert got[("u", 3.0)] == pytest.approx(math.e / (1 + math.e))


def test_position_weights():
    oldest = vectors.position_weights(4)
    assert sum(oldest) == pytest.approx(1.0) and oldest == sorted(oldest, reverse=True)
    assert vectors.position_weights(4, "recent") == oldest[::-1]


def test_seeded_vector_depends_on_id_and_seed_only(spark):
    ids = spark.range(2000).select(F.col("id").cast("string").alias("k"))

    def draw(df, seed):
        v = vectors.seeded_vector(F.col("k"), 8, seed, 0.1)
        return {r.k: r.v for r in df.select("k", v.alias("v")).collect()}

    first, again = draw(ids, 42), draw(ids.filter("k > '5'").repartition(3), 42)
    assert all(first[k] == v for k, v in again.items())
    assert first["7"] != draw(ids, 43)["7"]
    values = np.array(list(first.values()))
    assert abs(values.mean()) < 0.005 and abs(values.std() - 0.1) < 0.005


def test_event_weight_unknown_is_null(spark):
    df = spark.createDataFrame([("view",), ("payment_failed",), ("?",), (None,)], "t string")
    got = [r[0] for r in df.select(clicks.event_weight(F.col("t"))).collect()]
    assert got == [1.0, -2.0, None, None]


@pytest.mark.parametrize(
    "seq, expected",
    [
        (["a"], ["<PAD>", "<PAD>", "a"]),
        (["a", "b", "c"], ["a", "b", "c"]),
        (["a", "b", "c", "d"], ["b", "c", "d"]),
        ([], ["<PAD>"] * 3),
    ],
)
def test_fit_sequence(spark, seq, expected):
    assert one(spark, lambda c: clicks.fit_sequence(c, 3), seq, "array<string>") == expected
