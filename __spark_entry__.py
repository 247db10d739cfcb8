"""

The given tables stand in for the clickstream data: ``events`` are the clicks,
``customer`` and ``orders`` the users (first order = signup), ``part`` the
products and ``embeddings`` every kind of vector (features and factors).
"""

from __future__ import annotations

import importlib
import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clickloom import schemas  # noqa: E402
from clickloom.functions import clicks as click_fn  # noqa: E402
from clickloom.functions import times, vectors  # noqa: E402
from clickloom.operators import keys, metrics, ratings, sequences  # noqa: E402
from clickloom.operators.encoding import encode_sequences  # noqa: E402
from clickloom.operators.indexing import dense_index  # noqa: E402
from clickloom.operators.skew import hot_keys  # noqa: E402
from clickloom.operators.windows import fraud_windows  # noqa: E402
from clickloom.plans import (  # noqa: E402
    affinity,
    etl,
    factor_model,
    recommend,
    retraining,
    sequence_model,
    signups,
)
from clickloom.session import materialize, scratch_path  # noqa: E402
from clickloom.sources import files, readers, tables  # noqa: E402
from clickloom.sources.models import model_info  # noqa: E402
from clickloom.streaming import fanout, jobs  # noqa: E402

# Event types of the test table; ``signup`` has no weight on purpose.
WEIGHTS = {"view": 1.0, "click": 3.0, "purchase": 5.0, "error": -2.0}
WINDOW, THRESHOLD = "1 day", 5
CUTOVER = "2024-01-16"
DIGITS = 6
PAD_VALUE = 0.05

# --------------------------------------------------------------------------
# Test tables as the frames the package works on
# --------------------------------------------------------------------------


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _clicks_from(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").alias("product_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def _clicks(spark: SparkSession, sf: str) -> DataFrame:
    return _clicks_from(_table(spark, sf, "events"))


def _iso(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def _text(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(column)


def _rounded(column: str) -> Column:
    return F.round(F.col(column), DIGITS).alias(column)


def _click_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks in the four-column text form of the clickstream files."""
    return _clicks(spark, sf).select(
        _iso("event_time").alias("timestamp"),
        F.col("user_id").cast("string").alias("user_id"),
        "product_id",
        "event_type",
    )


def _users(spark: SparkSession, sf: str) -> DataFrame:
    first = (
        _table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg(F.min("o_orderdate").alias("first_order"))
    )
    return first.select(
        "user_id", F.date_format("first_order", "yyyy-MM-dd").alias("signup_date")
    )


def _users_text(spark: SparkSession, sf: str) -> DataFrame:
    customers = _table(spark, sf, "customer")
    return (
        _users(spark, sf)
        .join(customers, F.col("user_id") == F.col("c_custkey"))
        .select(
            F.col("user_id").cast("string"),
            F.col("c_name").alias("name"),
            "signup_date",
            F.to_json(F.array("c_acctbal", F.col("c_nationkey").cast("double"))).alias("features"),
        )
    )


def _products_text(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat_ws(", ", "p_name", "p_type").alias("product_name"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").cast("string").alias("price"),
        F.to_json(F.array("p_retailprice", F.col("p_size").cast("double"))).alias("features"),
    )


def _vectors(spark: SparkSession, sf: str, id_col: str, vector_col: str, text_id: bool = False):
    key = F.col("vec_id").cast("string") if text_id else F.col("vec_id")
    return _table(spark, sf, "embeddings").select(
        key.alias(id_col), F.col("embedding").cast("array<double>").alias(vector_col)
    )


def _embedding_model(spark: SparkSession, sf: str) -> factor_model.FactorModel:
    """A factor model whose users and items are the given vectors."""
    users = _vectors(spark, sf, "user_id", "factor")
    items = _vectors(spark, sf, "product_id", "factor", text_id=True)
    meta = {
        "model_type": "factor",
        "n_users": users.count(),
        "n_items": items.count(),
        "n_factors": users.select(F.size("factor")).first()[0],
        "epochs_completed": 0,
        "normalized": False,
    }
    return factor_model.FactorModel(users, items, meta)


def _embedding_sequence_model(spark: SparkSession, sf: str) -> sequence_model.SequenceModel:
    """A sequence model whose items are the given vectors, plus a constant padding row."""
    base = _embedding_model(spark, sf)
    n_factors = base.metadata["n_factors"]
    padding = spark.createDataFrame(
        [(click_fn.PAD, [PAD_VALUE] * n_factors)], "product_id string, factor array<double>"
    )
    return sequence_model.SequenceModel(
        base.items.unionByName(padding),
        base.users.select("user_id"),
        vectors.position_weights(sequences.SEQUENCE_LENGTH),
        {
            "model_type": "given",
            "sequence_length": sequences.SEQUENCE_LENGTH,
            "n_factors": n_factors,
            "n_users": base.metadata["n_users"],
            "n_items": base.metadata["n_items"] + 1,
            "final_loss": 0.0,
        },
    )


def _table_name(label: str) -> str:
    return f"clickloom_{label}_{uuid.uuid4().hex}"


# --------------------------------------------------------------------------
# Fraud windows
# --------------------------------------------------------------------------


def q_fraud_windows(spark, sf):
    found = fraud_windows(_clicks(spark, sf), WINDOW, THRESHOLD)
    return found.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_fraud_windows_short(spark, sf):
    """The default 10 s windows; the test events are sparse, so every window counts."""
    found = fraud_windows(_clicks(spark, sf), threshold=0)
    return found.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_fraud_windows_counted(spark, sf):
    """Counts one column and not rows: only failed events add up."""
    failed = _clicks(spark, sf).withColumn(
        "failed", F.when(F.col("event_type") == "error", F.col("user_id"))
    )
    found = fraud_windows(failed, WINDOW, 1, count_col="failed")
    return found.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def _event_stream(spark: SparkSession, sf: str) -> DataFrame:
    schema = _table(spark, sf, "events").schema
    return _clicks_from(
        spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    )


def q_fraud_windows_stream(spark, sf):
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-checkpoint")
    query = jobs.start_fraud_stream(
        _event_stream(spark, sf), out, checkpoint, drain=True, window=WINDOW, threshold=THRESHOLD
    )
    query.awaitTermination()
    alerts = spark.read.parquet(out)
    return alerts.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_fraud_windows_json_stream(spark, sf):
    """The alerts again, from a watched folder of JSON lines."""
    path = scratch_path(spark, "json-stream")
    _click_lines(spark, sf).write.json(path)
    events = readers.read_clickstream_stream(spark, path)
    out, checkpoint = scratch_path(spark, "alerts"), scratch_path(spark, "alerts-checkpoint")
    jobs.start_fraud_stream(
        events, out, checkpoint, drain=True, window=WINDOW, threshold=THRESHOLD
    ).awaitTermination()
    alerts = spark.read.parquet(out)
    return alerts.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_two_sinks_stream(spark, sf):
    """One stream, two sinks: alerts and recommendations per user."""
    lists = recommend.user_lists(_embedding_model(spark, sf), digits=DIGITS)
    path = scratch_path(spark, "two-sinks")
    for query in jobs.start_fraud_and_recommendations(
        _event_stream(spark, sf), materialize(lists, "user-lists"), path, f"{path}-checkpoint",
        drain=True, hot_users=hot_keys(_clicks(spark, sf), "user_id", min_rows=100),
        window=WINDOW, threshold=THRESHOLD,
    ):
        query.awaitTermination()
    parts = [
        spark.read.parquet(f"{path}/{sink}").select(F.lit(sink).alias("sink"), "user_id")
        for sink in ("fraud_attempts", "user_recommendations")
    ]
    return parts[0].unionByName(parts[1]).groupBy("sink", "user_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def q_fan_out_stream(spark, sf):
    """Both sinks again, from one read of the stream."""
    lists = recommend.user_lists(_embedding_model(spark, sf), digits=DIGITS)
    path = scratch_path(spark, "fan-out")
    fanout.start_fan_out(
        _event_stream(spark, sf), materialize(lists, "user-lists"), path, f"{path}-checkpoint",
        drain=True, hot_users=hot_keys(_clicks(spark, sf), "user_id", min_rows=100),
        window=WINDOW, threshold=THRESHOLD,
    ).awaitTermination()
    parts = [
        fanout.read_sink(spark, path, sink).select(F.lit(sink).alias("sink"), "user_id")
        for sink in (fanout.ALERTS, fanout.RECOMMENDATIONS)
    ]
    return parts[0].unionByName(parts[1]).groupBy("sink", "user_id").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


def _in_batches(spark: SparkSession, sf: str, parts: list[Column], recs, between=None, **options):
    """Run a fan-out over the clicks, one micro-batch per part, and return its path."""
    source, path = scratch_path(spark, "batches"), scratch_path(spark, "fan-out")
    clicks = _clicks(spark, sf)
    for number, part in enumerate(parts):
        if between:
            between(number)
        clicks.where(part).write.mode("append").parquet(source)
        events = spark.readStream.schema(clicks.schema).parquet(source)
        fanout.start_fan_out(
            events, recs, path, f"{path}-checkpoint", drain=True, keep=("event_id",),
            window=WINDOW, threshold=THRESHOLD, **options,
        ).awaitTermination()
    return path


def _late_errors(spark: SparkSession, sf: str) -> str:
    """Three batches: what came before the cutover, then the rest; errors come last."""
    error = F.col("event_type") == "error"
    early = F.col("event_time") < F.lit(CUTOVER).cast("timestamp")
    lists = materialize(
        recommend.user_lists(_embedding_model(spark, sf), digits=DIGITS), "user-lists"
    )
    return _in_batches(spark, sf, [~error & early, ~error & ~early, error], lists)


def q_late_rows_stream(spark, sf):
    """Rows of windows that were closed when they came, with their number per batch."""
    path = _late_errors(spark, sf)
    late = fanout.read_sink(spark, path, fanout.LATE).select("event_id", "user_id", "batch")
    counted = fanout.progress(spark, path).select("batch_id", "n_rows", "n_late")
    return late.join(counted, F.col("batch") == F.col("batch_id")).drop("batch")


def q_late_alerts_stream(spark, sf):
    """The alerts of the same run: late rows do not count."""
    alerts = fanout.read_sink(spark, _late_errors(spark, sf), fanout.ALERTS)
    return alerts.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_swapped_lists_stream(spark, sf):
    """New lists are published between two batches of one stream."""
    model = _embedding_model(spark, sf)
    turned = factor_model.FactorModel(
        model.users.withColumn("factor", F.transform("factor", lambda x: -x)), model.items
    )
    published = scratch_path(spark, "published")

    def publish(number: int) -> None:
        lists = recommend.user_lists((model, turned)[number], digits=DIGITS)
        fanout.publish_lists(materialize(lists, "user-lists"), published)

    early = F.col("event_time") < F.lit(CUTOVER).cast("timestamp")
    path = _in_batches(spark, sf, [early, ~early], published, publish)
    found = fanout.read_sink(spark, path, fanout.RECOMMENDATIONS)
    return found.select(
        "event_id", "user_id", "product_id", "recommended_product_id", "score",
        F.col("batch").cast("long").alias("batch"),
    )


# --------------------------------------------------------------------------
# Scalars and parsing
# --------------------------------------------------------------------------


def q_event_time_parse(spark, sf):
    """Error events carry junk in front of their time."""
    junk = F.when(F.col("event_type") == "error", F.lit("t=")).otherwise(F.lit(""))
    rows = _clicks(spark, sf).withColumn("timestamp", F.concat(junk, _iso("event_time")))
    parsed = rows.withColumn("event_time", times.parse_event_time(F.col("timestamp")))
    return parsed.select("event_id", _text("event_time"))


def q_event_time_strict(spark, sf):
    """Views carry milliseconds only, purchases a zone letter; both miss the strict form."""
    iso = _iso("event_time")
    text = (
        F.when(F.col("event_type") == "view", F.substring(iso, 1, 23))
        .when(F.col("event_type") == "purchase", F.concat(iso, F.lit("Z")))
        .otherwise(iso)
    )
    rows = _clicks(spark, sf).withColumn("timestamp", text)
    parsed = rows.withColumn("event_time", times.parse_event_time(F.col("timestamp"), "strict"))
    return parsed.select("event_id", _text("event_time"))


def q_timestamp_normalize(spark, sf):
    """Views carry epoch seconds, errors junk, the rest ISO text."""
    epoch = (F.unix_micros("event_time").cast("decimal(20,0)") / F.lit(1_000_000)).cast(
        "decimal(20,6)"
    )
    text = (
        F.when(F.col("event_type") == "view", epoch.cast("string"))
        .when(F.col("event_type") == "error", F.lit("unknown"))
        .otherwise(_iso("event_time"))
    )
    rows = _clicks(spark, sf).withColumn("event_time", times.normalize_timestamp(text))
    return rows.select("event_id", _text("event_time"))


def q_feature_vectors(spark, sf):
    """Vector text to array, its length and its unit vector's first entry."""
    text = F.to_json(
        F.transform("embedding", lambda x: F.round(x.cast("double"), 6))
    )
    rows = _table(spark, sf, "embeddings").select(
        "vec_id", vectors.parse_vector(text).alias("features")
    )
    norm = vectors.l2_norm(F.col("features"))
    first = F.get(vectors.unit(F.col("features")), F.lit(0))
    return rows.select(
        "vec_id",
        F.size("features").cast("bigint").alias("n_dims"),
        F.round(norm, DIGITS).alias("norm"),
        F.round(first, DIGITS).alias("unit_first"),
    )


# --------------------------------------------------------------------------
# Sources, sinks and tables
# --------------------------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.option("header", "true").option("escape", '"').csv(path)
    return path


def q_etl_users(spark, sf):
    base = scratch_path(spark, "etl-users")
    source = _write_csv(_users_text(spark, sf), f"{base}/users.csv")
    users = etl.etl_users(spark, source, _table_name("users"), f"{base}/table")
    return users.select(
        "user_id",
        "name",
        F.date_format("signup_date", "yyyy-MM-dd").alias("signup_date"),
        F.get(vectors.parse_vector(F.col("features")), F.lit(0)).alias("first_feature"),
    )


def q_etl_products(spark, sf):
    base = scratch_path(spark, "etl-products")
    source = _write_csv(_products_text(spark, sf), f"{base}/products.csv")
    products = etl.etl_products(spark, source, _table_name("products"), f"{base}/table")
    return products.select(
        "product_id",
        "product_name",
        "category",
        "price",
        F.get(vectors.parse_vector(F.col("features")), F.lit(1)).alias("second_feature"),
    )


def q_csv_roundtrip(spark, sf):
    """Header, no schema: all columns come back as text."""
    path = _write_csv(_table(spark, sf, "customer"), scratch_path(spark, "csv"))
    rows = readers.read_csv(spark, path)
    return rows.withColumn("c_acctbal", F.round(F.col("c_acctbal").cast("double"), 2))


def q_csv_inferred(spark, sf):
    path = _write_csv(_table(spark, sf, "customer"), scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, infer=True)


def _write_clicks(spark: SparkSession, sf: str, label: str) -> str:
    path = scratch_path(spark, label)
    _click_lines(spark, sf).write.json(f"{path}/clickstream-all.json")
    return path


def q_json_roundtrip(spark, sf):
    path = _write_clicks(spark, sf, "json")
    rows = readers.read_clickstream(spark, f"{path}/clickstream-all.json")
    return rows.select("user_id", "product_id", "event_type", _text("event_time"))


def _broken_lines(spark: SparkSession, sf: str) -> str:
    """Clicks as JSON text: lines of error events are cut short, signups bring a blank line."""
    path = scratch_path(spark, "broken-json")
    line = F.to_json(F.struct("*"))
    _click_lines(spark, sf).select(
        F.when(F.col("event_type") == "error", F.substring(line, 1, 30))
        .when(F.col("event_type") == "signup", F.concat(line, F.lit("\n   ")))
        .otherwise(line)
        .alias("value")
    ).write.text(path)
    return path


def q_malformed_json(spark, sf):
    path = _broken_lines(spark, sf)
    rows = readers.read_clickstream(spark, path)
    return rows.select("user_id", "product_id", "event_type", _text("event_time"))


def q_clickstream_path_filter(spark, sf):
    """A mixed folder: named files, a folder named like one, and files of another kind."""
    base = scratch_path(spark, "mixed")
    lines = _click_lines(spark, sf)
    for kind, place in (
        ("view", "clickstream-1.json"),
        ("click", "2024/clickstream-2.json"),
        ("purchase", "other.json"),
    ):
        lines.filter(F.col("event_type") == kind).write.json(f"{base}/{place}")
    text = files.to_json_rows(lines.filter(F.col("event_type") == "error"))
    text.write.text(f"{base}/clickstream-3.txt")
    paths = [f"{base}/*", f"{base}/2024/*"]
    rows = readers.read_clickstream(spark, paths, path_pattern=readers.CLICKSTREAM_PATHS)
    return rows.select("user_id", "product_id", "event_type", _text("event_time"))


def q_staged_reread(spark, sf):
    """What staging and merging wrote, read back by the reader's defaults."""
    base = scratch_path(spark, "reread")
    _click_lines(spark, sf).write.json(f"{base}/in/clickstream-1.json")
    files.stage(spark, f"{base}/in", f"{base}/out", groups=("clickstream",))
    parts = [
        readers.read_clickstream(spark, f"{base}/out/clickstream/{place}").select(
            F.lit(place).alias("place"), "user_id", "product_id", _text("event_time")
        )
        for place in ("merged", "individual")
    ]
    return parts[0].unionByName(parts[1])


def q_training_bad_lines(spark, sf):
    """Lines a training run would read, and the broken ones that make it fail."""
    path = _broken_lines(spark, sf)
    good, bad = readers.count_lines(spark, path, schemas.CLICKSTREAM)
    return spark.createDataFrame([(good, bad)], "n_good long, n_broken long")


def q_input_fallback(spark, sf):
    """Of several places only the last holds input."""
    base = scratch_path(spark, "fallback")
    _click_lines(spark, sf).write.json(f"{base}/staged/clickstream-1.json")
    found = readers.first_existing(
        spark, [f"{base}/clickstream.json", f"{base}/new-*.json", f"{base}/staged/clickstream-*"]
    )
    rows = readers.read_clickstream(spark, found)
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))


def q_merge_report(spark, sf):
    """Two inputs of the same name in different folders, and what the merge says of them."""
    base = scratch_path(spark, "merge-report")
    lines = _click_lines(spark, sf)
    for kind in ("view", "error"):
        chosen = lines.filter(F.col("event_type") == kind)
        chosen.write.json(f"{base}/{kind}/clickstream-1.json")
    paths = [f"{base}/{kind}/clickstream-1.json" for kind in ("view", "error")]
    report = files.merge_clickstream(spark, paths, f"{base}/merged")
    kind = F.regexp_extract("source", r"/(view|error)/", 1).alias("kind")
    return report.groupBy(kind).agg(
        F.sum("records").alias("records"),
        F.first(F.array_join("sample_keys", ",")).alias("sample_keys"),
    )


def q_malformed_json_kept(spark, sf):
    path = _broken_lines(spark, sf)
    rows = readers.read_json_lines(spark, path, schemas.CLICKSTREAM, bad_records="null")
    return rows.groupBy(F.col(readers.CORRUPT).isNotNull().cast("int").alias("is_broken")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("event_type").alias("n_typed")
    )


def q_table_roundtrip(spark, sf):
    path = scratch_path(spark, "table")
    name = _table_name("customer")
    tables.write_table(_table(spark, sf, "customer"), name, path)
    return tables.read_table(spark, name)


def q_table_append(spark, sf):
    """A table made once with a fixed schema, then appended to twice."""
    name = _table_name("fraud_attempts")
    tables.ensure_table(spark, name, schemas.FRAUD_ATTEMPTS, scratch_path(spark, "fraud"))
    found = fraud_windows(_clicks(spark, sf), WINDOW, THRESHOLD).select(
        F.col("user_id").cast("string"), "window_start", "window_end", "event_count"
    )
    tables.append_table(found, name)
    tables.append_table(found, name)
    rows = tables.read_table(spark, name)
    return rows.select("user_id", _text("window_start"), _text("window_end"), "event_count")


def q_namespace_tables(spark, sf):
    """A table in a namespace of its own is listed until it is dropped."""
    before, namespace = spark.catalog.currentDatabase(), _table_name("space")
    tables.use_namespace(spark, namespace)
    try:
        rows = tables.write_table(
            _table(spark, sf, "customer"), "customers", scratch_path(spark, "space")
        ).count()
        known = tables.list_namespaces(spark).where(F.col("namespace") == namespace).count()
        listed = [r.tableName for r in tables.list_tables(spark).collect() if not r.isTemporary]
        tables.drop_table(spark, "customers")
        left = tables.list_tables(spark, namespace).where(~F.col("isTemporary")).count()
    finally:
        tables.use_namespace(spark, before, create=False)
        spark.sql(f"DROP NAMESPACE {namespace} CASCADE")
    return spark.createDataFrame(
        [(rows, known == 1 and listed == ["customers"], left)],
        "n_rows long, was_listed boolean, n_left long",
    )


def q_listed_files(spark, sf):
    """The files of a folder with some for each event type and others besides."""
    path = scratch_path(spark, "listing")
    lines = _click_lines(spark, sf)
    lines.write.partitionBy("event_type").json(path)
    lines.limit(1).write.csv(f"{path}/other")
    found = files.manifest(spark, path, "*.json")
    return found.groupBy(
        F.regexp_extract("path", "event_type=([a-z]+)/", 1).alias("event_type")
    ).agg((F.sum("length") > 0).alias("has_content"))


def q_new_files(spark, sf):
    """Files that came after the last look at a folder, and what they hold."""
    base = scratch_path(spark, "inbox")
    lines, seen = _click_lines(spark, sf), f"{base}/seen"
    first = F.col("event_type").isin("view", "click")
    lines.where(first).write.partitionBy("event_type").json(f"{base}/in")
    files.mark_seen(files.unseen_files(spark, f"{base}/in", seen), seen)
    lines.where(~first).write.mode("append").partitionBy("event_type").json(f"{base}/in")
    fresh = files.unseen_files(spark, f"{base}/in", seen, "*.json")
    kind = F.regexp_extract("path", "event_type=([a-z]+)/", 1).alias("event_type")
    rows = spark.read.schema(schemas.CLICKSTREAM).json(f"{base}/in")
    counted = rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n_rows"))
    return fresh.select(kind).distinct().join(counted, "event_type")


def q_table_replace(spark, sf):
    """A table is replaced while it is read, and then by a write that fails."""
    name, path = _table_name("customer"), scratch_path(spark, "table")
    customers = _table(spark, sf, "customer")
    tables.write_table(customers, name, path)
    began_before = tables.read_table(spark, name)
    tables.write_table(customers.where("c_acctbal > 0"), name, path)
    broken = customers.withColumn("c_name", F.raise_error(F.col("c_name")))
    try:
        tables.write_table(broken, name, path)
        failed = False
    except Exception:  # the write fails as it should
        failed = True
    parts = [("before", began_before), ("after", tables.read_table(spark, name))]
    counts = [
        rows.groupBy(F.lit(when).alias("reader"), "c_nationkey").agg(F.count("*").alias("n_rows"))
        for when, rows in parts
    ]
    return counts[0].unionByName(counts[1]).withColumn("replace_failed", F.lit(failed))


def q_sql_entry(spark, sf):
    return tables.run_sql(
        spark,
        """
        SELECT c_mktsegment, count(*) AS n_customers, max(c_acctbal) AS max_balance
        FROM clickloom_customers WHERE c_acctbal > 0 GROUP BY c_mktsegment
        """,
        clickloom_customers=_table(spark, sf, "customer"),
    )


def q_merge_clickstream(spark, sf):
    base = scratch_path(spark, "merge")
    lines = _click_lines(spark, sf)
    for kind in ("view", "click", "purchase", "error", "signup"):
        lines.filter(F.col("event_type") == kind).write.json(f"{base}/clickstream-{kind}.json")
    paths = files.matching(spark, f"{base}/clickstream-*.json")
    files.merge_clickstream(spark, paths, f"{base}/merged")
    rows = readers.read_json_lines(spark, f"{base}/merged", schemas.CLICKSTREAM)
    return rows.select("timestamp", "user_id", "product_id", "event_type")


def q_staged_records(spark, sf):
    base = scratch_path(spark, "stage")
    _write_csv(_users_text(spark, sf), f"{base}/in/users.csv")
    _write_csv(_products_text(spark, sf), f"{base}/in/products.csv")
    _click_lines(spark, sf).write.json(f"{base}/in/clickstream-1.json")
    report = files.stage(spark, f"{base}/in", f"{base}/out")
    place = F.substring_index("path", "/", -1).alias("place")
    return report.groupBy("artifact", place).agg(F.sum("records").alias("records"))


def q_archived_records(spark, sf):
    """New data is counted where it waits, moved to the archive and counted there."""
    base = scratch_path(spark, "archive")
    staged = f"{base}/clickstream_new.json"
    _click_lines(spark, sf).write.json(staged)
    waiting = files.check_new_data(spark, staged)
    moved = files.archive(spark, staged, f"{base}/archive")
    left = files.check_new_data(spark, staged)
    listed = files.list_archives(spark, f"{base}/archive").count()
    archived = readers.read_json_lines(spark, moved, schemas.CLICKSTREAM)
    return archived.agg(
        F.lit(waiting).cast("bigint").alias("waiting"),
        F.lit(left or 0).cast("bigint").alias("left_over"),
        F.lit(listed).cast("bigint").alias("archives"),
        F.count(F.lit(1)).alias("archived"),
        F.count_distinct("user_id").alias("users"),
    )


def q_json_rows(spark, sf):
    return files.to_json_rows(
        _table(spark, sf, "customer").select(
            "c_custkey", "c_name", "c_nationkey", "c_mktsegment",
            F.round("c_acctbal", 2).cast("decimal(12,2)").cast("string").alias("c_acctbal"),
        )
    )


def q_inspect_events(spark, sf):
    """The first 20 events, raw time next to parsed time."""
    rows = _clicks(spark, sf).withColumn("timestamp", _iso("event_time"))
    first = rows.orderBy("event_time", "event_id").limit(20)
    parsed = first.withColumn("event_time", times.parse_event_time(F.col("timestamp")))
    return parsed.select("event_id", "timestamp", _text("event_time"))


# --------------------------------------------------------------------------
# Signups, keys and set operations
# --------------------------------------------------------------------------


def _fraud(spark: SparkSession, sf: str) -> DataFrame:
    return fraud_windows(_clicks(spark, sf), WINDOW, THRESHOLD)


def q_legit_signups_by_month(spark, sf):
    return signups.legit_signups_by_month(_users(spark, sf), _fraud(spark, sf))


def q_legit_signups_json(spark, sf):
    path = scratch_path(spark, "signups")
    signups.export_signups(_users(spark, sf), _fraud(spark, sf), path)
    return readers.read_json_lines(spark, path, schemas.SIGNUP_COUNTS)


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    clicks = _clicks(spark, sf)
    late = F.col("event_time") >= F.lit(CUTOVER).cast("timestamp")
    return clicks.filter(~late), clicks.filter(late)


def q_new_users(spark, sf):
    """Ordering customers that never clicked."""
    orders = _table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"))
    return keys.new_keys(orders, _clicks(spark, sf), "user_id")


def q_new_items(spark, sf):
    """Clicked user-product pairs of the later half that the earlier half lacks."""
    pair = F.concat_ws("|", F.col("user_id").cast("string"), "product_id").alias("pair")
    early, late = _halves(spark, sf)
    return keys.new_keys(late.select(pair), early.select(pair), "pair")


def q_events_union(spark, sf):
    early, late = _halves(spark, sf)
    both = keys.append(early.drop("event_type"), late)
    return both.select("event_id", "user_id", "product_id", "event_type")


def q_distinct_counts(spark, sf):
    return keys.count_distinct(_clicks(spark, sf), "user_id", "product_id")


def q_user_index(spark, sf):
    """Dense ids of users: as many as users, from 0 without gaps."""
    return dense_index(_clicks(spark, sf), "user_id").agg(
        F.count_distinct("user_id").alias("n_users"),
        F.count_distinct("index").alias("n_ids"),
        F.min("index").alias("first_id"),
        F.max("index").alias("last_id"),
    )


# --------------------------------------------------------------------------
# Ratings
# --------------------------------------------------------------------------


def _ratings(spark: SparkSession, sf: str) -> DataFrame:
    return ratings.build_ratings(_clicks(spark, sf), WEIGHTS)


def q_ratings_raw(spark, sf):
    return _ratings(spark, sf)


def q_rating_stats(spark, sf):
    stats = ratings.rating_stats(materialize(_ratings(spark, sf), "ratings"))
    return stats.select(
        "n_ratings",
        "rating_min",
        "rating_max",
        _rounded("rating_mean"),
        "rating_median",
        _rounded("rating_std"),
    )


def q_value_stats(spark, sf):
    """Values that hardly repeat, so the median is found among many ranges."""
    prices = _table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("rating"))
    stats = ratings.rating_stats(prices)
    return stats.select(
        "n_ratings", "rating_min", "rating_max", F.round("rating_mean", 2).alias("rating_mean"),
        "rating_median", F.round("rating_std", 2).alias("rating_std"),
    )


def q_ratings_normalized(spark, sf):
    scaled = ratings.normalize_ratings(_ratings(spark, sf))
    return scaled.select("user_id", "product_id", _rounded("rating"))


def q_ratings_train(spark, sf):
    train, _ = ratings.split(ratings.normalize_ratings(_ratings(spark, sf)))
    return train.select("user_id", "product_id", _rounded("rating"))


def q_ratings_test(spark, sf):
    _, test = ratings.split(ratings.normalize_ratings(_ratings(spark, sf)))
    return test.select("user_id", "product_id", _rounded("rating"))


def q_mean_baseline_error(spark, sf):
    train, test = ratings.split(ratings.normalize_ratings(_ratings(spark, sf)))
    errors = metrics.error_metrics(metrics.mean_baseline(train, test))
    return errors.select(_rounded("rmse"), _rounded("mae"), "n")


# --------------------------------------------------------------------------
# Click sequences
# --------------------------------------------------------------------------


def _sequences(spark: SparkSession, sf: str) -> DataFrame:
    return sequences.click_sequences(_clicks(spark, sf), tie_cols=("event_id",))


def q_click_sequences(spark, sf):
    return _sequences(spark, sf).select(
        "event_id", "user_id", F.concat_ws(",", "sequence").alias("sequence"), "target"
    )


def _hot_clicks(spark: SparkSession, sf: str) -> DataFrame:
    """Clicks where user 0 holds half of the rows, most of them at one instant or without time."""
    kind = F.col("event_id") % 6
    time = (
        F.when(kind == 0, F.lit("2024-01-05 00:00:00").cast("timestamp"))
        .when(kind == 1, F.lit(None))
        .otherwise(F.col("event_time"))
    )
    return _clicks(spark, sf).select(
        "event_id",
        F.when(kind < 3, F.lit(0)).otherwise(F.col("user_id")).cast("long").alias("user_id"),
        "product_id",
        time.alias("event_time"),
    )


def q_click_sequences_hot(spark, sf):
    found = sequences.click_sequences(
        _hot_clicks(spark, sf), tie_cols=("event_id",), hot_rows=1_000
    )
    return found.select(
        "event_id", "user_id", F.array_join("sequence", ",").alias("sequence"), "target"
    )


def q_click_sequences_alike(spark, sf):
    """A bot clicks one product at one instant, without event ids, once per error event."""
    bot = F.col("event_type") == "error"
    clicks = _clicks(spark, sf).select(
        F.when(bot, F.lit(-1)).otherwise(F.col("user_id")).cast("long").alias("user_id"),
        F.when(bot, F.lit("0")).otherwise(F.col("product_id")).alias("product_id"),
        F.when(bot, F.lit("2024-01-05 00:00:00").cast("timestamp"))
        .otherwise(F.col("event_time")).alias("event_time"),
    )
    found = sequences.click_sequences(clicks, hot_rows=200)
    return found.select(
        "user_id", "product_id", F.array_join("sequence", ",").alias("sequence"), "target"
    )


def q_click_sequences_long(spark, sf):
    """Sequences of at most three clicks from histories that are longer."""
    found = sequences.click_sequences(_clicks(spark, sf), 3, tie_cols=("event_id",))
    return found.select(
        "event_id", "user_id", F.array_join("sequence", ",").alias("sequence"), "target"
    )


def q_recent_clicks(spark, sf):
    recent = sequences.recent_clicks(_clicks(spark, sf), 5, tie_cols=("event_id",))
    return recent.select("user_id", F.concat_ws(",", "click_sequence").alias("click_sequence"))


def q_sequence_encoding(spark, sf):
    """Encoded sequences against their targets: logit, probability and loss."""
    model = _embedding_sequence_model(spark, sf)
    found = materialize(
        _sequences(spark, sf).select(
            F.col("event_id").alias("request_id"),
            F.col("sequence").alias("click_sequence"),
            F.col("target").alias("product_id"),
        ),
        "sequences",
    )
    encoded = encode_sequences(
        found, model.items, model.weights, keep=("product_id",), score="product_id"
    )
    scored = (
        encoded.where("score IS NOT NULL")
        .select(F.col("request_id").alias("event_id"), "score")
        .withColumn("probability", vectors.sigmoid(F.col("score")))
        .withColumn("loss", vectors.log_loss(F.col("probability")))
    )
    return scored.select(
        "event_id", _rounded("score"), _rounded("probability"), _rounded("loss")
    )


# --------------------------------------------------------------------------
# Top-N, affinity, predictions, serving
# --------------------------------------------------------------------------


def _ranked(df: DataFrame, *ids: str) -> DataFrame:
    return df.select(*ids, F.col("rank").cast("bigint").alias("rank"), "score")


def q_recommend_top_n(spark, sf):
    """Every user against every item, without what the user clicked."""
    seen = _clicks(spark, sf).select("user_id", "product_id")
    found = factor_model.recommend_top_n(
        _embedding_model(spark, sf), n=5, exclude=seen, digits=DIGITS
    )
    return _ranked(found, "user_id", "product_id")


def q_sample_recommendations(spark, sf):
    """A glance at a model: the first three users, five products each."""
    seen = _clicks(spark, sf).select("user_id", "product_id")
    model = _embedding_model(spark, sf)
    return _ranked(
        factor_model.sample_recommendations(model, seen), "user_id", "product_id"
    ).withColumn("score", _rounded("score"))


def _affinity_inputs(spark: SparkSession, sf: str):
    users = _vectors(spark, sf, "user_id", "features")
    products = _vectors(spark, sf, "product_id", "features")
    touched = _clicks(spark, sf).filter(F.col("event_type").isin("view", "click", "purchase"))
    last = sequences.recent_clicks(touched, 1, tie_cols=("event_id",))
    context = last.select(
        "user_id", F.get("click_sequence", F.lit(0)).cast("bigint").alias("product_id")
    )
    return users, products, context


def q_affinity_top_k(spark, sf):
    users, products, context = _affinity_inputs(spark, sf)
    found = affinity.affinity_top_k(users, products, context, k=5, digits=DIGITS)
    return found.select(
        "user_id", "product_id", F.col("rank").cast("bigint").alias("rank"), "score",
        _rounded("probability"),
    )


def q_affinity_top_k_excluding(spark, sf):
    """Without context; clicked products are no candidates."""
    users, products, _ = _affinity_inputs(spark, sf)
    seen = _clicks(spark, sf).select("user_id", "product_id")
    found = affinity.affinity_top_k(users, products, k=5, exclude=seen, digits=DIGITS)
    return found.select(
        "user_id", "product_id", F.col("rank").cast("bigint").alias("rank"), "score",
        _rounded("probability"),
    )


def _order_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered (customer, part) pairs; many have no vector and predict 0.0."""
    lines = _table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = _table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(
            F.col("o_custkey").alias("user_id"),
            F.col("l_partkey").cast("string").alias("product_id"),
        )
        .agg(F.sum("l_quantity").alias("rating"))
    )


def q_predict_pairs(spark, sf):
    pairs = materialize(_order_pairs(spark, sf), "pairs")  # hot keys are looked for twice
    scored = factor_model.predict(
        _embedding_model(spark, sf), pairs,
        hot_users=hot_keys(pairs, "user_id"), hot_items=hot_keys(pairs, "product_id"),
    )
    return scored.select("user_id", "product_id", _rounded("prediction"))


def q_prediction_errors(spark, sf):
    pairs = materialize(_order_pairs(spark, sf), "pairs")
    errors = factor_model.evaluate(_embedding_model(spark, sf), pairs)
    return errors.select(_rounded("rmse"), _rounded("mae"), "n")


def q_event_recommendations(spark, sf):
    found = recommend.event_recommendations(
        _clicks(spark, sf), _embedding_model(spark, sf), keep=("event_id",), digits=DIGITS
    )
    return found.select("event_id", "user_id", "product_id", "recommended_product_id", "score")


def q_event_recommendations_sql(spark, sf):
    """The same through SQL: a lateral call of the registered table function."""
    lists = recommend.user_lists(_embedding_model(spark, sf), digits=DIGITS)
    recommend.register_lateral(materialize(lists, "user-lists"), "clickloom_recommendations")
    return tables.run_sql(
        spark,
        """
        SELECT e.event_id, e.user_id, e.product_id, r.recommended_product_id, r.score
        FROM clickloom_events e,
             LATERAL clickloom_recommendations(e.user_id, e.product_id) r
        """,
        clickloom_events=_clicks(spark, sf),
    )


def q_event_recommendations_udtf(spark, sf):
    """The same through a table function over any rows that carry their user's list."""
    clicks = _clicks(spark, sf).select("event_id", "user_id", "product_id")
    lists = recommend.user_lists(_embedding_model(spark, sf), digits=DIGITS)
    recommend.register_table_function(
        materialize(lists, "user-lists"), clicks.schema, "clickloom_recommend_for"
    )
    return tables.run_sql(
        spark,
        """
        SELECT * FROM clickloom_recommend_for(TABLE(
          SELECT e.event_id, e.user_id, e.product_id, l.recs
          FROM clickloom_events e JOIN clickloom_recommend_for_lists l USING (user_id)), 5)
        """,
        clickloom_events=clicks,
    )


def q_event_recommendations_stream(spark, sf):
    model = _embedding_model(spark, sf)
    clicks = _clicks(spark, sf)
    lists = recommend.user_lists(model, digits=DIGITS)
    out, checkpoint = scratch_path(spark, "recs"), scratch_path(spark, "recs-checkpoint")
    query = jobs.start_recommendation_stream(
        _event_stream(spark, sf),
        materialize(lists, "user-lists"),
        out,
        checkpoint,
        keep=("event_id",),
        hot_users=hot_keys(clicks, "user_id"),
        drain=True,
    )
    query.awaitTermination()
    found = spark.read.parquet(out)
    return found.select("event_id", "user_id", "product_id", "recommended_product_id", "score")


def _requests(spark: SparkSession, sf: str) -> DataFrame:
    """One request per event: errors miss the user, signups have an empty one."""
    kind = F.col("event_type")
    user = F.when(kind == "signup", F.lit("")).when(
        kind != "error", F.col("user_id").cast("string")
    )
    return _clicks(spark, sf).select(
        F.col("event_id").alias("request_id"),
        user.alias("user_id"),
        F.when(kind == "view", F.lit(3)).alias("n"),
        F.array("product_id").alias("exclude_products"),
    )


def _answers(responses: DataFrame) -> DataFrame:
    return responses.select(
        "request_id",
        "user_id",
        F.col("metadata.n_items").alias("n_items"),
        "error",
        F.posexplode_outer("recommendations").alias("place", "rec"),
    ).select(
        "request_id",
        "user_id",
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        "error",
        F.coalesce(F.col("place") + 1, F.lit(0)).cast("bigint").alias("rank"),
        F.col("rec.product_id").alias("product_id"),
        F.col("rec.score").alias("score"),
    )


def q_serve_batch(spark, sf):
    model = _embedding_model(spark, sf)
    model.users = model.users.withColumn("user_id", F.col("user_id").cast("string"))
    requests = materialize(_requests(spark, sf), "requests")
    return _answers(recommend.serve_batch(requests, model, digits=DIGITS))


def q_serve_stream(spark, sf):
    """The requests of ``serve_batch`` from a stream."""
    model = _embedding_model(spark, sf)
    model.users = model.users.withColumn("user_id", F.col("user_id").cast("string"))
    source, out = scratch_path(spark, "requests"), scratch_path(spark, "responses")
    _requests(spark, sf).write.parquet(source)
    requests = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
    with recommend.Scorer(model, digits=DIGITS) as scorer:
        jobs.start_serving_stream(
            requests, scorer, out, f"{out}-checkpoint", drain=True
        ).awaitTermination()
    return _answers(spark.read.parquet(out).drop("batch"))


def q_recommend_from_sequence(spark, sf):
    recent = sequences.recent_clicks(_clicks(spark, sf), tie_cols=("event_id",))
    requests = materialize(recent.withColumnRenamed("user_id", "request_id"), "requests")
    found = sequence_model.recommend_from_sequence(
        _embedding_sequence_model(spark, sf), requests, n=5, digits=DIGITS
    )
    return _ranked(found.withColumnRenamed("request_id", "user_id"), "user_id", "product_id")


def q_recommend_unknown_sequences(spark, sf):
    """Clicks on nothing the model knows: every product ties, the smallest ids win."""
    users = _clicks(spark, sf).select("user_id").distinct()
    requests = users.select(
        F.col("user_id").alias("request_id"), F.array(F.lit("unknown")).alias("click_sequence")
    )
    model = _embedding_sequence_model(spark, sf)
    model = sequence_model.SequenceModel(
        model.items.withColumn(
            "factor",
            F.when(
                F.col("product_id") == click_fn.PAD, F.transform("factor", lambda x: x * 0)
            ).otherwise(F.col("factor")),
        ),
        model.users, model.weights, model.metadata,
    )
    found = sequence_model.recommend_from_sequence(model, materialize(requests, "requests"), n=5)
    return _ranked(found.withColumnRenamed("request_id", "user_id"), "user_id", "product_id")


def q_serve_sequence_batch(spark, sf):
    """Users of orders ask with their last three clicks; customers without clicks cannot."""
    recent = sequences.recent_clicks(_clicks(spark, sf), 3, tie_cols=("event_id",))
    customers = _table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"))
    requests = customers.join(recent, "user_id", "left").select(
        F.col("user_id").alias("request_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.lit(None).cast("int").alias("n"),
        F.col("click_sequence").alias("exclude_products"),
        "click_sequence",
    )
    model = _embedding_sequence_model(spark, sf)
    served = recommend.serve_sequence_batch(
        materialize(requests, "requests"), model, digits=DIGITS
    )
    return _answers(served)


# --------------------------------------------------------------------------
# Trained models
# --------------------------------------------------------------------------


def _trained_factors(spark: SparkSession, sf: str):
    return factor_model.train_factor_model(_clicks(spark, sf), WEIGHTS)


def q_model_info(spark, sf):
    """Metadata of a stored model, read back."""
    path = scratch_path(spark, "model")
    factor_model.save_model(_embedding_model(spark, sf), path)
    info = model_info(spark, path, schemas.FACTOR_MODEL_METADATA)
    return info.select("model_type", "n_users", "n_items", "n_factors", "normalized")


def q_model_roundtrip(spark, sf):
    path = scratch_path(spark, "model")
    factor_model.save_model(_embedding_model(spark, sf), path)
    items = factor_model.load_model(spark, path).items
    norm = vectors.l2_norm(F.col("factor"))
    return items.select("product_id", F.round(norm, DIGITS).alias("norm"))


def q_mf_metrics(spark, sf):
    """Counts and bounds of a trained model, and that it predicts no worse than the mean."""
    model, train = _trained_factors(spark, sf)
    path = scratch_path(spark, "model")
    factor_model.save_model(model, path)
    info = model_info(spark, path, schemas.FACTOR_MODEL_METADATA)
    _, test = ratings.split(ratings.normalize_ratings(_ratings(spark, sf)))
    constant = test.withColumn("prediction", F.lit(model.metadata["rating_offset"]))
    mean_rmse = metrics.error_metrics(constant).first()["rmse"]
    return info.select(
        "model_type", "n_users", "n_items", "n_factors", "training_samples", "test_samples",
        "epochs_completed", "rating_min", "rating_max", "normalized",
        _rounded("rating_offset"),
        (F.col("rmse") <= F.lit(mean_rmse * 1.005)).alias("as_good_as_mean"),
    )


def _list_facts(found: DataFrame, unwanted: DataFrame, items: DataFrame) -> DataFrame:
    """Per user: length of the list, whether it is in order, known and free of unwanted items."""
    pair = ["user_id", "product_id"]
    marked = (
        found.join(unwanted.select(*pair).distinct().withColumn("_bad", F.lit(1)), pair, "left")
        .join(items.select("product_id", F.lit(1).alias("_known")), "product_id", "left")
    )
    entry = F.struct("rank", -F.col("score"), "product_id")
    best = F.struct(-F.col("score"), "product_id")
    listed = lambda e: F.transform(F.sort_array(F.collect_list(e)), lambda x: x["product_id"])
    return marked.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        (listed(entry) == listed(best)).alias("in_order"),
        F.count("_bad").alias("n_unwanted"),
        F.count("_known").alias("n_known"),
    )


def q_mf_top_n(spark, sf):
    """Facts about each user's list that hold for any trained vectors."""
    model, train = _trained_factors(spark, sf)
    found = factor_model.recommend_top_n(
        model, n=5, exclude=train.select("user_id", "product_id")
    )
    return _list_facts(found, train, model.items)


def q_mf_early_stopping(spark, sf):
    """Iteration counts are tried in order until the error no longer falls; the best one is kept."""
    scaled = materialize(ratings.normalize_ratings(_ratings(spark, sf)), "ratings")
    train, test = ratings.split(scaled)
    grid, patience = (1, 2, 4), 1
    model, history = factor_model.train_with_early_stopping(train, test, grid, patience)
    errors = [rmse for _, rmse in history]
    best = next(e for e, rmse in history if rmse == min(errors))
    rose = next((i for i in range(1, len(errors)) if errors[i] >= min(errors[:i]) - 1e-4), None)
    stops = len(errors) == (len(grid) if rose is None else rose + 1)
    facts = (
        [e for e, _ in history] == list(grid[: len(history)]),
        stops,
        abs(dict(history)[model.metadata["epochs_completed"]] - dict(history)[best]) <= 1e-4,
    )
    counts = train.select(F.lit("train").alias("part")).unionByName(
        test.select(F.lit("test").alias("part"))
    )
    return counts.groupBy("part").agg(F.count(F.lit(1)).alias("n_ratings")).select(
        "part", "n_ratings",
        *[F.lit(f).alias(n) for f, n in zip(facts, ("tried_in_order", "stopped_in_time", "kept_best"))],
    )


STEP = {"lr": 0.02, "reg": 0.05}


def _epoch_from_given(spark: SparkSession, sf: str) -> factor_model.FactorModel:
    """One epoch from the given vectors, as one step over all ratings of known ids."""
    given = _embedding_model(spark, sf)
    rated = _ratings(spark, sf).join(given.users, "user_id", "left_semi")
    rated = rated.join(given.items, "product_id", "left_semi")
    return factor_model.train_by_rotation(
        materialize(rated, "ratings"), epochs=1, start=given, blocks=1, batch=1 << 40, **STEP
    )


def q_mf_epoch_history(spark, sf):
    """The error that the first epoch meets, from given vectors."""
    model = _epoch_from_given(spark, sf)
    return factor_model.training_history(model).select(
        "epoch",
        _rounded("rmse"),
        F.lit(model.metadata["training_samples"]).cast("long").alias("n_ratings"),
    )


def q_mf_epoch_vectors(spark, sf):
    """Every vector's length after that epoch."""
    model = _epoch_from_given(spark, sf)
    norm = F.round(vectors.l2_norm(F.col("factor")), DIGITS).alias("norm")
    users = model.users.select(
        F.lit("user").alias("kind"), F.col("user_id").cast("string").alias("id"), norm
    )
    items = model.items.select(F.lit("item").alias("kind"), F.col("product_id").alias("id"), norm)
    return users.unionByName(items)


# Rates at which the loss falls on the test tables.
SEQ_TRAINING = {"lr": 0.3, "reg": 0.0001, "epochs": 4, "patience": None}


def _trained_sequences(spark: SparkSession, sf: str, events: DataFrame | None = None):
    return sequence_model.train_sequence_model(
        _clicks(spark, sf) if events is None else events, tie_cols=("event_id",), **SEQ_TRAINING
    )


def _sequence_epoch(spark: SparkSession, sf: str, **training) -> sequence_model.SequenceModel:
    """One epoch from the given vectors, with one step per worker."""
    clicks = _clicks(spark, sf)
    given = _embedding_sequence_model(spark, sf)
    given.metadata |= {
        "seed": 42, "learning_rate": 0.01, "regularization": 0.0, "history": [],
        "total_training_samples": 0,
    }
    known = clicks.join(given.items.select("product_id"), "product_id", "left_semi")
    return sequence_model.update_sequence_model(
        given, known, epochs=1, decay=1.0, tie_cols=("event_id",), batch=1 << 40, **training
    )


def q_seq_epoch_vectors(spark, sf):
    """Every item's and the position weights' length after three workers' steps are averaged."""
    model = _sequence_epoch(spark, sf, workers=3, deal_by="event_id")
    norm = F.round(vectors.l2_norm(F.col("factor")), DIGITS).alias("norm")
    weights = spark.createDataFrame(
        [("weights", model.weights)], "product_id string, factor array<double>"
    )
    return model.items.unionByName(weights).select("product_id", norm)


def q_seq_train_history(spark, sf):
    """From the given vectors, with one step per worker: the first epoch's loss is known."""
    model = _sequence_epoch(spark, sf)
    history = sequence_model.training_history(model)
    learned = _trained_sequences(spark, sf).metadata["history"]
    return history.select(
        "epoch",
        _rounded("loss"),
        F.lit(model.metadata["total_training_samples"]).cast("long").alias("n_clicks"),
        F.lit(all(b < a for a, b in zip(learned, learned[1:]))).alias("loss_falls"),
    )


def q_seq_top_n(spark, sf):
    """Facts about each user's list that hold for any trained vectors."""
    recent = sequences.recent_clicks(_clicks(spark, sf), tie_cols=("event_id",))
    requests = materialize(recent.withColumnRenamed("user_id", "request_id"), "requests")
    model = _trained_sequences(spark, sf)
    found = sequence_model.recommend_from_sequence(model, requests, n=5)
    padding = requests.select(
        F.col("request_id").alias("user_id"), F.lit(click_fn.PAD).alias("product_id")
    )
    return _list_facts(found.withColumnRenamed("request_id", "user_id"), padding, model.items)


def q_seq_incremental(spark, sf):
    """Train on the earlier half, store, load, update with the later half."""
    early, late = _halves(spark, sf)
    path = scratch_path(spark, "model")
    sequence_model.save_model(_trained_sequences(spark, sf, early), path)
    updated = sequence_model.update_sequence_model(
        sequence_model.load_model(spark, path), late, tie_cols=("event_id",)
    )
    sequence_model.save_model(updated, path)
    info = model_info(spark, path, schemas.SEQUENCE_MODEL_METADATA)
    return info.select(
        "model_type", "n_users", "n_items", "n_factors", "sequence_length",
        "epochs_completed", "training_mode", "total_training_samples",
        (F.element_at("history", SEQ_TRAINING["epochs"]) < F.get("history", F.lit(0))).alias(
            "first_run_learned"
        ),
        (F.element_at("history", -1) < F.get("history", F.lit(0))).alias("update_kept_it"),
    )


def q_retraining_runs(spark, sf):
    """Full run over the earlier half, incremental run over the later half, idle run."""
    base = scratch_path(spark, "retraining")
    early, late = (
        half.select(
            _iso("event_time").alias("timestamp"),
            F.col("user_id").cast("string").alias("user_id"),
            "product_id",
            "event_type",
        )
        for half in _halves(spark, sf)
    )
    early.write.json(f"{base}/clickstream.json")
    late.write.json(f"{base}/clickstream_new.json")
    reports = [
        retraining.run_training(
            spark,
            f"{base}/clickstream.json",
            f"{base}/model",
            incremental=True,
            new_path=f"{base}/clickstream_new.json",
            archive_dir=f"{base}/archive",
        )
        for _ in range(3)
    ]
    rows = [
        (r["mode"], r["n_users"], r["n_items"], r["total_training_samples"]) for r in reports
    ]
    return spark.createDataFrame(rows, "mode string, n_users long, n_items long, n_samples long")


# --------------------------------------------------------------------------
# SQL equivalents
# --------------------------------------------------------------------------

_CLICKS = """clicks AS (
  SELECT event_id, user_id, json_extract_string(props, '$.k') AS product_id, event_type,
         ts AS event_time
  FROM events)"""

_STAMP = "'%Y-%m-%d %H:%M:%S.%f'"

_ALERTS = """alerts AS (
  SELECT user_id, time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') AS window_start,
         count(*) AS event_count
  FROM clicks GROUP BY 1, 2 HAVING count(*) > 5)"""

_ALERT_COLUMNS = f"""user_id, strftime(window_start, {_STAMP}) AS window_start,
  strftime(window_start + INTERVAL '1 day', {_STAMP}) AS window_end, event_count"""

_CLOSED_ALERTS = f"""
            WITH {_CLICKS}, {_ALERTS}
            SELECT {_ALERT_COLUMNS} FROM alerts
            WHERE window_start + INTERVAL '1 day' <=
                  (SELECT max(event_time) - INTERVAL '5 seconds' FROM clicks)"""

_LATE = f"""arrived AS (
  SELECT *, time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01') AS window_start,
         CASE WHEN event_type = 'error' THEN 2
              WHEN event_time < TIMESTAMP '{CUTOVER}' THEN 0 ELSE 1 END AS part
  FROM clicks),
late AS (
  SELECT event_id, user_id FROM arrived
  WHERE part = 2 AND window_start + INTERVAL '1 day' <=
    (SELECT max(event_time) - INTERVAL '5 seconds' FROM arrived WHERE part < 2))"""

_RATINGS = """ratings AS (
  SELECT user_id, product_id, coalesce(sum(CASE event_type WHEN 'view' THEN 1.0::DOUBLE
    WHEN 'click' THEN 3.0 WHEN 'purchase' THEN 5.0 WHEN 'error' THEN -2.0 END), 0.0) AS rating
  FROM clicks WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY 1, 2)"""

_SCALED = f"""{_RATINGS}, bounds AS (SELECT min(rating) AS lo, max(rating) AS hi FROM ratings),
scaled AS (
  SELECT user_id, product_id,
         CASE WHEN hi > lo THEN 1.0::DOUBLE + 4.0::DOUBLE * (rating - lo) / (hi - lo)
              ELSE 3.0 END AS rating,
         CAST('0x' || substr(md5(user_id::VARCHAR || '|' || product_id || '|42'), 1, 8)
              AS BIGINT) % 100 < 80 AS in_train
  FROM ratings, bounds)"""

_SEQUENCES = """histories AS (
  SELECT event_id, user_id, list(product_id) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h,
         lead(product_id) OVER w AS target
  FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id)),
seqs AS (
  SELECT event_id, user_id, target,
         list_concat(list_transform(range(10 - len(h)), lambda x: '<PAD>'), h) AS seq
  FROM histories WHERE target IS NOT NULL)"""

_FACTORS = """vecs AS (SELECT vec_id, vec_id::VARCHAR AS product_id, embedding::DOUBLE[] AS v
  FROM embeddings),
items AS (SELECT product_id, v FROM vecs)"""

_STEP_ERRORS = """errors AS (
  SELECT s.user_id, s.product_id, u.v AS uv, i.v AS iv,
         greatest(-10.0::DOUBLE, least(10.0::DOUBLE, s.raw - list_dot_product(u.v, i.v))) AS err
  FROM (SELECT user_id, product_id, rating AS raw FROM ratings) s
  JOIN vecs u ON u.vec_id = s.user_id JOIN items i ON i.product_id = s.product_id)"""

_ITEMS_PADDED = """padded AS (
  SELECT product_id, v FROM items
  UNION ALL SELECT '<PAD>', list_transform(range(max(len(v))), lambda x: 0.05::DOUBLE)
  FROM items)"""


def _recent_sql(k: int, extra: str = "") -> str:
    return f"""recent AS (
  SELECT user_id, list(product_id ORDER BY event_time, event_id) AS click_sequence
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id
          ORDER BY event_time DESC, event_id DESC) AS rn FROM clicks {extra})
  WHERE rn <= {k} GROUP BY user_id)"""


def _affinity_sql(candidates: str) -> str:
    return f"""scored AS ({candidates}),
ranked AS (
  SELECT user_id, product_id, score,
         row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank,
         round(exp(score / 2.0) / sum(exp(score / 2.0)) OVER (PARTITION BY user_id), 6)
           AS probability
  FROM scored)
SELECT user_id, product_id, rank, score, probability FROM ranked WHERE rank <= 5"""


_PAIRS = """pairs AS (
  SELECT o_custkey AS user_id, l_partkey::VARCHAR AS product_id, sum(l_quantity) AS rating
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2),
predicted AS (
  SELECT p.user_id, p.product_id, p.rating,
         coalesce(list_dot_product(u.v, i.v), 0.0) AS prediction
  FROM pairs p LEFT JOIN vecs u ON u.vec_id = p.user_id
  LEFT JOIN items i ON i.product_id = p.product_id)"""

_EVENT_RECS = f"""
WITH {_CLICKS}, {_FACTORS},
top AS (
  SELECT u.vec_id AS user_id, i.product_id AS recommended,
         round(list_dot_product(u.v, i.v), 6) AS score
  FROM vecs u, items i
  QUALIFY row_number() OVER (PARTITION BY u.vec_id
    ORDER BY round(list_dot_product(u.v, i.v), 6) DESC, i.product_id) <= 6)
SELECT c.event_id, c.user_id, c.product_id, t.recommended AS recommended_product_id, t.score
FROM clicks c JOIN top t ON t.user_id = c.user_id AND t.recommended <> c.product_id
QUALIFY row_number() OVER (PARTITION BY c.event_id ORDER BY t.score DESC, t.recommended) <= 5"""


def _sequence_scores(k: int, extra: str = "") -> str:
    """Scores of every product for the last clicks of each user."""
    return f"""{_recent_sql(k)}, padseq AS (
  SELECT user_id, click_sequence,
         list_concat(list_transform(range(10 - len(click_sequence)), lambda x: '<PAD>'),
                     click_sequence) AS seq FROM recent),
places AS (SELECT user_id, unnest(seq) AS product_id, unnest(range(1, 11)) AS pos FROM padseq),
known AS (
  SELECT l.user_id, p.v, (1.0::DOUBLE / l.pos) / 2.9289682539682538 AS w,
         count(*) OVER (PARTITION BY l.user_id) AS n
  FROM places l JOIN padded p ON p.product_id = l.product_id),
scored AS (
  SELECT k.user_id, i.product_id,
         round(sum(k.w * list_dot_product(k.v, i.v)) / max(k.n), 6) AS score
  FROM known k, items i {extra} GROUP BY 1, 2)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB statements over the same tables, column for column."""
    return _llm_sql() | {
        "fraud_windows": f"WITH {_CLICKS}, {_ALERTS} SELECT {_ALERT_COLUMNS} FROM alerts",
        "fraud_windows_short": f"""
            WITH {_CLICKS}, alerts AS (
              SELECT user_id,
                     time_bucket(INTERVAL '10 seconds', event_time, TIMESTAMP '1970-01-01')
                       AS window_start,
                     count(*) AS event_count
              FROM clicks GROUP BY 1, 2)
            SELECT user_id, strftime(window_start, {_STAMP}) AS window_start,
              strftime(window_start + INTERVAL '10 seconds', {_STAMP}) AS window_end, event_count
            FROM alerts""",
        "fraud_windows_counted": f"""
            WITH {_CLICKS}, alerts AS (
              SELECT user_id,
                     time_bucket(INTERVAL '1 day', event_time, TIMESTAMP '1970-01-01')
                       AS window_start,
                     count(CASE WHEN event_type = 'error' THEN user_id END) AS event_count
              FROM clicks GROUP BY 1, 2
              HAVING count(CASE WHEN event_type = 'error' THEN user_id END) > 1)
            SELECT {_ALERT_COLUMNS} FROM alerts""",
        "fraud_windows_stream": _CLOSED_ALERTS,
        "fraud_windows_json_stream": _CLOSED_ALERTS.replace(
            "SELECT user_id,", "SELECT user_id::VARCHAR AS user_id,"
        ),
        "two_sinks_stream": f"""
            SELECT 'fraud_attempts' AS sink, user_id, count(*) AS n_rows
            FROM ({_CLOSED_ALERTS}) GROUP BY user_id
            UNION ALL SELECT 'user_recommendations', user_id, count(*)
            FROM ({_EVENT_RECS}) GROUP BY user_id""",
        "fan_out_stream": f"""
            SELECT 'fraud_attempts' AS sink, user_id, count(*) AS n_rows
            FROM ({_CLOSED_ALERTS}) GROUP BY user_id
            UNION ALL SELECT 'user_recommendations', user_id, count(*)
            FROM ({_EVENT_RECS}) GROUP BY user_id""",
        "late_rows_stream": f"""
            WITH {_CLICKS}, {_LATE}
            SELECT event_id, user_id, 2::BIGINT AS batch_id,
                   (SELECT count(*) FROM arrived WHERE part = 2) AS n_rows,
                   count(*) OVER () AS n_late
            FROM late""",
        "late_alerts_stream": f"""
            WITH {_CLICKS}, {_LATE},
            counted AS (
              SELECT user_id, window_start, window_start + INTERVAL '1 day' AS window_end,
                     count(*) AS event_count
              FROM arrived WHERE event_id NOT IN (SELECT event_id FROM late) GROUP BY ALL)
            SELECT user_id, strftime(window_start, {_STAMP}) AS window_start,
                   strftime(window_end, {_STAMP}) AS window_end, event_count
            FROM counted
            WHERE event_count > 5
              AND window_end <= (SELECT max(event_time) - INTERVAL '5 seconds' FROM arrived)""",
        "swapped_lists_stream": f"""
            WITH {_CLICKS}, {_FACTORS},
            scored AS (
              SELECT u.vec_id AS user_id, i.product_id AS recommended, b.batch,
                     round(list_dot_product(u.v, i.v) * (1 - 2 * b.batch), 6) + 0.0 AS score
              FROM vecs u, items i, (VALUES (0::BIGINT), (1::BIGINT)) AS b(batch)),
            top AS (
              SELECT * FROM scored QUALIFY row_number() OVER (
                PARTITION BY user_id, batch ORDER BY score DESC, recommended) <= 6)
            SELECT c.event_id, c.user_id, c.product_id, t.recommended AS recommended_product_id,
                   t.score, t.batch
            FROM clicks c JOIN top t ON t.user_id = c.user_id AND t.recommended <> c.product_id
             AND t.batch = CASE WHEN c.event_time < TIMESTAMP '{CUTOVER}' THEN 0 ELSE 1 END
            QUALIFY row_number() OVER (
              PARTITION BY c.event_id ORDER BY t.score DESC, t.recommended) <= 5""",
        "namespace_tables": """
            SELECT count(*) AS n_rows, true AS was_listed, 0::BIGINT AS n_left FROM customer""",
        "new_files": """
            SELECT event_type, count(*) AS n_rows FROM events
            WHERE event_type NOT IN ('view', 'click') GROUP BY event_type""",
        "table_replace": """
            SELECT 'before' AS reader, c_nationkey, count(*) AS n_rows, true AS replace_failed
            FROM customer GROUP BY c_nationkey
            UNION ALL SELECT 'after', c_nationkey, count(*), true
            FROM customer WHERE c_acctbal > 0 GROUP BY c_nationkey""",
        "listed_files": "SELECT DISTINCT event_type, true AS has_content FROM events",
        "event_time_parse": f"""
            SELECT event_id, CASE WHEN event_type <> 'error'
              THEN strftime(date_trunc('millisecond', ts), {_STAMP}) END AS event_time
            FROM events""",
        "event_time_strict": f"""
            SELECT event_id, CASE WHEN event_type NOT IN ('view', 'purchase')
              THEN strftime(ts, {_STAMP}) END AS event_time
            FROM events""",
        "timestamp_normalize": f"""
            SELECT event_id, CASE WHEN event_type <> 'error'
              THEN strftime(ts, {_STAMP}) END AS event_time
            FROM events""",
        "feature_vectors": """
            WITH vecs AS (
              SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: round(x, 6)) AS v
              FROM embeddings)
            SELECT vec_id, len(v)::BIGINT AS n_dims,
                   round(sqrt(list_dot_product(v, v)), 6) AS norm,
                   round(v[1] / sqrt(list_dot_product(v, v)), 6) AS unit_first
            FROM vecs""",
        "etl_users": """
            SELECT c_custkey::VARCHAR AS user_id, c_name AS name,
                   strftime(min(o_orderdate), '%Y-%m-%d') AS signup_date,
                   c_acctbal AS first_feature
            FROM orders JOIN customer ON o_custkey = c_custkey
            GROUP BY c_custkey, c_name, c_acctbal""",
        "etl_products": """
            SELECT p_partkey::VARCHAR AS product_id, p_name || ', ' || p_type AS product_name,
                   p_brand AS category, p_retailprice AS price, p_size::DOUBLE AS second_feature
            FROM part""",
        "csv_roundtrip": """
            SELECT c_custkey::VARCHAR AS c_custkey, c_name, c_nationkey::VARCHAR AS c_nationkey,
                   round(c_acctbal, 2) AS c_acctbal, c_mktsegment FROM customer""",
        "csv_inferred": """
            SELECT c_custkey::INTEGER AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
            FROM customer""",
        "json_roundtrip": f"""
            WITH {_CLICKS} SELECT user_id::VARCHAR AS user_id, product_id, event_type,
              strftime(date_trunc('millisecond', event_time), {_STAMP}) AS event_time
            FROM clicks""",
        "malformed_json": f"""
            WITH {_CLICKS} SELECT user_id::VARCHAR AS user_id, product_id, event_type,
              strftime(date_trunc('millisecond', event_time), {_STAMP}) AS event_time
            FROM clicks WHERE event_type <> 'error'""",
        "clickstream_path_filter": f"""
            WITH {_CLICKS} SELECT user_id::VARCHAR AS user_id, product_id, event_type,
              strftime(date_trunc('millisecond', event_time), {_STAMP}) AS event_time
            FROM clicks WHERE event_type IN ('view', 'click')""",
        "staged_reread": f"""
            WITH {_CLICKS} SELECT place, user_id::VARCHAR AS user_id, product_id,
              strftime(date_trunc('millisecond', event_time), {_STAMP}) AS event_time
            FROM clicks, (VALUES ('merged'), ('individual')) AS places(place)""",
        "training_bad_lines": """
            SELECT count(*) FILTER (event_type <> 'error') AS n_good,
                   count(*) FILTER (event_type = 'error') AS n_broken FROM events""",
        "input_fallback": "SELECT event_type, count(*) AS n_rows FROM events GROUP BY 1",
        "merge_report": """
            SELECT event_type AS kind, count(*) AS records,
                   'timestamp,user_id,product_id,event_type' AS sample_keys
            FROM events WHERE event_type IN ('view', 'error') GROUP BY 1""",
        "malformed_json_kept": """
            SELECT (event_type = 'error')::INTEGER AS is_broken, count(*) AS n_rows,
                   count(CASE WHEN event_type <> 'error' THEN 1 END) AS n_typed
            FROM events GROUP BY 1""",
        "table_roundtrip": "SELECT * FROM customer",
        "table_append": f"""
            WITH {_CLICKS}, {_ALERTS}, twice AS (
              SELECT * FROM alerts UNION ALL SELECT * FROM alerts)
            SELECT user_id::VARCHAR AS user_id, strftime(window_start, {_STAMP}) AS window_start,
              strftime(window_start + INTERVAL '1 day', {_STAMP}) AS window_end, event_count
            FROM twice""",
        "sql_entry": """
            SELECT c_mktsegment, count(*) AS n_customers, max(c_acctbal) AS max_balance
            FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment""",
        "merge_clickstream": f"""
            WITH {_CLICKS} SELECT strftime(event_time, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
              user_id::VARCHAR AS user_id, product_id, event_type FROM clicks""",
        "staged_records": """
            SELECT 'users' AS artifact, 'users' AS place, count(DISTINCT o_custkey) AS records
            FROM orders JOIN customer ON o_custkey = c_custkey
            UNION ALL SELECT 'products', 'products', count(*) FROM part
            UNION ALL SELECT 'clickstream', 'individual', count(*) FROM events
            UNION ALL SELECT 'clickstream', 'merged', count(*) FROM events""",
        "archived_records": """
            SELECT count(*) AS waiting, 0::BIGINT AS left_over, 1::BIGINT AS archives,
                   count(*) AS archived, count(DISTINCT user_id) AS users
            FROM events""",
        "json_rows": """
            SELECT to_json(struct_pack(c_custkey := c_custkey, c_name := c_name,
                     c_nationkey := c_nationkey, c_mktsegment := c_mktsegment,
                     c_acctbal := c_acctbal::DECIMAL(12, 2)::VARCHAR))::VARCHAR AS value
            FROM customer""",
        "inspect_events": f"""
            SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
                   strftime(date_trunc('millisecond', ts), {_STAMP}) AS event_time
            FROM events ORDER BY ts, event_id LIMIT 20""",
        "legit_signups_by_month": _SIGNUPS,
        "legit_signups_json": _SIGNUPS,
        "new_users": """
            SELECT o_custkey AS user_id FROM orders WHERE o_custkey IS NOT NULL
            EXCEPT SELECT user_id FROM events""",
        "new_items": f"""
            WITH {_CLICKS}, pairs AS (
              SELECT user_id::VARCHAR || '|' || product_id AS pair,
                     event_time >= TIMESTAMP '{CUTOVER}' AS late FROM clicks)
            SELECT pair FROM pairs WHERE late EXCEPT SELECT pair FROM pairs WHERE NOT late""",
        "events_union": f"""
            WITH {_CLICKS} SELECT event_id, user_id, product_id,
              CASE WHEN event_time >= TIMESTAMP '{CUTOVER}' THEN event_type END AS event_type
            FROM clicks""",
        "distinct_counts": f"""
            WITH {_CLICKS} SELECT count(*) AS n_rows, count(DISTINCT user_id) AS n_user_id,
              count(DISTINCT product_id) AS n_product_id FROM clicks""",
        "user_index": """
            SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT user_id) AS n_ids,
                   0::BIGINT AS first_id, count(DISTINCT user_id) - 1 AS last_id
            FROM events""",
        "ratings_raw": f"WITH {_CLICKS}, {_RATINGS} SELECT * FROM ratings",
        "rating_stats": f"""
            WITH {_CLICKS}, {_RATINGS}
            SELECT count(rating) AS n_ratings, min(rating) AS rating_min,
                   max(rating) AS rating_max, round(avg(rating), 6) AS rating_mean,
                   median(rating) AS rating_median, round(stddev_samp(rating), 6) AS rating_std
            FROM ratings""",
        "value_stats": """
            SELECT count(*) AS n_ratings, min(l_extendedprice) AS rating_min,
                   max(l_extendedprice) AS rating_max, round(avg(l_extendedprice), 2) AS rating_mean,
                   median(l_extendedprice) AS rating_median,
                   round(stddev_samp(l_extendedprice), 2) AS rating_std
            FROM lineitem""",
        "ratings_normalized": f"""
            WITH {_CLICKS}, {_SCALED}
            SELECT user_id, product_id, round(rating, 6) AS rating FROM scaled""",
        "ratings_train": f"""
            WITH {_CLICKS}, {_SCALED}
            SELECT user_id, product_id, round(rating, 6) AS rating FROM scaled WHERE in_train""",
        "ratings_test": f"""
            WITH {_CLICKS}, {_SCALED}
            SELECT user_id, product_id, round(rating, 6) AS rating
            FROM scaled WHERE NOT in_train""",
        "mean_baseline_error": f"""
            WITH {_CLICKS}, {_SCALED},
            center AS (SELECT avg(rating) AS m FROM scaled WHERE in_train)
            SELECT round(sqrt(avg((rating - m) * (rating - m))), 6) AS rmse,
                   round(avg(abs(rating - m)), 6) AS mae, count(*) AS n
            FROM scaled, center WHERE NOT in_train""",
        "click_sequences": f"""
            WITH {_CLICKS}, {_SEQUENCES}
            SELECT event_id, user_id, array_to_string(seq, ',') AS sequence, target FROM seqs""",
        "click_sequences_alike": """
            WITH clicks AS (
              SELECT event_id,
                     CASE WHEN event_type = 'error' THEN -1 ELSE user_id END AS user_id,
                     CASE WHEN event_type = 'error' THEN '0'
                       ELSE json_extract_string(props, '$.k') END AS product_id,
                     CASE WHEN event_type = 'error' THEN TIMESTAMP '2024-01-05 00:00:00'
                       ELSE ts END AS event_time
              FROM events),
            histories AS (
              SELECT user_id, product_id, lead(product_id) OVER w AS target,
                     list(product_id) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h
              FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id))
            SELECT user_id, product_id, target,
                   array_to_string(list_concat(
                     list_transform(range(10 - len(h)), lambda x: '<PAD>'), h), ',') AS sequence
            FROM histories WHERE target IS NOT NULL""",
        "click_sequences_hot": """
            WITH clicks AS (
              SELECT event_id, json_extract_string(props, '$.k') AS product_id,
                     CASE WHEN event_id % 6 < 3 THEN 0 ELSE user_id END AS user_id,
                     CASE event_id % 6 WHEN 0 THEN TIMESTAMP '2024-01-05 00:00:00'
                       WHEN 1 THEN NULL ELSE ts END AS event_time
              FROM events),
            histories AS (
              SELECT event_id, user_id, lead(product_id) OVER w AS target,
                     list(product_id) OVER (w ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) AS h
              FROM clicks
              WINDOW w AS (PARTITION BY user_id ORDER BY event_time NULLS LAST, event_id))
            SELECT event_id, user_id, target,
                   array_to_string(list_concat(
                     list_transform(range(10 - len(h)), lambda x: '<PAD>'), h), ',') AS sequence
            FROM histories WHERE target IS NOT NULL""",
        "click_sequences_long": f"""
            WITH {_CLICKS}, histories AS (
              SELECT event_id, user_id, lead(product_id) OVER w AS target,
                     list(product_id) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS h
              FROM clicks WINDOW w AS (PARTITION BY user_id ORDER BY event_time, event_id))
            SELECT event_id, user_id, target,
                   array_to_string(list_concat(
                     list_transform(range(3 - len(h)), lambda x: '<PAD>'), h), ',') AS sequence
            FROM histories WHERE target IS NOT NULL""",
        "recent_clicks": f"""
            WITH {_CLICKS}, {_recent_sql(5)}
            SELECT user_id, array_to_string(click_sequence, ',') AS click_sequence FROM recent""",
        "sequence_encoding": f"""
            WITH {_CLICKS}, {_SEQUENCES}, {_FACTORS}, {_ITEMS_PADDED},
            places AS (SELECT event_id, target, unnest(seq) AS product_id,
                              unnest(range(1, 11)) AS pos FROM seqs),
            scores AS (
              SELECT l.event_id,
                     sum((1.0::DOUBLE / l.pos) / 2.9289682539682538 * list_dot_product(p.v, t.v))
                       / count(*) AS score
              FROM places l JOIN padded p ON p.product_id = l.product_id
              JOIN items t ON t.product_id = l.target GROUP BY l.event_id),
            chances AS (
              SELECT event_id, score,
                     1.0::DOUBLE / (1.0::DOUBLE + exp(-least(greatest(score, -10.0), 10.0)))
                       AS probability FROM scores)
            SELECT event_id, round(score, 6) AS score, round(probability, 6) AS probability,
                   round(-ln(greatest(probability, 1e-10)), 6) AS loss
            FROM chances""",
        "recommend_top_n": f"""
            WITH {_CLICKS}, {_FACTORS}, scored AS (
              SELECT u.vec_id AS user_id, i.product_id,
                     round(list_dot_product(u.v, i.v), 6) AS score
              FROM vecs u, items i
              WHERE NOT EXISTS (SELECT 1 FROM clicks c
                WHERE c.user_id = u.vec_id AND c.product_id = i.product_id))
            SELECT user_id, product_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank,
                   score
            FROM scored
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) <= 5
            """,
        "sample_recommendations": f"""
            WITH {_CLICKS}, {_FACTORS}, scored AS (
              SELECT u.vec_id AS user_id, i.product_id,
                     round(list_dot_product(u.v, i.v), 6) AS score,
                     row_number() OVER (PARTITION BY u.vec_id
                       ORDER BY list_dot_product(u.v, i.v) DESC, i.product_id) AS rank
              FROM (SELECT * FROM vecs ORDER BY vec_id LIMIT 3) u, items i
              WHERE NOT EXISTS (SELECT 1 FROM clicks c
                WHERE c.user_id = u.vec_id AND c.product_id = i.product_id))
            SELECT user_id, product_id, rank, score FROM scored WHERE rank <= 5""",
        "affinity_top_k": f"""
            WITH {_CLICKS}, vecs AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
            {_recent_sql(1, "WHERE event_type IN ('view', 'click', 'purchase')")},
            users AS (
              SELECT u.vec_id AS user_id, u.v AS uv, c.v AS cv
              FROM vecs u LEFT JOIN recent r ON r.user_id = u.vec_id
              LEFT JOIN vecs c ON c.vec_id = r.click_sequence[1]::BIGINT),
            {_affinity_sql('''
              SELECT u.user_id, p.vec_id AS product_id,
                     round(CASE WHEN u.cv IS NULL THEN list_dot_product(u.uv, p.v)
                       ELSE 0.7::DOUBLE * list_dot_product(u.cv, p.v)
                            + 0.3::DOUBLE * list_dot_product(u.uv, p.v) END, 6) AS score
              FROM users u, vecs p''')}""",
        "affinity_top_k_excluding": f"""
            WITH {_CLICKS}, vecs AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
            seen AS (SELECT DISTINCT user_id, product_id::BIGINT AS product_id FROM clicks),
            {_affinity_sql('''
              SELECT u.vec_id AS user_id, p.vec_id AS product_id,
                     round(list_dot_product(u.v, p.v), 6) AS score
              FROM vecs u, vecs p
              WHERE NOT EXISTS (SELECT 1 FROM seen s
                WHERE s.user_id = u.vec_id AND s.product_id = p.vec_id)''')}""",
        "predict_pairs": f"""
            WITH {_FACTORS}, {_PAIRS}
            SELECT user_id, product_id, round(prediction, 6) AS prediction FROM predicted""",
        "prediction_errors": f"""
            WITH {_FACTORS}, {_PAIRS}
            SELECT round(sqrt(avg((rating - prediction) * (rating - prediction))), 6) AS rmse,
                   round(avg(abs(rating - prediction)), 6) AS mae, count(*) AS n
            FROM predicted""",
        "event_recommendations": _EVENT_RECS,
        "event_recommendations_sql": _EVENT_RECS,
        "event_recommendations_udtf": _EVENT_RECS,
        "event_recommendations_stream": _EVENT_RECS,
        "serve_batch": _SERVED,
        "serve_stream": _SERVED,
        "recommend_from_sequence": f"""
            WITH {_CLICKS}, {_FACTORS}, {_ITEMS_PADDED}, {_sequence_scores(10)}
            SELECT user_id, product_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS rank,
                   score
            FROM scored
            QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) <= 5
            """,
        "recommend_unknown_sequences": f"""
            WITH {_FACTORS}, best AS (
              SELECT product_id, row_number() OVER (ORDER BY product_id) AS rank FROM items)
            SELECT user_id, product_id, rank, 0.0::DOUBLE AS score
            FROM (SELECT DISTINCT user_id FROM events), best WHERE rank <= 5""",
        "serve_sequence_batch": f"""
            WITH {_CLICKS}, {_FACTORS}, {_ITEMS_PADDED}, {_sequence_scores(3)},
            ranked AS (
              SELECT s.user_id, s.product_id, s.score,
                     row_number() OVER (PARTITION BY s.user_id
                       ORDER BY s.score DESC, s.product_id) AS rank
              FROM scored s JOIN recent r ON r.user_id = s.user_id
              WHERE NOT list_contains(r.click_sequence, s.product_id))
            SELECT c_custkey AS request_id,
                   CASE WHEN r.user_id IS NOT NULL THEN c_custkey::VARCHAR END AS user_id,
                   CASE WHEN r.user_id IS NOT NULL THEN (SELECT count(*) FROM padded) ELSE 0 END
                     AS n_items,
                   CASE WHEN r.user_id IS NULL THEN 'click_sequence is required' END AS error,
                   coalesce(t.rank, 0) AS rank, t.product_id, t.score
            FROM customer LEFT JOIN recent r ON r.user_id = c_custkey
            LEFT JOIN ranked t ON t.user_id = c_custkey AND t.rank <= 5""",
        "mf_metrics": f"""
            WITH {_CLICKS}, {_SCALED}
            SELECT 'factor' AS model_type, count(DISTINCT user_id) FILTER (in_train) AS n_users,
                   count(DISTINCT product_id) FILTER (in_train) AS n_items,
                   20::BIGINT AS n_factors, count(*) FILTER (in_train) AS training_samples,
                   count(*) FILTER (NOT in_train) AS test_samples, 20::BIGINT AS epochs_completed,
                   (SELECT lo FROM bounds) AS rating_min, (SELECT hi FROM bounds) AS rating_max,
                   true AS normalized, round(avg(rating) FILTER (in_train), 6) AS rating_offset,
                   true AS as_good_as_mean
            FROM scaled""",
        "mf_top_n": f"""
            WITH {_CLICKS}, {_SCALED}, train AS (SELECT * FROM scaled WHERE in_train)
            SELECT user_id, least(5, any_value(total) - count(*)) AS n_items, true AS in_order,
                   0::BIGINT AS n_unwanted, least(5, any_value(total) - count(*)) AS n_known
            FROM train, (SELECT count(DISTINCT product_id) AS total FROM train)
            GROUP BY user_id HAVING any_value(total) > count(*)""",
        "mf_early_stopping": f"""
            WITH {_CLICKS}, {_SCALED}
            SELECT CASE WHEN in_train THEN 'train' ELSE 'test' END AS part, count(*) AS n_ratings,
                   true AS tried_in_order, true AS stopped_in_time, true AS kept_best
            FROM scaled GROUP BY 1""",
        "mf_epoch_history": f"""
            WITH {_CLICKS}, {_SCALED}, {_FACTORS}, {_STEP_ERRORS}
            SELECT 1 AS epoch, round(sqrt(avg(err * err)), 6) AS rmse, count(*) AS n_ratings
            FROM errors""",
        "mf_epoch_vectors": f"""
            WITH {_CLICKS}, {_SCALED}, {_FACTORS}, {_STEP_ERRORS},
            places AS (
              SELECT user_id, product_id, err, unnest(uv) AS p, unnest(iv) AS q,
                     unnest(range(1, len(uv) + 1)) AS d FROM errors),
            moves AS (
              SELECT 'user' AS kind, user_id::VARCHAR AS id, d, count(*) AS c,
                     avg(err * q - 0.05::DOUBLE * p) AS g FROM places GROUP BY ALL
              UNION ALL
              SELECT 'item', product_id, d, count(*), avg(err * p - 0.05::DOUBLE * q)
              FROM places GROUP BY ALL),
            old AS (
              SELECT k.kind, product_id AS id, unnest(v) AS x,
                     unnest(range(1, len(v) + 1)) AS d
              FROM items, (VALUES ('user'), ('item')) AS k(kind)),
            moved AS (
              SELECT o.kind, o.id, greatest(-10.0::DOUBLE, least(10.0::DOUBLE,
                       x + coalesce((1.0::DOUBLE - pow(0.98::DOUBLE, c)) * g, 0.0::DOUBLE))) AS x
              FROM old o LEFT JOIN moves m ON m.kind = o.kind AND m.id = o.id AND m.d = o.d)
            SELECT kind, id, round(sqrt(sum(x * x)), 6) AS norm FROM moved GROUP BY kind, id""",
        "seq_train_history": f"""
            WITH {_FACTORS}, all_clicks AS (
              SELECT event_id, user_id, json_extract_string(props, '$.k') AS product_id,
                     ts AS event_time FROM events),
            clicks AS (
              SELECT * FROM all_clicks WHERE product_id IN (SELECT product_id FROM items)),
            {_SEQUENCES}, {_ITEMS_PADDED},
            places AS (SELECT event_id, target, unnest(seq) AS product_id,
                              unnest(range(1, 11)) AS pos FROM seqs),
            scores AS (
              SELECT l.event_id,
                     sum((1.0::DOUBLE / l.pos) / 2.9289682539682538 * list_dot_product(p.v, t.v))
                       / count(*) AS score
              FROM places l JOIN padded p ON p.product_id = l.product_id
              JOIN items t ON t.product_id = l.target GROUP BY l.event_id)
            SELECT 1 AS epoch,
                   round(avg(-ln(greatest(1.0::DOUBLE / (1.0::DOUBLE
                     + exp(-least(greatest(score, -10.0), 10.0))), 1e-10))), 6) AS loss,
                   (SELECT count(*) FROM clicks) AS n_clicks, true AS loss_falls
            FROM scores""",
        "seq_epoch_vectors": f"""
            WITH {_FACTORS}, all_clicks AS (
              SELECT event_id, user_id, json_extract_string(props, '$.k') AS product_id,
                     ts AS event_time FROM events),
            clicks AS (
              SELECT * FROM all_clicks WHERE product_id IN (SELECT product_id FROM items)),
            {_SEQUENCES}, {_ITEMS_PADDED},
            slots AS (
              SELECT event_id, event_id % 3 AS worker, target, unnest(seq) AS product_id,
                     unnest(range(1, 11)) AS pos FROM seqs),
            places AS (
              SELECT *, (1.0::DOUBLE / pos) / 2.9289682539682538 AS w,
                     count(*) OVER (PARTITION BY event_id) AS valid
              FROM slots),
            dims AS (
              SELECT product_id, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS d FROM padded),
            encoded AS (
              SELECT l.event_id, l.worker, l.target, x.d, sum(l.w * x.x / l.valid) AS e
              FROM places l JOIN dims x ON x.product_id = l.product_id GROUP BY ALL),
            chances AS (
              SELECT e.event_id, 1.0::DOUBLE / (1.0::DOUBLE
                + exp(-greatest(-10.0, least(10.0, sum(e.e * t.x))))) AS c
              FROM encoded e JOIN dims t ON t.product_id = e.target AND t.d = e.d
              GROUP BY e.event_id),
            pulls AS (SELECT event_id, (1 - c) * c * (1 - c) AS pull FROM chances),
            goals AS (
              SELECT worker, product_id, d, greatest(-10.0, least(10.0, any_value(x) + sum(step)))
                       AS x
              FROM (SELECT e.worker, e.target AS product_id, e.d, t.x, 0.01 * p.pull * e.e AS step
                    FROM encoded e JOIN pulls p USING (event_id)
                    JOIN dims t ON t.product_id = e.target AND t.d = e.d)
              GROUP BY worker, product_id, d),
            item_steps AS (
              SELECT l.worker, l.product_id, g.d,
                     sum(0.01 * p.pull / l.valid * g.x * l.w) AS step
              FROM places l JOIN pulls p USING (event_id)
              JOIN goals g ON g.worker = l.worker AND g.product_id = l.target
              GROUP BY ALL),
            ends AS (
              SELECT worker, product_id, d,
                     greatest(-10.0, least(10.0, coalesce(g.x, o.x) + coalesce(i.step, 0.0))) - o.x
                       AS change
              FROM goals g FULL JOIN item_steps i USING (worker, product_id, d)
              JOIN dims o USING (product_id, d)),
            moved AS (
              SELECT o.product_id, o.d, any_value(o.x) + coalesce(avg(e.change), 0.0) AS x
              FROM dims o LEFT JOIN ends e USING (product_id, d) GROUP BY o.product_id, o.d),
            gains AS (
              SELECT l.worker, l.pos,
                     sum(0.01 * p.pull / l.valid * (
                       coalesce(h.x, o.x) + coalesce(i.step, 0.0)) * g.x) AS gain
              FROM places l JOIN pulls p USING (event_id)
              JOIN goals g ON g.worker = l.worker AND g.product_id = l.target
              JOIN dims o ON o.product_id = l.product_id AND o.d = g.d
              LEFT JOIN goals h
                ON h.worker = l.worker AND h.product_id = l.product_id AND h.d = g.d
              LEFT JOIN item_steps i
                ON i.worker = l.worker AND i.product_id = l.product_id AND i.d = g.d
              GROUP BY l.worker, l.pos),
            weights AS (
              SELECT pos, avg(greatest(0.01, least(10.0,
                       (1.0::DOUBLE / pos) / 2.9289682539682538 + gain))) AS x
              FROM gains GROUP BY pos)
            SELECT product_id, round(sqrt(sum(x * x)), 6) AS norm FROM moved GROUP BY product_id
            UNION ALL SELECT 'weights', round(sqrt(sum(x * x)), 6) FROM weights""",
        "seq_top_n": f"""
            WITH {_CLICKS}
            SELECT user_id, least(5, any_value(total)) AS n_items, true AS in_order,
                   0::BIGINT AS n_unwanted, least(5, any_value(total)) AS n_known
            FROM clicks, (SELECT count(DISTINCT product_id) AS total FROM clicks)
            WHERE product_id IS NOT NULL GROUP BY user_id""",
        "seq_incremental": f"""
            WITH {_CLICKS}
            SELECT 'prio_clicks_aware_sequence' AS model_type, count(DISTINCT user_id) AS n_users,
                   count(DISTINCT product_id) + 1 AS n_items, 32::BIGINT AS n_factors,
                   10::BIGINT AS sequence_length, 7::BIGINT AS epochs_completed,
                   'incremental' AS training_mode, count(*) AS total_training_samples,
                   true AS first_run_learned, true AS update_kept_it
            FROM clicks""",
        "retraining_runs": f"""
            WITH {_CLICKS}, early AS (
              SELECT * FROM clicks WHERE event_time < TIMESTAMP '{CUTOVER}'),
            total AS (SELECT count(DISTINCT user_id) AS n_users,
                             count(DISTINCT product_id) + 1 AS n_items, count(*) AS n_samples
                      FROM clicks)
            SELECT 'full' AS mode, count(DISTINCT user_id) AS n_users,
                   count(DISTINCT product_id) + 1 AS n_items, count(*) AS n_samples FROM early
            UNION ALL SELECT 'incremental', * FROM total
            UNION ALL SELECT 'noop', * FROM total""",
        "model_info": """
            SELECT 'factor' AS model_type, count(*) AS n_users, count(*) AS n_items,
                   max(len(embedding))::BIGINT AS n_factors, false AS normalized
            FROM embeddings""",
        "model_roundtrip": f"""
            WITH {_FACTORS}
            SELECT product_id, round(sqrt(list_dot_product(v, v)), 6) AS norm FROM items""",
    }


_SERVED = f"""
            WITH {_CLICKS}, {_FACTORS}, requests AS (
              SELECT event_id AS request_id, product_id AS excluded,
                     CASE WHEN event_type NOT IN ('error', 'signup') THEN user_id END AS user_id,
                     CASE WHEN event_type = 'view' THEN 3 ELSE 5 END AS n
              FROM clicks),
            ranked AS (
              SELECT r.request_id, i.product_id, round(list_dot_product(u.v, i.v), 6) AS score,
                     row_number() OVER (PARTITION BY r.request_id
                       ORDER BY round(list_dot_product(u.v, i.v), 6) DESC, i.product_id) AS rank,
                     r.n
              FROM requests r JOIN vecs u ON u.vec_id = r.user_id
              JOIN items i ON i.product_id <> r.excluded)
            SELECT q.request_id, q.user_id::VARCHAR AS user_id,
                   CASE WHEN q.user_id IS NOT NULL THEN (SELECT count(*) FROM items) ELSE 0 END
                     AS n_items,
                   CASE WHEN q.user_id IS NULL THEN 'user_id is required' END AS error,
                   coalesce(t.rank, 0) AS rank, t.product_id, t.score
            FROM requests q LEFT JOIN ranked t ON t.request_id = q.request_id AND t.rank <= t.n"""


_SIGNUPS = f"""
WITH {_CLICKS}, {_ALERTS},
users AS (SELECT o_custkey AS user_id, min(o_orderdate) AS signup_date FROM orders GROUP BY 1)
SELECT strftime(signup_date, '%Y-%m') AS signup_month, count(*) AS count
FROM users WHERE user_id NOT IN (SELECT user_id FROM alerts) GROUP BY 1"""


# --------------------------------------------------------------------------
# Training-data operators, a subpackage that may be absent
# --------------------------------------------------------------------------


def _optional(name: str):
    """The module, or None where just it (or its package) is absent."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name and (name == error.name or name.startswith(f"{error.name}.")):
            return None
        raise


def _llm_modules() -> tuple:
    found = _optional("clickloom.llm.queries")
    return found, _optional("corpus_pipeline") if found else None


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found, pipeline = _llm_modules()
    own = found.queries() if found else {}
    return own | ({"pipeline": pipeline.run} if pipeline else {})


def _llm_sql() -> dict[str, str]:
    found, pipeline = _llm_modules()
    own = found.oracle_sql() if found else {}
    sql = pipeline.ORACLE_SQL if pipeline else None
    return own | ({"pipeline": sql} if sql else {})


# --------------------------------------------------------------------------
# Contract
# --------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: users with bursts of events."""
    return q_fraud_windows(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every registered query by name."""
    own = {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
    return own | _llm_queries()
