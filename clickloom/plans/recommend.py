"""Recommendations for events and for tables of requests."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.operators.skew import hot_keys, skew_join
from clickloom.operators.topn import Prepared, top_n
from clickloom.plans.factor_model import FactorModel
from clickloom.plans.sequence_model import SequenceModel, offered, recommend_from_sequence

EVENT_RECOMMENDATIONS = 5
REQUEST_LIMIT = 5
# Error texts of a response.
USER_REQUIRED = "user_id is required"
CLICKS_REQUIRED = "click_sequence is required"


def lateral_recommend(
    events: DataFrame,
    recs: DataFrame,
    n: int = EVENT_RECOMMENDATIONS,
    keep: tuple[str, ...] = (),
    hot_users: DataFrame | None = None,
) -> DataFrame:
    """Each event times the best ``n`` products of its user, without the event's product.

    ``recs`` has one row per user (``user_lists``), so the join
    adds no rows before the short list is unfolded. Users without a list give no
    rows. Works on a stream as a stream-static join.
    """
    joined = skew_join(events, recs, "user_id", "inner", hot_users)
    others = F.filter("recs", lambda r: ~r["product_id"].eqNullSafe(F.col("product_id")))
    return joined.select(
        *keep, "user_id", "product_id", F.explode(F.slice(others, 1, n)).alias("_rec")
    ).select(
        *keep,
        "user_id",
        "product_id",
        F.col("_rec.product_id").alias("recommended_product_id"),
        F.col("_rec.score").alias("score"),
    )


def user_lists(
    model: FactorModel,
    users: DataFrame | None = None,
    n: int = EVENT_RECOMMENDATIONS,
    digits: int | None = None,
) -> DataFrame:
    """The ``n + 1`` best products per user, so that one can be dropped later."""
    queries = model.users if users is None else users
    return top_n(queries, model.items, n + 1, lists=True, digits=digits)


def event_recommendations(
    events: DataFrame,
    model: FactorModel,
    n: int = EVENT_RECOMMENDATIONS,
    keep: tuple[str, ...] = (),
    digits: int | None = None,
) -> DataFrame:
    """``lateral_recommend`` for a factor model: scored once per user, not per event."""
    active = model.users.join(events.select("user_id").distinct(), "user_id", "left_semi")
    recs = user_lists(model, active, n, digits)
    return lateral_recommend(events, recs, n, keep, hot_keys(events, "user_id"))


def register_lateral(
    recs: DataFrame, name: str = "get_recommendations", n: int = EVENT_RECOMMENDATIONS
) -> None:
    """Make ``LATERAL name(user_id, product_id)`` available to SQL.

    The function is plain SQL over the lists, so the optimizer turns a lateral
    call into an equi-join on the user. The list's last entry stands in when the
    current product is among the first ``n``.
    """
    spark = recs.sparkSession
    view = f"{name}_lists"
    recs.select(
        "user_id",
        F.slice(F.col("recs.product_id"), 1, n).alias("first_ids"),
        F.posexplode("recs").alias("place", "rec"),
    ).createOrReplaceTempView(view)
    user = recs.schema["user_id"].dataType.simpleString()
    product = recs.schema["recs"].dataType.elementType["product_id"].dataType.simpleString()
    spark.sql(
        f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(asked_user {user}, current_product {product})
        RETURNS TABLE (recommended_product_id {product}, score DOUBLE)
        RETURN SELECT rec.product_id, rec.score FROM {view}
          WHERE user_id = asked_user AND NOT rec.product_id <=> current_product
            AND (place < {n} OR place = {n} AND array_contains(first_ids, current_product))
        """
    )


def register_table_function(
    recs: DataFrame,
    keep: T.StructType,
    name: str = "recommend_for",
) -> None:
    """Make ``name(TABLE(rows), n)`` available to SQL, and the lists as ``<name>_lists``.

    ``rows`` is any query with the columns of ``keep``, a ``product_id`` among them, and
    ``recs``, the list of the row's user; each row comes back with the best ``n``
    products that it does not hold itself, and n may differ from call to call:

        SELECT * FROM recommend_for(TABLE(
          SELECT e.event_id, e.user_id, e.product_id, l.recs
          FROM events e JOIN recommend_for_lists l USING (user_id)), 5)

    A list travels whole through the join and is unfolded behind it, batch by batch;
    the function needs no partitioning, so a hot user's rows stay where the join's skew
    handling put them (``PARTITION BY`` may be given and changes no row).
    """
    entry = recs.schema["recs"].dataType.elementType
    answer = T.StructType(
        [
            *keep.fields,
            T.StructField("recommended_product_id", entry["product_id"].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    names = keep.fieldNames()

    class Unfold:
        def eval(self, rows: pa.RecordBatch, n: pa.Array):
            lists = rows.column("recs")
            row = pc.list_parent_indices(lists)
            found = lists.flatten()
            ids = found.field("product_id")
            own = rows.column("product_id").take(row)
            other = pc.invert(pc.fill_null(pc.equal(ids, own.cast(ids.type)), False))
            row, found = row.filter(other), found.filter(other)
            at = row.to_numpy(zero_copy_only=False)
            first = np.searchsorted(at, at)  # entries of a list stand together, best first
            place = np.arange(len(at)) - first
            most = n[0].as_py() if len(n) else 0
            row, found = (x.filter(pa.array(place < most)) for x in (row, found))
            columns = [rows.column(c).take(row) for c in names]
            columns += [found.field("product_id"), found.field("score")]
            yield pa.RecordBatch.from_arrays(columns, names=answer.fieldNames())

    spark = recs.sparkSession
    spark.udtf.register(name, F.arrow_udtf(Unfold, returnType=answer))
    recs.select("user_id", "recs").createOrReplaceTempView(f"{name}_lists")


def _user_missing() -> Column:
    return F.col("user_id").isNull() | (F.col("user_id").cast("string") == "")


def _with_needs(requests: DataFrame, asker: list[str], n: int, item) -> DataFrame:
    """Add ``_take``, the items a request gets, and ``_ask``, the list that surely holds them.

    Whatever a request excludes, its answer is among the first ``_take`` plus as many
    items as it excludes of its asker's list. That number is rounded up to a power of
    two, so the requests of one asker share few lists, mostly one.
    """
    unwanted = F.array_distinct(F.coalesce("exclude_products", F.array())).cast(
        T.ArrayType(item)
    )
    take = F.greatest(F.coalesce("n", F.lit(n)), F.lit(0))
    deep = F.greatest(F.col("_take") + F.size("_unwanted"), F.lit(1))
    depth = F.pow(F.lit(2.0), F.ceil(F.log2(deep))).cast("int")
    return (
        requests.withColumns({"_unwanted": unwanted, "_take": take})
        .withColumn("_depth", depth)
        .withColumn("_ask", F.to_json(F.struct(*asker, "_depth")))
    )


def _asked(needs: DataFrame, asker: list[str]) -> DataFrame:
    """The distinct lists that the requests need."""
    return needs.groupBy("_ask").agg(
        F.first("_depth").alias("_depth"), *[F.first(c).alias(c) for c in asker]
    )


def _respond(
    requests: DataFrame,
    needs: DataFrame,
    lists: DataFrame,
    error: Column,
    metadata: Column,
    echo: list[str],
) -> DataFrame:
    """Cut each request's answer out of its list, and add the requests that got an error."""
    kind = lists.schema["recs"].dataType
    empty = F.array().cast(kind)
    columns = ["request_id", *echo, "recommendations", "metadata", "error"]
    found = skew_join(needs, lists, "_ask", "left", hot_keys(needs, "_ask"))
    ids = F.transform(F.coalesce("recs", empty), lambda r: r["product_id"])
    wanted = F.slice(F.array_except(ids, "_unwanted"), F.lit(1), F.col("_take"))
    answers = found.withColumn("_wanted", wanted).select(
        "request_id",
        *echo,
        F.filter(
            F.coalesce("recs", empty), lambda r: F.array_contains("_wanted", r["product_id"])
        ).alias("recommendations"),
        metadata.alias("metadata"),
        F.lit(None).cast("string").alias("error"),
    )
    failed = requests.withColumn("error", error).where("error IS NOT NULL")
    blank = {c: F.lit(None).cast(answers.schema[c].dataType) for c in (*echo, "metadata")}
    failed = failed.withColumns({**blank, "recommendations": F.lit(None).cast(kind)})
    return answers.select(columns).unionByName(failed.select(columns))


def serve_batch(
    requests: DataFrame,
    model: FactorModel,
    n: int = REQUEST_LIMIT,
    digits: int | None = None,
    prepared: Prepared | None = None,
    **options,
) -> DataFrame:
    """Answer a table of (request_id, user_id, n, exclude_products) requests.

    A request without a user gets an error; an unknown user an empty list. The
    catalogue is scored once per distinct user, however many requests there are.
    """
    error = F.when(_user_missing(), F.lit(USER_REQUIRED))
    item = model.items.schema["product_id"].dataType
    needs = _with_needs(requests.filter(~_user_missing()), ["user_id"], n, item)
    queries = _asked(needs, ["user_id"]).join(model.users, "user_id")
    lists = top_n(
        queries,
        model.items,
        query_col="_ask",
        n_col="_depth",
        digits=digits,
        lists=True,
        prepared=prepared,
        **options,
    )
    meta = model.metadata
    info = F.struct(
        F.lit(meta.get("rmse")).cast("double").alias("model_rmse"),
        F.lit(meta.get("mae")).cast("double").alias("model_mae"),
        F.lit(meta.get("n_users")).cast("bigint").alias("n_users"),
        F.lit(meta.get("n_items")).cast("bigint").alias("n_items"),
    )
    return _respond(requests, needs, lists, error, info, ["user_id"])


def serve_sequence_batch(
    requests: DataFrame,
    model: SequenceModel,
    n: int = REQUEST_LIMIT,
    digits: int | None = None,
    prepared: Prepared | None = None,
    **options,
) -> DataFrame:
    """Answer a table of (request_id, user_id, click_sequence, n, exclude_products) requests.

    Equal click sequences are encoded and scored once.
    """
    no_clicks = F.col("click_sequence").isNull() | (F.size("click_sequence") == 0)
    error = F.when(_user_missing(), F.lit(USER_REQUIRED)).when(no_clicks, F.lit(CLICKS_REQUIRED))
    item = model.items.schema["product_id"].dataType
    valid = requests.filter(~_user_missing() & ~no_clicks)
    needs = _with_needs(valid, ["click_sequence"], n, item)
    lists = recommend_from_sequence(
        model,
        _asked(needs, ["click_sequence"]),
        key_col="_ask",
        n_col="_depth",
        digits=digits,
        lists=True,
        prepared=prepared,
        **options,
    )
    meta = model.metadata
    info = F.struct(
        F.lit(meta.get("model_type")).alias("model_type"),
        F.lit(meta.get("sequence_length")).cast("bigint").alias("sequence_length"),
        F.lit(meta.get("n_users")).cast("bigint").alias("n_users"),
        F.lit(meta.get("n_items")).cast("bigint").alias("n_items"),
        F.lit(meta.get("final_loss")).cast("double").alias("final_loss"),
    )
    return _respond(requests, needs, lists, error, info, ["user_id", "click_sequence"])


class Scorer:
    """Answers tables of requests with one model, which is measured and shipped once.

    What is shipped stays until ``close``. Usable as a context, and as the
    ``respond`` of ``start_serving_stream``.
    """

    def __init__(
        self,
        model: FactorModel | SequenceModel,
        n: int = REQUEST_LIMIT,
        digits: int | None = None,
        **options,
    ):
        self.model, self.n, self.digits = model, n, digits
        self.serve = serve_batch
        items = model.items
        if isinstance(model, SequenceModel):
            self.serve, items = serve_sequence_batch, offered(model)
        self.prepared = Prepared(items, **options)

    def __call__(self, requests: DataFrame) -> DataFrame:
        return self.serve(requests, self.model, self.n, self.digits, self.prepared)

    def close(self) -> None:
        self.prepared.close()

    def __enter__(self) -> Scorer:
        return self

    def __exit__(self, *failure) -> None:
        self.close()
