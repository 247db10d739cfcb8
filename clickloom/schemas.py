"""Explicit schemas of every table; inference is only an opt-in reader flag."""

from pyspark.sql import types as T


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


S, D, L, TS = T.StringType(), T.DoubleType(), T.LongType(), T.TimestampType()

USERS_CSV = _struct(user_id=S, name=S, signup_date=S, features=S)
USERS = _struct(user_id=S, name=S, signup_date=T.DateType(), features=S)

PRODUCTS_CSV = _struct(product_id=S, product_name=S, category=S, price=S, features=S)
PRODUCTS = _struct(product_id=S, product_name=S, category=S, price=D, features=S)

# ``timestamp`` stays text: files carry ISO strings or epoch seconds.
CLICKSTREAM = _struct(timestamp=S, user_id=S, product_id=S, event_type=S)

FRAUD_ATTEMPTS = _struct(user_id=S, window_start=TS, window_end=TS, event_count=L)

USER_RECOMMENDATIONS = _struct(
    user_id=S, product_id=S, recommended_product_id=S, score=D
)

RATINGS = _struct(user_id=S, product_id=S, rating=D)

SIGNUP_COUNTS = _struct(signup_month=S, count=L)

FACTOR_MODEL_METADATA = _struct(
    version=S,
    model_type=S,
    rmse=D,
    mae=D,
    n_users=L,
    n_items=L,
    n_factors=L,
    training_samples=L,
    test_samples=L,
    epochs_completed=L,
    rating_offset=D,
    rating_min=D,
    rating_max=D,
    normalized=T.BooleanType(),
    history=T.ArrayType(D),
    validation_history=T.ArrayType(D),
    last_updated=TS,
)

SEQUENCE_MODEL_METADATA = _struct(
    version=S,
    model_type=S,
    n_users=L,
    n_items=L,
    n_factors=L,
    sequence_length=L,
    epochs_completed=L,
    final_loss=D,
    training_mode=S,
    total_training_samples=L,
    learning_rate=D,
    regularization=D,
    seed=L,
    position_weights=T.ArrayType(D),
    history=T.ArrayType(D),
    last_updated=TS,
)

LISTS_METADATA = _struct(version=S, n_users=L, last_updated=TS)

REQUESTS = T.StructType(
    [
        T.StructField("request_id", L),
        T.StructField("user_id", S),
        T.StructField("n", T.IntegerType()),
        T.StructField("exclude_products", T.ArrayType(S)),
        T.StructField("click_sequence", T.ArrayType(S)),
    ]
)
