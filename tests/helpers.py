import contextlib
import io
from datetime import datetime, timedelta

START = datetime(2024, 1, 1)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


def events_of(spark, rows):
    """Rows of (event_id, user_id, product_id, event_type, second)."""
    data = [(i, u, p, t, None if s is None else at(s)) for i, u, p, t, s in rows]
    return spark.createDataFrame(
        data,
        "event_id long, user_id string, product_id string, event_type string, "
        "event_time timestamp",
    )


def random_events(spark, count=400, users=7, items=15, seed=3, hot_share=0.4):
    """Events where user u0 and item p0 each hold a large share; some times tie or miss."""
    import random

    rng = random.Random(seed)
    rows = []
    for i in range(count):
        user = "u0" if rng.random() < hot_share else f"u{rng.randrange(users)}"
        item = "p0" if rng.random() < hot_share else f"p{rng.randrange(items)}"
        second = None if rng.random() < 0.03 else rng.randrange(3000)
        kind = rng.choice(["view", "add_to_cart", "purchase", "payment_failed", "other"])
        rows.append((i, user, item, kind, second))
    return events_of(spark, rows), rows
