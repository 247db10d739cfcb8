import numpy as np
import pytest
from helpers import plan_of

from clickloom.operators.encoding import encode_sequences
from clickloom.operators.matrix import broadcast_items, measure
from clickloom.operators.topn import top_n
from clickloom.plans.affinity import affinity_top_k

RNG = np.random.default_rng(5)
QUERIES = {f"u{i}": RNG.integers(-2, 3, 4).astype(float).tolist() for i in range(40)}
ITEMS = {f"p{i}": RNG.integers(-2, 3, 4).astype(float).tolist() for i in range(60)}
SEEN = {(f"u{RNG.integers(0, 45)}", f"p{RNG.integers(0, 65)}") for _ in range(400)}
SEEN |= {("u7", p) for p in ITEMS}

PATHS = {
    "broadcast": {},
    "blocks": {"broadcast_bytes": 0, "items_per_block": 31, "queries_per_block": 9},
    "one block": {"broadcast_bytes": 0},
}


def vectors(spark, rows, key):
    return spark.createDataFrame(list(rows.items()), f"{key} string, factor array<double>")


def brute(n, seen=(), limits=None):
    want = {}
    for u, q in QUERIES.items():
        scored = sorted(
            (-float(np.dot(q, v)), p) for p, v in ITEMS.items() if (u, p) not in seen
        )
        for rank, (score, p) in enumerate(scored[: limits[u] if limits else n], start=1):
            want[(u, rank)] = (p, -score)
    return want


def got(df):
    return {(r.user_id, r["rank"]): (r.product_id, r.score) for r in df.collect()}


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("n", [1, 5, 100])
@pytest.mark.parametrize("exclude", [False, True])
def test_against_brute_force(spark, path, n, exclude):
    seen = spark.createDataFrame(sorted(SEEN) * 2, "user_id string, product_id string")
    found = top_n(
        vectors(spark, QUERIES, "user_id"),
        vectors(spark, ITEMS, "product_id"),
        n,
        seen if exclude else None,
        **PATHS[path],
    )
    assert got(found) == brute(n, SEEN if exclude else ())


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("exclude", [False, True])
def test_lists(spark, path, exclude):
    limits = {u: i % 4 for i, u in enumerate(QUERIES)}
    rows = [(u, v, limits[u]) for u, v in QUERIES.items()]
    queries = spark.createDataFrame(rows, "user_id string, factor array<double>, n int")
    seen = spark.createDataFrame(sorted(SEEN) * 2, "user_id string, product_id string")
    found = top_n(
        queries,
        vectors(spark, ITEMS, "product_id"),
        exclude=seen if exclude else None,
        n_col="n",
        lists=True,
        **PATHS[path],
    )
    want = {}
    for (u, _), hit in brute(0, SEEN if exclude else (), limits).items():
        want.setdefault(u, []).append(hit)
    assert {r.user_id: [tuple(x) for x in r.recs] for r in found.collect()} == want


@pytest.mark.parametrize("path", PATHS)
def test_limit_per_query(spark, path):
    limits = {u: i % 4 for i, u in enumerate(QUERIES)}
    rows = [(u, v, limits[u]) for u, v in QUERIES.items()]
    queries = spark.createDataFrame(rows, "user_id string, factor array<double>, n int")
    items = vectors(spark, ITEMS, "product_id")
    assert got(top_n(queries, items, n_col="n", **PATHS[path])) == brute(0, (), limits)


@pytest.mark.parametrize("path", PATHS)
@pytest.mark.parametrize("exclude", [False, True])
def test_probabilities(spark, path, exclude):
    seen = spark.createDataFrame(sorted(SEEN), "user_id string, product_id string")
    found = top_n(
        vectors(spark, QUERIES, "user_id"),
        vectors(spark, ITEMS, "product_id"),
        3,
        seen if exclude else None,
        temperature=2.0,
        **PATHS[path],
    ).collect()
    left_out = SEEN if exclude else set()
    for row in found:
        q = QUERIES[row.user_id]
        scores = {p: np.dot(q, v) for p, v in ITEMS.items() if (row.user_id, p) not in left_out}
        total = sum(np.exp(s / 2.0) for s in scores.values())
        assert row.probability == pytest.approx(np.exp(scores[row.product_id] / 2.0) / total)


def test_many_tiles(spark):
    rng = np.random.default_rng(1)
    items = {f"{i:05}": rng.standard_normal(3).tolist() for i in range(20_000)}
    queries = {f"u{i}": rng.standard_normal(3).tolist() for i in range(3)}
    found = got(
        top_n(vectors(spark, queries, "user_id"), vectors(spark, items, "product_id"), 7)
    )
    for u, q in queries.items():
        best = sorted(items, key=lambda p: -np.dot(q, items[p]))[:7]
        assert [found[(u, r)][0] for r in range(1, 8)] == best


def test_no_items_no_queries(spark):
    queries, items = vectors(spark, QUERIES, "user_id"), vectors(spark, ITEMS, "product_id")
    assert top_n(queries, items.limit(0)).count() == 0
    assert top_n(queries.limit(0), items).count() == 0
    assert top_n(queries, items.limit(0), lists=True).count() == 0
    assert top_n(queries.limit(0), items, lists=True).count() == 0


@pytest.mark.parametrize("path", PATHS)
def test_rows_without_vector_and_ragged_vectors(spark, path):
    queries = vectors(spark, {**QUERIES, "empty": None}, "user_id")
    items = vectors(spark, {**ITEMS, "none": None}, "product_id")
    assert got(top_n(queries, items, 3, **PATHS[path])) == brute(3)
    ragged = vectors(spark, {**ITEMS, "long": [1.0] * 5, "short": [1.0] * 3}, "product_id")
    with pytest.raises(Exception, match="differ in length"):
        top_n(queries, ragged, 3, **PATHS[path]).collect()


@pytest.mark.parametrize("path", PATHS)
def test_score_pairs_are_never_rows(spark, path):
    found = top_n(
        vectors(spark, QUERIES, "user_id"), vectors(spark, ITEMS, "product_id"), **PATHS[path]
    )
    plan = plan_of(found)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert path != "broadcast" or "Exchange" not in plan


def test_broadcast_is_measured(spark, monkeypatch):
    from clickloom.operators import matrix

    items = vectors(spark, ITEMS, "product_id")
    size = measure(items, "product_id")
    assert size.rows == 60 and size.bytes == 60 * 4 * 8 + sum(len(p) + 8 for p in ITEMS)
    monkeypatch.setattr(matrix, "BROADCAST_BYTES", size.bytes - 1)
    with pytest.raises(ValueError):
        broadcast_items(items, size, "product_id")


@pytest.mark.parametrize("excluded", [False, True])
def test_blocks_are_bounded_by_bytes(spark, monkeypatch, excluded):
    """However wide the vectors, a block of either side holds about as many bytes."""
    from clickloom.operators import topn

    queries, items = vectors(spark, QUERIES, "user_id"), vectors(spark, ITEMS, "product_id")
    pairs = spark.createDataFrame([(q, i) for q in QUERIES for i in list(ITEMS)[:5]],
                                  queries.select("user_id").schema.add("product_id", "string"))
    exclude = pairs if excluded else None
    want = {tuple(r) for r in top_n(queries, items, 3, exclude, digits=6)
            .select("user_id", "product_id", "rank").collect()}
    blocks, real = {}, topn._block
    monkeypatch.setattr(
        topn, "_block", lambda key, n, name: blocks.update({name: n}) or real(key, n, name)
    )
    monkeypatch.setattr(topn, "BLOCK_BYTES", 10 * 4 * 8, raising=False)
    found = top_n(queries, items, 3, exclude, digits=6, broadcast_bytes=0)
    assert {tuple(r) for r in found.select("user_id", "product_id", "rank").collect()} == want
    assert blocks["_ib"] >= len(ITEMS) / 10 and blocks["_qb"] >= len(QUERIES) / 10


def test_little_is_shipped(spark):
    """A worker holds a copy of what is shipped, and an executor has several workers."""
    from clickloom.operators import matrix, topn

    assert matrix.BROADCAST_BYTES <= 64 * 1024 * 1024
    assert topn.TILE_QUERIES * topn.TILE_ITEMS * 8 <= 16 * 1024 * 1024


def test_few_mentioned_items_are_shipped(spark, monkeypatch):
    """A catalogue too large to ship: the rows that sequences mention may still be few."""
    from clickloom.operators import encoding

    shipped, real = [], encoding.broadcast_items
    monkeypatch.setattr(
        encoding, "broadcast_items", lambda *a: shipped.append(a[1].rows) or real(*a)
    )
    items = vectors(spark, ITEMS, "product_id")
    requests = spark.createDataFrame(
        [(1, ["p1", "p2"], "p3"), (2, ["p2", "x"], "gone"), (3, ["x", "y"], None)],
        "request_id long, click_sequence array<string>, target string",
    )
    size = measure(items, "product_id")
    for options in ({}, {"broadcast_bytes": size.bytes - 1}, {"broadcast_bytes": 0}):
        rows = encode_sequences(
            requests, items, [0.5, 0.5], keep=("target",), score="target", **options
        ).collect()
        score = {r.request_id: r.score for r in rows}
        mean = (np.array(ITEMS["p1"]) + np.array(ITEMS["p2"])) / 4
        assert score == {1: pytest.approx(float(mean @ np.array(ITEMS["p3"]))), 2: None, 3: None}
    assert shipped == [60, 3]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "per_block": 2}])
def test_encoding(spark, options):
    items = {**ITEMS, "<PAD>": [0.5, 0.0, -0.5, 1.0]}
    weights = [0.4, 0.3, 0.2, 0.1]
    sequences = {
        1: ["p1"], 2: ["p1", "p2", "p3", "p4", "p5"], 3: ["x", "y", "z", "w"],
        4: ["p9", "x", "p9"], 5: [],
    }
    requests = spark.createDataFrame(
        list(sequences.items()), "request_id long, click_sequence array<string>"
    )
    rows = encode_sequences(
        requests, vectors(spark, items, "product_id"), weights, **options
    ).collect()
    assert len(rows) == 5
    for row in rows:
        seq = sequences[row.request_id][-4:]
        seq = ["<PAD>"] * (4 - len(seq)) + seq
        known = [(w, items[p]) for w, p in zip(weights, seq, strict=True) if p in items]
        want = sum((w * np.array(v) for w, v in known), np.zeros(4)) / max(len(known), 1)
        assert row.factor == pytest.approx(want.tolist())


def test_affinity_uses_context(spark):
    users = spark.createDataFrame([("u1", [1.0, 0.0]), ("u2", [1.0, 0.0])],
                                  "user_id string, features array<double>")
    products = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0])],
                                     "product_id string, features array<double>")
    context = spark.createDataFrame([("u2", "b"), ("u1", "gone")],
                                    "user_id string, product_id string")
    rows = affinity_top_k(users, products, context, k=1).collect()
    best = {r.user_id: (r.product_id, r.score) for r in rows}
    assert best["u1"] == ("a", 1.0)
    assert best["u2"] == ("b", pytest.approx(0.7))


def test_ties_are_cut_per_tile(monkeypatch):
    """All scores tie: no tile hands on more than it may keep, and the first ids win."""
    import numpy as np

    from clickloom.operators import topn

    monkeypatch.setattr(topn, "TILE_ITEMS", 100)
    sizes, merged = [], topn._merged
    monkeypatch.setattr(
        topn, "_merged", lambda best, more, *rest: sizes.append(len(more[0])) or merged(best, more, *rest)
    )
    none = np.empty(0, dtype=np.int64)
    q, i, score, rank, _ = topn._best_of(
        np.zeros((7, 4)), np.ones((1000, 4)), np.full(7, 5), (none, none), None, None
    )
    assert max(sizes) <= 7 * 5
    assert i.tolist() == list(range(5)) * 7 and rank.tolist() == [1, 2, 3, 4, 5] * 7
    assert q.tolist() == [n for n in range(7) for _ in range(5)] and not score.any()


# --- stopping early ---------------------------------------------------------


def skewed(count, width=8, seed=2):
    """Few long vectors and many short ones."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((count, width))
    rows *= (100.0 / np.arange(1, count + 1))[rng.permutation(count), None]
    return {f"{i:05}": v.tolist() for i, v in enumerate(rows)}


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "items_per_block": 3000}])
@pytest.mark.parametrize("digits", [None, 2])
def test_long_vectors_end_the_search(spark, options, digits):
    items = skewed(6000)
    rng = np.random.default_rng(3)
    queries = {f"u{i}": rng.standard_normal(8).tolist() for i in range(50)}
    scored = spark.sparkContext.accumulator(0)
    found = got(
        top_n(
            vectors(spark, queries, "user_id"), vectors(spark, items, "product_id"), 7,
            scored=scored, digits=digits, **options,
        )
    )
    names, matrix = list(items), np.array(list(items.values()))
    for u, q in queries.items():
        scores = matrix @ np.array(q)
        if digits is not None:
            scores = np.round(scores, digits)
        best = sorted(range(len(names)), key=lambda i: (-scores[i], names[i]))[:7]
        assert [found[(u, r)][0] for r in range(1, 8)] == [names[i] for i in best]
    assert 0 < scored.value < 0.5 * len(queries) * len(items)


def test_norm_index_covers_every_row():
    from clickloom.operators import topn

    matrix = np.array(list(skewed(5000).values()))
    index = topn.norm_index(matrix, first=10)
    assert np.array_equal(index.matrix[index.row], matrix)
    assert sorted(index.place.tolist()) == list(range(5000))
    norms = np.linalg.norm(index.matrix, axis=1)
    for a, b, largest in zip(index.starts, index.starts[1:], index.norms, strict=False):
        assert norms[a:b].max() == pytest.approx(largest)
        assert index.place[a:b].tolist() == sorted(index.place[a:b])
        assert b == 5000 or norms[b:].max() <= norms[a:b].min() + 1e-12
    assert topn.norm_index(np.empty((0, 0))).starts == [0]


def test_a_prepared_table_is_shipped_once(spark, monkeypatch):
    from clickloom.operators import topn

    calls = []
    real = topn.small_items
    monkeypatch.setattr(topn, "small_items", lambda *a: calls.append(1) or real(*a))
    items, queries = vectors(spark, ITEMS, "product_id"), vectors(spark, QUERIES, "user_id")
    prepared = topn.Prepared(items)
    for _ in range(3):
        assert got(top_n(queries, items, 4, prepared=prepared)) == brute(4)
    assert len(calls) == 1
    prepared.close()
    assert got(top_n(queries, items, 4, prepared=prepared)) == brute(4) and len(calls) == 2


# --- candidates in single precision ------------------------------------------


def ranked(queries, items, n, digits=None, excluded=()):
    """Positions and scores of each query's best items, from plain loops."""
    for u, q in enumerate(queries):
        scores = [float(np.einsum("d,d->", q, v)) for v in items]
        if digits is not None:
            scores = [float(np.round(x, digits)) for x in scores]
        left = [i for i in range(len(items)) if (u, i) not in excluded]
        for i in sorted(left, key=lambda i: (-scores[i], i))[:n]:
            yield u, i, scores[i]


@pytest.mark.parametrize("temperature", [None, 2.0])
def test_full_lists_are_only_compared(monkeypatch, temperature):
    """Once a list is full, a tile is compared with its last score and not sorted out."""
    from clickloom.operators import topn

    rng = np.random.default_rng(8)
    queries, items = rng.standard_normal((40, 16)), rng.standard_normal((20_000, 16))
    items /= np.linalg.norm(items, axis=1)[:, None]  # equal lengths: nothing ends the search
    sorted_out, real = [], np.partition
    monkeypatch.setattr(
        topn.np, "partition", lambda a, *rest, **kw: sorted_out.append(a.size) or real(a, *rest, **kw)
    )
    none = np.empty(0, dtype=np.int64)
    q, i, score, rank, mass = topn._best_of(
        queries, items, np.full(40, 5), (none, none), 6, temperature
    )
    want = list(ranked(queries, items, 5, 6))
    assert list(zip(q.tolist(), i.tolist(), score.tolist(), strict=True)) == want
    assert sum(sorted_out) < 0.25 * len(queries) * len(items)
    if temperature:
        scores = np.round(queries @ items.T, 6) / temperature
        assert mass[rank == 1] == pytest.approx(np.log(np.exp(scores).sum(axis=1)))


@pytest.mark.parametrize("scale", [1.0, 1e-40, 1e60, 1e-160])
def test_scores_that_differ_in_double_precision_only(monkeypatch, scale):
    from clickloom.operators import topn

    monkeypatch.setattr(topn, "TILE_ITEMS", 64)
    rng = np.random.default_rng(9)
    base = rng.standard_normal((5, 12))
    items = base[rng.integers(0, 5, 700)] * (1 + 1e-11 * rng.permutation(700)[:, None])
    items[rng.integers(0, 700, 30)] = 0.0
    queries = np.concatenate([rng.standard_normal((9, 12)), np.zeros((1, 12))]) * scale
    pairs = sorted({(int(rng.integers(0, 10)), int(rng.integers(0, 700))) for _ in range(2000)})
    out = tuple(np.array(x) for x in zip(*pairs, strict=True))
    q, i, score, *_ = topn._best_of(queries, items, np.full(10, 7), out, None, None)
    want = list(ranked(queries, items, 7, None, set(pairs)))
    assert list(zip(q.tolist(), i.tolist(), strict=True)) == [w[:2] for w in want]
    assert score == pytest.approx([w[2] for w in want])


@pytest.mark.parametrize("temperature", [0.001, 2.0])
def test_softmax_of_long_vectors(temperature):
    from clickloom.operators import topn

    rng = np.random.default_rng(10)
    queries, items = 30 * rng.standard_normal((6, 8)), rng.standard_normal((900, 8))
    none = np.empty(0, dtype=np.int64)
    *_, rank, mass = topn._best_of(queries, items, np.full(6, 3), (none, none), None, temperature)
    powers = queries @ items.T / temperature
    peak = powers.max(axis=1, keepdims=True)
    want = np.log(np.exp(powers - peak).sum(axis=1)) + peak[:, 0]
    assert mass[rank == 1] == pytest.approx(want)


@pytest.mark.parametrize("path", PATHS)
def test_excluded_pairs_are_sent_without_null_vectors(spark, monkeypatch, path):
    """Sending a row after n null lists takes n steps."""
    from clickloom.operators import topn

    pair, group = topn._per_pair, topn._per_group

    def full(asked):
        if asked["_vector"].null_count:
            raise ValueError("null vectors")
        return asked

    def per_pair(*given):
        run = pair(*given)

        def checked(asked, offered):
            return run(full(asked), offered)

        return checked

    def per_group(*given):
        run = group(*given)

        def checked(asked):
            return run(full(asked))

        return checked

    monkeypatch.setattr(topn, "_per_pair", per_pair)
    monkeypatch.setattr(topn, "_per_group", per_group)
    odd = [(None, "p1"), ("u1", None), (None, None), ("gone", "p1"), ("u1", "gone")]
    seen = spark.createDataFrame(sorted(SEEN) + odd, "user_id string, product_id string")
    found = top_n(
        vectors(spark, {**QUERIES, "empty": None}, "user_id"),
        vectors(spark, ITEMS, "product_id"),
        4,
        seen,
        **PATHS[path],
    )
    assert got(found) == brute(4, SEEN)


def test_few_scores_are_computed_twice(monkeypatch):
    """All scores in single precision, and only what may enter a list in double precision."""
    from clickloom.operators import topn

    twice, real = [], topn._products
    monkeypatch.setattr(
        topn, "_products", lambda *given: twice.append(len(given[2])) or real(*given)
    )
    rng = np.random.default_rng(12)
    queries, items = rng.standard_normal((60, 24)), rng.standard_normal((9_000, 24))
    items /= np.linalg.norm(items, axis=1)[:, None]
    index, none = topn.norm_index(items), np.empty(0, dtype=np.int64)
    for sign in (1, -1):
        q, i, score, *_ = topn._best_of(
            sign * queries, index, np.full(60, 6), (none, none), 6, None
        )
        want = list(ranked(sign * queries, items, 6, 6))
        assert list(zip(q.tolist(), i.tolist(), score.tolist(), strict=True)) == want
    assert index.near.dtype == np.float32
    assert 0 < sum(twice) < 0.02 * 2 * len(queries) * len(items)
