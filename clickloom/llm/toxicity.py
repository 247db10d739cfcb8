"""Toxicity by a factorization machine over hashed terms.

A term is a word, its first four to six letters, either of them occurring
several times, or the magnitude of the text's length, hashed into ``BUCKETS``
buckets. Spark counts every bucket over all labelled rows to learn
from. Two kinds of buckets enter the model: those that tell the classes apart by
themselves, and, of the frequent ones, those that do so beside another bucket,
however balanced each is alone. The model adds to a
weight per bucket the product of two short vectors for every pair of buckets
in a text, so that a pair can weigh more, or less, than its parts: an insult
beside the mention of a group is no longer the sum of both.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, text_or_empty
from clickloom.llm.langid import letter_words
from clickloom.session import materialize

BUCKETS = 1 << 18
FEATURES = 1024  # buckets in the model, those that tell most
LEAST_Z = 4.0
FREQUENT = 1024  # most frequent buckets whose pairs are looked at
PAIRED = 256  # buckets of the pairs that tell most beyond their parts
LEAST_PAIR_Z, LEAST_PAIR_ROWS = 6.0, 20
LEVELS = (2, 3, 5)
SAMPLE_ROWS = 20_000  # labelled rows that the weights are fitted on
FACTORS = 4
STEPS = 250
RATE = 0.05
DECAY = 1e-3
MEMORY = 200_000
SEED = 11


def buckets(word: str) -> tuple[int, ...]:
    """The hashed terms of a raw word."""
    found = []
    for run in letter_words(word):
        terms = [f"w:{run}"] + [f"{n}:{run[:n]}" for n in (4, 5, 6) if len(run) > n]
        found += [zlib.crc32(t.encode()) % BUCKETS for t in terms]
    return tuple(found)


def at_least(bucket, times: int):
    """The bucket of a term that occurs so many times; numbers or arrays of them."""
    return (bucket * 40_503 + times * 65_537) % BUCKETS


def length_bucket(words: int) -> int:
    return zlib.crc32(f"n:{words.bit_length()}".encode()) % BUCKETS


class _Words(dict):
    """Terms of the words a worker has met; with ``wanted`` only those a model needs."""

    def __init__(self, wanted: dict[int, int] | None = None):
        self.wanted, self.needed = wanted, None
        if wanted is not None:
            every, ids = np.arange(BUCKETS), np.array(sorted(wanted), "i8")
            need = np.isin(every, ids)
            for times in LEVELS:
                need |= np.isin(at_least(every, times), ids)
            self.needed = set(np.flatnonzero(need).tolist())

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = buckets(word)
        if self.needed is not None:
            found = tuple(b for b in found if b in self.needed)
        self[word] = found
        return found

    def of(self, text: str) -> set[int]:
        """The text's terms, those that repeat, and its length; as the model numbers them."""
        if len(self) > MEMORY:
            self.clear()
        words = text.split()
        seen: dict[int, int] = {}
        for word, n in Counter(words).items():
            for b in self[word]:
                seen[b] = seen.get(b, 0) + n
        out = {length_bucket(len(words)), *seen}
        for b, n in seen.items():
            if n > 1:
                out.update([at_least(b, times) for times in LEVELS if n >= times])
        if self.wanted is None:
            return out
        return {self.wanted[b] for b in out if b in self.wanted}


def _bucket_counts(rows: DataFrame) -> DataFrame:
    """(bucket, toxic, clean): documents per bucket of rows (text, label)."""

    def run(batches):
        words = _Words()
        for batch in batches:
            counts = np.zeros((2, BUCKETS), "i8")
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                np.add.at(counts[label], list(words.of(text)), 1)
            used = np.flatnonzero(counts.any(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(used), pa.array(counts[1, used]), pa.array(counts[0, used])],
                names=["bucket", "toxic", "clean"],
            )

    counts = rows.mapInArrow(run, "bucket long, toxic long, clean long")
    return counts.groupBy("bucket").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def _telling(counts: DataFrame, toxic: int, clean: int, features: int) -> list[int]:
    """The buckets whose share differs most between the classes, by z-score."""
    share = (F.col("toxic") + F.col("clean")) / float(toxic + clean)
    apart = F.col("toxic") / float(toxic) - F.col("clean") / float(clean)
    z = F.abs(apart) / F.sqrt(share * (1 - share) * (1.0 / toxic + 1.0 / clean))
    top = (
        counts.where(share < 1)
        .withColumn("z", z)
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.col("z").desc(), "bucket")
        .limit(features)
    )
    return [r["bucket"] for r in top.select("bucket").collect()]


def _frequent(counts: DataFrame, rows: int) -> list[int]:
    """The buckets of most rows, but for those that most rows have."""
    both = F.col("toxic") + F.col("clean")
    top = counts.where(both <= 0.9 * rows).orderBy(both.desc(), "bucket").limit(FREQUENT)
    return [r["bucket"] for r in top.select("bucket").collect()]


def _paired(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Columns of pairs whose toxic share differs most from what both shares add up to."""
    rows, base = x.sum(0), float(y.mean())
    toxic = x[y > 0]
    share = toxic.sum(0) / np.maximum(rows, 1)
    both, found = x.T @ x, toxic.T @ toxic
    expected = np.clip(share[:, None] + share[None, :] - base, 0, 1)
    spread = np.sqrt(base * (1 - base) / np.maximum(both, 1))
    z = np.abs(found / np.maximum(both, 1) - expected) / spread
    # Neither a rare pair nor one term under two names says anything about a pair.
    alike = both >= 0.9 * np.minimum(rows[:, None], rows[None, :])
    z[(both < LEAST_PAIR_ROWS) | alike | (z < LEAST_PAIR_Z)] = 0
    a, b = np.nonzero(np.triu(z, 1))
    best = np.lexsort((b, a, -z[a, b]))
    order = np.column_stack([a[best], b[best]]).ravel()
    _, first = np.unique(order, return_index=True)
    return order[np.sort(first)][:PAIRED]


@dataclass
class FactorizationMachine:
    wanted: dict[int, int]
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def margin(self, features: set[int]) -> float:
        at = list(features)
        own = self.factors[at]
        pairs = (own.sum(0) ** 2 - (own**2).sum(0)).sum() / 2
        return self.bias + self.weights[at].sum() + pairs

    def score(self, features: set[int]) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.margin(features), -30, 30))))


def _fitted(x: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Logistic loss with decay, full gradient, step sizes by Adam."""
    draw = np.random.default_rng(SEED)
    n, size = x.shape
    rate = (y.sum() + 0.5) / (n + 1)
    state = [
        np.array([np.log(rate / (1 - rate))], "f4"),
        np.zeros(size, "f4"),
        draw.normal(0, 0.05, (size, FACTORS)).astype("f4"),
    ]
    first, second = [np.zeros_like(s) for s in state], [np.zeros_like(s) for s in state]
    for step in range(1, STEPS + 1):
        bias, weights, factors = state
        sums = x @ factors
        margin = bias[0] + x @ weights + ((sums**2).sum(1) - (x @ factors**2).sum(1)) / 2
        off = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - y) / n
        each = x.T @ off
        slopes = [
            np.array([off.sum()]),
            each + DECAY * weights / size,
            x.T @ (off[:, None] * sums) - factors * each[:, None] + DECAY * factors / size,
        ]
        for s, g, a, b in zip(state, slopes, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g**2 - b)
            mean, var = a / (1 - 0.9**step), b / (1 - 0.999**step)
            s -= (RATE * mean / (np.sqrt(var) + 1e-8)).astype("f4")
    return float(state[0][0]), state[1].astype("f8"), state[2].astype("f8")


def fit(
    rows: DataFrame,
    id_col: str = ID,
    text_col: str = TEXT,
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
) -> FactorizationMachine:
    """Learn from rows with an id and a label 0 or 1.

    Bucket counts cover all of them; pairs are looked at, and the weights fitted, on at
    most about ``sample_rows``, taken by a hash of the id, over at most ``features`` +
    ``PAIRED`` buckets, which bounds what the driver holds. Without both classes every
    score is 1/2.
    """
    known = rows.select(
        F.col(id_col).alias("_id"),
        text_or_empty(text_col).alias("text"),
        F.col(label_col).cast("int").alias("label"),
    ).where("_id IS NOT NULL AND label IN (0, 1)")
    known = materialize(known, "toxicity-rows")
    sizes = dict(known.groupBy("label").count().collect())
    none = FactorizationMachine({}, 0.0, np.zeros(0), np.zeros((0, FACTORS)))
    if len(sizes) < 2:
        return none
    counts = materialize(_bucket_counts(known.select("text", "label")), "toxicity-buckets")
    telling = set(_telling(counts, sizes[1], sizes[0], features))
    frequent = _frequent(counts, sizes[0] + sizes[1])
    looked = sorted(telling.union(frequent))
    wanted = {b: i for i, b in enumerate(looked)}
    share = sample_rows / (sizes[0] + sizes[1])
    draw = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)

    def run(batches):
        words = _Words(wanted)
        for batch in batches:
            found = [sorted(words.of(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.list_(pa.int32())), batch.column(1)],
                names=["features", "label"],
            )

    table = (
        known.where(draw < share)
        .select("text", "label")
        .mapInArrow(run, "features array<int>, label int")
        .toArrow()
    )
    x = np.zeros((table.num_rows, len(looked)), "f4")
    lists = table.column("features").combine_chunks()
    x[pc.list_parent_indices(lists).to_numpy(), lists.flatten().to_numpy()] = 1
    # Alike rows add nothing but weight; order them so that sums repeat exactly.
    y = table.column("label").to_numpy().astype("f4")
    if len(set(y.tolist())) < 2:
        return none
    at = np.array([wanted[b] for b in frequent], "i8")
    paired = {looked[i] for i in at[_paired(x[:, at], y)]} if len(at) else set()
    kept = sorted(telling | paired)
    x, wanted = x[:, [wanted[b] for b in kept]], {b: i for i, b in enumerate(kept)}
    order = np.lexsort((y, *(x[:, j] for j in range(min(64, x.shape[1])))))
    return FactorizationMachine(wanted, *_fitted(x[order], y[order]))


def score(
    docs: DataFrame, model: FactorizationMachine, id_col: str = ID, text_col: str = TEXT
) -> DataFrame:
    """One row per document: id, score from 0 to 1.

    A null text scores as the empty one, by the model's bias. Repeated rows
    give repeated rows; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        words = _Words(own.wanted)
        for batch in batches:
            scores = [own.score(words.of(t)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64())], names=[id_col, "score"]
            )

    rows = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, score double")
