"""Spelling variants by asymmetric q-chunks.

Two words are near if one inserted, deleted or replaced code point turns one into
the other. The shorter (or, of equal lengths, either) word contributes two disjoint
chunks, its two halves; one edit leaves one of them as it is, at the same place or,
behind an insertion, one further on. The other word contributes its positional
grams, of which only those can meet a chunk that have its size and stand within a
shift of one: two for words of the same length, two for words one longer. Groups of
equal (length, side, chunk) meet in a task, where the rest of the words is verified
by hashing it with one code point left out, so a group costs what it has rows and
lists no pairs. Of the two chunks the one without the edit counts (the last of a run
of equal code points is the inserted one), so every pair is found in one group only.
A group above ``GROUP`` rows goes back to the cluster, where the verified chunk is
extended by each half of what is left, until less than two code points are.

Only counts and the best neighbour of each word leave a task.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, text_or_empty
from clickloom.session import materialize

LEAST_LENGTH, LEAST_COUNT = 7, 2
RATIO = 10
DROP_OF = 31  # one run in so many loses a code point
GROUP = 20_000
HELD_WORDS = 200_000
PIECE = 1 << 20
# Letters of the first 256 code points; A-Z is lower-cased, what is not a letter separates.
LETTERS = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b >= 0xC0 else 32
    for b in range(256)
)


def runs(text: str):
    """The letter runs of a text in Latin-1 (a byte is a code point), in bounded pieces."""

    def flat(start: int) -> bytes:
        return text[start : start + PIECE].encode("latin-1", "replace").translate(LETTERS)

    at = 0
    while at < len(text):
        piece = flat(at)
        at += len(piece)
        while at < len(text) and not piece.endswith(b" "):
            more = flat(at)
            more = more[: more.find(b" ") + 1 or len(more)]
            piece += more
            at += len(more)
        yield piece.split()


def changed(doc_id: str, found: Counter) -> Counter:
    """The runs of a document, some without one code point (as the task defines)."""
    start, out = zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, times in found.items():
        coded = run if run.isascii() else run.decode("latin-1").encode()
        h = zlib.crc32(coded, start)
        if h % DROP_OF == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        out[run] += times
    return out


def word_counts(
    docs: DataFrame, id_col: str = ID, text_col: str = TEXT, least: int = LEAST_LENGTH
) -> DataFrame:
    """(word, n): the distinct words of at least ``least`` code points and their occurrences."""

    def flushed(held):
        words = pa.array([w.decode("latin-1") for w in held], pa.string())
        return pa.RecordBatch.from_arrays(
            [words, pa.array(held.values(), pa.int64())], names=["word", "n"]
        )

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found: Counter = Counter()
                for piece in runs(text):
                    found.update(r for r in piece if len(r) >= least)
                for word, times in changed(doc_id, found).items():
                    if len(word) >= least:
                        held[word] += times
                if len(held) > HELD_WORDS:
                    yield flushed(held)
                    held = Counter()
        yield flushed(held)

    rows = docs.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col).alias("_text")
    )
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _keyed(members: DataFrame) -> DataFrame:
    """Each member (word, n, size, low, high) under both halves of its middle.

    ``size`` is the length of the words without an insertion in the group, ``low`` and
    ``high`` the code points known to be equal on either side. A word of ``size`` + 1
    is the longer one and has its grams one further on behind the edit.
    """
    cut = (F.col("low") + F.floor((F.col("size") - F.col("low") - F.col("high")) / 2)).cast("int")
    longer = F.length("word") - F.col("size")
    both = members.withColumn("_cut", cut).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    front = F.substring("word", F.lit(1), F.col("_cut"))
    back = F.substring("word", F.col("_cut") + longer + 1, F.length("word"))
    head = F.substring("word", F.lit(1), F.col("low"))
    tail = F.substring("word", F.length("word") - F.col("high") + 1, F.col("high"))
    first = F.col("side") == 0
    return both.select(
        "word",
        "n",
        "size",
        F.when(first, F.col("_cut")).otherwise(F.col("low")).alias("low"),
        F.when(first, F.col("high")).otherwise(F.col("size") - F.col("_cut")).alias("high"),
        F.when(first, front).otherwise(head).alias("head"),
        F.when(first, tail).otherwise(back).alias("tail"),
    )


def _meet(group, size: int, low: int, high: int, best: dict) -> None:
    """Count the near pairs of a group: words equal but for one code point of their middle."""
    masked, whole = defaultdict(list), defaultdict(list)
    for word, n in group:
        if len(word) == size:
            middle = word[low : size - high]
            whole[middle].append((word, n))
            for i in range(len(middle)):
                masked[i, middle[:i] + middle[i + 1 :]].append((word, n))
    for near in masked.values():
        if len(near) > 1:
            top = sorted(near, key=lambda x: (-x[1], x[0]))[:2]
            for word, _ in near:
                _note(best, word, len(near) - 1, *(top[1] if top[0][0] == word else top[0]))
    for word, n in group:
        if len(word) == size:
            continue
        # Where the back is fixed, an insertion right before it belongs to the front's group.
        middle = word[low : size + 1 - high]
        for i in range(len(middle) - (high > 0)):
            if word[low + i + 1 : low + i + 2] != middle[i]:  # the last of its run
                for short, m in whole.get(middle[:i] + middle[i + 1 :], ()):
                    _note(best, word, 1, short, m)
                    _note(best, short, 1, word, n)


def _note(best: dict, word: str, near: int, other: str, n: int) -> None:
    count, (less, form) = best.get(word, (0, (0, "")))
    best[word] = (count + near, min((less, form), (-n, other)))


def _verified(keyed: DataFrame, largest: int) -> DataFrame:
    """Partial (word, near, less, form) of all groups; the rows of larger groups come back.

    ``less`` is the negative count of the best near word ``form``. A row that comes
    back has ``near`` null and keeps what the next level needs.
    """
    keys = ["size", "low", "high", "head", "tail"]
    names = ["word", "n", "size", "low", "high", "near", "less", "form"]
    kinds = [pa.string(), pa.int64(), *[pa.int32()] * 3, *[pa.int64()] * 2, pa.string()]
    schema = pa.schema(list(zip(names, kinds)))

    def run(batches):
        now, group, over, out = None, [], False, []
        best: dict = {}

        def close():
            if group and not over:
                _meet(group, *now[:3], best)

        def drained():
            rows = [(w, None, None, None, None, c, *top) for w, (c, top) in best.items()] + out
            best.clear()
            out.clear()
            columns = zip(*rows) if rows else [[]] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], schema=schema
            )

        for batch in batches:
            for *key, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                if key != now:
                    close()
                    now, group, over = key, [], False
                group.append((word, n))
                # A middle of one letter cannot be cut; the letters there are bound its group.
                if (len(group) > largest and key[0] - key[1] - key[2] > 1) or over:
                    over = True
                    out += [(*row, *key[:3], None, None, None) for row in group]
                    group = []
            if len(best) + len(out) > HELD_WORDS:
                yield drained()
        close()
        yield drained()

    parts = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(parts, *keys).sortWithinPartitions(*keys)
    kinds_sql = "word string, n long, size int, low int, high int, near long, less long, form string"
    return dealt.select(*keys, "word", "n").mapInArrow(run, kinds_sql)


def near_words(words: DataFrame, least: int = LEAST_LENGTH, group: int = GROUP) -> list[DataFrame]:
    """Partial (word, near, less, form) of (word, n) with distinct words, one frame per level."""
    zero = F.lit(0)
    level = words.select("word", "n", F.length("word").alias("size"), zero.alias("low"), zero.alias("high"))
    longer = level.where(F.col("size") > least).withColumn("size", F.col("size") - 1)
    level, found = level.unionByName(longer), []
    while True:
        part = materialize(_verified(_keyed(level), group), "variants-level")
        found.append(part.where("near IS NOT NULL").select("word", "near", "less", "form"))
        level = part.where("near IS NULL").select("word", "n", "size", "low", "high")
        if level.isEmpty():
            return found


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): the ends of the chains (word, form), by doubling the steps."""
    steps = materialize(forms, "variants-forms")
    while True:
        ahead = steps.select(F.col("word").alias("_at"), F.col("form").alias("_next"))
        both = steps.join(ahead, steps["form"] == ahead["_at"], "left")
        both = both.select(
            "word",
            F.coalesce("_next", "form").alias("form"),
            F.col("_next").isNotNull().alias("moved"),
        )
        both = materialize(both, "variants-forms")
        steps = both.drop("moved")
        if both.where("moved").isEmpty():
            return steps.withColumnRenamed("form", "root")


def group_variants(
    docs: DataFrame,
    id_col: str = ID,
    text_col: str = TEXT,
    least: int = LEAST_LENGTH,
    least_count: int = LEAST_COUNT,
    ratio: int = RATIO,
    group: int = GROUP,
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of at least ``least`` letters.

    ``form`` is the near word of largest count (ties: the smallest) if that is at
    least ``ratio`` times the word's own; ``root`` the end of the chain of forms. A
    null text has no words, a null id counts as an empty one; repeated rows count
    again; an empty table gives no rows; other columns are ignored.
    """
    counts = word_counts(docs, id_col, text_col, least).where(F.col("n") >= least_count)
    words = materialize(counts, "variants-words")
    none = {"near": F.lit(None).cast("long"), "less": F.lit(None).cast("long")}
    rows = words.withColumns({**none, "form": F.lit(None).cast("string")})
    for part in near_words(words, least, group):
        rows = rows.unionByName(part, allowMissingColumns=True)
    best = F.min(F.when(F.col("near").isNotNull(), F.struct("less", "form")))
    found = rows.groupBy("word").agg(
        F.max("n").alias("n"),
        F.coalesce(F.sum("near"), F.lit(0)).alias("n_near"),
        best.alias("best"),
    )
    frequent = -F.col("best.less") >= ratio * F.col("n")
    found = materialize(
        found.select(
            "word",
            F.when(frequent, F.col("best.form")).alias("form"),
            "n",
            "n_near",
            F.when(frequent, -F.col("best.less")).alias("form_n"),
        ),
        "variants-found",
    )
    roots = _roots(found.where("form IS NOT NULL").select("word", "form"))
    named = roots.select(F.col("word").alias("_word"), "root")
    return found.join(named, found["word"] == named["_word"], "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
