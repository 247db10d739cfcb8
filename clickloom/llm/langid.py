"""Language identification by character models with interpolated Kneser-Ney smoothing.

One model per language over words of letters, padded at their start and closed
at their end. Counts come from a hash sample of the labelled rows whose size
per language is a parameter; Spark counts the four-character grams, and the
model is built from that table. It is stored as sorted arrays of gram keys,
with the smoothed log-probability of every language beside each key, so a
gram is found by one binary search; a gram that no language has seen backs off
to the shorter one. A text gets the language of the least cross-entropy per
character, and is rejected when that lies beyond what calibration rows of the
language, kept out of the counts, show for texts of its length.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import ID, TEXT, in_arrow
from clickloom.session import materialize

ORDER = 4  # four characters of 16 bits make a key of 64
SAMPLE_ROWS = 20_000  # rows learned from, per language
MAX_LANGUAGES = 1_000  # the most frequent ones
MAX_GRAMS = 4_000_000  # of all languages together; beyond, each keeps its most frequent
MAX_CELLS = 16_000_000  # distinct grams times languages
CALIBRATION = 10  # one row of so many is kept out of the counts
CALIBRATION_ROWS = 2_000
ALL_CALIBRATION_ROWS = 1_000_000
LENIENCE = 1.75  # times the mean entropy; texts that mix known languages stay below
OUTLIERS = 0.005  # share of the calibration rows that may be garbled
MEMORY = 32 << 20  # bytes of remembered words and their scores
ENTRY = 200  # of a remembered word besides its scores
COUNTED, SCORED, WORDS = 1_000, 512, 20_000  # rows and words held at a time
FEW = 25  # languages up to which so many are held
START, END = "\x01", "\x02"
UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(word: str) -> list[str]:
    """The runs of letters in lower case."""
    found = []
    for run in LETTERS.findall(word.lower()):
        if run.isalpha():
            found.append(run)
        else:
            found += "".join(c if c.isalpha() else " " for c in run).split()
    return found


def language_words(word: str) -> list[str]:
    """Its runs of letters; none of a word with a digit, such as a number, key or address."""
    return [] if any(c.isdigit() for c in word) else letter_words(word)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The key of each predicted character, end included, and the number per word."""
    pad = START * (ORDER - 1)
    text = "".join([pad + w + END for w in words])
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("u8") & np.uint64(0xFFFF)
    keys = codes.copy()
    for back in range(1, ORDER):
        keys[back:] |= codes[:-back] << np.uint64(16 * back)
    starts = np.cumsum([0] + [len(w) + ORDER for w in words[:-1]])
    predicted = np.ones(len(codes), bool)
    for k in range(ORDER - 1):
        predicted[starts + k] = False
    return keys[predicted], np.array([len(w) + 1 for w in words])


# --------------------------------------------------------------------------
# Counting on Spark
# --------------------------------------------------------------------------


def _slices(batches, rows: int):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _gram_counts(rows: DataFrame) -> DataFrame:
    """(lang, gram, n) of rows (lang, text); counted per batch before the shuffle."""

    def run(batches):
        for part in _slices(batches, COUNTED):
            by: dict[str, Counter] = {}
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                by.setdefault(lang, Counter()).update(text.split())
            for lang, counts in by.items():
                words: Counter = Counter()
                for word, n in counts.items():
                    for run_ in language_words(word):
                        words[run_] += n
                if not words:
                    continue
                keys, sizes = grams(list(words))
                weights = np.repeat(np.fromiter(words.values(), "i8", len(words)), sizes)
                keys, at = np.unique(keys, return_inverse=True)
                n = np.bincount(at, weights).astype("i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(keys)), pa.array(keys.view("i8")), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    counts = in_arrow(rows, run, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _frequent(counts: DataFrame) -> DataFrame:
    """The grams to learn: all, or as many of the most frequent of each language as fit.

    The rank up to which grams are kept is the same for all languages and the largest that
    leaves ``MAX_GRAMS`` rows and ``MAX_CELLS`` distinct grams times languages; at least 1.
    """
    sizes = sorted(r["count"] for r in counts.groupBy("lang").count().collect())
    total, many = sum(sizes), len(sizes)
    if total <= MAX_GRAMS and total * many <= MAX_CELLS:
        return counts
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    ranked = materialize(counts.withColumn("rank", F.row_number().over(order)), "langid-ranked")
    left, most = MAX_GRAMS, sizes[-1]
    if total > MAX_GRAMS:
        for at, size in enumerate(sizes):
            most = left // (many - at)
            if size > most:
                break
            left -= size
    best = ranked.where(F.col("rank") <= most).groupBy("gram").agg(F.min("rank").alias("rank"))
    fits = MAX_CELLS // many
    if best.count() > fits:
        # Of the first that do not fit, all of their rank are left out.
        most = best.orderBy("rank").limit(fits + 1).agg(F.max("rank")).first()[0] - 1
    return ranked.where(F.col("rank") <= max(most, 1)).drop("rank")


# --------------------------------------------------------------------------
# The model
# --------------------------------------------------------------------------


@dataclass
class LanguageModel:
    """Sorted key arrays per order 1..ORDER, with a row of values per key.

    ``logp[k]``: log-probability of each language after smoothing; ``back[k]``:
    log-weight with which a context of order k hands on to the shorter gram.
    ``level`` and ``spread`` are the calibrated entropy limits per language.
    """

    languages: list[str]
    keys: list[np.ndarray]
    logp: list[np.ndarray]
    contexts: list[np.ndarray]
    back: list[np.ndarray]
    unseen: np.ndarray
    level: np.ndarray
    spread: np.ndarray

    def log_probabilities(self, gram: np.ndarray) -> np.ndarray:
        """(number of grams, languages)."""
        out = np.zeros((len(gram), len(self.languages)))
        open_, weight = np.arange(len(gram)), np.zeros((len(gram), len(self.languages)))
        for k in range(ORDER - 1, -1, -1):
            key = gram[open_] & np.uint64((1 << 16 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.keys[k], key), len(self.keys[k]) - 1)
            hit = self.keys[k][at] == key
            out[open_[hit]] = weight[hit] + self.logp[k][at[hit]]
            open_, weight, key = open_[~hit], weight[~hit], key[~hit]
            if not len(open_):
                return out
            if k:
                at = np.searchsorted(self.contexts[k], key >> np.uint64(16))
                at = np.minimum(at, len(self.contexts[k]) - 1)
                seen = self.contexts[k][at] == key >> np.uint64(16)
                weight[seen] += self.back[k][at[seen]]
        out[open_] = weight + self.unseen
        return out

    def word_scores(self, words: list[list[str]]) -> np.ndarray:
        """Per raw word: the sum of log-probabilities of each language, and the characters."""
        out = np.zeros((len(words), len(self.languages) + 1))
        flat = [r for runs in words for r in runs]
        if flat:
            keys, sizes = grams(flat)
            owner = np.repeat(np.arange(len(words)), [len(runs) for runs in words])
            sums = np.add.reduceat(
                self.log_probabilities(keys), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            )
            np.add.at(out, owner, np.column_stack([sums, sizes]))
        return out

    def limits(self, chars: np.ndarray, lang: np.ndarray) -> np.ndarray:
        return self.level[lang] + self.spread[lang] / np.sqrt(chars)


def _build(languages: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
    """The arrays of a model from counts of the longest grams."""
    size = len(languages)
    per_order: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(ORDER)]
    for i in range(size):
        own = np.argsort(gram[lang == i])
        key, count = gram[lang == i][own], n[lang == i][own].astype("f8")
        for k in range(ORDER - 1, -1, -1):
            per_order[k].append((key, count))
            # Continuations: in how many longer grams the shorter one ends.
            key, count = np.unique(key & np.uint64((1 << 16 * k) - 1), return_counts=True)
            count = count.astype("f8")
    keys, logp, contexts, back, lower = [], [], [], [], None
    letters = len(np.unique(np.concatenate([k for k, _ in per_order[0]]))) + 1
    unseen = np.zeros(size)
    for k in range(ORDER):
        union = np.unique(np.concatenate([key for key, _ in per_order[k]]))
        context = np.unique(union >> np.uint64(16))
        p, weight = np.zeros((len(union), size)), np.ones((len(context), size))
        where = np.searchsorted(context, union >> np.uint64(16))
        for i, (key, count) in enumerate(per_order[k]):
            ones, twos = (count == 1).sum(), (count == 2).sum()
            off = min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5
            at = np.searchsorted(union, key)
            total = np.bincount(where[at], count, len(context))
            kinds = np.bincount(where[at], minlength=len(context))
            known = total > 0
            weight[known, i] = off * kinds[known] / total[known]
            p[at, i] = np.maximum(count - off, 0) / total[where[at]]
        if k:
            shorter = np.searchsorted(keys[k - 1], union & np.uint64((1 << 16 * k) - 1))
            p += weight[where] * lower[shorter]
        else:
            p += weight[where] / letters
            unseen = np.log(weight[0] / letters)
        keys.append(union)
        contexts.append(context)
        logp.append(np.log(p))
        back.append(np.log(weight))
        lower = p
    return keys, logp, contexts, back, unseen


def fit(
    rows: DataFrame,
    id_col: str = ID,
    text_col: str = TEXT,
    lang_col: str = "lang",
    sample_rows: int = SAMPLE_ROWS,
) -> LanguageModel:
    """Learn from ``rows`` with text, language and id.

    ``sample_rows`` per language bounds what is learned from: rows are taken by
    a hash of their id, so the choice is the same at every run. Of more than
    ``MAX_LANGUAGES`` languages the most frequent are learned, of more grams than
    the model holds the most frequent of each language. With no such rows the
    model knows no language.
    """
    known = rows.select(
        F.col(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    ).where("_id IS NOT NULL AND text IS NOT NULL AND lang IS NOT NULL")
    ranked = known.groupBy("lang").count().orderBy(F.desc("count"), "lang")
    sizes = dict(ranked.limit(MAX_LANGUAGES).collect())
    languages = sorted(sizes)
    empty = LanguageModel([], [], [], [], [], *(np.zeros(0) for _ in range(3)))
    if not languages:
        return empty
    draw = F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    shares = known.sparkSession.createDataFrame(
        [(lang, sample_rows / sizes[lang]) for lang in languages], "lang string, _share double"
    )
    share = F.col("_share")
    sample = known.join(F.broadcast(shares), "lang").where(draw < share)
    fold = F.pmod(F.xxhash64("_id", F.lit("fold")), F.lit(CALIBRATION))
    counts = materialize(
        _gram_counts(sample.where(fold != 0).select("lang", "text")), "langid-grams"
    )
    table = _frequent(counts).toArrow()
    if not table.num_rows:
        return empty
    names = table.column("lang").to_pylist()
    languages = sorted(set(names))
    number = {lang: i for i, lang in enumerate(languages)}
    arrays = _build(
        languages,
        np.array([number[x] for x in names]),
        table.column("gram").to_numpy().view("u8"),
        table.column("n").to_numpy(),
    )
    model = LanguageModel(languages, *arrays, *(np.zeros(len(languages)) for _ in range(2)))
    rest = sample.where(fold == 0).withColumn("_draw", draw / share)
    wanted = min(CALIBRATION_ROWS, ALL_CALIBRATION_ROWS // len(languages))
    rest = rest.where(F.col("_draw") < wanted * CALIBRATION / sample_rows)
    return _calibrated(model, rest)


def _calibrated(model: LanguageModel, rows: DataFrame) -> LanguageModel:
    """Entropy limits per language from held-out rows: well above the mean level, plus
    the worst excess over it, which shrinks with the root of the length. The ``OUTLIERS``
    of the rows, one at least, that lie furthest beyond the typical level count for neither."""
    scored = _scored(rows.select("lang", "text"), model).where("chars > 0").toArrow()
    number = {lang: i for i, lang in enumerate(model.languages)}
    lang = np.array([number.get(x, -1) for x in scored.column("lang").to_pylist()], "i8")
    order = np.argsort(lang, kind="stable")
    sums = np.column_stack([scored.column(name).to_numpy() for name in ("own", "chars")])[order]
    ends = np.searchsorted(lang[order], np.arange(len(number) + 1))
    for i in range(len(number)):
        own = sums[ends[i] : ends[i + 1]]
        if not len(own):
            model.level[i] = np.inf
            continue
        root, entropy = np.sqrt(own[:, 1]), -own[:, 0] / own[:, 1]
        beyond = (entropy - LENIENCE * np.median(entropy)) * root
        outliers = min(math.ceil(OUTLIERS * len(own)), len(own) - 1)
        kept = np.argsort(beyond, kind="stable")[: len(own) - outliers]
        mean = -own[kept, 0].sum() / own[kept, 1].sum()
        excess = (entropy[kept] - LENIENCE * mean) * root[kept]
        model.level[i] = LENIENCE * mean
        model.spread[i] = max(excess.max(), 2 * mean)
    return model


# --------------------------------------------------------------------------
# Scoring
# --------------------------------------------------------------------------

class _Memory:
    """Scores of the words that a task has met, in at most about ``MEMORY`` bytes."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.clear()
        # Scores double in size when they are full, and are copied then.
        self.most = MEMORY // (ENTRY + 3 * 8 * (len(model.languages) + 1))
        self.words = WORDS // max(1, len(model.languages) // FEW)

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.zeros((1024, len(self.model.languages) + 1))

    def document_sums(self, texts: list[str]) -> np.ndarray:
        if len(self.rows) > self.most:
            self.clear()
        cut = [t.split() for t in texts]
        new = list({w for words in cut for w in words if w not in self.rows})
        if new:
            first = len(self.rows)
            self.rows.update(zip(new, range(first, first + len(new))))
            while len(self.scores) < len(self.rows):
                self.scores = np.concatenate([self.scores, np.zeros_like(self.scores)])
            for at in range(0, len(new), self.words):
                part = [language_words(w) for w in new[at : at + self.words]]
                self.scores[first + at : first + at + len(part)] = self.model.word_scores(part)
        rows = self.rows
        out = np.zeros((len(texts), self.scores.shape[1]))
        for i, words in enumerate(cut):
            if words:
                out[i] = self.scores[[rows[w] for w in words]].sum(0)
                if not out[i, -1]:  # all its letters, if any, are in words with digits
                    out[i] = self.model.word_scores([letter_words(" ".join(words))])[0]
        return out


def _scored(rows: DataFrame, model: LanguageModel) -> DataFrame:
    """(lang, own, chars): per text the log-probability of its language, and the characters."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        memory = _Memory(shared.value)
        number = {lang: i for i, lang in enumerate(shared.value.languages)}
        for part in _slices(batches, _held(shared.value)):
            sums = memory.document_sums([t or "" for t in part.column(1).to_pylist()])
            at = np.array([number.get(lang, -1) for lang in part.column(0).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sums[np.arange(len(at)), at]), pa.array(sums[:, -1])],
                names=["lang", "own", "chars"],
            )

    return in_arrow(rows, run, "lang string, own double, chars double")


def _held(model: LanguageModel) -> int:
    """Rows scored at a time: less with many languages, as each has a column."""
    return max(16, SCORED // max(1, len(model.languages) // FEW))


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = ID, text_col: str = TEXT
) -> DataFrame:
    """One row per document: id, lang_pred, score, entropy, rejected.

    ``lang_pred`` is ``und``, with score 0 and rejected, where the text is null
    or has no letter, or where the model knows no language. ``score`` is the
    share of the best language among all, at the evidence of at most 40
    characters; ties go to the language that sorts first. Repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = f"`{id_col}` {kind}, lang_pred string, score double, entropy double, rejected boolean"

    def run(batches):
        own = shared.value
        memory, size = _Memory(own), len(own.languages)
        names = np.array([*own.languages, UNKNOWN], object)
        for part in _slices(batches, _held(own)):
            if size:
                texts = [t or "" for t in part.column(1).to_pylist()]
                sums = memory.document_sums(texts)
            else:
                sums = np.zeros((part.num_rows, 1))
            chars = sums[:, -1]
            some = chars > 0
            best = np.full(part.num_rows, size)
            score, entropy = np.zeros(part.num_rows), np.zeros(part.num_rows)
            rejected = np.ones(part.num_rows, bool)
            if some.any():
                each = -sums[some, :-1] / chars[some, None]
                top = each.argmin(1)
                least = each.min(1)
                evidence = np.minimum(chars[some], 40)[:, None]
                best[some] = top
                score[some] = 1 / np.exp((least[:, None] - each) * evidence).sum(1)
                entropy[some] = least
                rejected[some] = least > own.limits(chars[some], top)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0),
                    pa.array(names[best].tolist(), pa.string()),
                    pa.array(score),
                    pa.array(entropy),
                    pa.array(rejected),
                ],
                names=[id_col, "lang_pred", "score", "entropy", "rejected"],
            )

    return in_arrow(docs.select(id_col, text_col), run, schema)


def keep_recognised(docs: DataFrame, model: LanguageModel, text_col: str = TEXT) -> DataFrame:
    """The rows whose text is not rejected, with all their columns; a narrow step."""
    at = docs.columns.index(text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        memory = _Memory(own)
        for part in _slices(batches, _held(own)):
            keep = np.zeros(part.num_rows, bool)
            if own.languages:
                sums = memory.document_sums([t or "" for t in part.column(at).to_pylist()])
                some = np.flatnonzero(sums[:, -1] > 0)
                each = -sums[some, :-1] / sums[some, -1:]
                keep[some] = each.min(1) <= own.limits(sums[some, -1], each.argmin(1))
            yield part.filter(pa.array(keep))

    return in_arrow(docs, run, docs.schema)
