"""Secret scan: fixed patterns, and formats learned as probabilistic automata.

The patterns give spans and, with them, labelled credentials. From a bounded
sample of those, one automaton per kind is inferred: a tree of all prefixes
with counts, in which states that are statistically alike (Hoeffding bound on
every outgoing share) are merged. Every candidate of the corpus that no
pattern covers is then scored by its likelihood under each automaton, and
becomes a span where it is no less likely than the credentials themselves are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, in_arrow, text_or_empty
from clickloom.session import materialize

# Fixed by the contract: kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
KEYWORDS = ("pass", "secret", "token", "api")
LEARNED = "format"

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{12,}")
SAMPLE = 1_000  # credentials per kind that an automaton is inferred from
LONGEST = 256  # symbols of a credential that are learned from
ALPHA = 0.05
UNSEEN = math.log(1e-4)
RECALL = 0.99  # share of the sample that the likelihood limit lets pass


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the patterns, by start, then kind."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= 12:
                found.append(("assign", m.start(), m.end(), m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= 18:
                found.append(("access", m.start(), m.end(), m[0]))
    for m in HEX.finditer(text):
        found.append(("hex", m.start(), m.end(), m[0]))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, spans: list[tuple]) -> list[tuple[int, int, str]]:
    """Runs of 12 or more credential characters with a digit and a letter, outside the spans."""
    found = []
    for m in CANDIDATE.finditer(text):
        run = m[0]
        if run.isalpha() or not any(c.isdigit() for c in run) or not any(c.isalpha() for c in run):
            continue
        if not any(s < m.end() and m.start() < e for _, s, e, _ in spans):
            found.append((m.start(), m.end(), run))
    return found


# --------------------------------------------------------------------------
# Automata
# --------------------------------------------------------------------------


def symbols(credential: str) -> str:
    """Character classes: digit, hexadecimal and other letters by case; other characters as such."""
    out = []
    for c in credential:
        if c.isdigit():
            out.append("0")
        elif "a" <= c <= "z":
            out.append("a" if c <= "f" else "z")
        elif "A" <= c <= "Z":
            out.append("A" if c <= "F" else "Z")
        else:
            out.append(c)
    return "".join(out)


@dataclass
class State:
    visits: int = 0
    ends: int = 0
    to: dict[str, int] = field(default_factory=dict)
    uses: dict[str, int] = field(default_factory=dict)


class Automaton:
    """A probabilistic automaton over symbol strings, inferred by merging states."""

    def __init__(self, words: Counter, alpha: float = ALPHA):
        self.bound = math.sqrt(0.5 * math.log(2 / alpha))
        self.states = [State()]
        for word, n in sorted(words.items()):
            self._add(word, n)
        self._infer()
        scores = sorted((self.score(w), n) for w, n in words.items())
        skip = (1 - RECALL) * sum(words.values())
        self.limit = -math.inf
        for value, n in scores:
            self.limit = value
            skip -= n
            if skip < 0:
                break

    def _add(self, word: str, n: int) -> None:
        at = 0
        self.states[0].visits += n
        for c in word:
            state = self.states[at]
            if c not in state.to:
                state.to[c] = len(self.states)
                state.uses[c] = 0
                self.states.append(State())
            state.uses[c] += n
            at = state.to[c]
            self.states[at].visits += n
        self.states[at].ends += n

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        if not n1 or not n2:
            return False
        return abs(f1 / n1 - f2 / n2) > self.bound * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _alike(self, a: int, b: int) -> bool:
        """Whether a, kept, and the tree below b agree in every outgoing share."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            one, two = self.states[a], self.states[b]
            if self._differ(one.ends, one.visits, two.ends, two.visits):
                return False
            for c in one.to.keys() | two.to.keys():
                uses = one.uses.get(c, 0), two.uses.get(c, 0)
                if self._differ(uses[0], one.visits, uses[1], two.visits):
                    return False
                if c in one.to and c in two.to:
                    todo.append((one.to[c], two.to[c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            one, two = self.states[a], self.states[b]
            one.visits += two.visits
            one.ends += two.ends
            for c, child in two.to.items():
                if c in one.to:
                    one.uses[c] += two.uses[c]
                    todo.append((one.to[c], child))
                else:
                    one.to[c], one.uses[c] = child, two.uses[c]

    def _infer(self) -> None:
        kept = [0]
        fringe = [(0, c) for c in sorted(self.states[0].to)]
        while fringe:
            parent, c = fringe.pop(0)
            child = self.states[parent].to[c]
            if child in kept:
                continue
            for known in kept:
                if self._alike(known, child):
                    self.states[parent].to[c] = known
                    self._fold(known, child)
                    break
            else:
                kept.append(child)
            fringe = [
                (k, s)
                for k in kept
                for s in sorted(self.states[k].to)
                if self.states[k].to[s] not in kept
            ]
        number = {old: new for new, old in enumerate(kept)}
        self.states = [self.states[k] for k in kept]
        for state in self.states:
            state.to = {c: number[t] for c, t in state.to.items()}

    def score(self, word: str) -> float:
        """Log-likelihood per symbol, the end included."""
        at, total = 0, 0.0
        for c in word:
            state = self.states[at]
            if c in state.to:
                total += math.log(state.uses[c] / state.visits)
                at = state.to[c]
            else:
                total += UNSEEN
        state = self.states[at]
        total += math.log(state.ends / state.visits) if state.ends else UNSEEN
        return total / (len(word) + 1)

    def accepts(self, word: str) -> bool:
        return self.score(word) >= self.limit


# --------------------------------------------------------------------------
# On Spark
# --------------------------------------------------------------------------

_FOUND = (
    "spans array<struct<kind:string,start:long,end:long,value:string>>, "
    "candidates array<struct<start:long,end:long,value:string>>"
)


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.struct(
        [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())]
    )
    free = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches):
        for batch in batches:
            spans, others = [], []
            for text in batch.column(1).to_pylist():
                own = base_spans(text)
                spans.append([dict(zip(("kind", "start", "end", "value"), s)) for s in own])
                others.append(
                    [dict(zip(("start", "end", "value"), c)) for c in candidates(text, own)]
                )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(spans, pa.list_(span)),
                    pa.array(others, pa.list_(free)),
                ],
                names=[id_col, "spans", "candidates"],
            )

    rows = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return in_arrow(rows, run, f"`{id_col}` {kind}, {_FOUND}")


def learn(found: DataFrame, sample: int = SAMPLE) -> list[Automaton]:
    """One automaton per kind from at most ``sample`` distinct credentials each.

    The sample is the credentials of the smallest hashes, so it is the same at
    every run; credentials are learned from up to ``LONGEST`` symbols.
    """
    values = found.select(F.explode("spans").alias("s")).select("s.kind", "s.value").distinct()
    automata = []
    for kind in KINDS:
        rows = (
            values.where(F.col("kind") == kind)
            .orderBy(F.xxhash64("value"), "value")
            .limit(sample)
            .select(F.substring("value", 1, LONGEST).alias("value"))
            .collect()
        )
        words = Counter(symbols(r["value"]) for r in rows)
        if words:
            automata.append(Automaton(words))
    return automata


def scan(
    docs: DataFrame, id_col: str = ID, text_col: str = TEXT, sample: int = SAMPLE
) -> DataFrame:
    """One row per document: id, spans (array of kind, start, end, value).

    Offsets are code points, the end exclusive; spans are in order of start,
    then kind, learned ones (kind ``format``) last. Null texts count as empty
    and have none; repeated rows give repeated rows; other columns are ignored;
    an empty table gives no rows.
    """
    found = materialize(_found(docs, id_col, text_col), "secrets")
    automata = found.sparkSession.sparkContext.broadcast(learn(found, sample))
    kind = docs.schema[id_col].dataType.simpleString()
    order = {k: i for i, k in enumerate((*KINDS, LEARNED))}

    def run(batches):
        models = automata.value
        for batch in batches:
            spans = []
            for own, free in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                for c in free:
                    text = symbols(c["value"])
                    if any(m.accepts(text) for m in models):
                        own.append({"kind": LEARNED, **c})
                spans.append(sorted(own, key=lambda s: (s["start"], order[s["kind"]])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(spans, batch.schema.field(1).type)],
                names=[id_col, "spans"],
            )

    return found.mapInArrow(run, f"`{id_col}` {kind}, {_FOUND.split(', candidates')[0]}")


def span_text(spans) -> F.Column:
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def redact(docs: DataFrame, id_col: str = ID, text_col: str = TEXT) -> DataFrame:
    """``docs`` with every span replaced by ``[SECRET]``; overlapping spans as one.

    Texts without spans, and null texts, stay as they are. Works on the text
    and spans of the same row: spans are found again rather than joined.
    """
    learned = materialize(_found(docs, id_col, text_col), "secrets")
    automata = docs.sparkSession.sparkContext.broadcast(learn(learned))
    at = docs.columns.index(text_col)

    def run(batches):
        models = automata.value
        for batch in batches:
            texts = []
            for text in batch.column(at).to_pylist():
                texts.append(text if text is None else _redacted(text, models))
            arrays = list(batch.columns)
            arrays[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return in_arrow(docs, run, docs.schema)


def _redacted(text: str, models: list[Automaton]) -> str:
    spans = base_spans(text)
    places = [(s, e) for _, s, e, _ in spans]
    places += [
        (s, e)
        for s, e, value in candidates(text, spans)
        if any(m.accepts(symbols(value)) for m in models)
    ]
    out, end = [], 0
    for s, e in sorted(places):
        if s >= end:
            out += [text[end:s], "[SECRET]"]
        end = max(end, e)
    return "".join([*out, text[end:]])
