"""BPE encoding by a depth-first walk of the trie of distinct words, and decoding.

Every task walks its own words: the new words of an Arrow batch are
sorted, which is the depth-first order of their trie, and each prefix carries
one state, the last token of its encoding. The state of a longer prefix is the
one token that ends it and may follow the state in front of that token, so a
prefix that many words share is encoded once and an encoding is read back from
the states. No shuffle and no table of words that grows with the corpus: a
task remembers words up to a bound of bytes.
"""

from __future__ import annotations

import json
import re
from functools import cache
from itertools import chain
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import ID, TEXT, in_arrow, text_or_empty

MEMORY = 16 << 20  # bytes of one generation of remembered words
ENTRY = 150  # of an entry besides its text and ids
FOLLOWS = 1_000_000  # pairs of tokens whose seam is remembered
LONG = 256  # pieces of more letters are encoded along the trie
CHUNK = 512


SHORT = (2, 1)


def _sizes(tokens) -> dict[str, tuple[int, ...]]:
    """Lengths of the tokens that may end like these three characters, longest first."""
    found: dict[str, set[int]] = {}
    for token in tokens:
        if len(token) >= 3:
            found.setdefault(token[-3:], set()).add(len(token))
    return {tail: (*sorted(sizes, reverse=True), *SHORT) for tail, sizes in found.items()}


class WordTrie:
    """Token states along the trie of the words given to ``encode``."""

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str):
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            whole = vocab[a + b]
            self.rank[vocab[a], vocab[b]] = rank
            self.parts.setdefault(whole, (rank, vocab[a], vocab[b]))
        self.size = {i: len(t.removesuffix(suffix)) for t, i in vocab.items()}
        self.follows: dict[int, bool] = {}
        whole: dict[int, bool] = {}
        for token in vocab.values():  # parts have smaller ranks, so the depth is that of the merges
            self._whole(token, whole)
        kept = {t: i for t, i in vocab.items() if whole[i]}
        self.inner = {t: i for t, i in kept.items() if not t.endswith(suffix)}
        self.final = {t.removesuffix(suffix): i for t, i in kept.items() if t.endswith(suffix)}
        self.inner_sizes, self.final_sizes = _sizes(self.inner), _sizes(self.final)

    def _apart(self, a: int, b: int, seam_skipped: bool = False) -> bool:
        """Whether a and b stay apart at their seam until both are complete.

        The merges that made a and b are undone, latest first; if the tokens at
        the seam could have merged before a merge that is undone, they would have.
        """
        before = len(self.rank) + 1
        while True:
            seam = self.rank.get((a, b))
            if seam is not None and seam < before and not seam_skipped:
                return False
            seam_skipped = False
            made_a, made_b = self.parts.get(a), self.parts.get(b)
            if not made_a and not made_b:
                return True
            if made_b and (not made_a or made_b[0] >= made_a[0]):
                before, b = made_b[0] + 1, made_b[1]  # of equal merges the left one comes first
            else:
                before, a = made_a[0], made_a[2]

    def _whole(self, token: int, known: dict[int, bool]) -> bool:
        """Whether the token's own text is encoded as the token."""
        if token not in known:
            made = self.parts.get(token)
            known[token] = not made or (
                self._whole(made[1], known)
                and self._whole(made[2], known)
                and self._apart(made[1], made[2], seam_skipped=True)
            )
        return known[token]

    def _state(self, word: str, end: int, tokens, sizes, states: list[int]) -> int:
        """The token that ends ``word[:end]`` and may follow the state in front of it."""
        follows = self.follows
        for size in sizes.get(word[end - 3 : end], SHORT) if end > 2 else SHORT:
            start = end - size
            if start < 0:
                continue
            token = tokens.get(word[start:end])
            if token is None:
                continue
            if start == 0:
                return token
            before = states[start]
            if before < 0:
                before = states[start] = self._state(
                    word, start, self.inner, self.inner_sizes, states
                )
            pair = before << 32 | token
            apart = follows.get(pair)
            if apart is None:
                if len(follows) > FOLLOWS:
                    follows.clear()
                apart = follows[pair] = self._apart(before, token)
            if apart:
                return token
        raise ValueError(f"no encoding of {word[:end]!r}")

    def encode(self, words) -> dict[str, bytes]:
        """The ids of each word, as little-endian 32-bit numbers.

        A prefix gets its state when one is asked for, which of a word most never are;
        prefixes of long words get theirs in turn, so that the asking stays shallow.
        """
        out: dict[str, bytes] = {}
        states, before = [0], ""
        for word in sorted(words):
            shared = 0
            for a, b in zip(before[:-1], word[:-1]):
                if a != b:
                    break
                shared += 1
            del states[shared + 1 :]
            states += [-1] * (len(word) - len(states))
            if len(word) > LONG:
                for end in range(1, len(word)):
                    if states[end] < 0:
                        states[end] = self._state(
                            word, end, self.inner, self.inner_sizes, states
                        )
            token = self._state(word, len(word), self.final, self.final_sizes, states)
            end, ids = len(word) - self.size[token], [token]
            while end:
                ids.append(states[end])
                end -= self.size[states[end]]
            ids.reverse()
            out[word] = pack(f"<{len(ids)}I", *ids)
            before = word
        return out


class Memory:
    """What a task remembers, in two generations of at most about ``MEMORY`` bytes.

    When the young one is full it becomes the old one; entries used since move on.
    """

    def __init__(self):
        self.forget()

    def __len__(self) -> int:
        return len(self.young)

    def forget(self) -> None:
        # Plain dictionaries: a set is compared with them by its own keys, however many they hold.
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.bytes = 0

    def remember(self, keys, values) -> None:
        self.young.update(zip(keys, values))
        self.bytes += sum(map(len, keys)) + sum(map(len, values)) + ENTRY * len(keys)

    def missing(self, keys: set[str]) -> set[str]:
        """Keys in neither generation; those in the old one become young."""
        if self.bytes > MEMORY:
            self.old, self.young, self.bytes = self.young, {}, 0
        new = keys.difference(self.young)
        if self.old:
            gone = new.difference(self.old)
            used = list(new.difference(gone))
            self.remember(used, [self.old[k] for k in used])
            return gone
        return new


class Encoder:
    """Texts to ids and back; equal to the library's result without special tokens added.

    Texts of printable ASCII and precomposed Latin letters, which the library's
    normalisation only lowers, are cut into pieces by one regular expression;
    any other text is cut by the library.
    """

    LETTERS = "a-z\u00df-\u00f6\u00f8-\u00ff\u0100-\u017f"
    # The library's alternatives, the most frequent one first; no other begins with a letter.
    PIECE = re.compile(rf"[{LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9]|[^\s{LETTERS}0-9]+")
    ODD = re.compile(
        "[^\t\n\v\f\r -~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\u0100-\u012f\u0131-\u017f]"
    )

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path, self.library = path, Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        vocab = spec["model"]["vocab"]
        self.tokens = [""] * (max(chain(vocab.values(), self.special.values())) + 1)
        for token, i in chain(vocab.items(), self.special.items()):
            self.tokens[i] = token
        self.known = Memory()
        self._prepare(spec["model"])

    def _prepare(self, model: dict) -> None:
        """What the encoding needs of the file; the rest of it is not kept."""
        raise NotImplementedError

    def _learn(self, pieces: list[str]) -> list[bytes]:
        raise NotImplementedError

    def _odd(self, text: str) -> bytes:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian 32-bit numbers."""
        odd, marks, pieces = self.ODD, tuple(self.special), self.PIECE.findall
        cut = [
            None if odd.search(t) or any(m in t for m in marks) else pieces(t.lower())
            for t in texts
        ]
        known = self.known
        new = list(known.missing(set().union(*[own for own in cut if own])))
        known.remember(new, self._learn(new))
        ids = known.young.__getitem__
        return [
            self._odd(text) if own is None else b"".join(map(ids, own))
            for text, own in zip(texts, cut)
        ]

    def decode(self, ids) -> str:
        """As the library does without a decoder: the tokens with a space between them."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


class TrieEncoder(Encoder):
    """New pieces are encoded along their trie."""

    def _prepare(self, model: dict) -> None:
        self.trie = WordTrie(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.split = self.library.pre_tokenizer.pre_tokenize_str
        self.normalise = self.library.normalizer.normalize_str
        self.byte_letters = str.maketrans(_byte_letters())

    def _learn(self, pieces: list[str]) -> list[bytes]:
        letters = [
            p if p.isascii() else p.encode().decode("latin-1").translate(self.byte_letters)
            for p in pieces
        ]
        ids = self.trie.encode(set(letters))
        return [ids[x] for x in letters]

    def _odd(self, text: str) -> bytes:
        out: list[str | bytes] = []
        for part in self.marks.split(text):
            if part in self.special:
                out.append(pack("<I", self.special[part]))
            elif part:
                out += [p for p, _ in self.split(self.normalise(part))]
        ids = self.trie.encode({p for p in out if isinstance(p, str)})
        return b"".join([ids[p] if isinstance(p, str) else p for p in out])


class MergeEncoder(Encoder):
    """New pieces are merged all together: one array of symbols, a merge per piece and step.

    The steps grow with a piece's length, so long pieces take the trie.
    """

    NONE = np.iinfo("i8").max

    def _prepare(self, model: dict) -> None:
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs])
        order = np.argsort(key)
        self.key, self.rank = key[order], order
        self.whole = np.array([vocab[a + b] for a, b in pairs])
        # The symbols of a byte: inside a piece, and at its end.
        letters = _byte_letters()
        self.inner = np.array([vocab[letters[x]] for x in range(256)])
        self.final = np.array([vocab[letters[x] + suffix] for x in range(256)])

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return np.where(self.key[at] == pair, self.rank[at], self.NONE)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        long = [p for p in pieces if len(p) > LONG]
        if not long:
            return self._merged(pieces)
        ids = dict(zip(long, encoder(self.path)._learn(long)))
        short = [p for p in pieces if len(p) <= LONG]
        ids.update(zip(short, self._merged(short)))
        return [ids[p] for p in pieces]

    def _merged(self, pieces: list[str]) -> list[bytes]:
        if not pieces:
            return []
        coded = [p.encode() for p in pieces]
        sizes = np.array([len(c) for c in coded])
        flat = np.frombuffer(b"".join(coded), "u1")
        symbol, last = self.inner[flat], np.cumsum(sizes) - 1
        symbol[last] = self.final[flat[last]]
        row = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(symbol), self.NONE)  # of the pair that begins here
        inside = np.flatnonzero(row[1:] == row[:-1])
        rank[inside] = self._ranks(symbol[inside], symbol[inside + 1])
        done_rows, done_symbols = [], []
        while len(symbol):
            start = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            sizes = np.diff(start, append=len(row))
            best = np.minimum.reduceat(rank, start)
            going = best != self.NONE
            if not going.all():
                keep = np.repeat(going, sizes)
                done_rows.append(row[~keep])
                done_symbols.append(symbol[~keep])
                symbol, row, rank = symbol[keep], row[keep], rank[keep]
                best, sizes = best[going], sizes[going]
                if not len(symbol):
                    break
            at = np.flatnonzero(rank == np.repeat(best, sizes))
            at = at[np.concatenate([[True], row[at[1:]] != row[at[:-1]]])]  # the leftmost
            symbol[at] = self.whole[rank[at]]
            keep = np.ones(len(symbol), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))  # one symbol fewer before each later merge
            symbol, row, rank = symbol[keep], row[keep], rank[keep]
            rank[at] = self.NONE
            for here in (at[at > 0] - 1, at[at < len(row) - 1]):
                pair = here[row[here] == row[here + 1]]
                rank[pair] = self._ranks(symbol[pair], symbol[pair + 1])
        rows, symbols = np.concatenate(done_rows), np.concatenate(done_symbols)
        order = np.argsort(rows, kind="stable")
        data = symbols[order].astype("<u4").tobytes()
        ends = (4 * np.cumsum(np.bincount(rows, minlength=len(pieces)))).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]

    def _odd(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next one from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}


@cache
def encoder(path: str, kind: type[Encoder] = TrieEncoder) -> Encoder:
    """One per worker process."""
    return kind(path)


def encode_decode(
    docs: DataFrame, tokenizer: str, id_col: str = ID, text_col: str = TEXT
) -> DataFrame:
    """One row per document: id, ``ids`` (array of int) and ``decoded`` (their text).

    ``tokenizer`` is the path of a vocabulary file that every executor can
    read. Null texts count as empty and have no ids; repeated rows give
    repeated rows; other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        own = encoder(tokenizer)
        own.known.forget()
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                ids = [np.frombuffer(x, "<i4") for x in own.encode(part.column(1).to_pylist())]
                ends = np.cumsum([0] + [len(x) for x in ids]).astype("int32")
                flat = np.concatenate(ids) if ids else np.empty(0, "int32")
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())),
                        pa.array([own.decode(x.tolist()) for x in ids], pa.string()),
                    ],
                    names=[id_col, "ids", "decoded"],
                )
        own.known.forget()

    rows = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return in_arrow(rows, run, f"`{id_col}` {kind}, ids array<int>, decoded string")


def ids_digest(ids) -> F.Column:
    """SHA-256 of the decimal ids joined by one space, lowercase hex."""
    return F.sha2(F.encode(F.array_join(ids.cast("array<string>"), " "), "UTF-8"), 256)
