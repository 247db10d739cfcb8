"""Ranked search, repeat removal and spelling variants against plain Python."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickloom.llm import lexical, queries, repeats, variants
from clickloom.llm.common import table

SF = "/root/testdata/sf0.001"
# Extra columns whose names clash with those the operators make.
CLASH = ("rank", "score", "spans", "kept", "word", "doc", "data", "_keys", "n", "length", "_text")


def rows_of(spark, rows, id_col="doc_id"):
    data = [(i, t, *("x" for _ in CLASH)) for i, t in rows]
    return spark.createDataFrame(
        data, f"{id_col} long, text string, " + ", ".join(f"`{c}` string" for c in CLASH)
    )


@pytest.fixture(scope="module")
def real(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()]


# -------------------------------------------------------------- ranked search

DOCS = [
    (1, "The quick brown fox; the fox."), (2, "quick quick QUICK"), (3, None), (4, ""),
    (5, "fox"), (6, "fox"), (6, "fox"), (None, "fox"), (7, "-- ?? \x7f"),
    (8, "ÉTÉ été naïve 日本 12 fox's"), (9, "fox " * 30_000), (10, "brown " + "pad " * 500),
]
ITEMS = [
    (1, "quick fox"), (2, "fox fox FOX"), (3, None), (4, ""), (5, "unknown words"),
    (6, "ÉTÉ 日本 naïve"), (1, "brown the"), (None, "fox's 12"), (7, "!!"),
]


def found_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("options", [{}, {"shard_postings": 3}, {"block_terms": 2}, {"k": 1}])
def test_search_matches_brute_force(spark, options):
    docs, items = rows_of(spark, DOCS), rows_of(spark, ITEMS, "item_id")
    found = lexical.search(docs.repartition(3), items, **options)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert found_rows(found) == brute.ranked(DOCS, ITEMS, options.get("k", 20))


def test_search_over_the_tables(spark, real):
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    found = queries.op11_lexical_search(spark, SF).select("item_id", "rank", "doc_id", "score")
    assert found_rows(found) == brute.ranked(real[1], items)


def test_search_of_empty_tables(spark):
    docs, items = rows_of(spark, DOCS), rows_of(spark, ITEMS, "item_id")
    columns = ["item_id", "rank", "doc_id", "score"]
    for a, b in ((docs.limit(0), items), (docs, items.limit(0))):
        found = lexical.search(a, b)
        assert found.columns == columns and found.count() == 0


def test_lists_are_not_read_to_the_end():
    """The best documents lead their lists: the rest of long lists stays unread."""
    n, k = 100_000, 5
    impacts = np.concatenate([np.arange(1000, 990, -1), np.full(n - 10, 3)])
    reads = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            reads.append(at)
            return np.asarray(self)[at]

    docs = np.concatenate([np.arange(n), np.arange(n)])
    both = np.concatenate([impacts, impacts]).view(Counted)
    best, score = lexical.read_lists([(1, 0, n), (2, n, 2 * n)], docs, both, n, np.arange(n), k, 0)
    assert best.tolist() == list(range(k)) and score.tolist() == [3 * x for x in range(1000, 995, -1)]
    assert max(s.stop for s in reads if isinstance(s, slice) and s.start < n) < n / 100


def test_long_texts_are_cut_between_terms():
    text = b"Ab " * (lexical.PIECE // 2) + b"x" * (2 * lexical.PIECE) + b" end"
    found = Counter(w for piece in lexical.words(text) for w in piece)
    assert found == Counter(text.lower().split())


# -------------------------------------------------------------- repeat removal


def check_repeats(spark, rows, **options):
    docs = rows_of(spark, rows)
    found = repeats.remove_repeats(docs.repartition(3), **options).collect()
    coded = [(i, (t or "").encode()) for i, t in rows]
    want = []
    for (i, data), spans in zip(coded, brute.repeats(coded, options.get("length", 50))):
        edges = [0, *(x for s in spans for x in s), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
        want.append((i, len(data), spans, kept))
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def passages(seed, count=60):
    rng = random.Random(seed)
    prose = lambda n: "".join(rng.choice("abcdefgh é日") for _ in range(n))
    shared = [prose(rng.randrange(45, 400)) for _ in range(8)]
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            piece = rng.choice(shared)
            a = rng.randrange(len(piece))
            parts += [prose(rng.randrange(0, 120)), piece[a : a + rng.randrange(40, 300)]]
        rows.append((rng.randrange(count), "".join(parts)))
    return rows


ODD = [
    (1, None), (2, ""), (3, "x" * 49), (4, "x" * 50), (5, "x" * 51), (6, "x" * 5000), (7, "x" * 49),
    (8, "ab" * 400), (9, "ba" * 300), (10, "abcabcabc" * 60), (10, "abcabcabc" * 60),
    (None, "abcabcabc" * 60), (11, "z" * 30 + "x" * 60 + "y" * 30), (12, "y" * 120),
    (13, "=" * 100 + "end"), (14, "=" * 80 + "end"), (15, "é" * 200), (16, "a" + "é" * 100),
]


@pytest.mark.parametrize("rows", [ODD, passages(1), passages(2)], ids=["odd", "one", "two"])
def test_repeats_match_brute_force(spark, rows):
    check_repeats(spark, rows)


def test_repeats_without_small_lists(spark, monkeypatch):
    """Beyond the broadcast bound, ids are joined by a shuffle."""
    from clickloom.llm import common

    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    check_repeats(spark, passages(3))


def test_repeats_across_slices(spark, monkeypatch):
    """Phrases that end at a slice's border still meet those that do not."""
    monkeypatch.setattr(repeats, "SLICE", 97)
    check_repeats(spark, passages(4, 20))
    with pytest.raises(ValueError, match="at least"):
        repeats.remove_repeats(rows_of(spark, ODD), length=30)


def test_repeats_of_other_lengths_and_empty_tables(spark):
    check_repeats(spark, passages(5, 20), length=64)
    found = repeats.remove_repeats(rows_of(spark, ODD).limit(0))
    assert found.columns == ["doc_id", "n_bytes", "spans", "kept"] and found.count() == 0


def test_repeats_of_frequent_triggers(spark, monkeypatch):
    """Groups above the bound are decided by window functions, to the same end."""
    for seed in (6, 7):
        docs = rows_of(spark, passages(seed))
        known = docs.where("doc_id IS NOT NULL").selectExpr("doc_id AS doc", "encode(text, 'UTF-8') AS data")
        found = [
            sorted(
                (r._doc, sorted(r._whole), sorted(r._single))
                for r in repeats.repeated_keys(known, largest=largest).collect()
            )
            for largest in (0, 2, 1 << 20)
        ]
        assert found[0] == found[1] == found[2] and found[0]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=200), min_size=1, max_size=4), st.integers(1, 90))
def test_every_window_has_one_phrase_and_equal_ones_the_same_trigger(texts, size):
    texts = [t.encode() for t in texts]
    triggers, seen = {}, [[] for _ in texts]
    for block in repeats.blocks(texts, 50, size):
        found = repeats.Phrases(block, 50)
        shift = (block.place - block.start)[found.part]
        rows = zip(found.row, found.start + shift, found.end + shift, found.a >> np.uint64(16))
        for row, start, end, trigger in rows:
            for at in range(start, end):
                seen[row].append(at)
                assert triggers.setdefault(texts[row][at : at + 50], trigger) == trigger
    assert seen == [list(range(len(t) - 49)) for t in texts]


def test_common_windows_lie_within_the_sides_searched():
    """Whatever two phrases share a window, the sides they share lead to it."""
    rng = random.Random(9)
    for _ in range(300):
        middle = bytes(rng.choices(b"abcdefgh", k=rng.randrange(50, 60)))
        pair = [
            bytes(rng.choices(b"abcdefgh", k=40)) + middle + bytes(rng.choices(b"abcdefgh", k=40))
            for _ in range(2)
        ]
        keys = []
        for text in pair:
            (block,) = repeats.blocks([text], 50)
            found = repeats.Phrases(block, 50)
            keys.append((text, found, found.a >> np.uint64(16), found.b >> np.uint64(16)))
        (text, one, t1, p1), (other, two, t2, p2) = keys
        covered = set()
        for i in range(len(one.start)):
            for j in range(len(two.start)):
                if t1[i] != t2[j]:
                    continue
                if p1[i] == p2[j]:
                    covered |= set(range(one.start[i], one.end[i]))
                sides = 0
                for bit, x in ((1, "a"), (2, "b")):
                    left, right = (getattr(f, x)[n] & np.uint64(0xFFFF) for f, n in ((one, i), (two, j)))
                    sides |= bit * (left == right != 0)
                place, _ = one.windows(np.array([i]), np.array([sides]))
                if sides:
                    covered |= set(place.tolist())
        shared = [s for s in range(len(text) - 49) if text[s : s + 50] in other]
        assert shared and set(shared) <= covered


def test_a_long_text_costs_bounded_slices():
    rng = np.random.default_rng(0)
    data = rng.integers(97, 123, 1_500_000, dtype="u1").tobytes()
    twice = data + data
    block = next(repeats.blocks([twice], 50))
    assert len(block.data) <= repeats.SLICE + 49
    first = repeats.Phrases(block, 50)
    whole = repeats._of_row(first.key()[100:101], np.zeros(1, "i8"))
    (spans,) = repeats.spans_of([twice], whole, np.empty(0, "u8"), 50)
    assert spans == [
        (at + int(first.start[100]), at + int(first.end[100]) + 49) for at in (0, len(data))
    ]


# ------------------------------------------------------------ spelling variants


def words_of(seed, count=300):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abÉé") for _ in range(rng.randrange(7, 10))) for _ in range(25)]
    texts = []
    for i in range(count):
        words = []
        for _ in range(rng.randrange(0, 12)):
            word = rng.choice(base[: 1 + rng.randrange(25)])
            if rng.random() < 0.4:
                at = rng.randrange(len(word))
                word = word[:at] + rng.choice(["", "a", "bé", "ab"]) + word[at + 1 :]
            words.append(word)
        texts.append((rng.choice([i, i, 7, None]), rng.choice([" ", "-", "\n", "ß1"]).join(words)))
    return [*texts, (1, None), (2, ""), (3, "short one"), (4, "aaaaaaa aaaaaaaa aaaaaaaaa " * 3)]


def check_variants(spark, rows, **options):
    found = variants.group_variants(rows_of(spark, rows).repartition(3), **options).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert len(got) == len(found)
    assert got == brute.variants(rows)
    return got


@pytest.mark.parametrize("group", [20_000, 3])
def test_variants_match_brute_force(spark, group):
    """With groups of three rows every group but the last level goes back to the cluster."""
    got = check_variants(spark, words_of(1), group=group)
    assert any(form for form, *_ in got.values())


def test_chains_of_forms_end_at_the_root(spark):
    a, b, c = "abcdefgh", "abcdefg", "abcdefx"
    rows = [(i, f"{a} ") for i in range(600)] + [(i, f"{b} ") for i in range(45)]
    rows += [(i, f"{c} ") for i in range(3)]
    got = check_variants(spark, rows)
    assert got[c][:2] == (b, a) and got[b][:2] == (a, a) and got[a][:2] == (None, a)


def test_variants_over_the_tables(spark, real):
    found = queries.op13_spelling_variants(spark, SF).collect()
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in found}
    assert got == brute.variants(real[1])


def test_variants_of_empty_tables(spark):
    found = variants.group_variants(rows_of(spark, ODD).limit(0))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert found.count() == 0


def test_long_runs_are_cut_between_runs(monkeypatch):
    monkeypatch.setattr(variants, "PIECE", 7)
    text = "Ab" + "é" * 40 + "×÷ 日本 x-ÀB1" + "q" * 14 + " "
    found = [run for piece in variants.runs(text) for run in piece]
    assert [r.decode("latin-1") for r in found] == ["ab" + "é" * 40 + "×÷", "x", "Àb", "q" * 14]
