"""Language ID, toxicity, licences, vectors, fixity and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_text import CLASH, LONG, ODD, docs_of

from clickloom.llm import embedding_dedup, langid, license_scan, queries, toxicity, warc
from clickloom.llm.common import remainder, table

SF = "/root/testdata/sf0.01"


def test_folds(spark):
    got = spark.range(50).select("id", remainder("id", 3).alias("r")).collect()
    assert all(r.r == zlib.crc32(str(r.id).encode()) % 3 for r in got)


# ------------------------------------------------------------- language ID


def plain_kneser_ney(words, order=langid.ORDER):
    """Interpolated Kneser-Ney of one language, by its definition; words: Counter."""
    counts = [Counter() for _ in range(order)]
    for word, n in words.items():
        text = langid.START * (order - 1) + word + langid.END
        for i in range(order - 1, len(text)):
            counts[order - 1][text[i - order + 1 : i + 1]] += n
    for k in range(order - 2, -1, -1):
        for gram in counts[k + 1]:
            counts[k][gram[1:]] += 1
    off, total, kinds = [], [], []
    for level in counts:
        ones = sum(v == 1 for v in level.values())
        twos = sum(v == 2 for v in level.values())
        off.append(min(0.95, max(0.05, ones / (ones + 2 * twos))) if ones else 0.5)
        total.append(Counter())
        kinds.append(Counter())
        for gram, v in level.items():
            total[-1][gram[:-1]] += v
            kinds[-1][gram[:-1]] += 1

    def p(gram, letters):
        if not gram:
            return 1 / letters
        k, context = len(gram) - 1, gram[:-1]
        shorter = p(gram[1:], letters)
        if not total[k][context]:
            return shorter
        own = max(counts[k][gram] - off[k], 0) if gram in counts[k] else 0
        return (own + off[k] * kinds[k][context] * shorter) / total[k][context]

    return p, counts


def test_probabilities_match_the_definition(spark):
    texts = {"aa": ["ab ba abba baab", "abab bb"], "bb": ["cab cabs bac"]}
    rows = [(lang, t) for lang, ts in texts.items() for t in ts]
    counts = langid._gram_counts(spark.createDataFrame(rows, "lang string, text string")).toArrow()
    lang = np.array([["aa", "bb"].index(x) for x in counts["lang"].to_pylist()])
    arrays = langid._build(
        ["aa", "bb"], lang, counts["gram"].to_numpy().view("u8"), counts["n"].to_numpy()
    )
    model = langid.LanguageModel(["aa", "bb"], *arrays, np.zeros(2), np.zeros(2))
    plain = {k: plain_kneser_ney(Counter(w for t in ts for w in t.split())) for k, ts in texts.items()}
    letters = len({g for _, c in plain.values() for g in c[0]}) + 1
    for word in ("abba", "cab", "xyz", "bz", "c", "scab"):
        keys, _ = langid.grams([word])
        got = model.log_probabilities(keys)
        text = langid.START * 3 + word + langid.END
        for i in range(3, len(text)):
            for k, name in enumerate(("aa", "bb")):
                want = math.log(plain[name][0](text[i - 3 : i + 1], letters))
                assert got[i - 3, k] == pytest.approx(want, rel=1e-9), (word, i, name)


def test_language_accuracy_and_rejection(spark):
    docs = table(spark, SF, "documents")
    got = queries.op10_language_id(spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert sum(r.rejected for r in got) <= 0.005 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_odd_texts(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs)
    texts = [*ODD, "123 4.5 !!", "½ ² Ⅷ", "zqxj kqzv wxqz jjqx vvzk qqxz " * 20]
    got = {r.doc_id: r for r in langid.identify(docs_of(spark, texts), model).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        no_letter = not any(c.isalpha() for c in text or "")
        assert (got[i].lang_pred == "und") == no_letter
        assert not no_letter or (got[i].score == 0 and got[i].rejected)
    assert got[len(texts) - 1].rejected
    kept = langid.keep_recognised(docs_of(spark, texts), model)
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.rejected}
    assert langid.identify(docs_of(spark, []), model).count() == 0


def test_language_model_of_nothing(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, None, "en"), (None, "b", "en")],
                                 "doc_id long, text string, lang string")
    model = langid.fit(rows)
    assert model.languages == []
    assert {r.lang_pred for r in langid.identify(rows, model).collect()} == {"und"}
    assert langid.keep_recognised(rows, model).count() == 0


def test_languages_and_grams_beyond_the_bounds_still_give_a_model(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(300 * 12):
        letters = [chr(0x4E00 + 40 * (i % 300) + k) for k in range(40)]
        rows.append((i, " ".join("".join(rng.choices(letters[:6], k=5)) for _ in range(8)), f"l{i % 300}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    monkeypatch.setattr(langid, "MAX_GRAMS", 20_000)
    monkeypatch.setattr(langid, "MAX_CELLS", 2_000_000)
    model = langid.fit(docs)
    assert len(model.languages) == 300
    assert len(model.keys[-1]) * 300 <= 2_000_000
    got = {r.doc_id: r.lang_pred for r in langid.identify(docs, model).collect()}
    assert sum(got[i] == lang for i, _, lang in rows) >= 0.99 * len(rows)
    counts = [("a", g, 9 - g) for g in range(9)] + [("b", 100 + g, 1) for g in range(2)]
    counts = spark.createDataFrame(counts, "lang string, gram long, n long")
    monkeypatch.setattr(langid, "MAX_GRAMS", 6)
    kept = [(r.lang, r.gram) for r in langid._frequent(counts).collect()]
    assert sorted(kept) == [("a", 0), ("a", 1), ("a", 2), ("a", 3), ("b", 100), ("b", 101)]
    monkeypatch.setattr(langid, "MAX_CELLS", 11)
    kept = [(r.lang, r.gram) for r in langid._frequent(counts).collect()]
    assert sorted(kept) == [("a", 0), ("a", 1), ("a", 2), ("b", 100), ("b", 101)]


def test_garbled_labelled_rows_do_not_switch_off_rejection(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    garbled = lambda rng, n: " ".join(
        "".join(rng.choices("qxzjvkwy", k=rng.randrange(3, 9))) for _ in range(n)
    )
    first = docs.where("lang = 'en'").select("doc_id").orderBy("doc_id")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(langid.CALIBRATION))
    ids = [r.doc_id for r in first.where(fold == 0).limit(1).collect()]
    noise = spark.createDataFrame(
        [(i, garbled(random.Random(i), 2_000), "en") for i in ids], docs.schema
    )
    model = langid.fit(docs.where(~F.col("doc_id").isin(ids)).union(noise))
    texts = [garbled(random.Random(100 + i), n) for i, n in enumerate([60, 200, 1_000])]
    got = langid.identify(docs_of(spark, texts), model).collect()
    assert all(r.rejected for r in got)
    clean = langid.identify(docs, model).collect()
    assert sum(r.rejected for r in clean) <= 0.005 * len(clean)


# ---------------------------------------------------------------- toxicity


def test_toxicity_on_held_out_rows(spark):
    labels = table(spark, SF, "labels").select("doc_id", "toxic")
    got = queries.op3_toxicity(spark, SF)
    assert got.count() == table(spark, SF, "documents").count()
    rows = [r for r in got.join(labels, "doc_id").collect() if r.held_out]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    hit = sum(r.predicted and r.toxic for r in rows)
    assert hit >= 0.7 * sum(r.toxic for r in rows)  # some labels have no sign in the text
    assert hit >= 0.9 * sum(r.predicted for r in rows)


def test_pairs_are_learned_beyond_single_terms(spark):
    """Either word alone is clean, both together are toxic, and so without a linear rule."""
    rng = random.Random(1)
    rows = []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        filler = [rng.choice(["one", "two", "three", "four"]) for _ in range(6)]
        words = [*filler, "grmbl" if a else "two", "folk" if b else "one"]
        rows.append((i, " ".join(words), int(a and b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit(docs)
    more = "one two three four one "
    texts = [more + "one grmbl two", more + "one folk two", more + "grmbl two folk", more * 2]
    probe = docs_of(spark, [*texts, None, LONG])
    got = {r.doc_id: r.score for r in toxicity.score(probe, model).collect()}
    assert got[2] > 0.7 and max(got[0], got[1], got[3], got[4], got[5]) < 0.5


def test_terms_that_matter_only_together_are_learned(spark, monkeypatch):
    """The label is the exclusive or of two words; no term tells anything by itself."""
    rng = random.Random(2)
    rows = []
    for i in range(3000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        filler = [rng.choice(["one", "two", "three", "four", "five"]) for _ in range(8)]
        words = [*filler, "grmbl" if a else "smile", "folk" if b else "tree"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a != b)))
    learn = spark.createDataFrame(rows[:2000], "doc_id long, text string, toxic int")
    probe = docs_of(spark, [t for _, t, _ in rows[2000:]])
    right = {}
    for factors in (4, 0):  # without factors the model is additive
        monkeypatch.setattr(toxicity, "FACTORS", factors)
        model = toxicity.fit(learn)
        got = {r.doc_id: r.score >= 0.5 for r in toxicity.score(probe, model).collect()}
        right[factors] = sum(got[i] == bool(y) for i, (_, _, y) in enumerate(rows[2000:])) / 1000
    assert right[4] >= 0.95 and right[0] <= 0.65


def test_scores_are_those_of_all_pairs(spark):
    """Every pair of a text's buckets counts once, with the product of its vectors."""
    rng = np.random.default_rng(3)
    texts = ["grmbl folk grmbl", "folk", "", "tree smile folk grmbl grmbl", None]
    known = sorted(set().union(*[toxicity._Words().of(t or "") for t in texts]))
    wanted = {b: i for i, b in enumerate(known)}
    weights, factors = rng.standard_normal(len(known)), rng.standard_normal((len(known), 3))
    model = toxicity.FactorizationMachine(wanted, 0.3, weights, factors)
    got = {r.doc_id: r.score for r in toxicity.score(docs_of(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        at = sorted(wanted[b] for b in toxicity._Words().of(text or ""))
        margin = 0.3 + sum(weights[j] for j in at)
        margin += sum(factors[j] @ factors[k] for n, j in enumerate(at) for k in at[n + 1 :])
        assert got[i] == pytest.approx(1 / (1 + np.exp(-np.clip(margin, -30, 30))))


def test_toxicity_without_both_classes(spark):
    rows = spark.createDataFrame([(1, "a", 0), (2, None, 0), (3, "b", None)],
                                 "doc_id long, text string, toxic int")
    model = toxicity.fit(rows)
    assert {r.score for r in toxicity.score(docs_of(spark, ODD), model).collect()} == {0.5}
    assert toxicity.score(docs_of(spark, []), model).count() == 0


# ---------------------------------------------------------------- licences


def plain_dice(a, b):
    a, b = license_scan.bigrams(a), license_scan.bigrams(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0


def test_size_bounds_lose_no_template(spark):
    rng = random.Random(5)
    own = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    pool = [t for ts in license_scan.TEMPLATES.values() for t in ts]
    for _ in range(400):
        words = rng.choice(pool).split()
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = rng.choice(["the", "foo", "licence", "work"])
        text = " ".join(words[: rng.randrange(3, len(words) + 1)])
        best = max(
            ((plain_dice(text, t), name) for name, ts in license_scan.TEMPLATES.items() for t in ts),
            key=lambda r: r[0],
        )
        got = own.best(license_scan.bigrams(text))
        if best[0] >= 0.8:
            assert got[0] == pytest.approx(best[0])
        else:
            assert got is None


def test_licences_of_documents(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    notices = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "Released under the MIT License.": "MIT",
    }
    want = Counter(
        (i, name) for i, text in docs.items() for notice, name in notices.items()
        for _ in range(text.count(notice))
    )
    rows = queries.op1_license_scan(spark, SF).collect()
    assert Counter((r.doc_id, r.licence) for r in rows) == want
    assert all(plain_dice(docs[r.doc_id][r.start : r.end],
                          license_scan.TEMPLATES[r.licence][r.template]) == r.dice for r in rows)


def test_whole_licence_in_lines_is_one_passage(spark):
    full = license_scan.TEMPLATES["MIT"][-1].replace(". ", ".\n")
    texts = [*ODD, f"Intro here.\n{full}\nAn end.", full.upper(), "Licensed under CC BY 4.0. x " * 3]
    rows = license_scan.scan(docs_of(spark, texts)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    n = len(ODD)
    assert set(by) == {n, n + 1, n + 2}
    assert [r.licence for r in by[n]] == ["MIT"] and texts[n][by[n][0].start :].startswith("Permis")
    assert len(by[n + 2]) == 3
    assert license_scan.scan(docs_of(spark, [])).count() == 0


def test_adjacent_licences_are_passages_of_their_own():
    own = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    notices = {"Apache-2.0": 2, "GPL-3.0": 2, "MIT": 3}
    full = {n: license_scan.TEMPLATES[n][k] for n, k in notices.items()}
    for names in [("Apache-2.0", "GPL-3.0"), ("GPL-3.0", "Apache-2.0", "MIT"), ("MIT", "MIT")]:
        for gap in (" ", "\n", "\n\nAnd these files:\n"):
            text = gap.join(full[n] for n in names)
            got = own.scan(text)
            assert [(r[2], text[r[0] : r[1]]) for r in got] == [(n, full[n]) for n in names]
    short = "Licensed under the MIT License."
    got = own.scan(f"{short} {full['GPL-3.0']}")
    assert [(r[2], r[4]) for r in got] == [("MIT", 1.0), ("GPL-3.0", 1.0)]
    worn = full["GPL-3.0"].replace("useful", "handy").replace("details", "of it").replace("along", "")
    got = own.scan(f"{short}\n{worn}\n{full['Apache-2.0']} Some words of no licence.")
    assert [r[2] for r in got] == ["MIT", "GPL-3.0", "Apache-2.0"]


def test_whole_texts_and_gnu_notices_have_their_own_names():
    own = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    for name, wordings in license_scan.TEMPLATES.items():
        for text in wordings:
            assert [(r[2], r[4]) for r in own.scan(text)] == [(name, 1.0)]
    gnu = license_scan.TEMPLATES["GPL-3.0"][2]
    for kind, name in (("Affero", "AGPL-3.0"), ("Lesser", "LGPL-3.0")):
        notice = gnu.replace("GNU General", f"GNU {kind} General")
        assert [r[2] for r in own.scan(f"Some file.\n\n{notice}\n\nimport this")] == [name]
    for name in license_scan.TEXTS:  # lines taken away, a header and a text behind
        lines = license_scan.TEMPLATES[name][-1].splitlines()
        text = "\n".join(["My project, 2020", *lines[: len(lines) // 3], *lines[len(lines) // 3 + 2 :], "Bye now."])
        assert [r[2] for r in own.scan(text)] == [name]


def test_passages_match_every_window(spark):
    rng = random.Random(11)
    own = license_scan.Templates(license_scan.TEMPLATES, 0.8)
    pool = [t for ts in license_scan.TEMPLATES.values() for t in ts if len(t) < 2_000]
    pool = [m[0].strip() for t in pool for m in license_scan.SENTENCE.finditer(t) if m[0].strip()]
    for _ in range(40):
        text = "\n".join(rng.choice([*pool, "Some words.", "x", "the end of it"]) for _ in range(8))
        spans = [m.span() for m in license_scan.SENTENCE.finditer(text) if m[0].strip()]
        sums = {len(spans): 0.0}
        for i in reversed(range(len(spans))):
            sums[i] = sums[i + 1]
            for j in range(i, len(spans)):
                a = license_scan.bigrams(text[spans[i][0] : spans[j][1]])
                words = len(license_scan.words_of(text[spans[i][0] : spans[j][1]]))
                for (size, _, _, b), reach in zip(own.rows, own.reach):
                    over = 2 * len(a & b) - 0.8 * (len(a) + size)
                    if size and a and words <= reach and over >= -1e-9:
                        sums[i] = max(sums[i], over + 1e-6 + sums[j + 1])
        got = 0.0
        for start, end, *_ in own.scan(text):
            a = license_scan.bigrams(text[start:end])
            got += 1e-6 + max(2 * len(a & r[3]) - 0.8 * (len(a) + r[0]) for r in own.rows)
        assert got == pytest.approx(sums[0], abs=1e-9)


# ------------------------------------------------------------------ vectors


def plain_vectors(rows, cosine=0.98):
    def ok(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links = []
    for n, (a, v, x) in enumerate(rows):
        for b, w, y in rows[n + 1 :]:
            if x is not None and x == y and ok(v) and ok(w) and len(v) == len(w):
                p, q = np.array(v, "f8"), np.array(w, "f8")
                if p @ q / math.sqrt(p @ p) / math.sqrt(q @ q) >= cosine:
                    links.append((a, b))
    number = Counter(n for link in links for n in link)
    return {
        a: (number[a], root, a == root)
        for a, root in brute.components([r[0] for r in rows], links).items()
    }


@pytest.mark.parametrize("cell", [4096, 5])
def test_vectors_match_brute_force(spark, monkeypatch, cell):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(25):
        centre, size = rng.normal(size=16), 16
        for _ in range(14):
            v = centre + rng.normal(size=size) * rng.choice([0.02, 0.12, 0.2])
            rows.append([float(x) for x in np.float32(v)])
    rows += [rows[0]] * 9 + [[2 * x for x in rows[0]]] + [rows[1][:8]] * 2
    rows = [(i, v, i % 2 if i < 350 else 0) for i, v in enumerate(rows)]
    bad = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15]
    rows += [(1000 + i, v, 0) for i, v in enumerate(bad)]
    rows += [(2000 + i, rows[0][1], None) for i in range(3)]
    frame = spark.createDataFrame(
        [(i, v, x, 1, 2) for i, v, x in rows],
        "vec_id long, embedding array<float>, label int, id int, a int",
    )
    monkeypatch.setattr(
        embedding_dedup, "candidate_pairs",
        lambda p, c, f=embedding_dedup.candidate_pairs: f(p, c, cell),
    )
    got = embedding_dedup.near_vectors(frame).collect()
    assert len(got) == len(rows)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == plain_vectors(rows)
    assert embedding_dedup.near_vectors(frame.limit(0)).count() == 0


# ------------------------------------------------------------------- fixity


def test_fixity_finds_exactly_the_damaged_pages(spark):
    pages = table(spark, SF, "pages")
    damaged = {
        r.page_id for r in pages.collect()
        if zlib.crc32(str(r.page_id).encode()) % queries.DAMAGED == 0
    }
    rows = queries.op9_warc_fixity(spark, SF).collect()
    assert {r.id for r in rows} == damaged and len(rows) == len(damaged)
    assert all(r.state == "changed" and r.first < r.last for r in rows)
    archive = {r.id: r.record for r in warc.to_archive(pages).collect()}
    at, places = defaultdict(int), {}
    for f, i, n in sorted((r.file, r.id, len(r.record)) for r in warc.to_archive(pages).collect()):
        places[i] = (at[f], at[f] + n)
        at[f] += n
    assert all((r.first, r.last) == places[r.id] for r in rows)
    head, _, body = bytes(archive[0]).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\n") and f"Content-Length: {len(body) - 4}".encode() in head


@pytest.mark.parametrize("fanout", [2, 16])
def test_fixity_of_odd_archives(spark, fanout):
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>", "x") for i in range(40)]
    rows += [(None, None, None, "x"), (7, "http://x/7", "again", "x"), (50, None, "é" * 4000, "x")]
    schema = "page_id long, url string, html string, file string"
    full = warc.to_archive(spark.createDataFrame(rows, schema))
    assert warc.audit(full, full, fanout).count() == 0
    none = full.limit(0)
    assert warc.audit(none, none, fanout).count() == 0
    assert Counter(r.state for r in warc.audit(full, none, fanout).collect()) == {"missing": 43}
    assert Counter(r.state for r in warc.audit(none, full, fanout).collect()) == {"extra": 43}
    short = full.where("id < 50 OR id IS NULL")
    assert [(r.id, r.state) for r in warc.audit(full, short, fanout).collect()] == [(50, "missing")]


def test_fixity_names_lost_and_added_records(spark):
    schema = "page_id long, url string, html string"
    rows = [(i, f"http://x/{i}", f"<p>{i}</p>") for i in range(2_000)]
    rows += [(9, "http://x/9", t) for t in ("a", "b", "b", "c")]
    rows += [(None, "http://x/n", t) for t in ("a", "b")]
    pages = spark.createDataFrame(rows, schema)
    files = warc.archive_count(pages)
    assert files == 2  # the replica has fewer than 2,000 pages, so its own number would be 1
    gone, new = {0, 3, 500, 501, 777, 1999, *range(1200, 1260)}, {-5, 5_000}
    changed = {4: "longer than it was", 1000: "?"}
    kept = [(i, u, changed.get(i, t)) for i, u, t in rows if i not in gone]
    kept.remove((9, "http://x/9", "b"))
    kept.remove((None, "http://x/n", "a"))
    kept += [(i, f"http://x/{i}", "new") for i in new]
    replica = warc.to_archive(spark.createDataFrame(kept, schema), files=files)
    got = warc.audit(warc.to_archive(pages, files=files), replica).collect()
    want = [(i, "missing") for i in [*gone, 9, None]]
    want += [(i, "extra") for i in new] + [(i, "changed") for i in changed]
    assert Counter((r.id, r.state) for r in got) == Counter(want)


def test_fixity_query_damages_every_chosen_page(spark, folder):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % queries.DAMAGED == 0][:3]
    rows = [(i, "http://x", t) for i, t in zip(ids, ["????", None, ""])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.write.parquet(f"{folder}/pages.parquet")
    got = queries.op9_warc_fixity(spark, folder).collect()
    assert sorted((r.id, r.state) for r in got) == sorted((i, "changed") for i in ids)


# ----------------------------------------------------------------- pipeline


def test_pipeline_matches_its_parts(spark):
    import corpus_pipeline
    from test_llm_text import plain_spans

    from clickloom.llm import secret_scan

    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    model = langid.fit(table(spark, sf, "documents"))
    known = {r.doc_id for r in langid.identify(table(spark, sf, "documents"), model).collect()
             if not r.rejected}
    assert len(known) >= 0.99 * len(docs)
    one = {i for i, v in brute.exact([(i, docs[i]) for i in known]).items() if v[2]}
    near = {i for i, c in brute.near({i: brute.simhash(docs[i]) for i in one}).items() if i == c}
    rows = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id for r in rows} == near
    assert brute.check_packing([(r.length, r.sequence_id, r.offset) for r in rows], 4096)
    frame = table(spark, sf, "documents").where(F.col("doc_id").isin(sorted(near)))
    clean = {r.doc_id: r.text for r in secret_scan.redact(frame).collect()}
    assert all(not plain_spans(t) for t in clean.values())
    assert all(clean[i] == docs[i] for i in near if "[SECRET]" not in clean[i])
    ids, _ = brute.token_ids([clean[i] for i in sorted(near)], queries.tokenizer_path())
    want = {(i, *p) for i, own in zip(sorted(near), ids) for p in brute.pieces(own, 4096)}
    assert {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want


def test_pipeline_stages_keep_columns_and_take_odd_rows(spark):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(i, t, "en" if i % 3 else None, "s", 0) for i, t in enumerate(ODD)] + [
        (None, "some ordinary words", "en", None, None), (3, "a", "fr", "s", 1), (3, "a", "fr", "s", 1)
    ]
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != "packing":
                assert out.columns == docs.columns
            out.collect()


def test_llm_names_and_clash_columns():
    assert len(CLASH) == len(set(CLASH))
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


@pytest.mark.parametrize("rows_at_most", [1_000_000, 0])
def test_copies_go_by_id_and_text(spark, monkeypatch, rows_at_most):
    """With one id on two texts, only the text that is a copy goes; no text is lost."""
    from clickloom.llm import common, exact_dedup, simhash

    monkeypatch.setattr(common, "BROADCAST_ROWS", rows_at_most)
    a, b, c = (" ".join(f"{k}{i}" for i in range(300)) for k in "abc")
    rows = [(5, a), (5, b), (3, a), (7, b), (9, c), (None, a)]
    docs = docs_of(spark, [t for _, t in rows], [i for i, _ in rows])
    want = sorted([(3, a), (5, b), (9, c), (None, a)], key=str)
    for drop in (exact_dedup.drop_exact_duplicates, simhash.drop_near_duplicates):
        left = drop(docs)
        assert left.columns == docs.columns
        assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == want


def test_long_words_are_encoded_along_the_trie():
    """A megabyte without a space takes seconds, and the ids are the library's."""
    import time

    from tokenizers import Tokenizer

    from clickloom.llm import bpe

    path = queries.tokenizer_path()
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    texts = [long, f"some {long[:500]} words {long[300:900]}", long[: bpe.LONG + 1]]
    library, own = Tokenizer.from_file(path), bpe.MergeEncoder(path)
    for text, ids in zip(texts, own.encode(texts)):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
    began = time.monotonic()
    own.encode([long * 50])
    assert time.monotonic() - began < 10


def test_what_a_task_remembers_is_bounded_by_bytes(monkeypatch):
    from clickloom.llm import bpe

    monkeypatch.setattr(bpe, "MEMORY", 20_000)
    own = bpe.MergeEncoder(queries.tokenizer_path())
    rng = random.Random(6)
    for _ in range(40):
        own.encode([" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(20))])
        assert own.known.bytes <= 20_000 + 20 * (bpe.ENTRY + 9 + 4 * 9)
    assert own.known.old
    own.known.forget()
    assert not own.known and not own.known.old and own.known.bytes == 0


def test_batches_between_tasks_and_workers_are_bounded(spark):
    import pyarrow as pa

    from clickloom.llm import bpe, common

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], names=["n"])

    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, 10_000)
        rows = common.in_arrow(spark.range(0, 9_000, 1, 1), sizes, "n long").collect()
        assert sum(r.n for r in rows) == 9_000
        assert max(r.n for r in rows) <= common.ARROW_ROWS
        spark.conf.set(name, 100)
        rows = common.in_arrow(spark.range(0, 900, 1, 1), sizes, "n long").collect()
        assert max(r.n for r in rows) <= 100  # a smaller setting stays
    finally:
        spark.conf.set(name, before)
    own = bpe.MergeEncoder(queries.tokenizer_path())
    assert not any(isinstance(x, dict) and "merges" in x for x in vars(own).values())


def test_few_prefixes_get_a_state(monkeypatch):
    """A word's prefixes get one when the tokens behind them ask, not each in turn."""
    from clickloom.llm import bpe

    asked, state = [0], bpe.WordTrie._state

    def counted(*args):
        asked[0] += 1
        return state(*args)

    monkeypatch.setattr(bpe.WordTrie, "_state", counted)
    own, rng = bpe.TrieEncoder(queries.tokenizer_path()), random.Random(9)
    parts = ["the", "ing", "er", "on", "tion", "and", "lich", "heit", "que"]
    words = {"".join(rng.choices(parts, k=4)) for _ in range(1000)}
    ids = own.encode([" ".join(words)])[0]
    assert asked[0] <= 1.5 * len(ids) / 4 < sum(map(len, words)) / 2


def test_a_batch_does_not_walk_through_all_that_is_remembered():
    import time

    from clickloom.llm import bpe

    memory = bpe.Memory()
    for generation in range(2):
        keys = [f"{generation}-{k}" for k in range(130_000)]
        memory.missing(set())
        memory.remember(keys, [b"1234"] * len(keys))
    assert memory.old and memory
    memory.bytes = 0  # no third generation here
    began = time.process_time()
    for k in range(300):
        assert memory.missing({f"1-{k}", f"0-{k}", f"new-{k}"}) == {f"new-{k}"}
    assert time.process_time() - began < 0.5
