"""Plain Python versions of the operators, to compare with."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def exact(docs):
    """docs: (id, text) -> {id: (keep, size, kept, sha)}"""
    groups = defaultdict(list)
    for i, text in docs:
        groups[normalised(text)].append(i)
    return {
        i: (min(ids), len(ids), i == min(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for i in ids
    }


def simhash(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near(fps, radius=3):
    """{id: fingerprint} -> {id: component}"""
    ids = sorted(fps)
    links = [
        (a, b)
        for n, a in enumerate(ids)
        for b in ids[n + 1 :]
        if (fps[a] ^ fps[b]).bit_count() <= radius
    ]
    return components(ids, links)


def token_ids(texts, path):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    coded = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    return [c.ids for c in coded], [library.decode(c.ids, skip_special_tokens=False) for c in coded]


def pieces(ids, capacity, end=1):
    """(piece, start, length, crc32) of one document."""
    full = [*ids, end]
    return [
        (
            k // capacity,
            k,
            len(full[k : k + capacity]),
            zlib.crc32(b"".join(i.to_bytes(4, "little") for i in full[k : k + capacity])),
        )
        for k in range(0, len(full), capacity)
    ]


def check_packing(rows, capacity):
    """rows: (length, sequence, offset); each sequence is gapless from 0. Returns their number."""
    by = defaultdict(list)
    for length, sequence, offset in rows:
        by[sequence].append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def best_fit_decreasing(lengths, capacity):
    import bisect

    gaps, opened = [], 0
    for size in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, size)
        if i == len(gaps):
            opened += 1
            bisect.insort(gaps, capacity - size)
        else:
            bisect.insort(gaps, gaps.pop(i) - size)
    return opened


def terms(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def ranked(docs, items, k=20):
    """docs, items: (id, text) -> sorted (item, rank, doc, score) rows; null ids come first."""
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held]
    n_docs, total = sum(n > 0 for *_, n in held), sum(n for *_, n in held)
    df = Counter(term for _, c, _ in held for term in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in held:
            score = 0
            for term in terms(text):
                if c[term]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    m = 100 - 25 + 25 * n * n_docs // total
                    score += w * (10**9 * c[term] // (1000 * c[term] + 12 * m))
            if score:
                scores.append((-score, (i is not None, i or 0), i))
        scores.sort()
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(scores[:k], start=1)]
    return sorted(out, key=str)


def repeats(docs, length=50):
    """docs: (id, bytes) -> the removed spans of each row, in the order given."""
    least = {}
    for i, data in docs:
        if i is not None:
            for at in range(len(data) - length + 1):
                window = data[at : at + length]
                least[window] = min(i, least.get(window, i))
    out = []
    for i, data in docs:
        spans = []
        for at in range(len(data) - length + 1 if i is not None else 0):
            if least[data[at : at + length]] < i:
                if spans and spans[-1][1] >= at:
                    spans[-1][1] = at + length
                else:
                    spans.append([at, at + length])
        out.append([tuple(s) for s in spans])
    return out


def variants(docs):
    """docs: (id, text) -> {word: (form, root, n, n_near, form_n)}"""
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    words = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    forms = {}
    for word, others in near.items():
        if others:
            best = min(others, key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[word]:
                forms[word] = best
    out = {}
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out[word] = (form, root, n, len(near[word]), words[form] if form else None)
    return out


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))
