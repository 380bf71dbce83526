"""Plain Python versions of the operators, for small inputs."""

import hashlib
import re

SF = "/root/testdata/sf0.001"
LAST = 2**63


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def space_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def rank(doc_id):
    return LAST if doc_id is None else doc_id


def substrings(rows, window=13):
    """rows of (doc_id, text) -> (doc_id, n_words, n_removed, kept text, spans)"""
    first = {}
    for doc_id, text in rows:
        w = space_words(text)
        for i in range(len(w) - window + 1):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, LAST + 1), rank(doc_id))
    out = []
    for doc_id, text in rows:
        w = space_words(text)
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < rank(doc_id):
                gone[i:i + window] = [True] * window
        spans = [m.span() for m in re.finditer("x+", "".join("x" if g else "." for g in gone))]
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((doc_id, len(w), sum(gone), kept, spans))
    return out


def byte_spans(rows, least=100):
    """rows of (doc_id, text) -> (doc_id, n_bytes, kept bytes, spans)"""
    place = {n: at for at, n in enumerate(sorted(range(len(rows)), key=lambda n: (rank(rows[n][0]), rows[n][1] or "")))}
    data = [(place[n], n, (t or "").encode()) for n, (i, t) in enumerate(rows)]
    first = {}
    for r, _, b in data:
        for p in range(len(b) - least + 1):
            key = b[p:p + least]
            first[key] = min(first.get(key, (LAST + 1, 0)), (r, p))
    out = []
    for (doc_id, _), (r, _, b) in zip(rows, data):
        gone = bytearray(len(b))
        for p in range(len(b) - least + 1):
            if first[b[p:p + least]] < (r, p):
                gone[p:p + least] = b"\1" * least
        spans = [m.span() for m in re.finditer(b"\1+", bytes(gone))]
        out.append((doc_id, len(b), bytes(x for x, g in zip(b, gone) if not g), spans))
    return out


def shingles(text, k=5):
    w = space_words(text)
    out = {}
    for i in range(max(1, len(w) - k + 1) if w else 0):
        key = tuple(w[i:i + k])
        out[key] = out.get(key, 0) + 1
    return out


def probability_jaccard(x, y):
    union = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in union) for d in set(x) & set(y))


def groups(rows, threshold=0.8):
    """rows of (doc_id, text) -> sorted (doc_id, class_id, copies)"""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingles(t) for t in texts]
    head = list(range(len(texts)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and len(a.keys() & b.keys()) and root(i) != root(j) and probability_jaccard(a, b) >= threshold:
                head[root(i)] = root(j)
    number = {t: root(i) for i, t in enumerate(texts)}
    least, copies = {}, {}
    for doc_id, text in rows:
        g = number[text or ""]
        least[g] = min(least.get(g, LAST), rank(doc_id))
        copies[text or ""] = copies.get(text or "", 0) + 1
    return [(i, None if least[number[t or ""]] == LAST else least[number[t or ""]], copies[t or ""]) for i, t in rows]


def counts(row):
    doc_id, text = row[0], row[1] or ""
    w = space_words(text)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = {g for g in grams if grams.count(g) > 1}
    covered = {i + j for i, g in enumerate(grams) if g in often for j in range(3)}
    lines = [x for x in text.split("\n") if space_words(x)]
    return (doc_id, len(w), len("".join(w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            len(w) < 50 or 100 * len(covered) > 50 * len(w))


def bench_words(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def contamination(row, items, window=13):
    doc_id, text = row
    w, hit, found = bench_words(text), set(), set()
    for item_id, item in items:
        own = bench_words(item)
        n = min(window, len(own))
        if not n:
            continue
        spans = {tuple(own[i:i + n]) for i in range(len(own) - n + 1)}
        for i in range(len(w) - n + 1):
            if tuple(w[i:i + n]) in spans:
                hit |= set(range(i, i + n))
                found |= {str(item_id)} if item_id is not None else set()
    spans = [m.span() for m in re.finditer("x+", "".join("x" if i in hit else "." for i in range(len(w))))]
    return doc_id, len(w), len(hit), tuple(sorted(found)), len(hit) > 0 and 20 * len(hit) >= len(w), tuple(spans)
