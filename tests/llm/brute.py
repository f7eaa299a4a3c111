"""Plain versions of the operators, for small inputs, and a way to make such inputs."""

import hashlib
import re
from collections import defaultdict

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def word_windows(docs, size=20):
    """op4: (doc_id, n_words, n_removed, kept_sha256)."""
    first, texts = {}, []
    for d, t in sorted(docs, key=lambda x: (x[0] is None, x[0] or 0)):
        w = (t or "").encode().split()
        texts.append((d, w))
        for s in range(len(w) - size + 1):
            first.setdefault(tuple(w[s:s + size]), (d, s))
    out = []
    for d, w in texts:
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] != (d, s):
                gone[s:s + size] = [True] * size
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def byte_strings(docs, size=400):
    """op10: (doc_id, n_bytes, n_removed, n_spans, kept_sha256)."""
    count = defaultdict(int)
    texts = [(d, (t or "").encode()) for d, t in docs]
    for _, b in texts:
        for s in range(len(b) - size + 1):
            count[b[s:s + size]] += 1
    out = []
    for d, b in texts:
        gone = [False] * len(b)
        for s in range(len(b) - size + 1):
            if count[b[s:s + size]] > 1:
                gone[s:s + size] = [True] * size
        spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def grams(text, n):
    w = (text or "").encode().translate(LOWER).split()
    if len(w) < n:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def jaccard_components(docs, n, num, den):
    """op5: (doc_id, n_shingles, component_id)."""
    sets = [grams(t, n) for _, t in docs]
    up = list(range(len(docs)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and den * len(a & sets[j]) >= num * len(a | sets[j]):
                up[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return sorted(((d, len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(docs)), key=repr)


def contamination(docs, items, window=13):
    """op9: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    words = lambda t: re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").encode().translate(LOWER))
    phrases = defaultdict(set)
    for i, t in items:
        w = words(t)
        for s in range(max(1, len(w) - window + 1)) if w else ():
            phrases[tuple(w[s:s + window])].add(i)
    out = []
    for d, t in docs:
        w, hit, found = words(t), set(), set()
        for size in {len(p) for p in phrases}:
            for s in range(len(w) - size + 1):
                if (k := tuple(w[s:s + size])) in phrases:
                    found |= {x for x in phrases[k] if x is not None}
                    hit |= set(range(s, s + size))
        ids = ",".join(sorted(map(str, found)))
        out.append((d, len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(),
                    bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=repr)


def text_rules(text):
    """op3's counts: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    count = defaultdict(int)
    for s in range(len(w) - 2):
        count[tuple(w[s:s + 3])] += 1
    hit = {s + k for s in range(len(w) - 2) if count[tuple(w[s:s + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in "".join(w))
    return len(w), sum(map(len, w)), symbols, dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, key long, units string"


def frame(spark, rows, parts=3):
    """Documents with columns whose names the operators use themselves."""
    data = [(d, t, "en", "s", len(t or ""), -1, -2, "x") for d, t in rows]
    df = spark.createDataFrame(data, DOCS)
    return df.repartition(parts) if rows else df
