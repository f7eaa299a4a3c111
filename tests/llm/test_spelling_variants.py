"""Spelling variants against brute force."""

import os
import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from brute import frame
from pyspark.sql import functions as F

from marketlens.llm import spelling_variants as S

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(docs, every=199, least=6, often=5):
    count = Counter()
    for d, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= least and n >= often}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def variants(words, ratio=5):
    """word -> form, root, n, n_near, form_n."""
    near = defaultdict(set)
    for a in words:
        for b in words:
            if one_edit(a, b):
                near[a].add(b)
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda x: (-words[x], x))
            if words[best] >= ratio * words[w]:
                form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {w: (form.get(w), root(w), words[w], len(near[w]), words.get(form.get(w))) for w in words}


def collected(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def table_of(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)


def test_scan_finds_all_pairs():
    rnd = random.Random(1)
    for _ in range(200):
        letters, size = rnd.choice(["ab", "abc", "abcdefgh", "aé😀"]), rnd.randint(0, 6)
        mids = sorted({"".join(rnd.choices(letters, k=size + rnd.randint(0, 1))) for _ in range(rnd.randint(1, 90))})
        got = S.near_pairs(mids)
        assert {(x, y) for x, y, _ in got} == {(x, y) for y in range(len(mids)) for x in range(y) if one_edit(mids[x], mids[y])}
        assert len(got) == len(set(got))
        assert all(len(os.path.commonprefix([mids[x], mids[y]])) == c for x, y, c in got)


def test_scan_skips(monkeypatch):
    """Ranges that no word can be near are not read on."""
    mids = sorted(a + "x" * 30 + b for a in "ab" for b in "cd") + ["z" * 12 + f"{i:03}" for i in range(400)]
    read, flat = [], S.np.flatnonzero
    monkeypatch.setattr(S.np, "flatnonzero", lambda x: read.append(len(x)) or flat(x))
    pairs = S.near_pairs(sorted(mids))
    assert len(pairs) == 4 + sum(one_edit(f"{i:03}", f"{j:03}") for i in range(400) for j in range(i))
    assert sum(read) < 400 * 400


@pytest.mark.parametrize("limit", [2, 5, 2000])  # groups divided down to one place, some, none
def test_matches_brute_force(spark, limit):
    rnd = random.Random(2)
    words = {}
    for _ in range(150):
        w = "".join(rnd.choices("abcé", k=rnd.randint(6, 9)))
        words[w] = rnd.choice([5, 25, 125, 700, 10**6])
        for _ in range(3):
            i = rnd.randrange(len(w))
            x = rnd.choice([w[:i] + w[i + 1:], w[:i] + rnd.choice("abç") + w[i:], w[:i] + rnd.choice("xyz") + w[i + 1:]])
            if len(x) >= 6:
                words[x] = rnd.choice([5, 6, 30, 130])
    words |= {f"common{a}{b}": 5 + 40 * (a == "q") for a in "abcdefq" for b in ["", "x", "y", "xy"]}
    assert collected(S.spelling_variants(table_of(spark, words), limit=limit)) == variants(words)


def test_long_chains_have_one_root(spark):
    words = {"a" * (6 + i): 5 * 6**i for i in range(14)}
    out = collected(S.spelling_variants(table_of(spark, words)))
    assert out == variants(words) and {r[1] for r in out.values()} == {"a" * 19}


def test_ties_and_no_words(spark):
    words = {"variant": 5, "variants": 50, "variana": 50, "otheréé": 5}
    out = collected(S.spelling_variants(table_of(spark, words)))
    assert out["variant"] == ("variana", "variana", 5, 2, 50) and out["otheréé"] == (None, "otheréé", 5, 0, None)
    assert S.spelling_variants(table_of(spark, {})).collect() == []


def test_vocabulary(spark, odd_docs):
    rnd = random.Random(6)
    stems = ["Colour", "Étude", "naïveté", "W×÷rter", "straßen", "ABCDEFG"]
    docs = odd_docs + [(i, " ".join(rnd.choice(stems) + rnd.choice(["", "s", "1", "-x"]) for _ in range(40))) for i in range(50)]
    docs += [(900, "e" * 50 + "lengthy" * 3), (None, "nobody " * 9), (901, "中" * 30 + "inside" * 1 + "中")]
    assert {r.word: r.n for r in S.vocabulary(frame(spark, docs)).collect()} == words_of(docs)
    assert S.vocabulary(frame(spark, [])).collect() == []
    often = S.vocabulary(frame(spark, docs), every=3, min_length=1, min_count=1)
    assert {r.word: r.n for r in often.where(F.length("word") > 0).collect()} == {
        w: n for w, n in words_of(docs, 3, 1, 1).items()}


def test_long_texts_and_many_words(odd_docs, monkeypatch):
    """In the parts of a text, and with counts passed on in between."""
    monkeypatch.setattr(S, "PART", 7)
    monkeypatch.setattr(S, "HELD", 5)
    docs = odd_docs + [(1000 + i, f"Anything {i} goesé " * i) for i in range(9)]
    batch = pa.RecordBatch.from_arrays([pa.array([None if d is None else str(d) for d, _ in docs]),
                                        pa.array([t for _, t in docs], pa.string())], ["_id", "_t"])
    count, batches = Counter(), 0
    for out in S._words(iter([batch]), 199, 1):
        batches += 1
        for w, n in zip(*(out.column(i).to_pylist() for i in (0, 1))):
            count[w] += n
    assert count == words_of(docs, least=1, often=1) and batches > 2


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_table(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert collected(S.op12_spelling_variants(spark, SF)) == variants(words_of(docs))
