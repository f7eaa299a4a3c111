"""Substring operators against brute force, whatever the size of a group."""

import hashlib
import random
from dataclasses import replace

import brute
import pytest
from brute import frame

import corpus_pipeline
from marketlens.llm import repeats, substring_dedup, suffix_array_dedup

CASES = {"words": (substring_dedup.PLAN, b" ", brute.word_windows),
         "bytes": (suffix_array_dedup.plan(), b"", brute.byte_strings)}


def run(df, plan, joiner):
    out = repeats.remove_repeats(df, plan, ("doc_id",), joiner).collect()
    spans = [(r.n_spans,) if joiner == b"" else () for r in out]
    return sorted(((r.doc_id, r.n_units, r.n_removed, *s, hashlib.sha256(bytes(r.kept)).hexdigest())
                   for r, s in zip(out, spans)), key=repr)


def made(kind):
    rnd = random.Random(11)
    if kind == "words":
        rows = [(i, " ".join(rnd.choice(["a", "b", "a a", "c"]) for _ in range(rnd.randint(0, 90)))) for i in range(60)]
        return rows + [(500 + i, "x y z " * rnd.randint(1, 30) + rows[i][1]) for i in range(30)]
    rows = [(i, "".join(rnd.choice("ab") for _ in range(rnd.randint(0, 900)))) for i in range(20)]
    base = rows[3][1] + rows[5][1] + rows[7][1]
    return rows + [(500 + i, base[rnd.randint(0, 300):rnd.randint(400, 2000)]) for i in range(25)]


@pytest.mark.parametrize("limit", [1, 3, 10**6])  # divided groups, and whole ones
@pytest.mark.parametrize("kind", CASES)
def test_matches_brute_force(spark, kind, limit):
    plan, joiner, expected = CASES[kind]
    rows = made(kind)
    assert run(frame(spark, rows), replace(plan, limit=limit), joiner) == expected(rows)


@pytest.mark.parametrize("limit", [1, 10**6])
@pytest.mark.parametrize("kind", CASES)
def test_small_buffers(spark, kind, limit):
    """Leaves are chosen again and again, and very frequent keys go out in pieces."""
    plan, joiner, expected = CASES[kind]
    rows = made(kind)
    assert run(frame(spark, rows), replace(plan, limit=limit, flush=40, group_rows=6), joiner) == expected(rows)


@pytest.mark.parametrize("kind", CASES)
def test_nothing_repeats_unless_the_order_says_so(spark, kind):
    """Copies of whole documents too are found by the sorted leaves, not by the hashes of their runs."""
    plan, joiner, expected = CASES[kind]
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{rnd.randrange(10**6)}" for _ in range(150))) for i in range(12)]
    rows += [(100 + i, rows[i % 12][1]) for i in range(60)] + [(200, rows[0][1]), (200, rows[0][1])]
    order = plan.order

    def blind(texts, off):
        right, common_right, left, common_left = order(texts, off)
        return right, 0 * common_right, left, 0 * common_left

    assert all(r[2] == 0 for r in run(frame(spark, rows), replace(plan, order=blind), joiner))
    assert run(frame(spark, rows), plan, joiner) == expected(rows)


@pytest.mark.parametrize("kind", CASES)
def test_followers_of_divided_leaves(spark, kind):
    """Many copies of runs whose keys are divided: followers find the windows of leaves at every level."""
    plan, joiner, expected = CASES[kind]
    rnd = random.Random(9)
    word = lambda: f"w{rnd.randrange(10**6)}"
    hot = " ".join(f"hot{k}" for k in range(12 if kind == "words" else 80))
    texts = [" ".join([*(word() for _ in range(25)), hot, *(word() for _ in range(25))]) for _ in range(8)]
    rows = [(i, texts[i % 8]) for i in range(40)] + [(100 + i, f"{word()} {hot} {texts[i][-120:]}") for i in range(8)]
    for limit in (1, 3):
        assert run(frame(spark, rows), replace(plan, limit=limit, flush=50), joiner) == expected(rows)


@pytest.mark.parametrize("kind", CASES)
def test_odd_documents(spark, kind, odd_docs):
    plan, joiner, expected = CASES[kind]
    assert run(frame(spark, odd_docs), plan, joiner) == expected(odd_docs)


@pytest.mark.parametrize("kind", CASES)
def test_empty_table(spark, kind):
    plan, joiner, _ = CASES[kind]
    assert run(frame(spark, []), plan, joiner) == []


def test_cut_texts_stay_texts(spark):
    shared = "ü" * 300
    rows = [(1, f"é{shared}x"), (2, f"è{shared}y"), (3, None), (4, shared)]
    out = {r.doc_id: r for r in suffix_array_dedup.without_repeats(frame(spark, rows)).collect()}
    assert out[1].text == "éx" and out[1].n_chars == 2 and out[3].text is None and out[4].text == ""
    assert out[2].units == "x" and list(out[2].asDict())[:2] == ["doc_id", "text"]


@pytest.mark.parametrize("window", [32, 100, 250])  # also no multiple of the refined grams
@pytest.mark.parametrize("limit", [2, 10**6])
def test_other_windows(spark, window, limit):
    rows = made("bytes")
    plan = replace(suffix_array_dedup.plan(window), limit=limit)
    assert run(frame(spark, rows), plan, b"") == brute.byte_strings(rows, window)
    with pytest.raises(ValueError):
        suffix_array_dedup.plan(31)


def test_passages_of_51_words(spark):
    """Passages of some 315 bytes repeat across documents: the pipeline's window finds them, that of op10 does not."""
    rnd = random.Random(8)
    words = lambda n: " ".join("".join(rnd.choices("abcdefghijklm", k=rnd.randint(3, 8))) for _ in range(n))
    passages = [words(51) for _ in range(6)]
    assert all(250 < len(p) < 400 for p in passages)
    rows = [(i, f"{words(40)} {passages[i % 6]} {words(60)}") for i in range(18)] + [(100 + i, words(120)) for i in range(6)]
    out = {r.doc_id: r.text for r in suffix_array_dedup.without_repeats(
        frame(spark, rows), window=corpus_pipeline.REPEAT_BYTES).collect()}
    assert all(passages[i % 6] not in out[i] and len(out[i]) < len(rows[i][1]) - 240 for i in range(18))
    assert all(out[i] == t for i, t in rows[18:])
    assert {r.text for r in suffix_array_dedup.without_repeats(frame(spark, rows)).collect()} == {t for _, t in rows}


def test_frequent_prefixes_reach_the_tree(spark, tmp_path):
    """A prefix with too many classes is divided by longer ones, and its pairs are compared as leaves."""
    rnd = random.Random(5)
    words = lambda n: [f"w{rnd.randrange(10**9)}" for _ in range(n)]
    rows = []
    for i in range(0, 40, 2):
        pair = [f"hot{k}" for k in range(8)] + words(20)
        rows += [(i + k, " ".join([*words(15), *pair, *words(15)])) for k in range(2)]
    mark, order = str(tmp_path / "hot"), substring_dedup.PLAN.order

    def seen(texts, off):
        if any(all(x.startswith(b"hot") for x in t.split()[o:o + 4]) for t, o in zip(texts, off)):
            open(mark, "w").close()
        return order(texts, off)

    plan = replace(substring_dedup.PLAN, limit=3, order=seen)
    assert run(frame(spark, rows), plan, b" ") == brute.word_windows(rows)
    assert (tmp_path / "hot").exists()
