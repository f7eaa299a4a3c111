import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from brute import frame

from marketlens.llm import common, components, ngram_join


def made():
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    rows = []
    for _ in range(25):
        base = [rnd.choice(vocab) for _ in range(rnd.choice([1, 2, 3, 8, 15, 40, 120]))]
        for _ in range(rnd.randint(1, 8)):
            w = list(base)
            for _ in range(rnd.randint(0, max(1, len(w) // 20))):
                w[rnd.randrange(len(w))] = rnd.choice(vocab)
            rows.append((len(rows) * 3 + 7, " ".join(w)))
    hot = [rnd.choice(vocab) for _ in range(120)]  # near copies for several blocks
    for i in range(300):
        w = list(hot)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(120)] = rnd.choice(vocab)
        rows.append((20_000 + i, " ".join(w)))
    return rows


@pytest.mark.parametrize("n,num,den", [(3, 9, 10), (5, 4, 5)])
def test_no_link_is_lost(spark, n, num, den):
    rows = made()
    out = ngram_join.ngram_components(frame(spark, rows), n, num, den)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute.jaccard_components(rows, n, num, den)


def test_odd_documents(spark, odd_docs):
    out = ngram_join.ngram_components(frame(spark, odd_docs), 3, 9, 10)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute.jaccard_components(odd_docs, 3, 9, 10)


def test_empty_table(spark):
    assert ngram_join.ngram_components(frame(spark, [])).collect() == []


def test_one_of_each(spark):
    t = "one two three four five six seven"
    rows = [(5, t), (3, t), (3, t), (9, "other words here and there again"), (1, ""), (2, None), (2, None)]
    got = sorted((r.doc_id, r.text) for r in ngram_join.one_of_each(frame(spark, rows)).collect() if r.text)
    assert got == [(3, t), (9, rows[3][1])]
    assert ngram_join.one_of_each(frame(spark, rows)).count() == 5


def test_components_of_long_and_branching_graphs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


def test_the_survey_is_bounded_by_grams(monkeypatch):
    """Long texts are counted in smaller lots; a gram that many texts have is found all the same."""
    texts = [" ".join(["a b c d"] + [f"w{i}x{j}" for j in range(400)]) for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(40), pa.int64()), pa.array(range(40), pa.int32()), pa.array(texts)],
                                       ["doc", "disc", "text"])

    def frequent():
        out = [r for b in ngram_join._survey(iter([batch]), 3, 0.5) for r in b.to_pylist()]
        assert [r["n"] for r in out if r["kind"] == 0] == [402] * 40
        return {r["c1"] for r in out if r["kind"] == 1}, sum(r["n"] for r in out if r["kind"] == 1)

    monkeypatch.setattr(ngram_join, "SAMPLE_GRAMS", 1000)
    monkeypatch.setattr(common.text_batches, "__defaults__", ("text", 8000))
    few = frequent()
    monkeypatch.undo()
    assert few == frequent() == (few[0], 80) and len(few[0]) == 2


def near_misses():
    """Families of near copies, half of them just too unlike to link, long texts among them; and a chain of chance."""
    rnd = random.Random(11)
    rows = []

    def family(words, copies, most):
        base = [f"b{rnd.randrange(10**6)}" for _ in range(words)]
        for _ in range(copies):
            w = list(base)
            for _ in range(rnd.randint(0, most)):
                w[rnd.randrange(words)] = f"x{rnd.randrange(10**9)}"
            rows.append((len(rows), " ".join(w)))

    family(100, 150, 12)
    family(400, 60, 45)
    passages = [[f"p{i}x{j}" for j in range(30)] for i in range(40)]
    for i in range(80):  # neighbours share a passage
        own = [f"o{i}x{j}" for j in range(40)]
        rows.append((len(rows), " ".join(passages[i // 2] + own + passages[(i + 1) // 2 % 40])))
    return rows


@pytest.mark.parametrize("n,num,den,vast", [(3, 9, 10, 1), (5, 4, 5, 16)])
def test_large_groups_copy_few_grams(spark, monkeypatch, n, num, den, vast):
    """Sets meet in blocks, not once in each of their bins, and no link is lost when groups are divided."""
    rows = near_misses()
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    monkeypatch.setattr(ngram_join, "BLOCK_GRAMS", 5000, raising=False)
    monkeypatch.setattr(ngram_join, "BLOCK_SETS", 40, raising=False)
    monkeypatch.setattr(ngram_join, "VAST", vast, raising=False)
    met, by_group = [], ngram_join._by_group

    def counted(df, *args):
        met.append(df.count())
        return by_group(df, *args)

    monkeypatch.setattr(ngram_join, "_by_group", counted)
    out = ngram_join.ngram_components(frame(spark, rows), n, num, den)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out.collect()), key=repr)
    assert got == brute.jaccard_components(rows, n, num, den)
    assert sum(met) < 20 * len(rows)


def test_bins_dealt_again_keep_every_link():
    """Sets that link share a bin whatever the salt, and only sets of one group share any."""
    rnd = np.random.default_rng(3)
    base = rnd.integers(1, 2**63, 300, dtype=np.uint64)
    near = np.concatenate([base[30:], rnd.integers(1, 2**63, 30, dtype=np.uint64)])
    for salt in range(1, 4):
        sets = [np.sort(base), np.sort(near), np.sort(base)]
        batch = pa.RecordBatch.from_arrays(
            [pa.array([7, 7, 8], pa.int64()), pa.array([1, 2, 3], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())],
            ["comp", "c1", "grams"])
        out = pa.Table.from_batches(ngram_join._dealt_again(iter([batch]), 4, 5, 0.4, np.zeros(0, np.uint64), salt)).to_pylist()
        keys = [{r["key"] for r in out if r["c"] == c} for c in (1, 2, 3)]
        assert keys[0] & keys[1] and not keys[0] & keys[2]
