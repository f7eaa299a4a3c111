"""Decontamination, quality rules, licences and language ids."""

import pickle
import random
import tracemalloc

import brute
import numpy as np
from brute import frame

from marketlens.llm import decontamination as D
from marketlens.llm import language_id as L
from marketlens.llm import license_scan as S
from marketlens.llm import quality_rules as Q


def test_fm_index_finds_all_occurrences():
    rnd = random.Random(0)
    for _ in range(20):
        x = np.array([rnd.choice([0, 1, 2, 3]) for _ in range(rnd.randint(1, 60))] + [0])
        f = D.FMIndex(x, sample=rnd.choice([1, 3, 8]))
        length = np.array([rnd.randint(1, 4) for _ in range(20)])
        symbols = np.zeros((20, 4), int)
        for i, n in enumerate(length):
            symbols[i, :n] = [rnd.randint(1, 4) for _ in range(n)]
        lo, hi = f.search(symbols.ravel(), np.arange(20) * 4, length)
        for i, n in enumerate(length):
            want = [j for j in range(len(x)) if list(x[j:j + n]) == list(symbols[i, :n])]
            assert sorted(f.locate(np.arange(lo[i], max(lo[i], hi[i])))) == want


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string")


def test_contamination(spark, odd_docs):
    passage = odd_docs[6][1].split()
    bench = [("10", " ".join(passage[20:50])), ("9", " ".join(passage[40:53])), ("9", "one"), (None, "lonely"), ("8", None),
             ("7", "..."), ("6", "A a, A"), ("5", " ".join(passage[20:50]))]
    for block in (64 << 20, 50):  # in one block, and in many
        out = D.decontaminate(frame(spark, odd_docs), items(spark, bench), block_bytes=block)
        out = out.withColumn("n_hit", D.n_hit()).collect()
        got = sorted(((r.doc_id, r.n_words, r.n_hit, len(r["items"])) for r in out), key=repr)
        assert got == sorted((x[:4] for x in brute.contamination(odd_docs, bench)), key=repr)
    clean = D.decontaminate(frame(spark, odd_docs), items(spark, []))
    assert clean.where("size(spans) > 0").count() == 0 and clean.count() == len(odd_docs)
    assert D.decontaminate(frame(spark, []), items(spark, bench)).collect() == []
    left = D.keep_clean(frame(spark, [(1, " ".join(passage)), (2, "plain text")]), items(spark, bench))
    assert [(r.doc_id, r.units) for r in left.collect()] == [(2, "x")]


def test_phrases_take_little_memory():
    """Some 30 bytes for a byte of benchmark, on the driver and in what is sent."""
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(10**6)}" for _ in range(400)).encode() for _ in range(300)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    tracemalloc.start()
    ph = D.Phrases([str(i) for i in range(300)], data, offsets)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(ph.length) == 300 * 388 and ph.items(0)
    assert peak < 60 * len(data) and len(pickle.dumps(ph)) < 8 * len(data)


def test_quality_statistics(spark, odd_docs):
    out = Q.quality_rules(frame(spark, odd_docs)).collect()
    cols = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted(((r.doc_id, *(r[c] for c in cols)) for r in out), key=repr)
    assert got == sorted(((d, *brute.text_rules(t)) for d, t in odd_docs), key=repr)
    assert not any(r.kept for r in out if r.base_failed)
    assert Q.quality_rules(frame(spark, [])).collect() == []


def test_fences_follow_the_group(spark):
    rnd = random.Random(3)
    text = lambda junk: " ".join("".join(rnd.choice("abcdef") for _ in range(rnd.randint(2, 8)))
                                 + ("***" if junk and rnd.random() < 0.5 else "") for _ in range(120))
    rows = [(i, text(i % 10 == 0), "en", "web") for i in range(300)]
    rows += [(1000 + i, text(True), None, "notes") for i in range(250)]  # symbols are usual here
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in Q.quality_rules(df).collect()}
    assert [i for i in range(300) if not kept[i]] == list(range(0, 300, 10))
    assert all(kept[1000 + i] for i in range(250))
    assert {r.doc_id for r in Q.keep_good(df).collect()} == {i for i, k in kept.items() if k}


def test_buckets_are_exact_and_ordered(spark):
    df = spark.range(0, 5000).select("id", Q.bucket(Q.F.col("id")).alias("b"))
    rows = df.withColumn("top", Q.bucket_top(Q.F.col("b"))).orderBy("id").collect()
    assert all(r.id <= r.top <= r.id * (1 + 1 / Q.SUB) + 1 for r in rows)
    assert [r.b for r in rows] == sorted(r.b for r in rows)


def test_licences(spark, odd_docs):
    m = S.train(["plain words of a story", "another line of plain prose"])
    rows = [(100 + i, f"some text before\nfoo {n} bar\nand after") for f in sorted(S.NOTICES) for i, n in enumerate(S.NOTICES[f])]
    want = [f for f in sorted(S.NOTICES) for _ in S.NOTICES[f]]
    got = [r.family for r in S.scan(frame(spark, rows, 1).coalesce(1).orderBy("n_chars"), m, ("text",)).collect()]
    found = {r.text: r.family for r in S.scan(frame(spark, rows), m, ("text",)).collect()}
    assert len(got) == len(rows)
    assert np.mean([found[t] == f for (_, t), f in zip(rows, want)]) >= 0.9
    other = S.scan(frame(spark, [*odd_docs, *enumerate(S.LOOKALIKES)]), m).collect()
    assert all(r.n_licensed == 0 and r.family is None for r in other) and len(other) == len(odd_docs) + len(S.LOOKALIKES)
    assert S.scan(frame(spark, []), m).collect() == []


def test_language_ids(spark, odd_docs):
    rnd = random.Random(8)
    stems = {"aa": ["ba", "ke", "lo", "mi"], "bb": ["schr", "ung", "keit", "pf"], "cc": ["ção", "lh", "nh", "ões"]}
    text = lambda k, n: " ".join("".join(rnd.choice(stems[k]) for _ in range(rnd.randint(2, 4))) for _ in range(n))
    train = [(text(k, 60), k) for k in stems for _ in range(20)] + [("x", None), (None, "aa")]
    d = L.train_dictionaries(spark.createDataFrame(train, "text string, lang string"), dict_bytes=4096)
    assert list(d) == sorted(stems) and all(len(x) <= 4096 for x in d.values())
    rows = [(i, text(k, 25).upper() if i % 2 else text(k, 25)) for i, k in enumerate(list(stems) * 10)]
    out = {r.doc_id: r for r in L.identify(frame(spark, rows), d).collect()}
    assert np.mean([out[i].lang_pred == k for i, k in enumerate(list(stems) * 10)]) >= 0.95
    odd = L.identify(frame(spark, [*odd_docs, (99, "123 ...")]), d).collect()
    assert len(odd) == len(odd_docs) + 1 and all(0 <= r.score <= 1 for r in odd)
    assert {r.lang_pred for r in odd if r.doc_id in (1, 2, 3, 99)} == {L.UNKNOWN}
    assert {r.lang_pred for r in L.identify(frame(spark, rows), {}).collect()} == {L.UNKNOWN}
    assert L.identify(frame(spark, []), d).collect() == []


def test_every_language_has_a_dictionary(spark):
    """Copies and very long texts take no room from a language's other texts."""
    df = lambda rows: spark.createDataFrame(rows, "text string, lang string")
    few = df([(f"{w}{i} " * 200, "copied") for i in range(30) for w in ["wort"]] + [("only one", "rare")])
    copied = spark.range(1000).select(Q.F.repeat(Q.F.lit("kopie "), 20_000).alias("text"), Q.F.lit("copied").alias("lang"))
    long = df([(f"{w} ", "long") for w in ("uno", "dos", "tres")]).select(
        Q.F.repeat("text", 2_000_000).alias("text"), "lang")
    train = few.union(copied).union(long)
    sample = L.training_sample(train, "text", "lang", 4096).collect()
    assert len({(r.lang, r.text) for r in sample}) == len(sample)
    assert all(r.before < 4096 for r in sample)
    d = L.train_dictionaries(train, dict_bytes=4096)
    assert list(d) == ["copied", "long", "rare"] and len(d["copied"]) > 2000 and len(d["long"]) == 4096


def test_background_favours_no_script_or_place(spark):
    lines = [f"{w} {i} story" for i in range(400) for w in ("Alpha", "beta", "история", "故事")]
    long = "\n".join(["x" * 5000, *lines])
    got = S.background(frame(spark, [(1, long), (2, None), (3, " \n")]), limit=200)
    count = {w: sum(x.startswith(w) for x in got) for w in ("Alpha", "beta", "история", "故事")}
    assert len(got) == 200 and set(got) <= set(long.split("\n"))
    assert all(n >= 25 for n in count.values())
    few = S.background(frame(spark, [(1, long)]), limit=200, most_bytes=1000)
    assert few == got[:len(few)] and sum(len(x.encode()) for x in few[:-1]) < 1000
    copied = frame(spark, [*((i, "one copied line") for i in range(50)), (99, "another line")])
    assert sorted(S.background(copied, sample_texts=2)) == ["another line", "one copied line"]
    assert S.background(frame(spark, [(1, None)])) == []
