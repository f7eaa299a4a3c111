import base64
import hashlib
import itertools
import random
import uuid

import numpy as np
from brute import frame
from pyspark.sql import functions as F

from marketlens.llm import common, packing, warc


def test_loser_tree():
    rnd = random.Random(2)
    for _ in range(100):
        runs = [sorted(rnd.choices(range(20), k=rnd.randint(0, 6))) for _ in range(rnd.randint(0, 9))]
        assert list(warc.LoserTree(runs, lambda x: (x,))) == sorted(itertools.chain(*runs))


def archive(spark, rows, min_bytes=0):
    path = f"{common.scratch_dir(spark)}/warc-{uuid.uuid4().hex}"
    df = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    warc.write_archives(df, path, "page_id", "url", "html", F.timestamp_seconds(F.col("page_id")), min_bytes, 4)
    return warc.capture_index(common.materialize(warc.read_archives(spark, path), "captures")).collect()


def test_round_trip(spark):
    body = "<p>" + "é\r\n\r\nWARC/1.1\r\n\x00" * 40
    rows = [(3, "http://www.b.org/x?Q=1#f", body), (7, "https://a.b.org", body), (5, None, body), (None, "", "only"),
            (9, "b.org/", None), (8, "http://b.org/", ""), (11, "no\r\nscheme", "x" * 300_000), (7, "http://again", body),
            (None, "u", body)]
    out = archive(spark, [(*r, "clash") for r in rows])
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(x for x in (best.get(h or "", -1), -1 if i is None else i))
    want = []
    for i, _, h in rows:
        p = (h or "").encode()
        top = best[h or ""]
        revisit = top >= 0 and i != top
        want.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response",
                     top if revisit else None))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert [(r.url_key, r.timestamp) for r in out] == sorted((r.url_key, r.timestamp) for r in out)
    assert {r.url_key for r in out if r.page_id == 3} == {"org,b)/x?q=1"}


def test_small_payloads_are_no_revisits(spark):
    out = archive(spark, [(1, "u", "abc", ""), (2, "u", "abc", ""), (3, "u", "abcdef", ""), (4, "u", "abcdef", "")], 4)
    assert {r.page_id: r.record_type for r in out} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_empty_archive(spark):
    assert archive(spark, []) == []


def test_bounds_have_the_least_padding():
    rnd = random.Random(6)
    for _ in range(40):
        lengths = np.array(sorted(rnd.sample(range(1, 40), rnd.randint(1, 8))))
        counts = np.array([rnd.randint(1, 9) for _ in lengths])
        k = rnd.randint(1, 5)
        cost = lambda b: sum(c * (min(x for x in b if x >= n) - n) for n, c in zip(lengths, counts))
        last = int(lengths[-1])
        best = min(cost([*c, last]) for r in range(min(k, len(lengths)))
                   for c in itertools.combinations(lengths[:-1].tolist(), r))
        got = packing.best_bounds(lengths, counts, k)
        assert len(got) <= k and got[-1] == last and cost(got) == best


def test_tokens_are_packed(spark, tmp_path):
    """The registered query fills its budget with the tokenizer's tokens, also of texts without blanks."""
    import public_tokenizers
    import sentencepiece
    rows = [(1, "語" * 9000), (2, None), (3, ""), *((10 + i, "some words " * (i + 1)) for i in range(40))]
    path = str(tmp_path / "documents.parquet")
    frame(spark, rows).write.parquet(path)
    out = packing.op8_length_buckets(spark, str(tmp_path)).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=str(public_tokenizers.path("piece_bpe_32k.model")))
    want = {i: len(sp.encode(t or "")) for i, t in rows}
    got = {}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
        assert r.n_tokens <= 4096
    assert got == want and sum(r.doc_id == 1 for r in out) == -(-want[1] // 4096) > 1
    room = {}
    for r in out:
        if r.n_tokens:
            room[r.bucket, r.batch] = room.get((r.bucket, r.batch), 0) + r.bucket
    assert all(x <= 65536 for x in room.values())


def test_batches(spark, odd_docs):
    rows = odd_docs + [(1000 + i, "w " * (i % 300)) for i in range(600)]
    counts = packing.word_counts(frame(spark, rows), ("doc_id",))
    out = packing.pack(counts, max_tokens=256, buckets=5, budget=1024).collect()
    words = sum(len((t or "").split()) for _, t in rows)
    assert sum(r.n_tokens for r in out) == words
    full = [r for r in out if r.n_tokens]
    assert all(r.batch is None and r.bucket is None for r in out if not r.n_tokens)
    assert all(r.n_tokens <= r.bucket for r in full) and len({r.bucket for r in full}) <= 5
    batches = {}
    for r in full:
        batches.setdefault((r.bucket, r.batch), []).append(r.slot)
    for (b, _), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) * b <= 1024
    for b in {r.bucket for r in full}:  # only the last batch of a bucket may have room
        open_ = [k for k, s in batches.items() if k[0] == b and len(s) < 1024 // b]
        assert len(open_) <= 1 and sorted(k[1] for k in batches if k[0] == b) == list(range(sum(k[0] == b for k in batches)))
    assert packing.pack(packing.word_counts(frame(spark, []), ("doc_id",))).collect() == []
