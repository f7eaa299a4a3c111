"""The pipeline, stage by stage, against plain versions on a small table."""

import os

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from marketlens.llm import common, decontamination, quality_rules

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_registered():
    names = {f"op{n}" for n in range(1, 14)}
    assert names <= {k.split("_")[0] for k in E.queries()} and "pipeline" in E.queries()


def test_stages(spark, tmp_path):
    docs, kept = common.table(spark, SF, "documents"), []
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append({r.doc_id: r for r in docs.collect()})
        assert docs.columns == columns or name == "packing"
    first = {r.doc_id: r for r in common.table(spark, SF, "documents").collect()}
    good = {r.doc_id for r in quality_rules.quality_rules(common.table(spark, SF, "documents")).where("kept").collect()}
    assert set(kept[0]) == good
    after = [(d, kept[0][d].text) for d in sorted(kept[0])]
    comp = brute.jaccard_components(after, 5, 4, 5)
    assert set(kept[1]) == {c for _, _, c in comp}
    cut = brute.byte_strings([(d, r.text) for d, r in kept[1].items()], corpus_pipeline.REPEAT_BYTES)
    lost = {d for d, _, n, _, _ in cut if n}
    assert all((kept[2][d].text != kept[1][d].text) == (d in lost) for d in kept[1])
    items = [(r.item_id, r.text) for r in common.table(spark, SF, "benchmark").collect()]
    bad = {x[0] for x in brute.contamination([(d, r.text) for d, r in kept[2].items()], items) if x[5]}
    assert set(kept[3]) == set(kept[2]) - bad
    assert set(kept[4]) == set(kept[3]) and set(kept[3]) <= set(first)
    words = sum(len(r.text.split()) for r in kept[3].values())
    assert sum(r.n_tokens for r in docs.collect()) == words


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "n_tokens", "bucket", "batch", "slot"] and out.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and decontamination.WINDOW == 13


def rows_of(spark, odd_docs, folder, keep=lambda r: True):
    """The odd documents as a folder of tables, with columns whose names the operators use."""
    long = [(200 + i, " ".join(f"v{(i * 37 + j * j) % 997}" for j in range(90)) + ".") for i in range(30)]
    docs = [r for r in odd_docs + long + [long[0], (300, long[0][1])] if keep(r)]
    brute.frame(spark, docs).withColumns({"spans": F.lit(1), "label": F.lit("x"), "kept": F.lit(True)}).write.parquet(
        f"{folder}/documents.parquet")
    spark.createDataFrame([("b1", " ".join(long[3][1].split()[5:60])), (None, "x"), ("b2", None)],
                          "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs


def test_odd_tables_pass_all_stages(spark, odd_docs, tmp_path):
    """Nulls, missing ids, repeated rows, clashing names; each stage keeps the columns."""
    rows_of(spark, odd_docs, str(tmp_path / "a"))
    docs = common.table(spark, str(tmp_path / "a"), "documents")
    columns, left = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path / "a")).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        assert docs.columns == columns
        left.append([r.doc_id for r in docs.collect()])
    assert all(r is None or r not in (1, 2, 3, 4) for r in left[0])  # no text, or too short
    assert 200 in left[1] and 300 not in left[1] and left[1].count(200) == 1
    assert 203 in left[2] and 203 not in left[3]
    assert corpus_pipeline.run(spark, str(tmp_path / "a")).count() >= len(left[3])


def test_empty_tables_pass_all_stages(spark, odd_docs, tmp_path):
    rows_of(spark, odd_docs, str(tmp_path / "a"), keep=lambda r: False)
    out = corpus_pipeline.run(spark, str(tmp_path / "a"))
    assert out.collect() == [] and "doc_id" in out.columns
