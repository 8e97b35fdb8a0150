"""The pipeline's stages on a small table in which it is known what each has to do."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import pieces
from tests.conftest import SMALL
from tests.llm.test_corpus_operators import DOCS, edited, prose


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    item = prose(40, 71)
    base = prose(80, 72)
    rows = [
        (1, base, "en"), (2, " ".join(edited(base.split(), 1, 3)), "en"), (3, base, "en"), (4, "!!! 123", "en"), (5, None, "en"), (6, prose(50, 73) + " " + item + " " + prose(20, 74), "en"),
        (7, prose(60, 75) + " token = 0123456789abcdef0123 end", None), (8, prose(70, 76), "de"), (None, prose(70, 77), "en"), (8, prose(70, 76), "de"),
    ]
    spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x") for i, t, lang in rows], DOCS + ", extra string").write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, folder).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        kept.append(sorted((r["doc_id"] for r in docs.collect()), key=str))
        if k < 4:
            assert docs.columns == before.columns, name
    assert kept[0] == [1, 2, 3, 6, 7, 8, 8, None] and kept[1] == [1, 6, 7, 8, None] and kept[2] == [1, 7, 8, None] == kept[3] == kept[4]
    masked = spark.read.parquet(str(tmp_path / "3")).filter("doc_id = 7").first()
    assert masked["text"].endswith("[SECRET] end") and masked["n_chars"] == len(masked["text"])
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(str(tmp_path / "3")).collect()}
    model = pieces.Pieces(pieces.default_model())
    assert all(model.decode(r["token_ids"]) == texts[r["doc_id"]] and r["n_tokens"] == len(r["token_ids"]) for r in docs.collect())


def test_columns_named_like_a_stage_s_own(spark, folder):
    odd = spark.read.parquet(f"{folder}/documents.parquet")
    for c in ("lang_pred", "score", "own_lang_pred", "own_score", "row", "token_ids", "spans", "held_out", "n"):
        odd = odd.withColumn(c, F.concat(F.lit(c), F.col("doc_id").cast("string")))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, odd, folder)
        assert got.columns == odd.columns, name
        assert got.filter("doc_id is not null and (score <> concat('score', doc_id) or own_score <> concat('own_score', doc_id) or row <> concat('row', doc_id))").count() == 0, name


def test_null_and_repeated_ids(spark):
    one, two, three = prose(80, 91), prose(80, 92), prose(80, 93)
    rows = [(None, one), (None, one), (None, " ".join(edited(one.split(), 1, 4))), (5, two), (5, three), (5, three), (6, two), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], DOCS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in got if r["doc_id"]) == sorted([(5, two), (5, three)])
    assert len([r for r in got if r["doc_id"] is None]) == 2


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).count() == 4
    whole = corpus_pipeline.run(spark, SMALL)
    assert 100 < whole.count() < 200 and whole.filter(F.col("n_tokens") < 1).count() == 0


def test_empty_table(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SMALL}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
