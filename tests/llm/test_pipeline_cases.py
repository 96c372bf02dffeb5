"""The whole pipeline on nulls, empty tables and columns of clashing names."""

import random

from pyspark.sql import functions as F

import corpus_pipeline

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("row", "key", "node", "kept", "spans", "n_words", "class_id", "found", "class", "ids", "name")


def put(spark, folder, docs, benchmark, labels):
    for name, df in (("documents", docs), ("benchmark", benchmark), ("labels", labels)):
        df.write.parquet(f"{folder}/{name}.parquet")


def test_nulls_empty_texts_repeats_and_clashing_columns(spark, tmp_path):
    rng = random.Random(1)
    prose = lambda: " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(120))
    passage = prose()
    texts = [prose(), prose(), None, "", " \n", "one word", prose() + " mail a@b.cd", "x" * 400_000, passage + " " + prose(), prose() + " é " * 60]
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    rows += [rows[0], (None, texts[1], None, None, None), (50, texts[1], "en", "s", 1), (51, texts[6] + " end", "en", "s", 1)]
    docs = spark.createDataFrame(rows, DOC).withColumns({c: F.lit(1) for c in CLASHING})
    bench = spark.createDataFrame([("q1", passage), (None, None), ("q2", ""), ("q3", "two words")], "item_id string, text string")
    put(spark, tmp_path, docs, bench, spark.read.parquet(f"{SF}/labels.parquet").limit(0))
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    # of equal texts the smallest id stays; texts of fewer than 50 words go by the base rule
    assert set(got) == {0, 1, 6, 8, 9}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got.values())


def test_empty_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("benchmark", "labels"))
    put(spark, tmp_path / "none", docs.limit(0), bench, labels)
    out = corpus_pipeline.run(spark, str(tmp_path / "none"))
    assert out.count() == 0 and "ids" in out.columns
    put(spark, tmp_path / "some", docs.where("doc_id < 40"), bench.limit(0), labels)
    assert corpus_pipeline.run(spark, str(tmp_path / "some")).count() > 0
