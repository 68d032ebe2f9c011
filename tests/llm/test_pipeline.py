"""The stages one after another on a small set of documents."""

import random

import corpus_pipeline
from tests.llm.conftest import sentence


def test_stages(spark, tmp_path):
    rng = random.Random(21)
    item = sentence(rng, 30)
    clean = ["\n".join(sentence(rng, 15) for _ in range(8)) for _ in range(6)]
    secret = clean[5] + '\nThe token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is here.'
    texts = [clean[0], clean[0], clean[1] + " " + item, clean[2], "too short", None, secret]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = [[0, 1, 2, 3, 6], [0, 2, 3, 6], [0, 3, 6], [0, 3, 6], [0, 3, 6]]
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, ((name, stage), ids) in enumerate(zip(corpus_pipeline.STAGES, left, strict=True)):
        out = stage(spark, now, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}.parquet")
        now = spark.read.parquet(f"{tmp_path}/{k}.parquet")
        assert sorted(r["doc_id"] for r in now.collect()) == ids, name
    masked = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{tmp_path}/3.parquet").collect()}
    assert "[SECRET]" in masked[6] and "04dbebab" not in masked[6]
    whole = {r["doc_id"]: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(whole) == {0, 3, 6} and all(r["round_trip"] and r["n_tokens"] == len(r["tokens"]) for r in whole.values())
