"""Stages return the values of their input's columns, whatever those are called."""

import random

from tests.llm.conftest import sentence
from tidemark.llm import cgk, gam, quality_rules, secret_scan

NAMES = (
    "kept n_words n_repeat_words n_symbols lost_chars cleaned _words _lines _good runs base spans _body _text leaks "
    "carried_0 carried_3 masked bin"
).split()


def clashing(spark):
    rng = random.Random(8)
    texts = ["\n".join(sentence(rng, 15) for _ in range(6)) for _ in range(3)] + [None]
    texts[1] += '\nThe token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" is here.'
    rows = [(*[f"{name} {i}" for name in NAMES], i, t, len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(f"{n} string" for n in NAMES) + ", doc_id long, text string, n_chars long"), texts


def test_values_stay(spark):
    docs, texts = clashing(spark)
    item = " ".join(texts[2].split()[5:35])
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for stage, left in ((quality_rules.keep_good, {0, 1, 2}), (secret_scan.mask_secrets, {0, 1, 2, 3}), (lambda d: cgk.keep_clean(d, items), {0, 1, 3})):
        out = stage(docs)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        rows = out.collect()
        assert {r["doc_id"] for r in rows} == left
        for r in rows:
            assert all(r[name] == f"{name} {r['doc_id']}" for name in NAMES)
            assert r["n_chars"] == len(r["text"] or "")


def test_repeated_ids_train_the_same_model(spark):
    rng = random.Random(3)
    rows = [(i % 30, sentence(rng, 5 + i % 40)) for i in range(90)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    a, b = (gam.classify(frame.repartition(n), labels).orderBy("doc_id", "score").collect() for n in (2, 5))
    assert a == b
