from __future__ import annotations

import numpy as np
import pytest
from postlake.llm import langid as g
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.cases import LONG, TEXTS, documents, empty


def model_of(samples):
    names = sorted(samples)
    counts = np.zeros((len(names), g.BUCKETS)) + g.SMOOTH
    for i, name in enumerate(names):
        for _, _, c in g.trigram_counts([samples[name]]):
            counts[i] += c
    return names, (counts / counts.sum(axis=1, keepdims=True)).T.copy()


ENGLISH = "the quick brown fox and the lazy dog with that thing which they think " * 5
GERMAN = "der schnelle fuchs und ein fauler hund mit dem ding das sie nicht denken " * 5


def test_mixture_proportions():
    names, model = model_of({"de": GERMAN, "en": ENGLISH})
    texts = [ENGLISH, GERMAN, ENGLISH * 3 + GERMAN, "the dog", None, "12 !?", ""]
    languages, scores = g.predict(texts, names, model)
    assert languages == ["en", "de", "en", "en", "und", "und", "und"]
    assert scores[0] == scores[1] == 1 and 0.65 < scores[2] < 0.85 and scores[4] == 0


def test_em_climbs_and_single_language_is_exact():
    names, model = model_of({"de": GERMAN, "en": ENGLISH})
    (_, n, counts), = g.trigram_counts([ENGLISH + GERMAN])
    counts = counts.reshape(n, g.BUCKETS)
    owner, bucket = np.nonzero(counts)
    args = owner, counts[owner, bucket].astype(float), model[bucket], counts.sum(axis=1).astype(float)
    values = [g._mixture(*args, np.full((1, 2), 0.5), np.ones((1, 2)), r)[1][0] for r in range(6)]
    assert all(b >= a - 1e-9 for a, b in zip(values, values[1:], strict=False))
    answer, share = g.infer(counts, model, penalty=1e9)
    assert share[0] == 1 and answer[0] == np.argmax([(counts[0] * np.log(model[:, k])).sum() for k in (0, 1)])


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = g.report(docs)
    rows = found.join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(rows) > 200 and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.97


def test_prediction_ignores_lang(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(300)
    names, model = g.train(docs, F.lit(True))
    a = g.identify(docs, names, model).collect()
    b = g.identify(docs.withColumn("lang", F.lit("xx")), names, model).collect()
    assert a == b


@pytest.mark.parametrize("lang", [True, False])
def test_hard_rows(spark, lang):
    docs = documents(spark)
    if not lang:
        docs = docs.withColumn("lang", F.lit(None).cast("string"))
    found = g.report(docs).collect()
    assert len(found) == len(TEXTS)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[i].lang_pred == "und" and by_id[i].score == 0 for i in (2, 3, 5))
    assert by_id[4].lang_pred == ("en" if lang else "und") and len(LONG) > 100_000
    assert all(0 <= r.score <= 1 and r.held_out is not None for r in found)
    assert g.report(empty(spark)).count() == 0


def test_many_short_texts_stay_small():
    sizes = [n for _, n, _ in g.trigram_counts(["ab"] * 1000)]
    assert max(sizes) <= g.GROUP and sum(sizes) == 1000
