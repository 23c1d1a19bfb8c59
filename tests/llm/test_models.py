"""Language ID and toxicity: held-out accuracy on the synthetic table, and awkward rows."""

import numpy as np
from pyspark.sql import functions as F

from gleaner.llm import language, toxicity

SF = "/root/testdata/sf0.01"
ODD = "doc_id long, text string, lang string, score string, rejected int, toxic int"
ODD_ROWS = [(1, None, None, "x", 1, None), (2, "", "en", None, None, 0), (2, "", "en", None, None, 0), (None, "1234 !!", "xx", None, None, 1), (5, "the " * 40_000, "en", None, None, 0)]


def test_kneser_ney_sums_to_one():
    texts = {"a": ["abab abba baab"] * 3, "b": ["cdcd dccd cdd"] * 3}
    model = language.estimate(texts, order=3)
    points = sorted({c for t in texts.values() for x in t for c in x})
    for before in ("ab", "cd", "zz"):
        tails = [before + c for c in [*points, "q"]]
        total = np.zeros(2)
        for t in tails:
            h1, n1 = language.entropies(model, [t])
            h0, n0 = language.entropies(model, [before])
            total += np.exp(-(h1[0] * len(t) - h0[0] * len(before)))
        assert (total < 1.001).all() and (total > 0.9).all()


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = language.op2_language_id(spark, SF).join(docs.select("doc_id", "lang", F.length("text").alias("n")), "doc_id").collect()
    held = [r for r in rows if r.held_out and r.n > 40]
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.98
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 2


def test_language_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(language.training_rows(docs), max_docs=60)
    odd = spark.createDataFrame(ODD_ROWS, ODD)
    got = language.predict(odd, model).collect()
    assert [(r.doc_id, r.lang_pred, r.rejected) for r in sorted(got, key=lambda r: (r.doc_id is None, r.doc_id or 0))] == [(1, "und", True), (2, "und", True), (2, "und", True), (5, "en", False), (None, "und", True)]
    assert language.reject(odd, model).columns == odd.columns
    rubbish = spark.createDataFrame([(1, "qxzjv kqwzx jxqvk " * 60, None)], "doc_id long, text string, lang string")
    assert language.predict(rubbish, model).first().rejected
    nothing = language.fit(language.training_rows(docs.limit(0)))
    assert language.predict(docs.limit(3), nothing).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language.predict(docs.limit(0), model).count() == 0


def test_language_rejects_short_foreign_text_with_junk_among_the_labels(spark):
    rows = language.training_rows(spark.read.parquet(f"{SF}/documents.parquet")).orderBy("doc_id").collect()
    texts = {}
    for r in rows:
        texts.setdefault(r.lang, []).append(r.text)
    rng = np.random.default_rng(7)
    rubbish = lambda n: "".join(rng.choice(list("bcdfghjklmnpqrstvwxz "), n))
    model = language.estimate({k: v[::2] for k, v in texts.items()})
    language.calibrate(model, {k: [*v[1::2], rubbish(20_000)] for k, v in texts.items()})
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, "
    foreign = [finnish, finnish * 3, finnish * 9, rubbish(120), rubbish(1_000), "Все люди рождаются свободными и равными"]
    assert language.predict_texts(model, foreign)[3].all()
    own = [t for v in texts.values() for t in v[1::2] if len(t) > 40]
    assert language.predict_texts(model, own)[3].mean() < 0.01


def test_toxicity_held_out(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = toxicity.op8_toxicity(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    caught = [r.predicted for r in held if r.toxic == 1]
    wrong = [r.predicted for r in held if r.toxic == 0]
    assert np.mean(caught) >= 0.65 and np.mean(wrong) <= 0.04


def test_toxicity_odd_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = toxicity.training_labels(spark.read.parquet(f"{SF}/labels.parquet"))
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame(ODD_ROWS, ODD)
    got = toxicity.score(odd, model).collect()
    assert len(got) == len(ODD_ROWS) and all(0 <= r.score <= 1 for r in got)
    again = toxicity.reject(odd, model)
    assert again.columns == odd.columns
    assert toxicity.score(odd.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert toxicity.score(odd, none).agg(F.max("score")).first()[0] < 1e-6
