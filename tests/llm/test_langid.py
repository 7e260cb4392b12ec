"""Language identification: held-out accuracy, plain recomputation of the scores, folds and odd rows."""

import math

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from graphmill.llm import langid
from graphmill.llm.common import mix64
from graphmill.llm.langid import calibrate, has_letter, op13_language_id, predict, subwords, train
from llm.conftest import crc_mod

SF1 = SF.replace("0.001", "0.01")


def plain_grams(text):
    raw = (" " + text.lower() + " ").encode()
    letters = [97 <= c <= 122 or c >= 128 for c in raw]
    out = []
    for n in (2, 3, 4):
        for i in range(len(raw) - n + 1):
            inner = letters[i + 1 : i + n - 1]
            if all(inner) and any(letters[i : i + n]):
                code = n
                for c, ok in zip(raw[i : i + n], letters[i : i + n], strict=True):
                    code = (code << 8) | (c if ok else 32)
                out.append(int(mix64(np.array([code], np.uint64))[0]) % langid.BUCKETS)
    return out


def plain_score(model, text):
    grams = plain_grams(text)
    logits = [sum(int(model.table[g, k]) for g in grams) / (1 << 20) / max(1, len(grams)) + model.bias[k] for k in range(len(model.languages))]
    e = [math.exp((x - max(logits)) / model.temperature) for x in logits]
    return model.languages[int(np.argmax(logits))], max(e) / sum(e)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF1}/documents.parquet")


@pytest.fixture(scope="module")
def model(spark, docs):
    return train(spark, docs.where("crc32(cast(doc_id as string)) % 4 <> 2"))


@pytest.mark.parametrize("size", [4, 7, 1 << 18])
def test_subwords_equal_plain_ones(monkeypatch, size):
    monkeypatch.setattr(langid, "PASS_BYTES", size)
    for text in ("", "a", "Ab c", "été 日本, x-y.\n\nEND", "a1b2 ß"):
        data = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)
        assert sorted(b for _, bucket in subwords(data) for b in bucket.tolist()) == sorted(plain_grams(text))


def test_held_out_accuracy(spark, docs):
    rows = op13_language_id(spark, SF1).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(r.held_out == (crc_mod(r.doc_id, 4) == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.98
    kept = [r for r in held if not r.rejected]
    assert len(kept) > 0.9 * len(held) and sum(r.lang_pred == r.lang for r in kept) / len(kept) >= 0.985
    assert all(0 <= r.score <= 1 for r in rows)


def test_short_texts(model):
    for text, lang in (("The erhable ofthing.", "en"), ("Den pfau keitung", "de"), ("Éclea que ieroiment", "fr"), ("Ciónmente el osmija", "es")):
        p = model.probabilities([text])[0]
        assert model.languages[int(p.argmax())] == lang


def test_scores_equal_plain_recomputation(spark, docs, model):
    for r in predict(spark, docs.limit(30), model, F.col("doc_id"), F.col("text").alias("t")).collect():
        lang, score = plain_score(model, r.t)
        assert r.lang_pred == lang and abs(r.score - score) < 1e-9 and r.rejected == (r.score < model.threshold)


def test_scores_do_not_depend_on_neighbours(spark, docs, model):
    a = predict(spark, docs, model, F.col("doc_id")).collect()
    b = predict(spark, docs.repartition(7), model, F.col("doc_id")).collect()
    assert sorted(a) == sorted(b)
    assert train(spark, docs.where("crc32(cast(doc_id as string)) % 4 <> 2").repartition(5)).bias.tolist() == model.bias.tolist()


def test_calibration_and_threshold():
    rng = np.random.default_rng(5)
    lang = rng.integers(0, 3, 4000)
    logits = rng.normal(0, 1, (4000, 3))
    logits[np.arange(4000), lang] += 2
    m = langid.Model(["a", "b", "c"], np.zeros((1, 3), np.int64), np.zeros(3))
    calibrate(m, lang, logits * 7, max_error=0.02)
    p = langid._softmax(logits * 7 / m.temperature)
    sure = p.max(axis=1)
    right = p.argmax(axis=1) == lang
    for low in (0.4, 0.6, 0.8):
        own = (sure >= low) & (sure < low + 0.15)
        assert abs(right[own].mean() - sure[own].mean()) < 0.06
    assert (~right[sure >= m.threshold]).mean() <= 0.02 and (sure >= m.threshold).mean() > 0.2


def test_other_columns_and_the_test_fold_are_not_read(spark, docs, model):
    changed = docs.withColumn("source", F.lit("x")).withColumn("lang", F.when(F.expr("crc32(cast(doc_id as string)) % 4 = 2"), "zz").otherwise(F.col("lang")))
    again = train(spark, changed.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    assert again.languages == model.languages and (again.table == model.table).all()


def test_odd_rows(spark, odd_docs, no_docs, model, tmp_path):
    rows = predict(spark, odd_docs, model, F.col("doc_id"), F.col("text").alias("t")).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.t is None or not has_letter(r.t):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in model.languages and r.score > 0
    for df, name in ((odd_docs, "a"), (no_docs, "b"), (odd_docs.withColumn("lang", F.lit(None).cast("string")), "c")):
        df.write.parquet(f"{tmp_path}/{name}/documents.parquet")
    got = op13_language_id(spark, f"{tmp_path}/a").collect()
    assert len(got) == odd_docs.count() and {r.lang_pred for r in got} <= {"en", "de", "und"}
    assert op13_language_id(spark, f"{tmp_path}/b").collect() == []
    assert {(r.lang_pred, r.score) for r in op13_language_id(spark, f"{tmp_path}/c").collect()} == {("und", 0.0)}
