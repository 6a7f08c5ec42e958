import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtables.llm import langid
from gridtables.llm.common import held_out, utf8

SCHEMA = "doc_id long, text string, lang string, score string"
SYLLABLES = {"aa": ["ba", "lo", "mi", "tun"], "bb": ["sch", "über", "ei", "ng"], "cc": ["ño", "que", "ción", "ra"]}


def text(lang, n, seed):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(n)).capitalize() + "."


def docs(spark, n=240):
    rows = [(i, text(lang, 3 + i % 40, i), lang, "clash") for i in range(n) for lang in [sorted(SYLLABLES)[i % 3]]]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(3)


def sets(value, lengths=langid.LENGTHS):
    b = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in value.encode())
    return {b[i : i + p] for p in lengths for i in range(len(b) - p + 1)}


def code(gram):
    return len(gram) << 56 | int.from_bytes(gram, "big")


def test_kernel_equals_sets(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(langid, "SLICE", 37)  # n-grams across the steps
    texts = ["Ba lo! ba", "", "über 12 ÜBER", "x", "que que que " * 20, None]
    marks = ["ba lo mi", "über sch", "que ra"]
    found = langid.gram_sets(*utf8(pa.array(marks)), langid.LENGTHS)
    assert [set(map(int, f)) for f in found] == [{code(g) for g in sets(m)} for m in marks]
    codes = np.unique(np.concatenate(found))
    bits = np.packbits(np.stack([np.isin(codes, f) for f in found]), axis=1)
    model = langid.Model(("aa",), langid.LENGTHS, codes, bits, np.zeros((4, 1)))
    vocabulary = set().union(*(sets(m) for m in marks))
    got = model.kernel(*utf8(pa.array(texts)))
    for row, t in zip(got, texts):
        own = sets(t or "") & vocabulary
        want = [len(own & sets(m)) / max(1, len(own)) ** 0.5 / len(sets(m)) ** 0.5 for m in marks]
        assert np.allclose(row, [*want, 1], atol=1e-6)


def test_weights_solve_the_regression(spark):
    rows, df = docs(spark, 90)
    chosen = langid.sample(df.select(F.col("doc_id").alias("id"), F.col("text").alias("body"), "lang"))
    assert chosen.count() == 90
    model = langid.fit(chosen, landmarks=8, penalty=1e-3)
    landmarks = model.landmarks.astype(float)
    import pyarrow as pa

    kernel = model.kernel(*utf8(pa.array([r[1] for r in rows])))
    target = np.array([[1 if r[2] == x else -1 for x in model.languages] for r in rows], float)
    values, vectors = np.linalg.eigh(landmarks.T @ landmarks)
    keep = values > 1e-6 * values.max()
    features = np.hstack([kernel[:, :-1] @ vectors[:, keep] / np.sqrt(values[keep]), kernel[:, -1:]])
    ridge = 1e-3 * 90 * np.diag([1.0] * int(keep.sum()) + [0.0])
    want = features @ np.linalg.solve(features.T @ features + ridge, features.T @ target)
    assert np.allclose(kernel @ model.weights, want, atol=1e-6)


def test_held_out_accuracy_and_defined_cases(spark):
    rows, df = docs(spark)
    model = langid.learn(df, ~held_out("doc_id", 5, 0), landmarks=12)
    assert model.languages == ("aa", "bb", "cc")
    more = [(900, None, "aa", "c"), (901, "", "aa", "c"), (902, "12 + 3 !", None, "c"), (None, text("bb", 30, 1), None, "c"),
            (903, text("cc", 60_000, 2), None, "c"), (0, rows[0][1], None, "c")]
    got = langid.predict(df.unionByName(spark.createDataFrame(more, SCHEMA)), model).collect()
    assert len(got) == len(rows) + len(more)
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
    assert all((by[i][0].lang_pred, by[i][0].score) == ("und", 0.0) for i in (900, 901, 902))
    assert by[None][0].lang_pred == "bb" and by[903][0].lang_pred == "cc" and len(by[0]) == 2
    assert sum(by[i][0].lang_pred == lang for i, _, lang, _ in rows) / len(rows) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_no_or_one_language(spark):
    _, df = docs(spark, 9)
    none = langid.learn(df.withColumn("lang", F.lit(None).cast("string")), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, none).collect()} == {("und", 0.0)}
    one = langid.learn(df.withColumn("lang", F.lit("aa")), F.lit(True))
    assert {(r.lang_pred, r.score) for r in langid.predict(df, one).collect()} == {("aa", 1.0)}
    assert langid.predict(df.limit(0), one).collect() == []


@pytest.mark.parametrize("per_language", [20])
def test_sample_is_bounded_by_language(spark, per_language):
    rows = [(i, "a b", "hot" if i % 3 else "rare", "c") for i in range(3000)] + [(9999, "a", "one", "c")]
    df = spark.createDataFrame(rows, SCHEMA).select(F.col("doc_id").alias("id"), F.col("text").alias("body"), "lang")
    found = {r.lang: r["count"] for r in langid.sample(df, per_language).groupBy("lang").count().collect()}
    assert found["one"] == 1 and 5 < found["hot"] < 50 and 5 < found["rare"] < 50
