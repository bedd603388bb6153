"""Null and repeated ids return every row once and mix none; extra columns of any type and texts full of matches."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import decontaminate, exact_dedup, minhash, pii, quality, repeats
from emporia.llm.common import small_batches

LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [(1, LONG), (1, "x1 x2 x3 x4 x5 x6 x7"), (None, "only rows without id have this text"), (None, "only rows without id have this text"),
        (None, LONG + " more"), (2, "x1, x2, x3 x4 x5 x6 x7"), (None, None), (3, ""), (4, "!!")]


def _docs(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "c", 7) for i, t in rows], "doc_id long, text string, class_id string, th int")


def test_near_classes_with_null_and_repeated_ids(spark):
    got = [(r.doc_id, r.class_id, r.class_size) for r in minhash.classes(_docs(spark).select("doc_id", "text")).collect()]
    want = [(1, 1, 2), (1, 1, 2), (2, 1, 2), (None, 1, 2), (None, None, 2), (None, None, 2), (None, None, 1), (3, 3, 1), (4, 4, 1)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_near_dedup_keeps_one_row_of_each_group(spark):
    kept = minhash.dedup(_docs(spark))
    assert kept.columns == ["doc_id", "text", "class_id", "th"]
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [ROWS[0], ROWS[1], ROWS[2], ROWS[3], ROWS[6], ROWS[7], ROWS[8]]  # a group without any id keeps its rows
    assert got == sorted(want, key=str)


def test_no_documents(spark):
    assert minhash.classes(_docs(spark, [])).count() == 0 and minhash.dedup(_docs(spark, [])).count() == 0


def test_batch_size_is_put_back(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        with small_batches(spark, "1m"):
            assert spark.conf.get(key) == "1m"
            raise KeyError
    except KeyError:
        pass
    assert spark.conf.get(key) == before


def test_texts_of_pairs_pass_the_filter_and_few_others(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text  "), F.col("id").cast("string")).alias("text"))
    pairs = docs.where("doc_id % 100 = 0").select(F.sha2(exact_dedup.normalised(), 256).alias("hex"))
    got = {r.id for r in exact_dedup.named_texts(docs, pairs).select("id").collect()}
    assert {i for i in range(4000) if i % 100 == 0} <= got and len(got) < 60
    assert exact_dedup.named_texts(docs, pairs.limit(0)).count() == 0


def _of(frame, *names):
    return sorted((tuple(r[n] for n in names) for r in frame.collect()), key=str)


@pytest.mark.parametrize("bound", [100_000, 0])
def test_decontamination_mixes_no_rows(spark, bound):
    leak = "a b c d e f g h i j"
    bench = spark.createDataFrame([("x", leak)], "item_id string, text string")
    rows = [(1, f"one {leak}"), (1, "clean words"), (None, f"two {leak}"), (None, "other"), (None, "other"), (2, "x"), (None, None), (2, "x")]
    want = [(1, 11, 10), (1, 2, 0), (None, 11, 10), (None, 1, 0), (None, 1, 0), (2, 1, 0), (2, 1, 0), (None, 0, 0)]
    assert _of(decontaminate.scan(_docs(spark, rows), bench, bound), "doc_id", "n_words", "n_hit") == sorted(want, key=str)
    kept = decontaminate.clean(_docs(spark, rows), bench)
    assert kept.columns == _docs(spark).columns
    assert _of(kept, "doc_id", "text") == sorted((r for r in rows if leak not in (r[1] or "")), key=str)


def test_repeats_with_null_and_repeated_ids(spark):
    rng = random.Random(5)
    some = lambda n: "".join(rng.choice("abcdefghij klmnop") for _ in range(n))
    shared, alone = some(512), some(900)
    rows = [(1, some(50) + shared + some(40)), (None, some(30) + shared), (1, alone), (None, alone), (None, alone), (2, some(700)), (None, None),
            (3, some(450)), (3, some(450)), (2**60 + 1, "x" * 399)]
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in repeats.remove(_docs(spark, rows)).collect())
    want = [(str(i), len(t or ""), 512 if t and shared in t else 900 if t == alone else 0, int(bool(t) and (shared in t or t == alone))) for i, t in rows]
    assert got == sorted(want)


def test_accepted_keeps_columns_of_every_type(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    frame = spark.createDataFrame([(i, "Plain words stand here. " * 9 if i % 2 else "##|| " * 40, 2**60 + i if i % 3 else None, [i], None) for i in range(40)],
                                  "doc_id long, text string, x long, _keep_key array<int>, at timestamp")
    kept = quality.accepted(frame, labels)
    assert kept.schema == frame.schema
    assert sorted(r.doc_id for r in kept.collect()) == list(range(1, 40, 2))
    assert {r.doc_id: r.x for r in kept.collect()} == {i: 2**60 + i if i % 3 else None for i in range(1, 40, 2)}


def test_ridge_and_isotonic_equal_independent_fits(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(400, len(quality.STATISTICS)))
    y = (x[:, 0] + rng.normal(size=400) > 0.6).astype(float)
    rows = spark.createDataFrame([(v.tolist(), float(t)) for v, t in zip(x, y, strict=True)], "x array<double>, y double").repartition(7)
    model = quality.fit(rows)
    z, w = model.fourier(x), np.where(y > 0.5, 400 / (2 * y.sum()), 400 / (2 * (400 - y.sum())))
    penalty = np.sqrt(np.r_[np.full(z.shape[1] - 1, quality.RIDGE), 1e-6])
    want = np.linalg.lstsq(np.vstack([z * np.sqrt(w)[:, None], np.diag(penalty)]), np.r_[np.sqrt(w) * (2 * y - 1), np.zeros(z.shape[1])], rcond=None)[0]
    assert np.allclose(model.weights, want, atol=1e-6)
    at, mean, weight = np.arange(30.0), rng.random(30), rng.integers(1, 5, 30).astype(float)
    # Isotonic regression by its min-max formula.
    block = lambda i, j: np.average(mean[i : j + 1], weights=weight[i : j + 1])
    exact = [max(min(block(i, j) for j in range(k, 30)) for i in range(k + 1)) for k in range(30)]
    assert np.allclose(np.interp(at, *quality.isotonic(at, mean, weight)), 0.001 + 0.998 * np.array(exact), atol=1e-3)


def test_pii_places_in_a_text_full_of_matches(spark):
    rng = random.Random(3)
    words = [rng.choice(["ann@mail.org", "10.0.0.7", "plain", "é", "+49 30 1234567"]) for _ in range(20_000)]
    text, at, want = " ".join(words), 0, []
    for w in words:
        if w not in ("plain", "é"):
            want.append(f"{'email' if '@' in w else 'phone' if w[0] == '+' else 'ip'}:{at}:{at + len(w)}")
        at += len(w) + 1
    row = pii.detect(_docs(spark, [(1, text), (None, None)]).select("doc_id", "text")).where("doc_id = 1").first()
    got = row.base.split(",")
    assert [g for g in got if g[:4] in ("emai", "ip:1")] == [g for g in want if g[:4] in ("emai", "ip:1")]
    assert row.n_email == sum(w[0] == "a" for w in words)
