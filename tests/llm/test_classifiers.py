import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cases import TEXTS, documents, plain
from martbrook.llm import features, quality, toxicity

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels")]


@pytest.fixture(scope="module")
def toxic_model(tables):
    return toxicity.fit(*tables)


@pytest.fixture(scope="module")
def quality_model(tables):
    return quality.fit(*tables)


def held_out(scored, labels):
    rows = scored.join(labels, "doc_id").filter(features.remainder("doc_id") == 1).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows)
    return rows


def test_toxic_texts_of_the_held_out_fold(tables, toxic_model):
    docs, labels = tables
    rows = held_out(toxicity.scores(docs, toxic_model), labels)
    toxic, clean = [[r for r in rows if r.toxic == t] for t in (1, 0)]
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.03 * len(clean)
    ahead = [(t.score > c.score) + 0.5 * (t.score == c.score) for t in toxic for c in clean]
    assert np.mean(ahead) > 0.85


def test_toxic_texts_of_all_lengths(spark):
    """On more rows: precision, and recall in bands of length. Some labels are wrong, most of them on short texts."""
    docs, labels = [spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels")]
    scored = toxicity.scores(docs, toxicity.fit(docs, labels)).join(docs.select("doc_id", F.length("text").alias("long")), "doc_id")
    rows = held_out(scored, labels)
    called = [r for r in rows if r.predicted]
    assert sum(r.toxic for r in called) >= 0.95 * len(called)
    toxic = [r for r in rows if r.toxic]
    for least, most, share in ((0, 1 << 40, 0.8), (500, 1500, 0.8), (1500, 4000, 0.8), (4000, 1 << 40, 0.9)):
        band = [r.predicted for r in toxic if least <= r.long < most]
        assert sum(band) >= share * len(band)


def test_a_passage_counts_alike_wherever_it_stands(toxic_model):
    grams = features.CharGrams(toxicity.ORDERS, toxicity.BITS)
    passage, calm = "you stupid worthless idiot, pathetic loser. " * 4, "the rain in the hills and of the one. " * 2000
    alone = toxic_model.score(grams.places(passage))
    assert toxic_model.score(grams.places(calm)) < 0.7 <= alone
    for text in (calm + passage, passage + calm, calm + passage + calm):
        assert toxic_model.score(grams.places(text)) >= alone - 1e-6


def test_worst_window_is_that_of_all_windows():
    pick = np.random.default_rng(3)
    weights = pick.normal(size=1 << 20)
    grams = features.CharGrams((3, 4, 5), 20)
    for text in ("", "a", "ab", "abc", "short text", "a longer text of words " * 9, "x" * 400):
        places = grams.places(text)
        starts = max((len(p) for p in places), default=0)
        sums = [sum(weights[p[at:at + 20]].sum() for p in places) for at in range(max(1, starts - 19))]
        at, weight = toxicity.worst(places, weights, 20)
        assert weight == pytest.approx(max(sums)) and sums[at] == pytest.approx(max(sums))


def test_held_out_labels_are_not_looked_at(tables, toxic_model):
    docs, labels = tables
    other = labels.withColumn("toxic", F.when(features.remainder("doc_id") == 1, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.fit(docs, other)
    assert again.bias == toxic_model.bias and (again.weights == toxic_model.weights).all()


def test_only_the_text_counts(spark, tmp_path, toxic_model):
    texts = [*TEXTS, "you stupid worthless idiot, pathetic loser"]
    docs = documents(spark, texts, folder=tmp_path)
    rows = plain(toxicity.scores(docs, toxic_model))
    assert len(rows) == len(texts) and rows[0][1] == rows[1][1] and rows[-1][2] == 1
    grams = features.CharGrams(toxicity.ORDERS, toxicity.BITS)
    assert [r[1] for r in rows] == [toxic_model.score(grams.places(t or "")) for t in texts]
    kept = toxicity.without_toxic(docs, toxic_model)
    assert kept.columns == docs.columns and kept.count() == sum(not r[2] for r in rows)
    none = documents(spark, [], folder=tmp_path)
    assert toxicity.scores(none, toxic_model).count() == toxicity.without_toxic(none, toxic_model).count() == 0


def test_without_labels(spark, tmp_path):
    docs = documents(spark, ["a", "b", None], folder=tmp_path)
    labels = spark.createDataFrame([(0, None, None), (None, 1, 1)], "doc_id bigint, quality int, toxic int")
    assert {r.score for r in toxicity.scores(docs, toxicity.fit(docs, labels)).collect()} == {0.5}
    assert {(r.expected_grade, r.tail) for r in quality.graded(docs, quality.fit(docs, labels)).collect()} == {(0.0, 1.0)}
    one = spark.createDataFrame([(n, 1, 0) for n in range(3)] * 2, "doc_id bigint, quality int, toxic int")
    assert all(r.predicted == 0 for r in toxicity.scores(docs, toxicity.fit(docs, one)).collect())


def test_grams_are_those_of_the_text():
    grams = features.CharGrams((3, 4), 20)
    found = grams("AbcA")
    assert len(found) == len(set(found.tolist())) == 7  # " ab" "abc" "bca" "ca " and three of four
    assert set(grams("abca").tolist()) == set(found.tolist())
    assert len(grams("")) == 0


def test_low_quality_of_the_held_out_fold(tables, quality_model):
    docs, labels = tables
    rows = held_out(quality.graded(docs, quality_model), labels)
    low, good = [r for r in rows if r.quality == 0], [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(r.selected for r in low) <= 0.1 * len(low) and sum(r.selected for r in good) >= 0.9 * len(good)
    assert max(r.expected_grade for r in low) < np.median([r.expected_grade for r in good])
    assert (np.diff(quality_model.thresholds) > 0).all()
    assert all(0 <= r.expected_grade <= 2 and r.selected == (r.tail >= 0.5) for r in rows)


def test_grades_are_told_apart_on_the_held_out_fold(spark):
    """Neighbouring grades have different means, and most good but toxic texts are not selected; some labels are wrong."""
    docs, labels = [spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels")]
    model = quality.fit(docs, labels, toxic=toxicity.fit(docs, labels))
    rows = held_out(quality.graded(docs, model), labels.withColumn("grade", quality.grade()))
    means = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in (0, 1, 2)]
    taken = [np.mean([r.selected for r in rows if r.grade == g]) for g in (0, 1, 2)]
    print("means", means, "selected", taken)
    assert means[0] + 0.5 < means[1] and means[1] + 0.3 < means[2]
    assert taken[0] < 0.05 and taken[1] < 0.5 and taken[2] > 0.95


def test_grades_any_text_with_toxicity(spark, tmp_path, tables, toxic_model):
    docs = documents(spark, folder=tmp_path)
    model = quality.fit(*tables, toxic=toxic_model)
    rows, features_of = plain(quality.graded(docs, model)), quality.Features(toxic_model)
    assert [r[2] for r in rows] == [float(model.above(features_of(t or ""))[-1]) for t in TEXTS]
    assert quality.selected(docs, model).count() == sum(r[3] for r in rows)
    assert quality.graded(documents(spark, [], folder=tmp_path), model).count() == 0


def test_grades_any_text(spark, tmp_path, quality_model):
    docs = documents(spark, folder=tmp_path)
    rows = plain(quality.graded(docs, quality_model))
    assert len(rows) == len(TEXTS) and rows[0][1:] == rows[1][1:]
    kept = quality.selected(docs, quality_model)
    assert kept.columns == docs.columns and kept.count() == sum(r[3] for r in rows)
    assert quality.graded(documents(spark, [], folder=tmp_path), quality_model).count() == 0
    every = quality.graded(docs, quality_model, level=0)
    assert {r.tail for r in every.collect()} == {1.0}


def test_ordinal_slopes_and_order():
    """The fit finds the order of grades from one feature, and its thresholds."""
    pick = np.random.default_rng(0)
    x = pick.normal(size=3000)
    y = np.digitize(3 * x + pick.logistic(size=3000), [-2.0, 0.5, 2.5])
    rows = [(np.array([0]), np.array([v])) for v in x]
    weights, thresholds = quality._ordinal(rows, y, (0, 1, 2, 3), 1, 600, 0.0)
    assert abs(weights[0] - 3) < 0.3 and np.abs(thresholds - [-2.0, 0.5, 2.5]).max() < 0.3


def test_sample_takes_one_text_an_id_and_no_more_labels_than_it_can(spark, tmp_path):
    ids = [k for k in range(200) if zlib.crc32(str(k).encode()) % 3 != 1]
    docs = documents(spark, [f"text {k} {n}" for k in ids[:5] for n in range(50)], [k for k in ids[:5] for _ in range(50)], tmp_path)
    labels = spark.createDataFrame([(k, k % 2) for k in ids[:5]], "doc_id bigint, y int")
    found = list(features.sample(docs, labels, F.col("y"), "doc_id", "text", 1, 3))
    assert sorted(int(t.split()[1]) for t, _ in found) == ids[:5] and all(int(t.split()[1]) % 2 == y for t, y in found)
    assert found == list(features.sample(docs.repartition(7), labels, F.col("y"), "doc_id", "text", 1, 3))
    many = spark.createDataFrame([(k, k) for k in ids[:101]], "doc_id bigint, y int")
    with pytest.raises(ValueError):
        list(features.sample(docs, many, F.col("y"), "doc_id", "text", 1, 3))
