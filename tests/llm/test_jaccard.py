import random

import numpy as np
import pytest

from cases import TEXTS, documents, plain
from martbrook.llm import jaccard as ja
from martbrook.llm.components import components


def brute(rows, join):
    sets = [ja.shingles(t or "", join.words) for _, t in rows]
    top = list(range(len(rows)))

    def of(x):
        while top[x] != x:
            x = top[x]
        return x

    for x in range(len(rows)):
        for y in range(x):
            a, b = sets[x], sets[y]
            both = len(a & b)
            if a and b and 100 * both >= join.percent * (len(a) + len(b) - both):
                top[of(x)] = of(y)
    least = {}
    for x, (i, _) in enumerate(rows):
        least[of(x)] = min(least.get(of(x), i), i)
    return sorted((i, len(sets[x]), least[of(x)]) for x, (i, _) in enumerate(rows))


def all_of_weight_two(bands):
    return [ja.Band(b.number, b.first, b.last, max(0, b.worth - 2 * ((b.worth + 1) // 2)), (b.worth + 1) // 2) for b in bands]


def mixed_weights(bands):
    return [ja.Band(b.number, b.first, b.last, b.worth - 2 * (b.worth // 3), b.worth // 3) for b in bands]


@pytest.mark.parametrize("percent", [50, 70, 80, 85, 95])
@pytest.mark.parametrize("change", [list, all_of_weight_two, mixed_weights])
def test_linked_sets_share_an_entry(percent, change):
    join, pick = ja.Join(percent=percent), np.random.default_rng(percent)
    limits = ja.band_limits(join, 2000)
    bands = change([ja.allocate(join, n, a, b - 1, 10) for n, (a, b) in enumerate(zip(limits, limits[1:]))])
    linked = 0
    for _ in range(1500):
        n = int(pick.integers(1, 60)) if pick.random() < 0.8 else int(pick.integers(60, 500))
        base = pick.integers(0, 2 ** 63, n, dtype=np.uint64)
        apart = int(pick.integers(0, join.apart_from_any(n) + 1))
        drop = int(pick.integers(0, min(n - 1, apart) + 1))
        a, b = np.unique(base), np.unique(np.concatenate([base[drop:], pick.integers(0, 2 ** 63, apart - drop, dtype=np.uint64)]))
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            linked += 1
            often = lambda x: x % np.uint64(5) == 0
            of = [np.concatenate([k for k, _ in ja.of_set(join, bands, x, often(x))]) for x in (a, b)]
            assert len(np.intersect1d(*of))
    assert linked > 500


def test_cost_turns_to_neighbourhoods_where_sets_are_many():
    join = ja.Join()
    assert ja.allocate(join, 5, 9, 12, 100).twos == 0
    assert ja.allocate(join, 5, 9, 12, 10 ** 9).twos > 0


def test_shared_entries_over_batches(spark):
    rows = [(1, 1, 5, True), (2, 1, 5, True), (2, 1, 5, True), (3, 1, 5, True), (3, 2, 5, False), (3, 2, 5, False), (4, 1, 5, True), (4, 1, 6, True)]
    rows += [(9, n % 50, 5, True) for n in range(100)] + [(10, 7, 7, True)] * 40
    schema = "entry bigint, hash bigint, size int, own boolean"
    size = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(size)
    try:
        for most in (1, 2, 3, 7, 10000):
            spark.conf.set(size, most)
            found = plain(ja.shared_entries(spark.createDataFrame(rows, schema)))
            want = [(3, 1, 5, True), (3, 2, 5, False), (4, 1, 5, True), (4, 1, 6, True)] + [(9, n, 5, True) for n in range(50)]
            assert sorted(set(found)) == sorted(want) and len(found) == len(want)
    finally:
        spark.conf.set(size, before)


def test_components(spark):
    pick = random.Random(1)
    links = [(pick.randint(0, 300), pick.randint(0, 300)) for _ in range(160)] + [(1000 + n, 1001 + n) for n in range(60)] + [(5, 5), (None, 3)]
    links += [(2000, 2001 + n) for n in range(200)]
    top = {}

    def of(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            top[max(of(a), of(b))] = min(of(a), of(b))
    want = sorted((x, of(x)) for x in list(top))
    assert plain(components(spark.createDataFrame(links, "a bigint, b bigint")), "node", "least") == want


def rows_of_all_kinds():
    pick = random.Random(3)
    small = [" ".join(pick.choice("a b c d e".split()) for _ in range(pick.randint(0, 9))) for _ in range(150)]
    base = [f"{pick.choice('abcdefgh')}{pick.randint(0, 50)}" for _ in range(150)]
    near = []
    for _ in range(120):  # a group of near copies, not all of which are linked to each other
        words = list(base)
        for _ in range(pick.randint(0, 6)):
            words[pick.randrange(150)] = str(pick.random())
        near.append(" ".join(words))
    passage = " ".join(base[:60])
    shared = [passage + " " + " ".join(str(pick.random()) for _ in range(pick.choice([10, 20, 90]))) for _ in range(60)]
    return [(100 + n, t) for n, t in enumerate([*TEXTS, *small, *near, *shared, *near[:20]])]


@pytest.mark.parametrize("join", [ja.Join(), ja.Join(words=5, percent=80)])
def test_against_brute_force(spark, tmp_path, join):
    rows = rows_of_all_kinds()
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], tmp_path)
    want = brute(rows, join)
    assert plain(ja.similar_documents(docs, join), "doc_id", "n_shingles", "component_id") == want
    kept = ja.one_of_each(docs, join)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _, c in want if i == c]


def test_pairwise_rest_is_enough_alone(spark, tmp_path, monkeypatch):
    """Without rounds to centres that link anything, pairs across components find all."""
    monkeypatch.setattr(ja, "HARDLY", 0.0)  # one round more, at most, and then the rest
    rows = rows_of_all_kinds()[100:260]
    docs = documents(spark, [t for _, t in rows], [i for i, _ in rows], tmp_path)
    assert plain(ja.similar_documents(docs), "doc_id", "n_shingles", "component_id") == brute(rows, ja.Join())


def test_repeated_rows_null_ids_and_empty_tables(spark, tmp_path):
    text = "a b c d e f g h"
    docs = documents(spark, [text, text, text + " ", None, "x y z w v"], [7, 7, None, 2, 7], tmp_path)
    assert plain(ja.similar_documents(docs)) == [(None, 5, None), (2, 0, 2), (7, 2, 7), (7, 5, None), (7, 5, None)]
    none = documents(spark, [], folder=tmp_path)
    assert ja.similar_documents(none).count() == 0 and ja.one_of_each(none).count() == 0


def test_texts_of_sets_take_one_python_worker_a_task(spark, tmp_path):
    texts = ["a b c", "d e f", None, "g h i", "a b c"]
    docs = documents(spark, texts, [3, 1, 2, None, 4], tmp_path)
    join = ja.Join(words=2)
    sets = ja.document_sets(docs, join, "doc_id", "text").filter("size IS NOT NULL").select("doc_id", "hash", "size").cache()
    shared = sets.filter("size > 0 AND (doc_id IS NULL OR doc_id != 1)").selectExpr("struct(hash, size) AS set")
    found = ja._texts(docs, join, sets, shared, "doc_id", "text")
    assert sorted(r.text for r in found.collect()) == ["a b c", "g h i"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan
    sets.unpersist()
