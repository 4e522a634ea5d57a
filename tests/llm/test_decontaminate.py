import random

import pytest
from pyspark.sql import functions as F

from cases import documents, plain
from martbrook.llm import decontaminate as dc

SCHEMA = "item_id bigint, text string"


def words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [(m.group(), m.span()) for m in dc.WORD.finditer(lowered)]


def brute(docs, items, n=10):
    windows = set()
    for item, text in items:
        w = [x for x, _ in words(text)]
        windows |= {(tuple(w[k:k + n]), str(item) if item is not None else "") for k in range(max(1, len(w) - n + 1)) if w}
    out = []
    for i, text in docs:
        found = words(text)
        w, hit, seen = [x for x, _ in found], set(), set()
        for key, item in windows:
            for k in range(len(w) - len(key) + 1):
                if tuple(w[k:k + len(key)]) == key:
                    hit |= set(range(k, k + len(key)))
                    seen.add(item)
        spans = [(found[k][1][0], next(found[j][1][1] for j in range(k, len(w)) if j + 1 not in hit)) for k in sorted(hit) if k - 1 not in hit]
        out.append((i, len(w), len(hit), sorted(seen), spans))
    return sorted(out)


def result(frame):
    return sorted((r.doc_id, r.n_words, r.n_hit, r.item_ids, [tuple(s) for s in r.spans]) for r in frame.collect())


@pytest.fixture
def rows():
    pick = random.Random(5)
    vocabulary = "alpha beta Gamma ünder 42 σ".split()
    text = lambda n: "".join(pick.choice(vocabulary) + pick.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, text(pick.choice([1, 3, 4, 9, 10, 14]))) for k in range(8)] + [(3, text(12)), (None, text(11)), (9, None), (10, " .,"), (11, "")]
    docs = [(k, text(pick.randint(0, 60))) for k in range(40)]
    docs += [(100 + k, f"XX {text(3)} {t} YY {t}, ZZ") for k, (_, t) in enumerate(items) if t]
    return docs + [(200, None), (201, ""), (202, " \n"), (203, "q" * 5000)], items


@pytest.mark.parametrize("block_bytes", [10 ** 6, 60])
def test_against_brute_force(spark, tmp_path, rows, block_bytes):
    docs, items = rows
    frame = documents(spark, [t for _, t in docs], [i for i, _ in docs], tmp_path)
    found = dc.benchmark_hits(frame, spark.createDataFrame(items, SCHEMA), window=4, block_bytes=block_bytes)
    assert result(found) == brute(docs, items, 4)
    kept = dc.decontaminated(frame, spark.createDataFrame(items, SCHEMA), window=4, block_bytes=block_bytes)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id for r in kept.collect()) == [r[0] for r in brute(docs, items, 4) if not r[2]]


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], SCHEMA)
    docs = documents(spark, ["a b", None], folder=tmp_path)
    assert plain(dc.benchmark_hits(docs, none), "doc_id", "n_words", "n_hit") == [(0, 2, 0), (1, 0, 0)]
    assert dc.benchmark_hits(documents(spark, [], folder=tmp_path), none).count() == 0
    assert dc.decontaminated(docs, none).count() == 2


def test_repeated_rows_and_clashing_columns_of_items(spark, tmp_path):
    docs = documents(spark, ["a b c", "a b c"], [7, 7], tmp_path)
    items = spark.createDataFrame([(1, "B c"), (1, "B c")], SCHEMA).withColumns({"n_hit": F.lit(1), "doc_id": F.lit(2)})
    assert result(dc.benchmark_hits(docs, items)) == [(7, 3, 2, ["1"], [(2, 5)])] * 2


@pytest.mark.parametrize("block_bytes", [10 ** 6, 60])
def test_null_and_repeated_ids(spark, tmp_path, rows, block_bytes):
    _, items = rows
    texts = [t for _, t in items if t] + ["no hit in here", None, "", "σ"]
    ids = [None if k % 3 == 0 else k % 2 for k in range(2 * len(texts))]
    docs = list(zip(ids, texts + texts[::-1]))
    frame = documents(spark, [t for _, t in docs], ids, tmp_path)
    found = dc.benchmark_hits(frame, spark.createDataFrame(items, SCHEMA), window=4, block_bytes=block_bytes)
    plain_rows = [(r.doc_id, r.n_words, r.n_hit, r.item_ids, [tuple(s) for s in r.spans]) for r in found.collect()]
    assert sorted(map(repr, plain_rows)) == sorted(repr(brute([d], items, 4)[0]) for d in docs)


def test_benchmark_does_not_pass_through_the_driver(spark, tmp_path, rows, monkeypatch):
    docs, items = rows
    frame = documents(spark, [t for _, t in docs], [i for i, _ in docs], tmp_path)
    benchmark, sizes = spark.createDataFrame(items, SCHEMA), []
    collect = type(frame).collect

    def counted(self):
        out = collect(self)
        sizes.append(len(out))
        return out

    monkeypatch.setattr(type(frame), "collect", counted)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", None)
    dc.benchmark_hits(frame, benchmark, window=4)
    dc.decontaminated(frame, benchmark, window=4)
    assert max(sizes) <= 1
