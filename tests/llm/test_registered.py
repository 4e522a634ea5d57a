"""The registered queries against their SQL, and the pipeline against its stages done plainly."""

import hashlib

import public_tokenizers
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from cases import TEXTS, documents
from compare import difference, duck
from martbrook.llm import bpe, jaccard, toxicity
from martbrook.llm.oracles import ORACLES
from martbrook.llm.queries import QUERIES
from test_decontaminate import brute as hits
from test_jaccard import brute as near

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, connection, name):
    assert difference(entry.queries()[name](spark, FOLDER), connection, ORACLES[name]) is None


def test_every_operator_has_a_query():
    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_one_row_a_document(spark, name):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    found = QUERIES[name](spark, FOLDER)
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == sorted(r.doc_id for r in docs.select("doc_id").collect())


def plainly(rows, items):
    """Token ids of what is left of texts that are not toxic, by brute force."""
    last = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        last["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")] = i
    rows = [(i, t) for i, t in rows if i in last.values()]
    least = {i: c for i, _, c in near(rows, jaccard.Join(words=5, percent=80))}
    rows = [(i, t) for i, t in rows if least[i] == i]
    clean = {r[0] for r in hits(rows, items) if not r[2]}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks=bpe.read_ranks(
        None, public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return {i: library.encode_ordinary(t or "") for i, t in rows if i in clean}


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    calm = {r.doc_id for r in toxicity.scores(docs, model).filter("predicted = 0").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in calm]
    assert 0 < len(rows) < docs.count()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert {i: r.ids for i, r in found.items()} == plainly(rows, items)
    texts = dict(rows)
    assert all(r.decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest() for i, r in found.items())


def folder_of(spark, docs, folder):
    """A folder of tables: these documents, a benchmark, labels of two texts only, none of them toxic."""
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([("i1", "a b c d e f g h i j"), ("i2", None), (None, "")], "item_id string, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(3, 1, 0), (6, None, None), (None, 1, 1), (3, 1, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def test_pipeline_on_awkward_documents(spark, tmp_path):
    """Null, empty, long and repeated texts, a null id, other columns with clashing names, hardly any labels."""
    texts = [*TEXTS, "alone without an id"]
    docs = documents(spark, texts, [*range(len(TEXTS)), None], tmp_path)
    folder = folder_of(spark, docs, tmp_path / "tables")
    found = [(r.doc_id, r.ids) for r in corpus_pipeline.run(spark, folder).collect()]
    want = plainly(list(enumerate(TEXTS)), [("i1", "a b c d e f g h i j"), ("i2", None), (None, "")])
    assert {i: ids for i, ids in found if i is not None} == want and len(found) == len(want) + 1
    assert 0 in want or 1 in want  # one of the null and the empty text


def test_pipeline_without_documents(spark, tmp_path):
    folder = folder_of(spark, documents(spark, [], folder=tmp_path), tmp_path / "tables")
    assert corpus_pipeline.run(spark, folder).collect() == []


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).schema.names == docs.schema.names
