"""Merkle manifests against trees built plainly, for several arities and block sizes, and awkward rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cases import CLASHING, LONG, documents, plain
from martbrook.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(*values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(leaves, arity):
    """Root, and per leaf the (before, after) digests of its siblings upwards."""
    paths, level, under = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        parents, spans = [], []
        for at in range(0, len(level), arity):
            run = level[at:at + arity]
            for k, members in enumerate(under[at:at + arity]):
                for i in members:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            parents.append(sha("".join(run)))
            spans.append(sum(under[at:at + arity], []))
        level, under = parents, spans
    return level[0], paths


def brute(rows, arity=2):
    """doc_id, leaf, subroot, root, path of (doc_id, group, text) rows."""
    order = lambda value: (value is not None, value if value is not None else 0)
    groups = {}
    for i, group, text in rows:
        groups.setdefault(group, []).append((order(i), plain_leaf(i, group, text), i))
    names = sorted(groups, key=lambda g: b"" if g is None else b"=" + g.encode())
    trees = [plain_tree([leaf for _, leaf, _ in sorted(groups[g])], arity) for g in names]
    root, above = plain_tree([t[0] for t in trees], arity)
    return sorted([(i, leaf, subroot, root, path + above[k]) for k, (g, (subroot, paths)) in enumerate(zip(names, trees))
                   for (_, leaf, i), path in zip(sorted(groups[g]), paths)], key=str)


def stored(spark, rows, folder):
    frame = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    frame.withColumns({n: F.lit(n) for n in (*CLASHING, "grp", "pos", "n", "path", "root", "leaf", "block", "place", "up", "name")}).repartition(
        5).write.parquet(f"{folder}/rows")
    return spark.read.parquet(f"{folder}/rows")


def found_rows(docs, **sizes):
    found = merkle.manifest(docs, ("doc_id", "lang", "text"), "lang", **sizes)
    return sorted([(r.doc_id, r.leaf, r.subroot, r.root, [tuple(s) for s in r.path]) for r in found.collect()], key=str)


@pytest.mark.parametrize("arity,levels", [(2, 10), (2, 2), (3, 2), (5, 1)])
def test_trees(spark, tmp_path, arity, levels):
    rows = [(n, ("a", "b", None, "ü", "é")[0 if n % 3 else n // 3 % 5], f"text {n}") for n in range(157)]
    docs = stored(spark, rows, tmp_path)
    assert found_rows(docs, arity=arity, levels=levels) == brute(rows, arity)


def test_awkward_rows(spark, tmp_path):
    rows = [(1, None, None), (1, None, None), (None, "", "x"), (None, "", "y"), (2, "only", LONG), (3, "", ""), (3, "", "a"),
            (3, "", "a"), (4, "Z", "é"), (5, "a", "1:a"), (-6, "a", "中")]
    docs = stored(spark, rows, tmp_path)
    assert found_rows(docs) == brute(rows)
    assert merkle.manifest(docs.limit(0), ("doc_id", "lang", "text"), "lang").count() == 0
    alone = docs.filter("lang = 'only'")
    (row,) = merkle.manifest(alone, ("doc_id", "lang", "text"), "lang").collect()
    assert row.path == [] and row.leaf == row.subroot == row.root


def test_tampering_shows(spark, tmp_path):
    rows = [(n, "ab"[n % 2], f"text {n}") for n in range(60)]
    changed = F.when(F.col("doc_id") % 10 == 3, merkle.leaf(F.col("doc_id"), F.col("lang"), F.concat("text", F.lit("!"))))
    found = merkle.manifest(stored(spark, rows, tmp_path), ("doc_id", "lang", "text"), "lang", changed=changed)
    checked = merkle.verified(found.withColumn("candidate", F.coalesce("changed", "leaf")), "candidate")
    assert plain(checked.filter("NOT verified"), "doc_id") == [(n,) for n in range(3, 60, 10)]
    (row,) = checked.filter("doc_id = 7").select("path", merkle.proof(F.col("path")).alias("proof")).collect()
    assert row.proof == sha("".join(s.before + s.after for s in row.path))


def test_large_groups_are_spread(spark, tmp_path):
    """No task has much more than its share of the rows of a group, whatever the number of groups."""
    rows = documents(spark, [f"t{n}" for n in range(4000)], folder=tmp_path).select(
        F.lit("g").alias("grp"), "doc_id", F.sha2("text", 256).alias("hash"))
    rows.write.parquet(f"{tmp_path}/nodes")
    placed = merkle.numbered(spark.read.parquet(f"{tmp_path}/nodes"), ["doc_id"])
    assert plain(placed, "doc_id", "pos") == [(n, n) for n in range(4000)]
    block = merkle.climb(placed, 2, 5).groupBy("block").count()
    assert block.agg(F.max("count")).first()[0] == 32
