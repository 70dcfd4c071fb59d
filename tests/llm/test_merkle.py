"""Merkle manifests against brute force, on odd rows, and the query against its contract."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from shelfmatch.llm import merkle, queries


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(*values):
    return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes, fanout=8):
    """The last node, and for each leaf the digests before and after it at each level."""
    steps, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // fanout * fanout
            steps[i].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + fanout])))
            at[i] = k // fanout
        nodes = [digest(*nodes[i : i + fanout]) for i in range(0, len(nodes), fanout)]
    return nodes[0], steps


def wanted(rows, fanout=8):
    """rows: (group, order, leaf) -> (group, order, leaf, subroot, root, path) of each."""
    groups = collections.defaultdict(list)
    for g, o, leaf in rows:
        groups[g].append((o is not None, o or 0, leaf, o))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {g: tree([x[2] for x in sorted(groups[g], key=lambda x: x[:3])], fanout) for g in names}
    root, tops = tree([made[g][0] for g in names], fanout)
    out = []
    for g, top in zip(names, tops):
        for (_, _, leaf, o), path in zip(sorted(groups[g], key=lambda x: x[:3]), made[g][1]):
            out.append((g, o, leaf, made[g][0], root, tuple(path + top)))
    return out


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest_equals_brute_force(spark, fanout):
    rng = random.Random(fanout)
    sizes = {None: 9, "": 1, "a": 130, "b": 8, "ä": 65, "c": 3, "-": 2, "=": 1, "d": 7, "e": 1, "f": 64}
    rows = [(g, rng.choice([None, i, i // 3]), digest(str(rng.randrange(200)))) for g, n in sizes.items() for i in range(n)]
    rows += [rows[20]] * 40  # repeated rows are leaves each
    df = spark.createDataFrame([(*r, None, "x", 1) for r in rows], "g string, o int, leaf string, _lo int, path string, `_group` int")
    made = merkle.manifest(df.repartition(5), "leaf", ["o"], "g", fanout)
    assert made.columns == ["g", "o", "leaf", "_lo", "_group", "subroot", "root", "path"]
    got = made.withColumn("proof", merkle.proof()).withColumn("up", merkle.folded("leaf")).collect()
    key = lambda r: repr(r)
    plain = [(r.g, r.o, r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.path)) for r in got]
    assert sorted(plain, key=key) == sorted(wanted(rows, fanout), key=key)
    for r in got:
        assert r.up == r.root and r.proof == digest(*(s.left + s.right for s in r.path))


def test_a_changed_leaf_gives_another_root(spark):
    rows = [("g", i, digest(str(i))) for i in range(20)]
    df = spark.createDataFrame(rows, "g string, o int, leaf string")
    made = merkle.manifest(df, "leaf", ["o"], "g").withColumn("other", F.sha2("leaf", 256))
    got = made.select(merkle.folded("leaf").alias("same"), merkle.folded("other").alias("other"), "root").collect()
    assert all(r.same == r.root != r.other for r in got) and len({r.other for r in got}) == 20


def test_odd_tables(spark):
    df = spark.createDataFrame([(None, None, "x" * 64)], "g string, o int, leaf string")
    (one,) = merkle.manifest(df, "leaf", ["o"], "g").collect()
    assert one.subroot == one.root == "x" * 64 and one.path == []
    assert merkle.manifest(df.limit(0), "leaf", ["o"], "g").count() == 0
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "é"), (4, "x" * 100_000), (None, "a:-")], "a int, b string")
    for r in odd.withColumn("leaf", merkle.leaf_digest(F.col("a"), F.col("b"))).collect():
        assert r.leaf == leaf_of(r.a, r.b)


def test_query(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").collect()
    fields = lambda d, text: leaf_of(d.doc_id, d.source, d.lang, d.n_chars, text)
    low = lambda t: t and re.sub("[A-Z]", lambda m: m[0].lower(), t)
    want = {r[1]: r for r in wanted([(d.lang, d.doc_id, fields(d, d.text)) for d in docs])}
    got = {r.doc_id: r for r in queries.op12_merkle_manifest(spark, data).collect()}
    assert len(got) == len(docs)
    for d in docs:
        _, _, leaf, subroot, root, path = want[d.doc_id]
        up = fields(d, low(d.text)) if zlib.crc32(str(d.doc_id).encode()) % 3 == 0 else leaf
        for left, right in path:
            up = digest(left, up, right)
        proof = digest(*(a + b for a, b in path))
        assert tuple(got[d.doc_id]) == (d.doc_id, leaf, subroot, root, proof, up, up == root)
    assert {r.verified for r in got.values()} == {True, False}
