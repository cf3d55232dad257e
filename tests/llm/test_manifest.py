import hashlib
import random

import fixtures as X
import pytest
from oracle_check import connect, differences
from pyspark.sql import functions as F

from hydrolens.llm import manifest as M
from hydrolens.sources.folders import RunFolder


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def coded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h(*[coded(v) for v in (row.doc_id, row.source, row.lang, row.n_chars, text)])


def up(nodes):
    """Levels from the leaves to the one that remains."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 16]) for i in range(0, len(last), 16)])
    return levels


def siblings(levels, place):
    for nodes in levels[:-1]:
        first = place // 16 * 16
        yield nodes[first:place], nodes[place + 1 : first + 16]
        place //= 16


def brute(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    inner = {}
    for s in sources:
        own = sorted((r for r in rows if r.source == s), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        inner[s] = own, up([leaf(r, r.text) for r in own])
    upper = up([inner[s][1][-1][0] for s in sources])
    out = []
    for number, s in enumerate(sources):
        own, levels = inner[s]
        for place, r in enumerate(own):
            tampered = r.doc_id is not None and X.fold(r.doc_id, 5) == 0 and r.text is not None
            node, gathered = leaf(r, X.ascii_lower(r.text) if tampered else r.text), []
            for before, after in [*siblings(levels, place), *siblings(upper, number)]:
                node = h(*before, node, *after)
                gathered += before + after
            root = upper[-1][0]
            out.append((r.doc_id, levels[0][place], levels[-1][0], root, h(*gathered), node, node == root))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def many(spark, sizes, texts=("Aa b", "c", None, "")):
    rows = [(i, texts[i % len(texts)], None, s, i % 3 or None) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, X.DOCUMENTS)


def test_awkward_documents(spark, tmp_path):
    docs = X.documents(spark, X.awkward_texts() + ["Z" * 3_000_000], extra=True)
    docs = docs.withColumn("digest", F.lit("x")).withColumn("presented", F.lit("x")).withColumn("tree", F.lit(1))
    result = M.document_proofs(spark, X.folder_of(tmp_path, documents=docs))
    wanted = brute(docs.collect())
    assert rows_of(result) == wanted
    assert {w[6] for w in wanted} == {True, False}
    assert result.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 16}, {"a": 17}, {None: 257, "a": 1, "é": 40, "Z": 16, "b": 300}, {f"s{i}": 1 + i % 3 for i in range(290)}])
def test_depths(spark, tmp_path, sizes):
    docs = many(spark, sizes)
    folder = X.folder_of(tmp_path, documents=docs)
    result = M.document_proofs(spark, folder)
    assert rows_of(result) == brute(docs.collect())
    assert differences(result, connect(folder), M.PROOFS_SQL) == ""


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(M, "small", lambda df: df)
    docs = many(spark, {"a": 40, None: 20, "b": 1})
    assert rows_of(M.verified_documents(docs, RunFolder(spark))) == brute(docs.collect())


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(7, "Same", "en", "s", 4)] * 40 + [(None, "A", None, None, None), (None, "B", None, None, None), (None, None, None, "s", None)]
    docs = spark.createDataFrame(rows, X.DOCUMENTS)
    assert rows_of(M.verified_documents(docs, RunFolder(spark))) == brute(docs.collect())
    assert M.verified_documents(docs.limit(0), RunFolder(spark)).collect() == []


def test_some_requests_visit_some_nodes(spark):
    """Proofs of chosen leaves only; records are found by digest, and there is one per inner node."""
    docs = many(spark, {"a": 300, "b": 20, "c": 1})
    leaves = docs.select("doc_id", "source", M.leaf_digest(F.col("text")).alias("digest"))
    manifest = M.write(leaves, "doc_id", "source", RunFolder(spark))
    asked = manifest.leaves.where("doc_id in (0, 17, 299, 310, 320)")
    got = manifest.proofs(asked).select("doc_id", "leaf", "subroot", M.proof(F.col("path")).alias("p"))
    wanted = {w[0]: (w[1], w[2], w[4]) for w in brute(docs.collect())}
    assert {r.doc_id: (r.leaf, r.subroot, r.p) for r in got.collect()} == {i: wanted[i] for i in (0, 17, 299, 310, 320)}
    last = M.descend(manifest.inner, manifest.inner.tops.withColumn("path", F.array().cast("array<struct<before:string,after:string>>")), asked.select("tree", "place"))
    assert last.count() == 5  # three records of a, one of b and the lone leaf of c
    assert [r.count() for r in manifest.inner.records] == [19 + 2, 2 + 1, 1]


def test_a_changed_record_is_noticed(spark):
    docs = many(spark, {"a": 20})
    leaves = docs.select("doc_id", "source", M.leaf_digest(F.col("text")).alias("digest"))
    manifest = M.write(leaves, "doc_id", "source", RunFolder(spark))
    (level1, level2) = manifest.inner.records
    swapped = level1.withColumn("children", F.reverse("children"))
    manifest.inner.records = [swapped, level2]
    folded = manifest.proofs().select(M.folded(F.col("leaf"), F.col("path")).alias("root"))
    assert manifest.root not in {r.root for r in folded.collect()}
