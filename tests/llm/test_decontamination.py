import hashlib
import random
import re

import fixtures as X
import pytest

from hydrolens.llm import decontamination as D
from hydrolens.sources.folders import RunFolder


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", X.ascii_lower(text or ""))


def brute(docs, items, window=10):
    out = []
    for doc_id, text in docs:
        words, hit, ids = terms(text), set(), set()
        for item_id, passage in items:
            p = terms(passage)
            n = min(len(p), window)
            for s in range(len(p) - n + 1 if n else 0):
                for i in range(len(words) - n + 1):
                    if words[i : i + n] == p[s : s + n]:
                        hit |= set(range(i, i + n))
                        ids |= {str(item_id)} if item_id is not None else set()
        sha = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), sha, bool(hit)))
    return sorted(out, key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def cases():
    rng = random.Random(4)
    long = X.sentence(rng, 45, 60)
    docs = X.awkward_texts() + [
        "start " + long + " end", long.lower().replace(" ", ", "), " ".join(long.split()[3:14]), " ".join(long.split()[3:12]),
        "same same same", "short item!", "a Short  ITEM here", "x " * 60, long + " " + long, "niño come",
    ]
    docs += [" ".join(rng.sample(long.split(), 30)) for _ in range(10)]
    items = [(1, long), (22, "short item"), (3, None), (4, ""), (5, "niño"), (6, "same " * 12), (7, "x x x"), (8, "never there at all"),
             (10, " ".join(long.split()[5:30])), (10, "short item"), (None, long), (None, "start"), (11, X.sentence(rng, 30)), (12, "!?")]
    return docs, items


def test_equals_brute_force(spark):
    texts, items = cases()
    docs = X.documents(spark, texts, extra=True)
    rows = D.contamination(docs, items_of(spark, items), RunFolder(spark)).collect()
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert sorted(map(tuple, rows), key=str) == wanted
    assert sum(r.contaminated for r in rows) > 8


def test_random_small_vocabulary(spark):
    rng = random.Random(9)
    docs = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(60)]
    items = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(1, 9)))) for i in range(12)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = D.contamination(frame, items_of(spark, items), RunFolder(spark), window=5).collect()
    assert sorted(map(tuple, rows), key=str) == brute(docs, items, 5)


def test_without_broadcasts(spark, monkeypatch):
    monkeypatch.setattr(D, "small", lambda df: df)
    texts, items = cases()
    docs = X.documents(spark, texts)
    rows = D.contamination(docs, items_of(spark, items), RunFolder(spark)).collect()
    assert sorted(map(tuple, rows), key=str) == brute([(r.doc_id, r.text) for r in docs.collect()], items)


def test_empty_tables_and_repeated_rows(spark):
    items = items_of(spark, [(1, "a b")])
    docs = spark.createDataFrame([(1, "a"), (1, "b a b"), (None, "a b"), (None, None)], "doc_id long, text string")
    rows = D.contamination(docs, items, RunFolder(spark)).collect()
    assert sorted((str(r.doc_id), r.n_hit) for r in rows) == [("1", 0), ("1", 2), ("None", 0), ("None", 2)]
    assert [r.contaminated for r in D.contamination(docs, items.limit(0), RunFolder(spark)).collect()] == [False] * 4
    assert D.contamination(docs.limit(0), items, RunFolder(spark)).collect() == []


def test_clean_keeps_columns(spark):
    texts, items = cases()
    docs = X.documents(spark, texts, extra=True)
    docs = docs.union(docs.selectExpr("cast(null as bigint)", *[f"`{c}`" for c in docs.columns[1:]]))
    kept = D.clean(docs, items_of(spark, items), RunFolder(spark))
    assert kept.columns == docs.columns
    marks = brute([(r.text, r.text) for r in docs.collect()], items)
    assert sorted(str(r.text) for r in kept.collect()) == sorted(str(m[0]) for m in marks if not m[5])


def test_native(spark):
    texts, items = cases()
    plan = D.contamination(X.documents(spark, texts), items_of(spark, items), RunFolder(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian", plan)


@pytest.mark.parametrize("span", [3, 6])
def test_proximity(spark, span):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice("abcdef") for _ in range(rng.randrange(25)))) for i in range(40)]
    items = [(1, "a b c"), (2, "f e"), (3, "a a")]
    run = RunFolder(spark)
    postings = D.index(spark.createDataFrame(docs, "doc_id long, text string"), run)
    names = D.documents_of(postings)
    found = D.proximity(postings, D.passages(items_of(spark, items), run), run, span).join(names, "doc")
    wanted = set()
    for doc, text in docs:
        words = text.split()
        for item, passage in items:
            need = set(passage.split())
            wanted |= {(item, doc, i) for i, w in enumerate(words) if w in need and need <= set(words[i : i + span])}
    assert {(r.item_id, r.doc_id, r.first) for r in found.collect()} == wanted
