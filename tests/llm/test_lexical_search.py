import math
import random
import re
from collections import Counter

import fixtures as X
import pytest
from oracle_check import connect, differences

from hydrolens.llm import lexical_search as S
from hydrolens.sources.folders import RunFolder


def terms(text):
    return [X.ascii_lower(t) for t in re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")]


def brute(docs, items, top=50):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    texts, length = len(bags), sum(n for _, _, n in bags)
    held = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item_id, text in items:
        asked = {t: math.floor(1000 * math.log((2 * texts + 2) / (2 * held[t] + 1))) for t in set(terms(text)) if held[t]}
        found = []
        for doc_id, bag, n in bags:
            m = 50 + (50 * n * texts) // length
            score = sum(w * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m)) for t, w in asked.items() if t in bag)
            if score > 0:
                found.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(found)[:top], 1):
            out.append((item_id, rank, None if none else doc_id, -score))
    return sorted(out, key=str)


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def cases(seed=1, n=150):
    rng = random.Random(seed)
    base = X.sentence(rng, 80, 40)
    shuffled = base.split()
    rng.shuffle(shuffled)
    texts = X.awkward_texts() + [X.sentence(rng, rng.randrange(1, 60), 40) for _ in range(n)]
    # Exact copies, copies with the same bag in another order or with other words outside the items.
    texts += [base] * 70 + [" ".join(shuffled)] * 10 + [base + " zzz", base + " yyy"] * 30
    items = [(1, base), (2, X.sentence(rng, 15, 40)), (3, None), (4, ""), (5, "W1"), (5, "w1 W1"), (None, "W2 w3"), (6, "never"), (7, "niño Él 日本語"), (8, X.sentence(rng, 400, 60)), (9, "?!")]
    return texts, items


@pytest.mark.parametrize("hot", [10_000, 20])
def test_equals_brute_force(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT", hot)
    texts, items = cases()
    docs = X.documents(spark, texts, extra=True).repartition(7)
    folder = X.folder_of(tmp_path, documents=docs, benchmark=items_of(spark, items).selectExpr("*", "1 as item", "2 as terms", "'x' as doc_id"))
    result = S.benchmark_documents(spark, folder)
    assert rows_of(result) == brute([(r.doc_id, r.text) for r in docs.collect()], items)
    assert differences(result, connect(folder), S.SEARCH_SQL) == ""
    assert result.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]


def test_small_steps_and_many_passes(spark, monkeypatch):
    """One item per pass, a few sums per step, few results, no broadcasts."""
    monkeypatch.setattr(S, "CHUNK_ITEMS", 3)
    monkeypatch.setattr(S, "CHUNK_ENTRIES", 20)
    monkeypatch.setattr(S, "SUMS", 50)
    monkeypatch.setattr(S, "small", lambda df: df)
    texts, items = cases(2, 60)
    docs = X.documents(spark, texts)
    got = rows_of(S.search(docs, items_of(spark, items), RunFolder(spark), top=4))
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()], items, 4)


def test_a_class_is_scored_once(spark):
    texts, items = cases(3)
    docs = [(i, t) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    run = RunFolder(spark)
    (chunk,) = S.chunks(S.item_terms(items_of(spark, items), run))
    queries = S.Queries.of(chunk)
    bags = frame.mapInArrow(S._bags(queries.vocabulary), S.BAG)
    known = bags.where("size(ids) > 0").withColumnRenamed("n", "m")
    classes = S.classes_of(known, 5).collect()
    wanted = {}
    for i, t in docs:
        own = terms(t)
        bag = frozenset((k, n) for k, n in Counter(own).items() if k.encode() in queries.vocabulary)
        if bag:
            wanted.setdefault((len(own), bag), []).append(i)
    assert sorted(r.members for r in classes) == sorted(sorted(v)[:5] for v in wanted.values())
    assert max(len(v) for v in wanted.values()) == 80


def test_repeated_rows_null_ids_and_empty(spark):
    items = items_of(spark, [(1, "a b")])
    docs = [(None, "a"), (None, "a b"), (3, "b A"), (3, "b A"), (4, "c"), (5, None), (6, "b")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(S.search(frame, items, RunFolder(spark))) == brute(docs, [(1, "a b")])
    empty = S.search(frame.limit(0), items, RunFolder(spark))
    assert empty.collect() == [] and empty.columns == ["item_id", "rank", "doc_id", "score"]
    assert S.search(frame, items.limit(0), RunFolder(spark)).collect() == []
    assert S.search(frame.where("text is null"), items, RunFolder(spark)).collect() == []


def test_one_very_long_text(spark):
    docs = [(1, "aa bb " * 1_500_000), (2, "aa cc"), (3, "dd")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert rows_of(S.search(frame, items_of(spark, [(1, "aa bb cc")]), RunFolder(spark))) == brute(docs, [(1, "aa bb cc")])
