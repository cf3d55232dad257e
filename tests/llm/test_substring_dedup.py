import hashlib
import itertools
import random
import re

import fixtures as X
import pytest

from hydrolens.llm import substring_dedup as S
from hydrolens.llm import shingles
from hydrolens.sources.folders import RunFolder


def brute(rows, window=13):
    last = 2**63 - 1
    words = [(last if i is None else i, X.space_words(t)) for i, t in rows]
    first = {}
    for i, w in words:
        for s in range(len(w) - window + 1):
            key = tuple(w[s : s + window])
            first[key] = min(first.get(key, last), i)
    out = []
    for (i, w), (name, _) in zip(words, rows):
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s : s + window])] < i:
                gone |= set(range(s, s + window))
        out.append((name, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def result(docs, **more):
    return sorted(map(tuple, S.remove_repeats(docs, RunFolder(docs.sparkSession), **more).collect()), key=str)


def texts():
    rng = random.Random(8)
    passages = [X.sentence(rng, n, 900) for n in (12, 13, 14, 20, 60)]
    found = X.awkward_texts()
    for _ in range(40):
        parts = [X.sentence(rng, rng.randrange(0, 25), 900) for _ in range(3)]
        found.append("  ".join([parts[0], rng.choice(passages), parts[1], rng.choice(passages), parts[2]]) + "\n")
    return found + [p.lower() for p in passages]


@pytest.mark.parametrize("chars", [300, 8_000_000])
def test_equals_brute_force(spark, monkeypatch, chars):
    monkeypatch.setattr(shingles, "PIECE_CHARS", chars)
    docs = X.documents(spark, texts(), extra=True)
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("window", [2, 5, 30])
def test_other_windows_small_vocabulary(spark, window):
    rng = random.Random(window)
    docs = spark.createDataFrame([(rng.randrange(40), " ".join(rng.choices("ab", k=rng.randrange(60)))) for _ in range(40)], "doc_id long, text string")
    assert result(docs, window=window) == brute([(r.doc_id, r.text) for r in docs.collect()], window)


def test_null_and_repeated_ids_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(None, text), (None, text + " x"), (5, text), (5, text), (4, None), (7, "y " + text)], "doc_id long, text string")
    assert result(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert result(docs.limit(0)) == [] and result(docs.where("text is null")) == [(4, 0, 0, "")]


def test_query(spark, tmp_path):
    docs = X.documents(spark, texts())
    rows = S.document_passages(spark, X.folder_of(tmp_path, documents=docs)).collect()
    wanted = [(i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute([(r.doc_id, r.text) for r in docs.collect()])]
    assert sorted(map(tuple, rows)) == sorted(wanted)


def test_covers():
    for period, cover in S.COVERS.items():
        assert {(a - b) % period for a, b in itertools.product(cover, cover)} == set(range(period))
    for window in range(1, 200):
        period, _ = S.cover_of(window)
        assert window - period + 1 >= window / 2


def test_texts_do_not_move(spark):
    docs = X.documents(spark, texts())
    plan = S.remove_repeats(docs, RunFolder(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(block[^\n]*\n[^\n]*texts", plan) and "Bucketed: true" in plan
