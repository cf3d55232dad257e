import hashlib
import random
import re
from collections import defaultdict

import fixtures as X
import pytest
from pyspark.sql import functions as F

from hydrolens.llm import mixing as M
from hydrolens.sources.folders import RunFolder


def weight(level, name):
    return {"domain": 3 if name == "crawl" else 2, "lang": 4 if name == "en" else 1, "source": 1}[level]


def domain(source):
    digits = re.search(r"(\d+)$", source or "")
    return "crawl" if source == "src0" else f"collection{int(digits[1]) % 4 if digits else 0}"


def share(budget, children):
    """children: name -> (weight, capacity). Fills them at one rate; full ones leave."""
    out, left = {}, dict(children)
    while left:
        rate = budget / sum(w for w, _ in left.values())
        full = [n for n, (w, can) in left.items() if can <= rate * w]
        if not full:
            return out | {n: rate * w for n, (w, _) in left.items()}
        for n in full:
            out[n] = left.pop(n)[1]
            budget -= out[n]
    return out


def brute(rows, epochs, part, seed):
    units = defaultdict(int)
    for i, text, lang, source in rows:
        if n := len(X.space_words(text)):
            units[domain(source), lang or "none", source or "none", i] += n
    leaves = defaultdict(int)
    for key, n in units.items():
        leaves[key[:3]] += n

    def capacity(path):
        return sum(n * epochs for k, n in leaves.items() if k[: len(path)] == path)

    given = {(): min(int(sum(leaves.values()) * part), capacity(()))}
    for depth, level in enumerate(M.LEVELS):
        for path in [p for p in given if len(p) == depth]:
            names = {k[depth] for k in leaves if k[:depth] == path}
            got = share(given[path], {n: (weight(level, n), capacity((*path, n))) for n in names})
            given |= {(*path, n): x for n, x in got.items()}
    out = set()
    for leaf, n in leaves.items():
        target = min(int(given[leaf] + 1e-9), n * epochs)
        for epoch in range(epochs):
            left = min(n, target - epoch * n)
            order = sorted((hashlib.md5(f"{seed}:{epoch}:{'' if k[3] is None else k[3]}".encode()).hexdigest(), k[3]) for k in units if k[:3] == leaf)
            for _, i in order:
                if left <= 0:
                    break
                size = units[(*leaf, i)]
                out.add((*leaf, i, epoch, size, min(size, left)))
                left -= size
    return out


def corpus(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        source = rng.choice(["src0"] * 5 + [f"src{k}" for k in range(1, 9)] + ["odd", None])
        rows.append((i, X.sentence(rng, rng.randrange(0, 60)) if i % 17 else None, rng.choice(["en", "en", "de", "fr", None]), source, 1))
    rows += [rows[5], rows[6], (5, "again here", rows[5][2], rows[5][3], 1), (None, "no id", "en", "src0", 1)]
    return spark.createDataFrame(rows, X.DOCUMENTS)


@pytest.mark.parametrize(("epochs", "part"), [(1, 0.5), (2, 0.9), (3, 2.2), (2, 5.0)])
def test_equals_brute_force(spark, epochs, part):
    docs = corpus(spark)
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]
    found = M.mixture(docs.withColumn("weight", F.lit("x")), RunFolder(spark), max_epochs=epochs, budget_part=part).select(*M.LEVELS, "doc_id", "epoch", "n_tokens", "taken").collect()
    assert len(found) == len(set(found))
    assert set(map(tuple, found)) == brute(rows, epochs, part, M.SEED)


def test_shortages_stay_with_siblings(spark):
    """A leaf that is short is made up for by its language, then by its domain, before others."""
    def texts(n, words, lang, source):
        return [(hash((lang, source, i)) % 10**9, "w " * words, lang, source, 1) for i in range(n)]

    rows = texts(10, 10, "en", "src1") + texts(500, 10, "en", "src5") + texts(500, 10, "de", "src1") + texts(500, 10, "en", "src0")
    docs = spark.createDataFrame(rows, X.DOCUMENTS)
    equal = {level: "1" for level in M.LEVELS}
    got = {(r.lang, r.source): r.target for r in M.budgets(M.supplies(docs, M.DOMAIN, RunFolder(spark)), equal, 1, 0.5, RunFolder(spark)).collect()}
    total = 15100 // 2
    assert got["en", "src0"] == total // 2 and got["de", "src1"] == total // 4 and got["en", "src1"] == 100
    assert got["en", "src5"] == int(total / 4 - 100)


def test_rows_of_the_mixture(spark):
    docs = corpus(spark).withColumn("slot", F.lit(1))
    chosen = M.mixture(docs, RunFolder(spark)).groupBy("doc_id", "lang", "source").count().collect()
    times = {(r.doc_id, r.lang, r.source): r["count"] for r in chosen}
    got = M.mixed_documents(docs, RunFolder(spark))
    assert got.columns == docs.columns
    wanted = []
    for r in docs.collect():
        if r.text and X.space_words(r.text):
            wanted += [r] * times.get((r.doc_id, r.lang or "none", r.source or "none"), 0)
    assert sorted(got.collect(), key=str) == sorted(wanted, key=str)


def test_empty_and_native(spark):
    docs = corpus(spark)
    assert M.mixture(docs.limit(0), RunFolder(spark)).collect() == []
    assert M.mixture(docs.where("text is null"), RunFolder(spark)).collect() == []
    plan = M.mixture(docs, RunFolder(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Cartesian", plan)
