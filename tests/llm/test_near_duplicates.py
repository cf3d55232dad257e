import random

import fixtures as X
import numpy as np
import pytest

from hydrolens.llm import near_duplicates as N
from hydrolens.llm.graph import components
from hydrolens.sources.folders import RunFolder


def shingles(text, size):
    words = X.space_words(X.ascii_lower(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def brute(rows, size):
    sets = {i: shingles(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in ids}


def edited(rng, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def family_texts():
    """Copies, near copies around the threshold, chains of edits."""
    rng = random.Random(11)
    texts = X.awkward_texts()
    for _ in range(6):
        base = X.sentence(rng, rng.randrange(40, 160), 5000)
        texts += [edited(rng, base, rng.randrange(0, 12)) for _ in range(12)]
        chain = base
        for _ in range(6):
            chain = edited(rng, chain, 3)
            texts.append(chain)
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("size", [2, 5])
def test_components_equal_brute_force(spark, size):
    docs = X.documents(spark, family_texts(), extra=True)
    rows = N.near_duplicates(docs, RunFolder(spark), size=size).collect()
    wanted = brute([(r.doc_id, r.text) for r in docs.collect()], size)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == wanted
    assert len(rows) == len(wanted) and all(r.kept == (r.doc_id == r.component_id) for r in rows)
    assert len({r.component_id for r in rows}) < len(rows) - 20


def test_query(spark, tmp_path):
    docs = X.documents(spark)
    rows = N.document_groups(spark, X.folder_of(tmp_path, documents=docs)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute([(r.doc_id, r.text) for r in docs.collect()], 2)


def test_null_and_repeated_ids_and_empty(spark):
    text = "a b c d e f g h i j k l m n o p"
    docs = spark.createDataFrame([(None, text), (3, text), (3, text), (2, text), (9, "other words"), (9, text), (None, None)], "doc_id long, text string")
    rows = N.near_duplicates(docs, RunFolder(spark), size=2).collect()
    assert len(rows) == 7
    assert all(r.component_id is None and r.kept for r in rows if r.doc_id is None)
    assert all(r.component_id == 2 for r in rows if r.doc_id in (2, 3))
    assert N.near_duplicates(docs.limit(0), RunFolder(spark)).collect() == []


def test_posterior_bounds():
    least = N.least_matches(0.8, 1e-6)
    assert list(least) == [25, 50, 75, 100, 125, 150] and all(least[n] < 0.8 * n for n in least)
    # A pair at the threshold is pruned about as seldom as the miss probability says.
    rng = np.random.default_rng(1)
    same = rng.random((20000, N.HASHES)) < 0.8
    pruned = np.zeros(len(same), bool)
    for n, fewest in least.items():
        pruned |= same[:, :n].sum(axis=1) < fewest
    assert pruned.mean() < 1e-3


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 300), (300, 400), (7, 7)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in components(frame, RunFolder(spark), "c").collect()}
    assert found == {i: 0 for i in range(101)} | {300: 300, 400: 300, 500: 300}
    assert components(frame.limit(0), RunFolder(spark), "c").collect() == []


def test_slices_of_batches_are_read_right():
    import pyarrow as pa

    from hydrolens.llm.shingles import Words, pieces, word_hash

    texts = [f"Word{i} ÀB cd " * (i % 5) for i in range(50)] + [None, ""]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    for lower in (True, False):
        got = []
        for first in range(0, len(texts), 7):
            words = Words(batch.slice(first, 7).column("text"), lower)
            got += words.hashes.tolist()
            assert words.sizes.tolist() == [len((t or "").split()) for t in texts[first : first + 7]]
        flat = [w for t in texts for w in X.space_words(X.ascii_lower(t or "") if lower else t)]
        assert got == word_hash([w.encode() for w in flat]).tolist()
    assert sum(p.num_rows for p in pieces(batch)) == len(texts)
