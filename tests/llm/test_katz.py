import math
import random
from collections import Counter, defaultdict

import fixtures as X
import numpy as np
import pytest

from hydrolens.llm import katz as K
from hydrolens.llm import shingles
from hydrolens.sources.folders import RunFolder


class Brute:
    """The model with dictionaries, straight from its definition."""

    def __init__(self, rows, order=2):
        self.order, self.words = order, Counter()
        self.grams = {k: Counter() for k in range(2, order + 1)}
        self.histories, self.followers, self.weights = Counter(), defaultdict(list), {}
        for i, text in rows:
            if X.fold("" if i is None else i, 7) == 2:
                continue
            tokens = self.tokens(text)
            for t, w in enumerate(tokens):
                self.words[w] += 1
                for k in self.grams:
                    self.grams[k][self.history(tokens, t, k), w] += 1
                    self.histories[self.history(tokens, t, k)] += 1
        self.n = sum(self.words.values())
        self.d = {1: K.discounts(Counter(self.words.values()))} | {k: K.discounts(Counter(c.values())) for k, c in self.grams.items()}
        for counts in self.grams.values():
            for h, w in counts:
                self.followers[h].append(w)
        freed = sum(c - self.off(c, 1) for c in self.words.values())
        self.total, self.unknown = (self.n, freed / self.n) if freed > 0 else (self.n + 1, 1 / (self.n + 1))

    @staticmethod
    def tokens(text):
        return [*X.space_words(X.ascii_lower(text or "")), "</s>"]

    @staticmethod
    def history(tokens, t, k):
        """The k - 1 tokens before place t, end tokens before the text."""
        return tuple((["</s>"] * (k - 1) + tokens)[t : t + k - 1])

    def off(self, c, k):
        return c * self.d[k][c] if c <= 5 else c

    def kept(self, h):
        k = len(h) + 1
        kept = {x: self.off(self.grams[k][h, x], k) for x in self.followers[h]}
        freed, total = self.histories[h] - math.fsum(kept.values()), self.histories[h]
        return (kept, freed, total) if abs(freed) >= 1e-9 else (kept, 1.0, total + 1)

    def weight(self, h):
        if h not in self.weights:
            kept, freed, total = self.kept(h)
            self.weights[h] = freed / total / (1 - math.fsum(self.probability(h[1:], x) for x in kept))
        return self.weights[h]

    def probability(self, h, w):
        if not h:
            return self.off(self.words[w], 1) / self.total if w in self.words else self.unknown
        if not self.histories[h]:
            return self.probability(h[1:], w)
        if (h, w) in self.grams[len(h) + 1]:
            kept, _, total = self.kept(h)
            return kept[w] / total
        return self.weight(h) * self.probability(h[1:], w)

    def row(self, i, text):
        tokens, score, base = self.tokens(text), 0.0, 0.0
        for t, w in enumerate(tokens):
            score += math.log10(self.probability(self.history(tokens, t, self.order), w))
            base += math.log10((self.words[w] + 1) / (self.n + len(self.words) + 1))
        return X.fold("" if i is None else i, 7) == 2, len(tokens), sum(w in self.words for w in tokens), self.n, base, score


def texts():
    rng = random.Random(3)
    weights = [1 / (i + 1) for i in range(200)]
    return X.awkward_texts() + [" ".join(rng.choices([f"t{i}" for i in range(200)], weights, k=rng.randrange(1, 150))) for _ in range(60)]


@pytest.mark.parametrize("chars", [700, 8_000_000])
def test_equals_brute_force(spark, tmp_path, monkeypatch, chars):
    monkeypatch.setattr(shingles, "PIECE_CHARS", chars)
    docs = X.documents(spark, texts(), extra=True)
    rows = {r.doc_id: r for r in docs.collect()}
    model = Brute([(i, r.text) for i, r in rows.items()])
    found = K.document_scores(spark, X.folder_of(tmp_path, documents=docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        held, n, known, total, base, score = model.row(r.doc_id, rows[r.doc_id].text)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-9)


def varied():
    """Texts of few words, so that longer grams repeat, and copies, so that some have no rare follower."""
    rng = random.Random(8)
    return [*texts()[:22], *[X.sentence(rng, rng.randrange(1, 60), 12) for _ in range(40)], *["a b c a b d"] * 9]


@pytest.mark.parametrize("order,chars", [(1, 8_000_000), (3, 500), (4, 8_000_000)])
def test_other_orders_equal_brute_force(spark, monkeypatch, order, chars):
    monkeypatch.setattr(shingles, "PIECE_CHARS", chars)
    docs = X.documents(spark, varied())
    model = Brute([(r.doc_id, r.text) for r in docs.collect()], order)
    text_of = {r.doc_id: r.text for r in docs.collect()}
    found = K.scores(docs, RunFolder(spark), order).collect()
    assert sorted(r.doc_id for r in found) == sorted(text_of)
    for r in found:
        held, n, known, total, base, score = model.row(r.doc_id, text_of[r.doc_id])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score == pytest.approx(score, rel=1e-7)


def test_order_below_one_is_refused(spark):
    with pytest.raises(ValueError):
        K.scores(X.documents(spark), RunFolder(spark), 0)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_add_up_to_one(order):
    model = Brute(list(enumerate(varied())), order)
    histories = [h for h in model.histories if len(h) == order - 1][:60]
    for h in [*histories, ("never seen",) * (order - 1)]:
        total = math.fsum(model.probability(h, w) for w in [*model.words, "unknown word"])
        assert total == pytest.approx(1, abs=1e-9)


def test_held_out_texts_gain_from_pairs(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{x} follows{x}" for x in rng.choices(range(50), k=40))) for i in range(200)]
    found = K.scores(spark.createDataFrame(rows, "doc_id long, text string"), RunFolder(spark)).where("held_out").collect()
    assert found and all(r.score > r.base_score for r in found)


def test_null_repeated_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, None), (1, "a b"), (1, "a b"), (9, "")], "doc_id long, text string")
    model = Brute([(r.doc_id, r.text) for r in docs.collect()])
    for r, d in zip(sorted(K.scores(docs, RunFolder(spark)).collect(), key=str), sorted(docs.collect(), key=str)):
        assert r.score < 0
    assert {round(r.score, 9) for r in K.scores(docs, RunFolder(spark)).collect()} == {round(model.row(i, t)[-1], 9) for i, t in docs.collect()}
    assert K.scores(docs.limit(0), RunFolder(spark)).collect() == []
    held = next(i for i in range(100) if X.fold(i, 7) == 2)
    untaught = K.scores(spark.createDataFrame([(held, "x y")], "doc_id long, text string"), RunFolder(spark)).collect()
    assert [(r.n_known, r.train_tokens, r.score) for r in untaught] == [(0, 0, 0.0)]


def test_packing():
    for values in ([], [0], [255, 256, 0], [2**40, 5]):
        assert K.unpack(K.pack(np.array(values, np.int64))).tolist() == values
