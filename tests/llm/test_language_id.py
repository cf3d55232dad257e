import math
import random
from collections import Counter

import fixtures as X
import numpy as np
from pyspark.sql import functions as F

from hydrolens.llm import language_id as L
from hydrolens.sources.folders import RunFolder

LETTERS = {"aa": "abcde ", "bb": "uvwxy ", "cc": "äöüßé "}


def text_of(lang, rng, size=200):
    return "".join(rng.choices(LETTERS[lang], k=size))


def corpus(spark, n=240):
    rng = random.Random(5)
    rows = [(i, text_of(lang := rng.choice(list(LETTERS)), rng, rng.randrange(20, 300)), lang) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_fold(spark, tmp_path):
    docs = corpus(spark)
    rows = L.document_languages(spark, X.folder_of(tmp_path, documents=docs)).collect()
    truth = {r.doc_id: r.lang for r in docs.collect()}
    assert len(rows) == len(truth)
    assert all(r.held_out == (X.fold(r.doc_id, 4) == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_held_out_rows_and_inputs_do_not_teach(spark):
    docs = corpus(spark, 120)
    clean = L.identify(docs, RunFolder(spark)).select("doc_id", "lang_pred", "score").collect()
    spoilt = docs.selectExpr("doc_id", "text", "if(pmod(crc32(cast(cast(doc_id as string) as binary)), 4) = 2, 'zz', lang) lang")
    assert sorted(clean) == sorted(L.identify(spoilt, RunFolder(spark)).select("doc_id", "lang_pred", "score").collect())


def test_awkward_rows(spark, tmp_path):
    docs = X.documents(spark, extra=True).selectExpr("*", "'x' score", "'y' lang_pred", "'z' rejected")
    out = L.identify(docs, RunFolder(spark))
    assert set(docs.columns) <= set(out.columns)
    for r in out.collect():
        if r.text is None or not L.LETTER.search(r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "de")


def test_long_texts_are_read_whole():
    long = "abc " * 1_200_000 + "xyz"
    found = L.counts(long)
    assert abs(found.sum() - 3 * len(long)) < 20
    assert L.counts("xyz")[L.counts("abc") == 0].max() == 1


def test_nothing_learned_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r.lang_pred for r in L.identify(docs, RunFolder(spark)).collect()} == {"und"}
    assert L.identify(docs.limit(0), RunFolder(spark)).collect() == []


def test_rejects_what_no_language_resembles(spark):
    docs = corpus(spark, 90).union(spark.createDataFrame([(1000, "日本語 テキスト", None)], "doc_id long, text string, lang string"))
    rows = {r.doc_id: r for r in L.identify(docs, RunFolder(spark)).collect()}
    assert rows[1000].rejected and not any(r.rejected for i, r in rows.items() if i < 1000)


SYLLABLES = {"aa": "an der ich en sch ung ge ver te st er li", "bb": "que la os ci on re ta men do es al ti", "zz": "ko vi sta ny je po ru mi za elä on ään"}


def prose(lang, rng, chars):
    words = [w for _ in range(chars // 3) for w in ["".join(rng.choices(SYLLABLES[lang].split(), k=rng.choice([1, 2, 2, 3])))]]
    return " ".join(words)[:chars]


def test_rejects_long_foreign_and_random_texts_but_not_short_clean_ones(spark):
    rng = random.Random(8)
    known = [(i, prose(lang, rng, int(2 ** rng.uniform(3, 13))), lang) for i in range(800) for lang in [rng.choice(["aa", "bb"])]]
    alphabets = {"foreign": None, "letters": "abcdefghijklmnopqrstuvwxyz    ", "base64": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"}
    strange, n = {}, 10_000
    for kind, letters in alphabets.items():
        for size in (1500, 5000, 20_000):
            for _ in range(3):
                strange[n] = (kind, size, prose("zz", rng, size) if letters is None else "".join(rng.choices(letters, k=size)))
                n += 1
    short = {20_000 + k: (prose(lang, rng, size), lang) for k, (lang, size) in enumerate([(a, b) for a in ("aa", "bb") for b in (40, 80, 160)] * 5)}
    learned = [r for r in known if X.fold(r[0], 4) != 2]
    docs = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    model = L.train(docs, RunFolder(spark))
    asked = [(k, v[2]) for k, v in strange.items()] + [(k, v[0]) for k, v in short.items()]
    asked += [(r[0], r[1]) for r in known if X.fold(r[0], 4) == 2]
    frame = spark.createDataFrame(asked, "doc_id long, text string").withColumn("_found", L.predictor(model)("text"))
    found = {r.doc_id: r for r in frame.select("doc_id", "_found.*").collect()}
    assert [strange[k][:2] for k in strange if not found[k].rejected] == []
    assert [k for k in short if found[k].rejected or found[k].lang_pred != short[k][1]] == []
    held = [r for r in known if X.fold(r[0], 4) == 2]
    assert sum(found[r[0]].rejected for r in held) <= 0.02 * len(held)


def test_bounds_lie_between_members_and_strangers_and_never_fall_with_length():
    strangers = np.full(L.SIZES, 0.2)
    bounds = L.bounds_of({5: (0.1, 500), 8: (0.4, 500), 9: (0.3, 500), 11: (0.9, 10)}, strangers)
    assert np.allclose(bounds[[5, 8, 9, 11, 23]], [0.1, 0.3, 0.3, 0.3, 0.3])
    assert (np.diff(bounds) >= 0).all() and L.bounds_of({5: (0.1, 10)}, strangers)[5] < 0.1


# --- brute force: the same classifier in plain Python --------------------------------------
def plain_counts(text):
    kept = [b if b >= 128 or 97 <= b <= 122 else 32 for b in (" " + text.lower() + " ").encode()]
    grams = [b for i, b in enumerate(kept) if not (b == 32 and i and kept[i - 1] == 32)]
    found = Counter()
    for size, odd in ((1, 0x9E3779B1), (2, 0x85EBCA77), (3, 0xC2B2AE3D)):
        for i in range(len(grams) - size + 1):
            code = sum(g << (8 * (size - 1 - k)) for k, g in enumerate(grams[i : i + size]))
            found[((code + 1) * odd % 2**32) >> 20] += 1
    return found


def plain_vector(found, idf):
    weighted = {b: math.log1p(n) * idf[b] for b, n in found.items()}
    length = math.sqrt(sum(w * w for w in weighted.values()))
    return {b: w / length for b, w in weighted.items()}


def cosine(a, b):
    return sum(w * b.get(k, 0.0) for k, w in a.items())


def plain_centroids(vectors):
    centres = [dict(v) for v in vectors[: L.CENTROIDS]]
    for _ in range(L.ROUNDS):
        owned = [[] for _ in centres]
        for v in vectors:
            owned[max(range(len(centres)), key=lambda c: cosine(v, centres[c]))].append(v)
        for c, members in enumerate(owned):
            mean = Counter()
            for v in members:
                mean.update(v)
            if size := math.sqrt(sum(w * w for w in mean.values())):
                centres[c] = {b: w / size for b, w in mean.items()}
    return centres


def test_equals_brute_force(spark):
    """Document frequencies of all labelled texts, k-means from the members in the order of their hashes,
    the nearest of all centroids."""
    docs = corpus(spark, 150).union(X.documents(spark).select("doc_id", "text", "lang").where("text is not null").withColumn("doc_id", F.expr("doc_id + 1000")))
    rows = docs.withColumn("share", F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))).collect()
    teaching = sorted((r.share, r.doc_id, r.text, r.lang) for r in rows if X.fold(r.doc_id, 4) != 2 and r.lang and L.LETTER.search(r.text))
    held = Counter(b for *_, text, _ in teaching for b in plain_counts(text))
    idf = {b: math.log((1 + len(teaching)) / (1 + held[b])) + 1e-3 for b in range(L.BINS)}
    centres = []
    for lang in sorted({t[3] for t in teaching}):
        vectors = [plain_vector(plain_counts(text), idf) for *_, text, own in teaching if own == lang]
        centres += [(lang, c) for c in plain_centroids(vectors)]
    got = {r.doc_id: r for r in L.identify(docs, RunFolder(spark)).collect()}
    assert len(got) == len(rows)
    for r in rows:
        if not L.LETTER.search(r.text):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        v = plain_vector(plain_counts(r.text), idf)
        best = {}
        for lang, c in centres:
            best[lang] = max(best.get(lang, 0.0), cosine(v, c))
        assert abs(got[r.doc_id].score - max(best.values())) < 1e-4
        assert best[got[r.doc_id].lang_pred] > max(best.values()) - 1e-4
