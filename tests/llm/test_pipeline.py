import random
import zlib

import fixtures as X
import numpy as np
import public_tokenizers
from test_decontamination import brute as contaminated
from test_mixing import brute as mixed
from test_near_duplicates import brute as grouped
from tokenizers import Tokenizer

import corpus_pipeline as P
from hydrolens.llm import language_id, mixing
from hydrolens.sources.folders import RunFolder


def corpus(spark, tmp_path):
    rng = random.Random(21)
    texts = X.awkward_texts() + [X.sentence(rng, rng.randrange(5, 120), 2000) for _ in range(60)]
    texts += [texts[-1], texts[-1] + " x", texts[-2] + " y z"]
    leak = X.sentence(rng, 30, 2000)
    texts += [X.sentence(rng, 20, 2000) + " " + leak + " " + X.sentence(rng, 9) for _ in range(3)]
    docs = X.documents(spark, texts, extra=True)
    items = spark.createDataFrame([(1, leak), (2, None), (3, "never there")], "item_id long, text string")
    return X.folder_of(tmp_path, documents=docs, benchmark=items)


def test_each_stage_on_its_own_input(spark, tmp_path):
    folder = corpus(spark, tmp_path)
    docs = before = spark.read.parquet(f"{folder}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    outputs = []
    for name, stage in P.STAGES:
        rows = docs.collect()
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/out/{name}")
        out = spark.read.parquet(f"{tmp_path}/out/{name}")
        pairs = [(r.doc_id, r.text) for r in rows]
        if name != "token_files":
            assert out.columns == before.columns
            kept = sorted(r.doc_id for r in out.collect())
        if name == "language_id":
            found = language_id.identify(docs, RunFolder(spark)).where("not rejected").collect()
            assert kept == sorted(r.doc_id for r in found)
            assert {r.doc_id for r in rows if r.text and language_id.LETTER.search(r.text) and r.text.isascii()} <= set(kept)
        elif name == "near_duplicates":
            assert kept == sorted(i for i, (_, c) in grouped(pairs, 5).items() if i == c)
            assert len(kept) < len(rows)
        elif name == "decontamination":
            assert kept == sorted(r[0] for r in contaminated(pairs, items) if not r[5])
            assert len(rows) - len(kept) == 3
        elif name == "mixing":
            chosen = mixed([(r.doc_id, r.text, r.lang, r.source) for r in rows], mixing.MAX_EPOCHS, mixing.BUDGET_PART, mixing.SEED)
            assert kept == sorted(c[3] for c in chosen)
        else:
            tokenizer, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
            got = out.orderBy("start").collect()
            for r, d in zip(got, sorted(rows, key=lambda r: (r.doc_id, r.text)), strict=True):
                ids = tokenizer.encode(d.text or "", add_special_tokens=False).ids + [2]
                assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
                start += len(ids)
        outputs.append(out.count())
        docs = out
    assert P.run(spark, folder).count() == outputs[-1] > 0


def test_empty_null_and_repeated(spark, tmp_path):
    empty = X.documents(spark).limit(0)
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert P.run(spark, X.folder_of(tmp_path / "e", documents=empty, benchmark=items)).collect() == []
    rows = [(None, "some words here", "en", None, 1), (None, None, None, None, None), (5, "more words here", "en", "s", 1), (5, "more words here", "en", "s", 1)] * 3
    docs = spark.createDataFrame(rows, X.DOCUMENTS)
    assert P.run(spark, X.folder_of(tmp_path / "n", documents=docs, benchmark=items)).count() > 0
