import random
import zlib

import fixtures as X
import numpy as np
import pyarrow as pa
import public_tokenizers
from tokenizers import Tokenizer

from hydrolens.llm import token_files as K
from hydrolens.sources.folders import RunFolder

PATH = public_tokenizers.path("word_bpe_49k.json")


def whole_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [2]


def test_word_by_word_equals_whole_texts():
    tokenizer, rng, encode = Tokenizer.from_file(PATH), random.Random(3), K.Encoder(PATH)
    pieces = list("aZ09'éÉñßİςΣ") + ["́", "̀", "À", "ö", "ÿ", "×", "÷", "µ", "º", "²", "¿", "Æ", "\x7f", "\x01", "'Ve", "'", '"', "<|", ".", ",,", "'s", "'LL", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x85", "\xa0", "　", " ", "日", "한", "\U0001f600", "<|endoftext|>", "-", "…", "½"]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(0, 60))) for _ in range(3000)] + ["", " "]
    ids, sizes = encode(pa.array(texts))
    wanted = [e.ids + [2] for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == [i for w in wanted for i in w]


def test_codes_and_random_access(tmp_path):
    rng = np.random.default_rng(0)
    for ids in (np.zeros(0), np.array([7]), rng.integers(0, 49408, 5000), rng.integers(0, 2**32, 3000), np.arange(512), np.full(1024, 256)):
        ids = ids.astype(np.uint32)
        path = f"{tmp_path}/x.dac"
        with open(path, "wb") as out:
            out.writelines(K.file_bytes(ids, np.array([5]), np.array([False]), np.array([len(ids)])))
        file = K.TokenFile(path)
        assert file.tokens(0, len(ids)).tolist() == ids.tolist()
        for i in rng.integers(0, max(len(ids), 1), 200 * bool(len(ids))):
            assert file.token(int(i)) == ids[i]
            j = int(rng.integers(i, len(ids)))
            assert file.tokens(int(i), j).tolist() == ids[i:j].tolist()


def test_documents(spark, tmp_path):
    docs = X.documents(spark, extra=True)
    rows = K.document_tokens(spark, X.folder_of(tmp_path, documents=docs)).orderBy("doc_id").collect()
    start = 0
    for r, d in zip(rows, docs.orderBy("doc_id").collect(), strict=True):
        ids = whole_ids(d.text)
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_several_files_null_and_repeated_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(K, "FILE_IDS", 50)
    docs = spark.createDataFrame([(None, "a"), (4, "b"), (4, "a a"), (2, "x " * 200), (None, None)] * 3, "doc_id long, text string")
    run = RunFolder(spark)
    manifest = K.write_tokens(docs, f"{run.path}/t", PATH, run)
    rows = K.read_tokens(manifest, run).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * 6 + [2] * 3 + [4] * 6
    assert [r.start for r in rows] == [int(x) for x in np.cumsum([0] + [r.n_tokens for r in rows])[:-1]]


def test_empty(spark, tmp_path):
    assert K.document_tokens(spark, X.folder_of(tmp_path, documents=X.documents(spark).limit(0))).collect() == []


def test_other_tokenizers_take_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Two  words", "", " a b\n", None]
    ids, sizes = K.Encoder(path, 7)(pa.array(texts))
    wanted = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids + [7] for t in texts]
    assert ids.tolist() == [i for w in wanted for i in w] and sizes.tolist() == [len(w) for w in wanted]
