import zlib
from collections import Counter, defaultdict

import fixtures as X
import numpy as np

from hydrolens.llm import sharding


def one_by_one(key: int, shards: int) -> int:
    b, j, key = -1, 0, key % 2**64
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_published_loop():
    keys = np.random.default_rng(1).integers(0, 2**63, 2000).astype(np.uint64)
    for n in (1, 2, 16, 17, 1000):
        assert sharding.jump(keys, n).tolist() == [one_by_one(int(k), n) for k in keys]


def test_documents(spark, tmp_path):
    docs = X.documents(spark, extra=True)
    rows = sharding.document_shards(spark, X.folder_of(tmp_path, documents=docs)).collect()
    text = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(text)
    slots = defaultdict(list)
    for r in rows:
        data = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 16) and 0 <= r.shard < 16
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_balance_and_moves(spark, tmp_path):
    docs = spark.range(20000).selectExpr("id as doc_id", "'t' as text")
    rows = sharding.document_shards(spark, X.folder_of(tmp_path, documents=docs)).collect()
    counts = Counter(r.shard for r in rows)
    assert len(counts) == 16 and max(counts.values()) < 1.15 * 20000 / 16
    assert abs(sum(r.grown_shard == 16 for r in rows) - 20000 / 17) < 150


def test_repeated_and_null_keys_and_empty(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a"), (None, "b"), (5, "c"), (5, "d"), (6, None)], "doc_id long, text string")
    rows = sharding.document_shards(spark, X.folder_of(tmp_path / "a", documents=docs)).collect()
    assert len(rows) == 5 and len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert sharding.document_shards(spark, X.folder_of(tmp_path / "b", documents=docs.limit(0))).collect() == []


def test_written_shards(spark, tmp_path):
    docs = X.documents(spark)
    sharding.write_shards(docs, "doc_id", 4, f"{tmp_path}/shards")
    assert spark.read.parquet(f"{tmp_path}/shards").count() == docs.count()


def test_columns_of_any_name_are_kept(spark):
    from hydrolens.sources.folders import RunFolder

    docs = X.documents(spark, extra=True)
    placed = sharding.assign(docs, "doc_id", 4, RunFolder(spark))
    assert placed.columns == [c for c in docs.columns if c not in ("slot", "shard")] + ["shard", "grown_shard", "slot"]
    kept = [f"`{c}`" for c in docs.columns if c not in ("slot", "shard")]
    assert sorted(map(repr, placed.select(kept).collect())) == sorted(map(repr, docs.select(kept).collect()))
