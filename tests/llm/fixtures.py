"""Small tables with the cases every operator has to stand."""

from __future__ import annotations

import random
import re
import zlib

from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# Extra columns whose names operators use inside.
CLASHING = (
    "slot", "shard", "_key", "words", "term", "pos", "path", "part", "weight", "n_words", "_id", "_times", "_lang", "_source",
    "_turn", "_row", "_place", "_range", "_first", "_before", "_found", "row", "id", "turn", "times", "domain", "doc", "A.b",
)


def sentence(rng: random.Random, size: int, vocabulary: int = 300) -> str:
    return " ".join(f"W{rng.randrange(vocabulary)}" for _ in range(size))


def awkward_texts(seed: int = 7) -> list[str | None]:
    """Nulls, empty and blank texts, single words, odd characters, long texts, copies, near
    copies, shared passages."""
    rng = random.Random(seed)
    base = sentence(rng, 120)
    passage = sentence(rng, 60)
    texts: list[str | None] = [
        None, "", "   \t\n", "one", "ONE", "a b", "Él niño come; ¿qué?", "x\x1cy\x0bz", "<|endoftext|> a<|startoftext|>b",
        sentence(rng, 5000, 4000), "same " * 400, base, base, base, base + " tail", base.replace("W1 ", "V1 ", 1),
        sentence(rng, 40) + " " + passage + " " + sentence(rng, 30), passage, sentence(rng, 9) + " " + passage,
        "日本語 テキスト です", "\U0001f600 emoji \U0001f600",
    ]
    return texts + [sentence(rng, rng.randrange(1, 90)) for _ in range(20)]


def documents(spark, texts=None, extra: bool = False):
    texts = awkward_texts() if texts is None else texts
    langs, sources = ["en", "de", None], ["src0", "src0", "src1", None]
    rows = [
        (i * 3 + 1, t, langs[i % 3], sources[i % 4], None if t is None else len(t)) for i, t in enumerate(texts)
    ]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    if extra:
        for name in CLASHING:
            frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame


def fold(key, modulus: int) -> int:
    return zlib.crc32(str(key).encode()) % modulus


def ascii_lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def space_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def folder_of(tmp_path, **frames) -> str:
    """Writes the frames as the tables of a folder."""
    for name, frame in frames.items():
        frame.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)
