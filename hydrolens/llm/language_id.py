"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams (1 to 3 bytes of the lower-cased text, other
characters than letters folded into one blank), weighted by TF-IDF and normalised. Each language
has several centroids, found by spherical k-means. A text gets the language of the centroid with
the largest cosine; if that is below the bound of the language for texts of this length, the text is
rejected.

Bounds are learned per language and class of n-gram counts (powers of two) from beginnings of the
sample texts: what members reach there (1 % quantile) against what the other languages' texts reach at
centroids not their own, or random letters (95 % quantile). A bound never falls with the length.

Document frequencies count every labelled training text. Centroids are fitted on a bounded sample,
`SAMPLE_PER_LANGUAGE` texts of each language at most, chosen by a hash of the id.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hydrolens.llm.common import fold, own, small, table, unused
from hydrolens.llm.shingles import give_back, lean
from hydrolens.sources.folders import RunFolder

BINS = 4096
CENTROIDS = 4
ROUNDS = 8
SAMPLE_PER_LANGUAGE = 1000
MEMBERS_LOW, FOREIGN_HIGH = 0.01, 0.95  # quantiles of cosines that a bound lies between
ENOUGH = 100  # a class with fewer members takes the bound of a smaller class
# Bound where no class has enough: part of the whole texts' low quantile, less below SHORT n-grams.
REJECT_PART, SHORT = 0.2, 100
SIZES = 24  # classes of n-gram counts; the last has all larger ones
CUTS = [2**k for k in range(2, 18)]  # characters of the beginnings
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
PIECE = 4_000_000
# Bytes that stay: a-z and everything outside ASCII; the rest is a blank.
KEPT = np.array([b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256)], np.uint8)
# Odd multipliers that spread n-grams over the bins.
SPREAD = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], np.uint32)


def counts(text: str) -> np.ndarray:
    """How often an n-gram of each bin occurs in the whole text."""
    total = np.zeros(BINS)
    for first in range(0, len(text) or 1, PIECE):
        piece = KEPT[np.frombuffer((" " + text[first : first + PIECE].lower() + " ").encode("utf-8", "replace"), np.uint8)]
        blank = piece == 32
        grams = piece[~(blank & np.concatenate([[False], blank[:-1]]))].astype(np.uint32)
        codes = grams
        for size in (1, 2, 3):
            if len(codes) == 0:
                break
            hashed = ((codes + np.uint32(1)) * SPREAD[size - 1]) >> np.uint32(20)
            total += np.bincount(hashed, minlength=BINS)
            codes = (codes[:-1] << np.uint32(8)) | grams[size:]
    return total


def vector(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Normalised TF-IDF of the counts."""
    weighted = np.log1p(found) * idf
    length = np.sqrt(weighted @ weighted)
    return (weighted / length if length else weighted).astype(np.float32)


def centroids_of(vectors: np.ndarray) -> np.ndarray:
    """Spherical k-means from the first members (they come in hash order)."""
    centres = vectors[:CENTROIDS].copy()
    for _ in range(ROUNDS):
        owner = (vectors @ centres.T).argmax(axis=1)
        for c in range(len(centres)):
            mean = vectors[owner == c].sum(axis=0)
            if (size := np.sqrt(mean @ mean)) > 0:
                centres[c] = mean / size
    return centres


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: np.ndarray  # per centroid and class of n-gram counts, cosine below which a text is rejected
    idf: np.ndarray

    def bound(self, centroid: int, grams: float) -> float:
        """Between the middles of two classes on a line over the logarithm of the count."""
        return float(np.interp(np.log2(max(1.0, grams)), np.arange(SIZES) + 0.5, self.least[centroid]))


def size_of(grams: float) -> int:
    return min(SIZES - 1, int(np.log2(max(1.0, grams))))


def _document_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    frequency, texts = np.zeros(BINS, np.int64), 0
    for batch in batches:
        for text in batch.column(0).to_pylist():
            frequency += counts(text) > 0
            texts += 1
    yield pa.RecordBatch.from_pydict({"bin": np.arange(-1, BINS), "n": np.concatenate([[texts], frequency])})


def _sample_vectors(idf: np.ndarray):
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [vector(counts(text), idf).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), batch.column("rank"), pa.array(rows, pa.binary())], names=["lang", "rank", "vector"])

    return vectors


def _fit(members: pd.DataFrame) -> pd.DataFrame:
    members = members.sort_values("rank")
    centres = centroids_of(np.stack([np.frombuffer(v, np.float32) for v in members["vector"]]))
    return pd.DataFrame({"lang": members["lang"].iloc[0], "centroid": range(len(centres)), "vector": [c.tobytes() for c in centres]})


def _beginnings(languages: list[str], centroids: np.ndarray, idf: np.ndarray):
    """Per beginning of a text its language and class, the largest cosine to the language's own
    centroids, and to those of all others (null if there are none)."""
    names = np.array(languages)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                for cut in [c for c in CUTS if c < len(text)] + [len(text)]:
                    found = counts(text[:cut])
                    line, own = centroids @ vector(found, idf), names == lang
                    foreign = None if own.all() else float(line[~own].max())
                    rows.append((lang, size_of(found.sum()), float(line[own].max()), foreign, cut == len(text)))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.string(), pa.int32(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["lang", "size", "member", "stranger", "whole"])

    return measured


def _random_letters(centroids: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Per class, the high quantile of the largest cosines of random letters with and without blanks."""
    rng, reached = np.random.default_rng(1), [[] for _ in range(SIZES)]
    for cut in CUTS[:13]:
        for alphabet in ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz    "):
            for _ in range(10):
                found = counts("".join(rng.choice(list(alphabet), cut)))
                reached[size_of(found.sum())].append((centroids @ vector(found, idf)).max())
    return np.array([np.quantile(r, FOREIGN_HIGH) if r else 0.0 for r in reached])


def bounds_of(members: dict[int, tuple[float, int]], strangers: np.ndarray) -> np.ndarray:
    """Bound per class, from the members' low cosine and their number and the strangers' high cosine:
    half way between them, or the members' if that is lower; a class of few members
    takes that of a smaller class."""
    bounds = np.zeros(SIZES)
    for size, (low, n) in members.items():
        if n >= ENOUGH:
            bounds[size] = min(low, (low + strangers[size]) / 2)
    return np.maximum.accumulate(bounds)


def _bounds(sample: DataFrame, languages: list[str], centroids: np.ndarray, idf: np.ndarray, run: RunFolder) -> dict[str, np.ndarray]:
    measured = run.keep(
        sample.select("text", "lang").mapInArrow(lean(_beginnings(languages, centroids, idf)), "lang string, size int, member double, stranger double, whole boolean"),
        "sample_cosines",
    )
    low = measured.groupBy("lang", "size").agg(F.percentile("member", F.lit(MEMBERS_LOW)).alias("low"), F.count("*").alias("n")).collect()
    high = measured.groupBy("size").agg(F.percentile("stranger", F.lit(FOREIGN_HIGH)).alias("high")).collect()
    usual = measured.where("whole").groupBy("lang").agg(F.percentile("member", F.lit(MEMBERS_LOW)).alias("low")).collect()
    least = REJECT_PART * np.minimum(1.0, np.sqrt(2 ** (np.arange(SIZES) + 0.5) / SHORT))
    strangers = _random_letters(centroids, idf)
    for r in high:
        strangers[r.size] = max(strangers[r.size], r.high or 0.0)
    strangers = np.maximum.accumulate(strangers)
    return {u.lang: np.maximum(u.low * least, bounds_of({r.size: (r.low, r.n) for r in low if r.lang == u.lang}, strangers)) for u in usual}


def _sample(teaching: DataFrame, run: RunFolder, bound: int) -> DataFrame:
    """At most `bound` texts of each language: those with the smallest hashes of the id. A cut at
    twice the wanted share leaves the ranking few rows whatever the language's size."""
    sizes = run.keep(teaching.groupBy("lang").agg(F.count("*").alias("rows")), "language_sizes")
    share = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    ids = teaching.select("doc_id", "lang", share.alias("share")).join(small(sizes), "lang")
    few = ids.where(F.col("share") * F.col("rows") < 2 * bound).select("doc_id", "lang", "share").distinct()
    by_hash = Window.partitionBy("lang").orderBy("share", "doc_id")
    ranked = few.withColumn("rank", F.row_number().over(by_hash)).where(F.col("rank") <= bound)
    chosen = run.keep(ranked.select(F.col("doc_id").alias("_id"), F.col("lang").alias("_lang"), "rank"), "sample_ids")
    same = teaching["doc_id"].eqNullSafe(F.col("_id")) & (teaching["lang"] == F.col("_lang"))
    return teaching.join(small(chosen), same).drop("_id", "_lang").dropDuplicates(["doc_id", "lang"])


def train(labelled: DataFrame, run: RunFolder, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Learns from the columns doc_id, text and lang. Rows without text, letter or language teach
    nothing. The model has at most CENTROIDS vectors of BINS numbers per language."""
    teaching = labelled.select("doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    totals = (
        teaching.select("text").mapInArrow(lean(_document_frequencies), "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n"))
    )
    frequency = {r.bin: r.n for r in totals.collect()}  # BINS + 1 rows
    texts = frequency.get(-1, 0)
    idf = np.array([np.log((1 + texts) / (1 + frequency.get(b, 0))) + 1e-3 for b in range(BINS)])
    sample = run.keep(_sample(teaching, run, sample_per_language), "sample")
    fitted = (
        sample.mapInArrow(lean(_sample_vectors(idf)), "lang string, rank int, vector binary")
        .groupBy("lang")
        .applyInPandas(_fit, "lang string, centroid int, vector binary")
        .orderBy("lang", "centroid")
        .collect()
    )
    languages = [r.lang for r in fitted]
    centroids = np.array([np.frombuffer(r.vector, np.float32) for r in fitted]).reshape(-1, BINS)
    bounds = _bounds(sample, languages, centroids, idf, run) if languages else {}
    return Model(languages, centroids, np.array([bounds[lang] for lang in languages]), idf)


PREDICTED = T.StructType(
    [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())]
)


def predictor(model: Model):
    """Column function: text to the struct lang_pred, score (cosine, 0 to 1), rejected. Null and
    texts without a letter, or any text if nothing was learned, are `und` and rejected."""

    @F.pandas_udf(PREDICTED)
    def predicted(series: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in series:
            best, score, rejected = [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            known = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)] if model.languages else []
            for first in range(0, len(known), 256):
                rows = known[first : first + 256]
                found = [counts(texts.iloc[i]) for i in rows]
                cosines = np.stack([vector(x, model.idf) for x in found]) @ model.centroids.T
                for i, c, line, x in zip(rows, cosines.argmax(axis=1), cosines, found):
                    best[i], score[i] = model.languages[c], min(1.0, max(0.0, float(line[c])))
                    rejected[i] = line[c] < model.bound(c, x.sum())
            yield pd.DataFrame({"lang_pred": best, "score": score, "rejected": rejected})
        give_back()

    return predicted


def identify(docs: DataFrame, run: RunFolder, modulus: int = 4, held_out: int = 2) -> DataFrame:
    """All rows and columns of the documents with `held_out`, `lang_pred`, `score` and `rejected`,
    which replace columns of these names. Learns from the rows outside the held-out fold only.
    Repeated rows are learned from and predicted as often as they occur."""
    folded = docs.drop("held_out", *PREDICTED.names).withColumn("held_out", fold(F.col("doc_id"), modulus) == held_out)
    model = train(folded.where(~F.col("held_out")), run)
    name = unused(folded, "_found")
    found = folded.withColumn(name, predictor(model)("text"))
    return found.select(*own(found, name), f"{name}.*")


def identified(docs: DataFrame, run: RunFolder) -> DataFrame:
    """The rows of the documents, all columns, whose language is not rejected."""
    folded = docs.select("doc_id", "text", "lang").where(fold(F.col("doc_id"), 4) != 2)
    model = train(folded, run)
    return docs.where(~predictor(model)("text")["rejected"])


def document_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = identify(table(spark, sf_dir, "documents"), RunFolder(spark))
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")
