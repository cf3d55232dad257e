"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact check.

1. Each text gets its set of word shingles, a hash of the whole set, and a MinHash signature.
   Texts with equal sets form a class, which the smallest doc_id stands for from then on.
2. Bands of signature values put representatives into buckets. With 30 bands of 5 values, a pair of
   similarity 0.8 shares no bucket with probability 7e-6.
3. In a bucket, every member is paired with three members only (smallest id, smallest and largest
   hash of the id).
4. Pairs are compared by batches of signature values. After each batch the posterior probability
   that the similarity reaches the threshold, given the matches so far (uniform prior), is held
   against the miss probability; pairs below it are pruned. Survivors are confirmed on full sets.
5. Links give components. Members of buckets that still hold several components are then paired
   across components by an exact prefix filter, checked the same way and joined. So every pair
   that shares a bucket is checked, already connected, or proven too far apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolens.llm.common import small, table
from hydrolens.llm.graph import components
from hydrolens.llm.shingles import ODD, Words, lean, mixed, pieces, shingle_sets
from hydrolens.sources.folders import RunFolder

BANDS, BAND_ROWS = 30, 5
HASHES = BANDS * BAND_ROWS
# Signature values compared before the posterior is looked at again.
BATCH = 25
MISS = 1e-6
PERCENT = 80
# Characters of text that a task works on at a time.
STEP_CHARS = 2_000_000
# Cells of the table by which rare shingles are told from frequent ones; any table gives right results.
CELLS = 1 << 18

DESCRIBED = "doc_id long, n_shingles long, set_a long, set_b long, signature binary"
SIGNATURE_SEED = 20


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SIGNATURE_SEED)
    return rng.integers(0, 2**32, HASHES, np.uint32), rng.integers(0, 2**31, HASHES, np.uint32) * np.uint32(2) + np.uint32(1)


def signatures(doc: np.ndarray, value: np.ndarray, texts: int) -> tuple[np.ndarray, ...]:
    """Set size, two set hashes and MinHash signature of each text; the hashes of a text without
    shingles are zero."""
    sizes = np.bincount(doc, minlength=texts)
    there = np.flatnonzero(sizes)
    starts = (np.cumsum(sizes) - sizes)[there]
    set_a, set_b = np.zeros(texts, np.uint64), np.zeros(texts, np.uint64)
    signature = np.zeros((texts, HASHES), np.uint32)
    if len(there):
        set_a[there] = np.add.reduceat(mixed(value), starts)
        set_b[there] = np.add.reduceat(mixed(value ^ ODD), starts)
        flips, factors = _permutations()
        short = (value >> np.uint64(32)).astype(np.uint32)
        for i in range(HASHES):
            signature[there, i] = np.minimum.reduceat((short ^ flips[i]) * factors[i], starts)
    return sizes, set_a.view(np.int64), set_b.view(np.int64), signature


def _describe(size: int, lower: bool):
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, chars=STEP_CHARS):
                doc, value = shingle_sets(Words(piece.column("text"), lower), size)
                sizes, set_a, set_b, signature = signatures(doc, value, piece.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sizes), pa.array(set_a), pa.array(set_b), pa.array([s.tobytes() for s in signature], pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "signature"],
                )

    return describe


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        signature = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS, BAND_ROWS).astype(np.uint64)
        key = np.arange(BANDS, dtype=np.uint64) + np.zeros((len(signature), 1), np.uint64)
        for i in range(BAND_ROWS):
            key = mixed(key * ODD + signature[:, :, i])
        doc = np.repeat(batch.column("doc_id").to_numpy(), BANDS)
        yield pa.RecordBatch.from_pydict({"bucket": key.ravel().view(np.int64), "doc_id": doc})


def least_matches(threshold: float, miss: float) -> dict[int, int]:
    """After so many compared values, the fewest matches that keep a pair. With a uniform prior,
    the posterior is a beta law whose upper tail is a binomial sum."""
    least = {}
    for n in [*range(BATCH, HASHES, BATCH), HASHES]:
        tail, matches = 0.0, 0
        while matches <= n:
            i = matches
            tail += math.exp(
                math.lgamma(n + 2) - math.lgamma(i + 1) - math.lgamma(n + 2 - i) + i * math.log(threshold) + (n + 1 - i) * math.log1p(-threshold)
            )
            if tail >= miss:
                break
            matches += 1
        least[n] = matches
    return least


def _verify(threshold: float, miss: float):
    least = least_matches(threshold, miss)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            alive, matches, done = np.arange(len(left)), np.zeros(len(left), np.int64), 0
            for n, fewest in least.items():
                matches[alive] += (left[alive, done:n] == right[alive, done:n]).sum(axis=1)
                alive, done = alive[matches[alive] >= fewest], n
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(alive)) for c in ("a", "b")], names=["a", "b"])

    return verify


def _sets(size: int, lower: bool):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, chars=STEP_CHARS):
                doc, value = shingle_sets(Words(piece.column("text"), lower), size)
                bounds = np.searchsorted(doc, np.arange(piece.num_rows + 1))
                rows = [value[a:b].tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(rows, pa.large_binary())], names=["doc_id", "shingles"])

    return sets


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    linked.append(False)
                    continue
                place = np.searchsorted(y, x)
                place[place == len(y)] = 0
                both = int((y[place] == x).sum())
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return confirm


class Linker:
    """Checks candidate pairs of representatives."""

    def __init__(self, docs: DataFrame, signed: DataFrame, run: RunFolder, size: int, lower: bool, percent: int, miss: float):
        self.docs, self.signed, self.run = docs, signed, run
        self.size, self.lower, self.percent, self.miss = size, lower, percent, miss

    def links(self, pairs: DataFrame, name: str) -> DataFrame:
        """Those of the stored pairs (a, b) whose full sets are similar enough."""
        sign = lambda side: self.signed.select(F.col("doc_id").alias(side), F.col("signature").alias(f"sig_{side}"))
        both = pairs.join(sign("a"), "a").join(sign("b"), "b")
        likely = self.run.keep(both.mapInArrow(lean(_verify(self.percent / 100, self.miss)), "a long, b long"), f"{name}_likely")
        ids = self.run.keep(
            likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct(), f"{name}_ids"
        )
        texts = self.docs.select("doc_id", "text").join(small(ids), "doc_id", "left_semi")
        sets = self.run.keep(texts.mapInArrow(lean(_sets(self.size, self.lower)), "doc_id long, shingles binary"), f"{name}_sets")
        full = lambda side: sets.select(F.col("doc_id").alias(side), F.col("shingles").alias(f"set_{side}"))
        confirmed = likely.join(full("b"), "b").join(full("a"), "a").mapInArrow(lean(_confirm(self.percent)), "a long, b long")
        return self.run.keep(confirmed, f"{name}_links")


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found = np.zeros(CELLS, np.int64)
    for batch in batches:
        for first in range(0, batch.num_rows, 500):
            values = np.frombuffer(b"".join(batch.column("shingles").slice(first, 500).to_pylist()), np.uint64)
            found += np.bincount((values & np.uint64(CELLS - 1)).astype(np.int64), minlength=CELLS)
    yield pa.RecordBatch.from_pydict({"cell": np.flatnonzero(found), "n": found[found > 0]})


def _prefixes(frequency: np.ndarray, percent: int):
    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, component, value in zip(batch.column("doc_id"), batch.column("component"), batch.column("shingles")):
                shingle = np.frombuffer(value.as_buffer(), np.uint64)
                n = len(shingle)
                order = np.lexsort((shingle, frequency[shingle & np.uint64(CELLS - 1)]))
                first = shingle[order[: n + (-percent * n // 100) + 1]]
                yield pa.RecordBatch.from_pydict(
                    {"shingle": first.view(np.int64), "place": np.arange(len(first)), "doc_id": np.full(len(first), doc.as_py()),
                     "component": np.full(len(first), component.as_py()), "n": np.full(len(first), n)}
                )

    return prefixes


def _across(docs: DataFrame, members: DataFrame, checked: DataFrame, run: RunFolder, size: int, lower: bool, percent: int) -> DataFrame:
    """Unchecked pairs of members of different components that can be similar enough, exactly.

    Shingles are put in one order, rare ones first. Two sets that are similar enough share a shingle
    among the first n - ceil(0.8 n) + 1 of each; and at the first that they share, what is left of
    both must suffice for the overlap they need. A member far from all others of its bucket starts
    with shingles of its own and so meets nobody. Where a shingle is shared by several components,
    members outside the largest of them meet the others."""
    members = run.keep(members, "apart_members")
    texts = docs.select("doc_id", "text").join(small(members.select("doc_id").distinct()), "doc_id", "left_semi")
    sets = texts.mapInArrow(lean(_sets(size, lower)), "doc_id long, shingles binary").join(members, "doc_id")
    sets = run.keep(sets, "apart_sets")
    counted = sets.select("shingles").mapInArrow(lean(_frequencies), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    frequency = np.zeros(CELLS, np.int64)
    counted = counted.toArrow()  # CELLS rows at most
    frequency[counted["cell"].to_numpy()] = counted["n"].to_numpy()
    first = run.keep(sets.mapInArrow(lean(_prefixes(frequency, percent)), "shingle long, place long, doc_id long, component long, n long"), "prefixes")
    largest = run.keep(
        first.groupBy("shingle", "component").agg(F.count("*").alias("size"))
        .groupBy("shingle").agg(F.max(F.struct("size", "component")).alias("top"), F.count("*").alias("components"))
        .where("components > 1").select("shingle", F.col("top.component").alias("largest")),
        "shared_prefixes",
    )
    met = run.keep(first.join(largest, "shingle"), "met_prefixes")
    left, right = met.where("component <> largest").alias("l"), met.alias("r")
    needed = F.lit(percent) * (F.col("l.n") + F.col("r.n")) / (100 + percent)
    across = left.join(
        right,
        (F.col("l.shingle") == F.col("r.shingle"))
        & (F.col("l.component") != F.col("r.component"))
        & ((F.col("r.component") == F.col("l.largest")) | (F.col("l.doc_id") < F.col("r.doc_id")))
        & (100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n"))
        & (F.least(F.col("l.n") - F.col("l.place"), F.col("r.n") - F.col("r.place")) >= needed - 1e-6),
    ).select(*_pair("l.doc_id", "r.doc_id"))
    return run.keep(across.distinct().join(checked, ["a", "b"], "left_anti"), "rest")


def _pair(x: str, y: str) -> list:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def near_duplicates(
    docs: DataFrame, run: RunFolder, size: int = 5, percent: int = PERCENT, lower: bool = True, miss: float = MISS
) -> DataFrame:
    """doc_id, n_shingles (set size), component_id (smallest doc_id reachable over links, itself
    included) and kept (doc_id = component_id), for every row.

    Texts without words (null included) and rows without doc_id are linked with nothing; the
    latter have a null component and are kept. Rows that repeat a doc_id get the component of
    their own text; classes that the same id stands for count as linked. An empty table gives an
    empty result; other columns are not read."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    described = run.keep(docs.mapInArrow(lean(_describe(size, lower)), DESCRIBED), "described")
    light = described.drop("signature")
    able = described.where("n_shingles > 0 and doc_id is not null")
    set_key = ["n_shingles", "set_a", "set_b"]
    classes = run.keep(able.groupBy(*set_key).agg(F.min("doc_id").alias("standing")), "classes")
    signed = run.keep(
        able.join(classes.select(*set_key, F.col("standing").alias("doc_id")), [*set_key, "doc_id"], "left_semi")
        .select("doc_id", "signature", "n_shingles"),
        "representatives",
    )
    buckets = run.keep(signed.select("doc_id", "signature").mapInArrow(lean(_bucket), "bucket long, doc_id long"), "buckets")
    # The same hash in all buckets: texts that share many buckets share their centres, not only members.
    by_hash = F.struct(F.xxhash64("doc_id"), "doc_id")
    centres = run.keep(
        buckets.groupBy("bucket")
        .agg(F.min("doc_id").alias("c1"), F.max("doc_id").alias("last"), F.min(by_hash).alias("low"), F.max(by_hash).alias("high"))
        .where("c1 < last")
        .select("bucket", "c1", F.col("low.doc_id").alias("c2"), F.col("high.doc_id").alias("c3")),
        "centres",
    )
    shared = run.keep(buckets.join(centres, "bucket"), "shared")
    star = shared.select("doc_id", F.explode(F.array_distinct(F.array("c1", "c2", "c3"))).alias("c")).where("doc_id <> c")
    pairs = run.keep(star.select(*_pair("doc_id", "c")).distinct(), "pairs")
    linker = Linker(docs, signed, run, size, lower, percent, miss)
    links = linker.links(pairs, "first")
    joined = components(links, run, "first")
    members = run.keep(
        shared.select("bucket", "doc_id").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id")),
        "members",
    )
    apart = members.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("bucket")
    apart = run.keep(members.join(apart, "bucket"), "apart")
    rest = _across(docs, apart.select("doc_id", "component").distinct(), pairs, run, size, lower, percent)
    more = linker.links(rest, "second")
    if not more.isEmpty():
        joined = components(links.union(more), run, "second")
    # From document to the one that stands for its class, and on to the component.
    standing = light.join(classes, set_key, "left")
    named = standing.join(joined.withColumnRenamed("node", "standing"), "standing", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "standing", "doc_id").alias("component_id")
    )
    return named.withColumn(
        "component_id", F.when(F.col("doc_id").isNull(), None).otherwise(F.col("component_id"))
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def distinct_documents(docs: DataFrame, run: RunFolder, **options) -> DataFrame:
    """The rows of the documents, all columns, that stand for their group: those with the smallest doc_id.
    Rows without words or without doc_id stay. Of rows that repeat both doc_id and text one stays;
    rows that share a doc_id otherwise stay or go together (they stay if one of them stands)."""
    with RunFolder(run.spark) as work:
        groups = run.keep(near_duplicates(docs, work, **options).select("doc_id", "kept"), "groups")
    by_id = groups.where("doc_id is not null").groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("rows"))
    by_id = run.keep(by_id.where("not kept or rows > 1"), "not_single")
    stay = docs.join(small(by_id.where("not kept").select("doc_id")), "doc_id", "left_anti")
    repeated = by_id.where("kept").select("doc_id")
    if not repeated.isEmpty():
        repeated = small(repeated)
        once = stay.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        stay = stay.join(repeated, "doc_id", "left_anti").unionByName(once)
    return stay.select(*[f"`{c}`" for c in docs.columns])


def document_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked by 2-word shingles at a similarity of 0.8 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), RunFolder(spark), size=2)
