"""Ranked lexical search over bags.

Documents are restricted to the vocabulary of the items that are searched for. What is left of a
document, the counts of those terms (its bag) and the length measure m, is all that its scores
depend on; documents that agree in both form a class. Classes are found by a hash and told apart by
the bags themselves, each is scored once, and the best classes are expanded into their members by
ascending doc_id.

Integers only, but for the logarithm in a term's weight. A class is scored against all items at once
from the items' term lists, which go with the tasks: items are taken in chunks of bounded size, and a
larger set of items means more passes, not larger tasks. Each task keeps the `TOP` best documents per
item, so what is ranked at the end is a few rows per item and task.

Only the `TOP` smallest ids of a class can appear in any ranking, so no more travel: a window keeps them in
the map tasks. A class of more than `HOT` rows is first reduced in `SALTS` parts, then as a whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import in_order, lower_ascii, small, table, words
from hydrolens.llm.shingles import lean, pieces
from hydrolens.sources.folders import RunFolder

# Lower-cased texts: digits, a-z and all characters outside ASCII.
TERM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same byte by byte: A-Z become a-z, all else below 128 but digits and letters a blank.
BYTES = bytes(b if b >= 128 or chr(b).isdigit() or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

TOP = 50
# Items of one pass, and (item, term) entries of one pass unless a single item has more.
CHUNK_ITEMS, CHUNK_ENTRIES = 256, 1_000_000
# Rows of a class from which it is reduced in parts, and the parts.
HOT, SALTS = 10_000, 64
# Sums that a task forms at a time.
SUMS = 4_000_000
BAG = "doc_id long, n long, ids array<int>, counts array<int>"


def item_terms(items: DataFrame, run: RunFolder) -> DataFrame:
    """item (a number per row), item_id and the distinct terms of the items that have any."""
    terms = F.array_distinct(words(lower_ascii(F.col("text").cast("string")), TERM))
    split = items.select("item_id", terms.alias("terms")).where(F.size("terms") > 0)
    numbered = in_order(split.withColumn("_by", F.xxhash64("terms")), ["_by"], run, "items")
    return run.keep(numbered.select(F.col("slot").alias("item"), "item_id", "terms"), "item_terms")


def chunks(items: DataFrame) -> list[DataFrame]:
    """The items in parts of bounded size."""
    chunk = F.floor(F.col("item") / CHUNK_ITEMS)
    sizes = items.groupBy(chunk.alias("chunk")).agg(F.sum(F.size("terms")).alias("n"), F.min("item").alias("first"), F.max("item").alias("last"))
    parts = []
    for r in sorted(sizes.collect()):
        step = CHUNK_ITEMS if r.n <= CHUNK_ENTRIES else 1
        parts += [items.where(F.col("item").between(i, min(i + step - 1, r.last))) for i in range(r.first, r.last + 1, step)]
    return parts


@dataclass
class Queries:
    """Items of one pass: their terms by number, and the items of each term (bounds into `items`)."""

    numbers: list[int]
    vocabulary: dict[bytes, int]
    bounds: np.ndarray
    items: np.ndarray

    @classmethod
    def of(cls, chunk: DataFrame) -> Queries:
        rows = sorted((r.item, r.terms) for r in chunk.collect())
        vocabulary: dict[bytes, int] = {}
        pairs = [(vocabulary.setdefault(t.encode(), len(vocabulary)), i) for i, (_, terms) in enumerate(rows) for t in terms]
        found = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        return cls([n for n, _ in rows], vocabulary, np.searchsorted(found[:, 0], np.arange(len(vocabulary) + 1)), found[:, 1])


def split_terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Of every term in order: its text and its place in the list of distinct terms."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data is not None else b""
    blank = pa.LargeStringArray.from_buffers(len(texts), pa.py_buffer((offsets - offsets[0]).tobytes()), pa.py_buffer(data.translate(BYTES)))
    parts = pc.split_pattern(blank, " ")
    coded = pc.dictionary_encode(parts.flatten())
    known = coded.dictionary.cast(pa.large_binary()).to_pylist()
    codes = coded.indices.to_numpy()
    doc = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))
    if b"" in known:  # between neighbouring blanks
        there = codes != known.index(b"")
        codes, doc = codes[there], doc[there]
    return doc, codes, known


def _bags(vocabulary: dict[bytes, int]):
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch):
                doc, codes, known = split_terms(piece.column("text"))
                n = np.bincount(doc, minlength=piece.num_rows)
                number = np.array([vocabulary.get(term, -1) for term in known], np.int64)
                ids = number[codes] if len(codes) else np.zeros(0, np.int64)
                pair, count = np.unique((doc[ids >= 0] << 32) | ids[ids >= 0], return_counts=True)
                bounds = pa.array(np.searchsorted(pair >> 32, np.arange(piece.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id"),
                        pa.array(n, pa.int64()),
                        pa.ListArray.from_arrays(bounds, pa.array(pair & 0xFFFFFFFF, pa.int32())),
                        pa.ListArray.from_arrays(bounds, pa.array(count, pa.int32())),
                    ],
                    names=["doc_id", "n", "ids", "counts"],
                )

    return bags


def weights(bags: DataFrame, size: int, texts: int) -> np.ndarray:
    """Per term of the vocabulary, from the number of documents that hold it."""
    held = np.zeros(size, np.int64)
    for r in bags.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n")).collect():
        held[r.id] = r.n
    return np.array([math.floor(1000 * math.log((2 * texts + 2) / (2 * int(n) + 1))) for n in held], np.int64)


def classes_of(bags: DataFrame, top: int) -> DataFrame:
    """m, ids, counts and members (the smallest doc_ids, null last, at most `top`) of each class."""
    key = ["m", "ids", "counts"]
    hashed = bags.select(F.xxhash64(*key).alias("h"), *key, "doc_id")
    hot = hashed.groupBy("h").agg(F.count("*").alias("rows")).where(F.col("rows") > HOT).select("h")
    hot = small(hot)

    def smallest(rows: DataFrame, *by: str) -> DataFrame:
        order = Window.partitionBy("h", *key, *by).orderBy(F.col("doc_id").asc_nulls_last())
        return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    parts = hashed.join(hot, "h", "left_semi").withColumn("salt", F.spark_partition_id() % SALTS)
    reduced = smallest(parts, "salt").select(hashed.columns)
    together = hashed.join(hot, "h", "left_anti").unionByName(reduced)
    members = F.array_sort(F.collect_list(F.struct("rank", "doc_id")))
    return smallest(together).groupBy("h", *key).agg(members.alias("members")).select(*key, F.col("members.doc_id").alias("members"))


def _best(queries: Queries, weight: np.ndarray, top: int):
    """The best documents of the classes of a task: item, doc_id, score."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_items = len(queries.numbers)
        many = np.diff(queries.bounds)
        least = np.ones(n_items, np.int64)  # lower scores are of no use
        found: list[list] = [[] for _ in range(n_items)]

        def scores(first: int, last: int, bounds, ids, counts, m) -> np.ndarray:
            """Of the classes first to last, against every item."""
            at = slice(bounds[first], bounds[last])
            tf, own = counts[at], np.repeat(np.arange(last - first), np.diff(bounds[first : last + 1]))
            part = weight[ids[at]] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[first + own]))
            often = many[ids[at]]
            begins = np.cumsum(often) - often
            entry = np.arange(often.sum()) - np.repeat(begins - queries.bounds[ids[at]], often)
            total = np.zeros((last - first) * n_items, np.int64)
            np.add.at(total, np.repeat(own * n_items, often) + queries.items[entry], np.repeat(part, often))
            return total.reshape(last - first, n_items)

        for batch in batches:
            ids, counts, m = [batch.column(c) for c in ("ids", "counts", "m")]
            members = batch.column("members")
            bounds = ids.offsets.to_numpy().astype(np.int64)
            bounds, flat = bounds - bounds[0], ids.flatten().to_numpy().astype(np.int64)
            counts, m = counts.flatten().to_numpy().astype(np.int64), m.to_numpy()
            # Classes whose sums fit in a step.
            sums = np.concatenate([[0], np.cumsum(many[flat])])[bounds] + np.arange(len(bounds)) * n_items
            first = 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(sums, sums[first] + SUMS, "right")) - 1)
                total = scores(first, last, bounds, flat, counts, m)
                bound = least
                if last - first > top:
                    bound = np.maximum(least, np.partition(total, last - first - top, axis=0)[last - first - top])
                rows, columns = np.nonzero(total >= bound)
                new: dict[int, list] = {}
                for row, item in zip(rows.tolist(), columns.tolist()):
                    score = int(total[row, item])
                    new.setdefault(item, []).extend((-score, i is None, i) for i in members[first + row].as_py())
                for item, more in new.items():
                    found[item] = sorted(found[item] + more, key=lambda r: (r[0], r[1], r[2] or 0))[:top]
                    if len(found[item]) == top:
                        least[item] = -found[item][-1][0]
                first = last
        rows = [(queries.numbers[item], doc_id, -score) for item in range(n_items) for score, _, doc_id in found[item]]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return best


def _searched(docs: DataFrame, chunk: DataFrame, top: int, run: RunFolder, name: str) -> DataFrame | None:
    queries = Queries.of(chunk)
    bags = run.keep(docs.mapInArrow(lean(_bags(queries.vocabulary)), BAG), name)
    texts, length = bags.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    if not texts:
        return None
    weight = weights(bags, len(queries.vocabulary), texts)
    known = bags.where(F.size("ids") > 0).withColumn("m", F.expr(f"50L + (50L * n * {texts}L) div {length}L")).drop("n")
    return classes_of(known, top).mapInArrow(lean(_best(queries, weight, top)), "item long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, run: RunFolder, top: int = TOP) -> DataFrame:
    """item_id, rank (from 1), doc_id and score: per row of the items the `top` documents with the highest
    score above 0, equal scores by ascending doc_id (null last).

    Every row of either table counts, also if it repeats another or has no id. Null and empty texts have no
    terms: as a document they count nowhere, as an item they find nothing. Empty tables give an empty
    result; other columns are not read. The distinct terms of one item have to fit in a task."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = item_terms(items.select("item_id", "text"), run)
    found = None
    for i, chunk in enumerate(chunks(listed)):
        part = _searched(docs, chunk, top, run, f"bags_{i}")
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        none = [F.lit(None).cast(kind).alias(name) for name, kind in (("rank", "int"), ("doc_id", "long"), ("score", "long"))]
        return items.select("item_id", *none).limit(0)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(small(listed.select("item", "item_id")), "item").select("item_id", "rank", "doc_id", "score")


def benchmark_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents ranked for each benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), RunFolder(spark))


SEARCH_SQL = r"""
with doc_terms as (
  select row_number() over () as doc, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents
), item_terms as (
  select row_number() over () as item, item_id,
    list_distinct(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) as w
  from benchmark
), totals as (
  select count(*) as N, sum(len(w))::bigint as L from doc_terms where len(w) > 0
), tf as (
  select doc, term, count(*) as tf from (select doc, unnest(w) as term from doc_terms) group by all
), weight as (
  select term, floor(1000 * ln((2.0::double * N + 2) / (2 * df + 1)))::bigint as w
  from (select term, count(*) as df from tf group by term), totals
), measure as (
  select doc, doc_id, 100 - 50 + ((50 * len(w) * N) // L) as m from doc_terms, totals where len(w) > 0
), scored as (
  select item, item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::bigint as score
  from (select item, item_id, unnest(w) as term from item_terms) join tf using (term) join weight using (term) join measure using (doc)
  group by item, item_id, doc, doc_id
), ranked as (
  select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from scored where score > 0
)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 50
"""
