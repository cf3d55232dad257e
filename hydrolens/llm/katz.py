"""Language-model scores: a Katz back-off model of any order.

Counts up to 5 are discounted by Good-Turing, for each order by itself. What the discounts
free under a history goes to the words that never followed it, in proportion to their probabilities
under the history without its first word; the back-off weight of each history is computed from its full
list of followers, so that all words and the unknown word add up to one exactly.

    P(w | h) = d(c(h, w)) c(h, w) / c(h)     if h w occurs in training
             = a(h) P(w | h')                else, h' being h without its first word,
                                             with a(h) = 1 for a history that never occurs
    P(w)     = d(c(w)) c(w) / N              and what is left for the unknown word

Before a document stand as many end tokens as the order needs.

Stored tables: blocks of documents (bucketed by block); word counts (by hash of the word); for each
order the counts of its grams (bucketed by history, one segment per block). A block sends its distinct words
and grams, packed, and gets counts, totals and back-off weights back, so its texts never move. Words are known
by 64-bit hashes until the word table numbers them; a gram is numbered in its bucket, and its number stands
for the history in the next order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolens.llm.common import bucketed, table
from hydrolens.llm.shingles import Words, blocks_of, lean, word_hash
from hydrolens.sources.folders import RunFolder

MODULUS, HELD_OUT = 7, 2
ORDER = 2
DISCOUNTED = 5
END = b""
# The number of the history of a document's first token, from order three on.
START = 0


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, in as few bytes as the largest needs, byte planes apart, compressed."""
    import zstandard

    values = np.asarray(values, np.uint64)
    width = max(1, (int(values.max(initial=0)).bit_length() + 7) // 8)
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(data: bytes) -> np.ndarray:
    import zstandard

    width = data[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8).reshape(width, -1)
    values = np.zeros((planes.shape[1], 8), np.uint8)
    values[:, :width] = planes.T
    return values.view(np.uint64).ravel().astype(np.int64)


def discounts(of: dict[int, int]) -> np.ndarray:
    """d(0..5) from the number of types that occur r times, r = 1..6. Where the Good-Turing estimate
    does not exist or is no discount, half a count is taken off."""
    n = [0] + [of.get(r, 0) for r in range(1, DISCOUNTED + 2)]
    out = np.ones(DISCOUNTED + 1)
    for r in range(1, DISCOUNTED + 1):
        out[r] = (r - 0.5) / r
        if n[1] and n[r] and n[r + 1] and n[1] > (over := (DISCOUNTED + 1) * n[DISCOUNTED + 1]):
            share = over / n[1]
            value = ((r + 1) * n[r + 1] / n[r] / r - share) / (1 - share)
            if 0 < value < 1:
                out[r] = value
    return out


def discounted(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    """d(c) c"""
    return counts * np.where(counts <= DISCOUNTED, d[np.minimum(counts, DISCOUNTED)], 1.0)


class Unigrams:
    """P(w) by the training count of w; count 0 is the unknown word."""

    def __init__(self, tokens: int, types: int, of: dict[int, int]):
        self.tokens, self.types, self.d = tokens, types, discounts(of)
        freed = sum((1 - self.d[r]) * r * of.get(r, 0) for r in range(1, DISCOUNTED + 1))
        # Without rare words nothing is freed: the unknown word then gets one count more.
        self.total = tokens + 1.0 if freed <= 0 else float(tokens)
        self.unknown = (freed if freed > 0 else 1.0) / self.total if tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.d) / max(self.total, 1.0), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 1) / (self.tokens + 1 * (self.types + 1)))


def held_out(doc_ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % MODULUS == HELD_OUT for i in doc_ids], bool)


class Block:
    """The tokens of a block: codes of its distinct words, each document closed by the end token."""

    def __init__(self, doc_ids: pa.Array, texts: pa.Array, buckets: int):
        self.doc_ids = doc_ids
        words = Words(texts, lower=True)
        dictionary = words.dictionary if END in words.dictionary else [*words.dictionary, END]
        end = dictionary.index(END)
        ends = words.firsts + words.sizes
        self.tokens = np.insert(words.codes.astype(np.int64), ends, end)
        self.sizes = words.sizes + 1
        self.before = np.concatenate([[end], self.tokens[:-1]])
        self.held_out = held_out(doc_ids.to_pylist())
        self.in_training = np.repeat(~self.held_out, self.sizes)
        self.types = len(dictionary)
        self.hashes = word_hash(dictionary)
        self.buckets = buckets
        self.bucket_of_word = (self.hashes % np.uint64(buckets)).astype(np.int64)
        self.word_order = np.lexsort((self.hashes, self.bucket_of_word))
        self.bounds = np.searchsorted(self.bucket_of_word[self.word_order], np.arange(buckets + 1))

    def words(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per bucket: hashes of the distinct words and their counts in training documents."""
        counts = np.bincount(self.tokens[self.in_training], minlength=self.types)
        for b in range(self.buckets):
            if len(chosen := self.word_order[self.bounds[b] : self.bounds[b + 1]]):
                yield b, self.hashes[chosen], counts[chosen]

    def learn(self, rows: dict[int, tuple[bytes, bytes]]) -> None:
        """Takes the number and the training count of each word."""
        self.number, self.count = np.zeros(self.types, np.int64), np.zeros(self.types, np.int64)
        for b, (numbers, counts) in rows.items():
            chosen = self.word_order[self.bounds[b] : self.bounds[b + 1]]
            self.number[chosen], self.count[chosen] = unpack(numbers), unpack(counts)

    def begin(self, words: dict[int, tuple[bytes, bytes]], unigrams: Unigrams) -> None:
        """Takes what the word table says; `value` is log10 P(token) from here on."""
        self.learn(words)
        self.value = np.log10(unigrams.probability(self.count))[self.tokens]
        self.order = 1

    def grams(self) -> None:
        """Distinct grams of the next order in the order of bucket, history and word; place of each token's gram."""
        self.order += 1
        if self.order == 2:
            numbers, codes = self.number, self.before
        else:
            numbers, codes = np.unique(self.following, return_inverse=True)
        unique, place = np.unique(codes * self.types + self.tokens, return_inverse=True)
        history, word = numbers[unique // self.types], unique % self.types
        bucket = bucket_of_history(history, self.order, self.buckets)
        order = np.lexsort((self.number[word], history, bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.place = rank[place]
        self.history, self.word = history[order], word[order]
        self.gram_bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        # A gram fixes the gram of the order below, so any of its tokens tells that one's probability.
        some = np.empty(len(order), np.int64)
        some[self.place] = np.arange(len(self.tokens))
        self.lower = self.value[some]

    def take(self, rows: dict[int, tuple[bytes, bytes, bytes, bytes | None]], d: np.ndarray) -> None:
        """Takes what the buckets say on the grams: `value` is log10 P(token | history) of this order then."""
        found, numbers = np.zeros(len(self.word)), np.zeros(len(self.word), np.int64)
        for b, (gram_counts, totals, weights, given) in rows.items():
            part = slice(self.gram_bounds[b], self.gram_bounds[b + 1])
            counts, total = unpack(gram_counts), unpack(totals)
            starts = _starts(self.history[part])
            weight = np.zeros(len(starts))
            weight[np.logical_or.reduceat(counts == 0, starts)] = np.frombuffer(weights)
            each = np.diff(np.append(starts, len(counts)))
            seen = np.maximum(discounted(counts, d), 1e-300) / np.maximum(np.repeat(total, each), 1)
            found[part] = np.where(counts > 0, np.log10(seen), np.repeat(weight, each) + self.lower[part])
            if given is not None:
                numbers[part] = np.cumsum(unpack(given))
        self.value = found[self.place]
        self.following = np.concatenate([[START], numbers[self.place][:-1]])
        self.following[np.cumsum(self.sizes) - self.sizes] = START


def bucket_of_history(numbers: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Words are numbered in turn over the buckets. A gram's number ends in its own bucket, so grams are dealt
    by the rest of it: the followers of one frequent history then lie in all buckets."""
    return numbers % buckets if order == 2 else numbers // buckets % buckets


def _blocks(rows: pa.RecordBatch | pa.Table, buckets: int) -> Iterator[tuple[int, Block]]:
    numbers, ids, texts = (rows.column(c) for c in ("block", "doc_ids", "texts"))
    for i in range(rows.num_rows):
        yield numbers[i].as_py(), Block(ids[i].values, texts[i].values, buckets)


def _send_words(buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _blocks(batch, buckets):
                rows = [(b, number, hashes.tobytes(), pack(counts)) for b, hashes, counts in block.words()]
                yield pa.RecordBatch.from_pydict(
                    {n: [r[i] for r in rows] for i, n in enumerate(("bucket", "block", "hashes", "counts"))},
                    schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary()), ("counts", pa.binary())]),
                )

    return send


WORD_ROWS = "bucket int, block long, hashes binary, numbers binary, counts binary"


def _number_words(buckets: int):
    def number(rows: pd.DataFrame) -> pd.DataFrame:
        """Sums the counts of the words of a bucket and numbers them, frequent ones first. One row
        per block, and one for the table itself (block null)."""
        bucket = int(rows["bucket"].iloc[0])
        hashes = [np.frombuffer(h, np.uint64) for h in rows["hashes"]]
        known, place = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(place, weights=np.concatenate([unpack(c) for c in rows["counts"]]), minlength=len(known)).astype(np.int64)
        numbers = np.empty(len(known), np.int64)
        numbers[np.argsort(-counts, kind="stable")] = np.arange(len(known)) * buckets + bucket
        bounds = np.cumsum([0, *map(len, hashes)])
        out = [
            (bucket, block, None, pack(numbers[place[a:b]]), pack(counts[place[a:b]]))
            for block, a, b in zip(rows["block"], bounds, bounds[1:])
        ]
        out.append((bucket, None, known.tobytes(), pack(numbers), pack(counts)))
        return pd.DataFrame(out, columns=["bucket", "block", "hashes", "numbers", "counts"]).astype({"block": "Int64"})

    return number


def _frequencies(counts: np.ndarray) -> list[tuple[int, int]]:
    """(r, types that occur r times) for r = 1..6, (0, types), (-1, tokens)."""
    counts = counts[counts > 0]
    few = np.bincount(counts[counts <= DISCOUNTED + 1], minlength=DISCOUNTED + 2)
    return [(-1, int(counts.sum())), (0, len(counts)), *((r, int(few[r])) for r in range(1, DISCOUNTED + 2))]


def _word_frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [f for counts in batch.column("counts").to_pylist() for f in _frequencies(unpack(counts))]
        yield pa.RecordBatch.from_pydict({"r": [f[0] for f in found], "n": [f[1] for f in found]}, schema=pa.schema([("r", pa.int32()), ("n", pa.int64())]))


GRAM_ROWS = pa.schema(
    [("bucket", pa.int32()), ("block", pa.int64())]
    + [(n, pa.binary()) for n in ("histories", "words", "numbers", "word_counts", "counts", "lower")]
)
GRAMS = "bucket int, block long, histories binary, words binary, numbers binary, word_counts binary, counts binary, lower binary"
FOUND = "order int, bucket int, block long, gram_counts binary, totals binary, weights binary, given binary"


def _climb(block: Block, found: pa.Table, unigrams: Unigrams, steps: list[np.ndarray]) -> None:
    """Takes the answers to the words and then to each order that the steps hold discounts of."""
    order = np.array(found["order"].fill_null(1).to_numpy())
    columns = ("bucket", "numbers", "counts"), ("bucket", "gram_counts", "totals", "weights", "given")
    told = lambda k: found.filter(pa.array(order == k)).select(columns[k > 1])
    rows = lambda k: {b: tuple(x) for b, *x in zip(*(c.to_pylist() for c in told(k).columns))}
    block.begin(rows(1), unigrams)
    for k, d in enumerate(steps, 2):
        block.grams()
        block.take(rows(k), d)


def _send_grams(buckets: int, unigrams: Unigrams, steps: list[np.ndarray]):
    def send(rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for number, block in _blocks(rows, buckets):
            _climb(block, found, unigrams, steps)
            block.grams()
            trained = np.bincount(block.place[block.in_training], minlength=len(block.word))
            for b in range(buckets):
                part = slice(block.gram_bounds[b], block.gram_bounds[b + 1])
                history, word = block.history[part], block.word[part]
                if len(word):
                    # The words of the segment in the order of their numbers: counts fall, gaps are small.
                    numbers, first, codes = np.unique(block.number[word], return_index=True, return_inverse=True)
                    # Probabilities of single words follow from their counts, those of longer grams are sent.
                    counts = pack(block.count[word[first]]) if block.order == 2 else None
                    lower = None if block.order == 2 else block.lower[part].tobytes()
                    out.append((b, number, pack(np.diff(history, prepend=0)), pack(codes), pack(np.diff(numbers, prepend=0)), counts, pack(trained[part]), lower))
        return pa.Table.from_pydict({n: [r[i] for r in out] for i, n in enumerate(GRAM_ROWS.names)}, schema=GRAM_ROWS)

    return send


class Segments:
    """The grams of one order and bucket, merged from the segments of all blocks."""

    def __init__(self, rows: pd.DataFrame):
        numbers = [np.cumsum(unpack(n)) for n in rows["numbers"]]
        codes = [unpack(c) for c in rows["words"]]
        word = np.concatenate([n[c] for n, c in zip(numbers, codes)])
        self.of_words = rows["word_counts"].notna().all()
        if self.of_words:
            lower = np.concatenate([unpack(n)[c] for n, c in zip(rows["word_counts"], codes)])
        else:
            lower = np.concatenate([np.frombuffer(x) for x in rows["lower"]])
        history = np.concatenate([np.cumsum(unpack(h)) for h in rows["histories"]])
        trained = np.concatenate([unpack(c) for c in rows["counts"]])
        self.bounds = np.cumsum([0, *map(len, codes)])
        order = np.lexsort((word, history))
        history, word = history[order], word[order]
        new = np.concatenate([[True], (history[1:] != history[:-1]) | (word[1:] != word[:-1])])
        starts = np.flatnonzero(new)
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.counts = np.add.reduceat(trained[order], starts)
        self.history, self.word = history[new], word[new]
        self.lower = lower[order][new]

    def histories(self, unigrams: Unigrams, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Group of each distinct gram by history; per group what its counts are divided by (0 for a
        history that training does not have), and log10 of its back-off weight."""
        first = np.concatenate([[True], self.history[1:] != self.history[:-1]])
        group = np.cumsum(first) - 1
        total = np.bincount(group, weights=self.counts)
        freed = np.bincount(group, weights=self.counts - discounted(self.counts, d))
        lower = unigrams.probability(self.lower) if self.of_words else 10.0**self.lower
        others = 1 - np.bincount(group, weights=np.where(self.counts > 0, lower, 0.0))
        least = unigrams.unknown if self.of_words else 1e-15
        # A history whose followers are all frequent frees nothing: one count more is given away.
        none = (freed <= 0) & (total > 0)
        freed = np.where(none, 1.0, freed)
        total = np.where(none, total + 1, total)
        with np.errstate(divide="ignore", invalid="ignore"):
            weight = np.where(total > 0, freed / (total * np.maximum(others, least)), 1.0)
            return group, total, np.log10(weight)


def _gram_frequencies(rows: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame(_frequencies(Segments(rows).counts), columns=["r", "n"])


def _starts(history: np.ndarray) -> np.ndarray:
    """First places of the histories of a segment, which is sorted by them."""
    return np.flatnonzero(np.concatenate([[True], history[1:] != history[:-1]]))


def _evaluate(order: int, buckets: int, unigrams: Unigrams, d: np.ndarray, last: bool):
    def evaluate(rows: pd.DataFrame) -> pd.DataFrame:
        """What each block needs for its grams: their counts, the totals of their histories, the back-off weights
        of those histories that have a gram without count, and, below the last order, the grams' numbers."""
        segments = Segments(rows)
        group, total, weight = segments.histories(unigrams, d)
        out = []
        for block, bucket, a, b in zip(rows["block"], rows["bucket"], segments.bounds, segments.bounds[1:]):
            place = segments.place[a:b]
            counts, here = segments.counts[place], group[place]
            starts = _starts(here)
            back_off = here[starts][np.logical_or.reduceat(counts == 0, starts)]
            given = None if last else pack(np.diff(START + 1 + place * buckets + bucket, prepend=0))
            out.append((order, int(bucket), int(block), pack(counts), pack(total[here[starts]]), weight[back_off].tobytes(), given))
        return pd.DataFrame(out, columns=["order", "bucket", "block", "gram_counts", "totals", "weights", "given"])

    return evaluate


SCORES = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]
)


def _score(buckets: int, unigrams: Unigrams, steps: list[np.ndarray]):
    def score(rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for _, block in _blocks(rows, buckets):
            _climb(block, found, unigrams, steps)
            counts = block.count[block.tokens]
            starts = np.cumsum(block.sizes) - block.sizes
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        block.doc_ids, pa.array(block.held_out), pa.array(block.sizes.astype(np.int64)),
                        pa.array(np.add.reduceat((counts > 0).astype(np.int64), starts)),
                        pa.array(np.full(len(starts), unigrams.tokens, np.int64)),
                        pa.array(np.add.reduceat(unigrams.base(counts), starts)),
                        pa.array(np.add.reduceat(block.value, starts)),
                    ],
                    schema=SCORES,
                )
            )
        return pa.Table.from_batches(out, schema=SCORES)

    return score


def _totals(df: DataFrame) -> dict[int, int]:
    """Eight numbers: tokens, types and the types of each small count."""
    return {r.r: r.n for r in df.groupBy("r").agg(F.sum("n").alias("n")).collect()}


def scores(docs: DataFrame, run: RunFolder, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row, under the model of
    the given order (1: single words).

    The model learns from the rows whose crc32 of the id as text, modulo 7, is not 2 (a null id counts
    as empty text, so it teaches), as often as they are repeated. Null and empty texts consist of the end
    token alone. Without training rows every token is unknown and has probability one. Other
    columns are not read; an empty table gives an empty result."""
    if order < 1:
        raise ValueError(f"order {order} is less than 1")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = bucketed(blocks_of(docs), "block", run, "blocks")
    sent = blocks.mapInArrow(lean(_send_words(buckets)), "bucket int, block long, hashes binary, counts binary")
    words = run.keep(sent.groupBy("bucket").applyInPandas(_number_words(buckets), WORD_ROWS), "words")
    of_words = _totals(words.where("block is null").select("counts").mapInArrow(lean(_word_frequencies), "r int, n long"))
    unigrams = Unigrams(of_words.get(-1, 0), of_words.get(0, 0), of_words)
    told = words.where("block is not null").drop("hashes").withColumn("order", F.lit(1))
    told = told.select("*", *[F.lit(None).cast("binary").alias(c) for c in ("gram_counts", "totals", "weights", "given")])
    steps: list[np.ndarray] = []
    for k in range(2, order + 1):
        sent = blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(_send_grams(buckets, unigrams, list(steps)), GRAMS)
        grams = bucketed(sent.repartition(buckets, "bucket"), "bucket", run, f"grams{k}")
        steps.append(discounts(_totals(grams.groupBy("bucket").applyInPandas(_gram_frequencies, "r int, n long"))))
        found = grams.groupBy("bucket").applyInPandas(_evaluate(k, buckets, unigrams, steps[-1], k == order), FOUND)
        # The answers of the last order are read once, those of the others by every later order.
        told = told.unionByName(found if k == order else run.keep(found, f"found{k}"), allowMissingColumns=True)
    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        _score(buckets, unigrams, steps),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def document_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"), RunFolder(spark))
