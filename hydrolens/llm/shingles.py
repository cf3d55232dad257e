"""Words and word shingles of Arrow batches as 64-bit hashes, computed in whole arrays."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ODD = np.uint64(0x9E3779B97F4A7C15)
# Characters of text in a block.
PIECE_CHARS = 8_000_000


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose result bits all depend on all bits."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def word_hash(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def give_back() -> None:
    """Returns unused memory to the system: a worker may wait for its next task beside other work."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def lean(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task over the batches of a partition that gives its memory back at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


class Words:
    """The words (no ASCII white space inside) of each text of a batch; null has none.

    hashes  of every word, in order    doc  index of its text    sizes  words per text
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        parts = pc.ascii_split_whitespace(texts)
        coded = pc.dictionary_encode(parts.flatten())
        self.dictionary = coded.dictionary.cast(pa.large_binary()).to_pylist()
        codes = coded.indices.to_numpy()
        if lower and self.dictionary:  # bytes.lower changes A-Z only
            at: dict[bytes, int] = {}
            codes = np.array([at.setdefault(w.lower(), len(at)) for w in self.dictionary])[codes]
            self.dictionary = list(at)
        offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        doc = np.repeat(np.arange(len(texts)), np.diff(offsets))
        if b"" in self.dictionary:  # before leading and after trailing white space
            there = codes != self.dictionary.index(b"")
            codes, doc = codes[there], doc[there]
        self.codes, self.doc = codes, doc
        self.sizes = np.bincount(doc, minlength=len(texts))
        self.firsts = np.cumsum(self.sizes) - self.sizes
        known = word_hash(self.dictionary)
        self.hashes = known[codes] if len(codes) else np.zeros(0, np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of each window of consecutive words of one text, and its hash."""
        count = len(self.hashes) - size + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        value = np.zeros(count, np.uint64)
        for i in range(size):
            value = value * ODD + self.hashes[i : i + count]
        place = np.flatnonzero(self.doc[:count] == self.doc[size - 1 :])
        return place, mixed(value[place])


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: index of the text and hash. A text of fewer words,
    but not none, has its whole sequence as the one shingle."""
    place, value = words.windows(size)
    doc = words.doc[place] if len(place) else np.zeros(0, np.int64)
    short = np.flatnonzero((words.sizes > 0) & (words.sizes < size))
    if len(short):
        whole = np.zeros(len(short), np.uint64)
        left = words.sizes[short]
        for i in range(int(left.max())):
            going = i < left
            whole[going] = whole[going] * ODD + words.hashes[words.firsts[short[going]] + i]
        # The length keeps a short sequence apart from every full shingle.
        whole = mixed(whole + mixed(left.astype(np.uint64)))
        doc, value = np.concatenate([doc, short]), np.concatenate([value, whole])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def pieces(batch: pa.RecordBatch, column: str = "text", chars: int | None = None) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded text size; a longer text is a slice of its own."""
    chars = chars or PIECE_CHARS
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy()
    upto = np.cumsum(lengths)
    first = 0
    while first < batch.num_rows:
        done = upto[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(upto, done + chars, "right")))
        yield batch.slice(first, last - first)
        first = last


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for piece in pieces(batch):
            yield pa.RecordBatch.from_arrays(
                [pa.array([number]), pa.array([piece.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([piece.column(1).to_pylist()], pa.list_(pa.string()))],
                names=["block", "doc_ids", "texts"],
            )
            number += 1


def blocks_of(docs: DataFrame) -> DataFrame:
    """The documents in blocks of bounded text size, one row each: block, doc_ids, texts."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return whole.mapInArrow(lean(_cut), "block long, doc_ids array<long>, texts array<string>")
