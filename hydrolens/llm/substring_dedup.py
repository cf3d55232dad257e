"""Removal of repeated passages through difference-cover anchors.

A difference cover D modulo v has, for any two numbers i and j, a shift below v that brings both
into D. So if short windows are hashed only at word positions that lie in D modulo v, any two
places with the same long window share such an anchor at the same offset. Windows of 13 words:
v = 7, D = {0, 1, 3}, anchors of 7 words at three positions of seven.

1. Documents are cut into blocks, stored once and bucketed by block.
2. Each block sends the hashes of its anchors to hash buckets, which send back those found in more
   than one document. 32 bits per bucket are kept: a chance agreement costs work, not correctness.
3. Only windows around a shared anchor are extended to full length; their 128-bit hashes go to hash
   buckets with the smallest doc_id of the block, and the smallest of all comes back where it
   matters.
4. Each block removes the words covered by windows that a smaller doc_id has too.

What is sent is distinct per block, so a passage in any number of documents is one entry per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hydrolens.llm.common import bucketed, table
from hydrolens.llm.shingles import Words, blocks_of, lean, mixed
from hydrolens.sources.folders import RunFolder

WINDOW = 13
# Period and positions of known perfect difference covers.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 3, 4, 9, 11)}
# Rows without doc_id stand behind all others.
LAST = np.iinfo(np.int64).max
SECOND = np.uint64(0xD6E8FEB86659FD93)


def cover_of(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of more than half the window."""
    period = max(v for v in COVERS if 2 * (window - v + 1) >= window)
    return period, COVERS[period]


class Block:
    def __init__(self, doc_ids: pa.Array, texts: pa.Array, window: int):
        self.doc_ids = doc_ids
        self.window = window
        self.words = Words(texts)
        ids = doc_ids.fill_null(LAST).to_numpy()
        self.id_of_word = ids[self.words.doc]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places and hashes of the anchors of all documents that have a window."""
        period, cover = cover_of(self.window)
        place, value = self.words.windows(self.window - period + 1)
        doc = self.words.doc[place]
        position = (place - self.words.firsts[doc]) % period
        chosen = np.isin(position, cover) & (self.words.sizes[doc] >= self.window)
        return place[chosen], value[chosen]

    def windows(self, near: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and two hashes of the windows that hold an anchor at one of the places."""
        period, _ = cover_of(self.window)
        place, value = self.words.windows(self.window)
        upto = np.zeros(len(self.words.hashes) + 1, np.int64)
        np.add.at(upto, near + 1, 1)
        upto = np.cumsum(upto)
        # A window that starts at s holds anchors that start at s .. s + period - 1.
        held = upto[np.minimum(place + period, len(upto) - 1)] > upto[place]
        place, value = place[held], value[held]
        second = np.zeros(len(place), np.uint64)
        for i in range(self.window):
            second = second * SECOND + mixed(self.words.hashes[place + i])
        return place, value, mixed(second)

    def without(self, starts: np.ndarray) -> pa.RecordBatch:
        """Each document without the words covered by the windows at these places."""
        words = self.words
        change = np.zeros(len(words.hashes) + 1, np.int64)
        change[starts] += 1
        np.add.at(change, starts + self.window, -1)
        kept = np.cumsum(change)[:-1] == 0
        left = np.bincount(words.doc[kept], minlength=len(words.sizes))
        known = words.dictionary
        strings = [known[c] for c in words.codes[kept]]
        bounds = np.concatenate([[0], np.cumsum(left)])
        texts = [b" ".join(strings[a:b]) for a, b in zip(bounds, bounds[1:])]
        return pa.RecordBatch.from_arrays(
            [self.doc_ids, pa.array(words.sizes), pa.array(words.sizes - left), pa.array(texts, pa.binary()).cast(pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_text"],
        )


def _blocks(rows: pa.RecordBatch | pa.Table, window: int) -> Iterator[tuple[int, Block]]:
    numbers, ids, texts = (rows.column(c) for c in ("block", "doc_ids", "texts"))
    for i in range(rows.num_rows):
        yield numbers[i].as_py(), Block(ids[i].values, texts[i].values, window)


def _split(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(bucket, kind="stable")
    bounds = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if bounds[b] < bounds[b + 1]:
            yield b, order[bounds[b] : bounds[b + 1]]


def _bucket_of(value: np.ndarray, buckets: int) -> np.ndarray:
    return ((value >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


def _low(value: np.ndarray) -> np.ndarray:
    return (value & np.uint64(0xFFFFFFFF)).astype(np.uint32)


ANCHORS = "bucket int, block long, keys binary, many binary"


def _send_anchors(window: int, buckets: int):
    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, block in _blocks(batch, window):
                place, value = block.anchors()
                bucket, key, doc = _bucket_of(value, buckets), _low(value), block.words.doc[place]
                rows = []
                for b, chosen in _split(bucket, buckets):
                    order = chosen[np.lexsort((doc[chosen], key[chosen]))]
                    keys, first = np.unique(key[order], return_index=True)
                    docs = doc[order]
                    last = np.append(first[1:], len(order)) - 1
                    rows.append((b, number, keys.tobytes(), np.packbits(docs[first] != docs[last]).tobytes()))
                yield pa.RecordBatch.from_pydict(
                    {n: [r[i] for r in rows] for i, n in enumerate(("bucket", "block", "keys", "many"))},
                    schema=pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()), ("many", pa.binary())]),
                )

    return send


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """Of the anchors of one bucket, those in more than one document, back to their blocks."""
    keys = [np.frombuffer(k, np.uint32) for k in rows["keys"]]
    many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[: len(k)] for m, k in zip(rows["many"], keys)])
    sizes = [len(k) for k in keys]
    key = np.concatenate(keys)
    _, group, count = np.unique(key, return_inverse=True, return_counts=True)
    found = (count > 1) | (np.bincount(group, weights=many) > 0)
    chosen = found[group]
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = [
        (int(block), int(bucket), key[a:b][chosen[a:b]].tobytes())
        for block, bucket, a, b in zip(rows["block"], rows["bucket"], bounds, bounds[1:])
        if chosen[a:b].any()
    ]
    return pd.DataFrame(out, columns=["block", "bucket", "keys"])


WINDOWS = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("first", pa.binary()), ("second", pa.binary()), ("least", pa.binary()), ("many", pa.binary())])


def _send_windows(window: int, buckets: int):
    def send(rows: pa.Table, shared: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if rows.num_rows and shared.num_rows:
            known = np.concatenate(
                [np.frombuffer(k.as_buffer(), np.uint32).astype(np.uint64) | np.uint64(b.as_py() << 32) for k, b in zip(shared["keys"], shared["bucket"])]
            )
            for number, block in _blocks(rows, window):
                place, value = block.anchors()
                mark = _low(value).astype(np.uint64) | (_bucket_of(value, buckets).astype(np.uint64) << np.uint64(32))
                place, first, second = block.windows(place[np.isin(mark, known)])
                doc = block.id_of_word[place] if len(place) else place
                for b, chosen in _split(_bucket_of(first, buckets), buckets):
                    order = chosen[np.lexsort((doc[chosen], second[chosen], first[chosen]))]
                    x, y, d = first[order], second[order], doc[order]
                    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
                    start = np.flatnonzero(new)
                    last = np.append(start[1:], len(order)) - 1
                    out.append((b, number, x[new].tobytes(), y[new].tobytes(), d[start].tobytes(), np.packbits(d[start] != d[last]).tobytes()))
        return pa.Table.from_pydict({n: [r[i] for r in out] for i, n in enumerate(WINDOWS.names)}, schema=WINDOWS)

    return send


def _least(rows: pd.DataFrame) -> pd.DataFrame:
    """The smallest doc_id of each window of one bucket, back to the blocks with larger ones."""
    first, second, least = (np.concatenate([np.frombuffer(v, k) for v in rows[c]]) for c, k in (("first", np.uint64), ("second", np.uint64), ("least", np.int64)))
    sizes = [len(v) // 8 for v in rows["first"]]
    many = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8))[:n] for m, n in zip(rows["many"], sizes)]).astype(bool)
    order = np.lexsort((least, second, first))
    x, y = first[order], second[order]
    new = np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
    smallest = np.empty(len(order), np.int64)
    smallest[order] = least[order][new][np.cumsum(new) - 1]
    back = many | (smallest < least)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    out = [
        (int(block), first[a:b][back[a:b]].tobytes(), second[a:b][back[a:b]].tobytes(), smallest[a:b][back[a:b]].tobytes())
        for block, a, b in zip(rows["block"], bounds, bounds[1:])
        if back[a:b].any()
    ]
    return pd.DataFrame(out, columns=["block", "first", "second", "least"])


KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])


def _remove(window: int):
    def remove(rows: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        first, second, least = (
            np.concatenate([np.frombuffer(v.as_buffer(), kind) for v in found[c]]) if found.num_rows else np.zeros(0, kind)
            for c, kind in (("first", np.uint64), ("second", np.uint64), ("least", np.int64))
        )
        # Both hashes in one key of 128 bits, sorted.
        order = np.lexsort((second, first))
        first, second, least = first[order], second[order], least[order]
        for _, block in _blocks(rows, window):
            starts = np.zeros(0, np.int64)
            if len(first):
                place, value = block.words.windows(window)
                at = np.searchsorted(first, value)
                at[at == len(first)] = 0
                maybe = first[at] == value
                place, x, y = block.windows(place[maybe])
                place, at = _match(first, second, x, y, place)
                starts = place[least[at] < block.id_of_word[place]]
            out.append(block.without(starts))
        return pa.Table.from_batches(out).cast(KEPT) if out else KEPT.empty_table()

    return remove


def _match(first, second, x, y, place):
    """Rows of the sorted table with both hashes equal. Equal first hashes stand side by side."""
    at = np.searchsorted(first, x)
    found = np.full(len(x), -1)
    going = np.flatnonzero(at < len(first))
    while len(going):
        going = going[first[at[going]] == x[going]]
        hit = second[at[going]] == y[going]
        found[going[hit]] = at[going[hit]]
        going = going[~hit]
        at[going] += 1
        going = going[at[going] < len(first)]
    return place[found >= 0], found[found >= 0]


def remove_repeats(docs: DataFrame, run: RunFolder, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text (kept words joined by one space) of every row.

    A word goes if a window of `window` words around it also starts in a row with a smaller
    doc_id; all windows are judged on the input. Words are runs of characters other than ASCII
    white space, compared as they are. Null and empty texts, and texts of fewer words than a
    window, lose nothing. Rows with the same doc_id take nothing from one another. Rows without
    doc_id come after all others and take nothing from one another. Other columns are not read.
    An empty table gives an empty result."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = blocks_of(docs)
    # Bucketed by block: what comes back to the blocks meets them without moving the texts again.
    blocks = bucketed(cut, "block", run, "blocks")
    anchors = blocks.mapInArrow(lean(_send_anchors(window, buckets)), ANCHORS)
    shared = run.keep(anchors.groupBy("bucket").applyInPandas(_shared, "block long, bucket int, keys binary"), "shared")
    windows = (
        blocks.groupBy("block").cogroup(shared.groupBy("block"))
        .applyInArrow(_send_windows(window, buckets), "bucket int, block long, first binary, second binary, least binary, many binary")
    )
    least = run.keep(windows.groupBy("bucket").applyInPandas(_least, "block long, first binary, second binary, least binary"), "least")
    kept = blocks.groupBy("block").cogroup(least.groupBy("block"))
    return kept.applyInArrow(_remove(window), "doc_id long, n_words long, n_removed long, kept_text string")


def document_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), RunFolder(spark))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


PASSAGES_SQL = r"""
with w as (
  select doc_id, row_number() over () as d, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
  select d, doc_id, s, array_to_string(w[s : s + 12], ' ') as win
  from (select d, doc_id, w, unnest(range(1, len(w) - 11)) as s from w where len(w) >= 13)
), firsts as (
  select win, min(doc_id) as first_doc from starts group by win
), gone as (
  select distinct d, p from (
    select d, unnest(range(s, s + 13)) as p from starts join firsts using (win) where first_doc < doc_id)
), removed as (
  select d, count(*) as n_removed, list(p) as places from gone group by d
)
select doc_id, len(w) as n_words, coalesce(n_removed, 0) as n_removed,
  sha256(array_to_string([x for x, i in w if not coalesce(list_contains(places, i), false)], ' ')) as kept_sha256
from w left join removed using (d)
"""
