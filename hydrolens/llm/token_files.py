"""Token ids in directly addressable codes.

An id is cut into 8-bit chunks. Level 0 holds the lowest chunk of every id, level l the l-th chunk
of those ids that have one. A bitmap per level marks the ids that go on, and a rank directory
(marked ids before each block of 512) leads from an id to its place on the next level. So any id
can be read by a few lookups; nothing is decoded in blocks.

File, little-endian:
  16 bytes  magic "DACTOK01", number of levels (uint32), unused (uint32)
  per level 4 x uint64: entries, offset of chunks, offset of bitmap, offset of rank directory
  3 x uint64: documents, offset of doc ids, offset of first positions
  then the arrays: chunks uint8, bitmap uint8 (least bit first), directory uint64,
  doc ids int64 with a uint8 each that is 1 for a null id, first positions uint64
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hydrolens.llm.common import table
from hydrolens.llm.shingles import lean
from hydrolens.sources.folders import RunFolder

MAGIC = b"DACTOK01"
RANK_BLOCK = 512
END_ID = 2
# Pieces of words whose ids a task remembers; ids after which a file ends.
CACHED_PIECES = 500_000
FILE_IDS = 8_000_000
# Texts that are encoded together.
STEP_ROWS = 2000
MANIFEST = "part int, file int, path string, n_ids long, n_docs long"
DECODED = "part int, file int, doc_id long, local_start long, n_tokens long, ids_crc32 long"


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


# The split rule of the tokenizer file, and the same rule for lower-case text of
# ASCII and Latin-1 letters as Python spells it.
SPLIT_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_RULE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
LATIN_WORD = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]*")


def byte_letters() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: printable bytes stand
    for themselves, the others for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b if b in plain else next(others)) for b in range(256)]


class Encoder:
    """Ids of whole texts, each followed by the end id.

    Where the tokenizer file has the split rule above, nothing is joined across ASCII white space:
    each distinct word of a batch is encoded once. The pieces of a word of Latin letters go straight
    to the merges, past normalisation that cannot change them, and are remembered. All other words, and whole texts under any other rule, take the tokenizer's full way."""

    def __init__(self, tokenizer_path: str, end_id: int = END_ID):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.model = self.tokenizer.model
        self.end_id = end_id
        self.pieces: dict[str, bytes] = {}  # ids as uint32
        self.letters = byte_letters()
        with open(tokenizer_path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.by_word = (
            steps[0].get("pattern") == {"Regex": SPLIT_RULE}
            and [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
            and not spec["model"].get("ignore_merges")
        )

    def piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()
        spelled = piece if plain else "".join([self.letters[b] for b in piece.encode()])
        return array("I", [token.id for token in self.model.tokenize(spelled)]).tobytes()

    def word(self, word: str) -> bytes | None:
        """Ids of a word of Latin letters, None for any other."""
        if "<|" in word or not (word.isascii() or LATIN_WORD.fullmatch(word)):
            return None
        known, word = self.pieces, word.lower()
        pieces = [word] if word.isascii() and word.isalpha() else LATIN_RULE.findall(word)
        for piece in pieces:
            if piece not in known:
                known[piece] = self.piece(piece)
        return known[pieces[0]] if len(pieces) == 1 else b"".join([known[p] for p in pieces])

    def of_words(self, words: list[str]) -> list[bytes]:
        if len(self.pieces) > CACHED_PIECES:
            self.pieces.clear()
        found = [self.word(word) for word in words]
        others = [i for i, ids in enumerate(found) if ids is None]
        encoded = self.tokenizer.encode_batch_fast([words[i] for i in others], add_special_tokens=False)
        for i, e in zip(others, encoded):
            found[i] = array("I", e.ids).tobytes()
        return found

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            found = [e.ids + [self.end_id] for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)
        parts = pc.ascii_split_whitespace(texts)
        ends = parts.offsets.to_numpy()[1:] - parts.offsets[0].as_py()
        coded = pc.dictionary_encode(parts.flatten())
        words = coded.dictionary.to_pylist()
        known = [*self.of_words(words), array("I", [self.end_id]).tobytes()]
        sizes = np.fromiter(map(len, known), np.int32, len(known)) // 4
        flat = np.frombuffer(b"".join(known), np.uint32)
        firsts = np.cumsum(sizes, dtype=np.int32) - sizes
        # The end id comes as a word of its own after the words of each text.
        order = np.insert(coded.indices.to_numpy(), ends, len(words))
        each = sizes[order]
        upto = np.cumsum(each, dtype=np.int64)
        # Place of each id in `flat`: its place in the row of words, moved to where its word stands.
        at = np.arange(int(upto[-1]) if len(upto) else 0)
        at += np.repeat(firsts[order] - (upto - each), each)
        ids = flat[at]
        return ids, np.diff(upto[ends + np.arange(len(ends))], prepend=0)


def levels_of(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Chunks, bitmap and rank directory of each level."""
    found, rest = [], ids.astype(np.uint32)
    while True:
        goes_on = rest >= 256
        bitmap = np.packbits(goes_on, bitorder="little")
        # Marked entries before every block, and before the end.
        blocks = np.bitwise_count(np.pad(bitmap, (0, -len(bitmap) % (RANK_BLOCK // 8)))).reshape(-1, RANK_BLOCK // 8)
        ranks = np.concatenate([[0], np.cumsum(blocks.sum(axis=1, dtype=np.int64))])
        found.append(((rest & 255).astype(np.uint8), bitmap, ranks.astype(np.uint64)))
        if not goes_on.any():
            return found
        rest = rest[goes_on] >> 8


def file_bytes(ids: np.ndarray, doc_ids: np.ndarray, nulls: np.ndarray, sizes: np.ndarray) -> Iterator[bytes]:
    levels = levels_of(ids)
    at = 16 + 32 * len(levels) + 24
    head = [MAGIC, np.array([len(levels), 0], "<u4").tobytes()]
    for chunks, bitmap, ranks in levels:
        head.append(np.array([len(chunks), at, at + len(chunks), at + len(chunks) + len(bitmap)], "<u8").tobytes())
        at += len(chunks) + len(bitmap) + 8 * len(ranks)
    head.append(np.array([len(doc_ids), at, at + 9 * len(doc_ids)], "<u8").tobytes())
    yield b"".join(head)
    for chunks, bitmap, ranks in levels:
        yield chunks.tobytes()
        yield bitmap.tobytes()
        yield ranks.astype("<u8").tobytes()
    yield doc_ids.astype("<i8").tobytes()
    yield nulls.astype(np.uint8).tobytes()
    yield (np.cumsum(sizes) - sizes).astype("<u8").tobytes()


class TokenFile:
    """Reads ids by position. Only the bytes asked for are fetched."""

    def __init__(self, path: str):
        system, inner = opened(path)
        self.source = system.open_input_file(inner)
        if self._bytes(0, 8) != MAGIC:
            raise ValueError(f"{path} is no token file")
        count = int(self._array(8, 1, "<u4")[0])
        self.levels = self._array(16, 4 * count, "<u8").astype(np.int64).reshape(count, 4)
        self.n_ids = int(self.levels[0, 0])
        self.n_docs, self._ids_at, self._starts_at = map(int, self._array(16 + 32 * count, 3, "<u8"))

    def _bytes(self, at: int, size: int) -> bytes:
        return self.source.read_at(size, at)

    def _array(self, at: int, count: int, kind: str) -> np.ndarray:
        return np.frombuffer(self._bytes(at, count * np.dtype(kind).itemsize), kind)

    def token(self, position: int) -> int:
        """The id at a position: one chunk, one bit and one rank per level."""
        value = 0
        for level, (entries, chunks, bitmap, ranks) in enumerate(self.levels):
            value |= self._bytes(int(chunks) + position, 1)[0] << (8 * level)
            if not self._bytes(int(bitmap) + position // 8, 1)[0] >> (position % 8) & 1:
                return value
            position = self._rank(level, position)
        return value

    def _rank(self, level: int, position: int) -> int:
        """Marked entries of a level before a position."""
        entries, _, bitmap, ranks = map(int, self.levels[level])
        block = position // RANK_BLOCK
        first = block * RANK_BLOCK
        base = int(self._array(ranks + 8 * block, 1, "<u8")[0])
        if position == first:
            return base
        bits = np.unpackbits(self._array(bitmap + first // 8, (position - first + 7) // 8, "u1"), bitorder="little")
        return base + int(bits[: position - first].sum())

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range of positions, starting anywhere."""
        return self._range(0, start, stop).astype(np.uint32)

    def _range(self, level: int, start: int, stop: int) -> np.ndarray:
        _, chunks, bitmap, _ = map(int, self.levels[level])
        if stop <= start:
            return np.zeros(0, np.uint32)
        values = self._array(chunks + start, stop - start, "u1").astype(np.uint32)
        first = start // 8
        bits = np.unpackbits(self._array(bitmap + first, (stop + 7) // 8 - first, "u1"), bitorder="little")
        goes_on = bits[start - 8 * first : stop - 8 * first].astype(bool)
        if goes_on.any():
            below = self._rank(level, start)
            values[goes_on] |= self._range(level + 1, below, below + int(goes_on.sum())) << np.uint32(8)
        return values

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Doc ids, whether they are null, and first positions with the end of the last."""
        starts = self._array(self._starts_at, self.n_docs, "<u8").astype(np.int64)
        doc_ids = self._array(self._ids_at, self.n_docs, "<i8")
        nulls = self._array(self._ids_at + 8 * self.n_docs, self.n_docs, "u1").astype(bool)
        return doc_ids, nulls, np.append(starts, self.n_ids)


def _writer(folder: str, tokenizer_path: str, end_id: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encode = Encoder(tokenizer_path, end_id)
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        files = 0

        def closed() -> pa.RecordBatch:
            ids, docs, nulls, sizes = (np.concatenate(x) for x in zip(*held))
            # An attempt that is run twice leaves a file that no manifest names.
            path = f"{folder}/{part:06d}-{files:04d}-{uuid.uuid4().hex}.dac"
            system, inner = opened(path)
            system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
            with system.open_output_stream(inner) as out:
                for piece in file_bytes(ids, docs, nulls, sizes):
                    out.write(piece)
            return pa.RecordBatch.from_pydict(
                {"part": [part], "file": [files], "path": [path], "n_ids": [len(ids)], "n_docs": [len(docs)]},
                schema=pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("n_ids", pa.int64()), ("n_docs", pa.int64())]),
            )

        for batch in batches:
            doc_ids, texts = batch.column(0), batch.column(1)
            for first in range(0, batch.num_rows, STEP_ROWS):
                ids, sizes = encode(texts.slice(first, STEP_ROWS))
                here = doc_ids.slice(first, STEP_ROWS)
                held.append((ids, pc.fill_null(here, 0).to_numpy(), pc.is_null(here).to_numpy(False), sizes))
                if sum(len(x[0]) for x in held) >= FILE_IDS:
                    yield closed()
                    held, files = [], files + 1
        if held:
            yield closed()

    return write


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, run: RunFolder, end_id: int = END_ID) -> DataFrame:
    """Encodes all texts (null: empty) and writes token files in ascending doc_id order (null ids
    first; rows with equal ids in the order of their texts). Returns the manifest of the files,
    stored by Spark's own commit: `part` and `file` give their order. An empty table gives an
    empty manifest; other columns are not read."""
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    dealt = whole.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return run.keep(dealt.mapInArrow(lean(_writer(folder, tokenizer_path, end_id)), MANIFEST), "manifest")


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            source = TokenFile(row["path"])
            doc_ids, nulls, starts = source.documents()
            for first in range(0, len(doc_ids), 2000):
                upto = min(first + 2000, len(doc_ids))
                here = starts[first : upto + 1]
                data = memoryview(source.tokens(int(here[0]), int(here[-1])).astype("<u4").tobytes())
                bounds = 4 * (here - here[0])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(upto - first, row["part"], np.int32)),
                        pa.array(np.full(upto - first, row["file"], np.int32)),
                        pa.array(doc_ids[first:upto], pa.int64(), mask=nulls[first:upto]),
                        pa.array(here[:-1].astype(np.int64)),
                        pa.array(np.diff(here).astype(np.int64)),
                        pa.array([zlib.crc32(data[a:b]) for a, b in zip(bounds, bounds[1:])], pa.int64()),
                    ],
                    names=["part", "file", "doc_id", "local_start", "n_tokens", "ids_crc32"],
                )


def read_tokens(manifest: DataFrame, run: RunFolder) -> DataFrame:
    """Per document, read back from the files: doc_id, start (ids of all documents before it),
    n_tokens (with the end id) and ids_crc32 (of its ids as little-endian uint32)."""
    before = Window.orderBy("part", "file")
    starts = run.keep(
        manifest.select(
            "part", "file", "path", (F.sum("n_ids").over(before) - F.col("n_ids")).alias("file_start")
        ),
        "file_starts",
    )
    # A number of tasks that is asked for is not merged into fewer: the rows are few, their files large.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = starts.select("part", "file", "path").repartition(tasks, "path")
    decoded = files.mapInArrow(lean(_decode), DECODED)
    return decoded.join(starts.drop("path"), ["part", "file"]).select(
        "doc_id",
        (F.col("file_start") + F.col("local_start")).alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def tokenized(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Writes the token files of the documents and reads them back."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    run = RunFolder(docs.sparkSession)
    return read_tokens(write_tokens(docs, f"{run.path}/tokens", tokenizer_path, run), run)


def document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenized(table(spark, sf_dir, "documents"))
