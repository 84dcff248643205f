"""Token ids in directly addressable codes, written and read as files.

An id is cut into one-byte chunks, lowest first.  Level k holds the k-th chunk
of every id that has one; a bitmap beside it says which ids go on to level k+1,
and a rank directory counts the set bits before each block of 512, so the place
of an id on the next level is one directory entry and one short count away.  Any
token, or any run of tokens, is read without decoding what stands before it.

File: magic, then ``<qqqq`` documents, tokens, levels, 0; then document ids
(null: smallest 64-bit number), null flags, starts within the file (one more
than documents); then per level the count, chunks, bitmap and directory.  All numbers are
little-endian.  A file holds documents in ascending order, files of a folder
follow each other by name.

* Null and empty texts are one end id.  A null document id sorts first.
* Rows that share an id are kept, in the order of their texts.
* An empty table gives a folder without files and an empty result.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.common import file_system, publish, scan_splits
from turnloom.llm.tokenizing import TOKENIZER, encoder
from turnloom.session import cut_lineage, scratch_path

MAGIC = b"DACIDS1\n"
RANK_BLOCK = 512
FILE_TOKENS = 8_000_000
_HEAD = "<qqqq"
_NULL = -(2**63)


def _level(chunks: np.ndarray, goes_on: np.ndarray) -> Iterator[bytes]:
    bits = np.packbits(goes_on, bitorder="little")
    ones = np.add.reduceat(goes_on, np.arange(0, max(1, len(goes_on)), RANK_BLOCK), dtype=np.int64) if len(goes_on) else np.zeros(1, np.int64)
    ranks = np.concatenate([[0], np.cumsum(ones)]).astype("<i8")
    yield struct.pack("<qqq", len(chunks), len(bits), len(ranks))
    yield chunks.tobytes()
    yield bits.tobytes()
    yield ranks.tobytes()


def encode(doc_ids: np.ndarray, nulls: np.ndarray, starts: np.ndarray, ids: np.ndarray) -> Iterator[bytes]:
    """The bytes of one file, block by block."""
    levels = max(1, -(-int(ids.max(initial=0)).bit_length() // 8))
    yield MAGIC
    yield struct.pack(_HEAD, len(doc_ids), len(ids), levels, 0)
    yield doc_ids.astype("<i8").tobytes()
    yield nulls.astype(np.uint8).tobytes()
    yield starts.astype("<i8").tobytes()
    rest = ids.astype(np.uint32)
    for _ in range(levels):
        goes_on = rest > 255
        yield from _level((rest & 255).astype(np.uint8), goes_on)
        rest = rest[goes_on] >> 8


@dataclass
class _Level:
    n: int
    chunks: int  # places in the file
    bits: int
    ranks: int


class DacFile:
    """Random access to one file; reads only the bytes it needs."""

    def __init__(self, fs: pafs.FileSystem, path: str):
        self.file = fs.open_input_file(path)
        if self._bytes(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a file of directly addressable codes")
        at = len(MAGIC)
        self.docs, self.tokens, levels, _ = struct.unpack(_HEAD, self._bytes(at, 32))
        self._ids_at = at + 32
        self._nulls_at = self._ids_at + 8 * self.docs
        self._starts_at = self._nulls_at + self.docs
        at = self._starts_at + 8 * (self.docs + 1)
        self.levels = []
        for _ in range(levels):
            n, bits, ranks = struct.unpack("<qqq", self._bytes(at, 24))
            self.levels.append(_Level(n, at + 24, at + 24 + n, at + 24 + n + bits))
            at += 24 + n + bits + 8 * ranks

    def _bytes(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def documents(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, null flags and starts (one more) of documents a to b."""
        ids = np.frombuffer(self._bytes(self._ids_at + 8 * a, 8 * (b - a)), "<i8")
        nulls = np.frombuffer(self._bytes(self._nulls_at + a, b - a), np.uint8)
        return ids, nulls, np.frombuffer(self._bytes(self._starts_at + 8 * a, 8 * (b - a + 1)), "<i8")

    def _flags(self, level: _Level, a: int, b: int) -> np.ndarray:
        packed = np.frombuffer(self._bytes(level.bits + a // 8, -(-b // 8) - a // 8), np.uint8)
        return np.unpackbits(packed, bitorder="little")[a % 8 : a % 8 + b - a]

    def rank(self, k: int, i: int) -> int:
        """Ids before place i of level k that go on."""
        block = i // RANK_BLOCK
        (before,) = struct.unpack("<q", self._bytes(self.levels[k].ranks + 8 * block, 8))
        return before + int(self._flags(self.levels[k], block * RANK_BLOCK, i).sum())

    def token(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for k, level in enumerate(self.levels):
            value |= self._bytes(level.chunks + i, 1)[0] << (8 * k)
            if not self._flags(level, i, i + 1)[0]:
                break
            i = self.rank(k, i)
        return value

    def run(self, a: int, b: int) -> np.ndarray:
        """The ids at places a to b."""
        values, own = np.zeros(b - a, np.uint32), np.arange(b - a)
        for k, level in enumerate(self.levels):
            if not len(own):
                break
            chunks = np.frombuffer(self._bytes(level.chunks + a, b - a), np.uint8)
            values[own] |= chunks.astype(np.uint32) << np.uint32(8 * k)
            goes_on = self._flags(level, a, b).astype(bool)
            own = own[goes_on]
            if len(own):
                a = self.rank(k, a)
                b = a + len(own)
        return values


def write(docs: DataFrame, folder: str, end_id: int, tokenizer: str = TOKENIZER, file_tokens: int = FILE_TOKENS) -> DataFrame:
    """Encodes texts in ascending order of doc_id into the folder's files.

    Returns one row per file: file, first (ids in the files before), n_tokens.
    """

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        task = TaskContext.get()
        held: list[tuple[int | None, np.ndarray]] = []
        size = made = 0
        end = np.array([end_id], np.uint32)

        def flush() -> pd.DataFrame:
            ids = np.concatenate([x for _, x in held])
            starts = np.cumsum([0, *(len(x) for _, x in held)])
            nulls = np.array([d is None for d, _ in held])
            doc_ids = np.array([_NULL if d is None else d for d, _ in held], np.int64)
            name = f"ids-{task.partitionId():06d}-{made:05d}.dac"
            publish(fs, root, name, task.taskAttemptId(), encode(doc_ids, nulls, starts, ids))
            return pd.DataFrame({"file": [name], "n_docs": [len(held)], "n_tokens": [len(ids)]})

        for batch in batches:
            keys = [None if pd.isna(d) else int(d) for d in batch["doc_id"].tolist()]
            for key, ids in zip(keys, encoder(tokenizer).encode(batch["text"].tolist())):
                held.append((key, np.concatenate([ids, end])))
                size += len(ids) + 1
                if size >= file_tokens:
                    yield flush()
                    held, size, made = [], 0, made + 1
        if held:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(scan_splits(docs), "doc_id")
    # One column would split rows of equal ids between files out of order; equal ids stay in one range.
    files = ordered.sortWithinPartitions("doc_id", "text").mapInPandas(encoded, "file string, n_docs long, n_tokens long")
    files, _ = cut_lineage(files, "dac-files")
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read(files: DataFrame, folder: str, block_tokens: int = 1_000_000) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32 and its place (file, at)."""

    def decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fs, root = file_system(folder)
        for batch in batches:
            for name, first in zip(batch["file"], batch["first"].tolist()):
                dac = DacFile(fs, f"{root}/{name}")
                ids, nulls, starts = dac.documents(0, dac.docs)
                a = 0
                while a < dac.docs:
                    b = max(a + 1, int(np.searchsorted(starts, starts[a] + block_tokens, "right")) - 1)
                    data = dac.run(int(starts[a]), int(starts[b])).astype("<u4").tobytes()
                    cut = ((starts[a : b + 1] - starts[a]) * 4).tolist()
                    rows = pd.DataFrame({
                        "doc_id": pd.array(ids[a:b], "Int64"),
                        "start": first + starts[a:b],
                        "n_tokens": np.diff(starts[a : b + 1]),
                        "ids_crc32": [zlib.crc32(data[i:j]) for i, j in zip(cut, cut[1:])],
                        "file": name,
                        "at": starts[a:b],
                    })
                    rows.loc[nulls[a:b].astype(bool), "doc_id"] = pd.NA
                    yield rows
                    a = b

    spread = files.select("file", "first").repartition(scan_splits(files), "file")
    return spread.mapInPandas(decoded, "doc_id long, start long, n_tokens long, ids_crc32 long, file string, at long")


def round_trip(docs: DataFrame, end_id: int = 1, tokenizer: str = TOKENIZER) -> DataFrame:
    """Writes the ids of all documents to the shared folder and reads them back."""
    folder = scratch_path(docs.sparkSession, "dac")
    return read(write(docs, folder, end_id, tokenizer), folder).select("doc_id", "start", "n_tokens", "ids_crc32")
