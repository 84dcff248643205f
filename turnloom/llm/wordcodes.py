"""BPE encoding and decoding over a table of distinct words.

The tokenizer drops white space and joins nothing across it, so the ids of a
text are those of its words, one after the other.

Encoding: texts are split into words in runs of about ``RUN_CHARS``.  A run
becomes its distinct words, dealt by hash to fragments, and the places where
each of them stands (numbers by first appearance, packed).  A fragment takes its
words of all runs, encodes each distinct one once with the library, and sends
every run the ids of its words, which are joined back by position.

Decoding: the distinct ids of each run are joined with the (id, piece) table of
the vocabulary, the pieces found go to the run, and there take the places of the
ids.

A fragment holds one entry per run for a word, however often the run has it, so
a frequent word is no larger than any other word that is in all runs.  Fragments
are dealt again by run once there are more than ``FRAGMENTS`` scan splits: then
a word is encoded once per block of runs, and no group grows with the data.

* Null and empty texts, and texts without words, have no ids and decode to ''.
* Rows are independent: null and repeated doc_ids keep a row each.
* Other columns of the input are left out; an empty table gives no rows.
* A text is never cut: a longer one than ``RUN_CHARS`` is a run of its own.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import count, islice

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm.common import find_words, scan_splits
from turnloom.llm.tokenizing import TOKENIZER, tokenizer_path
from turnloom.llm.words import gather

RUN_CHARS = 16_000_000
FRAGMENTS = 1024
ENCODE_BATCH = 20_000
# What a row of a run holds: the words or ids of a fragment, the places of its words (part -1), or ids in order (part -2).
_PLACES, _ORDERED = -1, -2
_RUN = T.StructType([
    # Known not to be null: else joins on it filter one side, and what both sides share would be computed twice.
    T.StructField("run", T.LongType(), False), T.StructField("part", T.IntegerType()), T.StructField("n", T.IntegerType()), T.StructField("body", T.BinaryType()),
    T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("sizes", T.ArrayType(T.LongType())),
])
_DEALT = T.StructType([T.StructField("place", T.LongType()), *_RUN.fields])


@cache
def library(name: str = TOKENIZER):
    """The tokenizer as the library reads it, without truncation and padding; one per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def planes(x: np.ndarray) -> bytes:
    """Whole numbers below 2^32, compressed byte by byte of their digits."""
    rows = np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.compress(rows.tobytes(), 9)


def unplaned(body: bytes) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(rows.T).view("<u4").ravel()


def _fragment(word: str, fragments: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % fragments


def _runs(docs: DataFrame, fragments: int, blocks: int) -> DataFrame:
    """A row of words per run and fragment, and a row of places per run."""

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        base = (context.partitionId() if context else 0) << 32
        made = count()

        def run_rows(number: dict[str, int], ids: list, at: list[np.ndarray]) -> pd.DataFrame:
            run = base + next(made)
            words = list(number)
            of = np.fromiter((_fragment(w, fragments) for w in words), np.int64, len(words))
            order = np.argsort(of, kind="stable")
            cuts = np.flatnonzero(np.diff(of[order], prepend=-1))
            block = run % 1_000_003 % blocks
            rows = []
            for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(order)]):
                own = [words[i] for i in order[a:b].tolist()]
                body = zstandard.compress("\n".join(own).encode("utf-8", "surrogatepass"), 9)
                rows.append((int(of[order[a]]) * blocks + block, run, int(of[order[a]]), b - a, body, None, None))
            places = np.concatenate([[len(of)], of, *at]) if at else np.concatenate([[len(of)], of])
            rows.append((-1 - run, run, _PLACES, len(ids), planes(places), ids, [len(x) for x in at]))
            return pd.DataFrame(rows, columns=["place", "run", "part", "n", "body", "ids", "sizes"])

        number: dict[str, int] = defaultdict(count().__next__)
        ids: list = []
        at: list[np.ndarray] = []
        size = 0
        for frame in frames:
            for doc, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                text = text or ""
                if ids and size + len(text) > RUN_CHARS:
                    yield run_rows(number, ids, at)
                    number, ids, at, size = defaultdict(count().__next__), [], [], 0
                words = find_words(text)
                at.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
                ids.append(None if doc is pd.NA else int(doc))
                size += len(text)
        if ids:
            yield run_rows(number, ids, at)

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(split, _DEALT)


def _encoded(runs: DataFrame, tokenizer: str) -> DataFrame:
    """The same rows with ids for words; each distinct word of a fragment is encoded once."""

    def encode(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["part"].iloc[0] < 0:
            return rows[_RUN.fieldNames()]
        number: dict[str, int] = defaultdict(count().__next__)
        at = []
        for body in rows["body"]:
            words = zstandard.decompress(body).decode("utf-8", "surrogatepass").split("\n")
            at.append(np.fromiter(map(number.__getitem__, words), np.int64, len(words)))
        tok, todo, coded = library(tokenizer), iter(number), []
        while batch := list(islice(todo, ENCODE_BATCH)):
            coded += [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(batch, add_special_tokens=False)]
        length = np.fromiter(map(len, coded), np.int64, len(coded))
        pool = np.concatenate(coded)
        start = np.cumsum(length) - length
        bodies = [planes(np.concatenate([length[a], gather(pool, start[a], length[a])])) for a in at]
        return pd.DataFrame({"run": rows["run"], "part": rows["part"], "n": rows["n"], "body": bodies, "ids": None, "sizes": None})

    return runs.groupBy("place").applyInPandas(encode, _RUN)


Coded = tuple[list[int | None], np.ndarray, np.ndarray]


def _assembled(rows: list[dict]) -> Coded:
    """A run's doc_ids, its ids one after the other, and how many each text has."""
    last = next(r for r in rows if r["part"] < 0)
    doc_ids = [None if d is None or d != d else int(d) for d in last["ids"]]
    counts = np.asarray(last["sizes"], np.int64)
    if last["part"] == _ORDERED:
        return doc_ids, unplaned(last["body"]), counts
    places = unplaned(last["body"])
    n = int(places[0])
    of, at = places[1 : n + 1], places[n + 1 :]
    length, pools, done = np.zeros(n, np.int64), [np.zeros(0, np.uint32)], 0
    order = np.argsort(of, kind="stable")
    for r in sorted((r for r in rows if r["part"] >= 0), key=lambda r: r["part"]):
        values = unplaned(r["body"])
        length[order[done : done + r["n"]]] = values[: r["n"]]
        pools.append(values[r["n"] :])
        done += r["n"]
    start = np.zeros(n, np.int64)
    start[order] = np.cumsum(length[order]) - length[order]
    ends = np.concatenate([[0], np.cumsum(length[at])])
    bounds = ends[np.concatenate([[0], np.cumsum(counts)])]
    return doc_ids, gather(np.concatenate(pools), start[at], length[at]), np.diff(bounds)


def _gathered(parts: DataFrame) -> DataFrame:
    """(run, rows): what was sent to each run."""
    return parts.groupBy("run").agg(F.collect_list(F.struct(*_RUN.fieldNames()[1:])).alias("rows"))


def encode_runs(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(run, rows): the texts of each run as places of words and ids of words."""
    splits = scan_splits(docs)
    fragments = min(FRAGMENTS, splits)
    return _gathered(_encoded(_runs(docs, fragments, -(-splits // fragments)), tokenizer))


def encode(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, ids) of every row of documents."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for run in frame["rows"]:
                doc_ids, ids, sizes = _assembled(run)
                yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "ids": np.split(ids.astype(np.int32), np.cumsum(sizes)[:-1])})

    return encode_runs(docs, tokenizer).select("rows").mapInPandas(rows, "doc_id long, ids array<int>")


def pieces(spark: SparkSession, tokenizer: str = TOKENIZER) -> DataFrame:
    """(id, piece) of the whole vocabulary; its size is that of the tokenizer file."""
    table = sorted((i, p) for p, i in library(tokenizer).get_vocab(with_added_tokens=True).items())
    return spark.createDataFrame(pd.DataFrame(table, columns=["id", "piece"]), "id int, piece string")


def ordered_runs(coded: DataFrame, rows: int = 4096) -> DataFrame:
    """Rows (doc_id, ids) packed into runs, in the form of ``encode_runs``."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        run = count((context.partitionId() if context else 0) << 32)
        for frame in frames:
            for a in range(0, len(frame), rows):
                part = frame.iloc[a : a + rows]
                ids = [np.zeros(0, np.uint32) if x is None else np.asarray(x, np.uint32) for x in part["ids"]]
                docs = [None if d is pd.NA else int(d) for d in part["doc_id"].astype("Int64")]
                yield pd.DataFrame([(next(run), _ORDERED, len(ids), planes(np.concatenate(ids)), docs, [len(x) for x in ids])], columns=_RUN.fieldNames())

    return _gathered(coded.select(F.col("doc_id").cast("bigint"), "ids").mapInPandas(pack, _RUN))


def decode_runs(runs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(rows, pieces) of each run: the ids that occur in it, joined with the (id, piece) table of the vocabulary."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def occurring(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: np.unique(_assembled(r)[1]).astype(np.int32))

    table = pieces(runs.sparkSession, tokenizer)
    named = runs.select("run", F.explode(occurring("rows")).alias("id")).join(F.broadcast(table), "id")
    held = named.groupBy("run").agg(F.collect_list(F.struct("id", "piece")).alias("pieces"))
    return runs.join(held.hint("merge"), "run", "left").select("rows", "pieces")


def _texts(frame: pd.DataFrame) -> Iterator[tuple[int | None, np.ndarray, str]]:
    """(doc_id, ids, text) of each text of some runs; pieces without a decoder are joined by one space."""
    for rows, held in zip(frame["rows"], frame["pieces"]):
        doc_ids, ids, sizes = _assembled(rows)
        table = {x["id"]: x["piece"] for x in held} if held is not None else {}
        a = 0
        for doc, size in zip(doc_ids, sizes.tolist()):
            own = ids[a : a + size]
            a += size
            yield doc, own, " ".join(map(table.__getitem__, own.tolist()))


def decode(coded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, text) of rows (doc_id, ids), as the library's decode with special tokens kept; null ids give ''."""

    def rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            found = [(doc, text) for doc, _ids, text in _texts(frame)]
            yield pd.DataFrame({"doc_id": pd.array([d for d, _ in found], "Int64"), "text": [t for _, t in found]})

    return decode_runs(ordered_runs(coded), tokenizer).mapInPandas(rows, "doc_id long, text string")


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def round_trip(docs: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded, then decoded from its ids."""

    def digests(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        decimal: list[str] = []
        for frame in frames:
            out = []
            for doc, ids, text in _texts(frame):
                if len(ids) and int(ids.max()) >= len(decimal):
                    decimal += map(str, range(len(decimal), int(ids.max()) + 1))
                out.append((len(ids), _hex(" ".join(map(decimal.__getitem__, ids.tolist()))), _hex(text), doc))
            table = pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256", "doc_id"])
            yield table.assign(doc_id=pd.array([r[3] for r in out], "Int64"))

    decoded = decode_runs(encode_runs(docs, tokenizer), tokenizer)
    return decoded.mapInPandas(digests, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
