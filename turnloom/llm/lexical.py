r"""Ranked lexical search over bit-sliced Bloom signatures.

Terms are the runs of ASCII letters and digits and of all other characters beyond
U+007F; only A-Z are lower-cased.  A document holds an entry (term, level) for
each level with tf >= 2 ** level.

Index: documents of about as many entries share a block.  A block has a bit
matrix, a row (slice) for each place of the signature and a column for each
document: an entry sets the ``HASHES`` slices that its hash names.  Beside it
stand the lengths, and the exact terms and counts of each document, packed.

Search: the slices of a term, anded, give the documents that may hold it, with
some too many and none too few; with the slices of its levels they give a bound
of tf in each document.  The weights of these bounds, summed over an item's
terms, are an upper bound of the score for every document of the block.  By
falling bound, documents are scored exactly from their terms until no bound
reaches the ten best scores that the task has seen.  What a task keeps are at
most ten rows per item; the best ten of these are the result.

Neither step shuffles documents.  Items are packed into blocks too, and each
block of items meets each block of documents.  Terms are told apart by 64-bit
hashes.

* Null and empty texts, and texts without terms, are in no result and not in N.
* Items without terms, or whose terms no document holds, give no rows.
* Equal scores go by ascending doc_id, null ids last; repeated rows are ranked
  one by one, and items with equal or null ids are answered one by one.
* Other columns of the input are left out; empty tables give no rows.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count
from math import floor, log

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from turnloom.llm.words import mixed
from turnloom.session import cut_lineage

TOP = 10
HASHES = 4
SLICES_PER_TERM = 16  # of a block's largest document; its smallest has twice as many
BLOCK_BITS = 1 << 26
BLOCK_DOCS = 4096
BLOCK_CHARS = 16_000_000
ITEM_BLOCK = 512
LEVELS = 12  # the last one bounds nothing: tf may be any number there
_U = np.uint64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_terms = re.compile(rb"[0-9a-z\x80-\xff]+").findall


def terms(text: str | None) -> list[bytes]:
    return _terms((text or "").encode("utf-8", "surrogatepass").translate(_LOWER))


def _slices(key: np.ndarray, level: int | np.ndarray, slices: int) -> np.ndarray:
    """The slices of entries: (HASHES, len(key))."""
    with np.errstate(over="ignore"):
        entry = mixed(key + np.asarray(level).astype(_U) * _U(0x9E3779B97F4A7C15))
        return np.stack([(mixed(entry + _U(k)) % _U(slices)).astype(np.int64) for k in range(HASHES)])


def _pack(x: np.ndarray, kind: str) -> bytes:
    rows = np.ascontiguousarray(x.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T)
    return zstandard.compress(rows.tobytes(), 1)


def _unpack(body: bytes, kind: str) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


# --- index ---

_INDEX = (
    "slices int, doc_ids array<long>, lengths binary, n_terms long, bits binary, "
    "keys binary, holders binary, sizes binary, held binary, times binary"
)


class _Block:
    """Documents of one size class, until they are enough for a block."""

    def __init__(self, slices: int, most: int):
        self.slices = slices
        self.most = max(8, min(most, BLOCK_BITS // slices))
        self.number: dict[bytes, int] = defaultdict(count().__next__)
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.own: list[tuple[np.ndarray, np.ndarray]] = []
        self.chars = 0

    def add(self, doc_id: int | None, found: list[bytes], chars: int) -> bool:
        at = np.fromiter(map(self.number.__getitem__, found), np.int64, len(found))
        self.own.append(np.unique(at, return_counts=True))
        self.doc_ids.append(doc_id)
        self.lengths.append(len(found))
        self.chars += chars
        return len(self.doc_ids) >= self.most or self.chars >= BLOCK_CHARS

    def row(self) -> tuple:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.number), _U, len(self.number))
        order = np.argsort(hashes)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys = hashes[order]
        sizes = np.array([len(own) for own, _ in self.own], np.int64)
        held = np.concatenate([place[own] for own, _ in self.own])
        times = np.concatenate([n for _, n in self.own])
        who = np.repeat(np.arange(len(sizes)), sizes)
        by = np.lexsort((held, who))
        held, times = held[by], times[by]
        width = -(-len(sizes) // 8) * 8
        bits = np.zeros((self.slices, width), bool)
        for level in range(LEVELS):
            some = np.flatnonzero(times >= 1 << level)
            if not len(some):
                break
            bits[_slices(keys, level, self.slices)[:, held[some]], who[some]] = True
        return (
            self.slices, self.doc_ids, _pack(np.array(self.lengths), "<u4"), int(sum(self.lengths)),
            zstandard.compress(np.packbits(bits, axis=1).tobytes(), 1),
            _pack(keys, "<u8"), _pack(np.bincount(held, minlength=len(keys)), "<u4"), _pack(sizes, "<u4"), _pack(held, "<u4"), _pack(times, "<u4"),
        )


def build_index(docs: DataFrame) -> tuple[DataFrame, str]:
    """The blocks of all documents, written to the shared folder: (table, its path)."""

    def blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = [c.split()[0] for c in _INDEX.split(", ")]
        made: dict[int, _Block] = {}
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                found = terms(text)
                if not found:
                    continue
                slices = SLICES_PER_TERM << max(2, len(set(found)).bit_length())
                if slices not in made:
                    made[slices] = _Block(slices, BLOCK_DOCS)
                if made[slices].add(None if doc_id is pd.NA else int(doc_id), found, len(text or "")):
                    yield pd.DataFrame([made.pop(slices).row()], columns=columns)
        for block in made.values():
            yield pd.DataFrame([block.row()], columns=columns)

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(blocks, _INDEX)
    return cut_lineage(rows, "signatures")


# --- items ---

_ITEMS = "item_block long, item_ids array<long>, item_keys binary, item_sizes binary, item_terms binary"


def _item_blocks(items: DataFrame) -> DataFrame:
    """Items packed: the distinct terms of a block, and which of them each item has."""

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        block = count((context.partitionId() if context else 0) << 32)
        for frame in frames:
            for a in range(0, len(frame), ITEM_BLOCK):
                part = frame.iloc[a : a + ITEM_BLOCK]
                hashes = [sorted({xxhash.xxh3_64_intdigest(t) for t in terms(text)}) for text in part["text"]]
                flat = np.array([h for own in hashes for h in own], _U)
                keys, which = np.unique(flat, return_inverse=True)
                ids = [None if i is pd.NA else int(i) for i in part["item_id"].astype("Int64")]
                row = (next(block), ids, _pack(keys, "<u8"), _pack(np.array([len(h) for h in hashes]), "<u4"), _pack(which, "<u4"))
                yield pd.DataFrame([row], columns=[c.split()[0] for c in _ITEMS.split(", ")])

    return items.select(F.col("item_id").cast("bigint"), "text").mapInPandas(pack, _ITEMS)


def _found(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Place of each sought key among the sorted ones, -1 where there is none."""
    if not len(keys):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[at] == sought, at, -1)


def _document_counts(index: DataFrame, items: DataFrame) -> DataFrame:
    """(item_block, counts): in how many documents each term of a block of items is."""

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples():
                at = _found(_unpack(r.keys, "<u8"), _unpack(r.item_keys, "<u8"))
                some = np.flatnonzero(at >= 0)
                yield pd.DataFrame({"item_block": r.item_block, "i": some, "n": _unpack(r.holders, "<u4")[at[some]].astype(np.int64)})

    pairs = index.select("keys", "holders").crossJoin(items.select("item_block", "item_keys"))
    sums = pairs.mapInPandas(look, "item_block long, i long, n long").groupBy("item_block", "i").agg(F.sum("n").alias("n"))
    return sums.groupBy("item_block").agg(F.collect_list(F.struct("i", "n")).alias("counts"))


# --- bounds and scores ---


@dataclass
class Statistics:
    n_docs: int
    n_terms: int

    def weight(self, holders: int) -> int:
        return floor(1000 * log((2 * self.n_docs + 2) / (2 * holders + 1)))

    def norms(self, lengths: np.ndarray) -> np.ndarray:
        """8 m of each length."""
        longest = int(lengths.max()) if len(lengths) else 0
        kind = object if 90 * longest * self.n_docs >= 1 << 63 else np.int64
        return (8 * (10 + 90 * lengths.astype(kind) * self.n_docs // self.n_terms)).astype(np.int64)


def _part(times: np.ndarray | int, norm: np.ndarray | int) -> np.ndarray:
    return (1_000_000_000 * times) // (1000 * times + norm)


@dataclass
class Candidates:
    """Upper bounds in one block of documents, and exact scores."""

    row: object
    stats: Statistics

    def __post_init__(self):
        r = self.row
        self.doc_ids = [None if d is None or d != d else int(d) for d in r.doc_ids]
        self.bits = np.frombuffer(zstandard.decompress(r.bits), np.uint8).reshape(r.slices, -1)
        self.norm = self.stats.norms(_unpack(r.lengths, "<u4").astype(np.int64))
        # The largest part of a score that a term can have at each level; 10 ** 6 is above any.
        steps = [_part(2 ** (level + 1) - 1, self.norm) for level in range(LEVELS - 1)]
        self.parts = np.stack([*steps, np.full(len(self.norm), 1_000_000)])

    def bounds(self, keys: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What each term can add to the score of each document: (terms, documents)."""
        width = len(self.norm)
        out = np.zeros((len(keys), width), np.int64)
        at = _slices(keys, 0, self.row.slices)
        may = np.bitwise_and.reduce(self.bits[at], axis=0)
        for i in np.flatnonzero(may.any(axis=1)).tolist():
            held, top = may[i], np.zeros(width, np.int64)
            for level in range(1, LEVELS):
                held = held & np.bitwise_and.reduce(self.bits[_slices(keys[i : i + 1], level, self.row.slices)[:, 0]], axis=0)
                if not held.any():
                    break
                top += np.unpackbits(held, count=width)
            out[i] = np.unpackbits(may[i], count=width) * (self.parts[top, np.arange(width)] * weights[i])
        return out

    def exact(self):
        """The exact terms of the block, unpacked when first asked for."""
        if not hasattr(self, "keys"):
            r = self.row
            self.keys, self.held, self.times = _unpack(r.keys, "<u8"), _unpack(r.held, "<u4"), _unpack(r.times, "<u4").astype(np.int64)
            self.ends = np.concatenate([[0], np.cumsum(_unpack(r.sizes, "<u4").astype(np.int64))])
        return self

    def score(self, doc: int, at: np.ndarray, weights: np.ndarray) -> int:
        """at: the places of the item's terms in the block, ascending."""
        a, b = self.ends[doc], self.ends[doc + 1]
        own = self.held[a:b]
        place = np.minimum(np.searchsorted(own, at), len(own) - 1)
        hit = own[place] == at
        return int((weights[hit] * _part(self.times[a:b][place[hit]], self.norm[doc])).sum())


# An item's best rows so far: score, the doc_id's place in the order of ties (later ids are lower), a tie, doc_id.
Best = list[tuple[int, int, int, int | None]]
_LAST = -(1 << 63)


def _search_block(block: Candidates, keys: np.ndarray, weights: np.ndarray, sizes: np.ndarray, which: np.ndarray, best: list[Best], top: int) -> None:
    """Brings the best rows of each item up to date with a block."""
    parts = block.bounds(keys, weights)
    ids = np.array([_LAST if d is None else ~d for d in block.doc_ids])
    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    at = None
    for item, heap in enumerate(best):
        own = which[ends[item] : ends[item + 1]]
        bound = parts[own].sum(axis=0)
        least, least_id = heap[0][:2] if len(heap) >= top else (0, 0)
        # Left out for good: a lower bound than the last of the best, or the same and a later id.
        open_ = np.flatnonzero((bound > least) | ((bound == least) & (ids > least_id) & (least > 0)))
        if not len(open_):
            continue
        if at is None:
            at = _found(block.exact().keys, keys)
        have = own[at[own] >= 0]
        have = have[np.argsort(at[have])]
        places, w = at[have], weights[have]
        for doc in open_[np.argsort(-bound[open_], kind="stable")].tolist():
            if len(heap) >= top and bound[doc] < heap[0][0]:
                break
            score = block.score(doc, places, w) if len(places) else 0
            if score > 0:
                entry = (score, int(ids[doc]), -doc, block.doc_ids[doc])
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                elif entry[:2] > heap[0][:2]:
                    heapq.heapreplace(heap, entry)


def search_index(index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` best documents of each item."""
    totals = index.agg(F.coalesce(F.sum(F.size("doc_ids")), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    stats = Statistics(*totals)
    packed, _ = cut_lineage(_item_blocks(items), "items")
    weighed = packed.join(_document_counts(index, packed), "item_block")

    def best(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, tuple[list, list[Best]]] = {}
        for frame in frames:
            for r in frame.itertuples():
                keys = _unpack(r.item_keys, "<u8")
                holders = {c["i"]: c["n"] for c in r.counts}
                weights = np.array([stats.weight(holders.get(i, 0)) for i in range(len(keys))], np.int64)
                sizes, which = _unpack(r.item_sizes, "<u4"), _unpack(r.item_terms, "<u4").astype(np.int64)
                item_ids, found = kept.setdefault(r.item_block, (list(r.item_ids), [[] for _ in sizes]))
                _search_block(Candidates(r, stats), keys, weights, sizes, which, found, top)
        for block, (item_ids, found) in kept.items():
            rows = [(block, i, item_ids[i], doc, score) for i, heap in enumerate(found) for score, _, _, doc in heap]
            table = pd.DataFrame(rows, columns=["item_block", "i", "item_id", "doc_id", "score"])
            whole = {c: pd.array([None if x is None or x != x else int(x) for x in table[c]], "Int64") for c in ("item_id", "doc_id")}
            yield table.assign(**whole)

    rows = index.crossJoin(weighed).mapInPandas(best, "item_block long, i long, item_id long, doc_id long, score long")
    order = Window.partitionBy("item_block", "i").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")


def rank(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """The best documents of each item, over an index of all documents."""
    index, _ = build_index(docs)
    return search_index(index, items, top)


_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = f"""with d as (select doc_id, {_TERMS} as t from documents),
l as (select count(*) filter (where len(t) > 0) as n_docs, sum(len(t)) as n_terms from d),
p as (select doc_id, n, term, count(*) as tf from (select doc_id, len(t) as n, unnest(t) as term from d) group by all),
f as (select term, count(*) as df from p group by term),
q as (select distinct item_id, unnest(t) as term from (select item_id, {_TERMS} as t from benchmark)),
w as (select item_id, term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1))) as bigint) as w from q join f using (term), l),
s as (select item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + cast((90 * n * n_docs) // n_terms as bigint))))) as bigint) as score
  from w join p using (term), l group by item_id, doc_id),
r as (select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) as rank, doc_id, score from s where score > 0)
select item_id, rank, doc_id, score from r where rank <= 10"""
