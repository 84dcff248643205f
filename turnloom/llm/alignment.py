"""Tokens of two tokenizers aligned by the bytes they cover.

Byte offsets where a token of A and a token of B both end cut a text into
groups; tokens of one group are linked.  What is known of a byte range of a text
is a ``Fragment``: an open head up to the first such offset, closed groups, an
open tail after the last one.  Fragments of neighbouring ranges compose, and
composing is associative, so ranges may be aligned anywhere and be put together
in a tree.

1. A text of at most ``RANGE`` bytes is one fragment, aligned where it is read.
2. A longer one is cut into byte ranges without regard to tokens; ranges are
   dealt to all tasks and become fragments, and a tree of ``FAN`` fragments each
   composes them.  Closed groups leave the tree as rows as soon as they are
   closed; only heads and tails go up.
3. The linked id pairs of many documents are packed into runs.  How many
   documents hold a pair is summed over runs, and these counts go back to the
   runs that hold the pair.

Both tokenizers are asked for units: a text is cut before each space that
follows no white space, unless the text ends with it: B, which adds a space, has
no text for a unit that is one space.  No pattern of A and no piece of B goes over such a place
(the pieces are looked through; if one does, a text is one unit), so tokens of
units are those of the text, and each unit is encoded about once per worker.  A
range takes the units it touches and keeps the tokens that end in it.  A unit of
over ``LONG_UNIT`` bytes stays in one range.

* Null and empty texts, and texts that A's or B's tokens do not spell (B reads
  U+2581 as a space), have no tokens: zeros, and '' as digest.
* Rows are independent: null and repeated doc_ids keep a row each, and repeated
  rows count as documents of their own.
* Strings of special tokens inside texts are plain text.
* Other columns of the input are left out; an empty table gives no rows.
* The digest of one document, and nothing else, is made in one task.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.llm.tokenizing import tokenizer_path
from turnloom.llm.words import gather
from turnloom.session import cut_lineage, drop_scratch

BYTE_TOKENIZER = "byte_bpe_50k.json"
PIECE_TOKENIZER = "piece_bpe_32k.model"
RANGE = 65_536
LONG_UNIT = 4_096
FAN = 16
KNOWN_UNITS = 400_000
BATCH_CHARS = 1_000_000
BATCH_ROWS = 100_000
RUN_PAIRS = 1_500_000
WIDE_GROUP = 65_536
_ID_BITS = 20
_ID_MASK = (1 << _ID_BITS) - 1
_unit_starts = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
_space_after_space = re.compile(r"\s ")


# --- tokens of both tokenizers ---


def _byte_table() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 onwards."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers, and the tokens of the units met so far."""

    def __init__(self, a_name: str, b_name: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(tokenizer_path(a_name))
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path(b_name))
        byte_of = _byte_table()
        names = sorted((i, t) for t, i in self.a.get_vocab().items())
        self.a_bytes = [b""] * (names[-1][0] + 1)
        for i, t in names:
            self.a_bytes[i] = bytes(byte_of[c] for c in t) if all(c in byte_of for c in t) else t.encode()
        parts = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(parts)]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        if max(len(self.a_bytes), len(self.b_bytes)) > _ID_MASK:
            raise ValueError(f"ids must be at most {_ID_MASK}")
        self.splits = not any("▁" in p.lstrip("▁") for p in parts)
        # Text of a token in the digest: before another one of its side, or as the last of its side.
        self.shown = [f"{i}{end}" for n, ends in ((len(self.a_bytes), ",|"), (len(self.b_bytes), ",;")) for end in ends for i in range(n)]
        self._forget()

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.good = np.zeros(0, bool)
        self.pool = [np.zeros(0, np.int32), np.zeros(0, np.int32)]
        self.at = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.length = [np.zeros(0, np.int64), np.zeros(0, np.int64)]

    def units(self, text: str) -> list[str]:
        """The units of a text with its leading space."""
        text = " " + text
        if not self.splits:
            return [text]
        if text[-1] == " " or _space_after_space.search(text):
            return _unit_starts.split(text)
        return [" " + word for word in text[1:].split(" ")]  # every space begins a unit

    def _tokens(self, text: str) -> tuple[list[int], list[int], bool]:
        # A batch of one: the fast form leaves out the places of tokens and is there for batches only.
        a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:])
        raw = text.encode()
        return a, b, b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))

    def _learn(self, units: list[str], run: int = 512) -> None:
        """Encodes new units; many at once where their concatenation is a text with these units."""
        plain = [u for u in units if not u[-1].isspace() and "▁" not in u]
        rest = [u for u in units if u[-1].isspace() or "▁" in u]
        order, good = [], []
        pool, length = ([], []), ([], [])

        def add(own: list[str], ok: bool, ids: tuple[list[int], list[int]], sizes: tuple) -> None:
            order.extend(own)
            good.append(np.full(len(own), ok))
            for k in (0, 1):
                pool[k].append(np.array(ids[k], np.int32))
                length[k].append(sizes[k])

        for i in range(0, len(plain), run):
            own = plain[i : i + run]
            a, b, ok = self._tokens("".join(own))
            if not ok:
                rest += own
                continue
            ends = np.cumsum(np.fromiter((len(u.encode()) for u in own), np.int64, len(own)))
            cuts = (np.searchsorted(np.cumsum(size[ids]), ends) + 1 for ids, size in ((a, self.a_size), (b, self.b_size)))
            add(own, True, (a, b), tuple(np.diff(cut, prepend=0) for cut in cuts))
        for u in rest:
            a, b, ok = self._tokens(u)
            add([u], ok, (a, b), (np.array([len(a)]), np.array([len(b)])))
        first = len(self.number)
        self.number.update(zip(order, range(first, first + len(order))))
        self.good = np.concatenate([self.good, *good])
        for k in (0, 1):
            sizes = np.concatenate(length[k])
            self.at[k] = np.concatenate([self.at[k], len(self.pool[k]) + np.cumsum(sizes) - sizes])
            self.length[k] = np.concatenate([self.length[k], sizes])
            self.pool[k] = np.concatenate([self.pool[k], *pool[k]])

    def numbers(self, units: list[str]) -> np.ndarray:
        """The number of each unit; new ones are encoded."""
        new = list(set(units).difference(self.number))
        if new and len(self.number) + len(new) > KNOWN_UNITS:
            self._forget()
            new = list(set(units))
        if new:
            self._learn(new)
        return np.fromiter(map(self.number.__getitem__, units), np.int64, len(units))

    def ids(self, numbers: np.ndarray, side: int) -> np.ndarray:
        return gather(self.pool[side], self.at[side][numbers], self.length[side][numbers])


@cache
def tokenizers(a_name: str = BYTE_TOKENIZER, b_name: str = PIECE_TOKENIZER) -> Tokenizers:
    """One per worker process, kept between tasks."""
    return Tokenizers(a_name, b_name)


# --- fragments ---

_NONE = np.zeros(0, np.int64)


@dataclass
class Tokens:
    """Tokens of both sides in order, with the byte offsets where they end."""

    a: np.ndarray = field(default_factory=lambda: _NONE)
    a_end: np.ndarray = field(default_factory=lambda: _NONE)
    b: np.ndarray = field(default_factory=lambda: _NONE)
    b_end: np.ndarray = field(default_factory=lambda: _NONE)

    def __add__(self, after: Tokens) -> Tokens:
        return Tokens(*(np.concatenate([x, y]) for x, y in zip(self.columns(), after.columns())))

    def columns(self) -> tuple[np.ndarray, ...]:
        return self.a, self.a_end, self.b, self.b_end

    def between(self, low: int, high: float) -> Tokens:
        """The tokens that end after low, at high at the latest."""
        a, b = (self.a_end > low) & (self.a_end <= high), (self.b_end > low) & (self.b_end <= high)
        return Tokens(self.a[a], self.a_end[a], self.b[b], self.b_end[b])

    def packed(self) -> bytes:
        return zstandard.compress(np.concatenate([[len(self.a)], *self.columns()]).astype("<i8").tobytes(), 1)

    @staticmethod
    def unpacked(body: bytes) -> Tokens:
        x = np.frombuffer(zstandard.decompress(body), "<i8")
        n, x = int(x[0]), x[1:]
        m = len(x) // 2 - n
        return Tokens(*np.split(x, [n, 2 * n, 2 * n + m]))


@dataclass
class Fragment:
    """A byte range: open head, tail after the last offset where both sides end.

    The head includes that first offset.  Without one (not ``cut``) all tokens
    are the head.  Closed groups between the two are handed out when they close.
    """

    head: Tokens
    cut: bool = False
    tail: Tokens = field(default_factory=Tokens)


def fragment(tokens: Tokens) -> tuple[Fragment, Tokens]:
    """The fragment of some neighbouring tokens, and its closed groups."""
    both = np.intersect1d(tokens.a_end, tokens.b_end)
    if not len(both):
        return Fragment(tokens), Tokens()
    first, last = int(both[0]), int(both[-1])
    return Fragment(tokens.between(-1, first), True, tokens.between(last, np.inf)), tokens.between(first, last)


def compose(x: Fragment, y: Fragment) -> tuple[Fragment, Tokens]:
    """The fragment of two neighbouring ranges, and the groups that closed between them."""
    middle = (x.tail if x.cut else x.head) + y.head
    if x.cut and y.cut:
        return Fragment(x.head, True, y.tail), middle
    inner, closed = fragment(middle)
    if x.cut:
        return (Fragment(x.head, True, inner.tail), inner.head + closed) if inner.cut else (Fragment(x.head, True, middle), Tokens())
    if y.cut:  # the middle ends where y's head does, at an offset of both sides
        return Fragment(inner.head, True, y.tail), closed
    return inner, closed


# --- what closed groups hold ---


@dataclass
class Tally:
    """Of one text or a part of it: counts, the digest's text, and linked pairs with how often each is linked."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    shown: str
    pairs: np.ndarray
    times: np.ndarray

    def counts(self) -> tuple[int, int, int, int]:
        return self.n_a, self.n_b, self.n_groups, self.n_links


def _wide(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one group of very many, by distinct ids."""
    (x, n), (y, m) = np.unique(a, return_counts=True), np.unique(b, return_counts=True)
    return ((x[:, None] << _ID_BITS) | y).ravel(), (n[:, None] * m).ravel()


def tally(kit: Tokenizers, a: np.ndarray, b: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray, wide: int = WIDE_GROUP) -> Iterator[Tally]:
    """Of each of some texts, or parts that begin and end where both sides do: tokens a[a_bounds[i] : a_bounds[i + 1]], b likewise.

    All parts spell as many bytes with a as with b.  Groups of more than ``wide``
    links are counted by distinct ids, without a row for each link.
    """
    a, b = a.astype(np.int64), b.astype(np.int64)
    a_end, b_end = np.cumsum(kit.a_size[a]), np.cumsum(kit.b_size[b])
    total = int(a_end[-1]) if len(a) else 0
    ends = np.zeros(total + 1, bool)
    ends[a_end] = True
    both = np.zeros(total + 1, np.int64)
    both[b_end] = ends[b_end]
    before = np.cumsum(both)
    groups = int(before[-1])
    a_group, b_group = before[a_end - 1], before[b_end - 1]
    n_a, n_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
    a_first, b_first = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b

    # The digest's tokens in order: a group's tokens of A, then those of B.
    A, B = len(kit.a_bytes), len(kit.b_bytes)
    a_last, b_last = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (a_group, b_group))
    order = np.empty(len(a) + len(b), np.int64)
    order[np.arange(len(a)) + b_first[a_group]] = a + A * a_last
    order[np.arange(len(b)) + (a_first + n_a)[b_group]] = 2 * A + b + B * b_last

    text = np.repeat(np.arange(len(a_bounds) - 1), np.diff(a_bounds))
    links = n_a * n_b
    narrow = links <= wide
    partners = np.where(narrow[a_group], n_b[a_group], 0)
    left = np.repeat(np.arange(len(a)), partners)
    right = gather(b, b_first[a_group], partners)
    key = (text[left] << 2 * _ID_BITS) | (a[left] << _ID_BITS) | right
    key, times = np.unique(key, return_counts=True)
    if not narrow.all():
        more_key, more_times = [key], [times]
        for g in np.flatnonzero(~narrow).tolist():
            pairs, n = _wide(a[a_first[g] : a_first[g] + n_a[g]], b[b_first[g] : b_first[g] + n_b[g]])
            more_key.append(pairs | (int(text[a_first[g]]) << 2 * _ID_BITS))
            more_times.append(n)
        key, which = np.unique(np.concatenate(more_key), return_inverse=True)
        times = np.bincount(which, np.concatenate(more_times)).astype(np.int64)
    cuts = np.searchsorted(key, np.arange(len(a_bounds), dtype=np.int64) << 2 * _ID_BITS)
    key &= (1 << 2 * _ID_BITS) - 1
    sums = np.concatenate([[0], np.cumsum(links)])
    spans = zip(a_bounds[:-1].tolist(), a_bounds[1:].tolist(), b_bounds[:-1].tolist(), b_bounds[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist())
    for a0, a1, b0, b1, k0, k1 in spans:
        g0, g1 = (int(a_group[a0]), int(a_group[a1 - 1]) + 1) if a1 > a0 else (0, 0)
        shown = "".join(map(kit.shown.__getitem__, order[a0 + b0 : a1 + b1].tolist()))
        yield Tally(a1 - a0, b1 - b0, g1 - g0, int(sums[g1] - sums[g0]), shown, key[k0:k1], times[k0:k1])


def _tally_of(kit: Tokenizers, tokens: Tokens) -> Tally:
    return next(tally(kit, tokens.a, tokens.b, np.array([0, len(tokens.a)]), np.array([0, len(tokens.b)])))


# --- runs of documents ---

_DOC_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_pairs"]
_DOC = T.StructType([T.StructField(c, T.StringType() if c == "groups_sha256" else T.LongType()) for c in _DOC_COLUMNS])
_NO_TOKENS = ((0, 0, 0, 0), "", _NONE, _NONE)
_RUN = T.StructType([
    T.StructField("run", T.LongType(), False), T.StructField("docs", T.ArrayType(_DOC)),
    T.StructField("at", T.BinaryType()), T.StructField("times", T.BinaryType()),
    T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("holders", T.ArrayType(T.LongType())),
])


def _planes(x: np.ndarray) -> bytes:
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unplaned(body: bytes) -> np.ndarray:
    rows = np.frombuffer(zstandard.decompress(body), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(rows.T).view("<i8").ravel()


class _Runs:
    """Documents of a task with their pairs, packed into runs."""

    def __init__(self, kind: int, most: int):
        self.most = most
        context = TaskContext.get()
        self.next = ((context.partitionId() if context else 0) * 2 + kind) << 32
        self.clear()

    def clear(self) -> None:
        self.docs: list[dict] = []
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []
        self.held = 0

    def add(self, doc_id: int | None, counts: tuple[int, ...], sha: str, pairs: np.ndarray, times: np.ndarray) -> Iterator[pd.DataFrame]:
        self.docs.append(dict(zip(_DOC_COLUMNS, (doc_id, *counts, sha, len(pairs)))))
        self.pairs.append(pairs)
        self.times.append(times)
        self.held += len(pairs)
        if self.held >= self.most or len(self.docs) >= self.most:
            yield from self.flush()

    def flush(self) -> Iterator[pd.DataFrame]:
        if self.docs:
            keys, which, holders = np.unique(np.concatenate([_NONE, *self.pairs]), return_inverse=True, return_counts=True)
            order = np.argsort(-holders, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            row = (self.next, self.docs, _planes(rank[which]), _planes(np.concatenate([_NONE, *self.times])), keys[order], holders[order])
            yield pd.DataFrame([row], columns=_RUN.fieldNames())
            self.next += 1
            self.clear()


def _whole(value: object) -> int | None:
    return None if value is None or value is pd.NA or value != value else int(value)


def _short_texts(docs: DataFrame, names: tuple[str, str]) -> DataFrame:
    """Runs of the texts that are one fragment each."""

    def aligned(rows: list[tuple[int | None, str]]) -> Iterator[tuple]:
        kit = tokenizers(*names)
        units = [kit.units(text) if text else [] for _, text in rows]
        numbers = kit.numbers(list(chain.from_iterable(units)))
        bounds = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
        wrong = np.concatenate([[0], np.cumsum(~kit.good[numbers])])
        good = (wrong[bounds[1:]] == wrong[bounds[:-1]]) & (bounds[1:] > bounds[:-1])
        kept = numbers[np.repeat(good, np.diff(bounds))]
        sides = []
        for side in (0, 1):
            sums = np.concatenate([[0], np.cumsum(kit.length[side][numbers])])
            own = np.where(good, sums[bounds[1:]] - sums[bounds[:-1]], 0)
            sides.append((kit.ids(kept, side), np.concatenate([[0], np.cumsum(own)])))
        (a, a_bounds), (b, b_bounds) = sides
        for (doc_id, _text), ok, t in zip(rows, good.tolist(), tally(kit, a, b, a_bounds, b_bounds, WIDE_GROUP)):
            yield doc_id, *((t.counts(), hashlib.sha256(t.shown[:-1].encode()).hexdigest(), t.pairs, t.times) if ok else _NO_TOKENS)

    def runs(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Runs(0, RUN_PAIRS)
        rows: list[tuple[int | None, str]] = []
        size = 0
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                rows.append((_whole(doc_id), text or ""))
                size += len(text or "")
                if size >= BATCH_CHARS or len(rows) >= BATCH_ROWS:
                    for found in aligned(rows):
                        yield from out.add(*found)
                    rows, size = [], 0
        for found in aligned(rows) if rows else ():
            yield from out.add(*found)
        yield from out.flush()

    return docs.mapInPandas(runs, _RUN)


# --- long texts, by ranges ---

_PART = "key long, doc_id long, step long, closed boolean, at long, good boolean, n_a long, n_b long, n_groups long, n_links long, cut boolean, head binary, tail binary"


def _ranges(docs: DataFrame, names: tuple[str, str]) -> DataFrame:
    """(key, doc_id, step, low, high, first, text): byte ranges of long texts with the units they touch; first is where the units begin."""

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kit, context = tokenizers(*names), TaskContext.get()
        key = (context.partitionId() if context else 0) << 32
        for frame in frames:
            for doc_id, text in zip(frame["doc_id"].astype("Int64"), frame["text"]):
                units = kit.units(text)
                ends = np.cumsum([len(u.encode()) for u in units])
                starts = np.concatenate([[0], ends[:-1]])
                total = int(ends[-1])
                marks = np.arange(RANGE, total, RANGE)
                unit = np.searchsorted(ends, marks, side="left")
                marks = np.where(ends[unit] - starts[unit] > LONG_UNIT, ends[unit], marks)
                edges = np.unique(np.concatenate([[0], marks, [total]])).tolist()
                rows = []
                for step, (low, high) in enumerate(zip(edges, edges[1:])):
                    i, j = int(np.searchsorted(ends, low, side="right")), int(np.searchsorted(ends, high, side="left")) + 1
                    rows.append((key, _whole(doc_id), step, low, high, int(starts[i]), "".join(units[i:j])))
                key += 1
                frame_out = pd.DataFrame(rows, columns=["key", "doc_id", "step", "low", "high", "first", "text"])
                yield frame_out.assign(doc_id=pd.array([_whole(doc_id)] * len(rows), "Int64"))

    return docs.mapInPandas(cut, "key long, doc_id long, step long, low long, high long, first long, text string")


Part = tuple


def _open(key: int, doc_id: int | None, step: int, good: bool, f: Fragment) -> Part:
    return key, doc_id, step, False, -1, good, 0, 0, 0, 0, f.cut, f.head.packed(), f.tail.packed()


def _closed(key: int, doc_id: int | None, step: int, kit: Tokenizers, groups: Tokens) -> Iterator[Part]:
    """A row of closed groups: head holds the digest's text, tail the pairs and how often each is linked."""
    if len(groups.a):
        t = _tally_of(kit, groups)
        body = zstandard.compress(np.concatenate([t.pairs, t.times]).astype("<i8").tobytes(), 1)
        yield key, doc_id, step, True, int(groups.a_end[0]), True, t.n_a, t.n_b, t.n_groups, t.n_links, None, zstandard.compress(t.shown.encode(), 1), body


def _parts(rows: Iterable[Part]) -> pd.DataFrame:
    table = pd.DataFrame(list(rows), columns=[c.split()[0] for c in _PART.split(", ")])
    return table.assign(doc_id=pd.array(table["doc_id"].tolist(), "Int64"))


def _fragments(ranges: DataFrame, names: tuple[str, str]) -> DataFrame:
    """The open fragment and the closed groups of each range."""

    def align(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kit = tokenizers(*names)
        for frame in frames:
            for r in frame.itertuples():
                numbers = kit.numbers(kit.units(r.text[1:]))
                a, b = kit.ids(numbers, 0).astype(np.int64), kit.ids(numbers, 1).astype(np.int64)
                tokens = Tokens(a, r.first + np.cumsum(kit.a_size[a]), b, r.first + np.cumsum(kit.b_size[b])).between(r.low, r.high)
                whole, groups = fragment(tokens)
                doc_id, good = _whole(r.doc_id), bool(kit.good[numbers].all())
                # Sides that spell different bytes have no common offsets to go by.
                rows = [_open(r.key, doc_id, r.step, good, whole if good else Fragment(Tokens()))]
                if good:
                    rows += _closed(r.key, doc_id, r.step, kit, groups)
                yield _parts(rows)

    return ranges.repartition("key", "step").mapInPandas(align, _PART)


def _composed(parts: DataFrame, names: tuple[str, str]) -> DataFrame:
    """One level of the tree: each ``FAN`` neighbouring fragments become one."""

    def merge(frame: pd.DataFrame) -> pd.DataFrame:
        kit = tokenizers(*names)
        key, doc_id, step = int(frame["key"].iloc[0]), _whole(frame["doc_id"].iloc[0]), int(frame["step"].min()) // FAN
        whole, good, rows = Fragment(Tokens()), bool(frame["good"].all()), []
        for r in frame.sort_values("step").itertuples() if good else ():
            whole, groups = compose(whole, Fragment(Tokens.unpacked(r.head), r.cut, Tokens.unpacked(r.tail)))
            rows += _closed(key, doc_id, step, kit, groups)
        return _parts([_open(key, doc_id, step, good, whole), *rows])

    return parts.groupBy("key", F.expr(f"step div {FAN}").alias("_up")).applyInPandas(merge, _PART)


def _long_texts(docs: DataFrame, names: tuple[str, str]) -> tuple[DataFrame | None, list[str]]:
    """Runs of the texts of several ranges; the scratch tables behind them."""
    ranges, path = cut_lineage(_ranges(docs, names), "ranges")
    paths = [path]
    most = ranges.agg(F.max("step")).first()[0]
    if most is None:
        return None, paths
    level, path = cut_lineage(_fragments(ranges, names), "fragments")
    paths.append(path)
    done = level.where("closed")
    while most > 0:
        level, path = cut_lineage(_composed(level.where("NOT closed"), names), "fragments")
        paths.append(path)
        done = done.unionByName(level.where("closed"))
        most //= FAN
    whole = done.unionByName(level.where("NOT closed"))

    def row_of(doc_id: int | None, counts: tuple[int, ...], sha: str, pairs: np.ndarray, times: np.ndarray) -> pd.DataFrame:
        body = zstandard.compress(np.concatenate([pairs, times]).astype("<i8").tobytes(), 1)
        table = pd.DataFrame([(doc_id, *counts, sha, body)], columns=[*_DOC_COLUMNS[:5], "sha", "body"])
        return table.assign(doc_id=pd.array([doc_id], "Int64"))

    def finish(frame: pd.DataFrame) -> pd.DataFrame:
        """One text: its groups in order; the root's head is its first group, and its tail is empty."""
        kit = tokenizers(*names)
        root = frame[~frame["closed"]].iloc[0]
        doc_id = _whole(root["doc_id"])
        rows = frame[frame["closed"]]
        if not root["good"]:
            return row_of(doc_id, *_NO_TOKENS)
        first = _parts(_closed(int(root["key"]), doc_id, 0, kit, Tokens.unpacked(root["head"])))
        rows = pd.concat([first, rows]).sort_values("at")
        shown = b"".join(map(zstandard.decompress, rows["head"]))
        both = [np.frombuffer(zstandard.decompress(x), "<i8").reshape(2, -1) for x in rows["tail"]]
        pairs, which = np.unique(np.concatenate([x[0] for x in both]), return_inverse=True)
        times = np.zeros(len(pairs), np.int64)
        np.add.at(times, which, np.concatenate([x[1] for x in both]))
        sums = tuple(int(rows[c].sum()) for c in ("n_a", "n_b", "n_groups", "n_links"))
        return row_of(doc_id, sums, hashlib.sha256(shown[:-1]).hexdigest(), pairs, times)

    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = _Runs(1, RUN_PAIRS)
        for frame in frames:
            for r in frame.itertuples():
                pairs, times = np.frombuffer(zstandard.decompress(r.body), "<i8").reshape(2, -1)
                yield from out.add(_whole(r.doc_id), (r.n_a, r.n_b, r.n_groups, r.n_links), r.sha, pairs, times)
        yield from out.flush()

    finished = whole.groupBy("key").applyInPandas(finish, "doc_id long, n_a long, n_b long, n_groups long, n_links long, sha string, body binary")
    return finished.mapInPandas(pack, _RUN), paths


# --- counts over all documents ---


def align_runs(docs: DataFrame, a_name: str = BYTE_TOKENIZER, b_name: str = PIECE_TOKENIZER) -> DataFrame:
    """Runs of all documents: counts and digest of each, and which pairs it links how often.  Written to the shared folder."""
    names = (a_name, b_name)
    docs = docs.select(F.col("doc_id").cast("bigint"), "text")
    is_long = F.octet_length("text") >= RANGE
    runs = _short_texts(docs.where(F.coalesce(~is_long, F.lit(True))), names)
    long_runs, paths = _long_texts(docs.where(is_long), names)
    table, _ = cut_lineage(runs.unionByName(long_runs) if long_runs is not None else runs, "alignment")
    for path in paths:
        drop_scratch(docs.sparkSession, path)
    return table


def pair_counts(runs: DataFrame) -> DataFrame:
    """(pair, n, best): how many documents link a pair of ids, and whether no pair of the same A id is linked by more."""
    held = runs.select(F.explode(F.arrays_zip("pairs", "holders")).alias("p"))
    counts = held.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.holders").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", _ID_BITS))  # at most one row per id of B
    return counts.select("pair", "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))


def align(docs: DataFrame, a_name: str = BYTE_TOKENIZER, b_name: str = PIECE_TOKENIZER) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    runs = align_runs(docs, a_name, b_name)
    sought = runs.select("run", F.posexplode("pairs").alias("i", "pair"))
    found = sought.join(pair_counts(runs).hint("merge"), "pair")
    back = found.groupBy("run").agg(F.collect_list(F.struct("i", (F.col("n") * 2 + F.col("best").cast("int")).alias("v"))).alias("counts"))

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for docs_, at, times, counts in zip(frame["docs"], frame["at"], frame["times"], frame["counts"]):
                value = np.zeros(len(counts) if counts is not None else 0, np.int64)
                if len(value):
                    value[[c["i"] for c in counts]] = [c["v"] for c in counts]
                own, n = value[_unplaned(at)], _unplaned(times)
                best = np.concatenate([[0], np.cumsum(np.where(own & 1, n, 0))])
                total = np.concatenate([[0], np.cumsum(n * (own >> 1))])
                column = {c: [d[c] for d in docs_] for c in _DOC_COLUMNS}
                ends = np.cumsum(column.pop("n_pairs"))
                starts = np.concatenate([[0], ends[:-1]])
                column["doc_id"] = pd.array([_whole(d) for d in column["doc_id"]], "Int64")
                yield pd.DataFrame({**column, "n_best": best[ends] - best[starts], "count_sum": total[ends] - total[starts]})

    joined = runs.select("run", "docs", "at", "times").join(back.hint("merge"), "run", "left").select("docs", "at", "times", "counts")
    return joined.mapInPandas(count, "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long")
