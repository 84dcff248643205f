"""Byte-level pieces: the byte alphabet, the word splitter, applying merges."""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom import constants as K
from turnloom.functions.text import let

# --- fixed values: byte alphabet and word splitter of byte-level vocabularies ---
# Bytes that print stand for themselves, the others for U+0100 onwards.
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHER = [b for b in range(256) if b not in set(PRINTABLE)]
BYTE_CHAR = {**{b: chr(b) for b in PRINTABLE}, **{b: chr(256 + i) for i, b in enumerate(OTHER)}}
CHAR_BYTE = {c: b for b, c in BYTE_CHAR.items()}
SPACE = r"\p{Z}\x09-\x0d\x85"
WORD_PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def reserved_tokens() -> list[str]:
    """All reserved tokens, in id order; buffers fill up to the reserved count."""
    named = K.SPECIAL_TOKENS + K.CONTROL_TOKENS
    return named + [f"<|buffer{i}|>" for i in range(1, K.RESERVED_COUNT - len(named) + 1)]


def byte_tokens() -> list[str]:
    """The byte alphabet in id order (by character)."""
    return sorted(BYTE_CHAR.values())


def base_vocab() -> list[str]:
    return reserved_tokens() + byte_tokens()


def split_pretokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD_PATTERN})"), F.lit(1))


def byte_chars(word: Column) -> Column:
    """A word as one alphabet character per UTF-8 byte."""
    raw = F.decode(F.encode(word, "UTF-8"), "ISO-8859-1")
    return F.translate(raw, "".join(chr(b) for b in OTHER), "".join(BYTE_CHAR[b] for b in OTHER))


class Codec:
    """Applies a learned vocabulary to text inside a task."""

    def __init__(self, vocab: list[str], merges: list[tuple[str, str]], cache: int = 65536):
        self.ids = {t: i for i, t in enumerate(vocab)}
        self.tokens = vocab
        self.rank = {pair: i for i, pair in enumerate(merges)}
        self.reserved = set(reserved_tokens())
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in reserved_tokens()) + ")")
        self.words = regex.compile(WORD_PATTERN)
        self.word_ids = lru_cache(maxsize=cache)(self._word_ids)

    def _word_ids(self, word: str) -> list[int]:
        """Merges by rank, leftmost first, in n log n: a heap of pairs over a linked list of parts."""
        parts = [BYTE_CHAR[b] for b in word.encode("utf-8")]
        if not self.rank:
            return [self.ids[p] for p in parts]
        end = len(parts)
        after, before = list(range(1, end + 1)), list(range(-1, end - 1))
        heap: list[tuple[int, int, str, str]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < end:
                left, right = parts[at], parts[after[at]]
                if (rank := self.rank.get((left, right))) is not None:
                    heapq.heappush(heap, (rank, at, left, right))

        for at in range(end):
            offer(at)
        while heap:
            _rank, at, left, right = heapq.heappop(heap)
            gone = after[at]
            # A pair that an earlier merge took part of is no longer there.
            if parts[at] != left or gone >= end or parts[gone] != right:
                continue
            parts[at], parts[gone] = left + right, ""
            after[at] = after[gone]
            if after[at] < end:
                before[after[at]] = at
            offer(before[at])
            offer(at)
        return [self.ids[p] for p in parts if p]

    def encode(self, text: str, limit: int | None = None) -> list[int]:
        """Ids of the text; with a limit, encoding stops once that many are there."""
        out: list[int] = []
        start = 0
        for mark in [*self.cut.finditer(text), None]:
            for word in self.words.finditer(text, start, mark.start() if mark else len(text)):
                out.extend(self.word_ids(word.group()))
                if limit is not None and len(out) >= limit:
                    return out[:limit]
            if mark:
                out.append(self.ids[mark.group()])
                start = mark.end()
        return out if limit is None else out[:limit]

    def raw(self, ids) -> bytes:
        out = bytearray()
        for i in ids:
            token = self.tokens[i]
            out += token.encode("utf-8") if token in self.reserved else bytes(CHAR_BYTE[c] for c in token)
        return bytes(out)


def encoder(vocab: list[str] | None = None, merges: list[tuple[str, str]] | None = None, limit: int | None = None):
    """A Column function text -> ids, the first ``limit`` of them where one is given.

    Vocabulary size bounds what is shipped.  Without merges the first ids depend
    on so many of the longest tokens at most, and only this much text is shipped.
    """
    tokens, pairs = vocab or base_vocab(), merges or []
    holder: dict[str, Codec] = {}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def encode_ids(text: pd.Series) -> pd.Series:
        codec = holder.setdefault("codec", Codec(tokens, pairs))
        return text.map(lambda t: np.asarray(codec.encode(t, limit), dtype="int32"), na_action="ignore")

    if limit is None or pairs:
        return encode_ids
    return lambda text: encode_ids(F.left(text, F.lit(limit * max(map(len, tokens)))))


def decoder(vocab: list[str] | None = None, merges: list[tuple[str, str]] | None = None):
    """A Column function ids -> bytes (check with ``is_valid_utf8`` before showing)."""
    tokens, pairs = vocab or base_vocab(), merges or []
    holder: dict[str, Codec] = {}

    @F.pandas_udf(T.BinaryType())
    def decode_bytes(ids: pd.Series) -> pd.Series:
        codec = holder.setdefault("codec", Codec(tokens, pairs))
        return ids.map(codec.raw, na_action="ignore")

    return decode_bytes


def byte_ids(text: Column) -> Column:
    """Ids of a text under the byte vocabulary, one per UTF-8 byte; reserved tokens in it are plain text."""
    order = byte_tokens()
    table = F.split(F.lit(" ".join(str(len(reserved_tokens()) + order.index(BYTE_CHAR[b])) for b in range(256))), " ").cast("array<int>")
    raw = F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")
    return F.when(text == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(raw, ""), lambda c: F.element_at(table, F.ascii(c) + 1)))


def _is_text(data: Column) -> Column:
    """Whether bytes are text without a replacement character."""
    return F.is_valid_utf8(data) & ~F.contains(data, F.lit("\ufffd"))


def _from_hex(digits: Column) -> Column:
    return F.unhex(digits).cast("string")


def _goes_on(then: Column) -> Column:
    """Whether the next token, in hex, begins with a continuation byte."""
    return F.substring(then, 1, 1).between("8", "B")


def _pieces_of_text(raw: Column, after: Column) -> Column:
    """Pieces of tokens that are text as a whole: byte FF, which text never has, is put between pieces and read as U+FFFD."""
    within = lambda then: _goes_on(then) | (then == "")
    marked = F.array_join(F.zip_with(raw, after, lambda own, then: F.when(within(then), own).otherwise(F.concat(own, F.lit("FF")))), "")
    texts = F.split(_from_hex(marked), "\ufffd")
    ends = F.array_join(F.transform(after, lambda then: F.when(then == "", "").when(_goes_on(then), ".").otherwise("|")), "")
    return F.zip_with(F.split(ends, r"\|"), texts, lambda held, text: F.struct((F.length(held) + 1).alias("n_tokens"), text.alias("text")))


def _pieces_up_to_bad(raw: Column, after: Column) -> Column:
    """Pieces before the first one that is no text; of that one, the part that was text before a stray continuation byte."""
    marked = F.zip_with(raw, after, lambda own, then: F.concat(own, F.when(_goes_on(then), ",").otherwise("|")))
    text = lambda p: _from_hex(F.replace(p, F.lit(","), F.lit("")))

    def cut(listed: Column) -> Column:
        first_bad = F.array_position(F.transform(listed, lambda p: _is_text(text(p))), F.lit(False)).cast("int")
        tokens = F.split(F.element_at(listed, first_bad), ",")
        parts = F.transform(F.sequence(F.lit(1), F.size(tokens)), lambda n: F.array_join(F.slice(tokens, 1, n), ","))
        saved = F.slice(F.filter(parts, lambda p: _is_text(text(p))), 1, 1)
        return F.concat(F.slice(listed, 1, first_bad - 1), saved)

    kept = let(F.filter(F.split(F.array_join(marked, ""), r"\|"), lambda p: p != ""), cut)
    return F.transform(kept, lambda p: F.struct(F.size(F.split(p, ",")).alias("n_tokens"), text(p).alias("text")))


def streamed_pieces(ids: Column, vocab: list[str] | None = None) -> Column:
    """Pieces (n_tokens, text) of token ids as a stream shows them: tokens are held until their bytes form characters.

    A token ends a piece if the next one does not begin with a continuation byte.
    What follows a byte that no character has there, or a replacement character,
    is held for good.
    """
    codec = Codec(vocab or base_vocab(), [])
    table = F.split(F.lit(" ".join(codec.raw([i]).hex().upper() for i in range(len(codec.tokens)))), " ")

    def pieces(raw: Column) -> Column:
        after = F.concat(F.slice(raw, 2, F.greatest(F.size(raw), F.lit(1))), F.array(F.lit("")))
        whole = _is_text(_from_hex(F.array_join(raw, "")))
        return F.when(F.size(raw) == 0, F.array().cast("array<struct<n_tokens: int, text: string>>")).when(whole, _pieces_of_text(raw, after)).otherwise(_pieces_up_to_bad(raw, after))

    return let(F.transform(ids, lambda i: F.element_at(table, i + 1)), pieces)
