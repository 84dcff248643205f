"""Vocabulary learning by distributed counting, and vocabulary tables."""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnloom import constants as K
from turnloom.functions.arrays import drop_end, drop_start
from turnloom.functions.bpe import base_vocab, byte_chars, byte_tokens, reserved_tokens, split_pretokens
from turnloom.functions.text import truthy
from turnloom.session import cut_lineage, drop_scratch

# Inside the trainer a word is a string with one character per token: token id i
# is chr(0x100 + i).  Merging a pair is then a plain string replace (left to
# right, no overlaps) and ordering two-character strings orders pairs by ids.
CODE_BASE = 0x100
MAX_VOCAB = 0xD800 - CODE_BASE


def corpus_text(conversation: Column, text: Column) -> Column:
    """Non-empty contents joined by newlines; a conversation goes before text."""
    said = F.filter(F.transform(conversation, lambda m: m["content"]), lambda c: truthy(c).isNotNull())
    joined = F.when(F.size(said) > 0, F.array_join(said, "\n"))
    return F.when(conversation.isNotNull(), joined).otherwise(truthy(text))


def special_tokens(spark: SparkSession) -> DataFrame:
    """(id, token, special): 36 reserved tokens; only the first 21 are special."""
    rows = [(i, t, t in K.SPECIAL_TOKENS) for i, t in enumerate(reserved_tokens())]
    return spark.createDataFrame(rows, "id int, token string, special boolean")


def pretoken_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """Distinct words and how often they occur, combined before the shuffle."""
    words = df.select(F.explode(split_pretokens(F.col(text))).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n"))


def adjacent(symbols: Column, sep: str = "") -> Column:
    return F.zip_with(drop_end(symbols), drop_start(symbols), lambda a, b: F.concat(a, F.lit(sep), b))


def pair_counts(words: DataFrame) -> DataFrame:
    """Adjacent byte pairs over all words, weighted by the word's count."""
    chars = F.split(byte_chars(F.col("word")), "")
    pairs = words.select(F.explode(adjacent(chars)).alias("pair"), "n")
    return pairs.groupBy(F.substring("pair", 1, 1).alias("left"), F.substring("pair", 2, 1).alias("right")).agg(
        F.sum("n").alias("n")
    )


@dataclass
class Vocabulary:
    tokens: list[str]
    merges: list[tuple[str, str]]

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, t in K.SPECIAL_TOKENS) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "id int, token string, special boolean")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, a, b) for i, (a, b) in enumerate(self.merges)]
        return spark.createDataFrame(rows, "rank int, left string, right string")


def _coded(words: DataFrame) -> DataFrame:
    """Words as strings of token codes, ready for merging."""
    first = CODE_BASE + K.RESERVED_COUNT
    alphabet = byte_tokens()
    codes = "".join(chr(first + i) for i in range(len(alphabet)))
    return words.select(F.translate(byte_chars(F.col("word")), "".join(alphabet), codes).alias("w"), "n")


def _windows(word: Column) -> Column:
    """All two-character windows of a coded word, overlapping; codes may be line separators."""
    return F.regexp_extract_all(word, F.lit("(?s)(?=(..))"), F.lit(1))


def _units(words: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of some words with a zero between words, each code's word, and which codes have a neighbour behind them in their word."""
    codes = np.frombuffer("\0".join(words).encode("utf-16-le"), "<u2")
    return codes, np.cumsum(codes == 0), (codes[:-1] != 0) & (codes[1:] != 0)


def _pair_keys(codes: np.ndarray) -> np.ndarray:
    return codes[:-1].astype(np.uint32) << 16 | codes[1:]


def _first_pairs(words: DataFrame) -> DataFrame:
    """(pair, n): adjacent tokens over all words, summed batch by batch before they are shuffled."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            codes, word, inside = _units(frame["w"])
            keys, which = np.unique(_pair_keys(codes)[inside], return_inverse=True)
            n = np.zeros(len(keys), np.int64)
            np.add.at(n, which, frame["n"].to_numpy(np.int64)[word[:-1][inside]])
            both = np.stack([keys >> 16, keys & 0xFFFF], 1).astype("<u2").tobytes().decode("utf-16-le")
            yield pd.DataFrame({"pair": [both[i : i + 2] for i in range(0, len(both), 2)], "n": n}).astype({"pair": "str"})

    return words.select("w", "n").mapInPandas(count, "pair string, n bigint").groupBy("pair").agg(F.sum("n").cast("bigint").alias("n"))


def _segments(words: DataFrame, tracked: set[str]) -> DataFrame:
    """(w, n): the longest runs of tokens whose adjacent pairs are all tracked, each distinct one once."""
    known = np.sort([ord(p[0]) << 16 | ord(p[1]) for p in tracked]).astype(np.uint32)

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            codes, word, inside = _units(frame["w"])
            at = np.flatnonzero(inside & ~np.isin(_pair_keys(codes), known)) + 1
            codes, word = np.insert(codes, at, 0), np.insert(word, at, word[at])
            ends = np.flatnonzero(codes == 0)
            long = np.diff(ends, prepend=-1, append=len(codes)) > 2
            n = frame["n"].to_numpy(np.int64)[np.append(word[:1], word[ends])]
            held: dict[str, int] = {}
            for part, k in zip(compress(codes.tobytes().decode("utf-16-le").split("\0"), long), n[long].tolist()):
                held[part] = held.get(part, 0) + k
            yield pd.DataFrame({"w": list(held), "n": list(held.values())}).astype({"w": "str", "n": "int64"})

    return words.select("w", "n").mapInPandas(cut, "w string, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


class _Replay:
    """Merges on a table of distinct segments, with exact counts and an index from pairs to segments.

    The index only grows: a segment that has lost a pair is passed over when the
    pair comes up.
    """

    def __init__(self, segments: list[str], counts: list[int]):
        self.words, self.weights = segments, counts
        self.holders: dict[str, array] = {}
        self.counts: dict[str, int] = {}
        for at, (word, n) in enumerate(zip(segments, counts)):
            pairs = [word[i : i + 2] for i in range(len(word) - 1)]
            for p in pairs:
                self.counts[p] = self.counts.get(p, 0) + n
            for p in set(pairs):
                self.holders.setdefault(p, array("I")).append(at)
        self.heap = [(-n, p) for p, n in self.counts.items()]
        heapq.heapify(self.heap)

    def best(self) -> tuple[int, str] | None:
        """(minus its count, the pair) that is next: the largest count, then the lower ids."""
        while self.heap:
            n, pair = self.heap[0]
            if self.counts.get(pair) == -n:
                return n, pair
            heapq.heappop(self.heap)
        return None

    def merge(self, pair: str, token: str) -> None:
        change: dict[str, int] = {}
        for at in self.holders.pop(pair):
            old = self.words[at]
            if pair not in old:
                continue
            new = self.words[at] = old.replace(pair, token)
            for word, by in ((old, -self.weights[at]), (new, self.weights[at])):
                for i in range(len(word) - 1):
                    p = word[i : i + 2]
                    change[p] = change.get(p, 0) + by
            for p in {new[i : i + 2] for i in range(len(new) - 1)}:
                if token in p:
                    self.holders.setdefault(p, array("I")).append(at)
        for p, by in change.items():
            n = self.counts[p] = self.counts.get(p, 0) + by
            if n > 0 and by:
                heapq.heappush(self.heap, (-n, p))
        self.counts.pop(pair)


def _merged(words: DataFrame, merges: list[tuple[str, str]]) -> DataFrame:
    """Words after the merges (pair, token), in their order."""
    rank = {pair: i for i, (pair, _) in enumerate(merges)}

    def merged(word: str) -> str:
        last = -1
        while len(word) > 1:
            # A merge is past once a later one is done: a token that an old pair holds may come up again.
            left = [r for i in range(len(word) - 1) if (r := rank.get(word[i : i + 2], -1)) > last]
            if not left:
                break
            last = min(left)
            word = word.replace(*merges[last])
        return word

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(w=[merged(w) for w in frame["w"]])

    return words.select("w", "n").mapInPandas(run, "w string, n bigint").where(F.length("w") > 1)


def learn_vocab(words: DataFrame, vocab_size: int = 8000, ranked: int = 4096, most_segments: int = 200_000) -> Vocabulary:
    """Byte-pair merges over a table of distinct words (word, n).

    The corpus is read once, for the word table.  A round counts all pairs with a
    grouped sum and tracks the most frequent ones, up to ``ranked``.  Words are cut
    wherever an adjacent pair is not tracked; the distinct segments, summed over
    all words, are all that merges of tracked pairs and of what they give birth
    to depend on.  So the driver takes them, ``most_segments`` at most, and merges
    one pair after the other with exact counts, hundreds or thousands a round.
    Then the words get these merges and are written to the shared folder, which
    bounds what a lost executor costs.

    The result is that of one merge at a time over all words: a pair over a cut,
    whatever its sides have grown to, occurs at most as often as the pair of
    tokens that was cut there, and with equal counts its newer tokens come later.
    So a round ends when the next pair is no longer ahead of the first pair that
    is not tracked.  It also ends after a merge that yields a token which already
    exists, as that token's pairs may lie over cuts and inside segments.

    Where too many segments are found, fewer pairs are tracked; a table of many
    words begins with few, as a scan that finds too many is lost.  Starts jobs.
    """
    if vocab_size > MAX_VOCAB:
        raise ValueError(f"vocab_size must be at most {MAX_VOCAB}")
    spark = words.sparkSession
    tokens = base_vocab()
    ids = {t: i for i, t in enumerate(tokens)}
    merges: list[tuple[str, str]] = []
    now, path = cut_lineage(_coded(words).where(F.length("w") > 1), "words")
    width = ranked if now.count() <= 4 * most_segments else max(1, ranked // 64)
    while len(tokens) < vocab_size:
        best = _first_pairs(now).orderBy(F.desc("n"), "pair").limit(ranked + 1).collect()
        if not best:
            break
        width = min(width, ranked)
        while True:
            found = _segments(now, {r["pair"] for r in best[:width]})
            # Segments of one pair are that pair, or runs of one token: a handful.
            table = (found.limit(most_segments + 1) if width > 1 else found).toPandas()
            if len(table) <= most_segments or width == 1:
                break
            width = width // (4 if width > 64 else 2)
        rest = (-best[width]["n"], best[width]["pair"]) if len(best) > width else (0, "")
        replay, done = _Replay(table["w"].tolist(), table["n"].tolist()), []
        rising = False
        while len(tokens) < vocab_size and not rising and (first := replay.best()) and first < rest:
            pair = first[1]
            left, right = (tokens[ord(c) - CODE_BASE] for c in pair)
            made = left + right
            rising = made in ids
            if not rising:
                ids[made] = len(tokens)
                tokens.append(made)
            merges.append((left, right))
            done.append((pair, chr(CODE_BASE + ids[made])))
            replay.merge(*done[-1])
        after, new_path = cut_lineage(_merged(now, done), "words")
        drop_scratch(spark, path)
        now, path = after, new_path
        if 4 * len(table) < most_segments:
            width *= 4
    drop_scratch(spark, path)
    return Vocabulary(tokens, merges)


def export_row(spark: SparkSession, vocab: Vocabulary) -> DataFrame:
    """Vocabulary with splitter and decoder as a file that public tokenizer libraries load, and the settings beside it.

    Two JSON documents, ``tokenizer`` and ``config``; their size is that of the vocabulary.
    """
    splitter = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}
    doc = {
        "version": "1.0", "truncation": None, "padding": None, "normalizer": None, "post_processor": None,
        "pre_tokenizer": splitter, "decoder": splitter,
        "model": {
            "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
            "fuse_unk": False, "byte_fallback": False, "ignore_merges": False,
            "vocab": {t: i for i, t in enumerate(vocab.tokens)}, "merges": [list(m) for m in vocab.merges],
        },
        "added_tokens": [
            {"id": i, "content": t, **flags, "special": t in K.SPECIAL_TOKENS} for i, t in enumerate(reserved_tokens())
        ],
    }
    config = {
        "bos_token": K.BOS, "eos_token": K.EOS, "pad_token": K.PAD, "unk_token": K.PAD,
        "add_prefix_space": False, "model_max_length": 131072,
    }
    return spark.createDataFrame([(json.dumps(doc, ensure_ascii=False), json.dumps(config))], "tokenizer string, config string")


def compression(df: DataFrame, n_chars: Column, n_tokens: Column, by: str) -> DataFrame:
    """Mean over rows of characters per token (not the ratio of the sums)."""
    return df.where(n_tokens > 0).groupBy(by).agg(
        F.count("*").alias("n_rows"), F.round(F.avg(n_chars / n_tokens), 6).alias("chars_per_token")
    )


def round_trip(df: DataFrame, text: Column, ids: Column, decode, by: str) -> DataFrame:
    """Rows whose decoded ids differ from the text, per group."""
    back = df.select(by, text.alias("t"), decode(ids).alias("b"))
    return back.groupBy(by).agg(
        F.count("*").alias("n_rows"), F.count_if(F.encode("t", "UTF-8") != F.col("b")).alias("n_changed")
    )
