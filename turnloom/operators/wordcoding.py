"""A learned vocabulary applied to words.

Texts are cut into reserved tokens and words.  Each batch of texts becomes its
distinct words and their places; distinct words are encoded once (a bounded store
of them is kept from batch to batch) and the ids are put to their places, so
texts are not moved.

Rows that share their keys become one, place by place, which needs the places as
rows: distinct words are then encoded in one table and joined back to them.
Words that make up much of a corpus are broadcast or salted by
``with_key_stats``, so no task holds all places of one word.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnloom.functions.bpe import Codec, reserved_tokens, split_pretokens
from turnloom.functions.joins import with_key_stats
from turnloom.operators.vocab import Vocabulary
from turnloom.session import cut_lineage

# Distinct words whose ids a task keeps.
KEPT_WORDS = 1 << 18


def _any_of(names: list[str]) -> str:
    """A pattern of these texts.  What all begin with stands in front, so that most places are passed over at their first character."""
    head = os.path.commonprefix(names)
    quoted = [re.sub(r"([^\w<>])", r"\\\1", x) for x in (head, *[name[len(head) :] for name in names])]
    return f"{quoted[0]}(?:{'|'.join(quoted[1:])})"


def text_pieces(text: Column) -> Column:
    """Reserved tokens and words of a text, in order; a word never goes over a reserved token."""
    names = reserved_tokens()
    one = _any_of(names)
    parts = F.split(text, f"(?={one})|(?<={one})", -1)
    fixed = F.array(*[F.lit(name) for name in names])
    cut = F.flatten(F.transform(parts, lambda p: F.when(F.array_contains(fixed, p), F.array(p)).otherwise(split_pretokens(p))))
    return F.when(text.rlike(one), cut).otherwise(split_pretokens(text))


def word_codes(words: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(word, n, ids) of a table of distinct pieces (word, n)."""
    tokens, merges = vocab.tokens, vocab.merges

    def encode(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        codec = Codec(tokens, merges, cache=0)
        for frame in frames:
            yield frame.assign(ids=[[codec.ids[w]] if w in codec.reserved else codec.word_ids(w) for w in frame["word"]])

    return words.select("word", "n").mapInPandas(encode, "word string, n bigint, ids array<int>")


def placed_codes(df: DataFrame, keys: list[str], text: str, vocab: Vocabulary) -> DataFrame:
    """(keys, at, ids): the ids of each piece of each text, by its place.

    A text without pieces, or a null one, is one row without place and ids.  The
    table of distinct words is written to the shared folder, so each word is
    encoded once.
    """
    pieces = df.select(*keys, F.posexplode_outer(text_pieces(F.col(text))).alias("at", "word"))
    counts = pieces.where("word IS NOT NULL").groupBy("word").agg(F.count("*").alias("n"))
    codes, _ = cut_lineage(word_codes(counts, vocab), "word-codes")
    return with_key_stats(pieces, codes, "word", "n").select(*keys, "at", "ids")


class _Coder:
    """Ids of words, the last so many of them kept."""

    def __init__(self, vocab: Vocabulary, most: int):
        self.codec, self.most, self.known = Codec(vocab.tokens, vocab.merges, cache=0), most, {}

    def ids(self, word: str) -> np.ndarray:
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= self.most:
                self.known.clear()
            own = [self.codec.ids[word]] if word in self.codec.reserved else self.codec.word_ids(word)
            found = self.known[word] = np.array(own, np.int32)
        return found

    def lists(self, pieces: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of lists of words: the first place of each and the end of the last, the number of each place's word, the words' ids one after the other, and where they end."""
        if isinstance(pieces, pa.ChunkedArray):
            pieces = pieces.combine_chunks()
        ends = np.concatenate([[0], np.cumsum(pieces.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        words = pieces.flatten().dictionary_encode()
        pool = [self.ids(w) for w in words.dictionary.to_pylist()]
        stops = np.cumsum(np.fromiter(map(len, pool), np.int64, len(pool)))
        return ends, words.indices.to_numpy(), np.concatenate([np.zeros(0, np.int32), *pool]), stops


def _coded(df: DataFrame, keys: list[str], text: str, vocab: Vocabulary, counts: bool) -> DataFrame:
    """(keys, ids) of every row, or (keys, n_tokens); null and empty texts have none."""
    out = "n_tokens" if counts else "ids"
    # A null text has no pieces.
    pieces = df.select(*keys, F.coalesce(text_pieces(F.col(text)), F.array().cast("array<string>")).alias("_pieces"))
    schema = T.StructType([*pieces.schema.fields[:-1], T.StructField(out, T.LongType() if counts else T.ArrayType(T.IntegerType()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Coder(vocab, KEPT_WORDS)
        for batch in batches:
            ends, which, pool, stops = coder.lists(batch.column(batch.num_columns - 1))
            sizes = np.diff(stops, prepend=0)
            upto = np.concatenate([[0], np.cumsum(sizes[which])])
            bounds = upto[ends]
            if counts:
                own = pa.array(np.diff(bounds))
            else:
                # The place of each id in the pool: from where its word's ids begin.
                begins = (stops - sizes)[which]
                at = np.arange(upto[-1]) + np.repeat(begins - upto[:-1], sizes[which])
                own = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(pool[at]))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names=[*batch.schema.names[:-1], out])

    return pieces.mapInArrow(encode, schema)


def encode_texts(df: DataFrame, keys: list[str], text: str, vocab: Vocabulary) -> DataFrame:
    """(keys, ids) of every text; ``keys`` name a row.  Null and empty texts have no ids.

    Rows that share their keys become one: their words in the order of places.
    Starts a job that looks for such rows.
    """
    if df.groupBy(*keys).count().where("count > 1").isEmpty():
        return _coded(df, keys, text, vocab, counts=False)
    placed = placed_codes(df, keys, text, vocab)
    parts = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "ids"))))
    return placed.groupBy(*keys).agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))


def token_counts(df: DataFrame, keys: list[str], text: str, vocab: Vocabulary) -> DataFrame:
    """(keys, n_tokens) of every text, without its ids: sums of the words' lengths."""
    return _coded(df, keys, text, vocab, counts=True).groupBy(*keys).agg(F.sum("n_tokens").alias("n_tokens"))


def decode_texts(df: DataFrame, keys: list[str], vocab: Vocabulary) -> DataFrame:
    """(keys, bytes) of rows (keys, ids): ids joined with the vocabulary's (id, bytes) table, whose size is that of the vocabulary.

    Null and empty ids give empty bytes.
    """
    codec = Codec(vocab.tokens, vocab.merges)
    rows = [(i, codec.raw([i])) for i in range(len(vocab.tokens))]
    table = df.sparkSession.createDataFrame(rows, "id int, bytes binary")
    placed = df.select(*keys, F.posexplode_outer("ids").alias("at", "id")).join(F.broadcast(table), "id", "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", F.hex("bytes").alias("h")))))
    return placed.groupBy(*keys).agg(F.unhex(F.array_join(F.transform(parts, lambda p: p["h"]), "")).alias("bytes"))
