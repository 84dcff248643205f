"""Cross-entropy difference under word n-grams: how much better a target model foretells a text than a background model.

Both models are interpolated word bigrams over one vocabulary, the distinct
lower-cased words of all documents and an end mark, with the same smoothing and,
after scaling, the same amount of text.  The target model learns from the
documents labelled good and not toxic, the background model from all documents.
A text's score is its mean loss under the target model minus that under the
background model, per token: lower is nearer to the target.

    P(w | v) = (n(v w) + k P1(w)) / (n(v) + k),   P1(w) = (n(w) + 1) / (N + V)

1. A first pass counts the vocabulary and finds words and pairs that may be hot
   (one in ``HOT_SHARE`` tokens, or half of that); there are at most
   2 ``HOT_SHARE`` of either.  A second pass counts those exactly.
2. Each document sends its pairs, as packed hashes, to the fragment of the word
   they foretell.  There all counts of that word meet: n(w), n(v w), and n(w) as
   the context of what follows it, whose share of the loss is -log(n(w) + k).
   Pairs of a hot word go by the pair's hash, as n(w) is known already; hot pairs
   are scored where they stand.  No table of counts is collected or broadcast.
3. A fragment gives back each document's sum (in 32-bit floats); these are added.

* Null, empty and blank texts have no tokens and null scores.
* Without labelled documents the target model is uniform.
* A document with several label rows is a target when all of them say so.
* Repeated rows count each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.words import mixed, text_runs, words_of
from turnloom.session import cut_lineage

STRENGTH = 5.0  # weight of the shorter context, in counts
HOT_SHARE = 1024
SEEN = 1 << 20  # distinct words a task holds before it hands them on
FRAGMENTS = 32
FRAGMENT_KEYS = 4_000_000
CHARS = 2_000_000
_U = np.uint64
_END, _START = _U(1), _U(2)
_STEP = _U(0x9E3779B97F4A7C15)
_HOT_BIT = _U(1 << 31)  # of a 32-bit word key: marks the place of a hot word in the list


def _grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words with end marks, the word before each, their pairs' hashes, and how many each text has."""
    w = words_of(texts, lower=True)
    n = np.diff(w.bounds)
    n += n > 0
    last = np.cumsum(n)[n > 0] - 1
    word = np.full(int(n.sum()), _END, _U)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = w.hash
    before = np.concatenate([[_START], word[:-1]]).astype(_U)[: len(word)]
    before[last[:-1] + 1] = _START
    with np.errstate(over="ignore"):
        pair = mixed(mixed(before * _STEP + _U(1)) + word)
    return word, before, pair, n


def _found(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Place of each sought value in the sorted keys, -1 where it isn't one."""
    if not len(keys):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[at] == sought, at, -1)


def _packed(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _unpacked(parts: list[bytes], width: int) -> np.ndarray:
    raw = np.frombuffer(b"".join(parts), np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def _survey(docs: DataFrame) -> tuple[int, int, np.ndarray]:
    """Tokens of all texts, size of the vocabulary, and the sorted keys of words and pairs that may be hot."""

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(0, _U)
        for batch in batches:
            for run in text_runs(batch["text"].tolist(), CHARS):
                word, _, pair, _ = _grams(run)
                hot = []
                for kind, keys in enumerate((word, pair)):
                    key, count = np.unique(keys, return_counts=True)
                    often = count * 2 * HOT_SHARE > len(word)
                    hot += [{"pair": kind, "key": k, "count": c} for k, c in zip(key[often].view(np.int64).tolist(), count[often].tolist())]
                    if not kind:
                        seen = np.union1d(seen, key)
                yield pd.DataFrame({"tokens": len(word), "words": [None], "hot": [hot]})
                if len(seen) > SEEN:
                    yield from words(seen)
                    seen = np.zeros(0, _U)
        yield from words(seen)

    def words(seen: np.ndarray) -> Iterator[pd.DataFrame]:
        for a in range(0, len(seen), 65536):
            yield pd.DataFrame({"tokens": 0, "words": [seen[a : a + 65536].view(np.int64)], "hot": [[]]})

    schema = "tokens long, words array<long>, hot array<struct<pair: int, key: long, count: long>>"
    table, _ = cut_lineage(docs.select("text").mapInPandas(look, schema), "vocabulary")
    tokens = table.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    size = table.select(F.explode("words")).distinct().count()
    # What is in one of HOT_SHARE tokens is, half of it or more, in runs where it is in one of 2 HOT_SHARE.
    often = table.select(F.explode("hot").alias("h")).groupBy("h.pair", "h.key").agg(F.sum("h.count").alias("c"))
    rows = often.where(F.col("c") * 2 * HOT_SHARE > tokens).select("key").collect()
    return tokens, size, np.unique(np.array([r["key"] for r in rows] + [int(_END)], np.int64).view(_U))


def is_target(labels: DataFrame) -> DataFrame:
    """Ids of documents whose labels all say good and not toxic."""
    good = F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))
    return labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(good).alias("_good")).where("_good").select("doc_id")


def _targets(labels: DataFrame) -> DataFrame:
    # Labels grow with the documents: shuffled at every size, so that the plan is the same at all of them.
    return is_target(labels).select(F.col("doc_id").alias("_good")).hint("shuffle_merge")


def _hot_counts(docs: DataFrame, labels: DataFrame, hot: np.ndarray) -> np.ndarray:
    """n and t of each hot key, then of all tokens, then of all texts with tokens: (2, len(hot) + 2)."""
    width = len(hot) + 2

    def sparse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = 0
            for run in text_runs(batch["text"].tolist(), CHARS):
                word, _, pair, n = _grams(run)
                doc = np.repeat(np.arange(len(run)), n)
                cells = [doc[k >= 0] * width + k[k >= 0] for k in (_found(hot, word), _found(hot, pair))]
                cell, count = np.unique(np.concatenate(cells), return_counts=True)
                cuts = np.searchsorted(cell, np.arange(1, len(run)) * width)
                yield pd.DataFrame({
                    "doc_id": batch["doc_id"].iloc[at : at + len(run)].astype("Int64").to_numpy(), "n": n,
                    "at": [x.tobytes() for x in np.split((cell % width).astype("<u2"), cuts)],
                    "count": [x.tobytes() for x in np.split(count.astype("<u4"), cuts)],
                })
                at += len(run)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((2, width))
        for batch in batches:
            at, count = (np.frombuffer(b"".join(batch[c]), t).astype(np.int64) for c, t in (("at", "<u2"), ("count", "<u4")))
            own = np.repeat(batch["target"].to_numpy(bool), [len(x) // 2 for x in batch["at"]])
            n, target = batch["n"].to_numpy(), batch["target"].to_numpy(bool)
            for row, cells, texts in ((0, slice(None), slice(None)), (1, own, target)):
                sums[row] += np.bincount(at[cells], count[cells], width)
                sums[row, -2:] += n[texts].sum(), (n[texts] > 0).sum()
        yield pd.DataFrame({"at": np.arange(width), "n": sums[0].astype(np.int64), "t": sums[1].astype(np.int64)})

    rows = docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(sparse, "doc_id long, n long, at binary, count binary")
    marked = rows.join(_targets(labels), F.col("doc_id") == F.col("_good"), "left").withColumn("target", F.col("_good").isNotNull())
    counted = marked.select("n", "at", "count", "target").mapInPandas(summed, "at long, n long, t long")
    out = np.zeros((2, width))
    for r in counted.groupBy("at").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).collect():  # at most 4 HOT_SHARE + 3 rows
        out[:, r["at"]] = r["n"], r["t"]
    return out


_RUNS = "place long, run long, lengths binary, targets binary, words binary, befores binary, ids array<long>, n array<long>, base array<double>"


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ce_target, ce_background, score) of every document."""
    tokens, size, hot = _survey(docs)
    counts = _hot_counts(docs, labels, hot)
    total = counts[:, -2]
    scale = total[1] / total[0] if total.all() else 1.0
    fragments = 1 << max(FRAGMENTS, -(-tokens // FRAGMENT_KEYS)).bit_length() - 1
    bits = _U(fragments.bit_length() - 1)
    # Rows of what follows: target, background.
    scales, sums = np.array([1.0, scale]), np.array([total[1], total[0] * scale])
    known = counts[::-1, :-2] * scales[:, None]
    firsts = np.log(counts[::-1, -1] * scales + STRENGTH)

    def alone(n: np.ndarray) -> np.ndarray:
        return (n + 1.0) / (sums + size)[:, None]

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        made = TaskContext.get().partitionId() << 32
        for batch in batches:
            at = 0
            for texts in text_runs(batch["text"].tolist(), CHARS):
                part = batch.iloc[at : at + len(texts)]
                at += len(texts)
                word, before, pair, n = _grams(texts)
                doc = np.repeat(np.arange(len(texts)), n)
                hot_word, hot_pair = _found(hot, word), _found(hot, pair)
                base = np.where(n > 0, -firsts[:, None], 0.0)
                ends = (hot_word >= 0) & (word != _END)
                both = hot_pair >= 0
                for k in (0, 1):
                    base[k] -= np.bincount(doc[ends], np.log(known[k, hot_word[ends]] + STRENGTH), len(texts))
                    chance = known[k, hot_pair[both]] + STRENGTH * alone(known[:, hot_word[both]])[k]
                    base[k] += np.bincount(doc[both], np.log(chance), len(texts))
                send = ~both
                word, before, pair, doc, hot_word = word[send], before[send], pair[send], doc[send], hot_word[send]
                is_hot = hot_word >= 0
                key = np.where(is_hot, pair, word)
                place = (key >> (_U(64) - bits)).astype(np.int64)
                # 31 bits of a cold word beside those of its place; a hot one is known by its place in the list.
                name = np.where(is_hot, hot_word.astype(_U) | _HOT_BIT, word & (_HOT_BIT - _U(1)))
                order = np.lexsort((doc, place))
                place, name, before, doc = place[order], name[order], before[order], doc[order]
                cuts = np.flatnonzero(np.diff(place, prepend=-1))
                targets = part["target"].to_numpy(bool).astype(np.uint8).tobytes()
                rows = [
                    (int(place[a]), made, np.bincount(doc[a:b], minlength=len(texts)).astype("<u4").tobytes(), targets, _packed(name[a:b], 4), _packed(before[a:b], 5), None, None, None)
                    for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(place)).tolist())
                ]
                ids = [None if pd.isna(x) else int(x) for x in part["doc_id"]]
                rows.append((-1 - made, made, None, None, None, None, ids, n.tolist(), base.ravel().tolist()))
                yield pd.DataFrame(rows, columns=[c.split()[0] for c in _RUNS.split(", ")])
                made += 1

    def fragment(rows: pd.DataFrame) -> pd.DataFrame:
        if rows["place"].iloc[0] < 0:
            return rows[["run", "ids", "n", "base"]].assign(sums=None)
        lengths = [np.frombuffer(x, "<u4") for x in rows["lengths"]]
        length = np.concatenate(lengths)
        doc = np.repeat(np.arange(len(length), dtype=np.int32), length)
        target = np.frombuffer(b"".join(rows["targets"]), np.uint8)[doc].astype(bool)
        name, before = _unpacked(rows["words"].tolist(), 4), _unpacked(rows["befores"].tolist(), 5)
        order = np.lexsort((before, name))
        name, before, doc, target = name[order], before[order], doc[order], target[order]
        new_word = np.concatenate([[True], name[1:] != name[:-1]])
        new_pair = new_word | np.concatenate([[True], before[1:] != before[:-1]])
        del before, order
        # Counts of pairs and words, each at the first place of its pair or word.
        pair_at, word_at = np.flatnonzero(new_pair), np.flatnonzero(new_word)
        of_word = np.cumsum(new_word)[pair_at] - 1
        first = name[word_at]
        is_hot = (first & _HOT_BIT) > 0
        listed = (first & (_HOT_BIT - _U(1))).astype(np.int64)
        reps = np.diff(np.append(pair_at, len(name)))
        pairs = np.stack([np.add.reduceat(target, pair_at, dtype=np.int64), reps]) * scales[:, None]
        words = np.stack([np.add.reduceat(target, word_at, dtype=np.int64), np.diff(np.append(word_at, len(name)))]) * scales[:, None]
        words[:, is_hot] = known[:, listed[is_hot]]
        gain = np.log(pairs + STRENGTH * alone(words)[:, of_word])
        gain -= np.where(is_hot, 0.0, np.log(words + STRENGTH))[:, of_word]  # a hot word's share as context is in the base
        sums_of = [np.bincount(doc, np.repeat(g, reps), len(length)).astype("<f4") for g in gain]
        cuts = np.cumsum([len(x) for x in lengths])[:-1]
        parts = zip(*(np.split(s, cuts) for s in sums_of))
        return pd.DataFrame({"run": rows["run"].to_numpy(), "ids": None, "n": None, "base": None, "sums": [np.concatenate(p).tobytes() for p in parts]})

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows[rows["sums"].isna()].iloc[0]
        loss = -np.array(head["base"], float)
        for x in sorted(rows["sums"].dropna()):
            loss -= np.frombuffer(x, "<f4")
        n = np.array(head["n"], np.int64)
        mean = loss.reshape(2, -1) / np.where(n > 0, n, np.nan)
        # An id list with nulls comes as floats unless it is taken value by value.
        ids = pd.array([None if x is None or x != x else int(x) for x in head["ids"]], "Int64")
        return pd.DataFrame({"doc_id": ids, "n_tokens": n, "ce_target": mean[0], "ce_background": mean[1], "score": mean[0] - mean[1]})

    # A fixed order, so that a run is the same documents when its task is done again.
    marked = docs.select(F.col("doc_id").cast("bigint"), "text").join(_targets(labels), F.col("doc_id") == F.col("_good"), "left")
    marked = marked.select("doc_id", "text", F.col("_good").isNotNull().alias("target")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    pieces = marked.mapInPandas(runs, _RUNS).groupBy("place").applyInPandas(fragment, "run long, ids array<long>, n array<long>, base array<double>, sums binary")
    out = pieces.groupBy("run").applyInPandas(added, "doc_id long, n_tokens long, ce_target double, ce_background double, score double")
    return out.select("doc_id", "n_tokens", *[F.nanvl(c, F.lit(None)).alias(c) for c in ("ce_target", "ce_background", "score")])
