"""N-gram Jaccard join by vertical partitioning, and the groups it links.

A document's set is its distinct shingles (3 words unless a caller says so; ASCII
letters lower-cased) as 64-bit hashes.  Equal sets are one class; everything below works on classes.

1. The order of all shingles is cut into fragments by hash.  Each document sends
   its shingles to the fragments as packed runs; a fragment counts in how many
   classes each of its shingles is, and keeps those in two or more.
2. Per class, the kept shingles meet again, rarest first.  Two sets with Jaccard
   t or more share a shingle among the first n - ceil(t n) + 1 of the order;
   shingles of one class alone stand first and link nothing, so most classes end
   here.
3. Classes that share such a shingle are candidates.  First each is held against
   the one of its bucket that has the fewest shingles of its own; what links is
   one component.  Then only candidates of different components are left, and
   all of them are held against each other: no link is lost, and a large group
   of near copies costs about one comparison per member.
4. A comparison counts the overlap of each fragment separately and sums per pair.
   Before that, sizes, shared sizes and shared sizes per fragment bound it.

Shingles in over about a hundredth of the documents skip the fragments: they are
found by counts per batch, are few by definition, and go straight to step 2.

* Null, empty and blank texts have no set and link with nothing.
* A text of fewer words than a shingle is one shingle.
* Repeated rows share a class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.common import scan_splits
from turnloom.llm.graph import components
from turnloom.llm.words import shingle_sets
from turnloom.session import cut_lineage

PERCENT = 90
SHINGLE = 3
FRAGMENTS = 64
FRAGMENT_KEYS = 1_000_000
BUCKET_CLASSES = 10_000
SEGMENTS = 16
HOT_SHARE = 100  # hot: in more than one in so many documents of a batch
BATCH_ROWS = 2000
_U = np.uint64
_HOT_DF = 2**40


def _class_id(own: np.ndarray) -> int:
    return int.from_bytes(blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True)


def _batches(frames: Iterator[pd.DataFrame], shingle: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    for frame in frames:
        for a in range(0, len(frame), BATCH_ROWS):
            part = frame.iloc[a : a + BATCH_ROWS]
            yield part, shingle_sets(part["text"].tolist(), shingle)


def class_table(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, mark, n, class, hot): mark is the text's hash, class is null for an empty set; hot lists a batch's frequent shingles."""

    def classes(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part, sets in _batches(frames, shingle):
            ids = [_class_id(s) if len(s) else None for s in sets]
            first = {c: i for i, c in reversed(list(enumerate(ids))) if c is not None}
            least = max(16, len(first) // HOT_SHARE)
            key, count = np.unique(np.concatenate([sets[i] for i in first.values()] or [np.zeros(0, _U)]), return_counts=True)
            often = count > least
            hot: list = [None] * len(part)
            if often.any():
                hot[0] = [{"key": k, "count": c} for k, c in zip(key[often].view(np.int64).tolist(), count[often].tolist())]
            yield pd.DataFrame({
                "doc_id": part["doc_id"].astype("Int64").to_numpy(), "mark": part["mark"].to_numpy(), "n": [len(s) for s in sets],
                "class": pd.array(ids, "Int64"), "hot": hot,
            })

    schema = "doc_id long, mark long, n long, class long, hot array<struct<key: long, count: long>>"
    return docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text").alias("mark")).mapInPandas(classes, schema)


def _runs(docs: DataFrame, fragments: int, buckets: int, hot: np.ndarray, shingle: int = SHINGLE) -> DataFrame:
    """Packed shingles by place: fragments 0, 1 ...; hot shingles by class bucket at -1, -2 ..."""
    shift = _U(64 - fragments.bit_length() + 1)
    hot_sorted = np.sort(hot)

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for _part, sets in _batches(frames, shingle):
            ids, own = [], []
            for s in sets:
                if len(s) and (c := _class_id(s)) not in seen:
                    seen.add(c)
                    ids.append(c)
                    own.append(s)
            if not own:
                continue
            size = np.fromiter(map(len, own), np.int64, len(own))
            key = np.concatenate(own)
            who = np.repeat(np.arange(len(own)), size)
            cls = np.array(ids, np.int64)
            place = (key >> shift).astype(np.int64) if fragments > 1 else np.zeros(len(key), np.int64)
            if len(hot_sorted):
                at = np.minimum(np.searchsorted(hot_sorted, key), len(hot_sorted) - 1)
                is_hot = hot_sorted[at] == key
                place[is_hot] = -1 - (cls[who[is_hot]] % buckets)
            order = np.argsort(place, kind="stable")
            place, key, who = place[order], key[order], who[order]
            cuts = np.flatnonzero(np.diff(place, prepend=place[0] - 1))
            ends = np.append(cuts[1:], len(place))
            rows = []
            for a, b in zip(cuts.tolist(), ends.tolist()):
                w = who[a:b]
                head = np.flatnonzero(np.diff(w, prepend=-1))
                runs = np.diff(np.append(head, b - a)).astype("<i4")
                k = np.ascontiguousarray(key[a:b].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7])
                rows.append((int(place[a]), cls[w[head]].astype("<i8").tobytes(), size[w[head]].astype("<i4").tobytes(), runs.tobytes(), k.tobytes()))
            yield pd.DataFrame(rows, columns=["place", "classes", "sizes", "runs", "keys"])

    return docs.select("text").mapInPandas(split, "place long, classes binary, sizes binary, runs binary, keys binary")


def _unpacked(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Classes, their set sizes, and per shingle its class's index and 7 low bytes; each class once per place."""
    cls = np.frombuffer(b"".join(rows["classes"]), "<i8")
    size = np.frombuffer(b"".join(rows["sizes"]), "<i4").astype(np.int64)
    runs = np.frombuffer(b"".join(rows["runs"]), "<i4")
    packed = np.frombuffer(b"".join(rows["keys"]), np.uint8).reshape(-1, 7)
    _, first = np.unique(cls, return_index=True)
    keep = np.zeros(len(cls), bool)
    keep[first] = True
    kept = np.repeat(keep, runs)
    key = np.zeros((np.count_nonzero(kept), 8), np.uint8)
    key[:, :7] = packed if kept.all() else packed[kept]
    return cls, size, np.repeat(np.arange(len(cls), dtype=np.int32), runs)[kept], key.view("<u8").ravel()


def _shared(runs: DataFrame, fragments: int, buckets: int) -> DataFrame:
    """Shingles in two or more classes, with that count, by class bucket."""
    shift = 64 - fragments.bit_length() + 1

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        place = int(rows["place"].iloc[0])
        if place < 0:  # hot shingles go on as they are
            return pd.DataFrame({"bucket": -1 - place, "cls": rows["classes"], "size": rows["sizes"], "key": rows["keys"], "df": None, "runs": rows["runs"]})
        cls, size, who, key = _unpacked(rows)
        order = np.argsort(key)
        key, who = key[order], who[order]
        del order
        same = key[1:] == key[:-1]
        some = np.concatenate([same, [False]]) | np.concatenate([[False], same]) if len(key) else np.zeros(0, bool)
        key, who = key[some], who[some]
        head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        df = np.diff(np.append(head, len(key)))
        df = np.repeat(df, df)
        cls, size = cls[who], size[who]
        if fragments > 1:  # the top byte again
            low = key & _U(2**56 - 1)
            key = low | ((_U(place) << _U(shift)) & _U(0xFF << 56))
        bucket = cls % buckets
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        out = []
        for a, b in zip(cuts.tolist(), np.append(cuts[1:], len(order)).tolist()):
            own = order[a:b]
            out.append((int(bucket[own[0]]), *(x[own].astype("<i8").tobytes() for x in (cls, size, key.view(np.int64), df)), None))
        return pd.DataFrame(out, columns=["bucket", "cls", "size", "key", "df", "runs"])

    return runs.groupBy("place").applyInPandas(count, "bucket long, cls binary, size binary, key binary, df binary, runs binary")


_CLASS = "class long, n long, own long, segments array<array<long>>, prefix array<long>"


def _classes(shared: DataFrame, hot: dict[int, int], percent: int) -> DataFrame:
    """Classes that can link: their shared shingles in segments and the first ones of the order."""
    low = np.array([k & (2**56 - 1) for k in hot], np.int64)
    by_low = np.argsort(low)
    low, whole = low[by_low], np.array(list(hot), np.int64)[by_low]
    rank = np.array(list(hot.values()), np.int64)[by_low]

    def gather(rows: pd.DataFrame) -> pd.DataFrame:
        plain, packed = rows[rows["runs"].isna()], rows[rows["runs"].notna()]
        cls, size, key, df = (np.frombuffer(b"".join(plain[c]), "<i8") for c in ("cls", "size", "key", "df"))
        if len(packed):
            more = _unpacked(pd.DataFrame({"classes": packed["cls"], "sizes": packed["size"], "runs": packed["runs"], "keys": packed["key"]}))
            at = np.searchsorted(low, more[3].astype(np.int64))
            cls, size = np.concatenate([cls, more[0][more[2]]]), np.concatenate([size, more[1][more[2]]])
            key, df = np.concatenate([key, whole[at]]), np.concatenate([df, _HOT_DF + rank[at]])
        order = np.lexsort((key, df, cls))
        cls, size, key = cls[order], size[order], key[order]
        head = np.flatnonzero(np.concatenate([[True], cls[1:] != cls[:-1]])) if len(cls) else np.zeros(0, np.int64)
        out = []
        for a, b in zip(head.tolist(), np.append(head[1:], len(cls)).tolist()):
            n, have = int(size[a]), b - a
            first = n - (percent * n + 99) // 100 + 1 - (n - have)
            if first > 0:
                own = np.sort(key[a:b].view(_U))
                cuts = np.searchsorted(own, np.arange(1, SEGMENTS, dtype=_U) << _U(64 - SEGMENTS.bit_length() + 1))
                out.append((int(cls[a]), n, n - have, [x.view(np.int64) for x in np.split(own, cuts)], key[a : a + first]))
        return pd.DataFrame(out, columns=["class", "n", "own", "segments", "prefix"])

    return shared.groupBy("bucket").applyInPandas(gather, _CLASS)


def _can_link(percent: int) -> Column:
    """Bounds on the overlap of candidates a and b, from sizes alone."""
    def enough(overlap: Column) -> Column:
        return 100 * overlap >= percent * (F.col("a.n") + F.col("b.n") - overlap)

    parts = F.aggregate(F.zip_with("a.counts", "b.counts", lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)
    have = F.least(F.col("a.n") - F.col("a.own"), F.col("b.n") - F.col("b.own"))
    return enough(F.least("a.n", "b.n")) & enough(have) & enough(parts)


def _verified(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that link: overlaps counted per segment and summed, in one row a pair."""
    left = classes.select(F.col("class").alias("a"), F.col("segments").alias("sa"))
    right = classes.select(F.col("class").alias("b"), F.col("segments").alias("sb"))
    partial = F.zip_with("sa", "sb", lambda x, y: F.size(F.array_intersect(x, y)))
    overlap = pairs.join(left, "a").join(right, "b").select("a", "b", "na", "nb", F.aggregate(partial, F.lit(0), lambda s, x: s + x).alias("both"))
    return overlap.where(100 * F.col("both") >= percent * (F.col("na") + F.col("nb") - F.col("both"))).select("a", "b")


def _pairs(rows: DataFrame) -> DataFrame:
    smaller = F.col("a.class") < F.col("b.class")
    pick = lambda x, y: F.when(smaller, F.col(x)).otherwise(F.col(y))
    return rows.select(
        pick("a.class", "b.class").alias("a"), pick("b.class", "a.class").alias("b"),
        pick("a.n", "b.n").alias("na"), pick("b.n", "a.n").alias("nb"),
    ).distinct()


def class_links(classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, root) of every class that links with another."""
    counted = classes.withColumn("counts", F.transform("segments", lambda s: F.size(s)))
    post = counted.select(F.explode("prefix").alias("key"), "class", "n", "own", "counts")
    # The one with the smallest share of shingles of its own stands for the bucket.
    fewest = F.min_by(F.struct("class", "n", "own", "counts"), F.struct(F.col("own") / F.col("n"), "class"))
    heads = post.groupBy("key").agg(fewest.alias("h"), F.min("class").alias("_lo"), F.max("class").alias("_hi")).where("_lo <> _hi")
    heads, _ = cut_lineage(heads.select("key", "h.*"), "bucket-heads")
    star = post.alias("a").join(heads.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.class") != F.col("b.class")) & _can_link(percent))
    near, _ = cut_lineage(_verified(_pairs(star), classes, percent), "star-links")
    roots, _ = cut_lineage(components(near.select(F.col("a").alias("u"), F.col("b").alias("v"))), "star-roots")

    labels = post.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    labelled, _ = cut_lineage(labels, "bucket-roots")
    mixed = labelled.groupBy("key").agg(F.min("root").alias("_lo"), F.max("root").alias("_hi")).where("_lo <> _hi").select("key")
    open_rows = labelled.join(mixed, "key")
    rest = open_rows.alias("a").join(open_rows.alias("b"), (F.col("a.key") == F.col("b.key")) & (F.col("a.class") < F.col("b.class")) & (F.col("a.root") != F.col("b.root")) & _can_link(percent))
    more = _verified(_pairs(rest), classes, percent)
    return components(near.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v")))


def _linked(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """(doc_id, mark, n, class, first) of every row; first is what stands for its component: no_id, doc_id, class, mark."""
    table, _ = cut_lineage(class_table(docs, shingle), "classes")
    totals = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("class")).first()
    fragments = 1 << max(FRAGMENTS, -(-totals[0] // FRAGMENT_KEYS)).bit_length() - 1
    buckets = max(scan_splits(docs), -(-totals[1] // BUCKET_CLASSES))
    # A hot shingle is in about one of HOT_SHARE documents or more, so there are at most HOT_SHARE times the mean set size.
    often = table.select(F.explode("hot").alias("h")).groupBy("h.key").agg(F.sum("h.count").alias("c"))
    hot_rows = often.where(F.col("c") * HOT_SHARE * 2 > totals[1]).orderBy("c", "key").collect()
    hot = {r["key"]: i for i, r in enumerate(hot_rows)}
    lows = {}
    for k in hot:  # keys that differ in the top byte alone can't both skip the fragments
        lows.setdefault(k & (2**56 - 1), k)
    hot = {k: i for k, i in hot.items() if lows[k & (2**56 - 1)] == k}

    runs = _runs(docs, fragments, buckets, np.array(list(hot), np.int64).view(_U), shingle)
    classes, _ = cut_lineage(_classes(_shared(runs, fragments, buckets), hot, percent), "link-classes")
    roots = class_links(classes, percent)

    # The smallest id first, null ids last, then the smallest class and mark.
    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "mark")).alias("low")
    members = table.where("class IS NOT NULL").groupBy("class").agg(low)
    rooted = members.join(roots.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    rooted, _ = cut_lineage(rooted, "class-roots")
    first = F.min(F.struct("low.no_id", "low.doc_id", "class", "low.mark")).alias("first")
    named, _ = cut_lineage(rooted.join(rooted.groupBy("root").agg(first), "root").select("class", "first"), "class-components")
    return table.join(named, "class", "left").select("doc_id", "mark", "n", "class", "first")


def link(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    return _linked(docs, percent, shingle).select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("first.doc_id", "doc_id").alias("component_id"),
    )


def one_of_each(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One row of each linked group: the one with the smallest doc_id.

    A row is known by its id and its text, so rows that share an id are judged
    each by its own text.  Null ids come after all others: where a group has no
    other, the row of the smallest text class stands for it.  Rows without words
    are no group and all stay, and so do exact repeats of a kept row.
    """
    stands = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.class") == F.col("class")) & (F.col("first.mark") == F.col("mark"))
    kept = _linked(docs, percent, shingle).where(F.col("class").isNull() | stands).select(F.col("doc_id").alias("_kept"), F.col("mark").alias("_mark")).distinct()
    return docs.join(kept, F.col("doc_id").cast("bigint").eqNullSafe(F.col("_kept")) & (F.xxhash64("text") == F.col("_mark")), "left_semi")
