"""Best-fit packing of token pieces into sequences, under several capacities.

A sequence has room for tokens, for documents and for attention cost (the sum of
squared lengths).  Pieces come longest first; each goes to the open sequence
that can take it under every capacity and scores best: smallest norm of what is
then left (``norm``), or largest weighted product of demand and room (``dot``).

Pieces are dealt to groups of about ``GROUP_PIECES`` by a hash of their places in
the table of pieces, so rows that share an id are spread too, and every group is
packed on its own, so nothing grows with the input but the number of groups.
A group leaves at most a sequence or two half full among thousands.

* Null and empty texts are one end id.  Repeated rows are packed each.
* Any key may be null; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnloom.llm.tokenizing import TOKENIZER, encoder
from turnloom.session import cut_lineage

CAPACITY = 2048
GROUP_PIECES = 8192
WEIGHTS = (1.0, 0.05, 0.05)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, end_id: int = 0, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """Encodes documents, ends each with an id, and cuts those beyond a sequence."""

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        end = np.array([end_id], np.uint32)
        for batch in batches:
            rows = []
            for doc, ids in zip(batch["doc_id"], encoder(tokenizer).encode(batch["text"].tolist())):
                ids = np.concatenate([ids, end])
                data = ids.astype("<u4").tobytes()
                for k, a in enumerate(range(0, len(ids), capacity)):
                    rows.append((doc, k, a, min(capacity, len(ids) - a), zlib.crc32(data[4 * a : 4 * (a + capacity)])))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInPandas(pieces, PIECES)


def best_fit(
    lengths: np.ndarray,
    capacity: int = CAPACITY,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    score: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each length.

    The default limits of documents and cost are those that the token capacity
    implies, so by themselves they bind nothing.
    """
    limits = np.array([capacity, max_docs or capacity, max_cost or capacity**2], float)
    if len(lengths) and (lengths.max() > capacity or float(lengths.max()) ** 2 > limits[2]):
        raise ValueError("a piece is larger than a sequence")
    w = np.array(weights)
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    room, name = np.zeros((3, n)), np.zeros(n, np.int64)
    used = made = 0
    smallest = lengths.min(initial=capacity)
    for i in np.argsort(-lengths, kind="stable"):
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        left = room[:, :used] - need[:, None]
        fits = np.flatnonzero((left >= 0).all(0))
        if len(fits):
            if score == "norm":
                value = ((w[:, None] * left[:, fits] / limits[:, None]) ** 2).sum(0)
            else:
                value = -((w * need / limits**2)[:, None] * room[:, fits]).sum(0)
            at = fits[np.argmin(value)]
        else:
            at, used = used, used + 1
            room[:, at], name[at] = limits, made
            made += 1
        sequence[i], offset[i] = name[at], capacity - room[0, at]
        room[:, at] -= need
        if room[0, at] < smallest or room[1, at] < 1 or room[2, at] < float(smallest) ** 2:
            used -= 1
            room[:, at], name[at] = room[:, used], name[used]
    return sequence, offset


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, **rules) -> DataFrame:
    """Adds sequence_id and offset to a written table of pieces."""
    groups = max(1, -(-pieces.count() // group_pieces))
    names = pieces.columns
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.lit(7), F.monotonically_increasing_id()), F.lit(groups)).cast("int"))

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        sequence, offset = best_fit(group["length"].to_numpy(), capacity, **rules)
        return group.assign(sequence_id=group["_group"].to_numpy(np.int64) * 2**32 + sequence, offset=offset)[[*names, "sequence_id", "offset"]]

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return dealt.groupBy("_group").applyInPandas(packed, f"{fields}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, end_id: int = 0, capacity: int = CAPACITY, tokenizer: str = TOKENIZER) -> DataFrame:
    """All documents in as few sequences as best fit finds.

    The pieces (a few numbers each) are written once to the shared folder.
    """
    pieces, _ = cut_lineage(cut_pieces(docs, end_id, capacity, tokenizer), "pieces")
    return pack(pieces, capacity)
