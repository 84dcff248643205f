"""Assembling streamed responses: text pieces -> reasoning, content, calls, finish.

A response is open until its last piece.  One that starts in thinking reasons up
to the first think close tag; all others are content from the start.  The stream
version keeps only what it cannot decide yet: a few characters that may begin a
tag, a call that is open, pieces that came before their turn.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

from turnloom.constants import CALL_CLOSE, CALL_OPEN, THINK_CLOSE, THINK_OPEN
from turnloom.functions.joins import with_key_stats

PART_CHUNKS = 1024

DELTA = T.StructType(
    [
        T.StructField("response_id", T.LongType()), T.StructField("seq", T.IntegerType()),
        T.StructField("kind", T.StringType()), T.StructField("delta", T.StringType()),
    ]
)
HEAD = "next int, thinking boolean, tail string, skip boolean, watch string, n_entries int"
# Groups that responses are dealt to; a checkpoint holds for this number.
BUCKETS = 256
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _held_back(text: str, tag: str) -> int:
    """Characters at the end of the text that may begin the tag."""
    return next((n for n in range(min(len(tag) - 1, len(text)), 0, -1) if tag.startswith(text[-n:])), 0)


class CallWatch:
    """Tool calls of a text that comes in pieces.

    Only calls outside think blocks count.  Without a whole block, a lone close
    tag makes all before it reasoning; an open tag that is never closed hides
    nothing.  So two searches run: ``main`` leaves out the blocks closed so far,
    ``late`` starts at the first close tag.  Held are an open call, the state
    before an open block, and the characters that may begin a tag.
    """

    def __init__(self, saved: dict | None = None):
        self.s = saved or {"tail": "", "block": False, "blocks": 0, "trim": False, "main": self.fresh(), "before": None, "late": None}

    @staticmethod
    def fresh() -> dict:
        return {"buf": "", "seen": 0, "calls": []}

    @staticmethod
    def _search(w: dict, text: str) -> None:
        buf = w["buf"] + text
        while True:
            at = buf.find(CALL_OPEN)
            if at < 0:
                buf = buf[len(buf) - _held_back(buf, CALL_OPEN) :]
                w["seen"] = 0
                break
            # What an earlier piece was searched for is not searched again.
            end = buf.find(CALL_CLOSE, at + max(len(CALL_OPEN), w["seen"] - len(CALL_CLOSE)))
            if end < 0:
                buf = buf[at:]
                w["seen"] = len(buf)
                break
            try:
                call = json.loads(buf[at + len(CALL_OPEN) : end].strip())
                if isinstance(call, dict):
                    w["calls"].append(json.dumps(call, ensure_ascii=False))
            except ValueError:
                pass
            buf = buf[end + len(CALL_CLOSE) :]
            w["seen"] = 0
        w["buf"] = buf

    def _feed(self, text: str, late: bool = True) -> None:
        s = self.s
        if late and s["late"] is not None:
            self._search(s["late"], text)
        if s["trim"]:
            text = text.lstrip()
            s["trim"] = not text
        self._search(s["main"], text)

    def add(self, text: str, done: bool) -> None:
        s = self.s
        text = s["tail"] + text
        while True:
            tags = [THINK_CLOSE] if s["block"] else [THINK_OPEN, THINK_CLOSE]
            at, tag = min(((text.find(t), t) for t in tags if t in text), default=(-1, ""))
            if at < 0:
                break
            self._feed(text[:at])
            text = text[at + len(tag) :]
            first_close = tag == THINK_CLOSE and s["late"] is None
            if tag == THINK_OPEN:
                s.update(block=True, before=json.dumps(s["main"]))
                self._feed(tag)
            elif s["block"]:
                if s["late"] is not None:
                    self._search(s["late"], tag)
                s.update(block=False, blocks=s["blocks"] + 1, trim=True, main=json.loads(s["before"]), before=None)
            else:
                self._feed(tag)
            if first_close:
                s["late"] = self.fresh()
        keep = 0 if done else max(_held_back(text, THINK_OPEN), _held_back(text, THINK_CLOSE))
        s["tail"] = text[len(text) - keep :]
        self._feed(text[: len(text) - keep])

    def calls(self) -> list[str]:
        whole = self.s["blocks"] or self.s["late"] is None
        return self.s["main" if whole else "late"]["calls"]


class Assembler:
    """The undecided rest of one response: HEAD without the number of entries that wait."""

    def __init__(self, saved: tuple | None = None, thinking: bool = False):
        self.next, self.thinking, self.tail, self.skip, watch = saved or (0, thinking, "", False, None)
        self.watch = CallWatch(json.loads(watch) if watch else None)
        self.early: dict[int, tuple[str, bool]] = {}
        self.over = False

    def save(self) -> tuple:
        return self.next, self.thinking, self.tail, self.skip, json.dumps(self.watch.s, ensure_ascii=False)

    def _say(self, seq: int, text: str, done: bool):
        self.watch.add(text, done)
        if self.thinking:
            text = self.tail + text
            at = text.find(THINK_CLOSE)
            keep = 0 if done else _held_back(text, THINK_CLOSE)
            reasoning = text[:at] if at >= 0 else text[: len(text) - keep]
            self.tail = "" if at >= 0 else text[len(text) - keep :]
            if reasoning:
                yield seq, "reasoning", reasoning
            if at < 0:
                return
            self.thinking, self.skip = False, True
            text = text[at + len(THINK_CLOSE) :]
        if self.skip:
            text = text.lstrip("\n")
            self.skip = not text
        if text:
            yield seq, "content", text

    def add(self, pieces: Iterable[tuple[int, str | None, bool]]):
        """Rows that these pieces decide; pieces that come early wait for their turn.

        Pieces that follow each other are read as one, up to the end of a part;
        their rows have the number of the last of them.
        """
        for seq, text, done in pieces:
            if seq >= self.next:
                self.early.setdefault(seq, (text or "", bool(done)))
        while self.next in self.early:
            texts, done = [], False
            while self.next in self.early and not done and not (texts and self.next % PART_CHUNKS == 0):
                text, done = self.early.pop(self.next)
                texts.append(text)
                self.next += 1
            yield from self._say(self.next - 1, "".join(texts), done)
            if done:
                yield from self.finish(self.next - 1, "tool_calls" if self.watch.calls() else "stop")
                return

    def finish(self, seq: int, reason: str):
        self.over = True
        for call in self.watch.calls():
            yield seq, "tool_call", call
        yield seq, "finish", reason


class Responses(StatefulProcessor):
    """Open responses as state: a head, pieces that wait as entries of a map, and a mark of those that ended.

    Pieces that wait are written once, packed into entries of up to a part, and an
    entry is taken out once all of it was said.  The mark keeps late repeats of a
    response from opening it again.
    """

    def __init__(self, idle_ms: int | None, forget_ms: int | None):
        self.idle_ms, self.forget_ms = idle_ms, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.head = handle.getValueState("head", HEAD)
        self.waiting = handle.getMapState("waiting", "entry int", "last int, pieces string")
        self.ended = handle.getValueState("ended", "over boolean", self.forget_ms)

    def _frame(self, key: tuple, rows: list[tuple]) -> pd.DataFrame:
        # By column: pandas takes a list of rows apart cell by cell, which cost half of a short response.
        return pd.DataFrame(dict(zip(DELTA.fieldNames(), ([key[0]] * len(rows), *map(list, zip(*rows))))))

    def _close(self) -> None:
        self.head.clear()
        self.waiting.clear()
        self.ended.update((True,))

    def _wait(self, now: int | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if now is not None:
            self.handle.registerTimer(now + self.idle_ms)

    def _keep(self, early: dict[int, tuple[str, bool]], entry: int) -> int:
        """Writes pieces that wait as entries from this number on; returns how many."""
        seqs = sorted(early)
        packs = [seqs[i : i + PART_CHUNKS] for i in range(0, len(seqs), PART_CHUNKS)]
        for i, pack in enumerate(packs):
            self.waiting.updateValue((entry + i,), (pack[-1], json.dumps([(seq, *early[seq]) for seq in pack], ensure_ascii=False)))
        return len(packs)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: TimerValues) -> Iterator[pd.DataFrame]:
        frames = list(rows)
        batch = frames[0] if len(frames) == 1 else pd.concat(frames)
        out = self.take(*(batch[c].tolist() for c in ("seq", "chunk", "done", "open_thinking")))
        if out is None:
            return
        if out:
            yield self._frame(key, out)
        if self.idle_ms is not None:
            self._wait(None if self.ended.exists() else timers.getCurrentProcessingTimeInMs())

    def take(self, seqs: list, chunks: list, dones: list, opens: list) -> list[tuple] | None:
        """What these pieces decide; None for a response that has ended before."""
        saved = self.head.get()
        if saved is None and self.ended.exists():
            return None
        # Not sorted: the assembler takes pieces by number, and of repeated ones the first that came.
        response = Assembler(tuple(saved)[:5] if saved else None, thinking=True in opens)
        entries = {k[0]: tuple(v) for k, v in self.waiting.iterator()} if saved and saved[5] else {}
        for entry in sorted(entries):
            for seq, text, done in json.loads(entries[entry][1]):
                if seq >= response.next:
                    response.early[seq] = (text, done)
        before = set(response.early)
        out = list(response.add(zip(seqs, chunks, dones)))
        if response.over:
            if saved:
                self._close()
            else:
                self.ended.update((True,))
        else:
            said = [entry for entry, (last, _) in entries.items() if last < response.next]
            for entry in said:
                self.waiting.removeKey((entry,))
            new = {int(seq): piece for seq, piece in response.early.items() if seq not in before}
            added = self._keep(new, max(entries, default=-1) + 1)
            self.head.update((*response.save(), len(entries) - len(said) + added))
        return out

    def handleExpiredTimer(self, key: tuple, timers: TimerValues, expired: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:
        saved = self.head.get()
        if saved:
            response = Assembler(tuple(saved)[:5])
            self._close()
            yield self._frame(key, list(response.finish(response.next, "timeout")))

    def close(self) -> None:
        pass


class _Value:
    """A value of one response, held by its bucket while a batch is taken."""

    def __init__(self, value: tuple | None = None):
        self.value = value

    def get(self) -> tuple | None:
        return self.value

    def exists(self) -> bool:
        return self.value is not None

    def update(self, value: tuple) -> None:
        self.value = value

    def clear(self) -> None:
        self.value = None


class _Entries(dict):
    """Pieces of one response that wait, held by its bucket while a batch is taken; notes what is new."""

    def __init__(self, known: dict):
        super().__init__(known)
        self.new: dict = {}

    def iterator(self) -> Iterator[tuple]:
        return iter(self.items())

    def updateValue(self, key: tuple, value: tuple) -> None:
        self[key] = self.new[key] = value

    def removeKey(self, key: tuple) -> None:
        del self[key]


class Buckets(StatefulProcessor):
    """The responses of a bucket, so that calls and state are read and written a bucket, not a response.

    A list of the heads of those that are open, written anew by each batch; a list of
    pieces that wait, to which a batch adds, and which is written anew once half of
    it was said; and a mark for each response that has ended.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.heads = handle.getListState("heads", f"id bigint, nil boolean, {HEAD}")
        self.waiting = handle.getListState("pieces", "id bigint, nil boolean, entry int, last int, pieces string")
        self.ended = handle.getMapState("over", "id bigint, nil boolean", "over boolean")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: TimerValues) -> Iterator[pd.DataFrame]:
        pieces: dict[tuple, tuple[list, ...]] = {}
        for frame in rows:
            for id_, nil, *piece in zip(*(frame[c].tolist() for c in ("id", "nil", "seq", "chunk", "done", "open_thinking"))):
                own = pieces.setdefault((id_, nil), ([], [], [], []))
                for held, value in zip(own, piece):
                    held.append(value)
        heads = {tuple(head[:2]): tuple(head[2:]) for head in self.heads.get()}
        stored = [tuple(entry) for entry in self.waiting.get()] if any(head[-1] for head in heads.values()) else []
        before = bool(heads)
        waits: dict[tuple, dict] = {}
        for id_, nil, entry, *value in stored:
            waits.setdefault((id_, nil), {})[entry,] = tuple(value)
        new, said = [], []
        for who, own in pieces.items():
            one = Responses(None, None)
            one.head, one.ended = _Value(heads.get(who)), _Value()
            # Entries that were said stay in the list for a while.
            one.waiting = _Entries({k: v for k, v in waits.get(who, {}).items() if who in heads and v[0] >= heads[who][0]})
            if who not in heads and self.ended.containsKey(who):
                continue
            said += [(*who, *row) for row in one.take(*own)]
            if one.ended.exists():
                heads.pop(who, None)
                self.ended.updateValue(who, (True,))
            else:
                heads[who] = one.head.get()
                new += [(*who, *k, *v) for k, v in one.waiting.new.items()]
        if heads:
            self.heads.put([(*who, *head) for who, head in heads.items()])
        elif before:
            self.heads.clear()
        live = [e for e in stored if e[:2] in heads and e[3] >= heads[e[:2]][0]]
        if stored and not live and not new:
            self.waiting.clear()
        elif 2 * len(live) < len(stored):
            self.waiting.put(live + new)
        elif new:
            self.waiting.appendList(new)
        if said:
            id_, nil, *others = map(list, zip(*said))
            ids = pd.array([None if n else i for i, n in zip(id_, nil)], "Int64")
            yield pd.DataFrame(dict(zip(DELTA.fieldNames(), (ids, *others))))

    def close(self) -> None:
        pass


def stream_deltas(chunks: DataFrame, idle_ms: int | None = None, forget_ms: int | None = None) -> DataFrame:
    """Streamed pieces (response_id, seq, chunk, done, open_thinking) -> delta rows.

    No row is dropped for its time: pieces may come in any order and in any
    micro-batch, and a repeated piece changes nothing.  Pieces of one micro-batch
    that follow each other give one row.  ``open_thinking`` (false when null or
    not there) tells whether a response starts inside its reasoning.  A response
    stays open until its last piece is there.  With ``idle_ms``, one without news
    for that long (processing time) ends as 'timeout', which frees its state; do
    not set it shorter than a backlog may take.  The mark of a response that has
    ended goes after ``forget_ms``; pieces that come later are taken for a new
    one.  Both need a query that runs on, as time makes new batches without end;
    without them a query may stop once all input is read, and marks stay, and
    state is kept by buckets of responses.
    """
    rows = chunks.select("response_id", "seq", "chunk", "done", _opens(chunks).alias("open_thinking"))
    if idle_ms is not None or forget_ms is not None:
        return rows.groupBy("response_id").transformWithStateInPandas(Responses(idle_ms, forget_ms), DELTA, "append", "processingTime")
    bucket, id_ = F.pmod(F.xxhash64("response_id"), F.lit(BUCKETS)).cast("int"), F.col("response_id").cast("bigint")
    # A null id has its own mark: as a number among others it would make floats of them.
    rows = rows.select(bucket.alias("bucket"), F.coalesce(id_, F.lit(0)).alias("id"), id_.isNull().alias("nil"), "seq", "chunk", "done", "open_thinking")
    return rows.groupBy("bucket").transformWithStateInPandas(Buckets(), DELTA, "append", "none")


def _opens(chunks: DataFrame) -> Column:
    return F.coalesce("open_thinking", F.lit(False)) if "open_thinking" in chunks.columns else F.lit(False)


def run_assembly(chunks: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Runs the stream over all that is there and returns the delta table.

    Typed state needs the state store that keeps it by column family; the
    checkpoint holds it in the shared folder.
    """
    chunks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    query = (
        stream_deltas(chunks).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return chunks.sparkSession.read.schema(DELTA).parquet(out)


def _ordered_text(kind: str):
    rows = F.array_sort(F.collect_list(F.when(F.col("kind") == kind, F.struct("seq", "delta"))))
    return F.array_join(F.transform(rows, lambda r: r["delta"]), "").alias(kind)


def delta_parts(deltas: DataFrame) -> DataFrame:
    """Delta rows -> reasoning and content text per part of 1024 pieces."""
    return deltas.groupBy("response_id", F.floor(F.col("seq") / PART_CHUNKS).cast("bigint").alias("part")).agg(
        _ordered_text("reasoning"), _ordered_text("content"),
        F.count_if(F.col("kind") == "tool_call").alias("n_calls"),
        F.max(F.when(F.col("kind") == "finish", F.col("delta"))).alias("finish_reason"),
    )


def response_parts(chunks: DataFrame, part_chunks: int = PART_CHUNKS, hot_parts: int = 100_000) -> DataFrame:
    """The same texts from a finished table of pieces.

    Pieces are joined in parts of bounded size, so a response that holds much of
    the table is spread over many groups.  Each part also sees the start of the
    next one, as a tag may lie across the border; pieces must not be empty.
    The place of the first close tag is one minimum per response.
    """
    part, within = F.floor(F.col("seq") / F.lit(part_chunks)).cast("bigint"), F.col("seq") % F.lit(part_chunks)
    ahead = len(THINK_CLOSE) - 1
    spots = F.array_compact(
        F.array(
            F.struct(part.alias("part"), F.lit(True).alias("own")),
            F.when((within < ahead) & (part > 0), F.struct((part - 1).alias("part"), F.lit(False).alias("own"))),
        )
    )
    spread = chunks.withColumn("opens", _opens(chunks)).select("response_id", "seq", "chunk", "opens", F.explode(spots).alias("s"))
    spread = spread.select("response_id", "seq", "chunk", "opens", "s.part", "s.own")

    def joined(own):
        rows = F.array_sort(F.collect_list(F.when(F.col("own") == own, F.struct("seq", "chunk"))))
        return F.array_join(F.transform(rows, lambda r: r["chunk"]), "")

    texts = spread.groupBy("response_id", "part").agg(
        joined(True).alias("text"), joined(False).alias("border"), F.max("opens").alias("opens")
    )
    texts = texts.where(F.col("text") != "").withColumn(
        "at", F.instr(F.concat("text", F.substring("border", 1, ahead)), THINK_CLOSE)
    )
    closers = texts.groupBy("response_id").agg(
        F.min(F.when(F.col("at") > 0, F.struct("part", "at", F.length("text").alias("len")))).alias("c"),
        F.max("opens").alias("thinks"), F.count("*").alias("n_parts"),
    )
    # Characters of the part that belong to the tag or lie before it.
    used = (
        F.when(F.col("c").isNull() | (F.col("part") < F.col("c.part")), F.length("text"))
        .when(F.col("part") == F.col("c.part"), F.col("c.at") - 1 + len(THINK_CLOSE))
        .when(F.col("part") == F.col("c.part") + 1, F.greatest(F.col("c.at") - 1 + len(THINK_CLOSE) - F.col("c.len"), F.lit(0)))
        .otherwise(F.lit(0))
    )
    thought = F.when(F.col("c").isNull() | (F.col("part") < F.col("c.part")), F.col("text")).when(
        F.col("part") == F.col("c.part"), F.substring(F.col("text"), F.lit(1), F.col("c.at") - 1)
    ).otherwise(F.lit(""))
    placed = with_key_stats(texts, closers, "response_id", "n_parts", hot_parts)
    cut = placed.select(
        "response_id", "part", "thinks", F.when(F.col("thinks"), thought).otherwise(F.lit("")).alias("reasoning"),
        F.when(F.col("thinks"), F.substring(F.col("text"), used + 1, F.length("text"))).otherwise(F.col("text")).alias("rest"),
    )
    # Newlines after the tag go, also where they fill whole parts.
    trimmed = F.ltrim("rest", F.lit("\n"))
    heads = cut.groupBy("response_id").agg(F.min(F.when(trimmed != "", F.col("part"))).alias("head"), F.count("*").alias("n_parts"))
    said = (
        F.when(~F.col("thinks") | (F.col("part") > F.col("head")), F.col("rest"))
        .when(F.col("part") == F.col("head"), trimmed).otherwise(F.lit(""))
    )
    return with_key_stats(cut, heads, "response_id", "n_parts", hot_parts).select("response_id", "part", "reasoning", said.alias("content"))
