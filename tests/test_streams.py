"""Streams against batch: many small batches, pieces out of order, borders."""

import random

from pyspark.sql import functions as F

from turnloom.operators import toolcalls
from turnloom.streaming import assemble, ingest

CALL = '<tool_call>{"name": "f"}</tool_call>'
TEXTS = [
    "think</think>\n\nsay", "no tag at all", "</think>", "a</think>b</think>c", "x<tool_call>{}</tool_call></think>y", f"r</think>{CALL} and {CALL}", CALL,
    "t</think>\n\n\n", "t</thin", f"q</think>a<tool_call>[1]</tool_call>b<tool_call>oops", "r</think>\n" + CALL[:20] + "\n" + CALL[20:],
    f"{CALL}<think>plan {CALL}</think> \n{CALL}", f"a<think>b{CALL}", "t</think>" + "\n" * 40 + "late",
]
OPENS = [True] * 11 + [True, False, True]
N_CALLS = [0, 0, 0, 0, 0, 2, 1, 0, 0, 0, 1, 2, 1, 0]


def pieces(seed, low=1, high=4):
    rng, rows = random.Random(seed), []
    for i, text in enumerate(TEXTS):
        cut, at = [], 0
        while at < len(text):
            n = rng.randint(low, high)
            cut.append(text[at : at + n])
            at += n
        rows += [(i, k, 1704067200 + k % 3, c, k == len(cut) - 1, OPENS[i]) for k, c in enumerate(cut)]
    return rows


def split(i):
    text = TEXTS[i]
    at = text.find("</think>")
    if not OPENS[i]:
        return "", text
    return (text, "") if at < 0 else (text[:at], text[at + 8 :].lstrip("\n"))


def frame(spark, rows):
    df = spark.createDataFrame(rows, "response_id bigint, seq int, t bigint, chunk string, done boolean, open_thinking boolean")
    return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")


def test_assembler_keeps_little():
    a = assemble.Assembler(thinking=True)
    rows = [r for k in range(500) for r in a.add([(k, "abc<", False)])]
    assert sum(len(str(x)) for x in a.save()) < 400 and "".join(r[2] for r in rows) == "abc<" * 499 + "abc"


def test_pieces_read_as_one():
    """However pieces fall into calls, the text is the same; a run ends with its part."""
    for seed in range(4):
        rng = random.Random(seed)
        for i in range(len(TEXTS)):
            own = [(r[1], r[3], r[4]) for r in pieces(seed) if r[0] == i]
            rng.shuffle(own)
            a, got, at = assemble.Assembler(thinking=OPENS[i]), [], 0
            while at < len(own):
                n = rng.randint(1, len(own))
                got += a.add(own[at : at + n] + own[:at][:2])  # some pieces come again
                at += n
            assert tuple("".join(t for _, k, t in got if k == kind) for kind in ("reasoning", "content")) == split(i)
            assert sum(k == "tool_call" for _, k, _ in got) == N_CALLS[i] and a.over and not a.early
    long_ = assemble.Assembler()
    rows = list(long_.add([(k, "a", k == 2999) for k in range(3000)]))
    assert [(seq, len(t)) for seq, kind, t in rows if kind == "content"] == [(1023, 1024), (2047, 1024), (2999, 952)]


def test_late_repeats_and_waiting_pieces(spark, tmp_path):
    """Pieces after the end say nothing more, early ones wait over batches, restarts go on."""
    feed, out, check = (str(tmp_path / x) for x in ("feed", "out", "checkpoint"))

    def run(rows):
        frame(spark, [(1, k, 0, t, d, False) for k, t, d in rows]).coalesce(1).write.mode("append").parquet(feed)
        chunks = spark.readStream.schema(frame(spark, []).schema).option("maxFilesPerTrigger", 1).parquet(feed)
        return sorted((r["seq"], r["kind"], r["delta"]) for r in assemble.run_assembly(chunks, out, check).collect())

    assert run([(3, "d", True), (1, "b", False)]) == []
    assert run([(0, "a", False)]) == [(1, "content", "ab")]
    ended = [(1, "content", "ab"), (3, "content", "cd"), (3, "finish", "stop")]
    assert run([(2, "c", False), (0, "a", False)]) == ended
    assert run([(0, "a", False), (3, "d", True)]) == ended


class Kept(dict):
    """State of one response in plain Python; counts what is written."""

    written = 0

    def updateValue(self, key, value):
        self.written += 1
        self[key] = value

    def iterator(self):
        return iter(self.items())

    def removeKey(self, key):
        del self[key]

    def update(self, value):
        self["value"] = value

    def get(self):
        return super().get("value")

    def exists(self):
        return "value" in self


def test_waiting_pieces_are_written_as_one():
    """Pieces of a batch that come early are one write a part, not one each, and are gone once said."""
    import pandas as pd

    rows = [(k, f"w{k} ", k == 2999, False) for k in range(3000)]
    own = assemble.Responses(None, None)
    own.head, own.waiting, own.ended = Kept(), Kept(), Kept()
    said = []
    for batch in (rows[5::6], rows[3::6] + rows[5::6], rows[1::6], rows[0:1000:6], rows[::2]):
        frame = pd.DataFrame(batch, columns=["seq", "chunk", "done", "open_thinking"]).sample(frac=1, random_state=1)
        for out in own.handleInputRows((1,), iter([frame[:100], frame[100:]]), None):
            said += out.itertuples(index=False, name=None)
    assert "".join(t for _, _, kind, t in said if kind == "content") == "".join(r[1] for r in rows)
    assert [kind for _, _, kind, _ in said].count("finish") == 1 and own.ended.exists() and not own.waiting
    assert own.waiting.written <= 4


def test_first_of_repeated_pieces_counts():
    """Of pieces with the same number in one batch the first that came is taken, also where the batch is out of order."""
    import pandas as pd

    rows = [(k, f"{k}{c} ", k == 199, False) for k in range(200) for c in "abc"]
    random.Random(5).shuffle(rows)
    first = {}
    for k, text, *_ in rows:
        first.setdefault(k, text)
    own = assemble.Responses(None, None)
    own.head, own.waiting, own.ended = Kept(), Kept(), Kept()
    out = pd.concat(own.handleInputRows((None,), iter([pd.DataFrame(rows, columns=["seq", "chunk", "done", "open_thinking"])]), None))
    assert list(out.columns) == assemble.DELTA.fieldNames() and out["response_id"].isna().all()
    assert out["delta"].tolist() == ["".join(first[k] for k in range(200)), "stop"]


def test_stream_in_small_batches_out_of_order(spark, tmp_path):
    rows = pieces(1)
    random.Random(9).shuffle(rows)
    feed = tmp_path / "feed"
    for k in range(6):
        frame(spark, rows[k::6]).coalesce(1).write.mode("append").parquet(str(feed))
    chunks = spark.readStream.schema(frame(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(str(feed))
    deltas = assemble.run_assembly(chunks, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = {r["response_id"]: r for r in assemble.delta_parts(deltas).collect()}
    assert sorted(got) == list(range(len(TEXTS)))
    for i in got:
        assert (got[i]["reasoning"], got[i]["content"]) == split(i)
    assert [got[i]["n_calls"] for i in range(len(TEXTS))] == N_CALLS
    assert got[5]["finish_reason"] == "tool_calls" and got[0]["finish_reason"] == "stop"


def test_batch_twin_in_small_parts(spark):
    for seed, part, hot in ((2, 8, 2), (3, 9, 100), (4, 1024, 1)):
        out = assemble.response_parts(frame(spark, pieces(seed)), part, hot).orderBy("response_id", "part").collect()
        got = {}
        for r in out:
            a, b = got.get(r["response_id"], ("", ""))
            got[r["response_id"]] = (a + r["reasoning"], b + r["content"])
        for i in range(len(TEXTS)):
            assert got[i] == split(i)


def test_one_response_per_batch(spark, tmp_path):
    feed = tmp_path / "feed"
    for k in range(6):
        rows = [(k, j, 1704067200 + 3600 * (5 - k), f"w{j} ", j == 2, False) for j in range(3)]
        frame(spark, rows).coalesce(1).write.mode("append").parquet(str(feed))
    chunks = spark.readStream.schema(frame(spark, rows).schema).option("maxFilesPerTrigger", 1).parquet(str(feed))
    deltas = assemble.run_assembly(chunks, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    got = {r["response_id"]: (r["content"], r["finish_reason"]) for r in assemble.delta_parts(deltas).collect()}
    assert got == {k: ("w0 w1 w2 ", "stop") for k in range(6)}


def test_long_open_call_is_searched_once():
    watch = assemble.CallWatch()
    watch.add('<tool_call>{"name": "', False)
    for _ in range(5000):
        watch.add("abcdefgh", False)
    watch.add('"}</tool_', False)
    watch.add("call>", True)
    assert len(watch.calls()) == 1 and len(watch.calls()[0]) > 40_000


def test_ingest_takes_only_new_files(spark, tmp_path):
    schema = "text string"
    src, out, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    spark.createDataFrame([(" a ",), (" ",)], schema).write.json(src)
    struct = spark.createDataFrame([], schema).schema
    assert sorted(r[0] for r in ingest.ingest(spark, src, struct, out, check).collect()) == ["a"]
    spark.createDataFrame([("b",)], schema).write.mode("append").json(src)
    assert sorted(r[0] for r in ingest.ingest(spark, src, struct, out, check).collect()) == ["a", "b"]


def test_call_deltas_in_small_parts(spark):
    rows = [(1, k, k % 2, "id" if k < 2 else None, "n" if k in (2, 3) else None, str(k)) for k in range(40)]
    df = spark.createDataFrame(rows, "response_id int, seq int, call_index int, id string, name string, arguments string").repartition(3)
    for run in (3, 1024):
        got = {r["call_index"]: (r["id"], r["name"], r["arguments"]) for r in toolcalls.merge_call_deltas(df, run).collect()}
        assert got == {i: ("id", "n", "".join(str(k) for k in range(i, 40, 2))) for i in (0, 1)}


def test_late_call_is_one_row(spark):
    rows = [(1, 1022 + k, 0, "id" if k == 0 else None, "n" if k == 1 else None, str(k)) for k in range(6)]
    df = spark.createDataFrame(rows, "response_id int, seq int, call_index int, id string, name string, arguments string")
    assert [tuple(r) for r in toolcalls.merge_call_deltas(df).collect()] == [(1, 0, "id", "n", "012345")]


def test_call_deltas_go_as_lists(spark):
    """Neighbouring pieces are one row before any shuffle; a field that none of them has is null."""
    rows = [(1 + k // 50, 0, 0, k % 50, None, None, str(k)) for k in range(100)]
    df = spark.createDataFrame(rows, "response_id int, call_index int, run long, seq int, id string, name string, arguments string").coalesce(1)
    packs = toolcalls._packed_deltas(df, ["response_id", "call_index", "run"], ["id", "name", "arguments"]).collect()
    assert [(r["response_id"], r["first"], r["last"], r["straight"], len(r["seq"]), r["id"]) for r in packs] == [(1, 0, 49, True, 50, None), (2, 0, 49, True, 50, None)]


def test_call_deltas_of_any_order(spark):
    """Repeated, null and shuffled sequence numbers, null and repeated keys, empty and null pieces: as sorted by (seq, id, name, arguments)."""
    draw = random.Random(3)
    rows = [
        (draw.choice([None, 1, 2, 3]), draw.choice([0, 1, None]), draw.choice([None, *range(30)]), *[draw.choice([None, "", "x", "yy", "\u00e9"]) for _ in range(3)])
        for _ in range(600)
    ]
    rows += [(4, 0, k, None, None, str(k)) for k in range(40)] + [(5, 0, k, None, None, str(k)) for k in [*range(20), *range(10, 40)]]
    rows += [(6, 0, k, None, None, str(k)) for k in [*range(20, 40), *range(20)]]
    want = {}
    for r in sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3] or "", r[4] or "", r[5] or "")):
        own = want.setdefault(r[:2], ["", "", ""])
        own[:] = [x + (y or "") for x, y in zip(own, r[3:])]
    df = spark.createDataFrame(rows, "response_id int, call_index int, seq int, id string, name string, arguments string")
    for run in (7, 1024):
        got = toolcalls.merge_call_deltas(df.repartition(3) if run == 7 else df.coalesce(1), run).collect()
        assert len(got) == len(want) and {tuple(r)[:2]: list(r)[2:] for r in got} == want


def test_capped_pull_over_runs_and_repeats(spark, tmp_path):
    """The first rows in file and line order, over triggers and restarts; a batch that runs again changes nothing."""
    src, out, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = spark.createDataFrame([], "text string").schema

    def pull():
        return sorted(r[0] for r in ingest.ingest_capped(spark, src, schema, out, check, 7, maxFilesPerTrigger=1).collect())

    def add(*texts):
        spark.createDataFrame([(x,) for x in texts], "text string").coalesce(1).write.mode("append").json(src)

    add(" a1", "  ", "a2 ")
    assert pull() == ["a1", "a2"]
    add("b1", "b2", "b3", " ", "b4")
    add("c1", "c2", "c3")
    first = pull()
    assert len(first) == 7 and {"a1", "a2"} <= set(first)
    assert set(first) in ({"a1", "a2", "b1", "b2", "b3", "b4", "c1"}, {"a1", "a2", "c1", "c2", "c3", "b1", "b2"})
    add("d1")
    assert pull() == first
    again = ingest._capped_batch(out, f"{check}/counts", 7)
    kept = spark.read.parquet(f"{out}/batch_id=0").select("text")
    kept.write.json(str(tmp_path / "copy"))
    again(spark.read.schema(schema).json(str(tmp_path / "copy")).select("*", ingest._file_block().alias("_at")), 0)
    assert sorted(r[0] for r in spark.read.parquet(f"{out}/batch_id=*").collect()) == first


def test_responses_are_taken_by_bucket(spark, tmp_path, monkeypatch):
    """Many responses a call, in batches out of order: repeats after the end, null and large ids, few writes."""
    import pandas as pd

    class Rows(list):
        put = lambda self, rows: (self.clear(), self.extend(rows))
        get = lambda self: iter(list(self))
        appendList = list.extend

    class Marks(Kept):
        containsKey = Kept.__contains__

    own = assemble.Buckets()
    own.heads, own.waiting, own.ended = Rows(), Rows(), Marks()
    ids = [(0, False), (0, True), ((1 << 60) + 1, False), *((i, False) for i in range(5, 40))]
    rows = [(*who, k, f"{who[0]}.{k} ", k == 59, False) for who in ids for k in range(60)]
    random.Random(2).shuffle(rows)
    said = []
    for batch in (rows[: len(rows) // 2], rows[len(rows) // 3 :], rows[:500]):
        table = pd.DataFrame(batch, columns=["id", "nil", "seq", "chunk", "done", "open_thinking"])
        for out in own.handleInputRows((3,), iter([table[:100], table[100:]]), None):
            said += [tuple(None if pd.isna(x) else x for x in r) for r in out.itertuples(index=False)]
    for id_, nil in ids:
        mine = [r for r in said if r[0] == (None if nil else id_)]
        assert "".join(r[3] for r in mine if r[2] == "content") == "".join(f"{id_}.{k} " for k in range(60))
        assert [r[2] for r in mine].count("finish") == 1
    assert not own.heads and not own.waiting and len(own.ended) == len(ids) == own.ended.written
    monkeypatch.setattr(assemble, "BUCKETS", 2)
    texts = {None: "abc", 1: "de", (1 << 60) + 1: "fghi"}
    feed = [(i, k, 1704067200, c, k == len(t) - 1, False) for i, t in texts.items() for k, c in enumerate(t)]
    for k in range(3):
        frame(spark, feed[::-1][k::3]).coalesce(1).write.mode("append").parquet(str(tmp_path / "feed"))
    chunks = spark.readStream.schema(frame(spark, feed).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "feed"))
    got = {r["response_id"]: r["content"] for r in assemble.delta_parts(assemble.run_assembly(chunks, str(tmp_path / "out"), str(tmp_path / "check"))).collect()}
    assert got == texts
