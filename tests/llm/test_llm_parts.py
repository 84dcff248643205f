"""Parts of the operators, and odd tables: nulls, empty and long texts, ties, repeats, clashing columns."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from tests.llm import plain
from turnloom.llm import covertree, dac, html, jaccard, mixing, packing, quality, tokenizing, urls, warc, words
from turnloom.llm.graph import components
from turnloom.llm.mincut import min_cut

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 5000}" for i in range(60_000))
ODD_TEXTS = [None, "", " \n\t", "one", "one two", "a b c", "A B C", "x<|endoftext|>y", "İ. é, ñ̃ ΣΑΣ ﬁ it's 12,5", LONG, LONG + " end", "é" * 3000, "same same same\n" * 40]
ODD_DOCS = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", 0) for i, t in enumerate(ODD_TEXTS)] + [(3, "one", "en", "s1", 0)] * 2


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD_DOCS, DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


CLASH = ["size", "n", "class", "start", "piece", "length", "kept", "key", "copies", "target", "hot", "first", "_row"]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_tables(spark, odd, none, name, stage):
    from pyspark.sql import functions as F

    clashing = odd.withColumns({c: F.lit("x") for c in CLASH})
    got = stage(spark, clashing, "")
    if name != "best_fit_packing":
        assert got.columns == clashing.columns
    got.collect()
    assert stage(spark, none, "").collect() == []


def test_token_files_give_any_token(spark, odd, tmp_path):
    folder = str(tmp_path / "ids")
    files = dac.write(odd, folder, 1, file_tokens=20_000)
    fs, root = dac.file_system(folder)
    want = [(i, x) for i, x in enumerate(y for _, t in sorted(((d, t or "") for d, t, *_ in ODD_DOCS)) for y in [*expected(t), 1])]
    got = []
    rows = sorted(files.collect(), key=lambda r: r["file"])
    for r in rows:
        f = dac.DacFile(fs, f"{root}/{r['file']}")
        assert r["first"] == len(got)
        got += f.run(0, f.tokens).tolist()
        for i in random.Random(1).sample(range(f.tokens), min(40, f.tokens)):
            assert f.token(i) == got[r["first"] + i]
    assert got == [x for _, x in want] and len(rows) > 1
    assert dac.round_trip(odd.limit(0)).collect() == []


def expected(text):
    from tokenizers import Tokenizer

    expected.tok = getattr(expected, "tok", None) or Tokenizer.from_file(tokenizing.tokenizer_path(tokenizing.TOKENIZER))
    return expected.tok.encode(text or "", add_special_tokens=False).ids


def test_directly_addressable_codes_of_wide_ids():
    rng = np.random.default_rng(5)
    ids = rng.choice([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1], 5000).astype(np.uint32)
    import pyarrow as pa

    body = b"".join(dac.encode(np.zeros(1, np.int64), np.zeros(1, bool), np.array([0, 5000]), ids))

    class Memory:
        def open_input_file(self, _path):
            return pa.BufferReader(body)

    f = dac.DacFile(Memory(), "")
    assert len(f.levels) == 4
    assert (f.run(17, 4321) == ids[17:4321]).all()
    assert [f.token(i) for i in range(0, 5000, 371)] == ids[::371].tolist()


def test_encoder_is_the_library():
    encode = tokenizing.WordEncoder(known=50).encode
    texts = [t for t in ODD_TEXTS if t != LONG] + ["A<|endoftext|>b", "Å. Ⅷ ª ٣ 日本語 a\x1cb a\xa0b x.. ,"]
    for t, ids in zip(texts, encode(texts), strict=True):
        assert ids.tolist() == expected(t)


def test_word_hashes_tell_words_apart():
    texts = ["".join(random.Random(i).choices("ab \n", k=300)) for i in range(50)] + ["x" * 70_000 + " " + "x" * 70_000 + "y " + "x" * 70_000]
    w = words.words_of(texts)
    spelled = [w.data[a:b] for a, b in zip(w.start, w.end)]
    assert spelled == [x.encode() for t in texts for x in plain.words(t)]
    assert len(set(spelled)) == len(set(w.hash.tolist())) == len(set(zip(spelled, w.hash.tolist())))


def test_best_fit_keeps_every_limit():
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 100, 400)
    for score in ("norm", "dot"):
        sequence, offset = packing.best_fit(lengths, 100, max_docs=5, max_cost=4000 + 99**2, score=score)
        held = defaultdict(list)
        for n, s, o in zip(lengths, sequence, offset):
            held[s].append((int(o), int(n)))
        for rows in held.values():
            at = 0
            for o, n in sorted(rows):
                assert o == at
                at += n
            assert at <= 100 and len(rows) <= 5 and sum(n * n for _, n in rows) <= 4000 + 99**2
    assert packing.best_fit(np.array([60, 40, 50, 50]), 100)[0].tolist() == [0, 0, 1, 1]
    with pytest.raises(ValueError):
        packing.best_fit(np.array([101]), 100)


def test_jaccard_on_near_copies(spark):
    rng = random.Random(7)
    vocabulary = [f"v{i}" for i in range(3000)]
    base = [rng.choice(vocabulary) for _ in range(400)]
    docs = []
    for i in range(160):  # one group of near copies about the threshold, and strangers that share a passage
        w = list(base)
        for _ in range(rng.choice([0, 1, 2, 4, 6, 9, 14])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        docs.append((i, " ".join(w)))
    docs += [(1000 + i, " ".join(base[:60] + [rng.choice(vocabulary) for _ in range(200)])) for i in range(60)]
    docs += [(2000 + i, t) for i, t in enumerate(ODD_TEXTS)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert sorted(tuple(r) for r in jaccard.link(frame).collect()) == plain.jaccard(docs)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 460)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "u long, v long")).collect())
    want = plain.components({x for e in edges for x in e}, edges)
    assert got == {n: low for n, low in want.items() if any(n in e for e in edges if e[0] != e[1])}


def test_mix_hits_targets(spark):
    rng = random.Random(4)
    docs = [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 5)), None, rng.choice(["a"] * 9 + ["b", "c", "d", None]), 0) for i in range(3000)]
    docs += [(5000 + i, "", None, "empty", 0) for i in range(3)]
    rows = mixing.report(spark.createDataFrame(docs, DOCS)).collect()
    assert sorted(rows) == sorted(mixing.report(spark.createDataFrame(docs[::-1], DOCS).repartition(7)).collect())
    source = {d[0]: d[3] for d in docs}
    taken, target, longest, have = Counter(), {}, Counter(), {}
    for r in rows:
        s = source[r.doc_id]
        taken[s] += r.taken
        target[s], have[s] = r.target, r.source_size
        longest[s] = max(longest[s], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    for s in target:
        assert abs(taken[s] - target[s]) <= longest[s] / 2 + 1e-6 and target[s] <= 2 * have[s]
    assert abs(sum(target.values()) - 1.5 * sum(have.values())) < 1e-6


def brute_cut(source, sink, edges):
    n = len(source)
    return min(
        sum(c for i, c in enumerate(source) if not m >> i & 1) + sum(c for i, c in enumerate(sink) if m >> i & 1)
        + sum(c for i, j, c in edges if (m >> i & 1) != (m >> j & 1))
        for m in range(1 << n)
    )


def test_min_cut():
    rng = random.Random(9)
    for _ in range(150):
        n = rng.randrange(1, 9)
        source, sink = [rng.randrange(20) for _ in range(n)], [rng.randrange(20) for _ in range(n)]
        edges = [(i, j, rng.randrange(9)) for i in range(n) for j in range(i) if rng.random() < 0.5]
        kept = min_cut(source, sink, edges)
        cost = sum(c for c, k in zip(source, kept) if not k) + sum(c for c, k in zip(sink, kept) if k)
        assert cost + sum(c for i, j, c in edges if kept[i] != kept[j]) == brute_cut(source, sink, edges)


PAGE = """<!doctype html><html><head><title>T</title><style>p{}</style><script>if (a < b) {"</p>"}</script></head><body class="no-sidebar">
<header><h1>Site name</h1><nav><ul><li><a href=/>Home</a><li><a href=/x>News</a></ul></nav></header>
<div id="cookie-notice"><p>We use cookies to make this site better for you.</p></div>
<article><h1>Rain &amp; wind</h1><p>It rained all day,<br>and the <b>wind</b> did not&nbsp;stop until the evening.
<ul><li>First point of the story.<li>Second one, 3 &lt; 4.</ul><div class="ad">Buy now! The best offer of the year is here.</div>
<p>Next day the sun came out.</p><aside>Read also this long text about other things that happened.</aside></article>
<section class="comments"><p>I do not agree with this article at all, it was sunny where I live.</p></section>
<form><label>Mail</label><input></form><footer>&copy; 2026 The Site</footer></body></html>"""
MAIN = "Rain & wind\n\nIt rained all day, and the wind did not stop until the evening.\n\nFirst point of the story.\n\nSecond one, 3 < 4.\n\nNext day the sun came out."
BARE = "<div><a href=/>Home</a> <a href=/a>About</a></div><div>" + "<p>This is a long paragraph of the text that the page is about, and it has many words in it.</p>" * 3 + "</div><div><a href=/b>Terms</a></div>"


def test_main_text(spark):
    assert html.main_text(PAGE) == MAIN
    assert html.main_text(PAGE[: PAGE.index("Next day") + 4]).endswith("Next")
    assert "Home" not in html.main_text(BARE) and html.main_text(BARE).count("long paragraph") == 3
    rows = [(1, "u", PAGE, 9), (2, None, None, 9), (3, "u", "", 9), (4, "u", "<p", 9), (1, "u", PAGE, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in html.extract(pages).collect()))
    assert got == [(1, MAIN, len(MAIN))] * 2 + [(2, "", 0), (3, "", 0), (4, "", 0)]
    assert html.extract(pages.limit(0)).collect() == []


def test_split_is_the_best_of_all(spark):
    counts = {"the": 50, "rain": 9, "in": 20, "spa": 3, "spain": 5, "t": 1, "he": 7}
    for piece in ("therainin", "inspain", "xqz", "thexin", "spainspa"):
        known = {(i, j): counts[piece[i:j]] for i in range(len(piece)) for j in range(i + 1, len(piece) + 1) if piece[i:j] in counts}
        assert urls.split_words(piece, known, 95) == plain.best_split(piece, counts, 95, len(piece))[1]


def test_url_rules_and_scores(spark):
    text = "<p>cheap pills free bets win casino news rain the weather of today</p>" * 5
    rows = [
        (1, "https://a.ORG/x?y", text, 0), (2, "http://example.org/es/1", text, 0), (3, "http://example.org/en/12#f", text, 0),
        (4, "http://b.com/fr/", text, 0), (5, "http://com/de/q", text, 0), (6, "http://xorg/", text, 0), (7, None, None, 0), (8, "nothing", "", 0),
        (9, "http://b.org", text, 0), (10, "http://cheappills.com/de/casino", text, 0), (11, "http://cheappills.net/casino", text, 0),
        (12, "http://rainnews.org/weather", text, 0), (13, "http://rainnews.net/weather", text, 0), (11, "http://cheappills.net/casino", text, 0),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, score long")
    got = {r.page_id: r for r in urls.judge(pages).collect()}
    rules = {1: "org/", 2: "example.org/es/", 3: "example.org/en/1", 4: "com/fr/", 5: "com/de/", 10: "com/de/", 12: "org/"}
    assert {p: r.rule for p, r in got.items() if r.rule} == rules
    assert (got[1].host, got[1].path, got[9].host, got[9].path, got[7].host, got[8].path) == ("a.org", "/x", "b.org", "", "", "")
    assert got[11].verdict == "block" and got[13].verdict == "allow" and urls.judge(pages).count() == len(rows)
    assert urls.judge(pages.limit(0)).collect() == []


def test_near_vectors_on_odd_rows(spark):
    rng = np.random.default_rng(8)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + rng.normal(size=16) * rng.choice([0, 0.02, 0.1, 0.2])).tolist(), i % 6 // 3) for i in range(400)]
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 16, 0), (503, [float("nan")] + [1.0] * 15, 0), (504, [None] + [1.0] * 15, 0), (505, rows[0][1], None), (506, [1.0, 2.0], 0), (507, [2.0, 4.0], 0)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int").repartition(3)
    assert sorted(tuple(r) for r in covertree.link(frame).collect()) == plain.near(rows)
    assert covertree.link(frame.limit(0)).collect() == []


def test_archives_round_trip(spark, tmp_path):
    rows = [(5, "http://a\r\nb", "<p>x</p>", 1), (2, "u", "<p>x</p>", 1), (2, "u", "<p>x</p>", 1), (9, None, None, 1), (7, "v", "", 1), (1, "w", "é\r\n\r\n" * 9, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record_type int")
    got = sorted((tuple(r) for r in warc.round_trip(pages).collect()), key=str)
    assert got == sorted(plain.captures([(p, h) for p, _, h, _ in rows]), key=str)
    folder = str(tmp_path / "warc")
    nested = warc.assemble(warc.read(warc.write(pages, folder), folder)).collect()
    assert len(nested) == len(rows) and all(r.request.block.startswith(b"GET") and r.metadata.block for r in nested)
    assert {bytes(r.response.block).partition(b"\r\n\r\n")[2].decode() for r in nested if r.response.type == "response"} == {"<p>x</p>", "", "é\r\n\r\n" * 9}
    assert warc.round_trip(pages.limit(0)).collect() == []


def test_quality_counts(spark, odd):
    got = quality.report(odd).collect()
    for r in got:
        t = next(t for d, t, *_ in ODD_DOCS if d == r.doc_id) or ""
        w = plain.words(t)
        grams = Counter(zip(w, w[1:], w[2:]))
        covered = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if plain.words(x)]
        assert (r.n_words, r.word_chars, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(lines) - len(set(lines)), len(covered))
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)
