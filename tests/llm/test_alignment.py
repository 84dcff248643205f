"""Alignment of two tokenizers against whole texts in plain Python, and the laws of fragments."""

import hashlib
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.test_llm_queries import rows
from turnloom.llm import alignment
from turnloom.llm.alignment import Fragment, Tokens, compose, fragment
from turnloom.llm.queries import QUERIES
from turnloom.llm.tokenizing import tokenizer_path

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = [
    (None, "a b"), (None, "a b"), (1, None), (2, ""), (3, " \t"), (4, "<|endoftext|>x <s> É́ İ ΣΑΣ x　y 12 <0x41>"), (5, "a ▁ b"), (6, "\n\n  a  \r\n b\xa0 c 　 d  "),
    (7, "  "), (8, "x" * 3000 + " " + "安全" * 500 + "😀" * 30), (9, "a " * 2000 + "ab" * 900), (10, "\x00 \x85 x  y"), (10, "y' 's 're  't"), (11, "a" * 70000), (12, "b ▁" * 1500),
]


@cache
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def spelled(side, i):
    a, b = libraries()
    if side:
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()
    table = alignment._byte_table()
    token = a.id_to_token(i)
    return bytes(table[c] for c in token) if all(c in table for c in token) else token.encode()


def groups(text):
    if not text:
        return []
    a, b = libraries()
    raw = (" " + text).encode()
    left = [(i, spelled(0, i)) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = [(i, spelled(1, i)) for i in b.encode(text)]
    if not b"".join(x for _, x in left) == raw == b"".join(x for _, x in right):
        return []
    out, own, i, j, a_end, b_end = [], ([], []), 0, 0, 0, 0
    while i < len(left) or j < len(right):
        if a_end <= b_end and i < len(left):
            own[0].append(left[i][0])
            a_end, i = a_end + len(left[i][1]), i + 1
        else:
            own[1].append(right[j][0])
            b_end, j = b_end + len(right[j][1]), j + 1
        if a_end == b_end and all(own):
            out.append(own)
            own = ([], [])
    return out


def plain(docs):
    found = [(d, groups(t)) for d, t in docs]
    links = [Counter((x, y) for a, b in g for x in a for y in b) for _, g in found]
    n = Counter(p for c in links for p in c)
    top = defaultdict(int)
    for (x, _), k in n.items():
        top[x] = max(top[x], k)
    out = []
    for (d, g), c in zip(found, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g)
        out.append((
            d, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), c.total(), sum(k for p, k in c.items() if n[p] == top[p[0]]),
            sum(k * n[p] for p, k in c.items()), hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


def test_query(spark, monkeypatch):
    """Short texts as one fragment each, and long ones by ranges in a tree of several levels."""
    monkeypatch.setattr(alignment, "RANGE", 3_000)
    docs = rows("documents", "doc_id, text")
    assert got(QUERIES["op13_token_alignment"][0](spark, "/root/testdata/sf0.001")) == plain(docs)


@pytest.mark.parametrize(("size", "unit", "wide"), [(65_536, 4_096, 4), (1_000, 20, 65_536)])
def test_odd_rows(spark, monkeypatch, size, unit, wide):
    for name, value in (("RANGE", size), ("LONG_UNIT", unit), ("WIDE_GROUP", wide)):
        monkeypatch.setattr(alignment, name, value)
    docs = spark.createDataFrame([(d, t, "z", 1) for d, t in ODD], "doc_id int, text string, n_a string, run int").repartition(3)
    assert got(alignment.align(docs)) == plain(ODD)


def test_one_space_at_the_end(spark, monkeypatch):
    """Short texts and texts of several ranges that end with a single space."""
    monkeypatch.setattr(alignment, "RANGE", 1_000)
    docs = [(1, "a "), (2, "a b "), (3, "a\u00a0 "), (4, "a\n "), (5, "x" * 5000 + " "), (6, "one two " * 600), (7, " "), (8, "a \u2581 ")]
    want = plain(docs)
    assert sum(r[1] > 0 for r in want) == 7
    assert got(alignment.align(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))) == want


class Counted:
    """A tokenizer that counts its calls, without the form that also finds the places of tokens."""

    def __init__(self, a):
        self.a, self.calls = a, 0

    def encode_batch_fast(self, texts, **options):
        self.calls += 1
        return self.a.encode_batch_fast(texts, **options)


def test_units_are_learned_in_bulk():
    """New units take a call for many, without the places of tokens; their tokens are those of each alone, also where a unit is not spelled."""
    kit = alignment.Tokenizers(alignment.BYTE_TOKENIZER, alignment.PIECE_TOKENIZER)
    kit.a = counted = Counted(kit.a)
    words = [f" word{i}" for i in range(1_200)] + [" na\u00efve", " \u1100\u1161", " a\u2581b", " x\n", " "]
    numbers = kit.numbers(words)
    assert counted.calls < 600 and sorted(numbers.tolist()) == list(range(len(words)))
    assert kit.numbers(words[::-1]).tolist() == numbers[::-1].tolist()
    for side, library in enumerate(libraries()):
        for u, n in zip(words, numbers):
            alone = library.encode(u[1:]) if side else library.encode(u, add_special_tokens=False).ids
            assert kit.ids(np.array([n]), side).tolist() == alone
    for u, n in zip(words, numbers):
        left, right = (b"".join(spelled(k, i) for i in kit.ids(np.array([n]), k).tolist()) for k in (0, 1))
        assert kit.good[n] == (left == right == u.encode())


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" a\n\u00a0\u2581\u2003\x1f.b"), max_size=20))
def test_units_are_cut_at_the_same_places(text):
    kit = alignment.tokenizers()
    assert kit.units(text) == alignment._unit_starts.split(" " + text)


def test_nothing(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_many_documents_a_run(spark, monkeypatch):
    """Runs that end after few pairs, and batches of few texts."""
    monkeypatch.setattr(alignment, "RUN_PAIRS", 50)
    monkeypatch.setattr(alignment, "BATCH_CHARS", 100)
    docs = [(i, f"words {i % 9} of a text, theextraordinary{i % 4} naïveté") for i in range(60)]
    assert got(alignment.align(spark.createDataFrame(docs, "doc_id int, text string"))) == plain(docs)


sizes = st.lists(st.integers(1, 4), min_size=1, max_size=30)


def tokens_of(a, b):
    a_end, b_end = np.cumsum(a), np.cumsum(b)
    short, long_ = sorted((a_end, b_end), key=lambda e: e[-1])
    if short[-1] < long_[-1]:  # both sides spell the same bytes
        (a_end, b_end) = (np.append(a_end, b_end[-1]), b_end) if a_end[-1] < b_end[-1] else (a_end, np.append(b_end, a_end[-1]))
    return Tokens(np.arange(len(a_end)), a_end, np.arange(len(b_end)), b_end)


def same(x, y):
    return all(np.array_equal(p, q) for p, q in zip(x.columns(), y.columns()))


def added(*parts):
    parts = sorted((p for p in parts if len(p.a)), key=lambda p: p.a_end[0])
    return sum(parts, Tokens())


@settings(max_examples=200, deadline=None)
@given(sizes, sizes, st.tuples(st.integers(0, 120), st.integers(0, 120)))
def test_fragments_compose_in_any_order(a, b, cuts):
    """(x y) z = x (y z) = the whole, wherever the ranges are cut; nothing is the neutral element."""
    tokens = tokens_of(a, b)
    low, high = sorted(cuts)
    parts = [fragment(tokens.between(*r)) for r in ((-1, low), (low, high), (high, 1000))]
    (x, cx), (y, cy), (z, cz) = parts
    xy, c1 = compose(x, y)
    left, c2 = compose(xy, z)
    yz, c3 = compose(y, z)
    right, c4 = compose(x, yz)
    whole, closed = fragment(tokens)
    for f, c in ((left, added(cx, cy, cz, c1, c2)), (right, added(cx, cy, cz, c3, c4))):
        assert f.cut == whole.cut and same(f.head, whole.head) and same(f.tail, whole.tail) and same(c, closed)
    for f in (compose(Fragment(Tokens()), x)[0], compose(x, Fragment(Tokens()))[0]):
        assert f.cut == x.cut and same(f.head, x.head) and same(f.tail, x.tail)
    assert same(Tokens.unpacked(tokens.packed()), tokens)
