"""Vocabulary learning against a public trainer library and a brute-force one."""

import random
from collections import Counter

import pytest
from tokenizers import Tokenizer, decoders, models, pre_tokenizers, trainers

from pyspark.sql import functions as F
from turnloom.functions import bpe
from turnloom.operators import vocab
from turnloom.plans.tables import documents

SF = "/root/testdata/sf0.001"


def library(texts, size):
    tok = Tokenizer(models.BPE())
    tok.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    tok.train_from_iterator(
        texts,
        trainers.BpeTrainer(
            vocab_size=size, show_progress=False, initial_alphabet=pre_tokenizers.ByteLevel.alphabet(), special_tokens=bpe.reserved_tokens()
        ),
    )
    tok.decoder = decoders.ByteLevel()
    return tok


def brute_force(counts, size):
    """One merge per round, everything recounted."""
    tokens = bpe.base_vocab()
    ids = {t: i for i, t in enumerate(tokens)}
    words = [([ids[bpe.BYTE_CHAR[b]] for b in w.encode()], n) for w, n in counts.items()]
    merges = []
    while len(tokens) < size:
        pairs = Counter()
        for w, n in words:
            for p in zip(w, w[1:]):
                pairs[p] += n
        if not pairs:
            break
        a, b = min(pairs, key=lambda p: (-pairs[p], p))
        made = tokens[a] + tokens[b]
        if made not in ids:
            ids[made] = len(tokens)
            tokens.append(made)
        merges.append((tokens[a], tokens[b]))
        merged = []
        for w, n in words:
            out, i = [], 0
            while i < len(w):
                if i + 1 < len(w) and (w[i], w[i + 1]) == (a, b):
                    out.append(ids[made])
                    i += 2
                else:
                    out.append(w[i])
                    i += 1
            merged.append((out, n))
        words = merged
    return tokens, merges


@pytest.mark.parametrize(("seed", "ranked", "segments"), [(1, 6, 1000), (2, 20, 8), (3, 4096, 200_000)])
def test_learned_like_brute_force(spark, seed, ranked, segments):
    """Few tracked pairs, few segments, and all at once: tokens, merges and their order are the same."""
    rng = random.Random(seed)
    counts = {"".join(rng.choice("aabcd") for _ in range(rng.randint(1, 9))): rng.randint(1, 6) for _ in range(60)}
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    learned = vocab.learn_vocab(words, 330, ranked=ranked, most_segments=segments)
    assert (learned.tokens, learned.merges) == brute_force(counts, 330)


def test_learned_like_the_library(spark):
    docs = documents(spark, SF)
    texts = [r["text"] for r in docs.select("text").collect()]
    tok = library(texts, 8000)
    learned = vocab.learn_vocab(vocab.pretoken_counts(docs), 8000)
    assert {t: i for i, t in enumerate(learned.tokens)} == tok.get_vocab()
    sample = texts[:20] + ["<|im_start|>user\n안녕 세상 it's 42!<|im_end|>\n", "a  b\n\n c\t", ""]
    codec = bpe.Codec(learned.tokens, learned.merges)
    for text in sample:
        assert codec.encode(text) == tok.encode(text).ids
        assert codec.raw(codec.encode(text)).decode() == text


def test_words_split_like_the_library(spark):
    texts = ["it's  a\n\ntest 12³ x_y—　 z ", "don't we'll\t\tgo", "  lead", "trail  ", "안녕  세상 !", "\u0085 x", "a\x1cb \x1f c"]
    pre = pre_tokenizers.ByteLevel(add_prefix_space=False)
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select(
        "i", bpe.split_pretokens("t").alias("w")
    )
    for r in rows.collect():
        want = [w for w, _ in pre.pre_tokenize_str(texts[r["i"]])]
        assert ["".join(bpe.BYTE_CHAR[b] for b in w.encode()) for w in r["w"]] == want


def test_export_names_every_token(spark):
    import json

    learned = vocab.learn_vocab(spark.createDataFrame([("hello", 3)], "word string, n bigint"), 294)
    doc = json.loads(vocab.export_row(spark, learned).first()["tokenizer"])
    assert len(doc["model"]["vocab"]) == 294 and len(doc["added_tokens"]) == 36
    assert sum(t["special"] for t in doc["added_tokens"]) == 21
    assert learned.merge_table(spark).count() == 2


def held(parts):
    """Token by token: held until the bytes decode without a replacement character."""
    import codecs

    out, text, count, reader = [], "", 0, codecs.getincrementaldecoder("utf-8")("strict")
    for part in parts:
        count += 1
        try:
            text += reader.decode(part)
        except UnicodeDecodeError:
            break
        if "\ufffd" in text:
            break
        if text and not reader.getstate()[0]:
            out.append((count, text))
            text, count = "", 0
    return out


def test_pieces_are_held_until_they_decode(spark):
    """All ways of bytes to be or not to be text, in tokens of one byte and of several."""
    raws = [b"a\xc3\xa9b", "가나".encode(), b"", b"a\xffb", "x\ufffdy".encode(), "<|im_end|>é".encode(), b"a\x80b", b"\xea\xb0!", b"\xed\xa0\x80", b"ab\xc3", "😀x".encode() + b"\xf0\x9f", b"\xc3\xa9\xa9z", b"\x80"]
    rows = [[raw[i : i + size] for i in range(0, len(raw), size)] for raw in raws for size in (1, 2, 3)]
    more = sorted({p for r in rows for p in r if len(p) > 1})
    tokens = bpe.base_vocab() + ["".join(bpe.BYTE_CHAR[b] for b in p) for p in more]
    number = {"".join(bpe.BYTE_CHAR[b] for b in p): tokens.index("".join(bpe.BYTE_CHAR[b] for b in p)) for r in rows for p in r}
    df = spark.createDataFrame([(i, [number["".join(bpe.BYTE_CHAR[b] for b in p)] for p in r]) for i, r in enumerate(rows)], "i int, ids array<int>")
    got = {r["i"]: [tuple(p) for p in r["p"]] for r in df.select("i", bpe.streamed_pieces(F.col("ids"), tokens).alias("p")).collect()}
    assert got == {i: held(r) for i, r in enumerate(rows)}


def test_byte_ids(spark):
    texts = ["a\u0085é 가😀\n", "", "<think>", None]
    got = [r["ids"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(bpe.byte_ids(F.col("t")).alias("ids")).collect()]
    order = bpe.byte_tokens()
    assert got == [None if t is None else [36 + order.index(bpe.BYTE_CHAR[b]) for b in t.encode()] for t in texts]


def test_windows_over_codes_that_are_line_separators(spark):
    """Token ids 7,976 and 7,977 are coded as line and paragraph separators; their pairs count like others."""
    from turnloom.operators.vocab import _windows

    words = ["a\u2028b", "\u2028\u2029", "\u2029", "abc"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string")
    got = [r["p"] for r in df.select("i", _windows(F.col("w")).alias("p")).orderBy("i").collect()]
    assert got == [["a\u2028", "\u2028b"], ["\u2028\u2029"], [], ["ab", "bc"]]


def test_merging_like_the_slow_way():
    """The heap merges in the same order as a full search for every merge, also in long words and runs."""
    import random

    rng = random.Random(3)
    merges = [("a", "a"), ("b", "c"), ("aa", "b"), ("aa", "aa"), ("c", "a"), ("aab", "c"), ("b", "b")]
    vocab = bpe.base_vocab() + ["".join(m) for m in merges]
    codec = bpe.Codec(vocab, merges)
    for n in (0, 1, 2, 5, 30, 400):
        for _ in range(20):
            word = "".join(rng.choice("aaabc") for _ in range(n))
            parts = list(word)
            while True:
                ranked = [(merges.index(p), at) for at, p in enumerate(zip(parts, parts[1:])) if p in merges]
                if not ranked:
                    break
                at = min(ranked)[1]
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            assert codec._word_ids(word) == [codec.ids[p] for p in parts]
    text = "<|im_start|>aab c<|im_end|> bca"
    assert [codec.encode(text, k) for k in range(1, 9)] == [codec.encode(text)[:k] for k in range(1, 9)]


def test_pairs_and_segments_of_batches(spark):
    """Pairs are summed batch by batch, not shuffled from a row for each place; words are cut where a pair is not tracked."""
    from collections import Counter

    from turnloom.operators.vocab import _first_pairs, _segments

    rows = [("abab a", 3), ("aaa", 1 << 60), ("ab", 5), ("bc", 2), ("abab a", 1), ("c퟿ab", 7)]
    words = spark.createDataFrame(rows, "w string, n bigint").coalesce(1)
    pairs, runs, tracked = Counter(), Counter(), {"ab", "ba", "aa"}
    for w, n in rows:
        for i in range(len(w) - 1):
            pairs[w[i : i + 2]] += n
        start = 0
        for i in range(1, len(w) + 1):
            if i == len(w) or w[i - 1 : i + 1] not in tracked:
                if i - start > 1:
                    runs[w[start:i]] += n
                start = i
    assert {r["pair"]: r["n"] for r in _first_pairs(words).collect()} == pairs
    assert {r["w"]: r["n"] for r in _segments(words, tracked).collect()} == runs
    assert _first_pairs(words.limit(0)).collect() == [] == _segments(words.limit(0), tracked).collect()
    assert "Generate" not in _first_pairs(words)._jdf.queryExecution().toString()
