"""Text functions against Python's own, on adversarial strings."""

import random
import re

from pyspark.sql import functions as F

from turnloom.functions import arrays, text
from turnloom.operators import chat, rewards

ALPHABET = "ab1 9.,-+_\t\n가나²　 \x1c\x85é'<>"


def strings(n=400, seed=7):
    rng = random.Random(seed)
    fixed = ["", " ", "값은 1,234.5 입니다", "The answer is 42.", "12.3.4", "a a a a a", "-5 - 6", "1,350.0 원", "x.5", "　가 나　", "\x1c\x85", "İ ß"]
    return fixed + ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 24))) for _ in range(n)]


def run(spark, values, *cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]


def test_strip_words_numbers(spark):
    values = strings()
    c = F.col("t")
    got = run(spark, values, text.py_strip(c), text.split_words(c), text.last_number(c), text.lone_numbers(c))
    answer = re.compile(r"([-]?\d[\d,]*(?:\.\d+)?)(?![\d.])")
    lone = re.compile(r"(?<![\w.])[-+]?\d+(?:\.\d+)?(?![\w.])")
    for t, (strip, words, last, nums) in zip(values, got):
        assert strip == t.strip()
        assert words == t.split()
        found = answer.findall(t)
        assert last == (found[-1].replace(",", "") if found else "")
        assert nums == [float(x) for x in lone.findall(t.replace(",", ""))]


def test_repeat_penalty(spark):
    """Worked by hand: 3-grams of words and marks, twice the cap times the repeated share, at most the cap of 0.5."""
    rows = {
        "": 0.0, "a b": 0.0,  # no 3-gram
        "a b c": 0.0, "a b c d": 0.0,  # all different
        "a a a a a": 0.5,  # 1 of 3 different: 2/3, capped
        "a b a b a": 1 / 3,  # aba bab aba
        "A b, a B, x": 0.2,  # "ab," "b,a" ",ab" "ab," ",x" -> ab, b,a ,ab ab, b,x: 4 of 5
        "a b c a b c d e f": 1 / 7,  # abc bca cab abc bcd cde def
    }
    got = run(spark, list(rows), arrays.repeat_penalty(F.col("t")))
    for (t, want), (pen,) in zip(rows.items(), got):
        assert abs(pen - want) < 1e-12, t


def test_answer_rows(spark):
    got = run(spark, ["값은 1,234.5 입니다", "The answer is 42.", "12.3.4", "no"], text.last_number(F.col("t")))
    assert [g[0] for g in got] == ["1234.5", "", "3.4", ""]


def test_splits(spark):
    values = ["abc</think>def", "a</think>b</think>c", "none", "</think>", "<think>x</think>  y<think>z</think> w"]
    c = F.col("t")
    got = run(spark, values, text.before_first(c, "</think>"), text.after_first(c, "</think>"), text.after_last(c, "</think>"), text.count_of(c, "</think>"))
    for t, g in zip(values, got):
        assert g == (t.split("</think>")[0], t.split("</think>", 1)[-1], t.split("</think>")[-1], t.count("</think>"))
    parsed = [g[0] for g in run(spark, values, chat.split_reasoning(c))]
    assert [(p["reasoning"], p["rest"]) for p in parsed] == [("abc", "def"), ("a", "b</think>c"), (None, "none"), ("", ""), ("x", "yw")]


def test_matched_gt(spark):
    """Answers found in the text, and the share of them, worked by hand."""
    rows = [
        ("환율은 1,350.0 원", ["1350", "2"], {"1350"}),  # equal as numbers
        ("x.5", ["5"], {"5"}),  # stands in the text
        ("Hello World", ["hello", "hello", " "], {"hello"}),  # case is ignored; blank is no answer
        ("v1.5", ["1.5"], {"1.5"}),
        ("a -3 b", ["-3.0", "3"], {"-3.0", "3"}),
        ("1e5", ["1"], {"1"}),
        ("", ["0"], set()),
        ("about 7.0 and 12", ["7", "12.00", "70"], {"7", "12.00"}),
        ("a7b", ["7.0"], set()),  # not a number by itself
    ]
    df = spark.createDataFrame([(i, t, gt) for i, (t, gt, _) in enumerate(rows)], "i int, t string, gt array<string>")
    got = df.select("i", rewards.matched_gt(F.col("t"), F.col("gt")).alias("m"), rewards.gt_coverage(F.col("t"), F.col("gt")).alias("c")).orderBy("i").collect()
    for r, (_t, gt, want) in zip(got, rows):
        assert set(r["m"]) == want
        assert abs(r["c"] - len(want) / len(gt)) < 1e-12
