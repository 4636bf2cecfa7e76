import math
from collections import Counter

from pyspark.sql import functions as F

from weftline.functions import formatting, ids, sequences


def col(spark, values, kind, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(f("v").alias("x")).collect()]


def test_ids(spark):
    assert col(spark, ["1abc_a", "1ABC_MODEL_2_xY", None, ""], "string", ids.canonical_id) == ["1ABC_a", "1ABC_MODEL_2_xY", None, ""]
    got = col(spark, ["1ABC_A", "1ABC_MODEL_2_xY", "1ABC_a_b", "nothing"], "string", ids.components)
    assert [tuple(r) for r in got] == [("1ABC", "", "A"), ("1ABC", "2", "xY"), ("1ABC", "", "a_b"), ("nothing", "", "")]
    df = spark.createDataFrame([(" 1ab c", "9zzz_A"), ("", "9zzz_A"), (None, "9zzz_A")], "p string, i string")
    assert [r[0] for r in df.select(ids.entry_key("p", "i")).collect()] == ["1ABC", "9ZZZ", "9ZZZ"]
    assert col(spark, [" Train", "TESTING", "validation", "heldout_excluded", None], "string", ids.split_label) == ["train", "test", "valid", None, None]
    assert col(spark, ["ab c-1d", "--", None], "string", ids.letters) == ["ABCD", None, None]


def test_sequence_stats_against_counter(spark):
    texts = ["a", "abab", "xyz" * 50 + "x", "aé" * 3, "v" * 5000]
    for s, r in zip(texts, col(spark, texts, "string", sequences.sequence_stats)):
        k, n = Counter(s), len(s)
        assert math.isclose(r["entropy_bits"], -sum(c / n * math.log2(c / n) for c in k.values()), abs_tol=1e-12)
        assert math.isclose(r["max_fraction"], max(k.values()) / n) and r["symbols"] == len(k)
    assert col(spark, ["", None], "string", sequences.sequence_stats) == [None, None]


def test_scalars(spark):
    assert col(spark, [["2.5", "1.9", "x"], ["nan"], [], None], "array<string>", sequences.best_float) == [1.9, None, None, None]
    assert col(spark, ["A(MSE)C\n D", ""], "string", sequences.one_letter_length) == [4, 0]
    assert col(spark, ["ACXB", "", None], "string", sequences.unknown_fraction) == [0.5, None, None]
    assert col(spark, ["X-RAY DIFFRACTION;ELECTRON MICROSCOPY", "electron microscopy", "SOLUTION NMR", None], "string", sequences.method_category) == ["xray", "em", "other", None]
    assert col(spark, ["2024-12-31", "2025-01-01", "2026-09-30", "2026-10-01", "", None], "string", sequences.period) == ["train", "valid", "test", None, None, None]
    assert col(spark, ["a; b;;a", None], "string", sequences.multi_value) == [["a", "b", "a"], []]
    assert col(spark, ["1ABC"], "string", lambda c: sequences.shard_path("r", c)) == ["r/ab/1abc.cif.gz"]
    df = spark.createDataFrame([("7", "1", "A"), (".", "1", "A")], "l string, a string, i string")
    assert [r[0] for r in df.select(sequences.residue_key("l", "a", "i")).collect()] == ["7", "1:A"]
    assert col(spark, ["a\tb\nc"], "string", sequences.one_line) == ["a b c"]


def test_python_rounding(spark):
    values = [3.5265, 0.0005, 1e-05, 1.0, None, float("nan")]
    want = lambda s: ["" if v is None or v != v else format(v, s) for v in values]
    assert col(spark, values, "double", formatting.python_format(".3f")) == want(".3f")
    assert col(spark, values, "double", formatting.python_format(".8g")) == want(".8g")
