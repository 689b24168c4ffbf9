import math

import pytest

from sluice.functions import NA_TOKENS, bucket_ratio, class_of, classify_value, dtypes, numeric, q, safe_name
from sluice.operators import columns
from sluice.operators.rules import rule_non_negative, rule_range
from sluice.session import local_table

TEXTS = {"inf": (math.inf, "inf"), "Infinity": (math.inf, "inf"), "-inf": (-math.inf, "inf"), " 5 ": (5.0, "integer"), "1e3": (1000.0, "integer"),
         "1.5": (1.5, "float"), ".5": (0.5, "float"), "1d": (None, "string"), "1f": (None, "string"), "1_0": (None, "string"),
         "0x10": (None, "string"), "abc": (None, "string"), "-7": (-7.0, "integer"), "1e400": (math.inf, "inf")}


def test_text_as_number_and_class(spark):
    df = local_table(spark, [(t,) for t in [*TEXTS, None]], "t string")
    kind = dtypes(df)["t"]
    got = {r[0]: (r[1], r[2]) for r in df.select("t", numeric("t", kind), classify_value("t", kind)).collect()}
    assert got == {**TEXTS, None: (None, "NaN")}


def test_classes_of_doubles(spark):
    df = local_table(spark, [(1.0,), (1.5,), (math.inf,), (math.nan,), (None,)], "x double")
    kinds = [r[0] for r in df.select(classify_value("x", dtypes(df)["x"])).collect()]
    assert kinds == ["integer", "float", "inf", "NaN", "NaN"]


def test_null_tokens(spark):
    df = local_table(spark, [(t,) for t in [*NA_TOKENS, "x", "Null"]], "t string")
    assert [r[0] for r in columns.normalize_nulls(df).where("t is not null").collect()] == ["x", "Null"]


def test_class_and_bucket(spark):
    df = local_table(spark, [(" Benign ", 0.5), ("DoS", 0.95), (None, 1.0), ("BENIGN", 0.49)], "l string, r double")
    got = [tuple(r) for r in df.select(class_of(q("l")), bucket_ratio(q("r"))).collect()]
    assert got == [("benign", "50-60%"), ("attack", "95-100%"), (None, "95-100%"), ("benign", None)]


def test_safe_name(spark):
    df = local_table(spark, [("Web Attack – XSS/1_a",)], "l string")
    assert df.select(safe_name(q("l"))).first()[0] == "WebAttackXSS1_a"


def test_repeated_headers():
    assert columns.numbered_repeats(["a", "b", "a", "a", "a.1"]) == ["a", "b", "a.1", "a.2", "a.1.1"]
    assert columns.duplicate_column_names(["a", "a.1", "x.y", "x.z"]) == {"a": ["a", "a.1"]}
    assert columns.duplicate_column_names(["a", "x.y", "x.z"], legacy=True) == {"x": ["x.y", "x.z"]}


def test_dedupe_and_label(spark):
    df = local_table(spark, [(1, 2, 3, "B")], "`a` int, `a.1` int, `x.y` int, ` Label` string")
    assert columns.dedupe_columns(df).columns == ["a", "x.y", " Label"]
    assert columns.resolve_label(df).columns[-1] == "label"
    assert columns.resolve_label(df, "class", missing="skip") is None
    assert columns.resolve_label(df, "class", missing="unknown").first()["class"] == "Unknown"
    with pytest.raises(ValueError):
        columns.resolve_label(df, "class")


def test_align(spark):
    test = local_table(spark, [(1, 2, "B")], "z int, a int, label string")
    assert [tuple(r) for r in columns.align_to(test, ["a", "b", "label"]).collect()] == [(2, 0, "B")]
    assert columns.align_to(test, ["a"], keep_label=False).columns == ["a"]
    report = {tuple(r) for r in columns.align_report(test, ["a", "b"]).collect()}
    assert report == {("b", "added"), ("z", "removed")}


def test_encode_and_decode_label(spark):
    df = local_table(spark, [("b",), ("a",), (None,), ("B",)], "label string")
    coded = columns.encode_label(df)
    assert {r["label"]: r["label_index"] for r in coded.collect()} == {"B": 0, "a": 1, "b": 2, None: None}
    back = columns.decode_label(coded, columns.label_index(df))
    assert all(r["label"] == r["decoded"] for r in back.collect())


def test_rules_by_name(spark):
    df = local_table(spark, [(-1.0, -1.0, "-inf", None), (1.0, 0.0, "x", "70000")], "flow_duration double, duration_skew double, idle string, src_port string")
    found = {r.column for r in rule_non_negative(df)}
    assert found == {"flow_duration", "idle", "src_port"}
    flags = df.select(*[r.violated for r in rule_non_negative(df)], *[r.violated for r in rule_range(df)])
    assert [tuple(r) for r in flags.collect()] == [(True, True, False, True), (False, False, False, True)]
    assert [r[0] for r in df.select(*[r.violated for r in rule_range(df, null_is_invalid=False)]).collect()] == [False, True]
