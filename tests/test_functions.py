"""Golden rows of the column functions."""

from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import names as N
from tessera.functions.similarity import length_bound, seq_ratio

NAMES = [
    ("Forlì", "FORLI", "FORLI", "FORLI'", "FORLI"),
    ("Sant’Agata", "SANT'AGATA", "SANTAGATA", "SANT’AGATA", "SANTAGATA"),
    ("L'Aquila", "L'AQUILA", "LAQUILA", "L'AQUILA", "L'AQUILA"),
    ("Valle-Dolina", "VALLE-DOLINA", "VALLE DOLINA", "VALLE-DOLINA", "VALLEDOLINA"),
    ("A - B", "A - B", "A B", "A - B", "A  B"),
    ("Bolzano/Bozen", "BOLZANO/BOZEN", "BOLZANO/BOZEN", "BOLZANO/BOZEN", "BOLZANOBOZEN"),
    ("Forli`", "FORLI'", "FORLI", "FORLI`", "FORLI"),
    ("Straße", "STRASSE", "STRASSE", "STRASSE", "STRASSE"),
    ("Ìsili  Nord", "ISILI NORD", "ISILI NORD", "I'SILI NORD", "ISILI NORD"),
]


def one(spark, values, kind, *columns):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_name_rules(spark):
    v = F.col("v")
    got = one(spark, [x[0] for x in NAMES], "string", N.plain_name(v), N.match_name(v), N.accent_name(v), N.loose_name(v))
    assert got == [x[1:] for x in NAMES]
    assert one(spark, [None], "string", N.plain_name(v), N.match_name(v), N.accent_name(v)) == [("", "", "")]


def test_numbers(spark):
    v = F.col("v")
    texts = ["1 216", "1.216", "12 *", "-5", "abc", "..", "—", "-", "…", ".", "", None, "12-34", "---"]
    got = one(spark, texts, "string", N.parse_number(v), F.coalesce(N.number_error(v), F.lit(False)))
    assert [g[0] for g in got] == [1216, 1216, 12, -5] + [None] * 10
    assert [g[1] for g in got] == [False] * 12 + [True, True]
    assert one(spark, ["1.7", "x", None, "-1.7"], "string", N.to_int(v)) == [(1,), (None,), (None,), (-1,)]
    assert one(spark, [724.5, 725.5], "double", N.half_even(v)) == [(724,), (726,)]


def test_codes_and_titles(spark):
    v = F.col("v")
    assert one(spark, ["1234", "1234.0", None, "1234567", "x"], "string", N.pad_code(v)) == [("001234",), ("001234",), ("",), ("1234567",), (None,)]
    assert one(spark, [" 12 ", "1234567"], "string", N.zero_fill(v)) == [("000012",), ("1234567",)]
    got = one(spark, ["AQUILA", "BARI DELLE PUGLIE", "FIUME", "ASCOLI PICENO", "NELL'EMILIA"], "string", N.modern_province(v))
    assert got == [("L'Aquila",), ("Bari",), (None,), ("Ascoli Piceno",), ("Nell'Emilia",)]
    assert one(spark, ["split_child_1921", "untraced_1921"], "string", N.reason_base(v)) == [("split_child",), ("untraced_1921",)]
    assert one(spark, ["a_p_p12"], "string", *N.page_key_parts(v)) == [("a_p", 12)]
    assert one(spark, ["pair_0003 then pair_0004", "none"], "string", N.pair_id(v)) == [("pair_0003",), ("",)]
    assert one(spark, ["Out of extra usage", "RATE LIMIT", "fine"], "string", N.rate_limited(v)) == [(True,), (True,), (False,)]


@pytest.mark.parametrize("rows", [[(None, 3.0, "extracted_null"), (5, None, "csv_empty"), (0, 0.4, "match"), (0, 5.0, "mismatch"), (5, 0.0, "mismatch"), (90, 100.0, "match"), (89, 100.0, "mismatch"), (100, 90.0, "match"), (110, 100.0, "match"), (23316, 24417.0, "match")]])
def test_compare_values(spark, rows):
    df = spark.createDataFrame(rows, "e long, c double, want string")
    assert df.where(N.compare_values(F.col("e"), F.col("c")) != F.col("want")).count() == 0


def test_digit_confusion(spark):
    df = spark.createDataFrame([(90, 95, False), (90, 96, True), (90, 99, True), (12, 13, True), (12, 12, False), (12, 123, False), (60, 69, True)], "a long, b long, want boolean")
    assert df.where(N.confused_digits(F.col("a"), F.col("b")) != F.col("want")).count() == 0


def test_ratio_keeps_its_order(spark):
    df = spark.createDataFrame([("cacabb", "cabaca"), ("cabaca", "cacabb"), (None, "x")], "a string, b string")
    got = [r[0] for r in df.select(seq_ratio(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(2 / 3) and got[1] == pytest.approx(0.5) and got[2] is None


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_length_bound_is_a_bound(a, b):
    bound = 1.0 if not a + b else 2 * min(len(a), len(b)) / (len(a) + len(b))
    assert SequenceMatcher(None, a, b).ratio() <= bound + 1e-12


def test_length_bound(spark):
    df = spark.createDataFrame([("", ""), ("ab", "abcd")], "a string, b string")
    assert [r[0] for r in df.select(length_bound(F.col("a"), F.col("b"))).collect()] == [1.0, pytest.approx(2 / 3)]
