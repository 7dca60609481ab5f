import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from areastats.functions.activations import ACTIVATIONS, activation
from areastats.functions.keys import area_key, key_state, state_code
from areastats.functions.numbers import ratio, to_double, total
from areastats.functions.text import file_label, naive_piece, plain_number, quoted_line, strip_anywhere, strip_suffix


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_key_skips_missing_state(rows):
    df = rows(
        "county string, state string",
        [
            ("  autauga ", "Alabama"),
            ("Washington", "District of Columbia"),
            ("", "Alabama"),
            (None, "Ohio"),
            ("Miami-Dade", "Florida"),
        ],
    )
    key = area_key(F.col("county"), state_code(F.col("state")))
    assert values(df, key) == ["AUTAUGA-AL", "WASHINGTON", "-AL", "OH", "MIAMI-DADE-FL"]


def test_strict_key_is_null_when_a_part_is(rows):
    df = rows("county string, state string", [("Adams", "NE"), ("Adams", None), (None, "NE")])
    assert values(df, area_key(F.col("county"), F.col("state"), strict=True)) == ["ADAMS-NE", None, None]


def test_key_flags(rows):
    df = rows("county string, state string", [(" Adams", "NE")])
    assert values(df, area_key(F.col("county"), F.col("state"), upper=False, trim=False)) == [" Adams-NE"]


def test_state_of_key_is_after_the_last_hyphen(rows):
    df = rows("k string", [("MIAMI-DADE-FL",), ("O'BRIEN-IA",), ("ST. CLAIR-MI",), ("WASHINGTON",), ("MIAMI-DADE",), ("FL",)])
    assert values(df, key_state(F.col("k"))) == ["FL", "IA", "MI", None, None, None]


def test_suffix_goes_only_at_the_end(rows):
    df = rows("c string", [("Autauga County",), ("Orleans Parish",), ("County Line County",), ("Iowa",), ("Adams county",), ("X County\n",)])
    assert values(df, strip_suffix(F.col("c"))) == ["AUTAUGA", "ORLEANS PARISH", "COUNTY LINE", "IOWA", "ADAMS COUNTY", "X COUNTY\n"]
    assert values(df, strip_suffix(F.col("c"), (" County", " Parish")))[1] == "ORLEANS"


def test_word_goes_anywhere(rows):
    df = rows("c string", [("County Line County",), ("Autauga County",), (None,)])
    assert values(df, strip_anywhere(F.col("c"))) == [" Line ", "Autauga ", None]


def test_ratio_never_fails(rows):
    df = rows("a string, b string", [("3", "4"), ("1", "0"), ("x", "2"), ("", "2"), (None, "2")])
    assert values(df, ratio(F.col("a"), F.col("b"))) == [0.75, None, None, None, None]


def test_total_and_double(rows):
    df = rows("a string, b int", [("1.5", 2), ("", 2), (None, 1)])
    assert values(df, total(F.col("a"), F.col("b"))) == [3.5, None, None]
    assert values(df, to_double(F.col("a"))) == [1.5, None, None]


def test_lines_and_labels(rows):
    df = rows("k string, n string, p string", [("ADAMS-NE", "O'Neill, North", "hdfs://h:1/in/usa_data.csv"), (None, "x", "/a/b")])
    assert values(df, quoted_line(F.col("k"), F.col("n"))) == ["'ADAMS-NE' 'O'Neill, North'", None]
    assert values(df, quoted_line(F.col("k"), F.col("n"), quote_value=False)) == ["'ADAMS-NE' O'Neill, North", None]
    assert values(df, file_label(F.col("p"))) == ["usa_data.csv", ""]
    assert values(df, naive_piece(F.col("n"), 1)) == [" North", None]


def test_plain_number_writes_digits(spark):
    numbers = [0.0003, 1.0, 0.5, -999.0, 12345678.25, 0.0034799999999999996, 2e-05, 1.5e-7, 1e16, 0.0, 1 / 3, 123456789012.0]
    df = spark.createDataFrame([(n,) for n in numbers], "n double")
    assert values(df, plain_number(F.col("n"))) == [repr(n) for n in numbers]


@pytest.mark.parametrize("name", sorted(ACTIVATIONS))
def test_activation_columns_agree_with_numpy(spark, name):
    z = np.linspace(-3, 3, 25)
    act = activation(name)
    df = spark.createDataFrame([(float(v),) for v in z], "z double")
    value = act.value(F.col("z"))
    assert np.allclose(values(df, value), act.value_np(z))
    assert np.allclose(values(df, act.slope(F.col("z"), value)), act.slope_np(z, act.value_np(z)))


def test_unknown_activation_is_an_error():
    with pytest.raises(ValueError, match="softmax"):
        activation("softmax")


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.sampled_from(["AL", "NE", None])), min_size=1, max_size=20))
def test_default_key_is_never_null(spark, parts):
    df = spark.createDataFrame(parts, "c string, s string")
    assert None not in values(df, area_key(F.col("c"), F.col("s")))
