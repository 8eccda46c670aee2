"""Column roles: order, tests of type and name, fallbacks."""

import pytest

from parcelkit.functions import schema as S


def frame(spark, *cols):
    return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in cols))


def test_roles(spark):
    df = frame(spark, ("id", "int"), ("label", "string"), ("neighborhood", "string"), ("MedianIncome", "double"),
               ("income_note", "string"), ("Pwhite", "string"), ("Pblack", "double"), ("hh", "int"), ("GEOID20", "string"))
    assert S.column(df, "name") == "neighborhood"
    assert S.column(df, "tract_id") == "GEOID20"
    assert S.columns(df, "income") == ["MedianIncome"]
    assert S.columns(df, "income_map") == ["MedianIncome", "income_note"]
    assert S.columns(df, "race_pct") == ["Pblack"]  # a text column is no share
    assert S.column(df, "weight") == "hh" and S.column(df, "weight_listed") is None
    assert S.column(df, "status") is None


def test_fallbacks(spark):
    df = frame(spark, ("k", "int"), ("title", "string"), ("P1", "double"), ("P2", "string"), ("NEIGHBORHOOD", "string"))
    assert S.column(df, "name") == "title" and S.column(df, "name_any_case") == "NEIGHBORHOOD"
    assert S.column(df, "neighborhood") == "NEIGHBORHOOD" and S.columns(df, "race_pct") == ["P1"]
    with pytest.raises(ValueError):
        S.column(frame(spark, ("k", "int")), "neighborhood")


def test_summary_columns(spark):
    df = frame(spark, ("total_count", "long"), ("lead_percent_bothsides_imputed", "double"), ("pct_known", "double"))
    assert S.column(df, "lead_percent") == "lead_percent_bothsides_imputed"
    assert S.column(df, "total_count") == "total_count" and S.column(df, "lead_count") is None


def test_no_column_is_cut_off(spark):
    df = frame(spark, *((f"income_{i}", "double") for i in range(30)), ("total_count", "long"))
    assert len(S.columns(df, "income")) == 30


def test_keep_present(spark):
    df = frame(spark, ("a", "int"), ("b", "int"))
    assert S.keep_present(df, ["b", "x", "a"]).columns == ["b", "a"]
