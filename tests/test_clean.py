"""Truth tables for the recoding rules."""

import math

import pytest
from pyspark.sql import functions as F

from parcelkit.functions import clean as X

STATUS_CASES = [
    (None, "Unknown"), ("Lead", "Lead"), ("Non-Lead", "Non-Lead"), ("\tNON-LEAD", "Non-Lead"),
    (" Unknown ", "Unknown"), ("yes", "Lead"), ("Y", "Lead"), ("no", "Non-Lead"), (" n ", "Non-Lead"),
    ("", "Unknown"), ("Galvanized Requiring Replacement", "Unknown"), ("lead-lined", "Lead"),
    ("none lead", "Non-Lead"), ("maybe", "Unknown"),
]
MATERIAL_CASES = [
    (None, "Unknown"), ("Lead", "Lead/GRR"), ("Lead ", "Lead/GRR"), ("lead-lined", "Unknown"),
    ("Galvanized requiring replacement", "Lead/GRR"), ("Unknown - copper", "Unknown"), ("Copper", "Non-Lead"),
    ("Plastic", "Non-Lead"), ("Other", "Non-Lead"), ("galvanized", "Non-Lead"), ("Non-Lead", "Non-Lead"),
    ("UNKNOWN", "Unknown"), ("steel", "Unknown"), ("", "Unknown"),
]
BOTH_CASES = [
    (None, "Unknown"), ("Non-Lead", "Non-Lead"), ("\tNON-LEAD", "Non-Lead"), ("Lead", "Lead/GRR"),
    ("Galvanized Requiring Replacement", "Lead/GRR"), ("yes", "Unknown"), ("", "Unknown"), (" Unknown ", "Unknown"),
]


def _apply(spark, fn, cases):
    df = spark.createDataFrame([(c,) for c, _ in cases], "v string")
    return [r[0] for r in df.select(fn("v")).collect()]


@pytest.mark.parametrize("fn,cases", [(X.normalize_status, STATUS_CASES), (X.normalize_material, MATERIAL_CASES),
                                      (X.normalize_both, BOTH_CASES)])
def test_truth_tables(spark, fn, cases):
    assert _apply(spark, fn, cases) == [e for _, e in cases]


def test_impute_and_combine(spark):
    rows = [("Unknown", 0), ("Unknown", 1), ("Unknown", 2), ("Unknown", 3), ("Unknown", 4), ("Unknown", None),
            ("Non-Lead", 3), ("Lead/GRR", 0)]
    df = spark.createDataFrame(rows, "cat string, cls long")
    got = [r[0] for r in df.select(X.impute_from_class("cat", "cls")).collect()]
    assert got == ["Non-Lead", "Non-Lead", "Lead/GRR", "Lead/GRR", "Unknown", "Unknown", "Non-Lead", "Lead/GRR"]
    pairs = [("Lead/GRR", "Non-Lead"), ("Non-Lead", "Unknown"), ("Unknown", "Unknown"), ("Unknown", "Lead/GRR")]
    df2 = spark.createDataFrame(pairs, "a string, b string")
    assert [r[0] for r in df2.select(X.combine_sides("a", "b")).collect()] == [
        "Lead/GRR", "Non-Lead", "Unknown", "Lead/GRR"]


def test_yes_flag_and_numbers(spark):
    df = spark.createDataFrame([("Yes",), ("TRUE",), ("t",), ("1",), ("1.0",), (None,), ("no",)], "v string")
    assert [r[0] for r in df.select(X.yes_flag("v")).collect()] == [1, 1, 1, 1, 0, 0, 0]
    df = spark.createDataFrame([("1850",), ("n/a",), (None,), ("NaN",), (" 12 ",)], "v string")
    got = [r[0] for r in df.select(X.to_double("v")).collect()]
    assert got[0] == 1850.0 and got[1] is None and got[2] is None and got[3] is None and got[4] == 12.0


def test_round_half_even_matches_numpy(spark):
    import numpy as np
    vals = [0.15, 0.25, 0.35, 2.675, -0.25, 12.35, 1 / 3, 100.05]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r[0] for r in df.select(X.round_half_even("v", 1)).collect()]
    assert got == [float(np.round(v, 1)) for v in vals]


def test_strip_handles_tabs(spark):
    df = spark.createDataFrame([("\t Lead \n",)], "v string")
    assert df.select(X.strip_lower("v")).first()[0] == "lead"


def test_sanitize_and_dataset_id(spark):
    df = spark.createDataFrame([(" Race & Ethnicity (2020) ", "https://x/datasets/" + "a" * 32 + "_3/about")],
                               "n string, u string")
    r = df.select(X.sanitize_name("n"), X.dataset_id("u")).first()
    assert r[0] == "Race_Ethnicity_2020_"[:-1] and r[1] == "a" * 32 + "_3"
