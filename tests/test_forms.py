"""Search forms, indexes and names by hand-made rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.functions import strings
from millrace.operators import forms


def test_forms_are_whole():
    assert len(forms.REPORT_FORM) == 39 and len(forms.CONTRIBUTION_FORM) == 20
    assert (len(forms.AWARD_INDEXES), len(forms.BILL_INDEXES), len(forms.FILING_INDEXES)) == (9, 11, 8)


@pytest.fixture(scope="module")
def filings(spark):
    rows = [(1, ("Acme Ltd",), [("A", 10.0), ("B", 60.0)], [3]), (2, None, [("A", 50.0)], []), (3, ("acme",), [], None), (4, ("x",), None, [4, None])]
    return spark.createDataFrame(rows, "k int, registrant struct<name:string>, foreign array<struct<name:string,percentage:double>>, entities array<int>")


@pytest.mark.parametrize(
    ("given", "want"),
    [
        ({}, [1, 2, 3, 4]),
        ({"registrant_name": "ACME"}, [1, 3]),
        ({"registrant_name": None}, [1, 2, 3, 4]),
        ({"foreign_entity_ownership_percentage_min": 20.0, "foreign_entity_ownership_percentage_max": 55.0}, [2]),
        ({"foreign_entity_ownership_percentage_min": 5.0, "foreign_entity_name": "b"}, [1]),
        ({"foreign_entity_listed_indicator": True}, [1, 2]),
        ({"foreign_entity_listed_indicator": False}, [3, 4]),
        ({"government_entities": [3, 4]}, [1, 4]),
        ({"government_entities": 3, "registrant_name": "x"}, []),
    ],
)
def test_parameters(filings, given, want):
    assert [r["k"] for r in forms.search_form(filings, forms.REPORT_FORM, **given).orderBy("k").collect()] == want


def test_unknown_parameter(filings):
    with pytest.raises(KeyError, match="colour"):
        forms.search_form(filings, forms.REPORT_FORM, colour="red")


def test_indexes_are_sparse_and_ordered(spark):
    df = spark.createDataFrame([(1, "D", "2024-01-01"), (2, "D", "2024-03-01"), (3, "D", None), (4, None, "2024-02-01"), (5, "D", "2024-03-01")], "k int, sponsor_party string, introduced_date string")
    find = lambda *a, **kw: [r["k"] for r in forms.by_index(df, forms.BILL_INDEXES, *a, tie="k", **kw).collect()]
    assert find("sponsor_party", "D") == [2, 5, 1] and find("sponsor_party", "D", descending=False, limit=2) == [1, 2]
    assert find("sponsor_party", "D", ("2024-02-01", None)) == [2, 5] and find("introduced", "2024-02-01") == [4]


@pytest.mark.parametrize(("name", "ok"), [("Ann Roe", True), ("Al", False), ("  Report", False), ("report of x", False), ("Reporter Bob", True), ("Yr Day", False), ("AB CD", False), ("ABC DE", True), ("12345", False), ("1 2 3", False), ("?!#", False), ("The Honorable X", False), ("é É 1", False), (None, False), ("", False), ("Form", False)])
def test_valid_names(spark, name, ok):
    assert spark.range(1).select(strings.valid_name(F.lit(name)).alias("x")).first()["x"] is ok
