import pytest

from tablesync.functions.names import (
    clean_columns,
    clean_identifier,
    name_list,
    resolve,
    target_table_name,
)


def test_clean_columns():
    assert clean_columns(["a b", "c.d", "e:f", "g(h)", "tab\tx"]) == [
        "a__b", "c__d", "e__f", "gh", "tab__x",
    ]


@pytest.mark.parametrize("names", [["a b", "a.b"], ["a b", "A:B"]])
def test_clashing_names_raise(names):
    with pytest.raises(ValueError, match="share one name"):
        clean_columns(names)


def test_case_sensitive_names_may_differ_in_case():
    assert clean_columns(["a", "A"], case_sensitive=True) == ["a", "A"]


def test_identifiers():
    assert clean_identifier("a-b c") == "a_b_c"
    assert clean_identifier("é") == "_"
    assert target_table_name("DBO", "My Table") == "dbo__my_table"


@pytest.mark.parametrize(
    "value", ["['a', b]", "a,b", "[a],[b]", " a , ,b ", ["a", "b"], ("a", " b")]
)
def test_name_list(value):
    assert name_list(value) == ("a", "b")


def test_empty_name_list():
    assert name_list(None) == name_list("") == name_list("[]") == ()


def test_resolve(spark):
    df = spark.createDataFrame([(1, 2)], "`a__b` int, Other int")
    assert resolve(df, "a b") == "a__b"
    assert resolve(df, "OTHER") == "Other"
    with pytest.raises(ValueError):
        resolve(df, "missing")
