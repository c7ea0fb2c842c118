from datetime import date

import pytest

from tablesync import LoadSpec

BASE = {"path_to_save": "/lake/", "tab": "Tbl"}


def spec(**params):
    return LoadSpec.from_params(BASE | params)


def test_defaults_and_paths():
    s = spec()
    assert (s.schema, s.mode, s.fetch_size, s.timezone) == ("dbo", "errorifexists", 50_000, "Europe/Kiev")
    assert s.path == "/lake/dbo__tbl"
    assert s.window is None and s.generated is None


def test_text_none_keeps_the_default():
    assert spec(mode="None", timezone="None", partition_col="None").timezone == "Europe/Kiev"


VALID = [
    {"dtflt": "d", "exec_date": "2021-10-10"},
    {"dtflt": "d", "calc_min_dt": "2021-10-01", "calc_max_dt": "2021-10-05"},
    {"use_merge": "true", "merge_keys": "id"},
    {"write_partitioned": "true", "partition_col": "p"},
    {"write_partitioned": "true", "partition_col": "x,d", "dtflt": "d", "exec_date": "2021-10-10"},
    {"write_partitioned": "true", "partition_col": "p", "dtflt": "d", "exec_date": "2021-10-10",
     "force_partition": "true"},
    {"write_partitioned": "true", "partition_col": "p", "dtflt": "d", "exec_date": "2021-10-10",
     "use_merge": "true", "merge_keys": "id"},
    {"generate_column": "true", "generated_column_name": "g", "generated_column_exp": "1",
     "generated_column_type": "int"},
    {"change_tracking": "true", "primary_key": "id,[FilId]"},
    {"mode": "Overwrite", "where": "a = 1", "full_overwrite": True},
]

INVALID = [
    {"path_to_save": ""},
    {"tab": ""},
    {"mode": "replace"},
    {"dtflt": "d"},
    {"exec_date": "2021-10-10"},
    {"dtflt": "d", "calc_min_dt": "2021-10-01"},
    {"use_merge": "true"},
    {"merge_keys": "id"},
    {"write_partitioned": "true"},
    {"partition_col": "p"},
    {"write_partitioned": "true", "partition_col": "p", "dtflt": "d", "exec_date": "2021-10-10"},
    {"generate_column": "true"},
    {"generate_column": "true", "generated_column_name": "g"},
    {"generated_column_exp": "1", "generated_column_type": "int"},
    {"change_tracking": "true"},
    {"primary_key": "id"},
    {"mode": "overwrite", "where": "a = 1"},
    {"use_merge": "yes", "merge_keys": "id"},
    {"exec_date": "10.10.2021", "dtflt": "d"},
    {"unheard_of": "1"},
]


@pytest.mark.parametrize("params", VALID)
def test_valid(params):
    spec(**params)


@pytest.mark.parametrize("params", INVALID)
def test_invalid(params):
    with pytest.raises(ValueError):
        spec(**params)


def test_window():
    assert spec(dtflt="d", exec_date="2021-12-31").window == (date(2021, 12, 31), date(2022, 1, 1))
    both = spec(dtflt="d", exec_date="2021-12-31", calc_min_dt="2020-01-01", calc_max_dt="2020-02-01")
    assert both.window == (date(2020, 1, 1), date(2020, 2, 1))


def test_credentials_stay_out_of_the_text_form():
    s = spec(jdbcUrl="jdbc:x;password=secret", jdbc_options={"password": "hidden"})
    assert "secret" not in repr(s) and "hidden" not in repr(s)
