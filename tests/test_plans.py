"""Physical-plan properties the scale design relies on (read from explain output)."""

import contextlib
import io
import re

import pytest

import __spark_entry__ as E
from lumen.plans.queries import QUERIES
from tests.conftest import SF001


def plan_of(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(fn(spark, SF001)) for name, fn in E.queries().items() if name in QUERIES}


def test_no_python_and_no_cartesian(plans):
    for name, p in plans.items():
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name
        assert "CartesianProduct" not in p, name


@pytest.mark.parametrize("name", ["latest_per_key", "rows_at_group_max", "dedup_by_key"])
def test_top1_is_limited_before_the_shuffle(plans, name):
    tree = plans[name].split("\n\n")[0]
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit", tree), "partial limit below the exchange"
    assert "Partial" in plans[name] and "Final" in plans[name]


@pytest.mark.parametrize("name", ["param_join", "linear_blend", "quantize_histogram", "grid_cells"])
def test_parameters_are_scalar_subqueries(plans, name):
    assert "NestedLoopJoin" not in plans[name]
    assert "Subquery" in plans[name] or "subquery" in plans[name]


@pytest.mark.parametrize("name", ["nearest_zone", "nearest_centroid", "nearest_supplied_part"])
def test_match_makes_no_pair_rows(plans, name):
    assert "NestedLoopJoin" not in plans[name]
    assert "Window" not in plans[name].split("\n\n")[0]  # no top-1 over pair rows
    assert "Generate" not in plans[name].split("\n\n")[0] or name == "nearest_supplied_part"


@pytest.mark.parametrize("name", ["vec_remove_direction", "plane_projection", "nearest_zone", "nearest_centroid"])
def test_vector_means_make_no_row_for_each_element(plans, name):
    assert "posexplode" not in plans[name]


def test_scans_read_only_needed_columns(plans):
    rs = re.findall(r"ReadSchema: struct<(.*?)>\n", plans["latest_per_key"])
    assert rs and all("o_orderstatus" not in r and "o_orderpriority" not in r for r in rs)
    rs = re.findall(r"ReadSchema: struct<(.*?)>\n", plans["route_and_union"])
    assert rs and all("props" not in r and "user_id" not in r for r in rs)


def test_aggregations_combine_before_the_shuffle(plans):
    for name in ["replicate_rows", "keyed_uniform", "group_averages", "route_and_union", "parity_cells"]:
        tree = plans[name].split("\n\n")[0]
        assert re.search(r"Exchange[\s\S]*HashAggregate", tree), name
        assert "SortAggregate" not in tree, name
