"""Dashboard SQL through spark.sql on registered views equals the DataFrame marts."""

from __future__ import annotations

import math

import pytest

from starloom.plans import marts
from starloom.plans.dashboards import DASHBOARD_SQL
from starloom.plans.pipeline import fixture_star
from starloom.plans.views import register_views

SF = "/root/testdata/sf0.001"


def _rows(df):
    cols = sorted(df.columns)

    def norm(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr), cols


@pytest.mark.parametrize("name", sorted(marts.MARTS))
def test_mart_sql_on_views_matches_dataframe_mart(spark, name):
    star = fixture_star(spark, SF)
    assert register_views(star)[-1] == "fact_track"
    via_sql = spark.sql(DASHBOARD_SQL[name])
    via_df = marts.MARTS[name](star)
    assert _rows(via_sql) == _rows(via_df)
