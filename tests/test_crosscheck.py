"""Island form = counting (sweep) form = session_window on the fixtures."""

from __future__ import annotations

import pytest

from conftest import SF0001, SF001
from crosscheck import session_window_condition_era, sweep_condition_era
from spanpack import condition_era, condition_target
from spanpack.plans.inspect import join_count
from spanpack.sources import fixtures as fx


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("sf", [SF0001, SF001])
def test_three_formulations_agree(spark, sf):
    co = fx.condition_occurrence(spark, sf)
    t = condition_target(co)
    island = rows(condition_era(co))
    assert rows(sweep_condition_era(t)) == island
    assert rows(session_window_condition_era(t)) == island


def test_counting_form_needs_a_join_island_form_does_not(spark):
    t = condition_target(fx.condition_occurrence(spark, SF0001))
    assert join_count(sweep_condition_era(t)) >= 1
    assert join_count(condition_era(fx.condition_occurrence(spark, SF0001))) == 0
