from __future__ import annotations

import pytest
from conftest import plan, values
from pyspark.sql import functions as F

from merchant_features.operators import cohorts as C

SCHEMA = "id int, cod_rubro string, cod_provincia string, cod_localidad int, a double, d double"


@pytest.fixture(scope="module")
def rows(frame):
    return frame(
        SCHEMA,
        (1, "R", "B", 1, 10.0, 1.0), (2, "R", "B", 2, 20.0, 2.0), (3, "R", "C", 1, None, 3.0),
        (4, None, "B", 1, 40.0, 4.0), (5, None, None, None, 50.0, 5.0), (6, "S", None, 1, 60.0, 6.0),
    )


def test_cohort_stats(rows):
    got = C.cohort_stats(rows, ["cod_rubro"], ["a"], "avg", "rubro")
    assert values(got) == sorted([("R", 15.0), ("S", 60.0), (None, 45.0)], key=repr)
    got = C.cohort_stats(rows, ["cod_rubro", "cod_provincia"], ["d"], "sum", "rubro_prov")
    assert values(got) == sorted(
        [("R", "B", 3.0), ("R", "C", 3.0), (None, "B", 4.0), (None, None, 5.0), ("S", None, 6.0)], key=repr
    )


def test_one_pass_equals_separate_cohorts(rows):
    stats = C.all_cohort_stats(rows, C.COHORTS, ["a"], ["d"])
    for name, keys in C.COHORTS.items():
        got = stats.where(F.col("cohort") == name).select(*keys, "avg_of_a", "sum_of_d")
        separate = rows.groupBy(*keys).agg(F.avg("a"), F.sum("d"))
        assert values(got) == values(separate)
    assert plan(stats).count("Scan ExistingRDD") <= 2


@pytest.mark.parametrize("bound", [None, 1])
def test_null_keys_have_no_cohort_and_both_join_ways_agree(rows, bound):
    got = C.with_cohort_stats(rows, ["a"], ["d"], max_broadcast_bytes=bound)
    assert values(got, "id", "a_rubro", "d_rubro", "a_prov", "d_rubro_prov", "d_loc_prov") == sorted(
        [
            (1, 15.0, 6.0, 70 / 3, 3.0, 5.0), (2, 15.0, 6.0, 70 / 3, 3.0, 2.0), (3, 15.0, 6.0, None, 3.0, 3.0),
            (4, None, None, 70 / 3, None, 5.0), (5, None, None, None, None, None), (6, 60.0, 6.0, None, None, None),
        ],
        key=repr,
    )
    assert "a_loc_prov" not in got.columns
