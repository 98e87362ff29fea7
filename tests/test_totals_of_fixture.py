"""Row counts and totals computed once by independent means (see FIXTURES.md)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from billmill.queries import registered

EXPECTED = {
    "sf0.001": {
        "stages": [6000, 5902, 5805, 5681],
        "median": 888.0,
        "high": 2790,
        "kwh": 5031371.0,
        "charges": 299471583.90,
        "dates": 2273,
        "developments": 50,
        "meters": 647,
        "rowgrain_kwh": 2861427227.0,
    },
    "sf0.01": {
        "stages": [60000, 59354, 58184, 56046],
        "median": 888.0,
        "high": 27267,
        "kwh": 49599425.0,
        "charges": 2943931484.07,
        "dates": 2499,
        "developments": 500,
        "meters": 900,
        "rowgrain_kwh": 27919244475.0,
    },
}


@pytest.mark.parametrize("sf", EXPECTED)
def test_known_numbers(spark, sf):
    folder, want = f"/root/testdata/{sf}", EXPECTED[sf]
    run = {name: lambda name=name: registered()[name](spark, folder) for name in registered()}
    stages = run["stage_row_counts"]().orderBy("place").collect()
    assert [line.row_count for line in stages] == want["stages"]
    assert run["median_kwh"]().first()[0] == want["median"]
    assert run["high_usage_flag"]().agg(F.sum("HighUsageFlag")).first()[0] == want["high"]
    usage = run["fact_borough_year_usage"]().collect()
    assert len(usage) == 42
    assert sum(line.total_kwh for line in usage) == want["kwh"]
    assert sum(line.total_current_charges for line in usage) == pytest.approx(want["charges"], abs=0.005)
    assert run["dim_date"]().count() == want["dates"]
    assert run["dim_development"]().count() == want["developments"]
    assert run["dim_meter"]().count() == want["meters"]
    assert run["dim_vendor"]().count() == 5
    rowgrain = run["fact_borough_year_rowgrain"]().agg(F.sum("total_kwh")).first()[0]
    assert rowgrain == want["rowgrain_kwh"]
    star = {tuple(line) for line in run["fact_borough_year_star"]().collect()}
    assert star == {tuple(line) for line in usage}
