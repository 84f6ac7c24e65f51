"""The registered hourly averages against plain ``avg``."""

import datetime
import math

import pytest

from sigflow.operators.analysis import hourly_generation, to_long
from sigflow.plans import queries
from sigflow.schemas import SIGNAL_KEYS

DAY = datetime.date(2024, 1, 1)
HOURS = {0: ["NaN", "100"], 1: ["0.00004"] * 3, 2: ["1e20", "5"], 3: ["Infinity"], 4: [None, "x"], 5: ["199.99999", "199.99999"], 6: ["0.1", "0.2", None]}


@pytest.fixture()
def telemetry(spark):
    rows = [(DAY, datetime.datetime(2024, 1, 1, h, i), dict.fromkeys(SIGNAL_KEYS, v)) for h, vs in HOURS.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "signal_date date, signal_ts timestamp, signals map<string,string>")


def test_both_forms_agree(spark, telemetry, monkeypatch):
    monkeypatch.setattr(queries, "load_telemetry", lambda *_: telemetry)
    got = {r.hour_of_day: r for r in queries.hourly_generation_q(spark, "").collect()}
    want = {r.hour_of_day: r for r in hourly_generation(telemetry).collect()}
    assert got.keys() == want.keys() == HOURS.keys()
    for h, r in want.items():
        assert got[h].generation_indicator == r.generation_indicator
        a, b = got[h].avg_active_power, r.avg_active_power
        assert a == b or (a is not None and (math.isclose(a, b, rel_tol=1e-15) or (math.isnan(a) and math.isnan(b))))
    assert got[0].generation_indicator == "Exceptional" and got[1].avg_wind_speed == pytest.approx(0.00004)
    assert got[5].generation_indicator == "Low"
    assert math.isnan({r.sig_name: r.value for r in to_long(queries.hourly_generation_q(spark, "")).filter("hour_of_day = 0").collect()}[SIGNAL_KEYS[0]])
