"""The fused patient-day timeline equals the table-by-table operators (source model shapes)."""

import pytest

from pulsevault.operators import business as BV
from pulsevault.operators import marts as MT
from pulsevault.operators import timeline as TL
from pulsevault.plans.lakehouse import Lakehouse

from conftest import SF_MID


@pytest.fixture(scope="module")
def parts(spark):
    lh = Lakehouse(spark, SF_MID, persist_layers=())
    daily = lh.daily_vitals()
    demo = lh.sat_patient_demographics()
    scores = BV.anomaly_score(daily)
    risk = BV.risk_profile(demo, scores, daily)
    return daily, demo, scores, risk


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_scores(parts):
    daily, demo, scores, risk = parts
    _same(TL.anomaly_score(daily), scores)


def test_risk_profile(parts):
    daily, demo, scores, risk = parts
    _same(TL.risk_profile(daily, demo), risk)


def test_feature_mart(parts):
    daily, demo, scores, risk = parts
    _same(TL.daily_features(daily, demo), MT.daily_features(daily, demo, risk, scores))
