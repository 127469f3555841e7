"""Published check values of the derived readings."""

import pytest
from making import SF_MEDIUM, SF_SMALL

from meterlake.plans.catalogue import readings
from meterlake.plans.views import fleet_summary

EXPECTED = {
    SF_SMALL: (16, 450, 538, 11, 223.69, -80.01, 52.34, 50.059),
    SF_MEDIUM: (151, 4483, 5362, 136, 223.62, -79.99, 52.50, 49.634),
}
ROWS = {SF_SMALL: 999, SF_MEDIUM: 9981}


@pytest.mark.parametrize("sf_dir", sorted(EXPECTED))
def test_fleet_summary(spark, sf_dir):
    table = readings(spark, sf_dir)
    assert table.count() == ROWS[sf_dir]
    assert tuple(fleet_summary(table).first()) == EXPECTED[sf_dir]
