"""Arguments the queries pass when they run on the fixture views
(FIXTURES.md section 2). The library defaults are the surveyed workload's."""

from __future__ import annotations

from zonecast.operators.rules import TripRules

# Fixed values (FIXTURES.md): rule arguments for trips_v.
FIXTURE_RULES = TripRules(
    period_start="1996-03-01 00:00:00",
    period_end="1999-04-01 00:00:00",
    max_distance=45.0,
    tip_factor=0.05,
    min_charge=1500.0,
    max_fare=90000.0,
    max_mta_tax=0.07,
    max_tolls=5000.0,
)

# Fixed values (FIXTURES.md): rule arguments for event_trips_v, in the month of
# the ridership; the others are the surveyed workload's.
EVENT_RULES = TripRules(
    period_start="2024-01-01 00:00:00",
    period_end="2024-02-01 00:00:00",
    max_distance=45.0,
)

# Zone-set rules on zones_v: exclusion (F13) and the equivalent regex.
EXCLUDED_BOROUGHS = ["MIDDLE EAST"]
KEPT_BOROUGH_PATTERN = "AFRICA|AMERICA|ASIA|EUROPE"

# Ridership period (F11) on ridership_v: the whole fixture month.
RIDER_PERIOD = ("2024-01-01 00:00:00", "2024-02-01 00:00:00")

# Temporal split of the pickups fixture (one month only): train before day 22.
SPLIT_DAY = 22

# Spatial tile side for the point-in-zone join, in coordinate units.
TILE_SIZE = 1.0
