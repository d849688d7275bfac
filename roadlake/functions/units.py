"""Unit conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Kilometres per mile, kilopascal per psi, standard gravity, km/h per cm/s.
KM_PER_MILE = 1.609344
KPA_PER_PSI = 6.894757
GRAVITY = 9.80665
KPH_PER_CMS = 0.036


def from_unit(value: Column, unit: Column) -> Column:
    """Miles and miles per hour to kilometres, Fahrenheit to Celsius, psi to kPa; null for any other unit."""
    return (
        F.when(unit.isin("mph", "mi"), value * KM_PER_MILE)
        .when(unit == "degF", (value - 32.0) * 5.0 / 9.0)
        .when(unit == "psi", value * KPA_PER_PSI)
    )
