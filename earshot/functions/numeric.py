"""Number and score expressions."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius in miles, kilometres per mile.
EARTH_RADIUS_MI = 3961
KM_PER_MI = 1.60934


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_cast(value: Column | str, to: str) -> Column:
    return _col(value).try_cast(to)


def cast_bool_to_text(value: Column | str) -> Column:
    return _col(value).cast("string")


def equals_null_safe(a: Column | str, b: Column | str) -> Column:
    return _col(a).eqNullSafe(_col(b))


def safe_add(fields: Sequence[Column | str]) -> Column:
    """Sum in which a null counts as 0."""
    return reduce(lambda x, y: x + y, [F.coalesce(_col(f), F.lit(0)) for f in fields])


def safe_subtract(fields: Sequence[Column | str]) -> Column:
    """First minus the rest; a null counts as 0."""
    return reduce(lambda x, y: x - y, [F.coalesce(_col(f), F.lit(0)) for f in fields])


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient, null when the denominator is 0."""
    return F.try_divide(_col(numerator), _col(denominator))


def width_bucket(value: Column | str, low, high, buckets) -> Column:
    """Bucket 1..n of equal width; 0 below ``low``, n + 1 from ``high`` on. Bounds are numbers or columns."""
    return F.width_bucket(_col(value), *[b if isinstance(b, Column) else F.lit(b) for b in (low, high, buckets)])


def degrees_to_radians(degrees: Column | str) -> Column:
    return F.radians(_col(degrees))


def haversine_distance(lat1, lon1, lat2, lon2, unit: str = "mi") -> Column:
    """Great-circle distance between two points given in degrees."""
    if unit not in ("mi", "km"):
        raise ValueError("unit must be 'mi' or 'km'")
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_dphi = F.radians(_col(lat2) - _col(lat1)) / 2
    half_dlam = F.radians(_col(lon2) - _col(lon1)) / 2
    chord = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlam), 2)
    miles = F.lit(2.0 * EARTH_RADIUS_MI) * F.asin(F.sqrt(chord))
    return miles * KM_PER_MI if unit == "km" else miles


def whole_number(value: Column | str) -> Column:
    """Round to two places, then half-up to a whole number.

    The second step goes through DECIMAL: casting a double to a long would cut
    instead of round.
    """
    return F.round(_col(value), 2).cast("decimal(38,0)").cast("long")


def round_ratio(part: Column | str, whole: Column | str, places: int = 3) -> Column:
    return F.round(_col(part).cast("double") / _col(whole), places)


def percent_of_total(part: Column | str, total: Column | str) -> Column:
    return F.round(_col(part).cast("double") / _col(total).cast("double") * 100, 2)


def raw_affinity(weighted_plays: Column | str, unique_tracks: Column | str, w_plays=0.6, w_tracks=0.4) -> Column:
    """Weighted sum in exact decimals, so that equal artists tie exactly."""
    plays = _col(weighted_plays).cast("decimal(18,1)") * F.lit(Decimal(str(w_plays)))
    tracks = _col(unique_tracks).cast("decimal(18,1)") * F.lit(Decimal(str(w_tracks)))
    return plays + tracks


def min_max_percent(value: Column, low: Column, high: Column) -> Column:
    """Place of ``value`` between low and high as 0..100; null when they are equal.

    The quotient keeps seven places before it is scaled and rounded to two.
    """
    share = F.round(F.try_divide(value - low, high - low), 7).cast("decimal(18,7)")
    return F.round(share * 100, 2).cast("double")


def blended_score(cooccurrence: Column | str, affinity: Column | str, w_co=0.7, w_aff=0.3) -> Column:
    """Recommendation score 0..100; rounded to three places before the factor 100."""
    co = _col(cooccurrence).cast("decimal(9,3)") * F.lit(Decimal(str(w_co)))
    aff = F.coalesce(_col(affinity), F.lit(0.0)).cast("decimal(9,2)") * F.lit(Decimal(str(w_aff)) / 100)
    return (F.round(co + aff, 3) * 100).cast("double")


def blended_percent(mean: Column | str, affinity: Column | str, w_co=0.7, w_aff=0.3) -> Column:
    """Blend of a mean co-occurrence (six places) and an affinity as 0..100, rounded to two places."""
    co = _col(mean).cast("decimal(9,6)") * F.lit(Decimal(str(w_co)))
    aff = F.coalesce(_col(affinity), F.lit(0.0)).cast("decimal(9,2)") * F.lit(Decimal(str(w_aff)) / 100)
    return F.round((co + aff) * 100, 2).cast("double")


def ms_to_minutes(ms: Column | str) -> Column:
    return _col(ms) / F.lit(1000) / F.lit(60)


def ms_to_hours(ms: Column | str) -> Column:
    return ms_to_minutes(ms) / F.lit(60)
