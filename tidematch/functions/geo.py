"""Great-circle distance and the cells that narrow a range join."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6378.138  # fixed value

# Cells are cubes of edge 2**-level on the unit sphere. 17 is the finest level
# used (about 49 m); three indices of 19 bits and the level fit one long.
FINEST_LEVEL = 17
COARSEST_LEVEL = -2
# Edge of about 100 km, at which the cells of the whole sphere can be broadcast.
GATE_LEVEL = 6
AXES = ("x", "y", "z")
_BITS = 19
_OFFSET = 1 << (_BITS - 1)


def as_double(text: Column) -> Column:
    """Text to double; text that is no number becomes null. A position that is
    null, infinite or not a number lies within no range."""
    return text.try_cast("double")


def haversine_m(lat1: Column, lng1: Column, lat2: Column, lng2: Column) -> Column:
    """Distance in whole metres between two points given in degrees."""
    phi1, phi2 = lat1 * F.pi() / 180, lat2 * F.pi() / 180
    lam1, lam2 = lng1 * F.pi() / 180, lng2 * F.pi() / 180
    half_chord = F.pow(F.sin((phi1 - phi2) / 2), F.lit(2)) + F.cos(phi1) * F.cos(
        phi2
    ) * F.pow(F.sin((lam1 - lam2) / 2), F.lit(2))
    return F.round(EARTH_RADIUS_KM * 2 * F.asin(F.sqrt(half_chord)) * 1000)


def within_range(distance: Column, store_range: Column) -> Column:
    """``distance < range`` where the range is text; a bad range matches nothing."""
    limit = store_range.try_cast("double")
    return distance < F.when(~F.isnan(limit), limit)


def unit_vector(lat: Column, lng: Column) -> dict[str, Column]:
    """The point on the unit sphere, per axis. The haversine term is half of one
    minus the dot product of two such vectors for *any* angles, so no case for
    poles, the date line or out-of-range degrees is needed."""
    phi, lam = F.radians(lat), F.radians(lng)
    return {"x": F.cos(phi) * F.cos(lam), "y": F.cos(phi) * F.sin(lam), "z": F.sin(phi)}


def range_chord(store_range: Column, pad_m: int = 1) -> Column:
    """Straight-line length of a range made ``pad_m`` metres longer or shorter,
    which covers the rounding of both formulas: no match lies beyond the longer
    chord, and all users within the shorter one match. Null when nothing can
    match."""
    metres = store_range.try_cast("double")
    angle = F.greatest(
        F.least((metres + pad_m) / (EARTH_RADIUS_KM * 1000), F.pi()), F.lit(0.0)
    )
    return F.when(
        (metres > 0) & ~F.isnan(metres), 2 * F.sin(angle / 2) + (1e-9 if pad_m > 0 else -1e-9)
    )


def squared_distance(a: dict[str, Column], b: dict[str, Column]) -> Column:
    return reduce(add, [(a[axis] - b[axis]) * (a[axis] - b[axis]) for axis in AXES])


def cell_level(chord: Column, step: int = 1) -> Column:
    """Finest level, of every ``step``-th, whose edge is at least the chord, so
    that a reach spans at most three cells per axis. At most 20 / ``step``
    distinct values exist."""
    level = F.least(F.floor(-F.log2(chord)).cast("int"), F.lit(FINEST_LEVEL))
    return F.greatest((F.floor(level / step) * step).cast("int"), F.lit(COARSEST_LEVEL))


def level_scale(level: Column) -> Column:
    """Cells per unit length."""
    return F.pow(F.lit(2.0), level)


def axis_index(value: Column, scale: Column) -> Column:
    return F.floor(value * scale).cast("long")


def cell_id(level: Column, index: dict[str, Column]) -> Column:
    """Level and three indices packed into one long, without collisions."""
    packed = level.cast("long") - COARSEST_LEVEL
    for axis in AXES:
        packed = packed * (1 << _BITS) + (index[axis] + _OFFSET)
    return packed


def gate_id(level: Column, index: dict[str, Column]) -> Column:
    """The cell's ancestor at ``GATE_LEVEL``, or the cell itself where it is
    coarser, for cells of one level. The sphere has about 100,000 of them at each of at
    most 20 levels."""
    steps = F.greatest(level - GATE_LEVEL, F.lit(0))
    packed = level.cast("long") - COARSEST_LEVEL
    for axis in AXES:
        above = F.floor(index[axis] / F.pow(F.lit(2.0), steps)).cast("long")
        packed = packed * (4 << GATE_LEVEL) + (above + (2 << GATE_LEVEL))
    return packed


def place_id(vector: dict[str, Column], level: int) -> Column:
    """The cell of one fixed level that a point of the unit sphere lies in."""
    scale = level_scale(F.lit(level))
    return cell_id(F.lit(level), {axis: axis_index(vector[axis], scale) for axis in AXES})


def touches_sphere(scale: Column, index: dict[str, Column]) -> Column:
    """Whether a cell can hold points of the unit sphere: its centre is no farther
    from the surface than half its diagonal."""
    half = F.lit(0.5)
    norm = F.sqrt(reduce(add, [(index[a] + half) * (index[a] + half) for a in AXES])) / scale
    return F.abs(norm - 1) <= 0.8660254037844387 / scale + 1e-9


def face_coordinate(period: Column, day: Column, night: Column) -> Column:
    """Day coordinate in period '0', night coordinate in any other."""
    return F.when(period == "0", day).otherwise(night)
