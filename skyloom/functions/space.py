"""Expressions on coordinates and boxes.  Boxes are north, west, south, east throughout."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RegularGrid:
    """A global grid: spacing and one point that lies on it."""

    delta_lat: float
    delta_lon: float
    lat0: float = 0.0
    lon0: float = 0.0
    digits: int = 9

    def __post_init__(self):
        if self.delta_lat <= 0 or self.delta_lon <= 0:
            raise ValueError("grid spacing must be positive")


@dataclass(frozen=True)
class RegionalGrid:
    """A limited-area grid given by the outer edges of its cells."""

    north: float
    west: float
    south: float
    east: float
    dlat: float
    dlon: float


def snap_inwards(
    north: Column, west: Column, south: Column, east: Column, grid: RegularGrid
) -> dict[str, Column]:
    """Move the edges of a box inwards to the nearest grid points.

    Gives the four edges, upside-down boxes and shifted longitudes put back as
    they came, and ``has_points``.
    """
    top, bottom = F.greatest(north, south), F.least(north, south)
    whole_turns = F.ceil((east - west) / 360.0) - 1
    right = F.when(east != west, east - 360.0 * whole_turns).otherwise(east)

    def steps(value: Column, origin: float, delta: float) -> Column:
        return F.bround((value - F.lit(origin)) / F.lit(delta), grid.digits)

    def down(value: Column, origin: float, delta: float) -> Column:
        return F.floor(steps(value, origin, delta)) * F.lit(delta) + F.lit(origin)

    def up(value: Column, origin: float, delta: float) -> Column:
        return F.ceil(steps(value, origin, delta)) * F.lit(delta) + F.lit(origin)

    n = down(top, grid.lat0, grid.delta_lat)
    s = up(bottom, grid.lat0, grid.delta_lat)
    w = up(west, grid.lon0, grid.delta_lon)
    e = down(right, grid.lon0, grid.delta_lon)
    has_points = (n >= s) & (e >= w)
    w_back = w - F.floor((w - west + 180.0) / 360.0) * 360.0
    e_back = e - F.floor((e - east + 180.0) / 360.0) * 360.0
    upright = north > south
    edges = {
        "north": F.when(upright, n).otherwise(s),
        "west": w_back,
        "south": F.when(upright, s).otherwise(n),
        "east": e_back,
    }
    # adding 0.0 turns a negative zero into a plain one
    return {k: F.bround(v, grid.digits) + F.lit(0.0) for k, v in edges.items()} | {"has_points": has_points}


def snap_to_cells(
    north: Column, west: Column, south: Column, east: Column, grid: RegionalGrid
) -> dict[str, Column]:
    """Move the edges of a box inwards to cell centres of a regional grid.

    A missing edge stands for the edge of the grid.  ``problem`` is NULL when
    the box can be used; ``is_full`` tells that it is the whole grid.
    """
    half_lat, half_lon = grid.dlat / 2.0, grid.dlon / 2.0
    lat_digits = len(str(half_lat).split(".")[1])
    lon_digits = len(str(half_lon).split(".")[1])
    n, s = F.coalesce(north, F.lit(grid.north)), F.coalesce(south, F.lit(grid.south))
    w, e = F.coalesce(west, F.lit(grid.west)), F.coalesce(east, F.lit(grid.east))

    def snap(value: Column, low: float, delta: float, digits: int, rounder) -> Column:
        origin = low + delta / 2
        return F.bround(rounder((value - F.lit(origin)) / F.lit(delta)) * F.lit(delta) + F.lit(origin), digits)

    edges = {
        "north": snap(n, grid.south, grid.dlat, lat_digits, F.floor),
        "west": snap(w, grid.west, grid.dlon, lon_digits, F.ceil),
        "south": snap(s, grid.south, grid.dlat, lat_digits, F.ceil),
        "east": snap(e, grid.west, grid.dlon, lon_digits, F.floor),
    }
    full = {
        "north": grid.north - half_lat,
        "west": grid.west + half_lon,
        "south": grid.south + half_lat,
        "east": grid.east - half_lon,
    }
    problem = (
        F.when(n <= s, "area north limit must be greater than south limit")
        .when(e <= w, "area east limit must be greater than west limit")
        .when(
            (edges["north"] < edges["south"]) | (edges["east"] < edges["west"]),
            "requested area does not contain a grid point",
        )
        .when(edges["north"] > full["north"], "north outside the grid")
        .when(edges["south"] < full["south"], "south outside the grid")
        .when(edges["east"] > full["east"], "east outside the grid")
        .when(edges["west"] < full["west"], "west outside the grid")
    )
    is_full = F.lit(True)
    for key, value in full.items():
        is_full = is_full & (edges[key] == F.lit(value))
    return edges | {"problem": problem, "is_full": is_full}


def shift_longitude(lon: Column, minimum: float) -> Column:
    """Longitude moved by whole turns into [minimum, minimum + 360)."""
    return F.pmod(lon - F.lit(minimum), F.lit(360.0)) + F.lit(minimum)


def shift_microdegrees(lon: Column, minimum_degrees: int = -180) -> Column:
    low = minimum_degrees * 1000000
    return F.pmod(lon - F.lit(low), F.lit(360000000)) + F.lit(low)


def microdegrees(value: Column) -> Column:
    """Degrees to integer microdegrees, exact halves to the even neighbour."""
    return F.bround(value * F.lit(1000000.0), 0).cast("bigint")


def snap_to_millidegrees(micro: Column) -> Column:
    return (F.bround(micro / F.lit(1000.0), 0) * 1000).cast("bigint")


def box_around(lat: Column, lon: Column, size: float = 1.0) -> dict[str, Column]:
    """The box of the given size centred on a point, in the order west, south, east, north."""
    half = size / 2.0
    return {"west": lon - half, "south": lat - half, "east": lon + half, "north": lat + half}


def points_in_box(
    north: Column, west: Column, south: Column, east: Column, d_lat: float, d_lon: float, least: int, signed: bool
) -> Column:
    """How many grid points a box holds, as an integer cut towards zero and not below ``least``.

    A signed extent lets a reversed box count as empty; otherwise the size of
    the box is what counts.
    """
    lat, lon = north - south, east - west
    if not signed:
        lat, lon = F.abs(lat), F.abs(lon)
    return F.greatest(F.lit(least).cast("bigint"), (lat / F.lit(d_lat) * lon / F.lit(d_lon)).cast("bigint"))


def cells_of_box(north: Column, west: Column, south: Column, east: Column, size: float = 10.0) -> Column:
    """The coarse cells a box touches, as array<struct<cy,cx>>: the equality key of box joins."""
    rows = F.sequence(F.floor(south / size).cast("int"), F.floor(north / size).cast("int"))
    cols = F.sequence(F.floor(west / size).cast("int"), F.floor(east / size).cast("int"))
    return F.flatten(F.transform(rows, lambda y: F.transform(cols, lambda x: F.struct(y.alias("cy"), x.alias("cx")))))


def cell_of_point(lat: Column, lon: Column, size: float = 10.0) -> Column:
    return F.struct(F.floor(lat / size).cast("int").alias("cy"), F.floor(lon / size).cast("int").alias("cx"))


HOME_SIZES = (8, 16, 32, 64, 128, 256, 512)  # powers of two, so that a division by them is exact


def home_of_box(north: Column, west: Column, south: Column, east: Column) -> Column:
    """Two by two cells of the smallest size that hold a box, by their size and the cell in the south-west.

    Size 0 is one home for all, of boxes that no size holds.
    """

    def fits(low: Column, high: Column, size: int) -> Column:
        return F.try_subtract(F.floor(high / size), F.floor(low / size)) <= 1

    homes = [F.when(fits(south, north, k) & fits(west, east, k), _home(k, F.floor(south / k), F.floor(west / k))) for k in HOME_SIZES]
    return F.coalesce(*homes, _home(0, F.lit(0), F.lit(0)))


def homes_of_point(lat: Column, lon: Column) -> Column:
    """All homes in whose boxes a point can lie."""
    homes = [_home(0, F.lit(0), F.lit(0))]
    for k in HOME_SIZES:
        ys, xs = ([F.floor(c / k), F.try_subtract(F.floor(c / k), F.lit(1))] for c in (lat, lon))
        homes += [_home(k, y, x) for y in ys for x in xs]
    return F.array(*homes)


def _home(size: int, cy: Column, cx: Column) -> Column:
    return F.struct(F.lit(size).alias("size"), cy.cast("bigint").alias("cy"), cx.cast("bigint").alias("cx"))
