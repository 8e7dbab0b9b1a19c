"""Sharpness and hashes of small grids: arrays in row order."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _mirror(i: int, n: int) -> int:
    """A border that mirrors about its edge element."""
    if n == 1:
        return 0
    return -i if i < 0 else 2 * (n - 1) - i if i >= n else i


def bound(value: Column, body) -> Column:
    """body(value), with value computed once a row: what a lambda refers to is computed anew for every element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def variance(values: Column) -> Column:
    """Of a population; null for an empty array."""

    def about(v: Column, mean: Column) -> Column:
        return _sum(F.transform(v, lambda x: (x - mean) * (x - mean))) / F.size(v)

    return bound(values, lambda v: F.when(F.size(v) > 0, bound(_sum(v) / F.size(v), lambda m: about(v, m))))


def laplacian(grid: Column, width: int, cells: list[list[int]]) -> Column:
    """The Laplacian within a rectangle of a grid, given as rows of indexes into it; the rectangle has its own border."""
    h, w = len(cells), len(cells[0])
    around = [[cells[_mirror(r + dr, h)][_mirror(c + dc, w)] for dr, dc in ((-1, 0), (1, 0), (0, -1), (0, 1))] + [cells[r][c]] for r in range(h) for c in range(w)]
    table = F.array(*[F.array(*[F.lit(i) for i in row]) for row in around])
    at = lambda row, k: F.get(grid, F.get(row, k)).cast("double")
    return F.transform(table, lambda row: at(row, 0) + at(row, 1) + at(row, 2) + at(row, 3) - 4 * at(row, 4))


def sharpness(grid: Column, width: int, height: int) -> Column:
    """The variance of a grid's Laplacian: low for flat or blurred ones."""
    return variance(laplacian(grid, width, [[r * width + c for c in range(width)] for r in range(height)]))


def tile_cells(width: int, height: int, n: int) -> list[list[list[int]]]:
    """Cells of n x n tiles in row order; edges round half to even, so that tiles of uneven size cover all."""
    ys, xs = ([round(i * size / n) for i in range(n + 1)] for size in (height, width))
    return [[[r * width + c for c in range(xs[j], xs[j + 1])] for r in range(ys[i], ys[i + 1])] for i in range(n) for j in range(n)]


def tile_sharpness(grid: Column, width: int, height: int, n: int) -> Column:
    """An array with the sharpness of each tile; an empty tile has 0."""
    one = [variance(laplacian(grid, width, t)) if t and t[0] else F.lit(0.0) for t in tile_cells(width, height, n)]
    return F.array(*one)


def sharp_share(tiles: Column, least: float) -> Column:
    """The share of tiles of at least that sharpness, NaN being none; null for no tiles."""
    good = F.size(F.filter(tiles, lambda v: (v >= least) & ~F.isnan(v)))
    return F.when(F.size(tiles) > 0, good / F.size(tiles))


def passes_share(tiles: Column, least: float, share: float) -> Column:
    return F.coalesce(sharp_share(tiles, least) >= share, F.lit(False))


def percentile_of(values: Column, q: float) -> Column:
    """With linear interpolation between neighbours in order."""

    def between(s: Column) -> Column:
        at = (F.size(s) - 1) * F.lit(q)
        low = F.floor(at).cast("int")
        a, b = F.get(s, low), F.get(s, F.least(low + 1, F.size(s) - 1))
        return a + (b - a) * (at - low)

    return bound(F.array_sort(values), between)


#: Further rules that a tile gate can use: columns from tiles and a threshold.
TILE_RULES = {
    "median": lambda tiles, t: percentile_of(tiles, 0.5) >= t,
    "minimum": lambda tiles, t: F.array_min(tiles) >= t,
    "p25": lambda tiles, t: percentile_of(tiles, 0.25) >= t,
}


def median_hash(values: Column, bits: int = 64) -> Column:
    """Bit k is set if value k is above the median; an array of up to `bits` values, 64 at most."""
    powers = F.array(*[F.lit((1 << k) - (1 << 64) if k == 63 else 1 << k).cast("long") for k in range(bits)])

    def fold(v: Column, middle: Column) -> Column:
        set_bits = F.zip_with(v, powers, lambda x, p: F.when(x > middle, p).otherwise(F.lit(0).cast("long")))
        return F.aggregate(set_bits, F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(x))

    doubles = F.transform(values, lambda x: x.cast("double"))
    return bound(doubles, lambda v: bound(percentile_of(v, 0.5), lambda m: fold(v, m)))


def hex64(h: Column) -> Column:
    return F.lower(F.lpad(F.hex(h), 16, "0"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
