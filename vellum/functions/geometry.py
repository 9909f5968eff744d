"""Box scalars as Column expressions; a box is four columns x0, y0, x1, y1."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str = "") -> Box:
    return tuple(F.col(f"{prefix}{c}") for c in ("x0", "y0", "x1", "y1"))  # type: ignore[return-value]


def _span(a: Column, b: Column) -> Column:
    return F.greatest(b - a, F.lit(0.0))


def area(b: Box) -> Column:
    return _span(b[0], b[2]) * _span(b[1], b[3])


def intersection(a: Box, b: Box) -> Column:
    return _span(F.greatest(a[0], b[0]), F.least(a[2], b[2])) * _span(F.greatest(a[1], b[1]), F.least(a[3], b[3]))


def iou(a: Box, b: Box) -> Column:
    common = intersection(a, b)
    union = area(a) + area(b) - common
    return F.when((common > 0) & (union > 0), common / union).otherwise(F.lit(0.0))


def overlap_fraction(a: Box, b: Box) -> Column:
    """Common area over the smaller box, boxes counting 1 at least."""
    return intersection(a, b) / F.greatest(F.least(area(a), area(b)), F.lit(1.0))


def contains_center(region: Box, b: Box) -> Column:
    cx, cy = (b[0] + b[2]) / 2, (b[1] + b[3]) / 2
    return cx.between(region[0], region[2]) & cy.between(region[1], region[3])


def covers_line(a: Box, line: Box) -> Column:
    """Half of the line's height and some of its width."""
    down = F.least(a[3], line[3]) - F.greatest(a[1], line[1])
    across = F.least(a[2], line[2]) - F.greatest(a[0], line[0])
    return (down >= 0.5 * (line[3] - line[1])) & (across > 0)


def displayed(x: Column, y: Column, rotation: Column, width: Column, height: Column) -> tuple[Column, Column]:
    """A point of a page turned by ``rotation`` as it is shown."""
    dx = F.when(rotation == 90, height - y).when(rotation == 180, width - x).when(rotation == 270, y).otherwise(x)
    dy = F.when(rotation == 90, x).when(rotation == 180, height - y).when(rotation == 270, width - x).otherwise(y)
    return dx, dy


def band(y: Column, step: float = 5.0) -> Column:
    """Reading band of a height: halves go to the even band."""
    return F.bround(y / step)


def layout_rank(order: Column, cy: Column, height: Column) -> Column:
    """Sort key: unordered blocks near the top, then ordered ones, then other unordered ones by height."""
    first = F.when(order.isNotNull(), 1).when(cy < 0.15 * height, 0).otherwise(2)
    return F.struct(first.alias("tier"), F.coalesce(order.cast("double"), cy).alias("at"))
