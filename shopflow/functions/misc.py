"""JSON field, ownership label, area level and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_field(c: Column | str, field: str) -> Column:
    """A top-level field of JSON text as a string (number 0 -> '0')."""
    return F.get_json_object(_col(c), f"$.{field}")


def product_status(extend_info: Column | str) -> Column:
    """Status '0' -> 'self', anything else -> 'Third Party'."""
    return F.when(json_field(extend_info, "product_status") == F.lit("0"), F.lit("self")).otherwise(
        F.lit("Third Party")
    )


# Area -> level of the area job.
AREA_LEVELS = (
    ("A_Level", ("华北", "华东")),
    ("B_Level", ("华中", "华南")),
    ("C_Level", ("西南", "西北")),
)
DEFAULT_AREA_LEVEL = "D_Level"


def area_level(area: Column | str) -> Column:
    """Area name -> A/B/C/D level."""
    a = _col(area)
    expr = None
    for level, names in AREA_LEVELS:
        cond = a.isin(*names)
        expr = F.when(cond, F.lit(level)) if expr is None else expr.when(cond, F.lit(level))
    return expr.otherwise(F.lit(DEFAULT_AREA_LEVEL))


def round_half_up(c: Column | str, scale: int) -> Column:
    """X11: HALF_UP rounding on the decimal text (0.285 -> 0.29)."""
    return F.round(_col(c), scale)
