"""Pieces of DuckDB SQL shared by the oracle texts in the query catalog.

The oracle is an independent formulation of each result in plain SQL.  Only
the input views (FIXTURES.md) are shared text, because both engines must read
the very same rows.
"""

from __future__ import annotations

from shopflow.sources.tables import CITY_AREA_ROWS
from shopflow.sources.views import duckdb_views

_VIEWS = duckdb_views()


def with_views(*names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH`` prefix defining the named input views, then ``extra`` CTEs."""
    parts = []
    for n in names:
        if n == "city_area":
            rows = ", ".join(f"({i}, '{c}', '{a}')" for i, c, a in CITY_AREA_ROWS)
            parts.append(f"city_area(city_id, city_name, area) AS (VALUES {rows})")
        else:
            parts.append(f"{n} AS ({_VIEWS[n]})")
    for name, body in extra or []:
        parts.append(f"{name} AS ({body})")
    return "WITH " + ",\n".join(parts) + "\n"


# Ad-log parse in DuckDB: the same fields as the Spark parser.
PARSED_AD_LOG = """
select epoch_ms(ms) as ts, strftime(epoch_ms(ms), '%Y-%m-%d') as date,
       province, city, userid, adid
from (select try_cast(f[1] as bigint) as ms, f[2] as province, f[3] as city,
             try_cast(f[4] as bigint) as userid, try_cast(f[5] as bigint) as adid
      from (select string_split(value, ' ') as f from ad_log) s
      where len(f) >= 5) p
where ms is not null and userid is not null and adid is not null
"""

AREA_LEVEL_CASE = (
    "case when area in ('华北','华东') then 'A_Level' when area in ('华中','华南') then 'B_Level' "
    "when area in ('西南','西北') then 'C_Level' else 'D_Level' end"
)
