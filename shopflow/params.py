"""Task parameters of the batch jobs.

The reference passes a JSON object whose optional fields are unset when they
are missing or the empty string; list fields are comma-separated text.  Here
they become a frozen dataclass with ``None`` / empty tuple meaning "unset".
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any, Mapping


def _text(v: Any) -> str | None:
    if v is None:
        return None
    s = str(v).strip()
    return s or None


def _list(v: Any) -> tuple[str, ...]:
    if v is None:
        return ()
    if isinstance(v, (list, tuple)):
        items = [str(x).strip() for x in v]
    else:
        items = [x.strip() for x in str(v).split(",")]
    return tuple(x for x in items if x)


def _int(v: Any) -> int | None:
    s = _text(v)
    return None if s is None else int(s)


@dataclass(frozen=True)
class TaskParams:
    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] = ()
    cities: tuple[str, ...] = ()
    sex: str | None = None
    keywords: tuple[str, ...] = ()
    category_ids: tuple[str, ...] = ()
    target_page_flow: tuple[int, ...] = field(default=(1, 2, 3, 4, 5, 6, 7))

    @classmethod
    def from_mapping(cls, m: Mapping[str, Any]) -> "TaskParams":
        """Build from the reference's JSON field names (camelCase)."""
        flow = _list(m.get("targetPageFlow"))
        return cls(
            start_date=str(m["startDate"]),
            end_date=str(m["endDate"]),
            start_age=_int(m.get("startAge")),
            end_age=_int(m.get("endAge")),
            professionals=_list(m.get("professionals")),
            cities=_list(m.get("cities")),
            sex=_text(m.get("sex")),
            keywords=_list(m.get("keywords")),
            category_ids=_list(m.get("categoryIds")),
            target_page_flow=tuple(int(x) for x in flow) if flow else (1, 2, 3, 4, 5, 6, 7),
        )


# Parameters used by the registered queries (see README, "Parameters"): the
# date window is the whole year, so every job runs over all rows.
DEFAULT_PARAMS = TaskParams(
    start_date="2024-01-01",
    end_date="2024-12-31",
    start_age=20,
    end_age=50,
    professionals=("BUILDING", "MACHINERY"),
)
