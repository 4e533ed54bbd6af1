"""Task parameters of the batch jobs."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import date

# The parameter names a task's JSON text uses.
JSON_NAMES = {
    "start_date": "startDate",
    "end_date": "endDate",
    "start_age": "startAge",
    "end_age": "endAge",
    "professionals": "professionals",
    "cities": "cities",
    "sex": "sex",
    "keywords": "keywords",
    "category_ids": "categoryIds",
    "page_flow": "targetPageFlow",
}


@dataclass(frozen=True)
class TaskParams:
    """Parameters of one analysis task. List-like filters are comma-separated text."""

    start_date: str
    end_date: str
    start_age: int | None = None
    end_age: int | None = None
    professionals: str | None = None
    cities: str | None = None
    sex: str | None = None
    keywords: str | None = None
    category_ids: str | None = None
    page_flow: tuple[int, ...] = field(default=())

    def __post_init__(self) -> None:
        for name in ("start_date", "end_date"):
            value = getattr(self, name)
            # Dates are compared as text, so only the zero-padded form is usable.
            if date.fromisoformat(value).isoformat() != value:
                raise ValueError(f"{name} must be yyyy-MM-dd, got {value!r}")
        if self.start_date > self.end_date:
            raise ValueError("start_date is after end_date")

    @staticmethod
    def from_json(text: str) -> TaskParams:
        """Read a JSON object whose values are one-element arrays of text."""
        raw = json.loads(text)

        def first(name: str) -> str | None:
            values = raw.get(JSON_NAMES[name])
            if not values:
                return None
            return str(values[0]) or None

        missing = [JSON_NAMES[n] for n in ("start_date", "end_date") if first(n) is None]
        if missing:
            raise ValueError(f"task parameters lack {', '.join(missing)}")

        def number(name: str) -> int | None:
            value = first(name)
            return None if value is None else int(value)

        flow = first("page_flow")
        return TaskParams(
            start_date=first("start_date"),
            end_date=first("end_date"),
            start_age=number("start_age"),
            end_age=number("end_age"),
            professionals=first("professionals"),
            cities=first("cities"),
            sex=first("sex"),
            keywords=first("keywords"),
            category_ids=first("category_ids"),
            page_flow=parse_flow(flow) if flow else (),
        )


def parse_flow(text: str) -> tuple[int, ...]:
    """``"1,2,3"`` to page ids."""
    return tuple(int(page) for page in text.split(","))
