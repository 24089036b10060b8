"""Task parameters: a JSON object whose values are arrays of strings; the
first element of each array is the value used.

Fixed parameter names (must equal the task format's): ``startDate``,
``endDate``, ``startAge``, ``endAge``, ``professionals``, ``cities``, ``sex``,
``keywords``, ``categoryIds``. List-valued parameters are comma-joined inside
their first element, e.g. ``{"cities": ["city1,city2"]}``.
"""

from __future__ import annotations

import ast
import json
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

PARAM_TYPE = "map<string,array<string>>"


def parse_params(json_text: Column) -> Column:
    """Spark-side parse of a parameter column (single quotes are accepted)."""
    return F.from_json(json_text, PARAM_TYPE)


def param_first(params: Column, name: str) -> Column:
    """First element of the named parameter, NULL when absent or empty."""
    return F.get(params[name], 0)


def _first(obj: dict, name: str) -> str | None:
    values = obj.get(name)
    if isinstance(values, list) and values:
        return None if values[0] is None else str(values[0])
    return None


def _split(value: str | None) -> list[str] | None:
    return None if value is None else value.split(",")


@dataclass(frozen=True)
class TaskParams:
    """One task's filter; ``None`` means "not set" (the filter passes)."""

    task_id: int = 0
    start_date: str | None = None
    end_date: str | None = None
    start_age: int | None = None
    end_age: int | None = None
    professionals: tuple[str, ...] | None = None
    cities: tuple[str, ...] | None = None
    sex: str | None = None
    keywords: tuple[str, ...] | None = None
    category_ids: tuple[str, ...] | None = None

    @classmethod
    def from_json(cls, text: str, task_id: int = 0) -> "TaskParams":
        """Parse the task JSON on the driver (it is a few hundred bytes of
        configuration, not data). Single-quoted JSON is accepted too."""
        try:
            obj = json.loads(text)
        except json.JSONDecodeError:
            obj = ast.literal_eval(text)

        def as_int(v):
            return None if v is None else int(v)

        def as_tuple(v):
            s = _split(v)
            return None if s is None else tuple(s)

        return cls(
            task_id=task_id,
            start_date=_first(obj, "startDate"),
            end_date=_first(obj, "endDate"),
            start_age=as_int(_first(obj, "startAge")),
            end_age=as_int(_first(obj, "endAge")),
            professionals=as_tuple(_first(obj, "professionals")),
            cities=as_tuple(_first(obj, "cities")),
            sex=_first(obj, "sex"),
            keywords=as_tuple(_first(obj, "keywords")),
            category_ids=as_tuple(_first(obj, "categoryIds")),
        )
