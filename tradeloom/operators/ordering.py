"""Sort keys written as text: ``"amount desc"`` or ``"amount"``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def sort_names(keys: Sequence[str]) -> list[str]:
    return [key.split()[0] for key in keys]


def sort_columns(keys: Sequence[str]) -> list[Column]:
    columns = []
    for key in keys:
        name, _, direction = key.partition(" ")
        if direction.strip().lower() not in ("", "asc", "desc"):
            raise ValueError(f"sort key {key!r} is not '<column>', '<column> asc' or '<column> desc'")
        columns.append(F.col(name).desc() if direction.strip().lower() == "desc" else F.col(name).asc())
    return columns
