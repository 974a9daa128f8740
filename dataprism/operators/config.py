"""Control values: segment list, frequency, dataset id, and the control columns that are never profiled.

Control values are plain arguments. Tables that carry them inside a per-row payload object are handled by
``operators.payload``, which checks with one small aggregate that every partition holds one value (Spark has no
"first row" to take) and profiles each distinct configuration with its own plan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names of the control columns dropped before profiling (matched case-insensitively).
CONTROL_COLUMNS = ("SEGMENT_COLUMNS", "GROUP_BY_FREQUENCY", "DATASET_TIMESTAMP")
DEFAULT_FREQ = "D"


def parse_segments(segments: str | Iterable[str] | None) -> list[str]:
    """Segment names from a CSV string or a list; blanks are dropped and names are trimmed."""
    if segments is None:
        return []
    items = segments.split(",") if isinstance(segments, str) else list(segments)
    names = [s.strip() for s in items if s is not None and s.strip()]
    if len(set(n.lower() for n in names)) != len(names):
        raise ValueError(f"segment columns repeat: {names}")
    return names


def resolve_names(df: DataFrame, names: Iterable[str], what: str = "column") -> list[str]:
    """Map names case-insensitively onto ``df``'s columns; unknown names raise with the available columns."""
    by_lower = {c.lower(): c for c in df.columns}
    out = []
    for n in names:
        if n.lower() not in by_lower:
            raise ValueError(f"{what} {n!r} not found; available columns: {df.columns}")
        out.append(by_lower[n.lower()])
    return out


def is_control_column(name: str) -> bool:
    return name.upper() in CONTROL_COLUMNS


def col(name: str) -> Column:
    """The column of exactly this name (dots and backticks included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def drop_control_columns(df: DataFrame) -> DataFrame:
    """Drop the control columns that are present; absent ones are ignored."""
    return df.select(*[col(c) for c in df.columns if not is_control_column(c)])
