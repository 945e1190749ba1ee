"""Rows in fewer bytes while they are shuffled.

A shuffled row has eight bytes for every column besides its texts, and where a text begins differs
from row to row, which compresses badly. So adjacent texts travel as one text that sorts as they do,
and calendar columns that follow from the date of a row stay behind and are derived again.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymart.functions.calendar import time_features

_END, _ESCAPED = "\x00", (("\x01", "\x01\x02"), ("\x00", "\x01\x01"))
_SIDE, _CALENDAR = "_side", "_calendar"


# --- texts ----------------------------------------------------------------------------------


def _is_text(field: T.StructField) -> bool:
    return field.dataType == T.StringType()


def _runs(fields: Sequence[T.StructField]) -> list[list[T.StructField]]:
    """Adjacent texts together, any other column alone."""
    runs: list[list[T.StructField]] = []
    for field in fields:
        if runs and _is_text(field) and _is_text(runs[-1][-1]):
            runs[-1].append(field)
        else:
            runs.append([field])
    return runs


def _written(name: str) -> Column:
    """A text that sorts by bytes like the cell, nulls last, and that no other text begins with."""
    cell = functools.reduce(lambda c, pair: F.replace(c, *map(F.lit, pair)), _ESCAPED, F.col(f"`{name}`"))
    return F.coalesce(F.concat(F.lit("1"), cell, F.lit(_END)), F.lit("2" + _END))


def _read(part: Column) -> Column:
    cell = F.substring(part, 2, (1 << 31) - 1)
    cell = functools.reduce(lambda c, pair: F.replace(c, *map(F.lit, reversed(pair))), reversed(_ESCAPED), cell)
    return F.when(F.startswith(part, F.lit("1")), cell)


def packed(fields: Sequence[T.StructField]) -> list[tuple[Column, bool]]:
    """A column for every run of texts and for every other column, and whether it may be null.

    The columns in this order sort like ``fields``. Texts are taken for valid UTF-8.
    """
    return [
        (F.concat(*(_written(f.name) for f in run)), False) if _is_text(run[0]) else (F.col(f"`{run[0].name}`"), True)
        for run in _runs(fields)
    ]


def unpacked(fields: Sequence[T.StructField], cells: Sequence[Column]) -> dict[str, Column]:
    """The columns of ``fields`` from those of ``packed``."""
    found: dict[str, Column] = {}
    for run, cell in zip(_runs(fields), cells):
        if _is_text(run[0]):
            parts = F.split(cell, _END)
            found |= {f.name: _read(F.get(parts, F.lit(i))) for i, f in enumerate(run)}
        else:
            found[run[0].name] = cell
    return found


# --- calendar columns -----------------------------------------------------------------------


def _flagged(cells: dict[str, Column]) -> Column:
    """Cells that sort with nulls last."""
    return F.struct(*(
        c.alias(f"{kind}_{n}") for n, cell in cells.items() for kind, c in (("none", F.isnull(cell)), ("cell", cell))
    ))


def _foldable(df: DataFrame, keep: Sequence[str]) -> list[str]:
    """Calendar columns of a dated table, if they are its last ones."""
    derived = time_features()
    names = [c for c in df.columns if c in derived and c not in keep]
    if "order_date" not in df.columns or not isinstance(df.schema["order_date"].dataType, T.TimestampNTZType):
        return []
    types = df.select(*(derived[c].alias(c) for c in names)).schema
    same = all(df.schema[c].dataType == types[c].dataType for c in names)
    rest = [c for c in df.columns if c not in keep]
    return names if same and names and rest[-len(names):] == names else []


def folded(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The table with its calendar columns, but for ``keep``, left out where they follow from the date.

    Where they don't, they are kept in one column; another says whether they sort before or after
    those of the date, so that rows of one date sort as before.
    """
    names = _foldable(df, keep)
    if not names:
        return df
    derived = time_features()
    as_derived = functools.reduce(Column.__and__, (F.col(c).eqNullSafe(derived[c]) for c in names))
    own, date = _flagged({c: F.col(c) for c in names}), _flagged({c: derived[c] for c in names})
    side = F.when(as_derived, 0).when(own < date, -1).otherwise(1)
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, side.alias(_SIDE), F.when(~as_derived, own).alias(_CALENDAR))


def unfolded(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table with ``columns``, which it had before it was folded."""
    if _CALENDAR not in df.columns:
        return df.select(*columns)
    derived = time_features()
    here = set(df.columns)
    return df.select(*(
        F.col(c) if c in here
        else F.when(F.col(_SIDE) == 0, derived[c]).otherwise(F.col(_CALENDAR)[f"cell_{c}"]).alias(c)
        for c in columns
    ))
