"""Layout of one record type, held on the driver to build select lists.

A layout is metadata: its size is that of one copybook, never of the data.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class LayoutField:
    name: str
    start: int
    length: int
    data_type: str = "STRING"
    decimals: int = 0
    base_name: str = ""
    kind: str = "elementary"
    is_pk: bool = False

    @property
    def end(self) -> int:
        return self.start + self.length - 1


@dataclass(frozen=True)
class Layout:
    name: str
    record_length: int
    fields: tuple[LayoutField, ...]

    def columns(self, include_group_slices: bool = False) -> list[LayoutField]:
        """Fields that become columns, in layout order."""
        kinds = ("elementary", "group_occurrence") if include_group_slices else ("elementary",)
        return [f for f in self.fields if f.kind in kinds and f.length > 0]

    def schema(self, include_group_slices: bool = False) -> T.StructType:
        """All columns as nullable strings, exactly what the reader returns."""
        return T.StructType(
            [T.StructField(f.name, T.StringType(), True) for f in self.columns(include_group_slices)]
        )

    def names_of(self, bases: Iterable[str]) -> set[str]:
        """Column names whose own or base name is listed."""
        wanted = set(bases)
        return {f.name for f in self.fields if f.name in wanted or f.base_name in wanted}

    def with_keys(self, keys: Iterable[str]) -> Layout:
        """The layout with ``is_pk`` set for fields whose own or base name is a key."""
        named = self.names_of(keys)
        return replace(self, fields=tuple(replace(f, is_pk=f.name in named) for f in self.fields))

    def field(self, name: str) -> LayoutField:
        return next(f for f in self.fields if f.name == name)


def layout_from_tuples(name: str, rows: Iterable[tuple[str, int, int, str]]) -> Layout:
    """Layout from (name, start, end, type) rows, 1-based and inclusive."""
    fields = tuple(LayoutField(n, s, e - s + 1, t, base_name=n) for n, s, e, t in rows)
    return Layout(name, max((f.end for f in fields), default=0), fields)


def one_copybook(rows: DataFrame) -> DataFrame:
    """``rows``, after a look at two ids: an error if there are several copybooks."""
    if len(rows.select("copybook_id").distinct().limit(2).collect()) > 1:
        raise ValueError("several copybooks found: name the one to apply")
    return rows


def collect_layout(
    layouts: DataFrame, copybook_id: str | None = None, record_name: str | None = None
) -> Layout:
    """Take one record of one copybook from the layout table; the first
    record unless another is named."""
    wanted = layouts
    if copybook_id is not None:
        wanted = wanted.filter(F.col("copybook_id") == copybook_id)
    if record_name is not None:
        wanted = wanted.filter(F.col("record_name") == record_name)
    one = one_copybook(wanted)
    first = one.agg(F.min("record_no")).first()[0] or 0
    rows = one.filter(F.col("record_no") == first).select(
        "copybook_name", "occ_path", "field_name", "base_name", "kind",
        "data_type", "decimal_positions", "length", "start_pos", "end_pos",
    ).collect()
    rows = sorted(rows, key=lambda r: r.occ_path)
    fields = tuple(
        LayoutField(
            r.field_name, r.start_pos, r.length, r.data_type, r.decimal_positions, r.base_name, r.kind
        )
        for r in rows
    )
    name = rows[0].copybook_name if rows else "UNKNOWN_COPYBOOK"
    return Layout(name, max((r.end_pos for r in rows), default=0), fields)
