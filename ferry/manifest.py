"""Table manifest: the constraints that Parquet and session tables cannot carry.

A ``TableSet`` is a plain ``dict[str, DataFrame]`` (name -> table). A
``Manifest`` maps the same names to ``TableSpec`` objects holding the target
schema, keys, foreign keys, unique rules, identity column and length limits.
Not-null rules come from ``StructField.nullable`` of the spec's schema.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TableSet = dict[str, DataFrame]

INTEGRAL_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class UniqueKey:
    columns: tuple[str, ...]
    collation: str | None = None  # e.g. "UNICODE_CI": case-insensitive, accent-sensitive


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    primary_key: tuple[str, ...] = ()
    unique: tuple[UniqueKey, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    identity: str | None = None
    max_len: Mapping[str, int] = field(default_factory=dict)
    logical: Mapping[str, str] = field(default_factory=dict)  # col -> "uuid" | "json"

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.schema.fields]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def text_columns(self) -> list[str]:
        """Plain text columns, the subject of row-level text parity."""
        return [f.name for f in self.schema.fields
                if isinstance(f.dataType, T.StringType)
                and f.name not in self.logical
                and f.name not in self.primary_key]


class Manifest(dict):
    """name -> TableSpec, iterated in name order like the target catalogue."""

    def __init__(self, specs: Iterable[TableSpec] = ()):
        super().__init__((s.name, s) for s in specs)

    def names(self) -> list[str]:
        return sorted(self)

    def identity_columns(self) -> list[tuple[str, str]]:
        return [(n, self[n].identity) for n in self.names() if self[n].identity]

    def foreign_keys(self) -> list[tuple[str, ForeignKey]]:
        return [(n, fk) for n in self.names() for fk in self[n].foreign_keys]


def spec_from_frame(name: str, df: DataFrame, *, nullable: Iterable[str] = (),
                    **kwargs) -> TableSpec:
    """Spec whose schema is ``df``'s, every column NOT NULL unless listed."""
    keep = set(nullable)
    schema = T.StructType([
        T.StructField(f.name, f.dataType, f.name in keep, f.metadata)
        for f in df.schema.fields
    ])
    return TableSpec(name=name, schema=schema, **kwargs)
