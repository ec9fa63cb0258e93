"""Record schemas found in landed pages, and a child table for every list in them.

The explicit schemas of :mod:`..schemas` name the fields that are known. What an API adds later is found here:
each record is parsed once as a VARIANT, the records' schemas are merged by an aggregate (combined map-side; a field
absent from some records is nullable, one of several types becomes text), and every list, at any depth, becomes a
table of its own with its parent's key and its positions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

SEP = "__"


def discovered_schema(records: DataFrame, json_col: str = "_json") -> StructType:
    """The merged schema of all records that are objects (JSON text in ``json_col``); no objects give no fields.

    Numbers with a fraction are DOUBLE; fields that are always null, and fields of several types, are text.
    """
    v = F.try_parse_json(json_col)
    found = records.where(F.json_object_keys(json_col).isNotNull()).agg(F.schema_of_variant_agg(v)).first()[0] or ""
    if not found.startswith("OBJECT<"):
        return StructType()
    ddl = re.sub(r"`[^`]*(?:``[^`]*)*`|\bOBJECT<|\b(?:VARIANT|VOID)\b|\bDECIMAL\([^)]*\)|\bFLOAT\b", _as_ddl, found)
    return StructType.fromDDL(ddl[len("STRUCT<"):-1]) if ddl != "STRUCT<>" else StructType()


def _as_ddl(m: re.Match) -> str:
    """A piece of a variant's schema as SQL types; quoted names stay."""
    part = m[0]
    return part if part[0] == "`" else "STRUCT<" if part == "OBJECT<" else "STRING" if part in ("VARIANT", "VOID") else "DOUBLE"


def typed_records(records: DataFrame, schema: StructType, json_col: str = "_json") -> DataFrame:
    """The records as columns of ``schema`` (records that are no objects are left out; they are rejects of the reader)."""
    rows = records.where(F.json_object_keys(json_col).isNotNull())
    return rows.select(F.from_json(json_col, schema).alias("r")).select("r.*")


def _field(path: Column, name: str) -> Column:
    return path.getField(name)


def _scalars(kind: StructType, path: Column | None, prefix: str = "") -> Iterator[Column]:
    for f in kind.fields:
        c = F.col("`" + f.name.replace("`", "``") + "`") if path is None else _field(path, f.name)
        if isinstance(f.dataType, StructType):
            yield from _scalars(f.dataType, c, f"{prefix}{f.name}{SEP}")
        elif not isinstance(f.dataType, ArrayType):
            yield c.alias(prefix + f.name)


def _lists(kind: DataType, path: Column | None, prefix: str = "") -> Iterator[tuple[str, Column, DataType]]:
    for f in kind.fields if isinstance(kind, StructType) else ():
        c = F.col("`" + f.name.replace("`", "``") + "`") if path is None else _field(path, f.name)
        if isinstance(f.dataType, ArrayType):
            yield prefix + f.name, c, f.dataType.elementType
        else:
            yield from _lists(f.dataType, c, f"{prefix}{f.name}{SEP}")


def child_tables(df: DataFrame, keys: list[str], name: str = "") -> dict[str, DataFrame]:
    """``name`` -> the records' own fields, ``name__list`` -> one row per entry of a list, and so on downwards.

    Structs are flattened (``owner__login``). A child has its parent's keys, ``<list>_pos`` (from 0) for each list above
    it, and its entry's fields, or ``value`` for a plain one. Empty and missing lists give no rows.
    """
    out: dict[str, DataFrame] = {name: df.select(*_scalars(df.schema, None))}

    def walk(rows: DataFrame, ids: list[str], kind: DataType, path: Column | None, prefix: str) -> None:
        for field, where, element in _lists(kind, path):
            table, pos = f"{prefix}{SEP}{field}" if prefix else field, f"{field}_pos"
            entries = rows.select(*ids, F.posexplode(where).alias(pos, "_entry"))
            entry, mine = F.col("_entry"), [*ids, pos]
            fields = list(_scalars(element, entry)) if isinstance(element, StructType) else [] if isinstance(element, ArrayType) else [entry.alias("value")]
            out[table] = entries.select(*mine, *fields)
            if isinstance(element, ArrayType):  # a list of lists
                element, entry = StructType().add("list", element), F.struct(entry.alias("list"))
            walk(entries, mine, element, entry, table)

    walk(df, keys, df.schema, None, name)
    return out
