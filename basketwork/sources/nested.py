"""Nested documents as flat, typed columns: objects become columns, arrays of objects become child rows.

The types come from all documents, not from the first: each document's schema merges into one on the map side. A field
that is a number in one document and text in another is text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")


@dataclass
class Flattened:
    """`rows`: one row per document, scalar fields and arrays of scalars as columns.

    `children`: for each array of objects, by its path, its elements as documents of their own: the kept columns,
    `position` of each element from 0 (one more per nesting: `position`, then `<path>_position`), and its fields.
    """

    rows: DataFrame
    children: dict[str, Flattened] = field(default_factory=dict)


def document_type(documents: DataFrame, column: str) -> T.DataType:
    """One type that fits every document of a VARIANT column; objects as structs. No document: NullType."""
    found = documents.agg(F.schema_of_variant_agg(column)).first()[0]
    return T._parse_datatype_string(re.sub(r"\bOBJECT<", "STRUCT<", found).replace("STRUCT<>", "VOID"))


def _path(names: tuple[str, ...]) -> str:
    return "$" + "".join(f".{n}" if _PLAIN.fullmatch(n) else f'["{n}"]' for n in names)


def _target(kind: T.DataType) -> str:
    """Type of the column of a scalar field; mixed and unknown values are text, whole decimals stay exact."""
    if isinstance(kind, (T.VariantType, T.NullType, T.StructType)):
        return "string"
    if isinstance(kind, T.ArrayType):
        return f"array<{_target(kind.elementType)}>"
    return kind.simpleString()


def _leaves(kind: T.StructType, names: tuple[str, ...] = ()) -> list[tuple[tuple[str, ...], T.DataType]]:
    out = []
    for f in kind.fields:
        inner = (*names, f.name)
        out += _leaves(f.dataType, inner) if isinstance(f.dataType, T.StructType) and f.dataType.fields else [(inner, f.dataType)]
    return out


def _named(paths: list[tuple[str, ...]], taken: set[str]) -> list[str]:
    """Column names of paths, joined by `_`; a name that is taken gets a number."""
    out = []
    for names in paths:
        name, n = "_".join(names), 1
        while (shown := name if n == 1 else f"{name}_{n}").lower() in taken:
            n += 1
        taken.add(shown.lower())
        out.append(shown)
    return out


def flatten(documents: DataFrame, column: str, keep: list[str], kind: T.DataType | None = None) -> Flattened:
    """Flatten a VARIANT column; `keep` names the columns that go with each document and its children.

    Documents that are null, or no object where others are, have null fields. Without `kind` the documents are read
    once more for their type. Arrays of arrays, and empty or mixed arrays, stay columns of text arrays.
    """
    kind = document_type(documents, column) if kind is None else kind
    leaves = _leaves(kind) if isinstance(kind, T.StructType) else [((), kind)]
    nested = [(n, k) for n, k in leaves if isinstance(k, T.ArrayType) and isinstance(k.elementType, T.StructType)]
    flat = [(n, k) for n, k in leaves if (n, k) not in nested]
    shown = _named([n or (column,) for n, _ in flat], {c.lower() for c in keep})
    fields = [F.try_variant_get(column, _path(n), _target(k)).alias(c) for (n, k), c in zip(flat, shown)]
    out = Flattened(documents.select(*keep, *fields))
    for names, k in nested:
        label = "_".join(names) or column
        position = "position" if "position" not in keep else f"{label}_position"
        elements = F.posexplode(F.try_variant_get(column, _path(names), "array<variant>")).alias(position, label)
        child = documents.select(*keep, elements)
        out.children[label] = flatten(child, label, [*keep, position], k.elementType)
    return out


def parsed(df: DataFrame, json: str, alias: str = "document") -> DataFrame:
    """`df` with the JSON text of a column as VARIANT; text that is no JSON is null there."""
    return df.withColumn(alias, F.try_parse_json(json))


def rejected(df: DataFrame, json: str) -> DataFrame:
    """Rows whose text is no JSON."""
    return df.filter(F.col(json).isNotNull() & F.try_parse_json(json).isNull())


def as_documents(df: DataFrame, key: str, document: Column) -> DataFrame:
    """`key` and the JSON text of a nested value, the form in which document exports arrive."""
    return df.select(key, F.to_json(document).alias("json"))
