"""Tables against stored signatures: which columns fit, which widen, which rows are set aside."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Each type with the types its values fit into without loss, nearest first.
_WIDER = {
    "tinyint": ("smallint", "int", "bigint", "float", "double"),
    "smallint": ("int", "bigint", "float", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz", "timestamp"),
}
VIOLATIONS = "violations"


def fit(actual: T.DataType, expected: T.DataType) -> str:
    """`ok`, `widened` or `type_mismatch`; lists by their elements, structs only if they are equal."""
    if isinstance(actual, T.ArrayType) and isinstance(expected, T.ArrayType):
        return fit(actual.elementType, expected.elementType)
    if actual.simpleString() == expected.simpleString():
        return "ok"
    return "widened" if expected.simpleString() in _WIDER.get(actual.simpleString(), ()) else "type_mismatch"


def column_status(schema: T.StructType, signature: T.StructType) -> dict[str, str]:
    """Status of every column of the signature and the table; `missing` and `unexpected` beside those of `fit`."""
    actual = {f.name: f.dataType for f in schema.fields}
    expected = {f.name: f.dataType for f in signature.fields}
    found = {n: fit(actual[n], t) if n in actual else "missing" for n, t in expected.items()}
    return found | {n: "unexpected" for n in actual if n not in expected}


def _faults(field: T.StructField, length: int | None) -> list[Column]:
    """One column for each rule: the text of the violation, else NULL."""
    column, name = F.col(f"`{field.name}`"), field.name
    found = []
    if not field.nullable:
        found.append(F.when(column.isNull(), F.lit(f"{name}: null")))
    if isinstance(field.dataType, T.ArrayType):
        if not field.dataType.containsNull:
            found.append(F.when(F.exists(column, lambda x: x.isNull()), F.lit(f"{name}: null inside")))
        if length is not None:
            found.append(F.when(F.size(column) != length, F.lit(f"{name}: not {length} items")))
    return found


def _lenient(t: T.DataType) -> T.DataType:
    """The type with NULL items allowed: whether there are any is a matter of the rows."""
    return T.ArrayType(_lenient(t.elementType), True) if isinstance(t, T.ArrayType) else t


def conform(
    df: DataFrame, signature: T.StructType, lengths: Mapping[str, int] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the signature, rows set aside with `violations`), columns widened to it.

    A column that is missing or of a type that does not widen is an error of the whole table.  Of the rows,
    NULL is a violation in a column that is not nullable, a NULL item in a list without NULLs, and another
    length than that of `lengths`.  Columns the signature does not know stay as they are.  Both results come
    from the same columns: a filter each, no pass of its own.
    """
    status = column_status(df.schema, signature)
    wrong = {n: s for n, s in status.items() if s in ("missing", "type_mismatch")}
    if wrong:
        raise ValueError(f"columns do not keep the signature: {wrong}")
    if VIOLATIONS in df.columns:
        raise ValueError(f"a column is called {VIOLATIONS}")
    wider = [f for f in signature.fields if status[f.name] == "widened"]
    checked = df.withColumns({f.name: F.col(f"`{f.name}`").cast(_lenient(f.dataType)) for f in wider}) if wider else df
    faults = [c for f in signature.fields for c in _faults(f, (lengths or {}).get(f.name))]
    listed = F.array_compact(F.array(*faults)) if faults else F.array().cast("array<string>")
    checked = checked.withColumn(VIOLATIONS, listed)
    return checked.where(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), checked.where(F.size(VIOLATIONS) > 0)


def signature_of(df: DataFrame, *columns: str, required: bool = True) -> str:
    """The columns of a table as a stored signature; `required` ones may not be NULL nor hold one."""

    def strict(t: T.DataType) -> T.DataType:
        return T.ArrayType(strict(t.elementType), False) if isinstance(t, T.ArrayType) else t

    fields = [df.schema[c] for c in columns]
    if required:
        fields = [T.StructField(f.name, strict(f.dataType), False) for f in fields]
    return T.StructType(fields).json()


def read_signature(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))
