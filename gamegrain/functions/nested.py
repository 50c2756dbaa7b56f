"""Structs, arrays of structs, and the way between nested documents and flat rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# (path below the struct, name of the result), or just a name that stays as it is.
Pick = str | tuple[str, str]


def field(struct: Column, path: str) -> Column:
    """``field(x, 'name.default')`` is the nested field ``x.name.default``."""
    for name in path.split("."):
        struct = struct.getField(name)
    return struct


def picks(struct: Column, wanted: Sequence[Pick]) -> list[Column]:
    """The wanted nested fields as columns."""
    pairs = [(pick, pick) if isinstance(pick, str) else pick for pick in wanted]
    return [field(struct, path).alias(name) for path, name in pairs]


def narrow(array: Column, wanted: Sequence[Pick]) -> Column:
    """Array of wide structs → array of narrow, renamed structs."""
    return F.transform(array, lambda item: F.struct(*picks(item, wanted)))


def concat_safe(*arrays: Column) -> Column:
    """Concatenation in which a NULL array counts as an empty one."""
    return F.concat(*[F.coalesce(array, F.array()) for array in arrays])


def ordered_by(array: Column, key: str) -> Column:
    """Structs sorted ascending by one field, equal keys in their old order (comparator sort)."""
    return F.array_sort(
        array,
        lambda a, b: F.when(a[key] < b[key], F.lit(-1)).when(a[key] > b[key], F.lit(1)).otherwise(F.lit(0)),
    )


def parallel_arrays(array: str, fields: Sequence[str], prefix: str = "") -> list[Column]:
    """One array per field of a column of structs, all in the same order."""
    return [F.col(array).getField(name).alias(prefix + name) for name in fields]


def cell(array: Column, name: Column | str, name_field: str, value_field: str) -> Column:
    """First value of one attribute in a list of (attribute, value …) structs; NULL where it is missing.

    Position lookup instead of a lambda, so the expression stays inside generated code.
    """
    position = F.array_position(array.getField(name_field), name)
    return F.get(array.getField(value_field), (position - 1).cast("int"))


def flatten_schema(schema: T.StructType, parents: tuple[str, ...] = ()) -> list[Column]:
    """Every leaf of nested structs as one column with a dotted name; arrays stay whole."""
    columns: list[Column] = []
    for item in schema.fields:
        path = (*parents, item.name)
        if isinstance(item.dataType, T.StructType):
            columns += flatten_schema(item.dataType, path)
        else:
            columns.append(F.col(".".join(f"`{name}`" for name in path)).alias(".".join(path)))
    return columns


def nest_schema(flat: T.StructType) -> T.StructType:
    """Inverse of ``flatten_schema`` for a schema: dotted names become nested structs."""
    children: dict[str, T.StructType | T.DataType] = {}
    for item in flat.fields:
        head, _, rest = item.name.partition(".")
        if rest:
            children.setdefault(head, T.StructType()).add(rest, item.dataType)
        else:
            children[head] = item.dataType
    dotted = {item.name.partition(".")[0] for item in flat.fields if "." in item.name}
    return T.StructType(
        [T.StructField(name, nest_schema(kind) if name in dotted else kind) for name, kind in children.items()]
    )
