"""Array, JSON and variant expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def array_construct(*items: Column | str) -> Column:
    return F.array(*map(_col, items))


def array_append(items: Column | str, item: Column | str) -> Column:
    return F.array_append(_col(items), _col(item))


def array_concat(a: Column | str, b: Column | str) -> Column:
    return F.concat(_col(a), _col(b))


def json_parse(text: Column | str, schema: T.StructType) -> Column:
    """JSON text to a struct; unknown fields dropped, missing ones null."""
    return F.from_json(_col(text), schema)


def json_emit(*columns: Column | str) -> Column:
    return F.to_json(F.struct(*map(_col, columns)))


def variant_extract(value: Column | str, field: str, kind: str) -> Column:
    """Typed field of a semi-structured value; null if absent or not of that type."""
    return F.try_variant_get(_col(value), f"$.{field}", kind)


def listagg(measure: Column | str, delimiter: str = ",", order_by: Column | None = None) -> Column:
    """Text of all values of a group, ordered by ``order_by`` (default: the value)."""
    value = _col(measure).cast("string")
    key = value if order_by is None else order_by
    pairs = F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(key.alias("k"), value.alias("v")))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), delimiter)
