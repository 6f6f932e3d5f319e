"""Slowly changing dimensions: every version of a row with the time it was valid."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import snapshot_hash


@dataclass(frozen=True)
class SnapshotColumns:
    valid_from: str = "valid_from"
    valid_to: str = "valid_to"
    scd_id: str = "scd_id"
    updated_at: str = "updated_at_version"
    is_deleted: str = "is_deleted"


@dataclass(frozen=True)
class SnapshotRule:
    """How versions are told apart.

    ``strategy='timestamp'``: a row changed if its ``updated_at`` is later than
    the open version's start. ``strategy='check'``: if any of ``check_columns``
    (None: all) differs, nulls counted as values; a column the snapshot does
    not know yet makes every row changed.
    ``hard_deletes``: what happens to keys that left the source: ``ignore``,
    ``invalidate`` (close them) or ``new_record`` (close, and add a version
    marked deleted).
    """

    keys: Sequence[str]
    strategy: str = "timestamp"
    updated_at: str | None = None
    check_columns: Sequence[str] | None = None
    hard_deletes: str = "ignore"
    valid_to_current: str | None = None
    columns: SnapshotColumns = SnapshotColumns()

    def __post_init__(self) -> None:
        if self.strategy not in ("timestamp", "check"):
            raise ValueError("strategy must be 'timestamp' or 'check'")
        if self.strategy == "timestamp" and self.updated_at is None:
            raise ValueError("the timestamp strategy needs updated_at")
        if self.hard_deletes not in ("ignore", "invalidate", "new_record"):
            raise ValueError("hard_deletes must be 'ignore', 'invalidate' or 'new_record'")


def _now(as_of: str | None) -> Column:
    return (F.current_timestamp() if as_of is None else F.lit(as_of)).cast("timestamp_ntz")


def _stamp(rule: SnapshotRule, as_of: str | None) -> Column:
    return F.col(rule.updated_at).cast("timestamp_ntz") if rule.updated_at else _now(as_of)


def _open_end(rule: SnapshotRule) -> Column:
    return F.lit(rule.valid_to_current).cast("timestamp_ntz")


def snapshot_start(source: DataFrame, rule: SnapshotRule, as_of: str | None = None) -> DataFrame:
    """First snapshot: every source row as an open version."""
    names, stamp = rule.columns, _stamp(rule, as_of)
    out = source.select(
        "*",
        snapshot_hash([*rule.keys, stamp]).alias(names.scd_id),
        stamp.alias(names.updated_at),
        stamp.alias(names.valid_from),
        _open_end(rule).alias(names.valid_to),
    )
    return out.withColumn(names.is_deleted, F.lit("False")) if rule.hard_deletes == "new_record" else out


def snapshot_apply(snapshot: DataFrame, source: DataFrame, rule: SnapshotRule, as_of: str | None = None) -> DataFrame:
    """Next state of the snapshot: closed versions, unchanged ones, new ones.

    Open versions and the source meet in one full join on the key; versions
    closed earlier pass through without a shuffle.
    """
    names, now, open_end = rule.columns, _now(as_of), _open_end(rule)
    added = {f.name: F.lit(None).cast(f.dataType) for f in source.schema.fields if f.name not in snapshot.columns}
    known = [c for c in source.columns if c not in added]
    if rule.hard_deletes == "new_record" and names.is_deleted not in snapshot.columns:
        added[names.is_deleted] = F.lit("False")
    snapshot = snapshot.withColumns(added) if added else snapshot

    is_open = F.col(names.valid_to).isNull()
    if rule.valid_to_current is not None:
        is_open = is_open | F.coalesce(F.col(names.valid_to) == open_end, F.lit(False))
    closed = snapshot.filter(~is_open)
    current = snapshot.filter(is_open).withColumn("_hit", F.lit(True)).alias("o")
    incoming = source.withColumns({"_hit": F.lit(True), "_stamp": _stamp(rule, as_of)}).alias("s")
    both = current.join(incoming, [F.col(f"o.{k}") == F.col(f"s.{k}") for k in rule.keys], "full")

    old, new = F.col("o._hit").isNotNull(), F.col("s._hit").isNotNull()
    stamp = F.col("s._stamp")
    if rule.strategy == "timestamp":
        differs = F.col(f"o.{names.valid_from}") < stamp
    else:
        checked = list(rule.check_columns or source.columns)
        if any(c not in known for c in checked):
            differs = F.lit(True)
        else:
            differs = F.lit(False)
            for c in checked:
                differs = differs | ~F.col(f"o.{c}").eqNullSafe(F.col(f"s.{c}"))
    changed = old & new & F.coalesce(differs, F.lit(False))
    gone = old & ~new & F.lit(rule.hard_deletes != "ignore")

    ends = F.when(changed, stamp).when(gone, now).otherwise(F.col(f"o.{names.valid_to}"))
    opened = {
        names.valid_from: stamp,
        names.updated_at: stamp,
        names.valid_to: open_end,
        names.scd_id: snapshot_hash([*[F.col(f"s.{k}") for k in rule.keys], stamp]),
        names.is_deleted: F.lit("False"),
    }
    removed = {
        names.valid_from: now,
        names.updated_at: now,
        names.scd_id: snapshot_hash([F.col(f"o.{names.scd_id}"), now]),
        names.is_deleted: F.lit("True"),
    }

    def version(side: str, values: dict[str, Column]) -> Column:
        cells = []
        for f in snapshot.schema.fields:
            if f.name in values:
                cell = values[f.name]
            elif side == "o" or f.name in source.columns:
                cell = F.col(f"{side}.{f.name}")
            else:
                cell = F.lit(None)
            cells.append(cell.cast(f.dataType).alias(f.name))
        return F.struct(*cells)

    versions = [
        F.when(old, version("o", {names.valid_to: ends})),
        F.when(new & (~old | changed), version("s", opened)),
    ]
    if rule.hard_deletes == "new_record":
        versions.append(F.when(gone, version("o", removed)))
    next_open = both.select(F.inline(F.array_compact(F.array(*versions))))
    return closed.unionByName(next_open)
