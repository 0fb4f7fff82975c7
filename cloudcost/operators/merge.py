"""Keyed, column-scoped merge (upsert) of daily tables, and the table-maintenance
filters around it.

Parquet tables have no MERGE, so a merge is expressed as *one aggregation*:
the target and every update batch are unioned with a sequence number and
grouped by the unique key. For each non-key column the result is the value of
the latest batch that *owns* the column (its ``update_cols``); if no batch owns
it for that key, the value of the first row for the key (the existing target
row, or the inserting batch) is kept. That is exactly INSERT ... ON DUPLICATE
KEY UPDATE <update_cols> applied batch after batch, but it costs one shuffle on
the key instead of one full outer join per batch, and ``max_by``/``min_by`` are
partially aggregated map-side, so a hot key does not pile up in one task.

Only the target partitions the caller names (e.g. the billing months of the
update) take part; the rest pass through untouched (``partition_col``,
``partitions``: a literal list, so that the scan of the target prunes).
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEQ = "__merge_seq"


@dataclass
class Batch:
    """One update batch and the non-key columns it overwrites on conflict.

    ``order``: optional column giving the arrival order inside the batch; when
    a key occurs more than once, the row with the highest order wins ("last
    wins"). Without it keys must be unique in the batch (aggregates are).
    """
    df: DataFrame
    update_cols: list[str]
    order: str | None = None


def keyed_merge(target: DataFrame | None, batches: list[Batch], keys: list[str],
                columns: list[str] | None = None, partition_col: str | None = None,
                partitions: list | None = None) -> DataFrame:
    """Apply ``batches`` in order to ``target`` (may be None = empty table).

    Keys compare null-safe (grouping treats NULLs as equal). Within one batch
    the key is expected to be unique (the daily aggregates are by construction).
    """
    if columns is None:
        columns = (target.columns if target is not None else batches[0].df.columns)
    values = [c for c in columns if c not in keys]
    if target is None and len(batches) == 1:
        # nothing to merge into: a batch is unique on its key already
        return batches[0].df.select(*columns)

    untouched = None
    if target is not None and partition_col is not None and partitions is not None:
        touched = F.coalesce(F.col(partition_col).isin(*partitions), F.lit(False))
        untouched = target.filter(~touched).select(*columns)
        target = target.filter(F.col(partition_col).isin(*partitions))

    frames = []
    if target is not None:
        frames.append(target.select(*columns).withColumn(_SEQ, F.lit(0)))
    for i, b in enumerate(batches, start=1):
        frames.append(_last_per_key(b, keys, columns).withColumn(_SEQ, F.lit(i)))
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f)

    # columns with the same owners are picked together: one max_by per owner
    # set (plus one min_by for the first row) instead of two per column
    groups = owner_groups(batches, values)
    seqs = range(0 if target is not None else 1, len(batches) + 1)
    latest = {c for owners, cols in groups.items() if latest_owns(owners, seqs) for c in cols}
    first = [c for c in values if c not in latest]
    aggs: list[Column] = [F.min_by(F.struct(*[F.col(c) for c in first]), F.col(_SEQ)).alias("__first")] if first else []
    for n, (owners, cols) in enumerate(groups.items()):
        rank = F.col(_SEQ) if cols[0] in latest else F.when(F.col(_SEQ).isin(*owners), F.col(_SEQ))
        aggs.append(F.max_by(F.struct(*[F.col(c) for c in cols]), rank).alias(f"__own{n}"))
    merged = u.groupBy(*keys).agg(*aggs) if aggs else u.select(*keys).distinct()

    where = {c: n for n, (_, cols) in enumerate(groups.items()) for c in cols}

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        if c not in where:
            return F.col(f"__first.{c}").alias(c)
        own = f"__own{where[c]}"
        if c in latest:
            return F.col(f"{own}.{c}").alias(c)
        return F.when(F.col(own).isNotNull(), F.col(f"{own}.{c}")).otherwise(F.col(f"__first.{c}")).alias(c)
    out = merged.select(*[pick(c) for c in columns])
    if untouched is not None:
        out = out.unionByName(untouched)
    return out


def owner_groups(batches: list[Batch], values: list[str]) -> dict[tuple[int, ...], list[str]]:
    """Columns by the numbers (from 1) of the batches that own them; unowned ones are left out."""
    groups: dict[tuple[int, ...], list[str]] = {}
    for c in values:
        owners = tuple(i for i, b in enumerate(batches, start=1) if c in b.update_cols)
        if owners:
            groups.setdefault(owners, []).append(c)
    return groups


def latest_owns(owners: tuple[int, ...], seqs: Iterable[int]) -> bool:
    """Whether a column's value is that of a key's latest row among ``seqs``, whoever owns it:
    all own it but one, which comes before all owners and so counts only where it is alone.
    The key's first row need not carry such a column through the shuffle."""
    rest = [i for i in seqs if i not in owners]
    return not rest or (len(rest) == 1 and rest[0] < min(owners))


def _last_per_key(b: Batch, keys: list[str], columns: list[str]) -> DataFrame:
    """The batch with one row per key: the last by ``order`` (an aggregate, so
    duplicates are combined map-side before the shuffle)."""
    if b.order is None:
        return b.df.select(*columns)
    values = [c for c in columns if c not in keys]
    last = b.df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(b.order)).alias("_v"))
    return last.select(*keys, *[F.col(f"_v.{c}").alias(c) for c in values]).select(*columns)


def upsert_all(target: DataFrame | None, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert replacing every non-key column (K5, K6 with all values)."""
    cols = updates.columns
    return keyed_merge(target, [Batch(updates, [c for c in cols if c not in keys])], keys, cols)


def append_new(target: DataFrame, new_rows: DataFrame, guard_keys: list[str]) -> DataFrame:
    """K8 with an idempotency guard: rows whose guard key already exists are
    not appended again (a replayed run appends nothing)."""
    fresh = new_rows.join(target.select(*guard_keys).distinct(), guard_keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def window_delete(df: DataFrame, cond: Column) -> DataFrame:
    """Keep rows outside the deleted window (NULL condition keeps the row,
    as a SQL DELETE would)."""
    return df.filter(~F.coalesce(cond, F.lit(False)))
