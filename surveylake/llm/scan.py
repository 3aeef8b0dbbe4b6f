"""Running sums over rows in a global order, and digests of ordered texts, for groups of any size."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.llm.common import column, fresh, saved

# A chunk of joined texts ends beyond this number of bytes.
CHUNK_BYTES = 1 << 14


def running(
    frame: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column | str] | None = None,
    overall: Mapping[str, Column | str] | None = None,
    label: str = "running",
) -> DataFrame:
    """The rows with inclusive running sums in the order of (``group``, ``order``).

    ``sums`` start anew in each group, ``overall`` run over all rows. The order (ascending, NULL
    first) must be total up to rows that may stand for each other. Rows are cut into ranges of that
    order, whatever the groups: sums run within each range and are shifted by the ranges before it,
    so a group with a third of all rows is worked on by many tasks. Only the first group of a range
    can go on from the range before, so the shifts are one row for each range at most.
    """
    sums, overall = dict(sums or {}), dict(overall or {})
    part, start = fresh(frame, "part"), fresh(frame, "start")
    keys = [column(name) for name in group]
    ordered = [column(name).asc_nulls_first() for name in (*group, *order)]
    spread = frame.repartitionByRange(*ordered).withColumn(part, F.spark_partition_id())
    ranged = saved(spread.withColumns({name: _sum_of(value) for name, value in {**sums, **overall}.items()}), label)

    own = ranged.groupBy(part, *keys).agg(*(F.sum(column(name)).alias(name) for name in sums), F.count(F.lit(1)).alias(start))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = {name: F.sum(column(name)).over(before) for name in sums}
    # A group's first range has no shift; the window gives NULL there.
    carried = own.select(part, *keys, F.count(F.lit(1)).over(before).alias(start), *(value.alias(name) for name, value in shifts.items()))
    carried = carried.where(column(start) > 0).drop(start)
    whole = ranged.groupBy(part).agg(*(F.sum(column(name)).alias(name) for name in overall), F.count(F.lit(1)).alias(start))
    earlier = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    moved = whole.select(part, *(F.coalesce(F.sum(column(name)).over(earlier), F.lit(0)).alias(name) for name in overall))

    by_row = ranged.repartition(part)
    inside = Window.partitionBy(part).orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    inside_group = Window.partitionBy(part, *keys).orderBy(*ordered[len(keys) :]).rowsBetween(Window.unboundedPreceding, 0)
    found = by_row.withColumns(
        {name: F.sum(column(name)).over(inside) for name in overall} | {name: F.sum(column(name)).over(inside_group) for name in sums}
    )
    result = found.alias("found")
    total = {name: column(name) for name in frame.columns if name not in (*sums, *overall)}
    if sums:
        same = F.col(f"found.{part}") == F.col(f"carried.{part}")
        for name in group:
            same &= F.col(f"found.`{name}`").eqNullSafe(F.col(f"carried.`{name}`"))
        result = result.join(F.broadcast(carried.alias("carried")), same, "left")
        total |= {name: F.col(f"found.{name}") + F.coalesce(F.col(f"carried.{name}"), F.lit(0)) for name in sums}
    if overall:
        result = result.join(F.broadcast(moved.alias("moved")), F.col(f"found.{part}") == F.col(f"moved.{part}"))
        total |= {name: F.col(f"found.{name}") + F.col(f"moved.{name}") for name in overall}
    plain = [name for name in frame.columns if name not in (*sums, *overall)]
    return result.select(*(F.col(f"found.`{name}`").alias(name) for name in plain), *(total[name].alias(name) for name in (*sums, *overall)))


def _sum_of(value: Column | str) -> Column:
    return (column(value) if isinstance(value, str) else value).cast("bigint")


def digests(frame: DataFrame, key: str, order: Sequence[str], text: str, separator: str, name: str) -> DataFrame:
    """``key`` and the lower-case SHA-256 of its texts, joined in ``order`` (``key`` must not be NULL).

    Sorted ranges of rows are joined to chunks first, so the task that hashes a hot key reads few
    rows; it passes over them with a constant amount of memory. A SHA-256 has no parallel form.
    """
    between = separator.encode()
    places = [frame.schema[field] for field in order]
    chunk_schema = T.StructType([frame.schema[key], *places, T.StructField("data", T.BinaryType())])
    result_schema = T.StructType([frame.schema[key], T.StructField(name, T.StringType())])
    width = len(order)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1 + width).to_pylist()
            starts: list[int] = []
            data: list[list[bytes]] = []
            size = 0
            for i, (group, value) in enumerate(zip(keys, texts)):
                if not i or group != keys[i - 1] or size > CHUNK_BYTES:
                    starts.append(i)
                    data.append([])
                    size = 0
                data[-1].append(value.encode())
                size += len(data[-1][-1])
            first = pa.array(starts, pa.int64())
            columns = [batch.column(i).take(first) for i in range(1 + width)]
            columns.append(pa.array([between.join(parts) for parts in data], pa.binary()))
            if target is None:
                target = pa.schema([*list(batch.schema)[: 1 + width], pa.field("data", pa.binary())])
            yield pa.RecordBatch.from_arrays(columns, schema=target)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, state, kind = None, None, None
        for batch in batches:
            kind = batch.schema.field(0)
            done: list = []
            sums: list[str] = []
            for key_, data in zip(batch.column(0).to_pylist(), batch.column(1 + width).to_pylist()):
                if state is None or key_ != group:
                    if state is not None:
                        done.append(group)
                        sums.append(state.hexdigest())
                    group, state = key_, hashlib.sha256(data)
                else:
                    state.update(between)
                    state.update(data)
            yield pa.RecordBatch.from_arrays([pa.array(done, kind.type), pa.array(sums, pa.string())], names=[key, name])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([group], kind.type), pa.array([state.hexdigest()], pa.string())], names=[key, name])

    slim = frame.select(key, *order, text)
    ranged = slim.repartitionByRange(key, *order).sortWithinPartitions(key, *order).mapInArrow(chunks, chunk_schema)
    return ranged.repartition(key).sortWithinPartitions(key, *order).mapInArrow(hashed, result_schema)
