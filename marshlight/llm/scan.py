"""Running values over rows in order, where one group may hold most rows.

A window over a group would bring the group to one task. Here rows are dealt by ranges of their order, each task runs over its
own range, and what a group has gathered in earlier ranges is added after: one number for each range, so that is all that
is looked at as a whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import stage

#: What takes a running value back at the start of a group.
_UNDO = {np.add: np.subtract, np.bitwise_xor: np.bitwise_xor}
_APPLY = {np.add: lambda a, b: a + b, np.bitwise_xor: lambda a, b: a.bitwiseXOR(b)}


def running(df: DataFrame, group: str, order: list[str], values: list[str], fold: np.ufunc) -> DataFrame:
    """`df`, written and read back, with the long columns `values` replaced by their running fold within `group`.

    `order` starts with `group`; nulls come first and equal null. `fold` is np.add or np.bitwise_xor. Rows equal in `order` come
    in any order. An empty table stays empty.
    """
    fields = df.dtypes

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, row, last, held = TaskContext.get().partitionId(), 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.empty(batch.num_rows, dtype=object)
            keys[:] = batch.column(group).to_pylist()
            begins = np.ones(len(keys), dtype=bool)
            begins[1:] = keys[1:] != keys[:-1]
            if held is not None:
                begins[0] = keys[0] != last
            first = np.maximum.accumulate(np.where(begins, np.arange(len(keys)), -1))
            out, ends = [], []
            for k, name in enumerate(values):
                all_of = fold.accumulate(batch.column(name).to_numpy())
                before = np.where(first > 0, all_of[np.maximum(first, 1) - 1], 0)
                own = _UNDO[fold](all_of, before)
                if held is not None:
                    own = np.where(first < 0, fold(own, held[k]), own)
                out.append(own)
                ends.append(own[-1])
            last, held = keys[-1], ends
            columns = [pa.array(out[values.index(n)]) if n in values else batch.column(n) for n, _ in fields]
            rows = pa.array(np.arange(row, row + len(keys)))
            row += len(keys)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(keys), part)), rows], [*(n for n, _ in fields), "_part", "_row"])

    schema = ", ".join(f"`{n}` {t}" for n, t in fields) + ", _part long, _row long"
    ran = stage(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(local, schema))
    parts = ran.groupBy("_part").agg(
        F.min(F.struct(group)).alias("first"), F.max(F.struct(group)).alias("last"),
        F.max_by(F.array(*values), "_row").alias("tail")).orderBy("_part").collect()  # one row for each range
    carried, open_group, gathered = [], None, None
    for p in parts:
        came = gathered if open_group is not None and open_group == p["first"] else None
        if came is not None:
            carried.append((p["_part"], *came))
        tail = [int(v) for v in p["tail"]]
        whole = p["first"] == p["last"]
        gathered = [int(fold(np.int64(a), np.int64(b))) for a, b in zip(tail, came)] if whole and came is not None else tail
        open_group = p["last"]
    firsts = {p["_part"]: p["first"][0] for p in parts}
    if not carried:
        return ran.drop("_part", "_row")
    spark, kind = df.sparkSession, dict(fields)[group]
    came = spark.createDataFrame([(p, firsts[p], *v) for p, *v in carried],
                                 f"_part long, _first {kind}, {', '.join(f'_c{k} long' for k in range(len(values)))}")
    joined = ran.join(F.broadcast(came), ran["_part"].eqNullSafe(came["_part"]) & ran[group].eqNullSafe(came["_first"]), "left")
    return joined.select(*[
        _APPLY[fold](ran[n], F.coalesce(f"_c{values.index(n)}", F.lit(0))).alias(n) if n in values else ran[n] for n, _ in fields])


def placed(df: DataFrame, group: str, order: list[str], name: str = "pos") -> DataFrame:
    """`df`, written and read back, with `name`: the place of a row in its group, from 0."""
    counted = running(df.withColumn(name, F.lit(1).cast("long")), group, order, [name], np.add)
    return counted.withColumn(name, F.col(name) - 1)
