"""Running totals over long groups, by pieces that any number of tasks work on.

Rows are range-partitioned by group and order, so a group of any size is spread over
tasks. Each task totals the stretch of rows it reads; what runs over from one stretch to
the next is one state per stretch, composed in order on the driver (as many rows as
there are stretches, whatever the data) and added by a broadcast join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from tidemark.llm.workspace import materialize


def in_order(rows: DataFrame, order: list[Column], label: str) -> DataFrame:
    """The rows written in this order, with ``pos``: it grows in the order, by 1 inside a file.

    Rows equal in all of ``order`` come in any order and are spread over partitions too.
    """
    spread = rows.withColumn("__spread", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 20)))
    keys = [*order, F.col("__spread")]
    ordered = spread.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("__spread")
    return materialize(ordered.select(F.monotonically_increasing_id().alias("pos"), "*"), label)


def powers(base: int, count: int, modulus: int) -> np.ndarray:
    """base ** 0 to base ** count at least, by doubling; ``modulus`` has at most 31 bits."""
    out = np.ones(1, dtype=np.uint64)
    while len(out) <= count:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), modulus)) % np.uint64(modulus)])
    return out


def _partial(batches: Iterator[pa.RecordBatch], group: str, plain: list[str], points: dict[str, int], modulus: int) -> Iterator[pa.RecordBatch]:
    """Adds stretch, rank and the totals, each counted from the start of the group in the stretch."""
    p = np.uint64(modulus)
    last_pos, stretch, last_group, count = None, 0, None, 0
    held = dict.fromkeys([*plain, *points], 0)
    up = {name: powers(point, 1, modulus) for name, point in points.items()}
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        pos, key = batch.column("pos").to_numpy(), batch.column(group).to_numpy(zero_copy_only=False)
        apart = np.append(last_pos is None or pos[0] != last_pos + 1, pos[1:] != pos[:-1] + 1)
        fresh = apart | np.append(last_group is None or key[0] != last_group, key[1:] != key[:-1])
        run = np.cumsum(fresh)
        begin = np.append(0, np.flatnonzero(fresh))[run]
        goes_on = run == 0
        rank = np.arange(n) - begin + np.where(goes_on, count, 0)
        stretches = np.append(stretch, pos[apart])[np.cumsum(apart)]
        added = {"stretch": stretches, "rank": rank + 1}
        for name in plain:
            x = batch.column(name).to_numpy()
            total = np.cumsum(x)
            added[f"{name}_upto"] = total - (total[begin] - x[begin]) + np.where(goes_on, held[name], 0)
            held[name] = int(added[f"{name}_upto"][-1])
        for name in points:
            if len(up[name]) <= rank.max():
                up[name] = powers(points[name], 2 * int(rank.max()), modulus)
            term = batch.column(name).to_numpy().astype(np.uint64) * up[name][rank] % p
            total = np.cumsum(term)
            upto = (total - (total[begin] - term[begin]) + np.where(goes_on, held[name], 0).astype(np.uint64)) % p
            added[f"{name}_upto"], added[f"{name}_before"] = upto.astype(np.int64), ((upto + p - term) % p).astype(np.int64)
            held[name] = int(upto[-1])
        last_pos, stretch, last_group, count = pos[-1], stretches[-1], key[-1], int(rank[-1]) + 1
        columns = [*batch.columns, *(pa.array(v, pa.int64()) for v in added.values())]
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])


def _carries(ends: list, plain: list[str], points: dict[str, int], modulus: int) -> list[tuple]:
    """(stretch, its first group, that group's rank and totals in the stretches before, powers of the points) where there are any."""
    out, before = [], None
    for end in sorted(ends, key=lambda r: r.stretch):
        state = before[1] if before and before[0] == end.first else None
        if state:
            out.append((end.stretch, end.first, state["rank"], *(state[n] for n in (*plain, *points)), *(pow(x, state["rank"], modulus) for x in points.values())))
        tail = {"rank": end.tail["rank"], **{n: end.tail[f"{n}_upto"] for n in (*plain, *points)}}
        if state and end.first == end.tail["group"]:
            whole = {"rank": state["rank"] + tail["rank"], **{n: state[n] + tail[n] for n in plain}}
            tail = whole | {n: (state[n] + pow(x, state["rank"], modulus) * tail[n]) % modulus for n, x in points.items()}
        before = (end.tail["group"], tail)
    return out


def running(table: DataFrame, group: str, label: str, plain: list[str] = (), points: dict[str, int] | None = None, modulus: int = (1 << 31) - 1) -> DataFrame:
    """Adds ``rank`` (from 1) and running totals within each group, in the order of ``pos``.

    ``table`` comes from ``in_order`` with ``group`` as its first order column, not null.
    A column c of ``plain`` gets c_upto. One of ``points``, with point x, gets the
    polynomial c_upto, the sum of c * x ** (rank - 1) up to the row, and c_before, that
    without the row, both modulo ``modulus``.
    """
    plain, points = list(plain), points or {}
    names = ["stretch", "rank", *(f"{c}_upto" for c in plain), *(f"{c}_{end}" for c in points for end in ("upto", "before"))]
    schema = StructType(list(table.schema))
    for name in names:
        schema = schema.add(name, LongType())
    partial = materialize(table.mapInArrow(lambda b: _partial(b, group, plain, points, modulus), schema), label)
    tail = F.struct(F.col(group).alias("group"), "rank", *(f"{c}_upto" for c in (*plain, *points)))
    ends = partial.groupBy("stretch").agg(F.min_by(group, "pos").alias("first"), F.max_by(tail, "pos").alias("tail")).collect()
    kind = table.schema[group].dataType.simpleString()
    carried = ", ".join(["stretch bigint", f"__group {kind}", "__rank bigint", *(f"__{c} bigint" for c in (*plain, *points)), *(f"__power_{c} bigint" for c in points)])
    carry = table.sparkSession.createDataFrame(_carries(ends, plain, points, modulus), carried)
    joined = partial.join(F.broadcast(carry), "stretch", "left")
    on = F.col(group) == F.col("__group")
    columns = {"rank": F.col("rank") + F.when(on, F.col("__rank")).otherwise(0)}
    for c in plain:
        columns[f"{c}_upto"] = F.col(f"{c}_upto") + F.when(on, F.col(f"__{c}")).otherwise(0)
    for c in points:
        for end in ("upto", "before"):
            value = F.col(f"{c}_{end}")
            columns[f"{c}_{end}"] = F.when(on, (F.col(f"__{c}") + F.col(f"__power_{c}") * value) % modulus).otherwise(value)
    return joined.withColumns(columns).select(*table.columns, *names[1:])

