"""A logical model: tables, their relationships, and views that name only fields.

A view is a set of dimensions and measures. Which tables are read, and how they are
joined, follows from the fields it names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import mean

_SUMMED = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Relationship:
    """Rows of two tables belong together where these columns are equal; neither has to be unique."""

    left: str
    left_column: str
    right: str
    right_column: str

    def towards(self, table: str) -> tuple[str, str, str] | None:
        """(own column, other table, its column) seen from ``table``."""
        if table == self.left:
            return self.left_column, self.right, self.right_column
        if table == self.right:
            return self.right_column, self.left, self.left_column
        return None


@dataclass(frozen=True)
class Measure:
    """count, sum, min, max or avg of a field; count of a table (``table``) counts its rows.

    With ``fixed`` the aggregate is taken at those dimensions whatever the view, and the
    view adds its values up by ``then``.
    """

    how: str
    field: str | None = None
    table: str | None = None
    fixed: tuple[str, ...] | None = None
    then: str = "sum"


class LogicalModel:
    """Tables by name, the tree of their relationships, and the fields a view can name.

    ``fields`` says for each name the table and column it stands for.
    """

    def __init__(self, tables: dict[str, DataFrame], relationships: Sequence[Relationship], fields: dict[str, tuple[str, str]]):
        self.tables, self.relationships, self.fields = dict(tables), list(relationships), dict(fields)
        for name, (table, column) in self.fields.items():
            if table not in self.tables or column not in self.tables[table].columns:
                raise ValueError(f"field {name}: no column {column} of table {table}")

    def _steps(self, start: str, goals: set[str]) -> list[tuple[str, str, str, str]]:
        """Joins (table, column, other, its column) that lead from a table to all others of ``goals``, and no further."""
        came: dict[str, tuple[str, str, str, str]] = {}
        open_, seen = [start], {start}
        while open_:
            table = open_.pop(0)
            for edge in filter(None, (r.towards(table) for r in self.relationships)):
                if edge[1] not in seen:
                    seen.add(edge[1])
                    came[edge[1]] = (table, *edge)
                    open_.append(edge[1])
        if goals - seen:
            raise ValueError(f"{start} is not related to {sorted(goals - seen)}")
        needed: list[tuple[str, str, str, str]] = []
        for goal in sorted(goals - {start}):
            path = []
            while goal != start:
                path.append(came[goal])
                goal = came[goal][0]
            needed += [step for step in reversed(path) if step not in needed]
        return needed

    def _columns(self, table: str, dimensions: Sequence[str]) -> dict[str, Column]:
        return {d: F.col(self.fields[d][1]) for d in dimensions if self.fields[d][0] == table}

    def _branch(self, step: tuple[str, str, str, str], steps: list, dimensions: Sequence[str]) -> DataFrame:
        """Distinct pairs of the key by which a branch hangs on and the dimensions of the branch's tables."""
        _, _, table, key = step
        onward = [s for s in steps if s[0] == table]
        own = self._columns(table, dimensions)
        rows = self.tables[table].select(F.col(key).alias("__key"), *(F.col(s[1]).alias(f"__to_{s[2]}") for s in onward), *(c.alias(d) for d, c in own.items()))
        for s in onward:
            rows = self._hung(rows, f"__to_{s[2]}", self._branch(s, steps, dimensions))
        return rows.distinct()

    @staticmethod
    def _hung(rows: DataFrame, key: str, branch: DataFrame) -> DataFrame:
        """Left join of a branch; rows without a partner have nulls for its dimensions."""
        other = branch.withColumnRenamed("__key", "__other")
        return rows.join(other, F.col(key) == F.col("__other"), "left").drop(key, "__other")

    def _one(self, dimensions: Sequence[str], measures: dict[str, Measure], table: str) -> DataFrame:
        """Measures of one table by dimensions of any.

        The table is aggregated by its own dimensions and the keys it is joined by before
        the join, so its rows are never repeated: what meets them is each value of the
        other tables' dimensions once per key.
        """
        steps = self._steps(table, {self.fields[d][0] for d in dimensions})
        first = [s for s in steps if s[0] == table]
        keys = {f"__to_{s[2]}": F.col(s[1]) for s in first}
        own = self._columns(table, dimensions)
        parts: dict[str, Column] = {}
        for name, m in measures.items():
            value = F.lit(1) if m.field is None else F.col(self.fields[m.field][1])
            if m.how == "avg":
                parts |= {f"__{name}_sum": F.sum(value), f"__{name}_n": F.count(value)}
            else:
                parts[f"__{name}"] = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[m.how](value)
        grouped = self.tables[table].groupBy(*(c.alias(n) for n, c in {**keys, **own}.items())).agg(*(c.alias(n) for n, c in parts.items()))
        for s in first:
            grouped = self._hung(grouped, f"__to_{s[2]}", self._branch(s, steps, dimensions))
        merged = []
        for name, m in measures.items():
            if m.how == "avg":
                merged.append(mean(F.sum(f"__{name}_sum"), F.sum(f"__{name}_n")).alias(name))
            else:
                merged.append(_SUMMED[m.how](f"__{name}").alias(name))
        return grouped.groupBy(*dimensions).agg(*merged)

    def combinations(self, dimensions: Sequence[str]) -> DataFrame:
        """Distinct values of the dimensions that occur together, seen from the first one's table."""
        table = self.fields[dimensions[0]][0]
        return self._one(dimensions, {"__rows": Measure("count", table=table)}, table).select(*dimensions)

    def _home(self, name: str, measure: Measure) -> str:
        if measure.table:
            return measure.table
        if measure.field is None:
            raise ValueError(f"measure {name} names neither a field nor a table")
        return self.fields[measure.field][0]

    def _fixed(self, dimensions: Sequence[str], name: str, measure: Measure) -> DataFrame:
        """A measure taken at its own dimensions, added up by those of the view."""
        home = self._home(name, measure)
        values = self._one(measure.fixed, {name: Measure(measure.how, measure.field, measure.table)}, home)
        further = [d for d in dimensions if d not in measure.fixed]
        if further:
            # Each value once for every combination the view makes of it.
            seen = self._one([*measure.fixed, *further], {"__rows": Measure("count", table=home)}, home).drop("__rows")
            values = _side_by_side(seen, values, measure.fixed, "left")
        then = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg}[measure.then]
        return values.groupBy(*dimensions).agg(then(name).alias(name))

    def view(self, dimensions: Sequence[str], measures: dict[str, Measure]) -> DataFrame:
        """One row per combination of the dimensions with its measures.

        Tables that no field needs, directly or to relate others, are not read. Measures
        of different tables are aggregated apart and put side by side, null dimensions
        included; rows without a partner in a dimension's table count under null.
        """
        dimensions = list(dimensions)
        apart: list[DataFrame] = []
        homes: dict[str, dict[str, Measure]] = {}
        for name, measure in measures.items():
            if measure.fixed is not None:
                apart.append(self._fixed(dimensions, name, measure))
            else:
                homes.setdefault(self._home(name, measure), {})[name] = measure
        apart = [self._one(dimensions, own, table) for table, own in homes.items()] + apart
        out = apart[0]
        for other in apart[1:]:
            out = _side_by_side(out, other, dimensions, "full_outer")
        return out.select(*dimensions, *measures)


def _side_by_side(left: DataFrame, right: DataFrame, dimensions: Sequence[str], how: str) -> DataFrame:
    """Join on equal dimensions, where null equals null."""
    if not dimensions:
        return left.crossJoin(right)  # one row each
    renamed = right.withColumnsRenamed({d: f"__{d}" for d in dimensions})
    same = F.lit(True)
    for d in dimensions:
        same = same & F.col(d).eqNullSafe(F.col(f"__{d}"))
    joined = left.join(renamed, same, how)
    values = [c for c in left.columns if c not in dimensions] + [c for c in right.columns if c not in dimensions]
    if how == "left":
        return joined.select(*dimensions, *values)
    return joined.select(*(F.coalesce(F.col(d), F.col(f"__{d}")).alias(d) for d in dimensions), *values)
