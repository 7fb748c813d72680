"""Row numbers, neighbours and running sums over a global order.

A window over a whole table, or over a key that holds a third of its rows, ends
in one task.  Here the rows are range-partitioned on ``keys + order`` instead,
so that a hot key spreads over as many partitions as its size needs.  What then
crosses partition borders is one small row per partition (or per key and
partition), never the data.

``order`` must be a total order within a key (end it with an id column).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tableloom.plans.scratch import materialize

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits
_LOCAL_MASK = (1 << _LOCAL_BITS) - 1


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until the table has no column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


class OrderedRows:
    """A table laid out once in a global order.

    ``rows`` holds the input columns plus ``_mid`` (partition and position),
    ``_part`` (partition) and ``_g`` (global position, from 0).
    """

    def __init__(self, df: DataFrame, keys: Sequence[str] = (), order: Sequence[Column | str] = ()):
        self.keys = list(keys)
        self.columns = df.columns
        sort = [F.col(k) for k in self.keys] + [F.col(o) if isinstance(o, str) else o for o in order]
        laid = (
            df.repartitionByRange(*sort)
            .sortWithinPartitions(*sort)
            .withColumn("_mid", F.monotonically_increasing_id())
        )
        # written down, because range bounds are sampled anew by every plan
        laid = materialize(laid).withColumn("_part", F.shiftright("_mid", _LOCAL_BITS))
        sizes = sorted(
            (r["_part"], r["n"])
            for r in laid.groupBy("_part").agg(F.count("*").alias("n")).collect()
        )  # one row per partition
        self.total = sum(n for _, n in sizes)
        offsets, before, previous = [], 0, -1
        for part, n in sizes:
            offsets.append((part, before, previous))
            before, previous = before + n, part
        self._parts = df.sparkSession.createDataFrame(
            offsets, "_part bigint, _before bigint, _previous bigint"
        )
        # one row per partition: a bound that does not grow with the rows
        self.rows = (
            laid.join(F.broadcast(self._parts.select("_part", "_before")), "_part")
            .withColumn("_g", F.col("_before") + F.col("_mid").bitwiseAND(F.lit(_LOCAL_MASK)))
            .drop("_before")
        )

    def numbered(self, name: str = "rn") -> DataFrame:
        """The rows with their 1-based position inside the key."""
        if not self.keys:
            return self.rows.withColumn(name, F.col("_g") + 1).select(*self.columns, name)
        local = self.rows.withColumn("_l", F.row_number().over(self._inside()).cast("bigint"))
        return self._continued(local, name).select(*self.columns, name)

    def _inside(self) -> Window:
        """The rows of a key inside one partition, in order."""
        return Window.partitionBy("_part", *self.keys).orderBy("_mid")

    def _continued(self, local: DataFrame, name: str) -> DataFrame:
        """``name``: the running value ``_l`` of a key inside its partition, continued over partitions.

        Only the first key of a partition can have started earlier.  What it brings is the last
        running value of the partition before, and so on back to where the key starts: one row
        per partition, which every row meets by a broadcast.
        """
        key = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)], F.lit(0).alias("all"))
        ends = local.groupBy("_part").agg(
            F.min_by(key, "_mid").alias("_first"), F.max_by(key, "_mid").alias("_last"), F.max_by("_l", "_mid").alias("_tail")
        )
        by = Window.orderBy("_part")
        ends = ends.withColumn("_goes_on", F.coalesce(F.lag("_last").over(by).eqNullSafe(F.col("_first")), F.lit(False)))
        # the last key of a partition starts in it, unless the partition holds nothing else and goes on
        starts = F.when(~(F.col("_goes_on") & F.col("_first").eqNullSafe(F.col("_last"))), F.col("_part"))
        ends = ends.withColumn("_run", F.last(starts, ignorenulls=True).over(by))
        ends = ends.withColumn("_sum", F.sum("_tail").over(Window.partitionBy("_run").orderBy("_part")))
        carry = ends.withColumn("_carry", F.lag("_sum").over(by)).where("_goes_on").select("_part", "_first", "_carry")
        joined = local.join(F.broadcast(carry), "_part", "left")
        brought = F.when(F.col("_first").eqNullSafe(key), F.col("_carry"))
        return joined.withColumn(name, F.col("_l") + F.coalesce(brought, F.lit(0)))

    def with_previous(self, **named: str) -> DataFrame:
        """Add columns of the previous row of the same key (``new_name=column``)."""
        return self._neighbour(named, forward=False)

    def with_next(self, **named: str) -> DataFrame:
        """Add columns of the next row of the same key (``new_name=column``)."""
        return self._neighbour(named, forward=True)

    def _neighbour(self, named: dict[str, str], forward: bool) -> DataFrame:
        payload = F.struct(
            *[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)],
            *[F.col(c).alias(f"v{i}") for i, c in enumerate(named.values())],
            F.lit(1).alias("here"),
        )
        rows = self.rows.withColumn("_pay", payload)
        within = Window.partitionBy("_part").orderBy("_mid")
        if forward:
            rows = rows.withColumn("_nb", F.lead("_pay").over(within))
            edge = rows.groupBy("_part").agg(F.min_by("_pay", "_mid").alias("_edge"))
            edge = self._parts.alias("p").join(
                edge.alias("e"), F.col("p._part") == F.col("e._part")
            ).select(F.col("p._previous").alias("_part"), "_edge")
        else:
            rows = rows.withColumn("_nb", F.lag("_pay").over(within))
            edge = rows.groupBy("_part").agg(F.max_by("_pay", "_mid").alias("_edge"))
            edge = self._parts.alias("p").join(
                edge.alias("e"), F.col("p._previous") == F.col("e._part")
            ).select(F.col("p._part").alias("_part"), "_edge")
        # the edge table has one row per partition
        rows = rows.join(F.broadcast(edge), "_part", "left").withColumn(
            "_nb", F.coalesce("_nb", "_edge")
        )
        inside = F.col("_nb").isNotNull()
        for i, key in enumerate(self.keys):
            inside = inside & F.col(f"_nb.k{i}").eqNullSafe(F.col(key))
        out = [F.when(inside, F.col(f"_nb.v{i}")).alias(n) for i, n in enumerate(named)]
        return rows.select(*self.columns, "_mid", "_part", "_g", *out)

    def running_sum(self, value: Column | str, name: str, rows: DataFrame | None = None) -> DataFrame:
        """Add the sum of ``value`` over the key up to and including the row.

        ``rows`` may be a result of the neighbour methods of the same object.
        """
        rows = self.rows if rows is None else rows
        value = F.col(value) if isinstance(value, str) else value
        columns = [c for c in rows.columns if c not in ("_mid", "_part", "_g")]
        rows = rows.withColumn("_x", value)
        local = rows.withColumn("_l", F.sum("_x").over(self._inside().rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        return self._continued(local, name).select(*columns, name, "_mid", "_part", "_g")

    def filled(self, value: str, name: str) -> DataFrame:
        """Add the latest non-NULL ``value`` of the key up to and including the row."""
        held = F.when(
            F.col(value).isNotNull(),
            F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(self.keys)], F.col(value).alias("v")),
        )
        rows = self.rows.withColumn("_held", held)
        so_far = Window.partitionBy("_part").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
        local = rows.withColumn("_fill", F.last("_held", ignorenulls=True).over(so_far))
        # one row per partition
        ends = rows.where("_held is not null").groupBy("_part").agg(F.max_by("_held", "_mid").alias("_end"))
        before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        carried = (
            self._parts.select("_part").join(ends, "_part", "left")
            .withColumn("_carry", F.last("_end", ignorenulls=True).over(before))
            .select("_part", "_carry")
        )
        filled = local.join(carried, "_part").withColumn("_fill", F.coalesce("_fill", "_carry"))
        inside = F.col("_fill").isNotNull()
        for i, key in enumerate(self.keys):
            inside = inside & F.col(f"_fill.k{i}").eqNullSafe(F.col(key))
        return filled.select(*self.columns, "_mid", "_part", "_g", F.when(inside, F.col("_fill.v")).alias(name))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], name: str = "rn") -> DataFrame:
    """Shorthand for ``OrderedRows(df, keys, order).numbered(name)``."""
    return OrderedRows(df, keys, order).numbered(name)


def public(df: DataFrame) -> DataFrame:
    """Drop the layout columns."""
    return df.drop("_mid", "_part", "_g")
