"""Tensor algebra on coordinate tables.

A tensor is a table ``(i0, ..., iN-1, value)`` with zero-based indices, next to
its shape.  Factor matrices are tables ``(row, f array<double>)``, one array of
rank length per row.  Decompositions keep tensor and factors distributed; only
matrices whose side is a rank, a product of ranks or a sample size reach the
driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import product
from math import prod

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableloom.functions.scalars import floor_divide
from tableloom.functions.draws import draw_normal, draw_unit
from tableloom.plans.scratch import discard, materialize
from tableloom.plans.skew import join_small, skew_join

# Largest matrix side that may be solved on the driver.
SOLVE_LIMIT = 4096
# above so many rank combinations arrays are summed instead of single expressions; numbers a task holds for that
WIDE = 200
BUFFER = 1 << 22
# Most numbers of a matrix that may be broadcast.
CARRY_LIMIT = 4_000_000


def index(n: int) -> str:
    return f"i{n}"


@dataclass
class Tensor:
    cells: DataFrame
    shape: tuple[int, ...]

    @property
    def order(self) -> int:
        return len(self.shape)

    @property
    def indices(self) -> list[str]:
        return [index(n) for n in range(self.order)]

    def others(self, mode: int) -> list[str]:
        return [c for n, c in enumerate(self.indices) if n != mode]


def _strides(shape: Sequence[int]) -> list[int]:
    return [prod(shape[n + 1:]) for n in range(len(shape))]


def _flat(names: Sequence[str], shape: Sequence[int]) -> Column:
    terms = [F.col(c).cast("bigint") * s for c, s in zip(names, _strides(shape))]
    return reduce(lambda a, b: a + b, terms)


def _unflat(flat: Column, shape: Sequence[int]) -> list[Column]:
    return [
        F.pmod(floor_divide(flat, s), F.lit(size)) for size, s in zip(shape, _strides(shape))
    ]


def _number(v: float) -> str:
    """A double literal of SQL."""
    return f"{float(v)!r}D" if np.isfinite(v) else f"double('{float(v)!r}')"


def _product(n_and_r: Sequence[tuple[int, int]], *more: str) -> str:
    """SQL for the product of factor entries ``f<n>[r]``; long sums are cheaper to build as text."""
    return " * ".join([*more, *[f"f{n}[{r}]" for n, r in n_and_r]])


# ---- creation and layout ---------------------------------------------------


def from_flat(df: DataFrame, flat: Column, value: Column, shape: Sequence[int]) -> Tensor:
    """Row-order positions and values to a tensor."""
    cells = df.select(flat.cast("bigint").alias("_at"), value.alias("value"))
    columns = [c.alias(index(n)) for n, c in enumerate(_unflat(F.col("_at"), shape))]
    return Tensor(cells.select(*columns, "value"), tuple(shape))


def dense_cells(spark: SparkSession, shape: Sequence[int]) -> DataFrame:
    """Every index of a shape, one row each."""
    flat = spark.range(prod(shape))
    return flat.select(*[c.alias(index(n)) for n, c in enumerate(_unflat(F.col("id"), shape))])


def fixed(x: Tensor, at: dict[int, int]) -> Tensor:
    """Fix some indices: a slice, a fiber or one cell; the other indices move up."""
    cells = x.cells
    for n, where in at.items():
        cells = cells.where(F.col(index(n)) == where)
    kept = [n for n in range(x.order) if n not in at]
    return Tensor(
        cells.select(*[F.col(index(n)).alias(index(k)) for k, n in enumerate(kept)], "value"),
        tuple(x.shape[n] for n in kept),
    )


def unfold(x: Tensor, mode: int) -> DataFrame:
    """``(row, col, value)``: rows by the mode, columns by the other indices in row order."""
    rest = [s for n, s in enumerate(x.shape) if n != mode]
    return x.cells.select(
        F.col(index(mode)).alias("row"), _flat(x.others(mode), rest).alias("col"), "value"
    )


def fold(matrix: DataFrame, mode: int, shape: Sequence[int]) -> Tensor:
    """Inverse of :func:`unfold`."""
    rest = [n for n in range(len(shape)) if n != mode]
    columns = dict(zip(rest, _unflat(F.col("col"), [shape[n] for n in rest])))
    columns[mode] = F.col("row")
    return Tensor(
        matrix.select(*[columns[n].alias(index(n)) for n in range(len(shape))], "value"), tuple(shape)
    )


def reshape(x: Tensor, shape: Sequence[int]) -> Tensor:
    if prod(shape) != prod(x.shape):
        raise ValueError(f"{x.shape} has no shape {tuple(shape)}")
    return from_flat(x.cells, _flat(x.indices, x.shape), F.col("value"), shape)


def vectorise(x: Tensor, keep: int = 0) -> Tensor:
    """One index for all but the first ``keep`` ones."""
    return reshape(x, (*x.shape[:keep], prod(x.shape[keep:])))


# ---- products --------------------------------------------------------------


def as_long(factor: DataFrame) -> DataFrame:
    """``(row, r, value)`` of a factor table."""
    return factor.select("row", F.posexplode("f").alias("r", "value"))


def mode_dot(x: Tensor, matrix: DataFrame, mode: int, rows: int) -> Tensor:
    """n-mode product with ``matrix (d, i, value)`` of ``rows`` rows.

    Up to ``SOLVE_LIMIT`` rows a column of the matrix meets its cells as one
    array, so the join itself adds no rows; a taller matrix is joined row by row
    with the hot indices spread.  Products are summed on the map side first.
    """
    left = x.cells.withColumn("i", F.col(index(mode)).cast("bigint"))
    entries = matrix.select(F.col("i").cast("bigint"), F.struct(F.col("d"), F.col("value").alias("m")).alias("_e"))
    if rows <= SOLVE_LIMIT:
        columns = entries.groupBy("i").agg(F.collect_list("_e").alias("_col"))
        met = join_small(left, columns, ["i"], max_rows=CARRY_LIMIT // rows)
        spread = met.select(*x.others(mode), "value", F.explode("_col").alias("_e"))
    else:
        spread = skew_join(left, entries, ["i"])
    cells = spread.groupBy(*x.others(mode), F.col("_e.d").cast("bigint").alias(index(mode))).agg(
        F.sum(F.col("value") * F.col("_e.m")).alias("value")
    )
    shape = tuple(rows if n == mode else s for n, s in enumerate(x.shape))
    return Tensor(cells.select(*x.indices, "value"), shape)


def mode_dot_vector(x: Tensor, vector: DataFrame, mode: int) -> Tensor:
    """n-mode product with ``vector (i, value)``; the mode disappears."""
    met = join_small(
        x.cells.withColumn("i", F.col(index(mode)).cast("bigint")),
        vector.select(F.col("i").cast("bigint"), F.col("value").alias("_v")), ["i"],
    )
    cells = met.groupBy(*x.others(mode)).agg(F.sum(F.col("value") * F.col("_v")).alias("value"))
    kept = [n for n in range(x.order) if n != mode]
    return Tensor(
        cells.select(*[F.col(index(n)).alias(index(k)) for k, n in enumerate(kept)], "value"),
        tuple(x.shape[n] for n in kept),
    )


def inner_per_sample(samples: Tensor, weights: Tensor) -> DataFrame:
    """``(i0, value)``: the inner product of every sample (first index) with the weights."""
    names = [index(n) for n in range(1, samples.order)]
    w = weights.cells.select(
        *[F.col(index(n)).alias(index(n + 1)) for n in range(weights.order)], F.col("value").alias("_w")
    )
    return join_small(samples.cells, w, names).groupBy("i0").agg(F.sum(F.col("value") * F.col("_w")).alias("value"))


def norm(x: Tensor) -> DataFrame:
    return x.cells.agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))


def difference(a: Tensor, b: Tensor) -> Tensor:
    """Cell-wise ``a - b``; absent cells are zero."""
    both = a.cells.unionByName(b.cells.withColumn("value", -F.col("value")))
    return Tensor(both.groupBy(*a.indices).agg(F.sum("value").alias("value")), a.shape)


def relative_error(reconstructed: Tensor, original: Tensor) -> DataFrame:
    """One row: ``difference``, ``norm`` and ``error = difference / norm``."""
    both = reconstructed.cells.select(*original.indices, F.col("value").alias("_r"), F.lit(0.0).alias("_o")).unionByName(
        original.cells.select(*original.indices, F.lit(0.0).alias("_r"), F.col("value").alias("_o"))
    )
    cells = both.groupBy(*original.indices).agg(F.sum("_r").alias("_r"), F.sum("_o").alias("_o"))
    gap = F.col("_r") - F.col("_o")
    return cells.agg(
        F.sqrt(F.sum(gap * gap)).alias("difference"), F.sqrt(F.sum(F.col("_o") * F.col("_o"))).alias("norm")
    ).withColumn("error", F.col("difference") / F.col("norm"))


def mean_over(x: Tensor, mode: int) -> Tensor:
    """Mean over an axis, which disappears; absent cells count as zero."""
    cells = x.cells.groupBy(*x.others(mode)).agg((F.sum("value") / x.shape[mode]).alias("value"))
    kept = [n for n in range(x.order) if n != mode]
    return Tensor(
        cells.select(*[F.col(index(n)).alias(index(k)) for k, n in enumerate(kept)], "value"),
        tuple(x.shape[n] for n in kept),
    )


# ---- factors ---------------------------------------------------------------


def random_factor(spark: SparkSession, rows: int, rank: int, seed: int, mode: int) -> DataFrame:
    """Uniform draws on (mode, row, r)."""
    f = F.transform(
        F.sequence(F.lit(0), F.lit(rank - 1)), lambda r: draw_unit(seed, "factor", mode, F.col("row"), r)
    )
    return spark.range(rows).select(F.col("id").alias("row")).select("row", f.alias("f"))


def random_cells(df: DataFrame, names: Sequence[str], seed: int, normal: bool = False) -> DataFrame:
    """Add a random ``value`` to every row of an index table."""
    fn = draw_normal if normal else draw_unit
    return df.withColumn("value", fn(seed, "cell", *[F.col(c) for c in names]))


def _sum_table(df: DataFrame, columns: Sequence[str], fn, size: int) -> DataFrame:
    """``(k, v)``: the sum of ``fn(arrays) -> vector of size`` over all batches.

    Every partition sends one vector; they are added by position.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size)
        for batch in batches:
            if len(batch):
                total += fn(*[_stack(batch[c]) for c in columns])
        yield pd.DataFrame({"v": [total]})

    parts = df.select(*columns).mapInPandas(run, "v array<double>")
    return parts.select(F.posexplode("v").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v"))


def _partial_sums(df: DataFrame, columns: Sequence[str], fn, size: int) -> np.ndarray:
    """The same as an array on the driver."""
    out = np.zeros(size)
    for row in _sum_table(df, columns, fn, size).collect():
        out[row["k"]] = row["v"]
    return out


def _stack(values: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=float) for v in values]) if values.dtype == object else values.to_numpy(float)


def gram(factor: DataFrame, size: int, column: str = "f") -> np.ndarray:
    """``f^T f`` of an array column."""
    if size > SOLVE_LIMIT:
        raise ValueError(f"a {size} x {size} matrix is too large for the driver")
    if size <= 6:
        upper = [(i, j) for i in range(size) for j in range(i, size)]
        row = factor.agg(*[F.expr(f"sum({column}[{i}] * {column}[{j}])").alias(f"g{i}_{j}") for i, j in upper]).first()
        out = np.zeros((size, size))
        for i, j in upper:
            out[i, j] = out[j, i] = row[f"g{i}_{j}"] or 0.0
        return out
    return _partial_sums(factor, [column], lambda f: (f.T @ f).ravel(), size * size).reshape(size, size)


def times(factor: DataFrame, matrix: np.ndarray, column: str = "f") -> DataFrame:
    """Multiply every array by a small matrix; tiny ones as a plain expression."""
    if matrix.size <= 256:
        sums = [" + ".join(f"{column}[{i}] * {_number(v)}" for i, v in enumerate(side)) for side in matrix.T]
        return factor.withColumn(column, F.expr(f"array({', '.join(sums)})"))

    @F.pandas_udf("array<double>")
    def multiply(f: pd.Series) -> pd.Series:
        return pd.Series(list(_stack(f) @ matrix))

    return factor.withColumn(column, multiply(F.col(column)))


def _with_factors(cells: DataFrame, factors: dict[int, DataFrame], numbers: dict[int, int]) -> DataFrame:
    """Add ``f<n>``, the factor row of index n, to every cell; cells without one drop out.

    ``numbers`` says how many numbers a factor holds; a small one is broadcast.
    """
    for n, factor in factors.items():
        side = factor.select(F.col("row").cast("bigint").alias(index(n)), F.col("f").alias(f"f{n}"))
        cells = cells.join(F.broadcast(side) if numbers[n] <= CARRY_LIMIT else side, index(n))
    return cells


def kruskal_at(cells: DataFrame, factors: Sequence[DataFrame], rank: int, shape: Sequence[int]) -> DataFrame:
    """Value of the CP form at the given cells: work grows with the cells asked for."""
    met = _with_factors(cells, dict(enumerate(factors)), {n: s * rank for n, s in enumerate(shape)})
    terms = " + ".join(_product([(n, r) for n in range(len(factors))]) for r in range(rank))
    return met.withColumn("value", F.expr(terms)).drop(*[f"f{n}" for n in range(len(factors))])


def kruskal_to_tensor(factors: Sequence[DataFrame], rank: int, shape: Sequence[int]) -> Tensor:
    """The full tensor of a CP form."""
    cells = dense_cells(factors[0].sparkSession, shape)
    return Tensor(kruskal_at(cells, factors, rank, shape), tuple(shape))


def small_array(x: Tensor) -> np.ndarray:
    """A rank-sized tensor as an array on the driver."""
    if prod(x.shape) > CARRY_LIMIT:
        raise ValueError(f"a tensor of shape {x.shape} is too large for the driver")
    out = np.zeros(x.shape)
    for row in x.cells.collect():
        out[tuple(int(row[c]) for c in x.indices)] = row["value"]
    return out


def tucker_at(cells: DataFrame, core: Tensor, factors: Sequence[DataFrame], shape: Sequence[int]) -> DataFrame:
    """Value of the Tucker form at the given cells; the core has the size of the ranks.

    A small core is written out as an expression, a larger one is contracted in
    Arrow batches.
    """
    values = small_array(core)
    names = [f"f{n}" for n in range(core.order)]

    @F.pandas_udf("double")
    def contract(*rows: pd.Series) -> pd.Series:
        out = np.tensordot(_stack(rows[0]), values, axes=(1, 0))
        for f in rows[1:]:
            out = np.einsum("na...,na->n...", out, _stack(f))
        return pd.Series(out)

    numbers = {n: s * r for n, (s, r) in enumerate(zip(shape, core.shape))}
    met = _with_factors(cells, dict(enumerate(factors)), numbers)
    if values.size <= 64:
        terms = " + ".join(_product(list(enumerate(at)), _number(v)) for at, v in np.ndenumerate(values))
        return met.withColumn("value", F.expr(terms)).drop(*names)
    return met.withColumn("value", contract(*names)).drop(*names)


def tucker_to_tensor(core: Tensor, factors: Sequence[DataFrame], shape: Sequence[int]) -> Tensor:
    """The full tensor of a Tucker form."""
    cells = dense_cells(factors[0].sparkSession, shape)
    return Tensor(tucker_at(cells, core, factors, shape), tuple(shape))


def kruskal_square(factors: Sequence[DataFrame], rank: int) -> float:
    """Squared norm of a CP form, from the Gram matrices of its factors."""
    return float(np.sum(reduce(lambda a, b: a * b, [gram(f, rank) for f in factors])))


def tucker_square(core: Tensor, factors: Sequence[DataFrame]) -> float:
    """Squared norm of a Tucker form, from its core and the Gram matrices of its factors."""
    values = turned = small_array(core)
    for n, factor in enumerate(factors):
        turned = np.moveaxis(np.tensordot(gram(factor, core.shape[n]), turned, axes=(1, n)), 0, n)
    return float(np.sum(values * turned))


def factored_error(at_cells: DataFrame, square: float) -> DataFrame:
    """One row as :func:`relative_error`, for a form of squared norm ``square``.

    ``at_cells`` has the stored cells with ``value`` and ``model``, the form's value there: the
    squared difference is |model|^2 - 2 <model, x> + |x|^2, so only stored cells are read.
    """
    x = F.col("value")
    sums = at_cells.agg(F.sum(x * F.col("model")).alias("inner"), F.sum(x * x).alias("size"))
    gap = F.greatest(F.lit(square) - 2 * F.col("inner") + F.col("size"), F.lit(0.0))
    return sums.select(F.sqrt(gap).alias("difference"), F.sqrt("size").alias("norm"), (F.sqrt(gap) / F.sqrt("size")).alias("error"))


def _modelled(x: Tensor, at) -> DataFrame:
    """The stored cells of ``x`` with the value that ``at(cells)`` gives them as ``model``."""
    cells = x.cells.withColumnRenamed("value", "_x")
    return at(cells).withColumnsRenamed({"value": "model", "_x": "value"})


def kruskal_error(x: Tensor, factors: Sequence[DataFrame], rank: int) -> DataFrame:
    """``difference``, ``norm`` and ``error`` of a CP form, without its tensor."""
    at = lambda cells: kruskal_at(cells, factors, rank, x.shape)
    return factored_error(_modelled(x, at), kruskal_square(factors, rank))


def tucker_error(x: Tensor, core: Tensor, factors: Sequence[DataFrame]) -> DataFrame:
    """``difference``, ``norm`` and ``error`` of a Tucker form, without its tensor."""
    at = lambda cells: tucker_at(cells, core, factors, x.shape)
    return factored_error(_modelled(x, at), tucker_square(core, factors))


def mttkrp(x: Tensor, factors: Sequence[DataFrame], mode: int, rank: int) -> DataFrame:
    """Matricised tensor times Khatri-Rao product: ``(row, f)`` with one sum per rank."""
    rest = {n: f for n, f in enumerate(factors) if n != mode}
    met = _with_factors(x.cells, rest, {n: s * rank for n, s in enumerate(x.shape)})
    sums = [F.expr(f"sum({_product([(n, r) for n in rest], 'value')}) AS s{r}") for r in range(rank)]
    rows = met.groupBy(F.col(index(mode)).alias("row")).agg(*sums)
    return rows.select("row", F.expr(f"array({', '.join(f's{r}' for r in range(rank))}) AS f"))


# ---- CP --------------------------------------------------------------------


@dataclass
class Decomposition:
    factors: list[DataFrame]
    core: Tensor | None
    errors: list[float]


def _stretch(x: Tensor, stacked: Sequence[DataFrame], rank: int, size: float) -> tuple[float, float]:
    """The step along the change of the factors that fits best, and the relative error there.

    A row of ``stacked`` holds a factor's row and its change.  Along the step the inner product with
    the tensor is a polynomial of as many degrees as modes, found in one pass; the squared norm, of
    twice as many, follows from Gram matrices.
    """
    order = x.order
    met = _with_factors(x.cells, dict(enumerate(stacked)), {n: 2 * s * rank for n, s in enumerate(x.shape)})
    sums = []
    for degree in range(order + 1):
        chosen = [c for c in product((0, 1), repeat=order) if sum(c) == degree]
        terms = " + ".join(_product([(n, r + rank * c[n]) for n in range(order)]) for c in chosen for r in range(rank))
        sums.append(F.expr(f"sum(value * ({terms})) AS c{degree}"))
    inner = np.polynomial.Polynomial(list(met.agg(*sums).first()))
    grams = [gram(table, 2 * rank) for table in stacked]
    square = np.polynomial.Polynomial([0.0])
    for i, j in np.ndindex(rank, rank):
        term = np.polynomial.Polynomial([1.0])
        for g in grams:
            term = term * np.polynomial.Polynomial([g[i, j], g[i, rank + j] + g[rank + i, j], g[rank + i, rank + j]])
        square = square + term
    gap = size - 2 * inner + square
    steps = [float(r.real) for r in gap.deriv().roots() if abs(r.imag) < 1e-9 and r.real > 0]
    best = min([0.0, *steps], key=gap)
    return best, float(np.sqrt(max(gap(best), 0.0) / size))


def parafac(x: Tensor, rank: int, sweeps: int = 100, tol: float = 1e-8, seed: int = 64) -> Decomposition:
    """CP by alternating least squares; ``errors`` holds the relative error per sweep.

    The error comes from the Gram matrices, without building the tensor.  Every second sweep is
    followed by a step along the change it made, as far as fits best, so that long slow stretches
    in one direction take few sweeps.
    """
    spark = x.cells.sparkSession
    factors = [random_factor(spark, s, rank, seed, n) for n, s in enumerate(x.shape)]
    grams = [gram(f, rank) for f in factors]
    size = x.cells.agg(F.sum(F.col("value") * F.col("value"))).first()[0]
    errors: list[float] = []
    targets: list[DataFrame | None] = [None] * x.order
    for sweep in range(sweeps):
        before, kept = factors, list(targets)
        factors = list(factors)
        for mode in range(x.order):
            target = materialize(mttkrp(x, factors, mode, rank))
            targets[mode] = target
            others = reduce(lambda a, b: a * b, [g for n, g in enumerate(grams) if n != mode])
            solve = np.linalg.pinv(others)
            inner = gram(target, rank)
            # factor = target @ solve, so its sums follow from those of the target
            factors[mode] = times(target, solve)
            grams[mode] = solve.T @ inner @ solve
            crossing = float(np.sum(inner * solve))
        model = float(np.sum(reduce(lambda a, b: a * b, grams)))
        errors.append(float(np.sqrt(max(size - 2 * crossing + model, 0.0) / size)))
        done = len(errors) > 1 and abs(errors[-2] - errors[-1]) < tol
        if not done and sweep % 2:
            changed = F.concat("f", F.zip_with("f", "_b", lambda now, old: now - old))
            stacked = [
                materialize(now.join(old.withColumnRenamed("f", "_b"), "row").select("row", changed.alias("f")))
                for now, old in zip(factors, before)
            ]
            step, error = _stretch(x, stacked, rank, size)
            if step > 0 and error < errors[-1]:
                ahead = np.concatenate([np.eye(rank), step * np.eye(rank)])
                factors = [materialize(times(f, ahead)) for f in stacked]
                grams = [gram(f, rank) for f in factors]
                errors[-1] = error
                kept, targets = [*kept, *targets], list(factors)
            for table in stacked:
                discard(table)
        # the factors before are read no more
        for table in kept:
            discard(table)
        if done:
            break
    return Decomposition(factors, None, errors)


# ---- Tucker ----------------------------------------------------------------


def _projected(x: Tensor, factors: Sequence[DataFrame], ranks: Sequence[int], mode: int) -> DataFrame:
    """``(row, f)``: the tensor contracted with all factors but one, unfolded by that mode."""
    rest = [n for n in range(x.order) if n != mode]
    met = _with_factors(
        x.cells, {n: factors[n] for n in rest}, {n: s * r for n, (s, r) in enumerate(zip(x.shape, ranks))}
    )
    if prod(ranks[n] for n in rest) > WIDE:
        return _projected_wide(met, rest, ranks, mode)
    combos = list(product(*[range(ranks[n]) for n in rest]))
    sums = [
        F.expr(f"sum({_product(list(zip(rest, combo)), 'value')}) AS s{k}") for k, combo in enumerate(combos)
    ]
    rows = met.groupBy(F.col(index(mode)).alias("row")).agg(*sums)
    return rows.select("row", F.expr(f"array({', '.join(f's{k}' for k in range(len(combos)))}) AS f"))


def _projected_wide(met: DataFrame, rest: Sequence[int], ranks: Sequence[int], mode: int) -> DataFrame:
    """The same for many rank combinations: arrays are summed in the tasks, and then per row."""
    side = prod(ranks[n] for n in rest)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for whole in batches:
            for start in range(0, len(whole), max(1, BUFFER // side)):
                batch = whole.iloc[start : start + max(1, BUFFER // side)]
                out = batch["value"].to_numpy(float)[:, None]
                for n in rest:
                    out = (out[:, :, None] * _stack(batch[f"f{n}"])[:, None, :]).reshape(len(batch), -1)
                row = batch["row"].to_numpy()
                order = np.argsort(row, kind="stable")
                first = np.flatnonzero(np.diff(row[order], prepend=row[order[0]] - 1))
                for r, v in zip(row[order][first], np.add.reduceat(out[order], first, axis=0)):
                    sums[r] = sums[r] + v if r in sums else v
                if len(sums) * side > BUFFER:
                    yield pd.DataFrame({"row": list(sums), "f": list(sums.values())})
                    sums = {}
        if sums:
            yield pd.DataFrame({"row": list(sums), "f": list(sums.values())})

    def whole_row(key: tuple, parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": [key[0]], "f": [_stack(parts["f"]).sum(axis=0)]})

    cells = met.select(F.col(index(mode)).cast("bigint").alias("row"), F.col("value").cast("double"), *[f"f{n}" for n in rest])
    schema = "row bigint, f array<double>"
    return cells.mapInPandas(partial, schema).groupBy("row").applyInPandas(whole_row, schema)


def _row_gram(y: DataFrame, rows: int, side: int) -> np.ndarray:
    """``Y Y^T`` of an unfolding of few rows: runs of columns meet in tasks, one small matrix each comes back."""
    width = max(1, min(side, BUFFER // rows))
    runs = F.transform(
        F.sequence(F.lit(0), F.lit((side - 1) // width)),
        lambda k: F.struct(k.alias("run"), F.slice("f", k * width + 1, F.least(F.lit(width), F.lit(side) - k * width)).alias("part")),
    )
    cut = y.select("row", F.explode(runs).alias("c")).select("row", "c.run", "c.part")

    def summed(group: pd.DataFrame) -> pd.DataFrame:
        part = _stack(group["part"])
        at = group["row"].to_numpy()
        whole = np.zeros((rows, rows))
        whole[np.ix_(at, at)] = part @ part.T
        return pd.DataFrame({"v": [whole.ravel()]})

    parts = cut.groupBy("run").applyInPandas(summed, "v array<double>")
    return _partial_sums(parts, ["v"], lambda v: v.sum(axis=0), rows * rows).reshape(rows, rows)


def _leading(y: DataFrame, rows: int, side: int, rank: int) -> tuple[DataFrame, float]:
    """The leading left singular vectors of the unfolding ``y`` as a factor, and their squared singular values' sum.

    The smaller of the Gram matrices of rows and of columns is summed in tasks and solved for.
    """
    spark = y.sparkSession
    if rows <= side:
        if rows > SOLVE_LIMIT:
            raise ValueError(f"a {rows} x {rows} matrix is too large for the driver")
        values, vectors = np.linalg.eigh(_row_gram(y, rows, side))
        top = np.argsort(values)[::-1][:rank]
        factor = np.zeros((rows, rank))
        factor[:, : len(top)] = vectors[:, top]
        table = spark.createDataFrame([(i, f.tolist()) for i, f in enumerate(factor)], "row bigint, f array<double>")
        return table, float(np.maximum(values[top], 0.0).sum())
    values, vectors = np.linalg.eigh(gram(y, side))
    top = np.argsort(values)[::-1][:rank]
    sigma = np.sqrt(np.maximum(values[top], 0.0))
    keep = sigma > 1e-12 * max(sigma.max(), 1e-300)
    inverse = np.where(keep, 1.0 / np.where(keep, sigma, 1.0), 0.0)
    padded = np.zeros((side, rank))
    padded[:, : len(top)] = vectors[:, top] * inverse
    return times(y, padded), float(np.sum(sigma[keep] ** 2))


def _core(y: DataFrame, factor: DataFrame, ranks: Sequence[int], mode: int) -> Tensor:
    """``factor^T Y`` as a table of cells; ``Y`` is unfolded by ``mode``."""
    rest = [r for n, r in enumerate(ranks) if n != mode]
    side = prod(rest)
    met = y.join(factor.withColumnRenamed("f", "u"), "row")
    sums = _sum_table(met, ["u", "f"], lambda u, f: (u.T @ f).ravel(), ranks[mode] * side)
    matrix = sums.select(floor_divide(F.col("k"), side).alias("row"), F.pmod("k", F.lit(side)).alias("col"), F.col("v").alias("value"))
    return fold(matrix, mode, ranks)


def tucker(x: Tensor, ranks: Sequence[int], sweeps: int = 50, tol: float = 1e-6, seed: int = 64) -> Decomposition:
    """Tucker by higher-order orthogonal iteration.

    The problem solved for a mode has the side of its size or of the product of
    the other ranks, whichever is smaller.  The core is a table of its own,
    summed in tasks from the last mode's unfolding.
    """
    spark = x.cells.sparkSession
    factors = [random_factor(spark, s, r, seed, n) for n, (s, r) in enumerate(zip(x.shape, ranks))]
    size = x.cells.agg(F.sum(F.col("value") * F.col("value"))).first()[0]
    errors: list[float] = []
    projections: list[DataFrame | None] = [None] * x.order
    for _ in range(sweeps):
        for mode in range(x.order):
            side = prod(r for n, r in enumerate(ranks) if n != mode)
            y = materialize(_projected(x, factors, ranks, mode))
            discard(projections[mode])
            projections[mode] = y
            factors[mode], held = _leading(y, x.shape[mode], side, ranks[mode])
        errors.append(float(np.sqrt(max(size - held, 0.0) / size)))
        if len(errors) > 1 and abs(errors[-2] - errors[-1]) < tol:
            break
    last = x.order - 1
    core = _core(projections[last], factors[last], list(ranks), last)
    return Decomposition(factors, Tensor(materialize(core.cells), tuple(ranks)), errors)


def small_tensor(spark: SparkSession, values: np.ndarray) -> Tensor:
    """A table for a rank-sized array."""
    rows = [(*map(int, at), float(v)) for at, v in np.ndenumerate(values)]
    schema = ", ".join(f"{index(n)} bigint" for n in range(values.ndim)) + ", value double"
    return Tensor(spark.createDataFrame(rows, schema), values.shape)


# ---- sizes -----------------------------------------------------------------


def shape_table(x: Tensor, ranks: Sequence[int]) -> DataFrame:
    """``(mode, size, rank)``; sizes are read from the cells."""
    widest = x.cells.agg(*[(F.max(c) + 1).alias(c) for c in x.indices])
    rows = F.array(*[
        F.struct(F.lit(n).alias("mode"), F.col(c).cast("bigint").alias("size"), F.lit(int(r)).cast("bigint").alias("rank"))
        for n, (c, r) in enumerate(zip(x.indices, ranks))
    ])
    return widest.select(F.explode(rows).alias("m")).select("m.*")


def parameter_counts(shapes: DataFrame) -> DataFrame:
    """One row: ``original``, ``factors`` (sum of rank * size), ``core`` (product of ranks)."""
    return shapes.agg(
        F.product("size").cast("bigint").alias("original"), F.sum(F.col("rank") * F.col("size")).alias("factors"),
        F.product("rank").cast("bigint").alias("core"),
    )


def space_savings(original: Column, compressed: Column) -> Column:
    """Percent saved, cut towards zero."""
    return (100 * (1 - compressed / original)).cast("int")


def penalised_objective(error: DataFrame, factors: Sequence[DataFrame], core: Tensor | None, penalty: float) -> DataFrame:
    """One row ``objective``: squared error plus ``penalty`` times all squared parameters.

    ``error`` is a row of :func:`kruskal_error`, :func:`tucker_error` or :func:`relative_error`.
    """
    parts = error.select((F.col("difference") * F.col("difference")).alias("v"))
    pieces = [as_long(f).select("value") for f in factors] + ([core.cells.select("value")] if core else [])
    weights = reduce(DataFrame.unionByName, pieces).agg((penalty * F.sum(F.col("value") * F.col("value"))).alias("v"))
    return parts.unionByName(weights).agg(F.sum("v").alias("objective"))


# ---- regression on samples -------------------------------------------------


def pack_samples(samples: Tensor) -> DataFrame:
    """``(sample_id, x)``: every sample as one array of its fixed size, absent cells zero."""
    width = prod(samples.shape[1:])
    flat = _flat([index(n) for n in range(1, samples.order)], samples.shape[1:])
    cells = samples.cells.select(F.col("i0").alias("sample_id"), flat.alias("at"), "value")
    packed = cells.groupBy("sample_id").agg(F.map_from_entries(F.collect_list(F.struct("at", "value"))).alias("m"))
    at = F.sequence(F.lit(0).cast("bigint"), F.lit(width - 1).cast("bigint"))
    return packed.select("sample_id", F.transform(at, lambda k: F.coalesce(F.element_at("m", k), F.lit(0.0))).alias("x"))


class KruskalRegressor:
    """Linear regression on tensors with low-rank weights.

    ``fit`` takes ``(x array<double>, y double)``: each sample in row order.  Up to
    ``SOLVE_LIMIT`` cells a sample, one pass sums the second moments of x and its products
    with y, and all iterations of all starts solve on these.  Beyond that one pass per mode
    and iteration sums the normal equations inside the tasks.  The driver solves a matrix of
    side ``size of the mode * rank``.
    """

    def __init__(
        self, shape: Sequence[int], rank: int, reg: float = 1.0, tol: float = 1e-6, max_iter: int = 100, seed: int = 64, starts: int = 1
    ):
        self.shape, self.rank, self.reg = tuple(shape), rank, reg
        self.tol, self.max_iter, self.seed, self.starts = tol, max_iter, seed, starts
        self.factors: list[np.ndarray] = []
        self.iterations = 0

    def _spread(self, mode: int) -> np.ndarray:
        """The matrix (cells, size of the mode * rank) that takes a factor to full weights."""
        out = np.ones((1, self.rank))
        for n, size in enumerate(self.shape):
            if n == mode:
                eye = np.eye(size)[:, :, None]
                out = (out.reshape(-1, 1, 1, self.rank) * eye[None]).reshape(-1, size, self.rank)
            elif n < mode:
                out = (out[:, None, :] * self.factors[n][None]).reshape(-1, self.rank)
            else:
                out = (out[:, None] * self.factors[n][None, :, None, :]).reshape(-1, self.shape[mode], self.rank)
        return out.reshape(prod(self.shape), self.shape[mode] * self.rank)

    def _moments(self, df: DataFrame) -> tuple[np.ndarray, np.ndarray, float]:
        width = prod(self.shape)

        def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return np.concatenate([(x.T @ x).ravel(), x.T @ y, [y @ y]])

        total = _partial_sums(df, ["x", "y"], sums, width * width + width + 1)
        return total[: width * width].reshape(width, width), total[width * width : -1], float(total[-1])

    def _equations(self, df: DataFrame, mode: int) -> tuple[np.ndarray, np.ndarray]:
        shape, rank = self.shape, self.rank
        factors = [f.copy() for f in self.factors]
        side = shape[mode] * rank
        if side > SOLVE_LIMIT:
            raise ValueError(f"a {side} x {side} matrix is too large for the driver")

        def sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            z = np.moveaxis(x.reshape(-1, *shape), mode + 1, 1)[..., None]
            z = np.broadcast_to(z, (*z.shape[:-1], rank))
            for n in reversed([n for n in range(len(shape)) if n != mode]):
                z = np.einsum("...ir,ir->...r", z, factors[n])
            z = z.reshape(len(x), side)
            return np.concatenate([(z.T @ z).ravel(), z.T @ y])

        total = _partial_sums(df, ["x", "y"], sums, side * side + side)
        return total[: side * side].reshape(side, side), total[side * side:]

    def _descend(self, equations) -> None:
        """Sweeps over the modes until the weights settle."""
        before = None
        for self.iterations in range(1, self.max_iter + 1):
            for mode, rows in enumerate(self.shape):
                a, b = equations(mode)
                solved = np.linalg.solve(a + self.reg * np.eye(len(a)), b)
                self.factors[mode] = solved.reshape(rows, self.rank)
            now = self.weights() if prod(self.shape) <= CARRY_LIMIT else np.concatenate([f.ravel() for f in self.factors])
            if before is not None and np.linalg.norm(now - before) <= self.tol * np.linalg.norm(now):
                break
            before = now

    def fit(self, df: DataFrame) -> KruskalRegressor:
        rng = np.random.default_rng(self.seed)
        drawn = lambda: [rng.random((s, self.rank)) for s in self.shape]
        if prod(self.shape) > SOLVE_LIMIT:
            self.factors = drawn()
            self._descend(lambda mode: self._equations(df, mode))
            return self
        second, first, size = self._moments(df)

        def equations(mode: int) -> tuple[np.ndarray, np.ndarray]:
            p = self._spread(mode)
            return p.T @ second @ p, p.T @ first

        best = None
        for _ in range(self.starts):
            self.factors = drawn()
            self._descend(equations)
            w = self.weights().ravel()
            gap = size - 2 * w @ first + w @ second @ w + self.reg * sum(float(np.sum(f * f)) for f in self.factors)
            if best is None or gap < best[0]:
                best = gap, self.factors, self.iterations
        _, self.factors, self.iterations = best
        return self

    def weights(self) -> np.ndarray:
        letters = "abcdefgh"[: len(self.shape)]
        spec = ",".join(f"{c}r" for c in letters) + "->" + letters
        return np.einsum(spec, *self.factors)

    def weight_tensor(self, spark: SparkSession) -> Tensor:
        return small_tensor(spark, self.weights())

    def weight_factors(self, spark: SparkSession) -> DataFrame:
        """``(mode, row, r, value)``."""
        rows = [
            (n, i, r, float(v)) for n, f in enumerate(self.factors) for (i, r), v in np.ndenumerate(f)
        ]
        return spark.createDataFrame(rows, "mode int, row int, r int, value double")

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``predicted``."""
        w = df.sparkSession.createDataFrame([(self.weights().ravel().tolist(),)], "w array<double>")
        return df.withColumn("_w", w.scalar()).withColumn("predicted", dot(F.col("x"), F.col("_w"))).drop("_w")


def dot(x: Column, w: Column) -> Column:
    """Inner product of two arrays, inside the row."""
    return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def linear_scores(
    df: DataFrame, weights: Tensor, biases: DataFrame, x: str = "x", cell_limit: int = 1_000_000
) -> DataFrame:
    """Add ``scores`` and ``best``: a linear layer with bias on array samples, and its argmax.

    ``weights`` has the outputs as last mode, ``biases`` holds ``(output, bias)``.
    The layer has a checked size and reaches the rows as one constant.
    """
    if prod(weights.shape) > cell_limit:
        raise ValueError("the layer is too large to carry to every row")
    outputs = weights.shape[-1]
    flat = vectorise(Tensor(
        weights.cells.select(
            F.col(index(weights.order - 1)).alias("i0"),
            *[F.col(index(n)).alias(index(n + 1)) for n in range(weights.order - 1)], "value",
        ),
        (outputs, *weights.shape[:-1]),
    ), keep=1)
    rows = pack_samples(flat).withColumnRenamed("sample_id", "output").join(biases, "output")
    layer = rows.agg(F.array_sort(F.collect_list(F.struct("output", "bias", F.col("x").alias("w")))).alias("l"))
    scored = df.withColumn("_layer", layer.scalar()).withColumn(
        "scores", F.transform("_layer", lambda o: dot(F.col(x), o["w"]) + o["bias"])
    )
    return scored.withColumn("best", F.array_position("scores", F.array_max("scores")) - 1).drop("_layer")
