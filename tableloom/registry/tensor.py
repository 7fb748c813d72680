"""Tensor operators over embeddings (vector x 8 x 8) and line item counts (flag x status x month)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.functions.draws import draw_unit
from tableloom.operators import tensor as tn
from tableloom.plans.scratch import materialize
from tableloom.registry import query, sql_draw, sql_unit

SEED = 64
H = W = 8

CELLS = """x AS (SELECT vec_id AS i0, k // 8 AS i1, k % 8 AS i2, value FROM
  (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS k, CAST(unnest(embedding) AS DOUBLE) AS value FROM embeddings))"""


def n_vectors(t) -> int:
    return t.embeddings.agg(F.max("vec_id")).first()[0] + 1


def vectors(t) -> tn.Tensor:
    long = t.embeddings.select("vec_id", F.posexplode(F.col("embedding").cast("array<double>")).alias("k", "v"))
    return tn.from_flat(long, F.col("vec_id") * (H * W) + F.col("k"), F.col("v"), (n_vectors(t), H, W))


COUNTS = """c AS (SELECT CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS BIGINT) AS i0,
  CAST(CASE l_linestatus WHEN 'F' THEN 0 ELSE 1 END AS BIGINT) AS i1, month(l_shipdate) - 1 AS i2, CAST(count(*) AS DOUBLE) AS value
  FROM lineitem GROUP BY 1, 2, 3)"""


def counts(t) -> tn.Tensor:
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    state = F.when(F.col("l_linestatus") == "F", 0).otherwise(1)
    cells = t.lineitem.groupBy(
        flag.cast("bigint").alias("i0"), state.cast("bigint").alias("i1"),
        (F.month("l_shipdate") - 1).cast("bigint").alias("i2"),
    ).agg(F.count("*").cast("double").alias("value"))
    return tn.Tensor(cells, (3, 2, 12))


def rounded(x, digits=9):
    df = x.cells if isinstance(x, tn.Tensor) else x
    return df.withColumn("value", F.round("value", digits))


def unit(*parts: str) -> str:
    return f"({sql_unit(sql_draw(SEED, *parts))})"


def factor_sql(name: str, mode: int, size: str, rank: int) -> str:
    return f"""{name} AS (SELECT row, r, {unit("'factor'", str(mode), 'row', 'r')} AS v
  FROM (SELECT unnest(range({size})) AS row), range({rank}) q(r))"""


N_VEC = "(SELECT max(vec_id) + 1 FROM embeddings)"


@query("t1_create", f"WITH {CELLS} SELECT i0, i1, i2, value FROM x")
def t1(t):
    return vectors(t).cells


@query("t2_slices_and_fibers", f"""
WITH {CELLS}, {COUNTS} SELECT 'slice' AS kind, i0 AS a, i1 AS b, value FROM x WHERE i2 = 0
UNION ALL SELECT 'fiber', i2, 0, value FROM c WHERE i0 = 0 AND i1 = 0
UNION ALL SELECT 'cell', 0, 0, value FROM c WHERE i0 = 2 AND i1 = 0 AND i2 = 5""")
def t2(t):
    c = counts(t)
    zero = F.lit(0).cast("bigint")
    part = tn.fixed(vectors(t), {2: 0}).cells.select(F.lit("slice").alias("kind"), F.col("i0").alias("a"), F.col("i1").alias("b"), "value")
    fiber = tn.fixed(c, {0: 0, 1: 0}).cells.select(F.lit("fiber").alias("kind"), F.col("i0").alias("a"), zero.alias("b"), "value")
    cell = tn.fixed(c, {0: 2, 1: 0, 2: 5}).cells.select(F.lit("cell").alias("kind"), zero.alias("a"), zero.alias("b"), "value")
    return part.unionByName(fiber).unionByName(cell)


@query("t3_unfold", f"""
WITH {CELLS} SELECT 0 AS mode, i0 AS "row", i1 * 8 + i2 AS col, value FROM x UNION ALL SELECT 1, i1, i0 * 8 + i2, value FROM x
UNION ALL SELECT 2, i2, i0 * 8 + i1, value FROM x""")
def t3(t):
    x = vectors(t)
    sides = [tn.unfold(x, n).select(F.lit(n).alias("mode"), "row", "col", "value") for n in range(3)]
    return sides[0].unionByName(sides[1]).unionByName(sides[2])


@query("t4_fold", f"WITH {CELLS} SELECT i0, i1, i2, value FROM x")
def t4(t):
    x = vectors(t)
    return tn.fold(tn.unfold(x, 1), 1, x.shape).cells


@query("t5_reshape", f"""
WITH {CELLS} SELECT 'matrix' AS kind, (i0 * 64 + i1 * 8 + i2) // 16 AS a, (i0 * 64 + i1 * 8 + i2) % 16 AS b, value FROM x
UNION ALL SELECT 'vector', i0 * 64 + i1 * 8 + i2, 0, value FROM x
UNION ALL SELECT 'samples', i0, i1 * 8 + i2, value FROM x""")
def t5(t):
    x = vectors(t)
    zero = F.lit(0).cast("bigint")
    matrix = tn.reshape(x, (x.shape[0] * 4, 16)).cells
    rows = tn.vectorise(x, keep=1).cells
    kinds = [
        matrix.select(F.lit("matrix").alias("kind"), F.col("i0").alias("a"), F.col("i1").alias("b"), "value"),
        tn.vectorise(x).cells.select(F.lit("vector").alias("kind"), F.col("i0").alias("a"), zero.alias("b"), "value"),
        rows.select(F.lit("samples").alias("kind"), F.col("i0").alias("a"), F.col("i1").alias("b"), "value"),
    ]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2])


def small_matrix(t, rows, columns, mode):
    """A matrix of draws as ``(d, i, value)``."""
    return tn.as_long(tn.random_factor(t.spark, rows, columns, SEED, mode)).select(
        F.col("row").alias("d"), F.col("r").alias("i"), "value"
    )


@query("t6_mode_product_matrix", f"""
WITH {CELLS}, {factor_sql('m', 7, '5', 8)}
SELECT i0, m.row AS i1, i2, round(sum(value * v), 9) AS value FROM x JOIN m ON r = i1 GROUP BY 1, 2, 3""")
def t6(t):
    return rounded(tn.mode_dot(vectors(t), small_matrix(t, 5, 8, 7), 1, 5))


@query("t7_mode_product_vector", f"""
WITH {CELLS}, {factor_sql('m', 7, '1', 8)}
SELECT i0, i2 AS i1, round(sum(value * v), 9) AS value FROM x JOIN m ON r = i1 GROUP BY 1, 2""")
def t7(t):
    vector = small_matrix(t, 1, 8, 7).select("i", "value")
    return rounded(tn.mode_dot_vector(vectors(t), vector, 1))


@query("t8_inner_product", f"""
WITH {CELLS}, {factor_sql('w', 3, '8', 8)}
SELECT i0, round(sum(value * v), 9) AS value FROM x JOIN w ON "row" = i1 AND r = i2 GROUP BY 1""")
def t8(t):
    w = tn.as_long(tn.random_factor(t.spark, H, W, SEED, 3)).select(
        F.col("row").alias("i0"), F.col("r").cast("bigint").alias("i1"), "value"
    )
    return rounded(tn.inner_per_sample(vectors(t), tn.Tensor(w, (H, W))))


RANK = 3
FACTORS = ",\n".join([factor_sql("fa", 0, N_VEC, RANK), factor_sql("fb", 1, "8", RANK), factor_sql("fc", 2, "8", RANK)])
KRUSKAL = f"""{FACTORS},
k AS (SELECT fa.row AS i0, fb.row AS i1, fc.row AS i2, sum(fa.v * fb.v * fc.v) AS value FROM fa JOIN fb USING (r) JOIN fc USING (r) GROUP BY 1, 2, 3)"""


def factors(t):
    return [materialize(tn.random_factor(t.spark, s, RANK, SEED, n)) for n, s in enumerate((n_vectors(t), H, W))]


@query("t9_relative_error", f"""
WITH {CELLS}, {KRUSKAL}, d AS (SELECT k.value - coalesce(x.value, 0) AS gap, coalesce(x.value, 0) AS v FROM k LEFT JOIN x USING (i0, i1, i2))
SELECT round(sqrt(sum(gap * gap)), 6) AS difference, round(sqrt(sum(v * v)), 6) AS norm,
       round(sqrt(sum(gap * gap)) / sqrt(sum(v * v)), 6) AS error FROM d""")
def t9(t):
    x = vectors(t)
    row = tn.kruskal_error(x, factors(t), RANK)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


@query("t9_error_of_tensors", f"""
WITH {CELLS}, {KRUSKAL}, d AS (SELECT k.value - coalesce(x.value, 0) AS gap, coalesce(x.value, 0) AS v FROM k LEFT JOIN x USING (i0, i1, i2))
SELECT round(sqrt(sum(gap * gap)), 6) AS difference, round(sqrt(sum(v * v)), 6) AS norm,
       round(sqrt(sum(gap * gap)) / sqrt(sum(v * v)), 6) AS error FROM d""")
def t9_of_tensors(t):
    x = vectors(t)
    row = tn.relative_error(tn.kruskal_to_tensor(factors(t), RANK, x.shape), x)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


# factors made of the vectors: their first components, and means over all vectors by component
MEANS = """means AS (SELECT k, avg(value) AS v FROM (SELECT i1 * 8 + i2 AS k, value FROM x) GROUP BY 1)"""


def vector_sql(name: str, rank: int) -> str:
    return f"{name} AS (SELECT vec_id AS row, r, CAST(embedding[r + 1] AS DOUBLE) AS v FROM embeddings, range({rank}) q(r))"


def mean_sql(name: str, rank: int, at: str) -> str:
    return f"{name} AS (SELECT row, r, means.v FROM range(8) p(row), range({rank}) q(r), means WHERE means.k = {at})"


def vector_factor(t, rank):
    """Each vector's first components."""
    parts = F.slice(F.col("embedding").cast("array<double>"), 1, rank)
    return materialize(t.embeddings.select(F.col("vec_id").alias("row"), parts.alias("f")))


def mean_table(t):
    """(k, v): the mean of each component."""
    long = t.embeddings.select(F.posexplode(F.col("embedding").cast("array<double>")).alias("k", "value"))
    return materialize(long.groupBy("k").agg(F.avg("value").alias("v")))


def mean_factor(means, rank, at):
    """(row, f) of eight rows: the means at the places ``at(row, r)``."""
    places = means.sparkSession.range(8).select(F.col("id").alias("row"), F.explode(F.sequence(F.lit(0), F.lit(rank - 1))).alias("r"))
    met = places.withColumn("k", at(F.col("row"), F.col("r")).cast("int")).join(means, "k")
    return materialize(met.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("r", "v"))), lambda e: e["v"]).alias("f")))


@query("t10_kruskal_to_tensor", f"""
WITH {CELLS}, {MEANS}, {vector_sql('fa', RANK)}, {mean_sql('fb', RANK, 'row * 8 + r')}, {mean_sql('fc', RANK, 'r * 8 + row')}
SELECT fa.row AS i0, fb.row AS i1, fc.row AS i2, round(sum(fa.v * fb.v * fc.v), 9) AS value FROM fa JOIN fb USING (r) JOIN fc USING (r) GROUP BY 1, 2, 3""")
def t10(t):
    means = mean_table(t)
    parts = [vector_factor(t, RANK), mean_factor(means, RANK, lambda row, r: row * 8 + r), mean_factor(means, RANK, lambda row, r: r * 8 + row)]
    return rounded(tn.kruskal_to_tensor(parts, RANK, (n_vectors(t), H, W)))


COUNTED = """
SELECT CAST(strpos('ANR', l_returnflag) - 1 AS BIGINT) AS i0, CAST(strpos('FO', l_linestatus) - 1 AS BIGINT) AS i1,
       CAST(month(l_shipdate) - 1 AS BIGINT) AS i2, CAST(count(*) AS DOUBLE) AS value FROM lineitem GROUP BY 1, 2, 3"""


def counted(t) -> tn.Tensor:
    at = [
        F.instr(F.lit("ANR"), F.col("l_returnflag")) - 1, F.instr(F.lit("FO"), F.col("l_linestatus")) - 1, F.month("l_shipdate") - 1
    ]
    named = t.lineitem.select(*[c.cast("bigint").alias(f"i{n}") for n, c in enumerate(at)])
    return tn.Tensor(materialize(named.groupBy("i0", "i1", "i2").agg(F.count("*").cast("double").alias("value"))), (3, 2, 12))


@query("t11_cp_decomposition", COUNTED)
def t11(t):
    """At rank 6 a 3 x 2 x 12 tensor is given back; run until the error settles."""
    x = counted(t)
    found = tn.parafac(x, 6)
    again = tn.kruskal_to_tensor(found.factors, 6, x.shape).cells
    return again.select("i0", "i1", "i2", F.round("value", 3).alias("value")).where("abs(value) > 0.001")


@query("t11_cp_of_embeddings")
def t11_of_embeddings(t):
    """Relative error after each sweep until it settles, and the recomputed error of the final factors."""
    x = tn.Tensor(materialize(vectors(t).cells), (n_vectors(t), H, W))
    found = tn.parafac(x, RANK, tol=1e-4)
    direct = tn.kruskal_error(x, found.factors, RANK).first()["error"]
    assert abs(direct - found.errors[-1]) < 1e-6 and found.errors == sorted(found.errors, reverse=True)
    rows = [(n, round(e, 9)) for n, e in enumerate(found.errors)]
    return t.spark.createDataFrame(rows, "sweep int, error double")


CORE = (2, 3, 2)
@query("t12_tucker_to_tensor", f"""
WITH {CELLS}, {MEANS}, {vector_sql('ua', 2)}, {mean_sql('ub', 3, 'row * 8 + r')}, {mean_sql('uc', 2, 'r * 8 + row')},
g AS (SELECT k // 6 AS a, k // 2 % 3 AS b, k % 2 AS c, v FROM means WHERE k < 12)
SELECT ua.row AS i0, ub.row AS i1, uc.row AS i2, round(sum(g.v * ua.v * ub.v * uc.v), 9) AS value
FROM g JOIN ua ON ua.r = a JOIN ub ON ub.r = b JOIN uc ON uc.r = c GROUP BY 1, 2, 3""")
def t12(t):
    means = mean_table(t)
    parts = [vector_factor(t, 2), mean_factor(means, 3, lambda row, r: row * 8 + r), mean_factor(means, 2, lambda row, r: r * 8 + row)]
    core = tn.from_flat(means.where("k < 12"), F.col("k"), F.col("v"), CORE)
    return rounded(tn.tucker_to_tensor(core, parts, (n_vectors(t), H, W)))


@query("t13_tucker_decomposition")
def t13(t):
    """Relative error after each sweep, and the recomputed error of core and factors."""
    x = tn.Tensor(materialize(vectors(t).cells), (n_vectors(t), H, W))
    found = tn.tucker(x, (4, 3, 3), tol=1e-4)
    direct = tn.tucker_error(x, found.core, found.factors).first()["error"]
    assert abs(direct - found.errors[-1]) < 1e-6
    rows = [(n, round(e, 9)) for n, e in enumerate(found.errors)]
    return t.spark.createDataFrame(rows, "sweep int, error double")


@query("t13_tucker_of_full_ranks", COUNTED)
def t13_full(t):
    """Full ranks give back the cells of a tensor of counts."""
    x = counted(t)
    found = tn.tucker(x, x.shape)
    again = tn.tucker_to_tensor(found.core, found.factors, x.shape).cells
    return again.select("i0", "i1", "i2", F.round("value", 6).alias("value")).where("value <> 0")


@query("t14_parameter_counts", f"""
WITH {CELLS}, s AS (SELECT max(i0) + 1 AS a, max(i1) + 1 AS b, max(i2) + 1 AS c FROM x)
SELECT a * b * c AS original, 10 * a + 4 * b + 4 * c AS factors, 160::BIGINT AS core FROM s""")
def t14(t):
    return tn.parameter_counts(tn.shape_table(vectors(t), (10, 4, 4)))


@query("t15_space_savings", f"""
WITH {CELLS}, s AS (SELECT max(i0) + 1 AS a, max(i1) + 1 AS b, max(i2) + 1 AS c FROM x)
SELECT CAST(trunc(100 * (1 - CAST(3 * (a + b + c) AS DOUBLE) / (a * b * c))) AS INTEGER) AS cp,
       CAST(trunc(100 * (1 - CAST(160 + 10 * a + 4 * b + 4 * c AS DOUBLE) / (a * b * c))) AS INTEGER) AS tucker FROM s""")
def t15(t):
    x = vectors(t)
    cp = tn.parameter_counts(tn.shape_table(x, (3, 3, 3))).select("original", "factors")
    full = tn.parameter_counts(tn.shape_table(x, (10, 4, 4)))
    return cp.withColumnRenamed("factors", "cp_size").join(full, "original").select(
        tn.space_savings(F.col("original"), F.col("cp_size")).alias("cp"),
        tn.space_savings(F.col("original"), F.col("factors") + F.col("core")).alias("tucker"),
    )


def labelled(t):
    return t.embeddings.select(
        F.col("vec_id").alias("sample_id"), F.col("embedding").cast("array<double>").alias("x"),
        F.col("label").cast("double").alias("y"),
    )


PLANTED = 2
PLANTED_SQL = f"""{factor_sql('pb', 1, '8', PLANTED)}, {factor_sql('pc', 2, '8', PLANTED)},
w AS (SELECT pb.row AS i1, pc.row AS i2, sum(pb.v * pc.v) AS v FROM pb JOIN pc USING (r) GROUP BY 1, 2)"""


def planted(t):
    """Samples whose y follows from weights of rank 2, and the fit of such weights to them."""
    parts = [tn.random_factor(t.spark, H, PLANTED, SEED, 1), tn.random_factor(t.spark, W, PLANTED, SEED, 2)]
    y = tn.inner_per_sample(vectors(t), tn.kruskal_to_tensor(parts, PLANTED, (H, W))).select(
        F.col("i0").alias("sample_id"), F.col("value").alias("y")
    )
    data = materialize(labelled(t).drop("y").join(y, "sample_id"))
    return data, tn.KruskalRegressor((H, W), PLANTED, reg=1e-9, tol=1e-11, max_iter=5000, seed=SEED, starts=4).fit(data)


@query("t16_tensor_regression", f"""
WITH {CELLS}, {PLANTED_SQL} SELECT i0 AS sample_id, round(sum(value * v), 5) AS predicted FROM x JOIN w USING (i1, i2) GROUP BY 1""")
def t16(t):
    """What the fitted weights predict, where the target follows from planted ones."""
    data, fitted = planted(t)
    return fitted.predict(data).select("sample_id", F.round("predicted", 5).alias("predicted"))


@query("t16_regression_on_labels")
def t16_on_labels(t):
    """Mean squared error of weights fitted to the labels until they settle, and of the plain mean."""
    rows = labelled(t)
    data = materialize(rows.withColumn("y", F.col("y") - rows.agg(F.avg("y")).scalar()))
    fitted = tn.KruskalRegressor((H, W), 2, reg=0.1, max_iter=1000, seed=SEED).fit(data)
    gap = F.col("y") - F.col("predicted")
    return fitted.predict(data).agg(
        F.round(F.avg(gap * gap), 6).alias("fitted_error"),
        F.round(F.avg(F.col("y") * F.col("y")), 6).alias("mean_error"),
    )


@query("t17_regression_predict", f"""
WITH {CELLS}, {factor_sql('fb', 1, '8', RANK)}, {factor_sql('fc', 2, '8', RANK)},
w AS (SELECT fb.row AS i1, fc.row AS i2, sum(fb.v * fc.v) AS v FROM fb JOIN fc USING (r) GROUP BY 1, 2)
SELECT i0, round(sum(value * v), 9) AS value FROM x JOIN w USING (i1, i2) GROUP BY 1""")
def t17(t):
    parts = [tn.random_factor(t.spark, H, RANK, SEED, 1), tn.random_factor(t.spark, W, RANK, SEED, 2)]
    return rounded(tn.inner_per_sample(vectors(t), tn.kruskal_to_tensor(parts, RANK, (H, W))))


@query("t18_learned_weights", f"""
WITH {PLANTED_SQL} SELECT i1 AS i0, i2 AS i1, round(v, 5) AS value, round(v, 5) AS from_factors FROM w""")
def t18(t):
    """The learned weights as a full tensor, next to what their factors give: the planted ones."""
    _, fitted = planted(t)
    full = fitted.weight_tensor(t.spark).cells
    long = fitted.weight_factors(t.spark)
    side = lambda n: long.where(F.col("mode") == n).groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("r", "value"))), lambda e: e["value"]).alias("f"))
    again = tn.kruskal_to_tensor([side(0), side(1)], 2, (H, W)).cells.withColumnRenamed("value", "from_factors")
    return full.join(again, ["i0", "i1"]).select(
        "i0", "i1", F.round("value", 5).alias("value"), F.round("from_factors", 5).alias("from_factors")
    )


OUTPUTS = 10


@query("t19_low_rank_layer", f"""
WITH {CELLS}, {factor_sql('ua', 0, '8', 2)}, {factor_sql('ub', 1, '8', 3)}, {factor_sql('uc', 2, str(OUTPUTS), 2)},
g AS (SELECT a, b, c, {unit("'cell'", 'a', 'b', 'c')} AS v FROM range(2) p(a), range(3) q(b), range(2) s(c)),
w AS (SELECT ua.row AS i1, ub.row AS i2, uc.row AS o, sum(g.v * ua.v * ub.v * uc.v) AS w
  FROM g JOIN ua ON ua.r = a JOIN ub ON ub.r = b JOIN uc ON uc.r = c GROUP BY 1, 2, 3),
s AS (SELECT i0, o, sum(value * w) + {unit("'bias'", 'o')} AS score FROM x JOIN w USING (i1, i2) GROUP BY 1, 2)
SELECT i0 AS vec_id, arg_max(o, score) AS best, round(max(score), 9) AS top FROM s GROUP BY 1""")
def t19(t):
    sizes = (H, W, OUTPUTS)
    parts = [tn.random_factor(t.spark, s, r, SEED, n) for n, (s, r) in enumerate(zip(sizes, CORE))]
    core = tn.Tensor(tn.random_cells(tn.dense_cells(t.spark, CORE), ["i0", "i1", "i2"], SEED), CORE)
    layer = tn.tucker_to_tensor(core, parts, sizes)
    biases = t.spark.range(OUTPUTS).select(F.col("id").alias("output"), draw_unit(SEED, "bias", F.col("id")).alias("bias"))
    scored = tn.linear_scores(labelled(t), tn.Tensor(materialize(layer.cells), sizes), biases)
    return scored.select(
        F.col("sample_id").alias("vec_id"), "best", F.round(F.array_max("scores"), 9).alias("top")
    )


@query("t20_penalised_objective", f"""
WITH {CELLS}, {KRUSKAL}, d AS (SELECT k.value - coalesce(x.value, 0) AS gap FROM k LEFT JOIN x USING (i0, i1, i2)),
p AS (SELECT sum(v * v) AS s FROM (SELECT v FROM fa UNION ALL SELECT v FROM fb UNION ALL SELECT v FROM fc))
SELECT round(sum(gap * gap) + 0.1 * any_value(s), 5) AS objective FROM d, p""")
def t20(t):
    x, parts = vectors(t), factors(t)
    row = tn.penalised_objective(tn.kruskal_error(x, parts, RANK), parts, None, 0.1)
    return row.select(F.round("objective", 5).alias("objective"))


@query("t21_mean_over_axis", f"""
WITH {CELLS} SELECT i1 AS i0, i2 AS i1, round(sum(value) / {N_VEC}, 9) AS value FROM x GROUP BY 1, 2""")
def t21(t):
    return rounded(tn.mean_over(vectors(t), 0))


NORMAL_U = sql_unit(sql_draw(SEED, "'cell'", "i0", "i1", "i2", "'u'"), 1)
NORMAL_V = sql_unit(sql_draw(SEED, "'cell'", "i0", "i1", "i2", "'v'"))


@query("t22_random_tensors", f"""
WITH {CELLS} SELECT i0, i1, i2, round(sqrt(-2.0 * ln({NORMAL_U})) * cos(6.283185307179586 * ({NORMAL_V})), 9) AS normal,
       round({unit("'cell'", 'i0', 'i1', 'i2')}, 9) AS uniform FROM x""")
def t22(t):
    names = ["i0", "i1", "i2"]
    at = vectors(t).cells.select(*names)
    normal = tn.random_cells(at, names, SEED, normal=True).withColumn("normal", F.round("value", 9)).drop("value")
    return tn.random_cells(normal, names, SEED).withColumn("uniform", F.round("value", 9)).drop("value")
