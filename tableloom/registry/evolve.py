"""Evolutionary operators over one individual per customer, bred within nations."""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.operators import evolve as ev
from tableloom.plans.ordered import numbered
from tableloom.plans.scratch import materialize, scratch_path
from tableloom.plans.skew import join_small
from tableloom.registry import query, sql_draw, sql_unit
from tableloom.sources.writers import append_metrics, read_metrics

SEED = 64
L = 24
TARGET = [ord(c) for c in "evolving tables on spark"]

# ---- the SQL side ----------------------------------------------------------


def pop_sql(low: int = 0, high: int = 1, name: str = "pop") -> str:
    gene = sql_draw(SEED, "'gene'", "c_nationkey", "c_custkey", "i")
    return f"""{name} AS (SELECT c_nationkey AS deme, c_custkey AS ind_id,
  [CAST({low} + {gene} % {high - low + 1} AS INTEGER) for i in range({L})] AS genes, CAST(NULL AS DOUBLE) AS fitness FROM customer)"""


ONES = "CAST(list_sum(genes) AS DOUBLE)"
SHARE = f"CAST(list_sum(genes) AS DOUBLE) / {L}"
CLOSE = f"-CAST(list_sum([abs(genes[i] - {TARGET}[i]) for i in range(1, {L + 1})]) AS DOUBLE)"


def scored_sql(source: str, name: str, fitness: str) -> str:
    return f"{name} AS (SELECT deme, ind_id, genes, coalesce(fitness, {fitness}) AS fitness FROM {source})"


def unit_sql(*parts: str) -> str:
    return f"({sql_unit(sql_draw(SEED, *parts))})"


def shuffle_sql(source: str, name: str, gen: int, seed: int = SEED) -> str:
    order = sql_draw(seed, f"{gen}", "'shuffle'", "deme", "ind_id")
    return f"{name} AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY {order}, ind_id) AS rn FROM {source})"


def pairs_sql(source: str, name: str, at: str = "rn") -> str:
    side = lambda s, c: f"max(CASE WHEN ({at} - 1) % 2 = {s} THEN {c} END)"
    return f"""{name} AS (SELECT deme, ({at} - 1) // 2 AS pair_id, {side(0, 'ind_id')} AS a_id, {side(0, 'genes')} AS a_genes,
  {side(0, 'fitness')} AS a_fit, {side(1, 'ind_id')} AS b_id, {side(1, 'genes')} AS b_genes, {side(1, 'fitness')} AS b_fit
  FROM {source} GROUP BY 1, 2)"""


def children_sql(pairs: str, name: str, first: str, second: str, crossed: str = "true", offset: int = 0) -> str:
    mix = lambda p, q: f"CASE WHEN x THEN {p}_genes[1:f] || {q}_genes[f + 1:s] || {p}_genes[s + 1:] ELSE {p}_genes END"
    return f"""{name}_1 AS (SELECT *, {first} AS f FROM {pairs}),
{name}_2 AS (SELECT *, {second} AS s, coalesce(b_genes IS NOT NULL AND {crossed}, false) AS x FROM {name}_1),
{name} AS (SELECT deme, 2 * pair_id + {offset + 1} AS ind_id, {mix('a', 'b')} AS genes, CASE WHEN NOT x THEN a_fit END AS fitness FROM {name}_2
  UNION ALL SELECT deme, 2 * pair_id + {offset + 2}, {mix('b', 'a')}, CASE WHEN NOT x THEN b_fit END FROM {name}_2 WHERE b_genes IS NOT NULL)"""


def pair_draw(gen: int, step: str) -> str:
    return sql_draw(SEED, f"{gen}", f"'{step}'", "deme", "pair_id")


def gate_sql(gen: int, p: float) -> str:
    return f"{unit_sql(f'{gen}', chr(39) + 'cross' + chr(39), 'deme', 'pair_id')} < {p}"


def two_point_sql(pairs: str, name: str, gen: int, crossed: str = "true", offset: int = 0) -> str:
    return children_sql(
        pairs, name, f"{pair_draw(gen, 'cut1')} % {L + 1}", f"f + {pair_draw(gen, 'cut2')} % ({L + 1} - f)", crossed, offset
    )


def interior_sql(pairs: str, name: str, gen: int, crossed: str) -> str:
    one, two = f"({pair_draw(gen, 'cut1')} % {L - 2} + 1)", f"({pair_draw(gen, 'cut2')} % {L - 2} + 1)"
    return children_sql(pairs, name, f"least({one}, {two})", f"greatest({one}, {two})", crossed)


def distinct_sql(pairs: str, name: str, gen: int, crossed: str) -> str:
    one, raw = f"({pair_draw(gen, 'cut1')} % {L} + 1)", f"({pair_draw(gen, 'cut2')} % {L - 1} + 1)"
    two = f"(CASE WHEN {raw} >= {one} THEN {raw} + 1 ELSE {raw} END)"
    return children_sql(pairs, name, f"least({one}, {two})", f"greatest({one}, {two})", crossed)


def mutate_sql(source: str, name: str, gate: str, gene: str) -> str:
    return f"""{name} AS (SELECT deme, ind_id, CASE WHEN {gate} THEN [CAST({gene} AS INTEGER) for i in range({L})] ELSE genes END AS genes,
  CASE WHEN NOT ({gate}) THEN fitness END AS fitness FROM {source})"""


def who_draw(gen: int, step: str, *more: str) -> str:
    return sql_draw(SEED, f"{gen}", f"'{step}'", "deme", "ind_id", *more)


def who_unit(gen: int, step: str, *more: str) -> str:
    return f"({sql_unit(who_draw(gen, step, *more))})"


def flip_sql(source: str, name: str, gen: int) -> str:
    gene = f"CASE WHEN {who_unit(gen, 'flip', 'i')} < 0.05 THEN 1 - genes[i + 1] ELSE genes[i + 1] END"
    return mutate_sql(source, name, f"{who_unit(gen, 'mutate')} < 0.2", gene)


def flip_one_sql(source: str, name: str, gen: int, p: float = 0.01) -> str:
    gene = f"CASE WHEN i = {who_draw(gen, 'locus')} % {L} THEN 1 - genes[i + 1] ELSE genes[i + 1] END"
    return mutate_sql(source, name, f"{who_unit(gen, 'mutate')} < {p}", gene)


def resample_sql(source: str, name: str, gen: int) -> str:
    gene = f"""CASE WHEN CAST(0.05 AS DOUBLE) > ({who_draw(gen, 'gate', 'i')} % 101) / CAST(100 AS DOUBLE)
      THEN {who_draw(gen, 'bit', 'i')} % 2 ELSE genes[i + 1] END"""
    return mutate_sql(source, name, f"CAST(0.2 AS DOUBLE) > ({who_draw(gen, 'mutate')} % 101) / CAST(100 AS DOUBLE)", gene)


def creep_sql(source: str, name: str, gen: int) -> str:
    gene = f"CASE WHEN i = {who_draw(gen, 'locus')} % {L} THEN genes[i + 1] + {who_draw(gen, 'step')} % 11 - 5 ELSE genes[i + 1] END"
    return mutate_sql(source, name, f"{who_unit(gen, 'mutate')} < 0.2", gene)


def place_sql(source: str, name: str) -> str:
    return f"{name} AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY fitness DESC, ind_id) AS place FROM {source})"


def position_sql(source: str, name: str) -> str:
    return f"""{name} AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY ind_id) AS rn,
  count(*) OVER (PARTITION BY deme) AS n FROM {source})"""


def tournament_sql(source: str, name: str, gen: int, rounds: int = 3) -> str:
    pick = sql_draw(SEED, f"{gen}", "'tournament'", "p.deme", "p.rn", "t")
    return f"""{position_sql(source, name + '_p')},
{name}_d AS (SELECT p.deme, p.rn AS slot, {pick} % p.n + 1 AS pick FROM {name}_p p, range({rounds}) r(t)),
{name}_r AS (SELECT d.deme, d.slot, q.ind_id, q.genes, q.fitness,
  row_number() OVER (PARTITION BY d.deme, d.slot ORDER BY q.fitness DESC, q.ind_id) AS k
  FROM {name}_d d JOIN {name}_p q ON d.deme = q.deme AND d.pick = q.rn),
{name} AS (SELECT deme, slot, ind_id, genes, fitness FROM {name}_r WHERE k = 1)"""


def parents_sql(source: str, name: str, gen: int) -> str:
    pick = sql_draw(SEED, f"{gen}", "'parents'", "p.deme", "(p.rn - 1) // 2", "t")
    win = lambda x, y: f"CASE WHEN f{x} > f{y} THEN i{x} ELSE i{y} END"
    take = ", ".join(f"max(CASE WHEN t = {k} THEN q.fitness END) AS f{k}, max(CASE WHEN t = {k} THEN q.ind_id END) AS i{k}" for k in range(4))
    return f"""{position_sql(source, name + '_p')},
{name}_d AS (SELECT p.deme, (p.rn - 1) // 2 AS pair_id, t, {pick} % p.n + 1 AS pick FROM {name}_p p, range(4) r(t) WHERE p.rn % 2 = 1),
{name}_m AS (SELECT d.deme, d.pair_id, {take} FROM {name}_d d JOIN {name}_p q ON d.deme = q.deme AND d.pick = q.rn GROUP BY 1, 2),
{name}_w AS (SELECT deme, pair_id, {win(0, 1)} AS a_id, {win(2, 3)} AS b_id FROM {name}_m),
{name} AS (SELECT w.deme, w.pair_id, w.a_id, a.genes AS a_genes, a.fitness AS a_fit, w.b_id, b.genes AS b_genes, b.fitness AS b_fit
  FROM {name}_w w JOIN {source} a ON a.deme = w.deme AND a.ind_id = w.a_id JOIN {source} b ON b.deme = w.deme AND b.ind_id = w.b_id)"""


def roulette_sql(source: str, name: str, gen: int) -> str:
    point = sql_draw(SEED, f"{gen}", "'roulette'", "deme", "rn")
    return f"""{name}_p AS (SELECT deme, ind_id, fitness, row_number() OVER w AS rn, sum(fitness) OVER w - fitness AS starts,
  sum(fitness) OVER (PARTITION BY deme) AS total FROM {source} WINDOW w AS (PARTITION BY deme ORDER BY ind_id)),
{name}_x AS (SELECT deme, rn AS slot, {sql_unit(point)} * total AS at FROM {name}_p),
{name}_r AS (SELECT x.deme, x.slot, p.ind_id, row_number() OVER (PARTITION BY x.deme, x.slot ORDER BY p.starts DESC, p.rn DESC) AS k
  FROM {name}_x x JOIN {name}_p p ON x.deme = p.deme AND p.starts <= x.at),
{name} AS (SELECT r.deme, r.slot, r.ind_id, s.genes, s.fitness FROM {name}_r r JOIN {source} s USING (deme, ind_id) WHERE k = 1)"""


def as_pop_sql(source: str, name: str) -> str:
    return f"{name} AS (SELECT deme, slot AS ind_id, genes, fitness FROM {source})"


def elitist_sql(source: str, name: str, gen: int, elite: int) -> str:
    return ",\n".join([
        place_sql(source, f"{name}_k"),
        f"{name}_rest AS (SELECT deme, ind_id, genes, fitness FROM {name}_k WHERE place > {elite})",
        shuffle_sql(f"{name}_rest", f"{name}_sh", gen),
        pairs_sql(f"{name}_sh", f"{name}_pairs"),
        two_point_sql(f"{name}_pairs", f"{name}_kids", gen, offset=elite),
        resample_sql(f"{name}_kids", f"{name}_mut", gen),
        f"""{name} AS (SELECT deme, place AS ind_id, genes, fitness FROM {name}_k WHERE place <= {elite}
  UNION ALL SELECT * FROM {name}_mut)""",
    ])


def show(source: str) -> str:
    return f"SELECT deme, ind_id, array_to_string(genes, ',') AS genes, fitness FROM {source}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


POP = pop_sql()
SCORED = (POP, scored_sql("pop", "scored", ONES))

# ---- the Spark side --------------------------------------------------------


def ids(t):
    return t.customer.select(F.col("c_nationkey").alias("deme"), F.col("c_custkey").alias("ind_id"))


def population(t):
    return ev.random_population(ids(t), L, SEED)


def scored(t):
    return materialize(ev.score(population(t), ev.ones_count))


def shown(df):
    return df.select("deme", "ind_id", F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"), "fitness")


@query("e1_random_bits", with_(POP) + show("pop"))
def e1(t):
    return shown(population(t))


GIVEN = [1, 0] * (L // 2)


@query("e2_population_with_given", with_(POP) + f"""
SELECT deme, ind_id, array_to_string(CASE WHEN ind_id = max(ind_id) OVER (PARTITION BY deme) THEN {GIVEN} ELSE genes END, ',') AS genes,
       fitness FROM pop""")
def e2(t):
    return shown(ev.with_given(population(t), GIVEN))


@query("e3_random_codes", with_(pop_sql(1, 255)) + show("pop"))
def e3(t):
    return shown(ev.random_population(ids(t), L, SEED, 1, 255))


@query("e4_share_of_ones", with_(POP) + f"SELECT deme, ind_id, {SHARE} AS fitness FROM pop")
def e4(t):
    return ev.score(population(t), ev.ones_share).select("deme", "ind_id", "fitness")


@query("e5_count_and_distance", with_(POP, pop_sql(1, 255, "codes")) + f"""
SELECT p.deme, p.ind_id, p.ones, c.closeness FROM (SELECT deme, ind_id, {ONES} AS ones FROM pop) p
JOIN (SELECT deme, ind_id, {CLOSE} AS closeness FROM codes) c USING (deme, ind_id)""")
def e5(t):
    codes = ev.random_population(ids(t), L, SEED, 1, 255).select("deme", "ind_id", F.col("genes").alias("codes"))
    # a row per individual on both sides: the small file behind it must not make Spark broadcast the genes
    both = population(t).join(codes.hint("merge"), ["deme", "ind_id"])
    return both.select(
        "deme", "ind_id", ev.ones_count(F.col("genes")).alias("ones"), ev.closeness(F.col("codes"), TARGET).alias("closeness")
    )


MASKED = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def separation(lines, label):
    """How far the class means of every feature lie apart: ``(locus, gain)``."""
    long = lines.select(label, F.posexplode(F.array(*MASKED)).alias("locus", "x"))
    per_class = long.groupBy("locus", label).agg(F.count("*").alias("n"), F.avg("x").alias("m"), F.var_pop("x").alias("v"))
    n, m, v = F.col("n"), F.col("m"), F.col("v")
    between = F.sum(n * m * m) / F.sum(n) - F.pow(F.sum(n * m) / F.sum(n), F.lit(2))
    within = F.sum(n * v) / F.sum(n)
    return per_class.groupBy("locus").agg((between / within * 1000).alias("gain"))


@query("e6_feature_mask_fitness", with_(POP, f"""
long AS (SELECT l_returnflag AS c, unnest([0, 1, 2, 3]) AS locus, unnest([{', '.join(MASKED)}]) AS x FROM lineitem),
pc AS (SELECT locus, c, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM long GROUP BY 1, 2),
gain AS (SELECT locus, (sum(n * m * m) / sum(n) - pow(sum(n * m) / sum(n), 2)) / (sum(n * v) / sum(n)) * 1000 AS gain FROM pc GROUP BY 1)""") + """
SELECT deme, ind_id, round(sum(CASE WHEN genes[locus + 1] = 1 THEN gain - 0.05 ELSE 0 END), 6) AS fitness FROM pop, gain GROUP BY 1, 2""")
def e6(t):
    """Each individual switches features of the line items on; the plan scores the choice."""
    gains = separation(t.lineitem, "l_returnflag")

    def fitness(individuals):
        loci = individuals.select("deme", "ind_id", F.posexplode("genes").alias("locus", "on"))
        gained = F.when(F.col("on") == 1, F.col("gain") - 0.05).otherwise(0.0)
        return join_small(loci, gains, ["locus"]).groupBy("deme", "ind_id").agg(F.sum(gained).alias("fitness"))

    done = ev.score_with_table(population(t), fitness)
    return done.select("deme", "ind_id", F.round("fitness", 6).alias("fitness"))


@query("e7_lazy_scoring", with_(*SCORED, flip_sql("scored", "changed", 1)) + f"""
SELECT deme, count(*) AS n, count(*) - count(fitness) AS n_evaluations, sum(coalesce(fitness, {ONES})) AS total FROM changed GROUP BY 1""")
def e7(t):
    changed = ev.flip_bits(scored(t), SEED, 1)
    done = ev.score(changed, ev.ones_count).groupBy("deme").agg(F.count("*").alias("n"), F.sum("fitness").alias("total"))
    return done.join(ev.unscored_count(changed), "deme")


FIGURES = """count(*) AS n, min(fitness) AS worst, max(fitness) AS best, round(avg(fitness), 3) AS mean"""


@query("e8_generation_statistics", with_(*SCORED) + f"SELECT deme, {FIGURES} FROM scored GROUP BY 1")
def e8(t):
    return ev.statistics(scored(t)).drop("deviation")


@query("e9_deviation_from_moments", with_(*SCORED) + """
SELECT deme, round(sqrt(abs(avg(fitness * fitness) - avg(fitness) * avg(fitness))), 6) AS deviation,
       round(stddev_pop(fitness), 6) AS built_in FROM scored GROUP BY 1""")
def e9(t):
    rows = scored(t)
    built_in = rows.groupBy("deme").agg(F.round(F.stddev_pop("fitness"), 6).alias("built_in"))
    moments = ev.statistics(rows).select("deme", F.round("deviation", 6).alias("deviation"))
    return moments.join(built_in, "deme")


@query("e10_roulette_statistics", with_(pop_sql(1, 255), scored_sql("pop", "scored", CLOSE)) + """
SELECT deme, sum(fitness) AS total, round(sum(fitness) / count(*), 6) AS average, greatest(max(fitness), 0.0) AS best FROM scored GROUP BY 1""")
def e10(t):
    rows = ev.score(ev.random_population(ids(t), L, SEED, 1, 255), lambda g: ev.closeness(g, TARGET))
    found = ev.roulette_statistics(rows)
    return found.select("deme", "total", F.round("average", 6).alias("average"), "best")


@query("e11_progress_report", with_(pop_sql(32, 122), scored_sql("pop", "scored", CLOSE), place_sql("scored", "placed")) + """
SELECT deme, max(fitness) AS best, round(avg(fitness), 3) AS mean, min(fitness) AS worst,
       max(CASE WHEN place = 1 THEN array_to_string([chr(greatest(1, least(g, 255))) for g in genes], '') END) AS best_text,
       CAST(10 AS INTEGER) AS generation FROM placed GROUP BY 1""")
def e11(t):
    rows = materialize(ev.score(ev.random_population(ids(t), L, SEED, 32, 122), lambda g: ev.closeness(g, TARGET)))
    assert ev.progress_report(rows, 7) is None
    return ev.progress_report(rows, 10)


@query("e12_roulette_selection", with_(*SCORED, roulette_sql("scored", "sel", 1)) + "SELECT deme, slot, ind_id, fitness FROM sel")
def e12(t):
    return ev.roulette(scored(t), SEED, 1).select("deme", "slot", "ind_id", "fitness")


@query("r7_weighted_draw", with_(*SCORED, roulette_sql("scored", "sel", 2)) + """
SELECT deme, ind_id, count(*) AS times FROM sel GROUP BY 1, 2""")
def r7(t):
    return ev.roulette(scored(t), SEED, 2).groupBy("deme", "ind_id").agg(F.count("*").alias("times"))


@query("e13_tournament_of_three", with_(*SCORED, tournament_sql("scored", "sel", 1)) + "SELECT deme, slot, ind_id, fitness FROM sel")
def e13(t):
    return ev.tournament(scored(t), 3, SEED, 1).select("deme", "slot", "ind_id", "fitness")


@query("e14_tournament_parents", with_(*SCORED, parents_sql("scored", "sel", 1)) + "SELECT deme, pair_id, a_id, b_id FROM sel")
def e14(t):
    return ev.tournament_parents(scored(t), SEED, 1).select(
        "deme", "pair_id", F.col("a.ind_id").alias("a_id"), F.col("b.ind_id").alias("b_id")
    )


@query("e15_sorted_mating", with_(*SCORED, """
asc_rank AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY fitness, ind_id) AS rn FROM scored)""",
    pairs_sql("asc_rank", "pairs")) + "SELECT deme, pair_id, a_id, b_id FROM pairs")
def e15(t):
    return ev.sorted_pairs(scored(t)).select(
        "deme", "pair_id", F.col("a.ind_id").alias("a_id"), F.col("b.ind_id").alias("b_id")
    )


@query("e16_elitism", with_(*SCORED, place_sql("scored", "placed"), """
rest AS (SELECT deme, ind_id, genes, fitness FROM placed WHERE place > 4)""", shuffle_sql("rest", "sh", 1)) + """
SELECT deme, 'elite' AS kind, place AS at, fitness FROM placed WHERE place <= 4
UNION ALL SELECT deme, 'rest', rn, fitness FROM sh""")
def e16(t):
    top, rest = ev.elite_and_rest(scored(t), 4)
    mixed = ev.shuffled(rest, SEED, 1)
    return top.select("deme", F.lit("elite").alias("kind"), F.col("ind_id").alias("at"), "fitness").unionByName(
        mixed.select("deme", F.lit("rest").alias("kind"), F.col("rn").alias("at"), "fitness")
    )


@query("e17_clone", with_(*SCORED, tournament_sql("scored", "sel", 3), as_pop_sql("sel", "clones")) + show("clones"))
def e17(t):
    return shown(ev.as_population(ev.tournament(scored(t), 3, SEED, 3)))


SHUFFLED = (*SCORED, shuffle_sql("scored", "sh", 1))


def shuffled(t):
    return ev.shuffled(scored(t), SEED, 1)


@query("e18_adjacent_pairs", with_(*SHUFFLED, pairs_sql("sh", "pairs")) + "SELECT deme, pair_id, a_id, b_id FROM pairs")
def e18(t):
    return ev.pairs_by(shuffled(t)).select(
        "deme", "pair_id", F.col("a.ind_id").alias("a_id"), F.col("b.ind_id").alias("b_id")
    )


SLIDING = """sliding AS (SELECT * FROM (SELECT deme, rn - 1 AS pair_id, ind_id AS a_id, genes AS a_genes, fitness AS a_fit,
  lead(ind_id) OVER w AS b_id, lead(genes) OVER w AS b_genes, lead(fitness) OVER w AS b_fit
  FROM sh WINDOW w AS (PARTITION BY deme ORDER BY rn)) WHERE b_id IS NOT NULL)"""


@query("e19_sliding_mating", with_(*SCORED, place_sql("scored", "placed"), """
rest AS (SELECT deme, ind_id, genes, fitness FROM placed WHERE place > 4)""", shuffle_sql("rest", "sh", 1), SLIDING,
    two_point_sql("sliding", "kids", 1), shuffle_sql("kids", "mixed", 1, SEED + 1), """
sizes AS (SELECT deme, count(*) AS n FROM scored GROUP BY 1)""", """
fit AS (SELECT m.deme, m.rn + 4 AS ind_id, m.genes, m.fitness FROM mixed m JOIN sizes USING (deme) WHERE m.rn + 4 <= n)""",
    resample_sql("fit", "mut", 1)) + """
SELECT deme, place AS ind_id, array_to_string(genes, ',') AS genes, fitness FROM placed WHERE place <= 4
UNION ALL SELECT deme, ind_id, array_to_string(genes, ','), fitness FROM mut""")
def e19(t):
    return shown(ev.sliding_generation(scored(t), SEED, 1, 4))


PAIRED = (*SHUFFLED, pairs_sql("sh", "pairs"))


def pairs(t):
    return materialize(ev.pairs_by(shuffled(t)))


@query("e20_two_point_crossover", with_(*PAIRED, two_point_sql("pairs", "kids", 1)) + show("kids"))
def e20(t):
    return shown(ev.two_point(pairs(t), SEED, 1))


@query("e21_interior_crossover", with_(*PAIRED, interior_sql("pairs", "kids", 1, "true")) + show("kids"))
def e21(t):
    return shown(ev.two_point_interior(pairs(t), SEED, 1))


@query("e22_mate_with_probability", with_(*PAIRED, distinct_sql("pairs", "kids", 1, gate_sql(1, 0.5))) + show("kids"))
def e22(t):
    return shown(ev.two_point_distinct(pairs(t), SEED, 1, 0.5))


ONE_GATE = f"{unit_sql('1', chr(39) + 'cross' + chr(39), 'deme', 'b_id')} < 0.75"
ONE_CUT = f"{pair_draw(1, 'cut1')} % {L}"


@query("e23_one_point_crossover", with_(*PAIRED, children_sql("pairs", "kids", ONE_CUT, f"{L}", ONE_GATE)) + show("kids"))
def e23(t):
    return shown(ev.one_point(pairs(t), SEED, 1, 0.75))


@query("e23_one_point_rotating", with_(*PAIRED, children_sql("pairs", "kids", ONE_CUT, f"{L}", ONE_GATE)) + f"""
SELECT deme, 2 * pair_id + 1 AS ind_id, array_to_string(CASE WHEN x THEN a_genes[1:f] || b_genes[f + 1:] ELSE a_genes END, ',') AS genes,
       CASE WHEN NOT x THEN a_fit END AS fitness FROM kids_2
UNION ALL SELECT deme, 2 * pair_id + 2, array_to_string(CASE WHEN x THEN a_genes[f + 1:] || b_genes[1:f] ELSE b_genes END, ','),
       CASE WHEN NOT x THEN b_fit END FROM kids_2 WHERE b_genes IS NOT NULL""")
def e23_rotating(t):
    return shown(ev.one_point(pairs(t), SEED, 1, 0.75, rotate_second=True))


@query("e24_gated_generation", with_(*SCORED, parents_sql("scored", "par", 1), interior_sql("par", "kids", 1, gate_sql(1, 0.5)),
    creep_sql("kids", "mut", 1), "sizes AS (SELECT deme, count(*) AS n FROM scored GROUP BY 1)",
    "nexts AS (SELECT m.* FROM mut m JOIN sizes USING (deme) WHERE ind_id <= n)") + show("nexts"))
def e24(t):
    return shown(ev.creeping_generation(scored(t), SEED, 1))


@query("e25_bit_flips", with_(*SCORED, flip_sql("scored", "mut", 1)) + show("mut"))
def e25(t):
    return shown(ev.flip_bits(scored(t), SEED, 1))


@query("e26_single_bit_flip", with_(*SCORED, flip_one_sql("scored", "mut", 1)) + show("mut"))
def e26(t):
    return shown(ev.flip_one_bit(scored(t), SEED, 1))


@query("e27_gene_resampling", with_(*SCORED, resample_sql("scored", "mut", 1)) + show("mut"))
def e27(t):
    return shown(ev.resample_genes(scored(t), SEED, 1))


@query("e28_integer_creep", with_(pop_sql(1, 255), scored_sql("pop", "scored", CLOSE), creep_sql("scored", "mut", 1)) + show("mut"))
def e28(t):
    rows = ev.score(ev.random_population(ids(t), L, SEED, 1, 255), lambda g: ev.closeness(g, TARGET))
    return shown(ev.creep(rows, SEED, 1))


@query("e29_replacement", with_(*SCORED, elitist_sql("scored", "g1", 1, 4)) + show("g1"))
def e29(t):
    return shown(ev.elitist_generation(scored(t), SEED, 1, 4))


@query("e30_two_generations", with_(
    POP, scored_sql("pop", "s0", ONES), elitist_sql("s0", "g0", 0, 4), scored_sql("g0", "s1", ONES),
    elitist_sql("s1", "g1", 1, 4), scored_sql("g1", "s2", ONES)) + show("s2"))
def e30(t):
    step = partial(ev.elitist_generation, elite=4)
    run = ev.evolve(population(t), ev.ones_count, step, SEED, 2, target=float(L + 1))
    return shown(run.population)


@query("e30_tournament_search", with_(
    POP, scored_sql("pop", "s0", ONES), tournament_sql("s0", "t0", 0), as_pop_sql("t0", "c0"), pairs_sql("c0", "p0", "ind_id"),
    distinct_sql("p0", "k0", 0, gate_sql(0, 0.5)), flip_sql("k0", "g0", 0), scored_sql("g0", "s1", ONES)) + show("s1"))
def e30_tournament(t):
    return shown(ev.evolve(population(t), ev.ones_count, ev.tournament_generation, SEED, 1).population)


@query("e30_roulette_search", with_(
    POP, scored_sql("pop", "s0", ONES), roulette_sql("s0", "t0", 0), as_pop_sql("t0", "c0"), pairs_sql("c0", "p0", "ind_id"),
    children_sql("p0", "k0", f"{pair_draw(0, 'cut1')} % {L}", f"{L}",
                 f"{unit_sql('0', chr(39) + 'cross' + chr(39), 'deme', 'b_id')} < 0.75"),
    flip_one_sql("k0", "g0", 0), scored_sql("g0", "s1", ONES)) + show("s1"))
def e30_roulette(t):
    return shown(ev.evolve(population(t), ev.ones_count, ev.roulette_generation, SEED, 1).population)


def search_sql(generations: int, target: float) -> str:
    """Best fitness of every generation, and each deme's first that reaches the target."""
    steps = [POP, scored_sql("pop", "s0", ONES)]
    for g in range(generations):
        steps += [elitist_sql(f"s{g}", f"g{g}", g, 4), scored_sql(f"g{g}", f"s{g + 1}", ONES)]
    # without this every later generation computes all earlier ones again
    stored = re.sub(r"\b(s\d+|pop) AS \(", r"\1 AS MATERIALIZED (", with_(*steps))
    best = " UNION ALL ".join(f"SELECT *, {g} AS generation FROM s{g}" for g in range(generations + 1))
    return f"""{stored}, steps AS ({best}), firsts AS (
  SELECT deme, min(generation) AS generation FROM (SELECT deme, generation FROM steps GROUP BY ALL HAVING max(fitness) >= {target}) GROUP BY deme)
SELECT deme, ind_id, array_to_string(genes, ',') AS genes, fitness, generation, true AS reached FROM steps JOIN firsts USING (deme, generation)"""


# a share of ones that every nation reaches within 100 generations, most after some
REACHABLE = 17.0


@query("e30_search_to_target", search_sql(10, REACHABLE))
def e30_to_target(t):
    store = ev.GenerationStore(t.spark, scratch_path(t.spark, "search"))
    found = ev.search(population(t), ev.ones_count, partial(ev.elitist_generation, elite=4), SEED, 100, REACHABLE, store)
    return found.select("deme", "ind_id", F.array_join("genes", ",").alias("genes"), "fitness", "generation", "reached")


@query("s26_metric_log", with_(
    POP, scored_sql("pop", "s0", ONES), elitist_sql("s0", "g0", 0, 4), scored_sql("g0", "s1", ONES)) + """
SELECT 'first' AS run, CAST(0 AS INTEGER) AS generation, count(*) AS n, max(fitness) AS best, min(fitness) AS worst, round(avg(fitness), 6) AS mean FROM s0
UNION ALL SELECT 'first', 1, count(*), max(fitness), min(fitness), round(avg(fitness), 6) FROM s1""")
def s26(t):
    log = scratch_path(t.spark, "metrics")

    def logged(scored, generation):
        figures = scored.agg(
            F.count("*").alias("n"), F.max("fitness").alias("best"), F.min("fitness").alias("worst"), F.round(F.avg("fitness"), 6).alias("mean")
        )
        # every generation is logged twice, as after a retry: the log holds it once
        for _ in range(2):
            append_metrics(figures, log, "first", generation)

    ev.evolve(population(t), ev.ones_count, partial(ev.elitist_generation, elite=4), SEED, 1, on_generation=logged)
    return read_metrics(t.spark, log)


@query("e31_best_report", with_(*SCORED, place_sql("scored", "placed")) + show("placed") + " WHERE place = 1")
def e31(t):
    return shown(ev.best(scored(t)))


@query("e32_opaque_evaluator", with_(POP) + f"SELECT deme, ind_id, {ONES} AS fitness FROM pop")
def e32(t):
    return ev.score(population(t), ev.opaque_fitness(sum)).select("deme", "ind_id", "fitness")


@query("d1_user_function", with_(POP) + """
SELECT deme, ind_id, CAST(list_sum([genes[i] * i for i in range(1, len(genes) + 1)]) AS DOUBLE) AS weight FROM pop""")
def d1(t):
    weigh = ev.opaque_fitness(lambda genes: sum(g * (i + 1) for i, g in enumerate(genes)))
    return population(t).select("deme", "ind_id", weigh(F.col("genes")).alias("weight"))


class CountingSearch(ev.Genetics):
    """A user's search: maximise ones with the default parents and no mutation."""

    def __init__(self, t):
        self.t = t

    def initial(self):
        return population(self.t)

    def fitness(self, genes):
        return ev.ones_count(genes)

    def crossover(self, pairs, seed, generation):
        return ev.two_point(pairs, seed, generation)

    def finished(self, history):
        return len(history) > 1


@query("d4_strategy_interface", with_(*SCORED, """
asc_rank AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY fitness, ind_id) AS rn FROM scored)""",
    pairs_sql("asc_rank", "pairs"), two_point_sql("pairs", "kids", 0), scored_sql("kids", "s1", ONES)) + show("s1"))
def d4(t):
    return shown(ev.run_genetics(CountingSearch(t), SEED, 5).population)


class GuessingSearch(ev.Genetics):
    """A user's search that says everything itself: closeness to a text, best with next best, one cut, one gene moved."""

    def __init__(self, t):
        self.t = t

    def initial(self):
        return ev.random_population(ids(self.t), L, SEED, 1, 255)

    def fitness(self, genes):
        return ev.closeness(genes, TARGET)

    def probability_crossover(self):
        return 0.6

    def probability_mutation(self):
        return 0.3

    def parents(self, scored, seed, generation):
        return ev.pairs_by(ev.ranked(scored, "rn"))

    def crossover(self, pairs, seed, generation):
        return ev.one_point(pairs, seed, generation, 1.0)

    def mutation(self, children, seed, generation):
        return ev.creep(children, seed, generation, 1.0)

    def finished(self, history):
        return len(history) > 2


def guessing_sql(source: str, name: str, gen: int) -> str:
    gene = f"CASE WHEN i = {who_draw(gen, 'locus')} % {L} THEN genes[i + 1] + {who_draw(gen, 'step')} % 11 - 5 ELSE genes[i + 1] END"
    return ",\n".join([
        f"{name}_k AS (SELECT *, row_number() OVER (PARTITION BY deme ORDER BY fitness DESC, ind_id) AS rn FROM {source})",
        pairs_sql(f"{name}_k", f"{name}_p"),
        children_sql(f"{name}_p", f"{name}_c", f"{pair_draw(gen, 'cut1')} % {L}", f"{L}", gate_sql(gen, 0.6)),
        mutate_sql(f"{name}_c", f"{name}_m", f"{who_unit(gen, 'mutate')} < 0.3", gene),
        f"""{name} AS (SELECT m.* FROM {name}_m m JOIN (SELECT deme, count(*) AS n FROM {source} GROUP BY deme) USING (deme)
  WHERE ind_id <= n)""",
    ])


@query("d4_all_hooks", with_(
    pop_sql(1, 255), scored_sql("pop", "s0", CLOSE), guessing_sql("s0", "g0", 0), scored_sql("g0", "s1", CLOSE),
    guessing_sql("s1", "g1", 1), scored_sql("g1", "s2", CLOSE)) + show("s2"))
def d4_all_hooks(t):
    return shown(ev.run_genetics(GuessingSearch(t), SEED, 50).population)


@query("d5_toolbox", with_(*SCORED, tournament_sql("scored", "sel", 1), as_pop_sql("sel", "c"), flip_sql("c", "mut", 1)) + show("mut"))
def d5(t):
    box = ev.Toolbox()
    box.register("evaluate", ev.score, fitness=ev.ones_count)
    box.register("select", ev.tournament, rounds=3, seed=SEED)
    box.register("mutate", ev.flip_bits, seed=SEED, p_gene=0.05)
    rows = materialize(box.evaluate(population(t)))
    return shown(box.mutate(ev.as_population(box.select(rows, generation=1)), generation=1))


@query("d6_partial_application", """
SELECT p_partkey, p_retailprice * 1.1 + 5 AS price, upper(p_name) AS name FROM part""")
def d6(t):
    def scaled(factor, shift):
        return lambda c: c * factor + shift

    raise_price = scaled(1.1, 5)
    shout = partial(tx.clean, steps=(F.upper,))
    return t.part.select("p_partkey", raise_price(F.col("p_retailprice")).alias("price"), shout(F.col("p_name")).alias("name"))
