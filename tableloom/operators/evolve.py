"""Evolutionary search over a population table.

A population is ``(deme, ind_id, genes array<int>, fitness double)``.  ``deme``
is the island an individual breeds in; ``fitness`` is NULL until the individual
has been scored.  Steps take and return such tables.  Random choices are draws
on (seed, generation, step, deme, individual, locus), so a step gives the same
rows wherever and however often it runs.

Ranking, pairing and selection lay the rows out by range, so one large deme is
spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.functions.draws import draw, draw_below, draw_unit
from tableloom.plans.ordered import OrderedRows, numbered
from tableloom.plans.placement import well_spread
from tableloom.plans.scratch import discard, materialize, temporary
from tableloom.plans.skew import join_small

KEY = ("deme", "ind_id")


def _who() -> tuple[Column, Column]:
    return F.col("deme"), F.col("ind_id")


def _length() -> Column:
    return F.size("genes")


# ---- populations -----------------------------------------------------------


def random_population(ids: DataFrame, length: int, seed: int, low: int = 0, high: int = 1) -> DataFrame:
    """An individual of ``length`` random genes for every ``(deme, ind_id)``."""
    genes = F.transform(
        F.sequence(F.lit(0), F.lit(length - 1)),
        lambda i: (F.lit(low) + draw_below(high - low + 1, seed, "gene", *_who(), i)).cast("int"),
    )
    # ids are small and genes are heavy: a file of few splits would leave them to a few tasks
    spread = well_spread(ids.select("deme", "ind_id"))
    return spread.select("deme", "ind_id", genes.alias("genes"), F.lit(None).cast("double").alias("fitness"))


def with_given(population: DataFrame, genes: Sequence[int]) -> DataFrame:
    """Give every deme one known individual in place of its last one."""
    last = population.groupBy("deme").agg(F.max("ind_id").alias("_last"))
    given = F.array(*[F.lit(g) for g in genes])
    marked = join_small(population, last, ["deme"])
    return marked.withColumn(
        "genes", F.when(F.col("ind_id") == F.col("_last"), given).otherwise(F.col("genes"))
    ).drop("_last")


# ---- fitness ---------------------------------------------------------------


def ones_count(genes: Column) -> Column:
    return F.aggregate(genes, F.lit(0), lambda a, g: a + g).cast("double")


def ones_share(genes: Column) -> Column:
    return ones_count(genes) / F.size(genes)


def closeness(genes: Column, target: Sequence[int]) -> Column:
    """Minus the L1 distance to ``target``; 0 is a perfect match."""
    wanted = F.array(*[F.lit(int(g)) for g in target])
    gaps = F.zip_with(genes, wanted, lambda g, w: F.abs(g - w))
    return -F.aggregate(gaps, F.lit(0), lambda a, d: a + d).cast("double")


Fitness = Callable[[Column], Column]
TableFitness = Callable[[DataFrame], DataFrame]


def score(population: DataFrame, fitness: Fitness) -> DataFrame:
    """Score the individuals whose fitness is unknown."""
    return population.withColumn("fitness", F.coalesce(F.col("fitness"), fitness(F.col("genes"))))


def score_with_table(population: DataFrame, fitness: TableFitness) -> DataFrame:
    """As :func:`score`, for a fitness computed by a plan.

    ``fitness`` gets the unscored individuals and returns ``(deme, ind_id, fitness)``.
    """
    fresh = population.where("fitness is null")
    found = fitness(fresh.drop("fitness")).select(*KEY, "fitness")
    scored = fresh.drop("fitness").join(found, list(KEY), "left")
    return population.where("fitness is not null").unionByName(scored)


def opaque_fitness(fn: Callable[[list], float]) -> Fitness:
    """A plain Python evaluator, run over Arrow batches."""

    @F.pandas_udf("double")
    def evaluate(genes: pd.Series) -> pd.Series:
        return genes.map(lambda g: float(fn(list(g))))

    return evaluate


def unscored_count(population: DataFrame) -> DataFrame:
    """``(deme, n_evaluations)``: how many individuals the next scoring computes."""
    return population.groupBy("deme").agg(F.count(F.when(F.col("fitness").isNull(), 1)).alias("n_evaluations"))


# ---- statistics ------------------------------------------------------------


def statistics(population: DataFrame) -> DataFrame:
    """Per deme: size, extremes, mean to 3 decimals, deviation from the moments."""
    f = F.col("fitness")
    spread = F.sqrt(F.abs(F.avg(f * f) - F.avg(f) * F.avg(f)))
    return population.groupBy("deme").agg(
        F.count("*").alias("n"), F.min(f).alias("worst"), F.max(f).alias("best"),
        F.round(F.avg(f), 3).alias("mean"), spread.alias("deviation"),
    )


def roulette_statistics(population: DataFrame) -> DataFrame:
    """Per deme: total, average and best fitness; the best is never below 0."""
    f = F.col("fitness")
    return population.groupBy("deme").agg(
        F.sum(f).alias("total"), (F.sum(f) / F.count("*")).alias("average"),
        F.greatest(F.max(f), F.lit(0.0)).alias("best"),
    )


def best(population: DataFrame) -> DataFrame:
    """The best individual of every deme, smallest id on ties."""
    top = population.groupBy("deme").agg(
        F.min(F.struct(F.col("fitness").isNull().alias("n"), (-F.col("fitness")).alias("f"), "ind_id", "genes")).alias("_b")
    )
    return top.select(
        "deme", F.col("_b.ind_id").alias("ind_id"), F.col("_b.genes").alias("genes"), (-F.col("_b.f")).alias("fitness")
    )


def progress_report(population: DataFrame, generation: int, every: int = 10) -> DataFrame | None:
    """On every ``every``-th generation: best, mean, worst and the best genes as text."""
    if generation % every:
        return None
    figures = statistics(population).select("deme", "best", "mean", "worst")
    champion = best(population).select("deme", tx.from_codes(F.col("genes")).alias("best_text"))
    return figures.join(champion, "deme").withColumn("generation", F.lit(generation))


# ---- selection -------------------------------------------------------------


def ranked(population: DataFrame, name: str = "place") -> DataFrame:
    """Number the individuals of a deme from the best, smallest id first on ties."""
    return numbered(population, ["deme"], [F.desc("fitness"), "ind_id"], name)


def elite_and_rest(population: DataFrame, elite: int) -> tuple[DataFrame, DataFrame]:
    """The ``elite`` best of every deme, renumbered by rank, and all others."""
    placed = ranked(population)
    top = placed.where(F.col("place") <= elite).withColumn("ind_id", F.col("place")).drop("place")
    return top, placed.where(F.col("place") > elite).drop("place")


def shuffled(population: DataFrame, seed: int, generation: int, name: str = "rn") -> DataFrame:
    """Number the individuals of a deme in random order."""
    drawn = population.withColumn("_draw", draw(seed, generation, "shuffle", *_who()))
    return numbered(drawn, ["deme"], ["_draw", "ind_id"], name).drop("_draw")


def deme_sizes(population: DataFrame) -> DataFrame:
    return population.groupBy("deme").agg(F.count("*").alias("n"))


def _by_position(population: DataFrame) -> DataFrame:
    return numbered(population, ["deme"], ["ind_id"])


def tournament(population: DataFrame, rounds: int, seed: int, generation: int) -> DataFrame:
    """As many winners as individuals; each is the best of ``rounds`` random ones.

    Only id and fitness take part in the draws, genes join the winners.
    Gives ``(deme, slot, ind_id, genes, fitness)``.
    """
    light = _by_position(population.select(*KEY, "fitness"))
    slots = join_small(light.select("deme", F.col("rn").alias("slot")), deme_sizes(population), ["deme"])
    drawn = slots.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))).withColumn(
        "rn", draw_below(F.col("n"), seed, generation, "tournament", F.col("deme"), F.col("slot"), F.col("t")) + 1
    )
    met = drawn.drop("n").join(light, ["deme", "rn"])
    winners = met.groupBy("deme", "slot").agg(
        F.min(F.struct(F.col("fitness").isNull().alias("n"), (-F.col("fitness")).alias("f"), F.col("ind_id").alias("i"))).alias("_w")
    ).select("deme", "slot", F.col("_w.i").alias("ind_id"))
    return winners.join(population, list(KEY)).select("deme", "slot", "ind_id", "genes", "fitness")


def tournament_parents(population: DataFrame, seed: int, generation: int) -> DataFrame:
    """Father and mother per pair, each the better of two; the second wins ties.

    Gives ``(deme, pair_id, a, b)`` with enough pairs to refill the deme.
    """
    light = _by_position(population.select(*KEY, "fitness"))
    slots = join_small(
        light.where("rn % 2 = 1").select("deme", F.floor((F.col("rn") - 1) / 2).alias("pair_id")),
        deme_sizes(population), ["deme"],
    )
    drawn = slots.withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(3)))).withColumn(
        "rn", draw_below(F.col("n"), seed, generation, "parents", F.col("deme"), F.col("pair_id"), F.col("t")) + 1
    )
    met = drawn.drop("n").join(light, ["deme", "rn"])
    one = lambda t: F.max(F.when(F.col("t") == t, F.struct("fitness", "ind_id"))).alias(f"c{t}")
    chosen = met.groupBy("deme", "pair_id").agg(*[one(t) for t in range(4)])
    winner = lambda x, y: F.when(F.col(f"{x}.fitness") > F.col(f"{y}.fitness"), F.col(f"{x}.ind_id")).otherwise(
        F.col(f"{y}.ind_id")
    )
    sides = chosen.select(
        "deme", "pair_id", F.explode(F.array(
            F.struct(F.lit(0).alias("side"), winner("c0", "c1").alias("ind_id")),
            F.struct(F.lit(1).alias("side"), winner("c2", "c3").alias("ind_id")),
        )).alias("s"),
    ).select("deme", "pair_id", "s.side", "s.ind_id")
    return _side_by_side(sides.join(population, list(KEY)))


def roulette(population: DataFrame, seed: int, generation: int) -> DataFrame:
    """As many draws as individuals, in proportion to fitness, with replacement.

    Needs non-negative fitness with a positive total per deme.  Every individual
    owns the stretch of the running fitness sum that starts before it.  Starts
    and draw points are laid out in one order, and each point takes the latest
    start, so a much drawn individual is copied along the order and not joined.
    Gives ``(deme, slot, ind_id, genes, fitness)``.
    """
    laid = OrderedRows(population.select(*KEY, "genes", "fitness"), ["deme"], ["ind_id"])
    starts = laid.running_sum("fitness", "_cum").select(
        "deme", (F.col("_cum") - F.col("fitness")).alias("at"), F.lit(0).alias("kind"),
        F.col("ind_id").alias("tie"), F.struct("ind_id", "genes", "fitness").alias("owner"),
    )
    totals = population.groupBy("deme").agg(F.sum("fitness").alias("total"))
    points = join_small(laid.numbered("slot").select("deme", "slot"), totals, ["deme"]).select(
        "deme",
        (draw_unit(seed, generation, "roulette", F.col("deme"), F.col("slot")) * F.col("total")).alias("at"),
        F.lit(1).alias("kind"), F.col("slot").alias("tie"),
        F.lit(None).cast(starts.schema["owner"].dataType).alias("owner"),
    )
    drawn = OrderedRows(starts.unionByName(points), ["deme"], ["at", "kind", "tie"]).filled("owner", "who")
    return drawn.where("kind = 1").select("deme", F.col("tie").alias("slot"), "who.*")


def as_population(selected: DataFrame) -> DataFrame:
    """Selected rows as individuals of their own, numbered by slot."""
    return selected.select("deme", F.col("slot").alias("ind_id"), "genes", "fitness")


# ---- pairing ---------------------------------------------------------------


def _side_by_side(sides: DataFrame) -> DataFrame:
    person = F.struct("ind_id", "genes", "fitness")
    return sides.groupBy("deme", "pair_id").agg(
        F.max(F.when(F.col("side") == 0, person)).alias("a"), F.max(F.when(F.col("side") == 1, person)).alias("b")
    )


def pairs_by(numbered_population: DataFrame, name: str = "rn") -> DataFrame:
    """Positions 2k and 2k+1 become pair k: ``(deme, pair_id, a, b)``; an odd last one has no b."""
    at = F.col(name) - 1
    return _side_by_side(
        numbered_population.withColumn("pair_id", F.floor(at / 2)).withColumn("side", (at % 2).cast("int"))
    )


def sorted_pairs(population: DataFrame) -> DataFrame:
    """Worst with next worst."""
    return pairs_by(numbered(population, ["deme"], ["fitness", "ind_id"]))


def sliding_pairs(numbered_population: DataFrame, name: str = "rn") -> DataFrame:
    """Every individual with its successor: one pair fewer than individuals."""
    rows = numbered_population.withColumn("_p", F.struct("ind_id", "genes", "fitness"))
    pairs = OrderedRows(rows, ["deme"], [name]).with_next(b="_p")
    return pairs.where(F.col("b").isNotNull()).select(
        "deme", (F.col(name) - 1).alias("pair_id"), F.col("_p").alias("a"), "b"
    )


# ---- crossover -------------------------------------------------------------


def _middle_swapped(a: Column, b: Column, first: Column, second: Column) -> Column:
    """Genes of ``a`` with ``[first, second)`` from ``b``."""
    first, second, size = first.cast("int"), second.cast("int"), F.size(a)
    return F.concat(
        F.slice(a, F.lit(1), first), F.slice(b, first + 1, second - first), F.slice(a, second + 1, size - second)
    )


def _children(
    pairs: DataFrame, first: Column, second: Column, crossed: Column | None = None, offset: int = 0
) -> DataFrame:
    """Children of pairs, numbered ``offset + 2 * pair + side + 1``.

    Where ``crossed`` is false, and for a single left over, the parents pass on
    with their fitness.
    """
    both = pairs.withColumn("_f", first).withColumn("_s", second)
    cross = F.col("b").isNotNull()
    if crossed is not None:
        cross = cross & crossed
    both = both.withColumn("_x", cross)

    def child(own: str, other: str, side: int) -> Column:
        mixed = _middle_swapped(F.col(f"{own}.genes"), F.col(f"{other}.genes"), F.col("_f"), F.col("_s"))
        return F.struct(
            (2 * F.col("pair_id") + F.lit(side + 1 + offset)).alias("ind_id"),
            F.when(F.col("_x"), mixed).otherwise(F.col(f"{own}.genes")).alias("genes"),
            F.when(~F.col("_x"), F.col(f"{own}.fitness")).alias("fitness"),
        )

    pair = F.array(child("a", "b", 0), child("b", "a", 1))
    offspring = both.withColumn("_c", F.explode(F.filter(pair, lambda c: c["genes"].isNotNull())))
    return offspring.select("deme", "_c.*")


def _pair_draw(n: Column | int, seed: int, generation: int, step: str) -> Column:
    return draw_below(n, seed, generation, step, F.col("deme"), F.col("pair_id"))


def _size_of_pair() -> Column:
    return F.size("a.genes")


def _chance(p: float, seed: int, generation: int, step: str) -> Column | None:
    if p >= 1.0:
        return None
    return draw_unit(seed, generation, step, F.col("deme"), F.col("pair_id")) < p


def two_point(pairs: DataFrame, seed: int, generation: int, p_cross: float = 1.0, offset: int = 0) -> DataFrame:
    """Swap a segment: first cut in 0..L, second from the first cut to L."""
    first = _pair_draw(_size_of_pair() + 1, seed, generation, "cut1")
    second = F.col("_f") + _pair_draw(_size_of_pair() + 1 - F.col("_f"), seed, generation, "cut2")
    return _children(pairs, first, second, _chance(p_cross, seed, generation, "cross"), offset)


def two_point_interior(
    pairs: DataFrame, seed: int, generation: int, p_cross: float = 1.0, offset: int = 0
) -> DataFrame:
    """Swap a segment between two cuts drawn from 1..L-2."""
    one = _pair_draw(_size_of_pair() - 2, seed, generation, "cut1") + 1
    two = _pair_draw(_size_of_pair() - 2, seed, generation, "cut2") + 1
    return _children(
        pairs, F.least(one, two), F.greatest(one, two), _chance(p_cross, seed, generation, "cross"), offset
    )


def two_point_distinct(
    pairs: DataFrame, seed: int, generation: int, p_cross: float = 0.5, offset: int = 0
) -> DataFrame:
    """Swap a segment between two different cuts from 1..L, with chance ``p_cross`` per pair."""
    one = _pair_draw(_size_of_pair(), seed, generation, "cut1") + 1
    two = _pair_draw(_size_of_pair() - 1, seed, generation, "cut2") + 1
    two = F.when(two >= one, two + 1).otherwise(two)
    return _children(
        pairs, F.least(one, two), F.greatest(one, two), _chance(p_cross, seed, generation, "cross"), offset
    )


def one_point(
    pairs: DataFrame, seed: int, generation: int, p_cross: float, rotate_second: bool = False, offset: int = 0
) -> DataFrame:
    """One cut in 0..L-1 per pair; the pair crosses when the second parent's draw allows it.

    The second child is front(b) + back(a); with ``rotate_second`` it is
    back(a) + front(b), which moves loci.
    """
    cut = _pair_draw(_size_of_pair(), seed, generation, "cut1")
    gate = draw_unit(seed, generation, "cross", F.col("deme"), F.col("b.ind_id")) < p_cross
    children = _children(pairs, cut, F.size("a.genes"), gate, offset)
    if not rotate_second:
        return children
    cuts = pairs.where(gate).select(
        "deme", (2 * F.col("pair_id") + F.lit(2 + offset)).alias("ind_id"), cut.cast("int").alias("_cut")
    )
    turned = F.concat(
        F.slice("genes", F.col("_cut") + 1, F.size("genes") - F.col("_cut")), F.slice("genes", F.lit(1), F.col("_cut"))
    )
    return children.join(cuts, list(KEY), "left").withColumn(
        "genes", F.when(F.col("_cut").isNotNull(), turned).otherwise(F.col("genes"))
    ).drop("_cut")


# ---- mutation --------------------------------------------------------------


def _changed(population: DataFrame, gate: Column, genes: Column) -> DataFrame:
    return population.withColumn("_m", gate).select(
        "deme", "ind_id", F.when(F.col("_m"), genes).otherwise(F.col("genes")).alias("genes"),
        F.when(~F.col("_m"), F.col("fitness")).alias("fitness"),
    )


def flip_bits(population: DataFrame, seed: int, generation: int, p_individual: float = 0.2, p_gene: float = 0.05) -> DataFrame:
    """Flip every bit with chance ``p_gene`` in individuals drawn with ``p_individual``."""
    gate = draw_unit(seed, generation, "mutate", *_who()) < p_individual
    genes = F.transform("genes", lambda g, i: F.when(
        draw_unit(seed, generation, "flip", *_who(), i) < p_gene, 1 - g).otherwise(g))
    return _changed(population, gate, genes)


def flip_one_bit(population: DataFrame, seed: int, generation: int, p_individual: float = 0.01) -> DataFrame:
    """Flip one random bit in individuals drawn with ``p_individual``."""
    gate = draw_unit(seed, generation, "mutate", *_who()) < p_individual
    at = draw_below(_length(), seed, generation, "locus", *_who())
    genes = F.transform("genes", lambda g, i: F.when(i == at, 1 - g).otherwise(g))
    return _changed(population, gate, genes)


def resample_genes(
    population: DataFrame, seed: int, generation: int, p_individual: float = 0.2, p_gene: float = 0.05
) -> DataFrame:
    """Replace genes by random bits.  Both gates draw hundredths from 0..100, so 0.05 means 5 of 101."""
    gate = F.lit(p_individual) > draw_below(101, seed, generation, "mutate", *_who()) / 100
    genes = F.transform("genes", lambda g, i: F.when(
        F.lit(p_gene) > draw_below(101, seed, generation, "gate", *_who(), i) / 100,
        draw_below(2, seed, generation, "bit", *_who(), i).cast("int"),
    ).otherwise(g))
    return _changed(population, gate, genes)


def creep(population: DataFrame, seed: int, generation: int, p_individual: float = 0.2, reach: int = 5) -> DataFrame:
    """Move one random gene by -reach..reach in individuals drawn with ``p_individual``."""
    gate = draw_unit(seed, generation, "mutate", *_who()) < p_individual
    at = draw_below(_length(), seed, generation, "locus", *_who())
    step = (draw_below(2 * reach + 1, seed, generation, "step", *_who()) - reach).cast("int")
    genes = F.transform("genes", lambda g, i: F.when(i == at, g + step).otherwise(g))
    return _changed(population, gate, genes)


# ---- generations -----------------------------------------------------------


def truncated(population: DataFrame, sizes: DataFrame) -> DataFrame:
    """Keep the ids 1..n of every deme."""
    return join_small(population, sizes, ["deme"]).where(F.col("ind_id") <= F.col("n")).drop("n")


def elite_ids(population: DataFrame, elite: int) -> DataFrame:
    """(deme, ind_id, place) of the ``elite`` best of every deme, smallest id first on ties."""
    order = Window.partitionBy("deme").orderBy(F.desc("fitness"), "ind_id")
    # the row number is bounded, so partitions drop all but their own best before the shuffle
    return population.select(*KEY, "fitness").withColumn("place", F.row_number().over(order)).where(
        F.col("place") <= elite
    ).drop("fitness")


def elitist_generation(
    scored: DataFrame, seed: int, generation: int, elite: int, p_individual: float = 0.2, p_gene: float = 0.05,
    p_cross: float = 1.0,
) -> DataFrame:
    """Keep the elite; shuffle, pair, cross and mutate the rest.

    Ranking and shuffling move ids only; genes join their places once.
    """
    top = materialize(elite_ids(scored, elite))
    rest = scored.select(*KEY).join(top, list(KEY), "left_anti")
    at = F.col("rn") - 1
    sides = shuffled(rest, seed, generation).select(
        *KEY, F.floor(at / 2).alias("pair_id"), (at % 2).cast("int").alias("side"), F.lit(None).cast("int").alias("place")
    )
    kept = top.select(*KEY, F.lit(None).cast("bigint").alias("pair_id"), F.lit(None).cast("int").alias("side"), "place")
    placed = materialize(scored.join(sides.unionByName(kept), list(KEY)))
    top = placed.where("place is not null").select("deme", F.col("place").cast("bigint").alias("ind_id"), "genes", "fitness")
    pairs = _side_by_side(placed.where("place is null"))
    children = two_point(pairs, seed, generation, p_cross, offset=elite)
    return top.unionByName(resample_genes(children, seed, generation, p_individual, p_gene))


def sliding_generation(
    scored: DataFrame, seed: int, generation: int, elite: int, p_individual: float = 0.2, p_gene: float = 0.05
) -> DataFrame:
    """Cross all neighbours of the shuffled rest, shuffle the children and keep as many as fit."""
    top, rest = elite_and_rest(scored, elite)
    children = two_point(sliding_pairs(shuffled(rest, seed, generation)), seed, generation)
    mixed = shuffled(children, seed + 1, generation, "_rn").withColumn("ind_id", F.col("_rn") + elite).drop("_rn")
    fitting = truncated(mixed, deme_sizes(scored))
    return top.unionByName(resample_genes(fitting, seed, generation, p_individual, p_gene))


def tournament_generation(
    scored: DataFrame, seed: int, generation: int, rounds: int = 3, p_cross: float = 0.5, p_individual: float = 0.2,
    p_gene: float = 0.05,
) -> DataFrame:
    """Full replacement: tournament, pairing in slot order, crossover, bit flips."""
    chosen = as_population(tournament(scored, rounds, seed, generation))
    children = two_point_distinct(pairs_by(chosen, "ind_id"), seed, generation, p_cross)
    return flip_bits(children, seed, generation, p_individual, p_gene)


def roulette_generation(
    scored: DataFrame, seed: int, generation: int, p_cross: float = 0.75, p_individual: float = 0.01
) -> DataFrame:
    """Roulette selection, one-point crossover, single bit flips."""
    chosen = as_population(roulette(scored, seed, generation))
    children = one_point(pairs_by(chosen, "ind_id"), seed, generation, p_cross)
    return flip_one_bit(children, seed, generation, p_individual)


def creeping_generation(
    scored: DataFrame, seed: int, generation: int, p_cross: float = 0.5, p_individual: float = 0.2
) -> DataFrame:
    """Two-way tournaments, gated crossover, creep; truncated to the old size."""
    parents = tournament_parents(scored, seed, generation)
    children = two_point_interior(parents, seed, generation, p_cross)
    return truncated(creep(children, seed, generation, p_individual), deme_sizes(scored))


@dataclass
class Run:
    population: DataFrame
    generations: int
    history: list[dict] = field(default_factory=list)


Step = Callable[[DataFrame, int, int], DataFrame]


def evolve(
    population: DataFrame,
    fitness: Fitness,
    step: Step,
    seed: int,
    max_generations: int,
    target: float | None = None,
    on_generation: Callable[[DataFrame, int], None] | None = None,
) -> Run:
    """Score and step until a deme reaches ``target`` or the generations are used up.

    Each generation is written down, so its plan does not grow and a lost
    executor costs one generation at most; the one before is removed then.  What
    reaches the driver is one row of statistics.  ``on_generation`` may read the
    generation during the call.
    """

    def figures(scored: DataFrame) -> dict:
        return scored.agg(
            F.count("*").alias("n"), F.max("fitness").alias("best"), F.min("fitness").alias("worst"),
            F.avg("fitness").alias("mean"),
        ).first().asDict()

    def finished(history: list[dict]) -> bool:
        return target is not None and history[-1]["best"] >= target

    return _drive(population, fitness, step, seed, max_generations, finished, figures, on_generation)


def _drive(population, fitness, step, seed, limit, finished, figures, on_generation=None) -> Run:
    spark = population.sparkSession
    run = Run(population, 0)
    for generation in range(limit + 1):
        with temporary(spark) as kept:
            following = population if generation == 0 else step(run.population, seed, generation - 1)
            scored = materialize(score(following, fitness))
            kept.append(scored)
        if generation > 0:
            discard(run.population)
        run.population, run.generations = scored, generation
        run.history.append({"generation": generation, **figures(scored)})
        if on_generation is not None:
            on_generation(scored, generation)
        if finished(run.history):
            break
    return run


class GenerationStore:
    """Generations and figures of a run, as tables below one folder that all executors share.

    ``open/generation=<g>`` holds the individuals that go on after generation g, and is written last;
    ``stopped/generation=<g>`` those whose search ended with it, ``figures`` one row per deme.  A
    generation counts once its open part is complete.  Writing one again replaces all its parts, and
    steps give the same rows every time, so a run that broke off goes on from its last generation.
    """

    PARTS = ("figures", "stopped", "open")

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, part: str, generation: int | None = None):
        name = f"{self.folder}/{part}" + ("" if generation is None else f"/generation={generation}")
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)

    def last(self) -> int | None:
        """The last complete generation."""
        whole = self._path("open")
        files = whole.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(whole):
            return None
        found = [int(f.getPath().getName().partition("=")[2]) for f in files.listStatus(whole) if f.isDirectory()]
        done = [g for g in found if files.exists(self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self._path("open", g), "_SUCCESS"))]
        return max(done, default=None)

    def write(self, generation: int, **parts: DataFrame) -> None:
        for part in self.PARTS:
            parts[part].write.mode("overwrite").parquet(self._path(part, generation).toString())

    def read(self, part: str, generation: int | None = None) -> DataFrame:
        """A part of one generation, or of all with a column ``generation``."""
        reader = self.spark.read
        if generation is None:
            return reader.parquet(self._path(part).toString())
        return reader.parquet(self._path(part, generation).toString())

    def forget(self, generation: int) -> None:
        """Remove the open part of a generation that is no longer needed."""
        path = self._path("open", generation)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def search(
    population: DataFrame, fitness: Fitness, step: Step, seed: int, limit: int, target: float, store: GenerationStore
) -> DataFrame:
    """Breed every deme until its best reaches ``target``, at most ``limit`` generations.

    Demes that reached it leave the loop with the generation that did, the others go on.  Goes on
    where ``store`` ends, so after a broken run the same call finishes the search.  Gives the
    individuals of every deme's last generation: ``(deme, ind_id, genes, fitness, generation, reached)``.
    """
    last = store.last()
    generation = -1 if last is None else last
    while generation < limit:
        if generation >= 0:
            going = store.read("open", generation)
            if going.isEmpty():
                break
        generation += 1
        with temporary(store.spark):
            following = population if generation == 0 else step(going, seed, generation - 1)
            scored = materialize(score(following, fitness))
            figures = materialize(scored.groupBy("deme").agg(
                F.count("*").alias("n"), F.max("fitness").alias("best"), F.min("fitness").alias("worst"), F.avg("fitness").alias("mean")
            ))
            done = figures.where(F.col("best") >= target).select("deme")
            store.write(
                generation, figures=figures, stopped=scored.join(done, "deme", "left_semi"), open=scored.join(done, "deme", "left_anti")
            )
        if generation > 1:
            store.forget(generation - 2)
    stopped = store.read("stopped").withColumn("reached", F.lit(True))
    left = store.read("open", generation).withColumn("generation", F.lit(generation)).withColumn("reached", F.lit(False))
    return stopped.unionByName(left)


def metrics_table(run: Run, spark) -> DataFrame:
    """The history as a table: one row per generation."""
    return spark.createDataFrame(
        [(h["generation"], h["n"], h["best"], h["worst"], h["mean"]) for h in run.history],
        "generation int, n bigint, best double, worst double, mean double",
    )


# ---- user surface ----------------------------------------------------------


class Genetics:
    """A search in hooks from tables to tables; a user's class overrides what it needs.

    Defaults: everybody crosses, nobody mutates, parents are neighbours in the order of fitness,
    children are their parents, and the search never ends before its limit.
    """

    def initial(self) -> DataFrame:
        """The first population: (deme, ind_id, genes, fitness)."""
        raise NotImplementedError

    def fitness(self, genes: Column) -> Column:
        return F.size(genes).cast("double")

    def probability_crossover(self) -> float:
        return 1.0

    def probability_mutation(self) -> float:
        return 0.0

    def parents(self, scored: DataFrame, seed: int, generation: int) -> DataFrame:
        """Pairs (deme, pair_id, a, b) of individuals; ids of pairs count from 0."""
        return sorted_pairs(scored)

    def crossover(self, pairs: DataFrame, seed: int, generation: int) -> DataFrame:
        """Children of pairs, with ids 2 * pair_id + 1 and 2 * pair_id + 2 and no fitness unless it is known."""
        return unchanged(pairs)

    def mutation(self, children: DataFrame, seed: int, generation: int) -> DataFrame:
        """The drawn children after mutation, without fitness where genes may have changed."""
        return children

    def finished(self, history: list[dict]) -> bool:
        return False

    def next_generation(self, scored: DataFrame, seed: int, generation: int) -> DataFrame:
        """Parents, gated crossover, gated mutation, and as many children as there were individuals."""
        pairs = materialize(self.parents(scored, seed, generation))
        crosses = draw_unit(seed, generation, "cross", F.col("deme"), F.col("pair_id")) < self.probability_crossover()
        children = self.crossover(pairs.where(crosses), seed, generation).unionByName(unchanged(pairs.where(~crosses)))
        # the pairs are stored, so both branches read them and nothing before
        mutates = draw_unit(seed, generation, "mutate", *_who()) < self.probability_mutation()
        mutated = self.mutation(children.where(mutates), seed, generation).unionByName(children.where(~mutates))
        return truncated(mutated, deme_sizes(scored))


def unchanged(pairs: DataFrame) -> DataFrame:
    """The parents of pairs as their own children."""
    return _children(pairs, F.lit(0), F.lit(0), F.lit(False))


def run_genetics(genetics: Genetics, seed: int, limit: int) -> Run:
    """Drive a :class:`Genetics` until it is finished or ``limit`` generations passed."""

    def figures(scored: DataFrame) -> dict:
        return scored.agg(F.count("*").alias("n"), F.max("fitness").alias("best")).first().asDict()

    return _drive(
        genetics.initial(), genetics.fitness, genetics.next_generation, seed, limit, genetics.finished, figures
    )


class Toolbox:
    """Operators under names, with arguments bound in advance."""

    def register(self, name: str, fn: Callable, *args, **kwargs) -> None:
        setattr(self, name, partial(fn, *args, **kwargs))

    def unregister(self, name: str) -> None:
        delattr(self, name)
