"""Properties of the evolutionary operators."""

from collections import Counter
from functools import partial

import pytest
from pyspark.sql import functions as F

from tableloom.operators import evolve as ev
from tableloom.plans.scratch import materialize

L, SEED = 16, 64


@pytest.fixture(scope="module")
def scored(spark):
    """Two demes; one is five times as large as the other and has an odd size."""
    ids = spark.range(66).select((F.col("id") < 11).cast("int").alias("deme"), "id")
    ids = ids.withColumnRenamed("id", "ind_id")
    return materialize(ev.score(ev.random_population(ids, L, SEED), ev.ones_count))


def genes_of(df):
    return {(r["deme"], r["ind_id"]): list(r["genes"]) for r in df.collect()}


def test_scores_and_statistics(spark, scored):
    for r in scored.collect():
        assert r["fitness"] == sum(r["genes"]) and len(r["genes"]) == L
    stats = {r["deme"]: r for r in ev.statistics(scored).collect()}
    assert stats[0]["n"] == 55 and stats[1]["n"] == 11
    low = spark.createDataFrame([(0, 1, [0], -3.0)], "deme int, ind_id bigint, genes array<int>, fitness double")
    assert ev.roulette_statistics(low).first()["best"] == 0.0
    assert ev.closeness(F.array(F.lit(1)), [1]) is not None


def test_given_individual_is_there_once_per_deme(scored):
    given = [1] * L
    genes = ev.with_given(scored, given).groupBy("deme").agg(F.sum((F.col("genes") == F.array(*[F.lit(1)] * L)).cast("int")).alias("n"))
    assert {r["n"] for r in genes.collect()} == {1}


def crossing(name):
    return {
        "two_point": lambda p: ev.two_point(p, SEED, 1),
        "interior": lambda p: ev.two_point_interior(p, SEED, 1),
        "distinct": lambda p: ev.two_point_distinct(p, SEED, 1, 1.0),
        "one_point": lambda p: ev.one_point(p, SEED, 1, 1.0),
    }[name]


@pytest.mark.parametrize("name", ["two_point", "interior", "distinct", "one_point"])
def test_crossover_keeps_every_locus_of_a_pair(scored, name):
    pairs = materialize(ev.pairs_by(ev.shuffled(scored, SEED, 1)))
    children = genes_of(crossing(name)(pairs))
    assert len(children) == 66
    mixed = 0
    for r in pairs.collect():
        one = children[r["deme"], 2 * r["pair_id"] + 1]
        if r["b"] is None:
            assert one == list(r["a"]["genes"])
            continue
        two = children[r["deme"], 2 * r["pair_id"] + 2]
        for i in range(L):
            assert Counter([one[i], two[i]]) == Counter([r["a"]["genes"][i], r["b"]["genes"][i]])
        mixed += one != list(r["a"]["genes"])
    assert mixed > 5


def test_rotating_child_has_back_then_front(scored):
    pairs = materialize(ev.pairs_by(ev.shuffled(scored, SEED, 1)))
    plain = genes_of(ev.one_point(pairs, SEED, 1, 1.0))
    turned = genes_of(ev.one_point(pairs, SEED, 1, 1.0, rotate_second=True))
    for r in pairs.where("b is not null").collect():
        first, second = (r["deme"], 2 * r["pair_id"] + 1), (r["deme"], 2 * r["pair_id"] + 2)
        assert plain[first] == turned[first]
        a, b = list(r["a"]["genes"]), list(r["b"]["genes"])
        assert turned[second] in [a[c:] + b[:c] for c in range(L)]
        assert plain[second] in [b[:c] + a[c:] for c in range(L)]


def test_uncrossed_pairs_keep_their_fitness(scored):
    pairs = ev.pairs_by(ev.shuffled(scored, SEED, 1))
    children = ev.two_point_distinct(pairs, SEED, 1, 0.5)
    known = children.where("fitness is not null").collect()
    assert 0 < len(known) < 66
    assert all(r["fitness"] == sum(r["genes"]) for r in known)
    fresh = {r["deme"]: r["n_evaluations"] for r in ev.unscored_count(children).collect()}
    assert sum(fresh.values()) == 66 - len(known)


def test_selection_sizes_and_pressure(scored, partitions):
    assert ev.tournament(scored, 3, SEED, 1).count() == 66
    chosen = ev.roulette(scored, SEED, 1)
    assert chosen.count() == 66
    assert chosen.join(scored.select("deme", "ind_id", F.col("fitness").alias("f")), ["deme", "ind_id"]).where("f <> fitness").count() == 0
    mean = lambda df: df.agg(F.avg("fitness")).first()[0]
    assert mean(ev.tournament(scored, 3, SEED, 1)) > mean(scored)
    pairs = ev.tournament_parents(scored, SEED, 1)
    assert {r["deme"]: r["n"] for r in pairs.groupBy("deme").agg(F.count("*").alias("n")).collect()} == {0: 28, 1: 6}


def test_roulette_follows_the_running_sum(spark):
    df = spark.createDataFrame(
        [(0, 1, [1], 0.0), (0, 2, [2], 9.0), (0, 3, [3], 0.0), (0, 4, [4], 1.0)],
        "deme int, ind_id bigint, genes array<int>, fitness double",
    )
    who = Counter(r["ind_id"] for g in range(4) for r in ev.roulette(df, SEED, g).collect())
    assert set(who) <= {2, 4} and who[2] > 2 * who[4]


def test_same_generation_under_any_partitioning(spark, scored, partitions):
    got = genes_of(ev.elitist_generation(scored.repartition(partitions), SEED, 3, 4))
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert got == genes_of(ev.elitist_generation(scored, SEED, 3, 4))


@pytest.mark.parametrize("step", ["elitist", "sliding", "tournament", "roulette", "creeping"])
def test_generations_keep_the_size(scored, step):
    run = {
        "elitist": partial(ev.elitist_generation, elite=4), "sliding": partial(ev.sliding_generation, elite=4),
        "tournament": ev.tournament_generation, "roulette": ev.roulette_generation, "creeping": ev.creeping_generation,
    }[step]
    after = run(scored, SEED, 1)
    sizes = {r["deme"]: (r["n"], r["lo"], r["hi"]) for r in after.groupBy("deme").agg(
        F.countDistinct("ind_id").alias("n"), F.min("ind_id").alias("lo"), F.max("ind_id").alias("hi")).collect()}
    assert sizes == {0: (55, 1, 55), 1: (11, 1, 11)}


def test_elite_never_gets_worse_and_the_loop_stops(scored):
    run = ev.evolve(scored, ev.ones_count, partial(ev.elitist_generation, elite=4), SEED, 3)
    best = [h["best"] for h in run.history]
    assert best == sorted(best) and run.generations == 3 and len(best) == 4
    stopped = ev.evolve(scored, ev.ones_count, partial(ev.elitist_generation, elite=4), SEED, 3, target=best[0])
    assert stopped.generations == 0


def test_mutations_change_what_they_should(scored):
    before = genes_of(scored)
    flipped = genes_of(ev.flip_one_bit(scored, SEED, 1, 1.0))
    assert all(sum(a != b for a, b in zip(flipped[k], before[k])) == 1 for k in before)
    crept = genes_of(ev.creep(scored, SEED, 1, 1.0))
    assert all(sum(a != b for a, b in zip(crept[k], before[k])) <= 1 for k in before)
    assert max(abs(a - b) for k in before for a, b in zip(crept[k], before[k])) <= 5
    untouched = ev.resample_genes(scored, SEED, 1, p_individual=0.0)
    assert genes_of(untouched) == before and untouched.where("fitness is null").count() == 0
    every = genes_of(ev.flip_bits(scored, SEED, 1, 1.0, 1.1))
    assert all(every[k] == [1 - g for g in before[k]] for k in before)


def test_toolbox_binds_arguments():
    box = ev.Toolbox()
    box.register("power", pow, 2)
    assert box.power(5) == 32
    box.unregister("power")
    assert not hasattr(box, "power")


def _ids(spark, demes, size):
    return spark.range(demes * size).selectExpr(f"id % {demes} AS deme", "id AS ind_id")


def test_unknown_fitness_never_wins(spark):
    rows = [(0, i, [0], None if i % 2 else float(i)) for i in range(8)]
    population = spark.createDataFrame(rows, "deme bigint, ind_id bigint, genes array<int>, fitness double")
    won = [r for g in range(6) for r in ev.tournament(population, 3, 5, g).collect()]
    lone = [r for r in won if r.fitness is None]
    # only where all three drawn are unknown
    assert len(won) == 48 and len(lone) < 16 and ev.tournament(population, 40, 5, 0).where("fitness is null").isEmpty()


def test_search_goes_on_after_a_break(spark, tmp_path):
    first = ev.random_population(_ids(spark, 3, 40), 16, 9)
    calls = []

    def step(scored, seed, generation):
        calls.append(generation)
        if generation == 2 and calls.count(2) == 1:
            raise RuntimeError("lost")
        return ev.elitist_generation(scored, seed, generation, elite=4)

    def found(folder, broken):
        store = ev.GenerationStore(spark, str(tmp_path / folder))
        ask = lambda: ev.search(first, ev.ones_count, step, 9, 8, 12.0, store)
        if broken:
            with pytest.raises(RuntimeError):
                ask()
            assert store.last() == 2
        rows = {(r.deme, r.ind_id): (r.genes, r.fitness, r.generation, r.reached) for r in ask().collect()}
        return rows, store

    whole, store = found("broken", True)
    assert calls[:4] == [0, 1, 2, 2]
    again, _ = found("whole", False)
    assert whole == again and len(whole) == 120
    best = {}
    for (deme, _), (_, fitness, generation, reached) in whole.items():
        assert reached
        best[deme] = max(best.get(deme, (0, 0)), (fitness, generation))
    assert all(b[0] >= 12 for b in best.values())
    # figures are kept for every generation a deme took part in, older open parts are gone
    figures = store.read("figures").collect()
    assert len(figures) == sum(b[1] + 1 for b in best.values())
    assert not store._path("open", 0).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(store._path("open", 0))


def test_search_ends_at_its_limit(spark, tmp_path):
    first = ev.random_population(_ids(spark, 2, 6), 16, 9)
    store = ev.GenerationStore(spark, str(tmp_path / "limit"))
    rows = ev.search(first, ev.ones_count, lambda s, seed, g: ev.flip_bits(s, seed, g), 9, 2, 17.0, store).collect()
    assert len(rows) == 12 and {(r.generation, r.reached) for r in rows} == {(2, False)}


def test_default_hooks(spark):
    class Bare(ev.Genetics):
        def initial(self):
            return ev.random_population(_ids(spark, 2, 5), 4, 1)

    run = ev.run_genetics(Bare(), 1, 2)
    rows = run.population.collect()
    assert run.generations == 2 and len(rows) == 10 and {r.fitness for r in rows} == {4.0}
    start = sorted((r.deme, tuple(r.genes)) for r in ev.random_population(_ids(spark, 2, 5), 4, 1).collect())
    assert sorted((r.deme, tuple(r.genes)) for r in rows) == start
