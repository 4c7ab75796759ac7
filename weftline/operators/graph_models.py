"""The two graph predictors end to end, and their dispatcher."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import clamp01, pw_score
from ..functions.vectors import hash_uniform
from . import graph, nullmodels
from .lineage import Tables, cut
from .pairs import domain_pairs_of_ppi, edge_lookup, members, reduce_for_graph, witnesses


@dataclass
class Split:
    """A split's loaded tables: ddi (domain_a, domain_b, interaction, eval_relevant), pd, ppi, go."""

    ddi: DataFrame
    pd: DataFrame
    ppi: DataFrame
    go: DataFrame | None = None


@dataclass
class NetworkConfig:
    """Knowledge-guided network model: grids, distance threshold, permutation control.

    optimized: a (chi-square cutoff, bicluster cutoff) that skips training.
    """

    chi_square_cutoffs: list[float] = field(default_factory=lambda: [0.1, 0.3, 0.5, 0.7, 0.9, 1.0])
    bicluster_cutoffs: list[float] = field(default_factory=lambda: [0.5, 0.6, 0.7, 0.8])
    threshold: int = 3
    permutation: bool = False
    optimized: tuple[float, float] | None = None
    least_score: int = 900
    seed: int = 42


@dataclass
class Prepared:
    ddi: DataFrame
    chi2: DataFrame
    domains: DataFrame
    n_domains: DataFrame


def prepare(split: Split, ontology: DataFrame, config: NetworkConfig) -> Prepared:
    """What doesn't depend on the grid, computed once: components of similar ppi, their statistics, term domains."""
    terms = members(ontology, "parent", "child", name="go")
    kept = reduce_for_graph(split.ddi, split.pd, split.ppi, split.go, terms, config.least_score)
    specific = graph.most_specific_terms(kept["go"], graph.term_levels(ontology))
    if config.permutation:
        lists = specific.groupBy("uniprot_id").agg(F.collect_set("go").alias("gos"))
        specific = graph.permuted(lists, "uniprot_id", "gos", config.seed).select("uniprot_id", F.explode("gos").alias("go"))
    specific = cut(specific)
    near = graph.bounded_distances(ontology, specific.select("go"), config.threshold)
    ppi = Tables(ontology.sparkSession).written(kept["ppi"].select(F.least("protein_a", "protein_b").alias("protein_a"), F.greatest("protein_a", "protein_b").alias("protein_b")).distinct(), "ppi")
    groups = graph.ppi_groups(ppi, specific, near, config.threshold)
    chi2 = cut(graph.group_chi_square(groups, kept["pd"]))
    domains = cut(graph.term_domains(specific, kept["pd"], ppi))
    return Prepared(kept["ddi"], chi2, domains, kept["pd"].agg(F.countDistinct("pfam_id").alias("n")))


def expand(prepared: Prepared, chi_square_cutoff: float, bicluster_cutoff: float) -> tuple[DataFrame, DataFrame]:
    """The best pairs of each group, and the pairs that biclusters of the term subgraphs predict."""
    best = graph.select_by_quantile(prepared.chi2, chi_square_cutoff)
    subgraphs = graph.guarded(graph.term_subgraphs(prepared.domains, best.select("d1", "d2").distinct()))
    return best, cut(graph.bicluster_pairs(subgraphs, bicluster_cutoff).select("a", "b").distinct())


def max_normalised(df: DataFrame, score: str, keys: list[str], seed: int) -> DataFrame:
    """score over its largest value (0 where that is 0), moved by a hash-drawn jitter of 1,000 machine epsilons, held to 0 and 1."""
    top = df.agg(F.max(score).alias("_top"))
    jitter = (hash_uniform(seed, *map(F.col, keys)) * 2 - 1) * (2.0**-52 * 1000)
    share = F.coalesce(F.col(score) / F.nullif("_top", F.lit(0.0)), F.lit(0.0))
    return df.crossJoin(F.broadcast(top)).withColumn(score, clamp01(share + jitter)).drop("_top")  # one row


def network_model(train: Split | None, test: Split, ontology: DataFrame, config: NetworkConfig) -> tuple[DataFrame, tuple[float, float]]:
    """Predictions for test's evaluation pairs, and the cutoffs used.

    Without optimized cutoffs the largest fold enrichment on train wins, the
    earliest of equals.
    """
    chosen, ready = config.optimized, None
    if chosen is None:
        ready = prepare(train, ontology, config)
        known = ready.ddi.filter("interaction = 1").select("domain_a", "domain_b")
        n = int(ready.n_domains.first().n)
        best = None
        for x in config.chi_square_cutoffs:
            for b in config.bicluster_cutoffs:
                fold = float(graph.fold_enrichment(expand(ready, x, b)[1], known, n).first().fold)
                if best is None or fold > best[0]:
                    best = (fold, x, b)
        chosen = (best[1], best[2])
    if ready is None or train is not test:
        ready = prepare(test, ontology, config)
    best, predicted = expand(ready, *chosen)
    scores = best.groupBy(F.least("d1", "d2").alias("domain_a"), F.greatest("d1", "d2").alias("domain_b")).agg(F.max("chi2").alias("chi2"))
    scores = max_normalised(scores, "chi2", ["domain_a", "domain_b"], config.seed)
    pairs = ready.ddi.filter("eval_relevant = 1").groupBy("domain_a", "domain_b").agg(F.max("interaction").alias("interaction"))
    flagged = edge_lookup(pairs, predicted, "hit").join(scores, ["domain_a", "domain_b"], "left")
    score = F.coalesce("chi2", F.lit(0.0))
    out = flagged.select(
        "domain_a", "domain_b", F.col("interaction").cast("byte").alias("true_interaction"), F.col("hit").cast("byte").alias("predicted_interaction"), score.cast("float").alias("predicted_probability")
    )
    return out, chosen


@dataclass
class ParsimonyConfig:
    """Set-cover model: reliabilities, candidate cutoffs, widths; optimized (reliability, cutoff) skips training."""

    reliabilities: list[float] = field(default_factory=lambda: [0.5, 0.6, 0.7, 0.8, 0.9, 1.0])
    cutoffs: list[float] = field(default_factory=lambda: [0.7, 0.8, 0.9])
    iterations: int = 1000
    runs: int = 200
    optimized: tuple[float, float] | None = None
    least_score: int = 900
    seed: int = 42


def parsimony_scores(split: Split, reliabilities: list[float], config: ParsimonyConfig) -> DataFrame:
    """reliability, domain_a, domain_b, interaction, eval_relevant, witnesses, p and pw of each known pair."""
    kept = reduce_for_graph(split.ddi, split.pd, split.ppi, None, None, config.least_score)
    pairs = kept["ddi"].groupBy("domain_a", "domain_b").agg(F.max("interaction").alias("interaction"), F.max("eval_relevant").alias("eval_relevant"))
    number = cut(nullmodels.numbered_pairs(pairs))
    ppi = cut(kept["ppi"].select("protein_a", "protein_b").distinct())
    pd_map = cut(kept["pd"].distinct())
    random_x = cut(nullmodels.random_covers(ppi, pd_map, number, config.iterations, config.seed))
    observed = nullmodels.observed_cover(ppi, pd_map, number, reliabilities, config.runs, config.seed)
    p = nullmodels.empirical_p(random_x, observed, config.iterations)
    shown = witnesses(number, domain_pairs_of_ppi(ppi, pd_map))
    rows = p.join(shown, "pair_id")
    score = F.least(F.col("p"), F.pow(1 - F.col("reliability"), F.col("witnesses")))
    return rows.select("reliability", "domain_a", "domain_b", "interaction", "eval_relevant", "witnesses", "p", score.alias("pw"))


def best_cutoff(scores: DataFrame, cutoffs: list[float], by: list[str]) -> DataFrame:
    """by, cutoff, accuracy, fp_rate: the best accuracy, then the lowest false positive share, then the lowest cutoff.

    A pair is predicted if pw <= cutoff.
    """
    rows = scores.select(*by, "interaction", "pw", F.explode(F.array(*map(F.lit, cutoffs))).alias("cutoff"))
    hit = (F.col("pw") <= F.col("cutoff")).cast("int")
    found = rows.groupBy(*by, "cutoff").agg(F.avg((hit == F.col("interaction")).cast("int")).alias("accuracy"), F.avg(((hit == 1) & (F.col("interaction") == 0)).cast("int")).alias("fp_rate"))
    best = F.max(F.struct("accuracy", (-F.col("fp_rate")).alias("f"), (-F.col("cutoff")).alias("c"))).alias("b")
    return found.groupBy(*by).agg(best).select(*by, (-F.col("b.c")).alias("cutoff"), F.col("b.accuracy").alias("accuracy"), (-F.col("b.f")).alias("fp_rate"))


def grid_winner(found: DataFrame, by: str) -> DataFrame:
    """The row of the best accuracy, then of the lowest fp_rate, then of the first `by`."""
    return found.orderBy(F.desc("accuracy"), "fp_rate", by).limit(1)


def parsimony_model(train: Split | None, test: Split, config: ParsimonyConfig) -> tuple[DataFrame, tuple[float, float]]:
    """Predictions for test's evaluation pairs, and (reliability, cutoff) used."""
    chosen = config.optimized
    if chosen is None:
        found = best_cutoff(parsimony_scores(train, config.reliabilities, config), config.cutoffs, ["reliability"])
        row = grid_winner(found, "reliability").first()
        chosen = (float(row.reliability), float(row.cutoff))
    scores = parsimony_scores(test, [chosen[0]], config).filter("eval_relevant = 1")
    out = scores.select(
        "domain_a", "domain_b", F.col("interaction").cast("byte").alias("true_interaction"), (F.col("pw") <= chosen[1]).cast("byte").alias("predicted_interaction"), (1 - F.col("pw")).cast("float").alias("predicted_probability")
    )
    return out, chosen


def pw_scores(pairs: DataFrame, reliability: float) -> DataFrame:
    """pairs (p, witnesses) with pw."""
    return pairs.withColumn("pw", pw_score(F.col("p"), reliability, F.col("witnesses")))


GRAPH_MODELS: dict[str, Callable] = {"network": network_model, "parsimony": parsimony_model}
