"""Loading, joining and shaping of interaction pairs.

Dimension tables (domain, protein) are joined by plain equi-joins: the planner
broadcasts them while their size allows, and shuffles them beyond that.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of one task of a join or a sum by key: a hash map of as many stays in the low hundreds of MB.
TASK_ROWS = 1_000_000


def task_count(spark: SparkSession, rows: int) -> int | None:
    """Tasks for so many rows; None where the planner's own partitions are small enough."""
    n = -(-rows // TASK_ROWS)
    least = min(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return None if n <= least else n


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys over a task for each TASK_ROWS of rows, which is about its size; few rows are left to the planner.

    The planner has a fixed number of partitions and only merges them, so a task's hash map would grow with the table.
    """
    n = task_count(df.sparkSession, rows)
    return df if n is None else df.repartition(n, *keys)


def shared_keys(rows: DataFrame, key: str, member: str, size: int) -> DataFrame:
    """a < b and score: how many key two members share. size: about how many rows there are."""
    own = dealt(rows.select(F.col(key).alias("k"), F.col(member).alias("a")), size, "k")
    both = own.join(own.withColumnRenamed("a", "b"), "k").filter("a < b").select("a", "b")
    return dealt(both, 2 * size, "a", "b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("score"))


def extract_ddi(ddi: DataFrame, relevant_only: bool) -> DataFrame:
    """domain_1, domain_2, interaction of a domain_domain_interaction table.

    relevant_only: as for a database directory; a single file isn't filtered.
    """
    rows = ddi.filter(F.col("is_evaluation_relevant").cast("boolean")) if relevant_only and "is_evaluation_relevant" in ddi.columns else ddi
    return rows.select(F.col("domain_id_a").alias("domain_1"), F.col("domain_id_b").alias("domain_2"), negated("negative").cast("int").alias("interaction"))


def negated(column: str) -> Column:
    """NOT column, null for null."""
    return ~F.col(column).cast("boolean")


def filled_int(column: str) -> Column:
    return F.coalesce(F.col(column).cast("int"), F.lit(0))


def canonical(df: DataFrame, a: str, b: str) -> DataFrame:
    """The pair's smaller end in a, its larger in b."""
    return df.withColumns({a: F.least(a, b), b: F.greatest(a, b)})


def symmetrised(df: DataFrame, a: str, b: str) -> DataFrame:
    """Both orientations of each pair, once each."""
    other = [c for c in df.columns if c not in (a, b)]
    both = F.explode(F.array(F.struct(F.col(a).alias("a"), F.col(b).alias("b")), F.struct(F.col(b).alias("a"), F.col(a).alias("b"))))
    return df.select(*other, both.alias("_p")).select(F.col("_p.a").alias(a), F.col("_p.b").alias(b), *other).distinct()


def load_ddi(ddi: DataFrame, domain: DataFrame) -> DataFrame:
    """domain_a <= domain_b by accession, interaction and eval_relevant as 0 or 1."""
    one = domain.select(F.col("id").alias("_a"), F.col("pfam_id").alias("domain_a"))
    two = domain.select(F.col("id").alias("_b"), F.col("pfam_id").alias("domain_b"))
    relevant = filled_int("is_evaluation_relevant") if "is_evaluation_relevant" in ddi.columns else F.lit(0)
    rows = ddi.withColumn("interaction", F.coalesce(negated("negative").cast("int"), F.lit(0))).withColumn("eval_relevant", relevant)
    joined = rows.join(one, F.col("domain_id_a") == F.col("_a")).join(two, F.col("domain_id_b") == F.col("_b"))
    return canonical(joined.select("domain_a", "domain_b", "interaction", "eval_relevant"), "domain_a", "domain_b")


def load_protein_domains(mapping: DataFrame, domain: DataFrame, protein: DataFrame) -> DataFrame:
    rows = mapping.select("domain_id", "protein_id").join(domain.select(F.col("id").alias("domain_id"), "pfam_id"), "domain_id")
    return rows.join(protein.select(F.col("id").alias("protein_id"), "uniprot_id"), "protein_id").select("uniprot_id", "pfam_id")


def load_ppi(ppi: DataFrame, protein: DataFrame, least_score: int | None = None) -> DataFrame:
    """protein_a, protein_b and score; the score filter comes first, so it reaches the source."""
    rows = ppi if least_score is None else ppi.filter(F.col("score") > least_score)
    one = protein.select(F.col("id").alias("protein_id_a"), F.col("uniprot_id").alias("protein_a"))
    two = protein.select(F.col("id").alias("protein_id_b"), F.col("uniprot_id").alias("protein_b"))
    return rows.join(one, "protein_id_a").join(two, "protein_id_b").select("protein_a", "protein_b", "score")


def load_go(terms: DataFrame, protein: DataFrame) -> DataFrame:
    return terms.join(protein.select(F.col("id").alias("protein_id"), "uniprot_id"), "protein_id").select("uniprot_id", F.col("go_accession").alias("go"))


def load_residues(mapping: DataFrame, protein: DataFrame, blob: str) -> DataFrame:
    """The residue blob of each mapped protein, where there is one."""
    rows = protein.filter(F.col(blob).isNotNull()).select(F.col("id").alias("protein_id"), blob)
    return mapping.select("domain_id", "protein_id", "start_pos", "end_pos").join(rows, "protein_id")


def members(df: DataFrame, *columns: str, name: str = "protein") -> DataFrame:
    """The distinct values of some columns, as one column."""
    parts = [df.select(F.col(c).alias(name)) for c in columns]
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()


def within(df: DataFrame, allowed: DataFrame, *columns: str) -> DataFrame:
    """Rows of df all of whose columns hold a value of the one-column frame allowed."""
    key = allowed.columns[0]
    for c in columns:
        df = df.join(allowed.select(F.col(key).alias(c)), c, "left_semi")
    return df


def reduce_for_graph(ddi: DataFrame, pd: DataFrame, ppi: DataFrame, go: DataFrame | None, ontology_terms: DataFrame | None, least_score: int = 900) -> dict[str, DataFrame]:
    """The semi-join cascade of the graph models; without go the short one of the parsimony model.

    ppi by score; go to ontology terms and to proteins of those ppi; ppi to
    proteins with go; protein domains to proteins of those ppi; ddi to domains
    of those. go isn't reduced again after the ppi shrink.
    """
    ppi = ppi.filter(F.col("score") > least_score)
    proteins = members(ppi, "protein_a", "protein_b")
    if go is not None:
        go = go.join(ontology_terms.select("go").distinct(), "go", "left_semi")
        go = within(go, proteins.withColumnRenamed("protein", "uniprot_id"), "uniprot_id")
        ppi = within(ppi, go.select(F.col("uniprot_id").alias("protein")).distinct(), "protein_a", "protein_b")
        proteins = members(ppi, "protein_a", "protein_b")
    pd = within(pd, proteins.withColumnRenamed("protein", "uniprot_id"), "uniprot_id")
    ddi = within(ddi, pd.select(F.col("pfam_id").alias("d")).distinct(), "domain_a", "domain_b")
    return {"ppi": ppi, "go": go, "pd": pd, "ddi": ddi.distinct()}


def domain_pairs_of_ppi(ppi: DataFrame, pd: DataFrame) -> DataFrame:
    """protein_a, protein_b, d1, d2: every domain pair that a ppi may stand on."""
    one = pd.select(F.col("uniprot_id").alias("protein_a"), F.col("pfam_id").alias("d1"))
    two = pd.select(F.col("uniprot_id").alias("protein_b"), F.col("pfam_id").alias("d2"))
    return ppi.select("protein_a", "protein_b").join(one, "protein_a").join(two, "protein_b")


def witnesses(pairs: DataFrame, expanded: DataFrame) -> DataFrame:
    """domain_a, domain_b and how many ppi show the pair in this orientation (0 where none)."""
    counts = expanded.groupBy(F.col("d1").alias("domain_a"), F.col("d2").alias("domain_b")).agg(F.count(F.lit(1)).alias("witnesses"))
    return pairs.join(counts, ["domain_a", "domain_b"], "left").fillna(0, ["witnesses"])


def association_scores(ppi: DataFrame, pd: DataFrame) -> DataFrame:
    """d1, d2, score: interacting protein pairs that show the domain pair, over the proteins with either domain."""
    both = symmetrised(ppi.select("protein_a", "protein_b").filter("protein_a != protein_b"), "protein_a", "protein_b")
    shown = domain_pairs_of_ppi(both, pd.distinct()).groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n"))
    size = pd.groupBy("pfam_id").agg(F.countDistinct("uniprot_id").alias("k"))
    joined = shown.join(size.toDF("d1", "k1"), "d1").join(size.toDF("d2", "k2"), "d2")
    return joined.select("d1", "d2", (F.col("n") / (F.col("k1") + F.col("k2"))).alias("score"))


def pair_universe(expanded: DataFrame, ddi: DataFrame, default: int = 1) -> DataFrame:
    """All domain pairs that ppi show, with the known label or a default."""
    return canonical(expanded.select(F.col("d1").alias("domain_a"), F.col("d2").alias("domain_b")), "domain_a", "domain_b").distinct().join(ddi.select("domain_a", "domain_b", "interaction"), ["domain_a", "domain_b"], "left").fillna(default, ["interaction"])


def pair_multiplicity(ddi: DataFrame) -> DataFrame:
    return ddi.groupBy("domain_a", "domain_b").agg(F.count(F.lit(1)).alias("times"))


def coordinates(pairs: DataFrame, a: str, b: str, value: Column | None = None) -> DataFrame:
    """A sparse adjacency matrix: i, j, v with nodes numbered by rank, both orientations.

    Numbers come from ranks inside ranges of nodes plus the ranges' prefix sums.
    """
    nodes = members(pairs, a, b, name="node").repartitionByRange("node").sortWithinPartitions("node").select("node", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m"))
    low = nodes.groupBy("p").agg(F.min("m").alias("m0"), F.count(F.lit(1)).alias("n"))
    from pyspark.sql import Window

    bases = low.withColumn("base", F.coalesce(F.sum("n").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # one row for each partition
    numbered = nodes.join(F.broadcast(bases.select("p", "m0", "base")), "p").select("node", (F.col("base") + F.col("m") - F.col("m0")).alias("k"))
    v = F.lit(1) if value is None else value
    rows = pairs.withColumn("v", v).join(numbered.toDF(a, "i"), a).join(numbered.toDF(b, "j"), b)
    return symmetrised(rows.select("i", "j", "v"), "i", "j")


def edge_lookup(pairs: DataFrame, edges: DataFrame, flag: str = "found") -> DataFrame:
    """pairs with flag: whether the edge is known in either orientation."""
    known = canonical(edges.toDF("_a", "_b"), "_a", "_b").distinct().withColumn("_k", F.lit(True))
    a, b = pairs.columns[:2]
    on = (F.least(a, b) == F.col("_a")) & (F.greatest(a, b) == F.col("_b"))
    return pairs.join(known, on, "left").withColumn(flag, F.coalesce("_k", F.lit(False))).drop("_a", "_b", "_k")


def subset_fixture(tables: dict[str, DataFrame], n_ddi: int = 100, n_rows: int = 150) -> dict[str, DataFrame]:
    """A small, referentially whole subset of a split, rows chosen by key so that it is repeatable.

    Half of the n_ddi pairs are positive, half negative.
    """
    ddi = tables["domain_domain_interaction"]
    order = ["domain_id_a", "domain_id_b"]
    halves = [ddi.filter(F.coalesce(F.col("negative").cast("boolean"), F.lit(False)) == F.lit(k)).orderBy(*order).limit(n_ddi // 2) for k in (False, True)]
    chosen = halves[0].unionByName(halves[1])
    domains = members(chosen, "domain_id_a", "domain_id_b", name="domain_id")
    mapping = tables["domain_protein_map"].join(domains, "domain_id", "left_semi").orderBy("domain_id", "protein_id").limit(n_rows)
    proteins = mapping.select("protein_id").distinct()
    keep = proteins.withColumnRenamed("protein_id", "p")
    return {
        "domain_domain_interaction": chosen,
        "domain": tables["domain"].join(domains.withColumnRenamed("domain_id", "id"), "id", "left_semi"),
        "domain_protein_map": mapping,
        "protein": tables["protein"].join(proteins.withColumnRenamed("protein_id", "id"), "id", "left_semi"),
        "protein_protein_interaction": within(tables["protein_protein_interaction"], keep, "protein_id_a", "protein_id_b").orderBy("protein_id_a", "protein_id_b").limit(n_rows),
        "protein_go_terms": tables["protein_go_terms"].join(proteins, "protein_id", "left_semi").orderBy("protein_id", "go_accession").limit(n_rows),
    }
