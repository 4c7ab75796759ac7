"""From labelled pairs and feature vectors to design matrices, balanced and sampled by hash."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import all_finite, hash_uniform
from .lineage import Tables
from .pairs import symmetrised


def smallest_by_hash(df: DataFrame, by: list[str], keys: list[str], most: int, seed: int) -> DataFrame:
    """At most `most` rows of each group, those of the smallest hash of their keys: the same ones on any cluster."""
    w = Window.partitionBy(*by).orderBy(F.xxhash64(F.lit(seed), *keys), *keys)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= most).drop("_r")


def downsample(pairs: DataFrame, label: str, keys: list[str], seed: int) -> DataFrame:
    """As many pairs of each class as the smaller one has.

    The larger class is cut at a hash threshold that is found by counting
    hash ranges, so neither class is sorted in one task.
    """
    rows = pairs.withColumn("_u", hash_uniform(seed, *[F.col(k) for k in keys]))
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if len(sizes) < 2:
        return pairs.limit(0)
    least = min(sizes.values())
    out = []
    for value, size in sizes.items():
        own = rows.filter(F.col(label) == F.lit(value))
        if size > least:
            own = _first_by(own, "_u", keys, least)
        out.append(own.drop("_u"))
    return reduce(lambda a, b: a.unionByName(b), out)


def _first_by(rows: DataFrame, u: str, keys: list[str], n: int) -> DataFrame:
    """The n rows of the smallest u: whole ranges below a threshold, and the rest of one narrow range."""
    lo, hi, before = 0.0, 1.0, 0
    while True:
        width = (hi - lo) / 1024
        found = rows.filter((F.col(u) >= lo) & (F.col(u) < hi)).groupBy(F.floor((F.col(u) - lo) / width).alias("b")).count().orderBy("b").collect()
        for r in found:
            if before + r["count"] >= n:
                lo, hi, inside = lo + r.b * width, lo + (r.b + 1) * width, r["count"]
                break
            before += r["count"]
        if inside <= 10_000 or width < 1e-12:
            break
    rest = rows.filter((F.col(u) >= lo) & (F.col(u) < hi)).orderBy(u, *keys).limit(n - before)
    return rows.filter(F.col(u) < lo).unionByName(rest)


def oversample(rows: DataFrame, label: str, keys: list[str], seed: int) -> DataFrame:
    """All rows, and rows of the smaller class again (by hash) until both classes have as many.

    With m rows missing of n, each row of the smaller class comes m // n more
    times, and the m % n rows of the smallest hash once more.
    """
    sizes = {r[0]: r[1] for r in rows.groupBy(label).count().collect()}
    if len(sizes) < 2:
        return rows
    value = min(sizes, key=lambda k: sizes[k])
    often, once = divmod(max(sizes.values()) - sizes[value], sizes[value])
    own = rows.filter(F.col(label) == F.lit(value))
    out = rows
    if often:
        out = out.unionByName(own.withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(often)))).drop("_k"))
    if once:
        out = out.unionByName(_first_by(own.withColumn("_u", hash_uniform(seed, *[F.col(k) for k in keys])), "_u", keys, once).drop("_u"))
    return out


def with_fold(train: DataFrame, validation: DataFrame) -> DataFrame:
    """Both as one frame with fold -1 (always training) and 0 (validation)."""
    return train.withColumn("fold", F.lit(-1)).unionByName(validation.withColumn("fold", F.lit(0)))


def domains_in_all(features: DataFrame, names: list[str]) -> DataFrame:
    """domain_id of domains that every one of the named features covers."""
    rows = features.filter(F.col("feature").isin(names)).groupBy("domain_id").agg(F.countDistinct("feature").alias("k"))
    return rows.filter(F.col("k") == len(names)).select("domain_id")


def wide_features(features: DataFrame, names: list[str]) -> DataFrame:
    """domain_id, protein_id, vec: the named features' vectors one after another, for keys that have them all.

    One aggregation instead of a join for each feature.
    """
    rows = features.filter(F.col("feature").isin(names)).groupBy("domain_id", "protein_id")
    parts = [F.max(F.when(F.col("feature") == n, F.col("vec"))).alias(f"_{k}") for k, n in enumerate(names)]
    full = rows.agg(*parts)
    for k in range(len(names)):
        full = full.filter(F.col(f"_{k}").isNotNull())
    return full.select("domain_id", "protein_id", F.concat(*(f"_{k}" for k in range(len(names)))).alias("vec"))


#: Proteins of a bucket, partners of a domain that a row lists, and slots of a bucket's table of domains.
BUCKET, PARTNERS, SLOTS = 8_192, 1_000, 64


def block_pairs(pairs: DataFrame, wide: DataFrame) -> DataFrame:
    """pairs' columns, x and y: a member of domain_a and one of domain_b for each two of them, made tile by tile.

    wide: domain_id, protein_id and what else members have. Proteins are dealt to buckets by hash, so hot domains are too, and a tile is
    two buckets: it gets the members of one by their domains, with these domains' partners, and those of the other
    as a table, and makes its part of every pair of domains where it lies. What moves is
    the members, twice for each bucket, whatever the number of pairs of domains.
    """
    spark = wide.sparkSession
    tables = Tables(spark)
    own = tables.written(wide.filter("domain_id IS NOT NULL"), "wide")
    n, cores = own.count(), spark.sparkContext.defaultParallelism
    g = max(1, -(-n // BUCKET), min(n, math.ceil(math.sqrt(4 * cores))))
    member = F.struct(*(c for c in wide.columns if c != "domain_id"))
    blocks = own.groupBy(F.pmod(F.xxhash64("domain_id", "protein_id"), F.lit(g)).alias("_i"), "domain_id").agg(F.collect_list(member).alias("members"))
    blocks = tables.written(blocks, "blocks")
    times = pairs.groupBy("domain_a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("_k"))
    lists = pairs.join(times, "domain_a").groupBy("domain_a", F.pmod(F.xxhash64("domain_b"), F.col("_k")).alias("_c")).agg(F.collect_list(F.struct(*pairs.columns)).alias("partners"))

    def slot(c: str) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(SLOTS)).cast("int")

    every, tasks = F.explode(F.sequence(F.lit(0), F.lit(g - 1))), min(8 * g * g, 4_096)  # so few tiles share a task
    rows = blocks.select("_i", F.col("domain_id").alias("domain_a"), F.col("members").alias("_a")).join(lists.drop("_c"), "domain_a")
    rows = rows.select("_a", "partners", "_i", every.alias("_j")).select("_a", "partners", (F.col("_i") * g + F.col("_j")).alias("tile"))
    held = blocks.groupBy("_i", slot("domain_id").alias("slot")).agg(F.map_from_entries(F.collect_list(F.struct("domain_id", "members"))).alias("m"))
    held = held.groupBy(F.col("_i").alias("_j")).agg(F.map_from_entries(F.collect_list(F.struct("slot", "m"))).alias("held"))
    held = held.select("held", "_j", every.alias("_i")).select("held", (F.col("_i") * g + F.col("_j")).alias("tile"))
    met = rows.repartition(tasks, "tile").join(held.repartition(tasks, "tile"), "tile")
    each = met.select("_a", F.explode("partners").alias("p"), "held")
    each = each.select(*(F.col(f"p.{c}").alias(c) for c in pairs.columns), "_a", F.try_element_at(F.try_element_at("held", slot("p.domain_b")), F.col("p.domain_b")).alias("_b"))
    return each.filter("_b IS NOT NULL").select(*pairs.columns, F.explode("_a").alias("x"), "_b").select(*pairs.columns, "x", F.explode("_b").alias("y"))


def assemble(
    ddi: DataFrame, features: DataFrame, names: list[str], pair_features: DataFrame | None = None, most_per_pair: int | None = None, balance: str | None = None, both_orientations: bool = True, seed: int = 42
) -> DataFrame:
    """domain_a, domain_b, protein_a, protein_b, label, features: one row for each pair and its proteins.

    ddi: domain_1, domain_2, interaction. In order: orientations, balancing (on
    pairs, before features are looked at), domains present in every feature,
    proteins of both sides, at most most_per_pair of them by hash, vectors
    a | b | pair, and rows without NaN. Samples and listed pairs join their
    vectors last, so rows that are cut never carry any. The whole product of
    both sides is made tile by tile: see block_pairs().
    """
    pairs = ddi.select(F.col("domain_1").alias("domain_a"), F.col("domain_2").alias("domain_b"), F.col("interaction").alias("label")).distinct()
    if both_orientations:
        pairs = symmetrised(pairs, "domain_a", "domain_b").distinct()
    if balance == "downsample":
        pairs = downsample(pairs, "label", ["domain_a", "domain_b"], seed)
    present = domains_in_all(features, names)
    for c in ("domain_a", "domain_b"):
        pairs = pairs.join(present.toDF(c), c, "left_semi")
    wide = wide_features(features, names)
    if pair_features is None and most_per_pair is None:
        # a row is without NaN if both its vectors are: each is looked at once, not with every partner
        met = block_pairs(pairs, wide.filter(all_finite(F.col("vec"))))
        out = met.select("domain_a", "domain_b", F.col("x.protein_id").alias("protein_a"), F.col("y.protein_id").alias("protein_b"), "label", F.concat("x.vec", "y.vec").alias("features"))
        return oversample(out, "label", ["domain_a", "domain_b", "protein_a", "protein_b"], seed) if balance == "oversample" else out
    keys = wide.select("domain_id", "protein_id")
    chosen = pairs.join(keys.toDF("domain_a", "protein_a"), "domain_a").join(keys.toDF("domain_b", "protein_b"), "domain_b")
    if pair_features is not None:
        chosen = chosen.join(pair_features.select("domain_a", "domain_b", "protein_a", "protein_b"), ["domain_a", "domain_b", "protein_a", "protein_b"], "left_semi")
    if most_per_pair is not None:
        chosen = smallest_by_hash(chosen, ["domain_a", "domain_b", "label"], ["protein_a", "protein_b"], most_per_pair, seed)
    out = chosen.join(wide.toDF("domain_a", "protein_a", "va"), ["domain_a", "protein_a"]).join(wide.toDF("domain_b", "protein_b", "vb"), ["domain_b", "protein_b"])
    parts = ["va", "vb"]
    if pair_features is not None:
        out = out.join(pair_features.withColumnRenamed("vec", "vi"), ["domain_a", "domain_b", "protein_a", "protein_b"])
        parts.append("vi")
    out = out.select("domain_a", "domain_b", "protein_a", "protein_b", "label", F.concat(*parts).alias("features")).filter(all_finite(F.col("features")))
    return oversample(out, "label", ["domain_a", "domain_b", "protein_a", "protein_b"], seed) if balance == "oversample" else out


def class_report(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives"))


def label_conflicts(ddi: DataFrame, a: str = "domain_1", b: str = "domain_2", label: str = "interaction") -> DataFrame:
    """Pairs, in either orientation, that come with both labels."""
    return ddi.groupBy(F.least(a, b).alias("domain_a"), F.greatest(a, b).alias("domain_b")).agg(F.min(label).alias("lo"), F.max(label).alias("hi")).filter("lo != hi").select("domain_a", "domain_b")
