"""Graph analytics over edge lists: bounded distances, components, subgraphs, biclusters, statistics."""

from __future__ import annotations

from collections import deque

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import chi_square, safe_ratio
from .lineage import Tables, cut
from .pairs import canonical, dealt, members, symmetrised, task_count
from .ranges import numbered, quantiles


def term_levels(edges: DataFrame) -> DataFrame:
    """go, level and depth of the terms that are a child of some edge; a root has no row."""
    return edges.groupBy(F.col("child").alias("go")).agg(F.min("level").alias("level"), F.max("depth").alias("depth"))


def bounded_distances(edges: DataFrame, sources: DataFrame, most: int, a: str = "parent", b: str = "child") -> DataFrame:
    """source, node and the fewest hops (0 to most) between them over undirected edges.

    sources: one column. The frontier grows by one join a hop, and only nodes
    that are new for their source go on; an absent row is out of reach.
    """
    both = symmetrised(edges.select(F.col(a).alias("src"), F.col(b).alias("dst")), "src", "dst")
    seen = sources.toDF("source").distinct().select("source", F.col("source").alias("node"), F.lit(0).alias("dist"))
    frontier = seen
    for hop in range(1, most + 1):
        step = frontier.join(both, F.col("node") == F.col("src")).select("source", F.col("dst").alias("node")).distinct()
        frontier = cut(step.join(seen, ["source", "node"], "left_anti").withColumn("dist", F.lit(hop)))
        seen = seen.unionByName(frontier)
    return seen


def most_specific_terms(go: DataFrame, levels: DataFrame, root_is_specific: bool = True) -> DataFrame:
    """uniprot_id, go: the protein's terms of the highest level, ties included.

    A term without a level (the root) counts as the highest, unless
    root_is_specific is False.
    """
    level = F.coalesce(F.col("level").cast("double"), F.lit(float("inf" if root_is_specific else "-inf")))
    ranked = go.join(levels.select("go", "level"), "go", "left").withColumn("_l", level)
    best = ranked.groupBy("uniprot_id").agg(F.max("_l").alias("_m"))
    return ranked.join(best, "uniprot_id").filter("_l = _m").select("uniprot_id", "go").distinct()


#: Proteins of a block of one set of terms.
BLOCK = 1_000


def term_sets(terms: DataFrame) -> DataFrame:
    """uniprot_id and gos, the sorted set of its terms."""
    return terms.filter("uniprot_id IS NOT NULL AND go IS NOT NULL").groupBy("uniprot_id").agg(F.array_sort(F.collect_set("go")).alias("gos"))


def set_distances(sets: DataFrame, distances: DataFrame) -> DataFrame:
    """gos_i, gos_j and dist: the least distance of a term of one set to a term of the other, for the sets that occur (column gos)."""
    kinds = sets.select("gos").distinct()
    one, two = (kinds.select(F.col("gos").alias(f"gos_{k}"), F.explode("gos").alias(end)) for k, end in (("i", "source"), ("j", "node")))
    return one.join(distances, "source").join(two, "node").groupBy("gos_i", "gos_j").agg(F.min("dist").alias("dist"))


def protein_distances(terms: DataFrame, distances: DataFrame) -> DataFrame:
    """p_i < p_j and the least distance of their terms; a shared term is distance 0, nothing is its own neighbour.

    Distances belong to sets of terms, and each protein has one set. So pairs of
    sets are summed, not pairs of proteins, and these are made where two blocks
    of proteins meet: they are never shuffled or held.
    """
    own = term_sets(terms)
    size = own.groupBy("gos").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_n"))
    placed = own.join(size, "gos").withColumn("_b", F.pmod(F.xxhash64("uniprot_id"), F.col("_n")))
    blocks = Tables(terms.sparkSession).written(placed.groupBy("gos", "_b").agg(F.collect_list("uniprot_id").alias("ps")), "blocks")
    near = set_distances(blocks, distances)
    met = near.join(blocks.toDF("gos_i", "b_i", "i"), "gos_i").join(blocks.toDF("gos_j", "b_j", "j"), "gos_j")
    spread = met.repartition(8 * terms.sparkSession.sparkContext.defaultParallelism, "gos_i", "b_i", "gos_j", "b_j")
    return spread.select(F.explode("i").alias("p_i"), "j", "dist").select("p_i", F.explode("j").alias("p_j"), "dist").filter("p_i < p_j")


def similar_ppi(ppi: DataFrame, close: DataFrame) -> DataFrame:
    """Pairs of ppi (a, b) < (c, d) with c close to a and d close to b, or c close to b and d close to a.

    An inverted index by close proteins instead of all pairs of ppi.
    """
    near = symmetrised(close.select("p_i", "p_j"), "p_i", "p_j")
    own = canonical(ppi.select("protein_a", "protein_b"), "protein_a", "protein_b").distinct()
    turned = own.select(F.col("protein_a").alias("x"), F.col("protein_b").alias("y"), "protein_a", "protein_b").unionByName(own.select(F.col("protein_b").alias("x"), F.col("protein_a").alias("y"), "protein_a", "protein_b")).distinct()
    other = own.toDF("c", "d")
    hit = turned.join(near.toDF("x", "c"), "x").join(other, "c").join(near.toDF("y", "d"), ["y", "d"], "left_semi")
    return hit.filter("struct(protein_a, protein_b) < struct(c, d)").select("protein_a", "protein_b", "c", "d").distinct()


#: Interactions of a block of one cell of similar_by_terms().
CELL = 4_096


def similar_by_terms(ppi: DataFrame, terms: DataFrame, distances: DataFrame, most: int) -> DataFrame:
    """similar_ppi() of proteins whose terms are at most so far apart: protein_a, protein_b, c, d.

    distances: in both directions, each term at 0 of itself. Being close depends on proteins' sets of terms, their kinds, so ppi, turned both
    ways, lie in cells of two kinds, and similar ones are made where blocks of two close cells meet: they
    are never shuffled or made distinct. A pair that is similar both ways is made once, as two blocks meet once.
    """
    tables = Tables(ppi.sparkSession)
    sets = tables.written(term_sets(terms), "sets")
    kinds = tables.written(numbered(sets.select("gos").distinct(), ["gos"], "kind"), "kinds")
    within = set_distances(sets, distances).filter(F.col("dist") <= most)
    near = tables.written(within.join(kinds.toDF("gos_i", "p"), "gos_i").join(kinds.toDF("gos_j", "q"), "gos_j").select("p", "q"), "near")
    own = tables.written(sets.join(kinds, "gos").select("uniprot_id", "kind"), "own")
    edges = canonical(ppi.select("protein_a", "protein_b"), "protein_a", "protein_b").distinct()
    placed = tables.written(edges.join(own.toDF("protein_a", "g"), "protein_a").join(own.toDF("protein_b", "h"), "protein_b"), "placed")
    size = placed.groupBy("g", "h").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("n"))
    cells = placed.join(size, ["g", "h"]).withColumn("k", F.pmod(F.xxhash64("protein_a", "protein_b"), F.col("n")))
    blocks = tables.written(cells.groupBy("g", "h", "k").agg(F.collect_list(F.struct("protein_a", "protein_b")).alias("ps")), "blocks")
    keys, other = blocks.select("g", "h", "k"), blocks.select("g", "h", "k").toDF("g2", "h2", "k2")
    met = [keys.join(near.toDF("g", x), "g").join(near.toDF("h", y), "h").join(other, ["g2", "h2"]) for x, y in (("g2", "h2"), ("h2", "g2"))]
    names = ["g", "h", "k", "g2", "h2", "k2"]
    met = met[0].select(*names, F.lit(1).alias("way")).unionByName(met[1].select(*names, F.lit(2).alias("way"))).groupBy(*names).agg(F.min("way").alias("first"), F.max("way").alias("last"))
    spread = tables.written(met, "met").repartition(8 * ppi.sparkSession.sparkContext.defaultParallelism, *names)
    both = spread.join(blocks, ["g", "h", "k"]).join(blocks.toDF("g2", "h2", "k2", "others"), ["g2", "h2", "k2"])
    rows = both.select("first", "last", F.explode("ps").alias("p"), "others").select("first", "last", "p", F.explode("others").alias("o"))
    straight = F.expr("first = 1 AND p.protein_a != o.protein_a AND p.protein_b != o.protein_b")
    turned = F.expr("last = 2 AND p.protein_b != o.protein_a AND p.protein_a != o.protein_b")
    kept = rows.filter((F.col("p") < F.col("o")) & (straight | turned))
    return kept.select("p.protein_a", "p.protein_b", F.col("o.protein_a").alias("c"), F.col("o.protein_b").alias("d"))


def _apart(p: Column, q: Column) -> Column:
    return (p["x"] != q["x"]) & (p["y"] != q["y"])


def ppi_groups(ppi: DataFrame, terms: DataFrame, distances: DataFrame, most: int) -> DataFrame:
    """protein_a, protein_b and group_name: the components of ppi by similar_ppi() of proteins at most so far apart, without a row for each similar pair.

    distances: source, node, dist in both directions, each term at 0 of itself,
    as bounded_distances() gives them. Being close depends on a protein's set of terms, its kind,
    but for a protein itself. So the ppi of two kinds, turned both ways, are
    cells (x, y) of a table, and cells of two tables with close kinds are linked
    where both proteins differ. A table with three cells in different rows and columns
    is one component, and any cell of a close table meets it. Other tables have
    at most two rows or columns that cover them (Koenig). A row or column of over two cells is linked
    like its first three, so cells meet these and the few cells outside such
    lines. Links grow with the cells, and with pairs of tables of close kinds; where
    nearly each protein has a kind of its own, those are all similar pairs.
    """
    tables, kind, cell = Tables(ppi.sparkSession), ["g", "h"], ["g", "h", "x", "y", "e"]
    sets = tables.written(term_sets(terms), "sets")
    kinds = tables.written(numbered(sets.select("gos").distinct(), ["gos"], "kind"), "kinds")
    within = set_distances(sets, distances).filter(F.col("dist") <= most)
    near = tables.written(within.join(kinds.toDF("gos_i", "p"), "gos_i").join(kinds.toDF("gos_j", "q"), "gos_j").select("p", "q"), "near")
    own = sets.join(kinds, "gos").select("uniprot_id", "kind")
    edges = canonical(ppi.select("protein_a", "protein_b"), "protein_a", "protein_b").distinct().select("*", F.concat_ws("|", "protein_a", "protein_b").alias("e"))
    edges = tables.written(edges, "edges")
    turned = edges.select("e", F.col("protein_a").alias("x"), F.col("protein_b").alias("y")).unionByName(edges.select("e", F.col("protein_b").alias("x"), F.col("protein_a").alias("y"))).distinct()
    cells = tables.written(turned.join(own.toDF("x", "g"), "x").join(own.toDF("y", "h"), "y").select(*cell), "cells")
    lines = {c: cells.groupBy(*kind, c).agg(F.count(F.lit(1)).alias("n")).filter("n > 2").select(*kind, c, F.lit(1).alias(f"long_{c}")) for c in "xy"}
    cells = tables.written(cells.join(lines["x"], [*kind, "x"], "left").join(lines["y"], [*kind, "y"], "left").fillna(0, ["long_x", "long_y"]).select(*cell, "long_x", "long_y"), "marked")

    size = cells.groupBy(*kind).agg(F.min("e").alias("first"), F.count_if(F.expr("long_x + long_y = 0")).alias("rest"))
    count = lines["x"].select(*kind).unionByName(lines["y"].select(*kind)).groupBy(*kind).agg(F.count(F.lit(1)).alias("lines"))
    size = size.join(count, kind, "left").fillna(0, ["lines"]).withColumn("many", F.expr("lines > 2 OR rest > 2 * (2 - lines)"))
    few = cells.filter("long_x + long_y = 0").join(size.filter("NOT many").select(*kind), kind, "left_semi").groupBy(*kind).agg(F.collect_list(F.struct("x", "y")).alias("c"))  # four at most
    two = F.exists("c", lambda p: F.exists("c", lambda q: _apart(p, q)))
    three = F.exists("c", lambda p: F.exists("c", lambda q: _apart(p, q) & F.exists("c", lambda r: _apart(p, r) & _apart(q, r))))
    found = few.select(*kind, two.alias("two"), three.alias("three"))
    one = F.expr("many OR coalesce(CASE lines WHEN 0 THEN three WHEN 1 THEN two END, false)")
    kept = tables.written(size.join(found, kind, "left").select(*kind, "first", one.alias("one")), "tables")

    close = kept.join(near.toDF("g", "g2"), "g").join(near.toDF("h", "h2"), "h").join(kept.toDF("g2", "h2", "first2", "one2"), ["g2", "h2"])
    close = tables.written(close, "close")
    joint = close.filter("one2").select(*kind, "first").distinct()  # whole tables that are in one component
    links = [close.filter("one OR one2").select("first", "first2"), cells.select(*kind, "e").join(joint, kind).select("e", "first")]
    loose = cells.join(kept.filter("NOT one").select(*kind), kind, "left_semi")
    heads = [loose.filter("long_x + long_y = 0").select(*cell)]
    for c, other in ("xy", "yx"):
        rank = F.row_number().over(Window.partitionBy(*kind, c).orderBy(other))
        heads.append(loose.filter(f"long_{c} = 1").select(*cell, rank.alias("k")).filter("k <= 3").select(*cell))
    heads = heads[0].unionByName(heads[1]).unionByName(heads[2]).distinct().toDF("g2", "h2", "x2", "y2", "e2")
    met = loose.select(*cell).join(close.filter("NOT one AND NOT one2").select("g", "h", "g2", "h2"), kind).join(heads, ["g2", "h2"])
    links.append(met.filter("x != x2 AND y != y2").select("e", "e2"))
    every = links[0].toDF("a", "b").unionByName(links[1].toDF("a", "b")).unionByName(links[2].toDF("a", "b")).filter("a != b")
    comps = connected_components(every, edges.select("e"))
    return edges.join(comps.toDF("e", "group_name"), "e").select("protein_a", "protein_b", "group_name")


def _contracted(edges: DataFrame, tables: Tables) -> list[DataFrame]:
    """The maps node -> to of rounds of contraction, until no edge is left; a node absent from a map stays what it is.

    Each round draws an order of the nodes by hash. A node points to its first
    neighbour in it, and then to where that one points; what is on both ends of
    an edge is replaced by what it points to. Falling runs in a drawn order are short
    whatever the graph, and each round leaves about a third of the edges of a
    path, so rounds grow with the logarithm of the nodes and their total work
    with the edges.
    """
    maps: list[DataFrame] = []
    while edges.head(1):
        k = len(maps)

        def drawn(c: str) -> Column:
            return F.struct(F.xxhash64(F.lit(k), F.col(c)).alias("h"), F.col(c).alias("v"))  # noqa: B023

        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        first = ends.groupBy("a").agg(F.min(drawn("b")).alias("m"))
        point = tables.written(first.select(F.col("a").alias("node"), F.least(F.col("m"), drawn("a"))["v"].alias("to")), f"point-{k}")
        ahead = point.toDF("to", "far")
        jump = tables.written(point.join(ahead, "to").select("node", F.col("far").alias("to")), f"map-{k}")
        maps.append(jump)
        moved = edges.join(jump.toDF("a", "p"), "a").join(jump.toDF("b", "q"), "b").select("p", "q")
        # where a node points to one that points on, both stay linked
        onward = jump.select(F.col("to").alias("p")).distinct().join(jump.toDF("p", "q"), "p")
        left = moved.unionByName(onward).filter("p != q").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
        edges = tables.written(left, f"edges-{k + 1}")
        tables.drop(f"point-{k}")
        tables.drop(f"edges-{k}")
    return maps


def connected_components(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """node and component (the smallest node reachable); edges are two columns, nodes adds single ones. Null ends are left out.

    Rounds are written tables: a checkpoint would keep the size that its plan
    guessed, and guesses multiply. Only joins and sums by key: no task or
    driver holds a component.
    """
    tables = Tables(edges.sparkSession)
    given = edges.toDF("a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    links = tables.written(given.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges-0")
    own = tables.written(members(links, "a", "b", name="node") if nodes is None else members(links, "a", "b", name="node").unionByName(nodes.toDF("node").filter("node IS NOT NULL")).distinct(), "nodes")
    maps = _contracted(links.filter("a != b"), tables)
    root = maps[-1] if maps else None
    for k in range(len(maps) - 2, -1, -1):
        root = tables.written(maps[k].join(root.toDF("to", "far"), "to", "left").select("node", F.coalesce("far", "to").alias("to")), f"root-{k}")
        tables.drop(f"map-{k + 1}")
        tables.drop(f"root-{k + 1}")
    if root is None:
        return own.select("node", F.col("node").alias("component"))
    least = root.groupBy("to").agg(F.min("node").alias("component"))  # a root is a member too, which points to itself
    named = tables.written(root.join(least, "to").select("node", "component"), "components")
    out = tables.written(own.join(named, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels")
    for name in ("nodes", "map-0", "root-0", "components"):
        tables.drop(name)
    return out


def group_chi_square(groups: DataFrame, pd_map: DataFrame) -> DataFrame:
    """group_name, d1, d2, a and chi2 of each domain pair that a group's ppi show.

    groups: group_name, protein_a, protein_b. With A the group's ppi that show
    the pair, T all that do, n the group's size and N all ppi: B = T - A,
    C = n - A, D = N - n - B. Three counts, no loop over ppi. A ppi is kept with its
    proteins' domains as lists, so its pairs are made where they are counted, and never held.
    """
    own = canonical(groups.select("group_name", "protein_a", "protein_b"), "protein_a", "protein_b")
    each = own.groupBy("protein_a", "protein_b").agg(F.collect_set("group_name").alias("gs"))
    lists = pd_map.filter("pfam_id IS NOT NULL").groupBy("uniprot_id").agg(F.collect_set("pfam_id").alias("ds"))
    ppi = each.join(lists.toDF("protein_a", "da"), "protein_a", "left").join(lists.toDF("protein_b", "db"), "protein_b", "left")
    ppi = Tables(groups.sparkSession).written(ppi.withColumn("both", F.array_intersect("da", "db")), "ppi")
    pairs = ppi.select("gs", "both", "db", F.explode("da").alias("d1")).select("gs", "both", "d1", F.explode("db").alias("d2"))
    # of a pair that the ppi shows in both orientations, one counts
    once = pairs.filter(F.expr("d1 <= d2 OR NOT (array_contains(both, d1) AND array_contains(both, d2))"))
    placed = canonical(once.withColumnsRenamed({"d1": "x", "d2": "y"}), "x", "y")
    a = placed.select(F.explode("gs").alias("group_name"), "x", "y").groupBy("group_name", "x", "y").agg(F.count(F.lit(1)).alias("a"))
    t = placed.groupBy("x", "y").agg(F.count(F.lit(1)).alias("t"))
    n = ppi.select(F.explode("gs").alias("group_name")).groupBy("group_name").agg(F.count(F.lit(1)).alias("n"))
    every = ppi.agg(F.count(F.lit(1)).alias("every"))
    rows = a.join(t, ["x", "y"]).join(n, "group_name").crossJoin(F.broadcast(every))  # one row
    b, c = F.col("t") - F.col("a"), F.col("n") - F.col("a")
    chi2 = chi_square(F.col("a"), b, c, F.col("every") - F.col("n") - b)
    return rows.select("group_name", F.col("x").alias("d1"), F.col("y").alias("d2"), "a", chi2.alias("chi2"))


def select_by_quantile(scores: DataFrame, cut_at: float, by: str = "group_name", value: str = "chi2") -> DataFrame:
    """Rows at or above their group's quantile: all for a cut of 0 or less, the maximum alone for 1 or more."""
    if cut_at <= 0:
        return scores
    limits = scores.groupBy(by).agg(F.max(value).alias("_limit")) if cut_at >= 1 else quantiles(scores, [by], value, [cut_at]).select(by, F.col("quantile").alias("_limit"))
    return scores.join(limits, by).filter(F.col(value) >= F.col("_limit")).drop("_limit")


def term_domains(terms: DataFrame, pd_map: DataFrame, ppi: DataFrame) -> DataFrame:
    """go, d1 (domains of the term's proteins) and d2 (domains of their partners), as sorted sets."""
    both = symmetrised(ppi.select("protein_a", "protein_b"), "protein_a", "protein_b")
    own = terms.join(pd_map, "uniprot_id").groupBy("go").agg(F.array_sort(F.collect_set("pfam_id")).alias("d1"))
    partner = terms.join(both, F.col("uniprot_id") == F.col("protein_a")).select("go", F.col("protein_b").alias("uniprot_id")).distinct()
    other = partner.join(pd_map, "uniprot_id").groupBy("go").agg(F.array_sort(F.collect_set("pfam_id")).alias("d2"))
    return own.join(other, "go")


def term_subgraphs(domains: DataFrame, edges: DataFrame) -> DataFrame:
    """go, a, b: known edges between a term's d1 and its d2, a in d1; terms without one have no row."""
    d1 = domains.select("go", F.explode("d1").alias("a"))
    d2 = domains.select("go", F.explode("d2").alias("b"))
    both = symmetrised(edges.toDF("a", "b"), "a", "b")
    return d1.join(both, "a").join(d2, ["go", "b"], "left_semi").select("go", "a", "b").distinct()


def guarded(subgraphs: DataFrame, most_nodes: int = 800, dense_nodes: int = 100, dense_ratio: float = 50.0) -> DataFrame:
    """Subgraphs without those too large, or large and dense, for biclustering."""
    edges = subgraphs.select("go", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    n = edges.select("go", F.explode(F.array("a", "b")).alias("v")).groupBy("go").agg(F.countDistinct("v").alias("nodes"))
    e = edges.groupBy("go").agg(F.count(F.lit(1)).alias("edges"))
    fit = n.join(e, "go").filter(~((F.col("nodes") > most_nodes) | ((F.col("nodes") > dense_nodes) & (F.col("edges") / F.col("nodes") > dense_ratio))))
    return subgraphs.join(fit.select("go"), "go", "left_semi")


def _bits(mask: int) -> list[int]:
    """The places of a mask's set bits."""
    out = []
    while mask:
        low = mask & -mask
        out.append(low.bit_length() - 1)
        mask ^= low
    return out


def _parted(masks: dict[int, int], rows: int, cols: int, dense: float, least: int) -> tuple[bool, list[tuple[int, int]]]:
    """Whether a block is a bicluster, and the smaller blocks that replace it if not.

    Rows are bit masks. A block that isn't dense is taken apart by its sparsest
    row that has a gap: a block of ones lies within that row's columns, or it
    has a column which the row lacks, and then only rows with such a column.
    The first part has fewer rows, the second fewer columns, so the work ends.
    """
    names, width = _bits(rows), cols.bit_count()
    if len(names) < least or width < least:
        return False, []
    own = {i: masks.get(i, 0) & cols for i in names}
    if min(m.bit_count() for m in own.values()) > dense * width and min(sum(m >> j & 1 for m in own.values()) for j in _bits(cols)) > dense * len(names):
        return True, []
    gaps = [i for i in names if own[i] != cols]
    if not gaps:
        return False, []
    inside = own[min(gaps, key=lambda i: (own[i].bit_count(), i))]
    parts = [(sum(1 << i for i in names if own[i] & needed), columns) for columns, needed in ((cols, cols & ~inside), (inside, inside))]
    return False, [(r, c) for r, c in parts if r.bit_count() >= least and c.bit_count() >= least]


#: Blocks that a task looks at before it hands the rest on, and blocks of a term that share a task.
LOOKS, SHARED = 200_000, 20_000


def _packed(mask: int) -> bytes:
    return mask.to_bytes((mask.bit_length() + 7) // 8, "little")


def biclusters(subgraphs: DataFrame, dense: float, least: int = 3) -> DataFrame:
    """go, rows, cols (arrays of nodes): the blocks of each term's adjacency matrix, least by least at least, whose row and column means all exceed dense.

    The search is a table of open blocks. In a round each task looks at up to
    LOOKS blocks, breadth first, from the SHARED that it was given, and hands on
    those that are left; the next round drops repeats, and blocks handed on in
    an earlier round, and deals the rest anew. So a term's search spreads over
    tasks as it grows, and no task holds it whole. Nodes are taken in order of
    name; a term's matrix has at most the nodes that guarded() lets through.
    """
    tables = Tables(subgraphs.sparkSession)
    links = tables.written(symmetrised(subgraphs.select("go", "a", "b"), "a", "b").filter("go IS NOT NULL AND a IS NOT NULL AND b IS NOT NULL").distinct(), "links")
    partners = links.groupBy("go", "a").agg(F.array_sort(F.collect_list("b")).alias("bs"))
    terms = tables.written(partners.groupBy("go").agg(F.array_sort(F.collect_list(F.struct("a", "bs"))).alias("adjacency")), "terms")
    kind = {c: links.schema[c].dataType.simpleString() for c in ("go", "a")}

    def look(rows: pd.DataFrame) -> pd.DataFrame:
        adjacency = rows.adjacency.iloc[0]
        nodes = [r["a"] for r in adjacency]
        at = {v: k for k, v in enumerate(nodes)}
        masks = {k: sum(1 << at[b] for b in r["bs"]) for k, r in enumerate(adjacency)}
        todo = deque((int.from_bytes(r, "little"), int.from_bytes(c, "little")) for r, c in sorted(zip(rows.r, rows.c)))
        if not rows.open.iloc[0]:  # the first round: all rows and columns
            todo = deque([((1 << len(nodes)) - 1, (1 << len(nodes)) - 1)])
        seen, found = set(todo), []
        for _ in range(max(LOOKS, len(todo))):  # all given blocks: one that is handed on again counts as a repeat
            if not todo:
                break
            block = todo.popleft()
            dense_enough, parts = _parted(masks, *block, dense, least)
            if dense_enough:
                found.append(block)
            for part in parts:
                if part not in seen:
                    seen.add(part)
                    todo.append(part)
        out = [(False, *block) for block in found] + [(True, *block) for block in todo]
        columns = {"go": [rows.go.iloc[0]] * len(out), "open": [o for o, _, _ in out], "r": [_packed(r) for _, r, _ in out], "c": [_packed(c) for _, _, c in out]}
        return pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in columns.items()})

    def round_of(blocks: DataFrame) -> DataFrame:
        sizes = blocks.groupBy("go").agg(F.ceil(F.count(F.lit(1)) / SHARED).cast("int").alias("n"))
        dealt = blocks.join(sizes, "go").withColumn("task", F.pmod(F.xxhash64("r", "c"), "n").cast("int")).drop("n")
        matrices = terms.join(sizes, "go").select("go", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("task"), "adjacency")
        shape = f"go {kind['go']}, open boolean, r binary, c binary"
        # the matrix comes with one block of each task, not with every one
        head = dealt.groupBy("go", "task").agg(F.min(F.struct("r", "c")).alias("h")).join(matrices, ["go", "task"]).select("go", "task", "h.r", "h.c", "adjacency")
        return dealt.join(head, ["go", "task", "r", "c"], "left").groupBy("go", "task").applyInPandas(lambda rows: look(rows.sort_values("adjacency", key=lambda x: x.isna(), kind="stable")), shape)

    blocks = terms.select("go", F.lit(False).alias("open"), F.lit(b"").alias("r"), F.lit(b"").alias("c"))
    found, handed = [], []
    while blocks.head(1):
        k = len(found)
        done = tables.written(round_of(blocks), f"round-{k}")
        found.append(done.filter("NOT open").select("go", "r", "c"))
        blocks = done.filter("open").distinct()
        for old in handed:
            blocks = blocks.join(old.select("go", "r", "c"), ["go", "r", "c"], "left_anti")
        blocks = tables.written(blocks.select("go", "open", "r", "c"), f"open-{k}")
        handed.append(blocks)
    every = terms.select("go", "adjacency").limit(0).select("go", F.lit(b"").alias("r"), F.lit(b"").alias("c"))
    for part in found:
        every = every.unionByName(part)
    names = F.transform("adjacency", lambda x: x["a"])

    @F.pandas_udf("array<int>")
    def places(masks: pd.Series) -> pd.Series:
        return pd.Series([_bits(int.from_bytes(m, "little")) for m in masks], dtype=object)

    def named(c: str) -> Column:
        return F.transform(places(c), lambda j: F.element_at("names", j + 1))

    return every.distinct().join(terms.select("go", names.alias("names")), "go").select("go", named("r").alias("rows"), named("c").alias("cols"))


def bicluster_pairs(subgraphs: DataFrame, dense: float) -> DataFrame:
    """go, a, b: every row-column pair of the biclusters of each term's adjacency matrix, and a single node that is its own partner."""
    blocks = biclusters(subgraphs, dense)
    pairs = blocks.select("go", F.explode("rows").alias("a"), "cols").distinct().select("go", "a", F.explode("cols").alias("b"))
    ends = subgraphs.select("go", "a", "b").filter("a IS NOT NULL AND b IS NOT NULL")
    lone = ends.groupBy("go").agg(F.min(F.least("a", "b")).alias("a"), F.max(F.greatest("a", "b")).alias("b")).filter("a = b")
    return pairs.unionByName(lone).distinct()


def fold_enrichment(predicted: DataFrame, known: DataFrame, n_domains: int | Column) -> DataFrame:
    """One row: n, k, known, fold = (k / n) / (K / N^2), 0 where something is empty, and fp_rate = share unknown.

    Hits count in the pair's own orientation.
    """
    p = predicted.toDF("a", "b").distinct()
    q = known.toDF("a", "b").distinct()
    # one sum over both: a cross join of two totals would run one of them as a broadcast, under its time limit
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    flags = p.select("a", "b", one.alias("p"), none.alias("q")).unionByName(q.select("a", "b", none.alias("p"), one.alias("q")))
    met = flags.groupBy("a", "b").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
    both = F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("p") * F.col("q")).otherwise(0)
    every = met.agg(*(F.coalesce(F.sum(x), none).alias(name) for x, name in ((F.col("p"), "n"), (both, "k"), (F.col("q"), "known"))))
    size = (n_domains if isinstance(n_domains, Column) else F.lit(n_domains)).cast("double") ** 2
    fold = safe_ratio(F.try_divide("k", "n"), F.try_divide(F.col("known"), size))  # no pair predicted: 0, not an error
    return every.select("n", "k", "known", F.coalesce(fold, F.lit(0.0)).alias("fold"), safe_ratio(F.col("n") - F.col("k"), F.col("n")).alias("fp_rate"))


def fp_rate(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Share of all rows that are predicted and not true."""
    return df.agg(safe_ratio(F.count_if((F.col(predicted) == 1) & (F.col(label) == 0)), F.count(F.lit(1))).alias("fp_rate"))


def degrees(edges: DataFrame, by: list[str] | None = None, once: bool = False) -> DataFrame:
    """node and degree over distinct undirected edges (the last two columns); a self-loop counts twice.

    once: each edge comes once already, in one orientation, so only nodes are held.
    """
    by = by or []
    a, b = [c for c in edges.columns if c not in by][:2]
    own = edges if once else canonical(edges.select(*by, a, b), a, b).distinct()
    return own.select(*by, F.explode(F.array(a, b)).alias("node")).groupBy(*by, "node").agg(F.count(F.lit(1)).alias("degree"))


def degree_histogram(nodes: DataFrame, by: list[str]) -> DataFrame:
    """by, num_nodes and degree_distribution: how many nodes have each degree, in order of degree."""
    counts = nodes.groupBy(*by, "degree").agg(F.count(F.lit(1)).alias("nodes"))
    return counts.groupBy(*by).agg(F.sum("nodes").alias("num_nodes"), F.array_sort(F.collect_list(F.struct("degree", "nodes"))).alias("degree_distribution"))


def network_counts(edges: DataFrame, by: list[str] | None = None, once: bool = False) -> DataFrame:
    """by, num_edges, num_nodes and degree_distribution in one pass: an edge is two of its ends' degrees. once: see degrees()."""
    by = by or []
    found = degree_histogram(degrees(edges, by, once), by)
    ends = F.aggregate("degree_distribution", F.lit(0).cast("long"), lambda s, x: s + x["degree"] * x["nodes"])
    return found.select(*by, F.floor(ends / 2).alias("num_edges"), F.coalesce("num_nodes", F.lit(0)).cast("long").alias("num_nodes"), "degree_distribution")


def clustering(edges: DataFrame) -> DataFrame:
    """node and its local clustering coefficient: closed over possible pairs of neighbours.

    Joins are dealt to tasks by the number of open paths, which is counted first from degrees.
    """
    a, b = edges.columns[:2]
    tables = Tables(edges.sparkSession)
    given = canonical(edges.select(F.col(a).alias("a"), F.col(b).alias("b")), "a", "b").filter("a != b")
    given = tables.written(given, "given")
    own = tables.written(dealt(given, given.count(), "a", "b").distinct(), "edges")
    tables.drop("given")
    into, out = (own.groupBy(F.col(c).alias("y")).agg(F.count(F.lit(1)).alias(n)) for c, n in (("b", "i"), ("a", "o")))
    paths = into.join(out, "y").agg(F.sum(F.col("i") * F.col("o"))).first()[0] or 0  # x < y < z over x - y and y - z
    one, two = (dealt(own.toDF(*c), paths, "y") for c in (("x", "y"), ("y", "z")))
    closed = dealt(one.join(two, "y"), paths, "x", "z").join(dealt(own.toDF("x", "z"), paths, "x", "z"), ["x", "z"])  # triangles x < y < z
    per_node = closed.select(F.explode(F.array("x", "y", "z")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("t"))
    d = degrees(own, once=True).join(per_node, "node", "left").fillna(0, ["t"])
    return d.select("node", F.when(F.col("degree") > 1, 2 * F.col("t") / (F.col("degree") * (F.col("degree") - 1))).otherwise(0.0).alias("clustering"))


def ppi_degree_keys(ppi: DataFrame, rows: int | None = None, once: bool = False) -> DataFrame:
    """ppi with the sum of both ends' degrees, in descending order of it. rows: about how many there are, for the number of tasks that sort; once: see degrees()."""
    d = degrees(ppi.select("protein_a", "protein_b"), once=once)
    joined = ppi.join(d.toDF("protein_a", "da"), "protein_a").join(d.toDF("protein_b", "db"), "protein_b")
    out, order = joined.withColumn("degree", F.col("da") + F.col("db")).drop("da", "db"), [F.desc("degree"), F.asc("protein_a"), F.asc("protein_b")]
    n = None if rows is None else task_count(ppi.sparkSession, rows)
    return out.orderBy(*order) if n is None else out.repartitionByRange(n, *order).sortWithinPartitions(*order)


def interaction_counts(df: DataFrame, by: list[str], label: str | None = "interaction") -> DataFrame:
    """Total, positive and negative interactions; all are positive where there is no label."""
    positive = F.count_if(F.col(label) == 1) if label and label in df.columns else F.count(F.lit(1))
    out = df.groupBy(*by).agg(F.count(F.lit(1)).alias("total_interactions"), positive.alias("num_positive_interactions"))
    return out.withColumn("num_negative_interactions", F.col("total_interactions") - F.col("num_positive_interactions"))


def permuted(df: DataFrame, key: str, value: str, seed: int) -> DataFrame:
    """df with value dealt anew over its rows: the same values, in an order drawn by hash.

    Rows are in the order of key and their other columns. Values are in the
    order of an MD5 of seed, value and the occurrence among equal values, so
    neither depends on partitions. Both are numbered by ranges and bases, so no
    task sees all rows; a value with many rows is laid out in steps.
    """
    step = 100_000
    rest = [c for c in df.columns if c not in (key, value)]
    counts = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(value, "_n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(step).cast("long"))).alias("_s")).repartition(value, "_s")
    each = starts.select(value, F.explode(F.sequence("_s", F.least(F.col("_s") + step, "_n") - 1)).alias("_s"))
    drawn = each.select(value, F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(value).cast("string"), F.lit("")), "_s")).alias("_d"))
    one = numbered(df.select(key, *rest), [key, *rest], "_k")
    two = numbered(drawn, ["_d", value], "_k").drop("_d")
    return one.join(two, "_k").select(*df.columns)
