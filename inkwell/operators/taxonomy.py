"""Parent and child edges: reverse index, closure, pruning, nearest ancestors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators.picks import first_wins
from inkwell.sources.storage import stored


def merged_edges(*sets: DataFrame) -> DataFrame:
    out = sets[0].select("parent", "child")
    for s in sets[1:]:
        out = out.union(s.select("parent", "child"))
    return out.distinct()


def edges_or_baked(found: DataFrame, baked: DataFrame, curated: DataFrame | None = None) -> DataFrame:
    """Online edges with the baked ones, among which only curated children stay; without online edges the baked ones as they are."""
    if found.isEmpty():
        return merged_edges(baked)
    edges = merged_edges(found, baked)
    if curated is not None:
        edges = edges.join(curated.select(F.col("curie").alias("child")), "child", "left_semi")
    return edges.select("parent", "child")


# Ranks from the nearest to the root, ranks below a species, and ids at the root.
RANKS = ("species", "genus", "family", "order", "class", "phylum", "kingdom", "domain", "superkingdom")
BELOW_SPECIES = ("subspecies", "strain", "isolate", "biovar", "serovar", "pathovar")
ROOTS = (1, 131567)
NODE = "struct<taxonomy:struct<rank:string,parents:array<string>,parent_tax_id:string,classification:map<string,struct<id:string>>>>"


def lineage(records: DataFrame, json: str = "json") -> DataFrame:
    """``records`` with parent_tid, rank, parents and ranks (ids by classification) of taxonomy records, both nearest first.

    Parents are turned so that the immediate one comes first; where it is not
    among them, they are reversed if they begin at the root. The species
    counts only for ranks below it. A record that isn't one, or has no nodes,
    gives a null, an empty rank and empty lists.
    """
    node = F.get(F.from_json(json, f"struct<taxonomy_nodes:array<{NODE}>>")["taxonomy_nodes"], F.lit(0))["taxonomy"]
    number = lambda c: c.try_cast("bigint")
    rank = F.lower(F.replace(F.coalesce(node["rank"], F.lit("")), F.lit("_"), F.lit(" ")))
    parents = F.filter(F.transform(F.coalesce(node["parents"], F.array().cast("array<string>")), number), lambda p: p.isNotNull())
    parent = number(node["parent_tax_id"])
    at = F.coalesce(F.array_position(parents, parent), F.lit(0)).cast("int")
    turned = F.concat(F.slice(parents, F.greatest(at, F.lit(1)), F.size(parents)), F.slice(parents, F.lit(1), F.greatest(at - 1, F.lit(0))))
    nearest = F.when(at > 0, turned).when(F.get(parents, F.lit(0)).isin(*ROOTS), F.reverse(parents)).otherwise(parents)
    below = rank.rlike("|".join(BELOW_SPECIES))
    ids = [number(F.try_element_at(node["classification"], F.lit(r))["id"]) for r in RANKS]
    ranks = F.array_distinct(F.array_compact(F.array(F.when(below, ids[0]), *ids[1:])))
    return records.withColumns({"parent_tid": parent, "rank": rank, "parents": nearest, "ranks": ranks})


def first_lineage(records: DataFrame, key: str = "taxid", source: str = "source") -> DataFrame:
    """One row of ``lineage`` for each key: that of the first provider (by ``source``) that says anything; keys without one are left out."""
    said = (F.size("parents") > 0) | (F.size("ranks") > 0) | F.col("parent_tid").isNotNull()
    return first_wins(records.where(said), [key], [source])


def reverse_index(edges: DataFrame) -> DataFrame:
    return edges.groupBy("child").agg(F.array_sort(F.collect_set("parent")).alias("parents"))


def ancestors(edges: DataFrame) -> DataFrame:
    """node, ancestor, depth (the shortest) of all ancestors, however far; a node on a cycle is its own ancestor.

    Round k joins the ancestors nearer than 2^k with the pairs that exactly
    2^k edges connect, so a pair is made once on each shortest way, and a
    lineage of depth d takes log2(d) rounds. Each round is deduplicated and
    written to the shared folder. Where a round finds no new pair there are no
    others, which also ends cycles: were there a farther one, the nodes on the
    way to it would have been new. Null ends are no edges.
    """
    kept = edges.select(F.col("child").alias("node"), F.col("parent").alias("ancestor")).where("node is not null and ancestor is not null").distinct()
    power = found = stored(kept, "closure")
    found, pairs, step = stored(found.withColumn("depth", F.lit(1)), "closure"), found.count(), 1
    while True:
        ends = power.select(F.col("node").alias("__middle"), F.col("ancestor").alias("__end"))
        power = stored(power.join(ends, F.col("ancestor") == F.col("__middle")).select("node", F.col("__end").alias("ancestor")).distinct(), "closure")
        step *= 2
        ends = power.select(F.col("node").alias("__middle"), F.col("ancestor").alias("__end"))
        farther = found.join(ends, F.col("ancestor") == F.col("__middle")).select("node", F.col("__end").alias("ancestor"), (F.col("depth") + step).alias("depth"))
        own = power.select("node", "ancestor", F.lit(step).alias("depth"))
        found = stored(found.union(farther).union(own).groupBy("node", "ancestor").agg(F.min("depth").alias("depth")), "closure")
        pairs, before = found.count(), pairs
        if pairs == before:
            return found


def most_specific(found: DataFrame, closure: DataFrame, key: str, node: str = "node", order: str | None = None) -> DataFrame:
    """Of each text's nodes, those that are no ancestor of another of its nodes, once each.

    With ``order``, a node has the least of its places, by which the rows of a
    text can be sorted as they were first seen. A node on a cycle is its own
    ancestor and goes.
    """
    others = [c for c in found.columns if c not in (key, node)]
    once = first_wins(found, [key, node], [order]) if order else found.dropDuplicates([key, node])
    above = once.select(F.col(key).alias("__k"), F.col(node).alias("__n")).join(closure.select(F.col("node").alias("__of"), F.col("ancestor").alias("__above")), F.col("__n") == F.col("__of"))
    drop = above.select(F.col("__k").alias(key), F.col("__above").alias(node)).distinct()
    return once.join(drop, [key, node], "left_anti").select(key, node, *others)


def nearest_curated(nodes: DataFrame, lineage: DataFrame, curated: DataFrame) -> DataFrame:
    """node, ancestor: the nearest curated one; lineage has node, ancestor, source (lower first), depth."""
    known = lineage.join(curated.select(F.col("curie").alias("ancestor")), "ancestor", "left_semi").join(nodes.select("node"), "node", "left_semi")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("source", "depth", "ancestor"))
    return known.withColumn("__r", rank).where("__r = 1").select("node", "ancestor")
