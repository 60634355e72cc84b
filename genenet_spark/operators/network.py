"""Graph and layer construction (N1-N4), node degree/strength (D1), association strength (Z1),
trait annotation (AN1).

Everything is a grouped aggregate or a join against a reduced side; per-group
totals are computed as aggregates and joined back instead of window partitions,
so a trait or gene holding a third of all rows is combined map-side first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.params import DEFAULTS, Params
from genenet_spark.session import cut_lineage


def interaction_graph(ppi: DataFrame) -> DataFrame:
    """Undirected simple graph from the harmonised interactome.

    One row per unordered pair ``gene_a < gene_b``; ``weight`` = max score over
    sources and directions, ``n_sources`` = distinct source databases.
    """
    a = F.least("targetA", "targetB")
    b = F.greatest("targetA", "targetB")
    return (
        ppi.where(F.col("targetA") != F.col("targetB"))
        .groupBy(a.alias("gene_a"), b.alias("gene_b"))
        .agg(
            F.max("scoring").alias("weight"),
            F.count_distinct("sourceDatabase").alias("n_sources"),
        )
    )


def directed_edges(graph: DataFrame) -> DataFrame:
    """Both directions of every undirected edge: (src, dst, weight)."""
    fwd = graph.select(F.col("gene_a").alias("src"), F.col("gene_b").alias("dst"), "weight")
    rev = graph.select(F.col("gene_b").alias("src"), F.col("gene_a").alias("dst"), "weight")
    return fwd.unionByName(rev)


def graph_nodes(graph: DataFrame) -> DataFrame:
    return graph.select(F.explode(F.array("gene_a", "gene_b")).alias("gene_id")).distinct()


def trait_layers(
    gwas_common: DataFrame | None,
    gwas_rare: DataFrame | None,
    expression: DataFrame | None,
    params: Params = DEFAULTS,
) -> DataFrame:
    """Long table (trait_id, capa, gene_id, score) over the active layers.

    GWAS layers: trait = diseaseId, score = max association score per gene.
    Expression layer: unit = tissue (efo_code), score = max rna_level / 3.
    (trait, layer) pairs with fewer than ``min_genes_per_trait`` genes are dropped. The scores per gene are read twice, for
    the counts and for the rows, so they are stored and the associations are worked through once.
    """
    active = params.active_layers()
    parts = []
    if "gwas_comun" in active and gwas_common is not None:
        parts.append(
            gwas_common.select(
                F.col("diseaseId").alias("trait_id"), F.lit("gwas_comun").alias("capa"),
                F.col("targetId").alias("gene_id"), F.col("score").cast("double").alias("score"),
            )
        )
    if "gwas_rara" in active and gwas_rare is not None:
        parts.append(
            gwas_rare.select(
                F.col("diseaseId").alias("trait_id"), F.lit("gwas_rara").alias("capa"),
                F.col("targetId").alias("gene_id"), F.col("score").cast("double").alias("score"),
            )
        )
    if "expresion" in active and expression is not None:
        parts.append(
            expression.select(
                F.col("efo_code").alias("trait_id"), F.lit("expresion").alias("capa"),
                F.col("id").alias("gene_id"), (F.col("rna_level") / F.lit(3.0)).alias("score"),
            )
        )
    if not parts:
        raise ValueError("no active layer")
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    per_gene = cut_lineage(long.groupBy("trait_id", "capa", "gene_id").agg(F.max("score").alias("score")))
    big_enough = (
        per_gene.groupBy("trait_id", "capa")
        .agg(F.count(F.lit(1)).alias("n_genes"))
        .where(F.col("n_genes") >= params.min_genes_per_trait)
        .select("trait_id", "capa")
    )
    return per_gene.join(big_enough, ["trait_id", "capa"], "left_semi")


def select_traits(layers: DataFrame, diseases: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """All traits, or the listed ids, or those in the given therapeutic areas; minus exclusions."""
    traits = layers.select("trait_id").distinct()
    if not params.traits_use_all:
        chosen = None
        if params.traits_list:
            chosen = traits.where(F.col("trait_id").isin(list(params.traits_list)))
        if params.traits_areas:
            areas = F.array(*[F.lit(a) for a in params.traits_areas])
            in_area = diseases.where(F.arrays_overlap("therapeuticAreas", areas)).select(
                F.col("id").alias("trait_id")
            )
            by_area = traits.join(in_area, "trait_id", "left_semi")
            chosen = by_area if chosen is None else chosen.unionByName(by_area).distinct()
        traits = chosen if chosen is not None else traits.where(F.lit(False))  # nothing selected
    if params.traits_exclude:
        traits = traits.where(~F.col("trait_id").isin(list(params.traits_exclude)))
    return traits


def seed_scores(layers: DataFrame, graph: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """seed = score x layer weight over genes in the graph, summing to 1 per (trait, layer).

    Genes in the graph are joined once: their rows are stored, for the totals and for the shares.
    """
    weights = params.active_layers()
    w = F.lit(1.0)
    for name, peso in weights.items():
        w = F.when(F.col("capa") == name, F.lit(float(peso))).otherwise(w)
    on_graph = cut_lineage(layers.join(graph_nodes(graph), "gene_id", "left_semi").withColumn(
        "raw", F.col("score") * w
    ).where(F.col("raw") > 0))
    totals = on_graph.groupBy("trait_id", "capa").agg(F.sum("raw").alias("total"))
    return on_graph.join(totals, ["trait_id", "capa"]).select(
        "trait_id", "capa", "gene_id", (F.col("raw") / F.col("total")).alias("seed")
    )


def node_metrics(graph: DataFrame) -> DataFrame:
    """Degree (neighbours) and strength (sum of weights) per gene."""
    return (
        directed_edges(graph)
        .groupBy(F.col("src").alias("gene_id"))
        .agg(F.count(F.lit(1)).alias("degree"), F.sum("weight").alias("strength"))
    )


def association_strength(gwas: DataFrame) -> DataFrame:
    """-log10 p from the split mantissa / exponent, per association row."""
    return gwas.withColumn(
        "neg_log10_p", -(F.log10("pValueMantissa") + F.col("pValueExponent").cast("double"))
    )


def annotate_traits(traits: DataFrame, diseases: DataFrame) -> DataFrame:
    """AN1: trait id -> name and therapeutic areas (one row per area; traits without one kept)."""
    d = diseases.select(F.col("id").alias("trait_id"), F.col("name").alias("trait_name"), "therapeuticAreas")
    return traits.join(d, "trait_id", "left").select(
        "trait_id", "trait_name", F.explode_outer("therapeuticAreas").alias("therapeutic_area")
    )
