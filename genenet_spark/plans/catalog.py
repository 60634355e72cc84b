"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables under ``sf_dir`` through the adapters in
``sources.fixtures`` and runs the library operator over the whole input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from genenet_spark.operators import coverage, harmonize, quality
from genenet_spark.plans import ledger, materialize, run
from genenet_spark.plans.present import presentable
from genenet_spark.sources import fixtures as fx
from genenet_spark.session import cut_lineage, ensure_checkpoint_dir
from genenet_spark.sources import parquet as pq

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


# --------------------------------------------------------------------------- sources
#: Raised with every change of the adapters, so that no table of an older one is read.
FIXTURE_VERSION = 2


def _stored(spark: SparkSession, sf_dir: str, dataset: str) -> str:
    """Write the dataset once as a Parquet directory (M1) and return its path."""
    tables = [f"{sf_dir}/{t}.parquet" for t in fx.TABLES]
    key = materialize.cache_key("fixture", dataset, FIXTURE_VERSION, inputs=tables, spark=spark)
    materialize.materialize(spark, key, lambda: fx.BUILDERS[dataset](spark, sf_dir))
    return materialize.location(spark, key)


def _reader(dataset: str) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return presentable(pq.READERS[dataset](spark, _stored(spark, sf_dir, dataset)))

    q.__doc__ = f"R{list(pq.READERS).index(dataset) + 1}: scan the stored {dataset} Parquet directory."
    return q


for _ds in pq.READERS:
    register(f"read_{_ds}")(_reader(_ds))


# --------------------------------------------------------------------------- quality
def _validator(dataset: str, fn) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fx.BUILDERS[dataset](spark, sf_dir))

    q.__doc__ = fn.__doc__
    return q


for _ds, _fn in {
    "genes": quality.validate_genes,
    "interactome": quality.validate_interactome,
    "gwas_common": quality.validate_gwas_common,
    "gwas_rare": quality.validate_gwas_rare,
    "expression": quality.validate_expression,
    "diseases": quality.validate_diseases,
}.items():
    register(f"validate_{_ds}")(_validator(_ds, _fn))


@register("validate_cross")
def q_validate_cross(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = fx.load_all(spark, sf_dir)
    out = coverage.validate_cross(
        raw["genes"], raw["interactome"], raw["gwas_common"], raw["gwas_rare"],
        raw["expression"], raw["diseases"], raw=True,
    )
    return presentable(out)


# --------------------------------------------------------------------------- harmonise
def harmonized(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return harmonize.harmonize_all(fx.load_all(spark, sf_dir))


for _ds in ["genes", "interactome", "gwas_common", "gwas_rare", "expression", "diseases"]:
    def _q(spark: SparkSession, sf_dir: str, _ds=_ds) -> DataFrame:
        return presentable(harmonized(spark, sf_dir)[_ds])

    register(f"harmonize_{_ds}")(_q)


# --------------------------------------------------------------------------- ledger
@register("ledger_pending")
def q_ledger_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = fx.trait_ledger(spark, sf_dir)
    return ledger.pending_traits(led, led)


@register("ledger_summary")
def q_ledger_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ledger.footer(fx.trait_ledger(spark, sf_dir))
    return out.withColumn("tiempo_total", F.round("tiempo_total", 6))


@register("ledger_eta")
def q_ledger_eta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.eta(fx.trait_ledger(spark, sf_dir))


# --------------------------------------------------------------------------- network (2.B)
from genenet_spark.operators import analysis, communities, hypergraph, iterative, network, significance  # noqa: E402
from genenet_spark.params import DEFAULTS, LAYERS  # noqa: E402

# 2.B queries run with all three layers active (weight 1.0 each) so that
# integration, cross-layer overlap and hypergraph links have something to combine.
MULTILAYER = DEFAULTS.with_(layers={name: (True, 1.0) for name in LAYERS})
AREA_SELECTION = MULTILAYER.with_(
    traits_use_all=False, traits_areas=("AUTOMOBILE", "MACHINERY"), traits_exclude=("EFO_001_AU",)
)
# Tighter than the default 1e-6: ranks are printed with six decimals, and the L1 change bounds all genes of a key together.
PROPAGATION_TOL = 1e-10


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 for the queries that need no layers, which are stored when they are built."""
    return network.interaction_graph(harmonized(spark, sf_dir)["interactome"])


def network_inputs(spark: SparkSession, sf_dir: str, params=MULTILAYER):
    h = harmonized(spark, sf_dir)
    graph = network.interaction_graph(h["interactome"])
    layers = network.trait_layers(h["gwas_common"], h["gwas_rare"], h["expression"], params)
    return h, graph, layers


@register("interaction_graph")
def q_interaction_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """N1 over the harmonised interactome."""
    graph = interactions(spark, sf_dir)
    return presentable(graph)


@register("trait_layers")
def q_trait_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(trait, layer, gene, score) over the three harmonised layers."""
    _, _, layers = network_inputs(spark, sf_dir)
    return presentable(layers)


@register("select_traits")
def q_select_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traits in two therapeutic areas, minus one excluded id."""
    h, _, layers = network_inputs(spark, sf_dir)
    return network.select_traits(layers, h["diseases"], AREA_SELECTION)


@register("seed_scores")
def q_seed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layer scores on graph genes, normalised to sum 1 per (trait, layer)."""
    _, graph, layers = network_inputs(spark, sf_dir)
    return presentable(network.seed_scores(layers, graph, MULTILAYER))


@register("node_metrics")
def q_node_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Degree and strength of every graph gene."""
    graph = interactions(spark, sf_dir)
    return presentable(network.node_metrics(graph))


@register("association_strength")
def q_association_strength(spark: SparkSession, sf_dir: str) -> DataFrame:
    """-log10 p per harmonised common-variant association."""
    h = harmonized(spark, sf_dir)
    z = network.association_strength(h["gwas_common"])
    return presentable(
        z.select(F.col("diseaseId").alias("trait_id"), F.col("targetId").alias("gene_id"), "variantId",
                 "studyId", "neg_log10_p")
    )


@register("annotate_traits")
def q_annotate_traits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AN1: every layer trait with its name and therapeutic areas."""
    h, _, layers = network_inputs(spark, sf_dir)
    return network.annotate_traits(network.select_traits(layers, h["diseases"], MULTILAYER), h["diseases"])


def _normed(spark, sf_dir):
    _, _, layers = network_inputs(spark, sf_dir)
    return analysis.normalize_layers(layers, MULTILAYER)


@register("normalize_layers")
def q_normalize_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Min-max normalised layer scores."""
    return presentable(_normed(spark, sf_dir))


@register("integrate_layers")
def q_integrate_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean / median / max over layers of the normalised scores."""
    return presentable(analysis.integrate_layers(_normed(spark, sf_dir), MULTILAYER))


@register("rank_genes")
def q_rank_genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: top 25% genes per trait by integrated score (>= 0.1)."""
    integ = analysis.integrate_layers(_normed(spark, sf_dir), MULTILAYER)
    return presentable(analysis.rank_genes(integ, MULTILAYER))


@register("propagate")
def q_propagate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personalised PageRank from the seed scores, to the fixed point at the printed precision."""
    _, graph, layers = network_inputs(spark, sf_dir)
    graph = cut_lineage(graph)
    seeds = cut_lineage(network.seed_scores(layers, graph, MULTILAYER))
    return presentable(iterative.propagate(graph, seeds, MULTILAYER, max_iter=200, tol=PROPAGATION_TOL))


@register("hub_score")
def q_hub_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3: HITS hub score, iterated until it is stable."""
    graph = interactions(spark, sf_dir)
    return presentable(iterative.hub_score(cut_lineage(graph)))


@register("coreness")
def q_coreness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K-core number of every graph gene (iterated until stable)."""
    graph = interactions(spark, sf_dir)
    return iterative.coreness(cut_lineage(graph))


#: Raised with every change of C1, so that no table of an older one is read.
CLUSTER_VERSION = 4


def clustered(spark: SparkSession, sf_dir: str):
    """C1 on every (trait, layer) gene set restricted to the graph; the communities are stored once (M1), as six queries read them."""
    _, graph, layers = network_inputs(spark, sf_dir)
    graph = cut_lineage(graph)
    on_graph = cut_lineage(layers.join(network.graph_nodes(graph), "gene_id", "left_semi"))
    tables = [f"{sf_dir}/{t}.parquet" for t in fx.TABLES]
    key = materialize.cache_key("communities", CLUSTER_VERSION, FIXTURE_VERSION, inputs=tables, spark=spark)
    comms = materialize.materialize(spark, key, lambda: communities.communities(graph, on_graph, MULTILAYER),
                                    **materialize.policy(MULTILAYER))
    return graph, on_graph, comms


@register("communities")
def q_communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modularity local-moving communities per (trait, layer), size >= 5."""
    return clustered(spark, sf_dir)[2]


@register("recluster")
def q_recluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-communities inside communities of >= 30 genes."""
    graph, _, comms = clustered(spark, sf_dir)
    return communities.recluster(graph, comms, MULTILAYER)


@register("cluster_jaccard")
def q_cluster_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jaccard overlap of communities across layers of a trait."""
    _, _, comms = clustered(spark, sf_dir)
    return presentable(analysis.cluster_jaccard(comms, list(LAYERS)))


@register("permutation_test")
def q_permutation_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T1 + T2: permutation p-values (1000 score permutations) and BH q-values per trait."""
    _, on_graph, comms = clustered(spark, sf_dir)
    return presentable(significance.permutation_test(on_graph, comms, MULTILAYER))


@register("hypergraph_incidence")
def q_hypergraph_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Community hyperedges over genes."""
    _, _, comms = clustered(spark, sf_dir)
    return hypergraph.incidence(comms, MULTILAYER)


@register("hyperedge_links")
def q_hyperedge_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Y2: cross-layer hyperedges of a trait sharing >= 2 genes."""
    _, _, comms = clustered(spark, sf_dir)
    return hypergraph.links(comms, list(LAYERS), MULTILAYER)


@register("global_summary")
def q_global_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: per trait ranked genes, communities, significant communities, top gene."""
    _, on_graph, comms = clustered(spark, sf_dir)
    ranking = analysis.rank_genes(analysis.integrate_layers(_normed(spark, sf_dir), MULTILAYER), MULTILAYER)
    sig = significance.permutation_test(on_graph, comms, MULTILAYER)
    return analysis.global_summary(ranking, comms, sig)


@register("export_run")
def q_export_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1 + L3: one run's seven tables, exported and read back."""
    root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/export/{uuid.uuid4().hex}"
    return run.exported(spark, run.export_run(spark, harmonized(spark, sf_dir), root, "run", MULTILAYER), "run")
