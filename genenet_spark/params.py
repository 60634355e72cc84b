"""Run parameters.

The reference keeps these in a YAML file; here they are a frozen dataclass whose
fields feed straight into column expressions as literals (no driver-side lookups
during planning besides reading the field).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# ---------------------------------------------------------------------------
# These must equal the reference defaults for identical results.
# ---------------------------------------------------------------------------
BIOTYPE_PROTEIN_CODING = "protein_coding"
ENSEMBL_GENE_PATTERN = r"^ENSG\d+"
VALID_RNA_LEVELS = (-1, 0, 1, 2, 3)
EXCLUDED_CLINICAL_SIGNIFICANCES = ("benign", "likely benign")
LAYERS = ("gwas_comun", "gwas_rara", "expresion")
LEDGER_STATUS_OK = "ok"
STEP_STATUSES = ("ok", "error", "omitido")
ETA_WINDOW = 10
RANDOM_SEED = 12345


@dataclass(frozen=True)
class Params:
    # harmonisation thresholds
    interactome_score_min: float = 0.5
    gwas_common_score_min: float = 0.5
    gwas_rare_score_min: float = 0.5
    excluded_significances: tuple[str, ...] = EXCLUDED_CLINICAL_SIGNIFICANCES
    rna_level_min: int = 1
    min_genes_per_trait: int = 2
    # layers: name -> (active, weight)
    layers: dict = field(
        default_factory=lambda: {
            "gwas_comun": (True, 1.0),
            "gwas_rara": (False, 1.0),
            "expresion": (False, 1.0),
        }
    )
    # trait selection
    traits_use_all: bool = True
    traits_list: tuple[str, ...] = ()
    traits_areas: tuple[str, ...] = ()
    traits_exclude: tuple[str, ...] = ()
    # propagation (personalised PageRank); alpha is the restart probability
    pr_alpha: float = 0.15
    pr_max_iter: int = 100
    pr_tol: float = 1e-6
    # communities
    community_min_size: int = 5
    community_use_weights: bool = True
    recluster_min_size: int = 30
    recluster_min_subsize: int = 5
    # integration
    normalisation: str = "minmax"  # minmax | zscore
    aggregation: str = "mean"  # mean | median | max
    use_weights: bool = True
    # ranking
    top_pct_genes: float = 0.25
    rank_min_score: float = 0.1
    # significance
    n_permutations: int = 1000
    seed: int = RANDOM_SEED
    null_model: str = "permute_scores"
    min_community_size: int = 5
    # hypergraph
    hg_min_shared_genes: int = 2
    hg_connect_traits: bool = False  # True is refused by hypergraph.links
    hg_connect_layers: bool = True
    hg_min_cluster_size: int = 5
    # cache
    cache_enabled: bool = True
    cache_max_age_days: float | None = None
    # iterative jobs: cut lineage every N iterations
    checkpoint_every: int = 3

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    def active_layers(self) -> dict[str, float]:
        return {k: w for k, (on, w) in self.layers.items() if on}


DEFAULTS = Params()
