"""Cross-dataset referential coverage (X1-X6): six percentages in one row.

Every side is reduced before it is joined: reference ids to distinct keys, gene
rows to (id, row count). A key holding a third of the rows therefore arrives at
the join as one row, and the six ratios are global aggregates over small frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from genenet_spark.functions.rsem import pct_1dp


def _flag_join(keys: DataFrame, ref_ids: DataFrame) -> DataFrame:
    """Left join ``keys(k, w)`` with distinct ``ref_ids(r)``; adds ``hit`` 0/1, null-safe."""
    ref = ref_ids.distinct().withColumn("__hit", F.lit(1))
    j = keys.join(ref, keys["k"].eqNullSafe(ref["r"]), "left")
    return j.select(keys["k"], keys["w"], F.coalesce(ref["__hit"], F.lit(0)).alias("hit"))


def _distinct_keys(df: DataFrame, c: str) -> DataFrame:
    return df.select(F.col(c).alias("k")).distinct().withColumn("w", F.lit(1))


METRICS = (
    "ppi_genes_cov",
    "gwas_comun_genes_cov",
    "gwas_comun_dis_cov",
    "gwas_rara_genes_cov",
    "gwas_rara_dis_cov",
    "expresion_genes_cov",
)


def validate_cross(
    genes: DataFrame,
    interactome: DataFrame,
    gwas_common: DataFrame,
    gwas_rare: DataFrame,
    expression: DataFrame,
    diseases: DataFrame,
    raw: bool = False,
) -> DataFrame:
    """X1-X6. ``raw=True`` also returns the unrounded ratios (``*_raw``)."""
    gene_ids = genes.select(F.col("id").alias("r"))
    disease_ids = diseases.select(F.col("id").alias("r"))
    ppi_ids = interactome.select(F.explode(F.array("targetA", "targetB")).alias("r"))
    # X1 is weighted by gene rows: duplicates count, so weight = rows per id.
    gene_rows = genes.groupBy(F.col("id").alias("k")).agg(F.count(F.lit(1)).alias("w"))
    sides = {
        "ppi_genes_cov": (gene_rows, ppi_ids),
        "gwas_comun_genes_cov": (_distinct_keys(gwas_common, "targetId"), gene_ids),
        "gwas_comun_dis_cov": (_distinct_keys(gwas_common, "diseaseId"), disease_ids),
        "gwas_rara_genes_cov": (_distinct_keys(gwas_rare, "targetId"), gene_ids),
        "gwas_rara_dis_cov": (_distinct_keys(gwas_rare, "diseaseId"), disease_ids),
        "expresion_genes_cov": (_distinct_keys(expression, "id"), gene_ids),
    }
    flagged = None
    for name, (keys, ref) in sides.items():
        part = _flag_join(keys, ref).select(F.lit(name).alias("metric"), "w", "hit")
        flagged = part if flagged is None else flagged.unionByName(part)
    cols: list[Column] = []
    for name in METRICS:
        sel = F.col("metric") == name
        num = F.coalesce(F.sum(F.when(sel, F.col("w") * F.col("hit"))), F.lit(0))
        den = F.coalesce(F.sum(F.when(sel, F.col("w"))), F.lit(0))
        cols.append(pct_1dp(num, den).alias(name))
        if raw:
            cols.append(F.try_divide(num * F.lit(100.0), den.cast("double")).alias(name + "_raw"))
    return flagged.agg(*cols)
