"""Data-quality checks (V0-V7).

Each validator checks the required columns (schema only, no job) and returns a
one-row metrics DataFrame computed in a single aggregate pass; the input frame
itself flows on untouched. ``to_long`` turns any metrics row into
``(dataset, check, n)`` rows for a combined report.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from genenet_spark.functions.rsem import (
    count_na,
    count_not_in,
    count_out_of_range,
    count_pattern_mismatch,
    missing_columns,
    unique_n,
)
from genenet_spark.params import BIOTYPE_PROTEIN_CODING, ENSEMBL_GENE_PATTERN, VALID_RNA_LEVELS

# Required columns per dataset.
REQUIRED = {
    "genes": ["id", "approvedSymbol", "biotype", "approvedName", "genomicLocation"],
    "interactoma": ["sourceDatabase", "targetA", "intA", "targetB", "intB", "count", "scoring"],
    "gwas_comun": ["datasourceId", "targetId", "diseaseId", "score", "variantId", "studyId", "datatypeId"],
    "gwas_rara": [
        "datasourceId", "targetId", "diseaseId", "score", "clinicalSignificances", "variantId", "datatypeId",
    ],
    "expresion": ["id", "efo_code", "label", "rna_value", "rna_level"],
    "enfermedades": ["id", "name", "therapeuticAreas", "parents", "ancestors"],
}


class MissingColumnsError(ValueError):
    pass


def require_columns(df: DataFrame, required: list[str], dataset: str) -> None:
    """Fail listing the missing columns (case-sensitive)."""
    missing = missing_columns(df, required)
    if missing:
        raise MissingColumnsError(f"[{dataset}] table lacks column(s) {', '.join(missing)}")


def assert_non_empty(df: DataFrame | None, name: str) -> DataFrame:
    """V7: error when the frame is missing or has no rows (reads at most one row)."""
    if df is None or df.isEmpty():
        raise ValueError(f"'{name}' is empty or NULL")
    return df


def _sources(c: str):
    return F.array_join(F.sort_array(F.collect_set(c)), ", ")


def validate_genes(df: DataFrame) -> DataFrame:
    """V1."""
    require_columns(df, REQUIRED["genes"], "genes")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_na("id").alias("n_na_id"),
        count_na("approvedSymbol").alias("n_na_approvedSymbol"),
        count_pattern_mismatch("id", ENSEMBL_GENE_PATTERN).alias("n_bad_id"),
        (F.count(F.lit(1)) - unique_n("id")).alias("n_duplicate_ids"),
        F.count_if(F.col("biotype") == BIOTYPE_PROTEIN_CODING).alias("n_protein_coding"),
        unique_n("id").alias("n_unique_ids"),
    )


def validate_interactome(df: DataFrame) -> DataFrame:
    """V2. Unique genes are counted over targetA and targetB together.

    One pass: each row is exploded into its two endpoints; row-level counts only
    look at the first copy (``pos = 0``).
    """
    require_columns(df, REQUIRED["interactoma"], "interactoma")
    ex = df.select(
        F.posexplode(F.array("targetA", "targetB")).alias("pos", "g"),
        "targetA", "targetB", "scoring", "sourceDatabase",
    )
    first = F.col("pos") == 0

    def once(cond):
        return F.count_if(first & cond)

    return ex.agg(
        once(F.lit(True)).alias("n_rows"),
        once(F.col("targetA").isNull()).alias("n_na_targetA"),
        once(F.col("targetB").isNull()).alias("n_na_targetB"),
        once(F.col("targetA").isNull() | ~F.col("targetA").rlike(ENSEMBL_GENE_PATTERN)).alias("n_bad_targetA"),
        once(F.col("targetB").isNull() | ~F.col("targetB").rlike(ENSEMBL_GENE_PATTERN)).alias("n_bad_targetB"),
        once(((F.col("scoring") < 0) | (F.col("scoring") > 1)) & ~F.isnan("scoring")).alias(
            "n_scoring_out_of_range"
        ),
        _sources("sourceDatabase").alias("sources"),
        unique_n("g").alias("n_unique_genes"),
    )


def _validate_gwas(df: DataFrame, dataset: str) -> DataFrame:
    require_columns(df, REQUIRED[dataset], dataset)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_na("targetId").alias("n_na_targetId"),
        count_na("diseaseId").alias("n_na_diseaseId"),
        count_pattern_mismatch("targetId", ENSEMBL_GENE_PATTERN).alias("n_bad_targetId"),
        count_out_of_range("score", 0, 1).alias("n_score_out_of_range"),
        unique_n("targetId").alias("n_genes"),
        unique_n("diseaseId").alias("n_diseases"),
        _sources("datasourceId").alias("sources"),
    )


def validate_gwas_common(df: DataFrame) -> DataFrame:
    """V3."""
    return _validate_gwas(df, "gwas_comun")


def validate_gwas_rare(df: DataFrame) -> DataFrame:
    """V4. clinicalSignificances is required but its content is not checked."""
    return _validate_gwas(df, "gwas_rara")


def validate_expression(df: DataFrame) -> DataFrame:
    """V5."""
    require_columns(df, REQUIRED["expresion"], "expresion")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_na("id").alias("n_na_id"),
        count_na("efo_code").alias("n_na_efo_code"),
        count_pattern_mismatch("id", ENSEMBL_GENE_PATTERN).alias("n_bad_id"),
        F.count_if(F.col("rna_value") < 0).alias("n_negative_rna_value"),
        count_not_in("rna_level", VALID_RNA_LEVELS).alias("n_bad_rna_level"),
        unique_n("id").alias("n_genes"),
        unique_n("efo_code").alias("n_tissues"),
    )


def validate_diseases(df: DataFrame) -> DataFrame:
    """V6."""
    require_columns(df, REQUIRED["enfermedades"], "enfermedades")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        count_na("id").alias("n_na_id"),
        count_na("name").alias("n_na_name"),
    )


def to_long(metrics: DataFrame, dataset: str) -> DataFrame:
    """Unpivot the integer metrics of a one-row frame to (dataset, check, n)."""
    ints = [f.name for f in metrics.schema.fields if f.dataType.typeName() in ("long", "integer")]
    return metrics.unpivot([], ints, "check", "n").select(F.lit(dataset).alias("dataset"), "check", "n")
