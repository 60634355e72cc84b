"""Parquet readers for the six input datasets.

Each reader scans ``<path>/*.parquet`` (one directory level) and projects the
dataset's column list. Projection and later filters reach the Parquet scan
(``ReadSchema`` / ``PushedFilters``); nothing is read eagerly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Column with a row's place in the files: file by path, then row number inside it.
FILE_ORDER = "__at"

# Column lists read by the reference for each dataset.
GENES_COLUMNS = ["id", "approvedSymbol", "biotype", "approvedName", "genomicLocation"]
INTERACTOME_COLUMNS = [
    "sourceDatabase", "targetA", "intA", "targetB", "intB", "count", "scoring",
]
GWAS_COMMON_COLUMNS = [
    "datasourceId", "targetId", "diseaseId", "diseaseFromSource", "score",
    "pValueExponent", "pValueMantissa", "beta", "oddsRatio", "variantId",
    "variantRsId", "studyId", "studyLocusId", "datatypeId", "resourceScore",
    "directionOnTrait",
]
GWAS_RARE_COLUMNS = [
    "datasourceId", "targetId", "diseaseId", "diseaseFromSource", "score",
    "clinicalSignificances", "variantId", "variantRsId", "variantFromSourceId",
    "variantFunctionalConsequenceId", "alleleOrigins", "datatypeId", "confidence",
    "directionOnTrait",
]
EXPRESSION_COLUMNS = [
    "id", "efo_code", "label", "rna_value", "rna_zscore", "rna_level", "rna_unit",
    "organs", "anatomical_systems", "protein_level", "protein_reliability",
]
DISEASES_COLUMNS = [
    "id", "name", "description", "therapeuticAreas", "parents", "ancestors",
    "children", "synonyms",
]

DATASET_COLUMNS = {
    "genes": GENES_COLUMNS,
    "interactome": INTERACTOME_COLUMNS,
    "gwas_common": GWAS_COMMON_COLUMNS,
    "gwas_rare": GWAS_RARE_COLUMNS,
    "expression": EXPRESSION_COLUMNS,
    "diseases": DISEASES_COLUMNS,
}


def read_dataset(spark: SparkSession, path: str, columns: list[str], ordered: bool = False) -> DataFrame:
    """``SELECT cols FROM <path>/*.parquet``. A missing column fails analysis.

    ``ordered`` adds ``FILE_ORDER``, by which harmonisation keeps the first row in the files among duplicates.
    """
    df = (
        spark.read.option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "false")
        .parquet(path)
    )
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")).alias(FILE_ORDER)
    return df.select(*[df[c] for c in columns], *([at] if ordered else []))


def read_genes(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, GENES_COLUMNS, ordered)


def read_interactome(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, INTERACTOME_COLUMNS, ordered)


def read_gwas_common(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, GWAS_COMMON_COLUMNS, ordered)


def read_gwas_rare(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, GWAS_RARE_COLUMNS, ordered)


def read_expression(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, EXPRESSION_COLUMNS, ordered)


def read_diseases(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    return read_dataset(spark, path, DISEASES_COLUMNS, ordered)


READERS = {
    "genes": read_genes,
    "interactome": read_interactome,
    "gwas_common": read_gwas_common,
    "gwas_rare": read_gwas_rare,
    "expression": read_expression,
    "diseases": read_diseases,
}
