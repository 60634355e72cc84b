"""Harmonisation (H1-H6): filters, null-safe semi joins, keep-first de-duplication.

Filter order follows the reference; de-duplication always runs last because it
keeps the first surviving row per key. Tables read with their file order keep the
first row in the files; others the least by a total order of their columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from genenet_spark.functions.rsem import (
    field_type,
    ge_not_nan,
    is_in,
    matches_text_or_array,
    regex_any,
)
from genenet_spark.params import BIOTYPE_PROTEIN_CODING, DEFAULTS, Params
from genenet_spark.sources.parquet import FILE_ORDER

_ORDERABLE = (T.AtomicType, T.StructType, T.ArrayType)


def default_tiebreak(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """All other orderable columns, ascending, nulls first."""
    return [
        F.col(f.name).asc_nulls_first()
        for f in df.schema.fields
        if f.name not in keys and isinstance(f.dataType, _ORDERABLE)
    ]


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """One row per key: the first under ``order`` (R ``unique(by=)``, G6).

    ``row_number() <= 1`` is planned as a partial WindowGroupLimit before the shuffle,
    so each map task sends at most one row per key: a key holding a third of the
    rows costs one row per map task in the exchange, not a third of the data.
    """
    if order is None:
        order = [F.col(FILE_ORDER).asc()] if FILE_ORDER in df.columns else default_tiebreak(df, keys)
    w = Window.partitionBy(*keys).orderBy(*list(order))
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= 1).drop("__rn", FILE_ORDER)


def _ge(df: DataFrame, c: str, threshold) -> Column:
    if isinstance(field_type(df, c), (T.FloatType, T.DoubleType)):
        return ge_not_nan(c, threshold)
    return F.col(c) >= F.lit(threshold)


def harmonize_genes(genes: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """H1: protein-coding rows, first row per id. Sort by id only at a sink."""
    pc = genes.where(F.col("biotype") == BIOTYPE_PROTEIN_CODING)
    if order is None and FILE_ORDER not in genes.columns:
        order = [F.col("approvedSymbol").asc_nulls_first(), F.col("approvedName").asc_nulls_first()] + [
            c for c in default_tiebreak(pc, ["id", "approvedSymbol", "approvedName"])
        ]
    return keep_first(pc, ["id"], order)


def interactome_tiebreak(df: DataFrame) -> list[Column]:
    first = [F.col("scoring").desc_nulls_last(), F.col("count").desc_nulls_last()]
    rest = default_tiebreak(df, ["targetA", "targetB", "sourceDatabase", "scoring", "count"])
    return first + rest


def harmonize_interactome(
    interactome: DataFrame, genes: DataFrame, params: Params = DEFAULTS, order: Sequence[Column] | None = None
) -> DataFrame:
    """H2: score >= min, both ends known genes, no self loops, first per directed key."""
    ids = genes.select("id")
    out = interactome.where(_ge(interactome, "scoring", params.interactome_score_min))
    out = is_in(out, "targetA", ids, "id")
    out = is_in(out, "targetB", ids, "id")
    out = out.where(F.col("targetA") != F.col("targetB"))
    if order is None and FILE_ORDER not in out.columns:
        order = interactome_tiebreak(out)
    return keep_first(out, ["targetA", "targetB", "sourceDatabase"], order)


def harmonize_gwas_common(gwas: DataFrame, genes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """H3: disease known, score >= min, gene known. Duplicates kept."""
    out = gwas.where(F.col("diseaseId").isNotNull())
    out = out.where(_ge(out, "score", params.gwas_common_score_min))
    return is_in(out, "targetId", genes.select("id"), "id")


def harmonize_gwas_rare(gwas: DataFrame, genes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """H4: as H3, then drop rows whose clinical significance matches an excluded term.

    Case-insensitive substring match against a string or any array element; null
    significance is kept; an empty exclusion list disables the step.
    """
    out = gwas.where(F.col("diseaseId").isNotNull())
    out = out.where(_ge(out, "score", params.gwas_rare_score_min))
    out = is_in(out, "targetId", genes.select("id"), "id")
    if params.excluded_significances:
        pattern = regex_any(params.excluded_significances)
        hit = matches_text_or_array(
            "clinicalSignificances", field_type(out, "clinicalSignificances"), pattern
        )
        out = out.where(~hit | F.col("clinicalSignificances").isNull())
    return out


def harmonize_expression(expr: DataFrame, genes: DataFrame, params: Params = DEFAULTS) -> DataFrame:
    """H5: rna_level >= min, gene known."""
    out = expr.where(_ge(expr, "rna_level", params.rna_level_min))
    return is_in(out, "id", genes.select("id"), "id")


def harmonize_diseases(diseases: DataFrame, gwas_common: DataFrame, gwas_rare: DataFrame) -> DataFrame:
    """H6: ontology terms referenced by either GWAS table."""
    used = gwas_common.select("diseaseId").unionByName(gwas_rare.select("diseaseId"))
    return is_in(diseases, "id", used, "diseaseId")


class Harmonized(dict):
    """H1-H6 chained the way the reference documents them; each table is planned on first use."""

    def __init__(self, raw: dict[str, DataFrame], params: Params = DEFAULTS):
        super().__init__()
        self._raw, self._params = raw, params

    def __missing__(self, name: str) -> DataFrame:
        raw, p = self._raw, self._params
        if name == "genes":
            df = harmonize_genes(raw["genes"])
        elif name == "interactome":
            df = harmonize_interactome(raw["interactome"], self["genes"], p)
        elif name == "gwas_common":
            df = harmonize_gwas_common(raw["gwas_common"], self["genes"], p)
        elif name == "gwas_rare":
            df = harmonize_gwas_rare(raw["gwas_rare"], self["genes"], p)
        elif name == "expression":
            df = harmonize_expression(raw["expression"], self["genes"], p)
        elif name == "diseases":
            df = harmonize_diseases(raw["diseases"], self["gwas_common"], self["gwas_rare"])
        else:
            raise KeyError(name)
        self[name] = df = df.drop(FILE_ORDER)
        return df

    def counted(self, name: str) -> tuple[DataFrame, Observation]:
        """A table, and the number of its surviving rows (``rows``), noted while an action runs over the table.

        No pass of its own is made. The other tables are built on the uncounted one, so a count holds the rows of one
        action; ``get`` waits for it.
        """
        seen = Observation(f"harmonize_{name}")
        return self[name].observe(seen, F.count(F.lit(1)).alias("rows")), seen


def harmonize_all(raw: dict[str, DataFrame], params: Params = DEFAULTS) -> Harmonized:
    return Harmonized(raw, params)
