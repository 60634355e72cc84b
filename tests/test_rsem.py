"""Unit frames for the R semantics rules G1-G13."""

import math

import pytest
from pyspark.sql import functions as F

from genenet_spark.functions import rsem
from genenet_spark.operators import coverage, harmonize, quality


def test_g1_nan_is_not_ge_threshold(spark):
    df = spark.createDataFrame([(0.7,), (float("nan"),), (None,), (0.2,)], "s double")
    assert df.where(rsem.ge_not_nan("s", 0.5)).count() == 1
    # NaN is not counted out of range either
    n = df.agg(rsem.count_out_of_range("s", 0, 0.5).alias("n")).first().n
    assert n == 1


def test_g2_pattern_counts_null_as_mismatch(spark):
    df = spark.createDataFrame([("ENSG1",), ("LRG_1",), (None,), ("ENSG01.2",)], "id string")
    n = df.agg(rsem.count_pattern_mismatch("id", r"^ENSG\d+").alias("n")).first().n
    assert n == 2  # LRG_1 and null; ENSG01.2 is a prefix match (G11)


def test_g3_null_level_counts_as_bad(spark):
    df = spark.createDataFrame([(1,), (4,), (None,), (-1,)], "l int")
    assert df.agg(rsem.count_not_in("l", (-1, 0, 1, 2, 3)).alias("n")).first().n == 2


def test_g4_unique_n_counts_null_once(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), ("b",)], "x string")
    assert df.agg(rsem.unique_n("x").alias("n")).first().n == 3
    empty = spark.createDataFrame([], "x string")
    assert empty.agg(rsem.unique_n("x").alias("n")).first().n == 0


def test_g5_null_matches_null_in_membership(spark):
    df = spark.createDataFrame([("a",), (None,), ("c",)], "k string")
    ref = spark.createDataFrame([("a",), (None,)], "id string")
    got = sorted(r.k or "<null>" for r in rsem.is_in(df, "k", ref, "id").collect())
    assert got == ["<null>", "a"]


def test_g8_significance_exclusion_string_and_array(spark):
    arr = spark.createDataFrame(
        [(["Pathogenic"],), (["xBENIGN"],), ([],), (["Uncertain", None],), (None,), (["Likely benign"],)],
        "clinicalSignificances array<string>",
    )
    p = rsem.regex_any(["benign", "likely benign"])
    hit = rsem.matches_text_or_array("clinicalSignificances", arr.schema[0].dataType, p)
    kept = arr.where(~hit | F.col("clinicalSignificances").isNull()).count()
    assert kept == 4  # Pathogenic, empty, [Uncertain, null], null
    txt = spark.createDataFrame([("Benign/Likely benign",), ("pathogenic",), (None,)], "clinicalSignificances string")
    hit = rsem.matches_text_or_array("clinicalSignificances", txt.schema[0].dataType, p)
    assert txt.where(~hit | F.col("clinicalSignificances").isNull()).count() == 2


def test_g9_round_half_even_and_g10_empty_is_null(spark):
    df = spark.createDataFrame([(1225.0, 10000.0), (0.0, 0.0)], "num double, den double")
    vals = [r.v for r in df.select(rsem.pct_1dp(F.col("num"), F.col("den")).alias("v")).collect()]
    assert vals[0] == 12.2 and vals[1] is None


def test_g12_column_check_is_case_sensitive(spark):
    df = spark.createDataFrame([("x",)], "ID string")
    assert rsem.missing_columns(df, ["id"]) == ["id"]
    with pytest.raises(quality.MissingColumnsError):
        quality.validate_diseases(df)


def test_g13_ppi_coverage_counts_gene_rows(spark):
    genes = spark.createDataFrame([("g1",), ("g1",), ("g2",), ("g3",)], "id string")
    ppi = spark.createDataFrame([("g1", "g9")], "targetA string, targetB string")
    empty_g = spark.createDataFrame([], "targetId string, diseaseId string")
    expr = spark.createDataFrame([], "id string")
    dis = spark.createDataFrame([], "id string")
    out = coverage.validate_cross(genes, ppi, empty_g, empty_g, expr, dis, raw=True).first()
    assert out.ppi_genes_cov == 50.0  # 2 of 4 gene rows, duplicates counted
    assert out.gwas_comun_genes_cov is None  # 0 / 0


def test_keep_first_uses_tiebreak_not_arrival(spark):
    df = spark.createDataFrame(
        [("g1", "B", "protein_coding", "n1"), ("g1", "A", "protein_coding", "n2"),
         ("g1", None, "protein_coding", "n3"), ("g2", "Z", "lncRNA", "n4")],
        "id string, approvedSymbol string, biotype string, approvedName string",
    )
    for parts in (1, 3):
        out = harmonize.harmonize_genes(df.repartition(parts)).collect()
        assert [(r.id, r.approvedSymbol) for r in out] == [("g1", None)]


def test_nan_literal_is_nan(spark):
    assert math.isnan(spark.range(1).select(F.lit(float("nan")).alias("x")).first().x)
