"""Adapter counts and harmonisation properties on the sf0.001 driver tables."""

import pytest
from pyspark.sql import functions as F

from genenet_spark.operators import harmonize, quality
from genenet_spark.sources import fixtures as fx


@pytest.fixture(scope="module")
def raw(spark, sf0001):
    return fx.load_all(spark, sf0001)


@pytest.fixture(scope="module")
def harm(raw):
    return harmonize.harmonize_all(raw)


def test_adapter_row_counts(raw):
    # FIXTURES.md section 3 (the interactome adapter emits one row per line item)
    assert raw["genes"].count() == 205
    assert raw["interactome"].count() == 6000
    assert raw["gwas_common"].count() == 4032
    assert raw["gwas_rare"].count() == 1968
    assert raw["expression"].count() == 6000
    assert raw["diseases"].count() == 98


def test_harmonised_counts(harm):
    assert harm["genes"].count() == 151
    assert harm["gwas_common"].count() == 1649
    assert harm["gwas_rare"].count() == 479
    assert harm["expression"].count() == 3124
    assert harm["diseases"].count() == 84


def test_gene_quality_counts(raw):
    m = quality.validate_genes(raw["genes"]).first()
    assert (m.n_bad_id, m.n_duplicate_ids, m.n_na_approvedSymbol) == (2, 5, 4)
    e = quality.validate_expression(raw["expression"]).first()
    assert (e.n_negative_rna_value, e.n_bad_rna_level) == (595, 1958)
    g = quality.validate_gwas_common(raw["gwas_common"]).first()
    assert g.n_na_diseaseId == 96


def test_harmonise_is_idempotent_and_a_subset(raw, harm):
    genes = harm["genes"]
    again = harmonize.harmonize_genes(genes)
    assert again.exceptAll(genes).count() == 0 and genes.exceptAll(again).count() == 0
    inter = harm["interactome"]
    assert inter.exceptAll(raw["interactome"]).count() == 0
    again_i = harmonize.harmonize_interactome(inter, genes)
    assert again_i.exceptAll(inter).count() == 0 and inter.exceptAll(again_i).count() == 0


def test_interactome_rules(harm):
    inter = harm["interactome"]
    assert inter.where(F.col("targetA") == F.col("targetB")).count() == 0
    assert inter.where(F.isnan("scoring") | (F.col("scoring") < 0.5)).count() == 0
    assert inter.groupBy("targetA", "targetB", "sourceDatabase").count().where("count > 1").count() == 0


def test_dedup_independent_of_partitioning(raw, spark):
    genes = harmonize.harmonize_genes(raw["genes"])
    a = harmonize.harmonize_interactome(raw["interactome"].repartition(1), genes)
    b = harmonize.harmonize_interactome(raw["interactome"].repartition(7), genes)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_rare_exclusion_with_string_column(spark, raw):
    genes = harmonize.harmonize_genes(raw["genes"])
    as_text = raw["gwas_rare"].withColumn("clinicalSignificances", F.array_join("clinicalSignificances", ","))
    a = harmonize.harmonize_gwas_rare(raw["gwas_rare"], genes).count()
    b = harmonize.harmonize_gwas_rare(as_text, genes).count()
    assert a == b == 479


def test_assert_non_empty(spark):
    with pytest.raises(ValueError):
        quality.assert_non_empty(spark.createDataFrame([], "x int"), "x")
    with pytest.raises(ValueError):
        quality.assert_non_empty(None, "x")
