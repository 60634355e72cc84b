"""Physical-plan properties: pushdown, pruning, partial dedup, no cartesian products."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from genenet_spark.operators import analysis
from genenet_spark.params import DEFAULTS
from genenet_spark.plans.catalog import harmonized


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_filters_pushed_and_columns_pruned(spark, sf0001):
    p = _plan(harmonized(spark, sf0001)["gwas_common"])
    assert "Not(EqualTo(l_returnflag,R))" in p
    lineitem_schema = [ln for ln in p.splitlines() if "ReadSchema" in ln and "l_orderkey" in ln]
    assert lineitem_schema and all("l_shipdate" not in ln for ln in lineitem_schema)


def test_keep_first_is_partial_before_shuffle(spark, sf0001):
    p = _plan(harmonized(spark, sf0001)["interactome"])
    assert "WindowGroupLimit" in p and "Partial" in p


@pytest.mark.parametrize("name", ["validate_cross", "validate_interactome", "harmonize_diseases", "rank_genes",
                                  "seed_scores", "integrate_layers", "ledger_eta"])
def test_no_cartesian_or_nested_loop(spark, sf0001, name):
    p = _plan(E.queries()[name](spark, sf0001))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


def test_zscore_and_other_aggregations(spark):
    rows = [("t", "a", "g1", 1.0), ("t", "a", "g2", 3.0), ("t", "b", "g1", 2.0), ("t", "b", "g2", 2.0)]
    df = spark.createDataFrame(rows, "trait_id string, capa string, gene_id string, score double")
    z = {(r.capa, r.gene_id): r.norm_score
         for r in analysis.normalize_layers(df, DEFAULTS.with_(normalisation="zscore")).collect()}
    sd = (2.0 ** 0.5)  # sample sd of {1, 3}
    assert z[("a", "g1")] == pytest.approx(-1 / sd) and z[("a", "g2")] == pytest.approx(1 / sd)
    assert z[("b", "g1")] == 0.0  # zero spread
    normed = df.withColumn("norm_score", F.col("score"))
    for agg, want in (("median", 1.5), ("max", 2.0), ("mean", 1.5)):
        out = analysis.integrate_layers(normed, DEFAULTS.with_(aggregation=agg))
        got = {r.gene_id: r.score for r in out.collect()}
        assert got["g1"] == pytest.approx(want)
