"""Stand-in inputs built from the driver's TPC-H-style tables.

These adapters only give rows in the six input schemas (plus the ledger schema);
they do none of the engine's work. Every expression has a DuckDB twin in
``genenet_spark.plans.oracle`` so both engines start from identical rows.
Deliberate defects (bad ids, nulls, NaN, duplicates, self loops, out-of-range
scores) exercise the validators and filters.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


_SCANS: dict[tuple[str, str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one driver table, memoised per session (no footer re-reads while planning)."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return _SCANS[key]


def ens(c: Column) -> Column:
    """Ensembl-style gene id from an integer key."""
    return F.concat(F.lit("ENSG"), F.lpad(c.cast("string"), 11, "0"))


def _disease_id(nationkey: Column, segment: Column) -> Column:
    return F.concat(
        F.lit("EFO_"), F.lpad(nationkey.cast("string"), 3, "0"), F.lit("_"), F.substring(segment, 1, 2)
    )


def _score(quantity: Column, discount: Column) -> Column:
    return F.when(quantity == 48, F.lit(float("nan"))).otherwise(F.round(discount * 10, 2) + 0.0)


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    base = p.select(
        F.when(F.col("p_partkey") % 97 == 13, F.concat(F.lit("LRG_"), F.col("p_partkey").cast("string")))
        .otherwise(ens(F.col("p_partkey")))
        .alias("id"),
        F.when(F.col("p_partkey") % 50 == 7, F.lit(None).cast("string"))
        .otherwise(F.upper("p_name"))
        .alias("approvedSymbol"),
        F.when(F.col("p_size") % 5 == 0, F.lit("lncRNA"))
        .when(F.col("p_size") % 11 == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("protein_coding"))
        .alias("biotype"),
        F.col("p_name").alias("approvedName"),
        F.struct(
            F.col("p_size").cast("string").alias("chromosome"),
            (F.col("p_partkey") * 1000).alias("start"),
        ).alias("genomicLocation"),
    )
    dups = p.where(F.col("p_partkey") % 40 == 3).select(
        ens(F.col("p_partkey")).alias("id"),
        F.concat(F.lit("DUP_"), F.col("p_name")).alias("approvedSymbol"),
        F.lit("protein_coding").alias("biotype"),
        F.col("p_name").alias("approvedName"),
        F.struct(F.lit("dup").alias("chromosome"), (F.col("p_partkey") * 1000).alias("start")).alias(
            "genomicLocation"
        ),
    )
    return base.unionByName(dups)


def interactome(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order line interacts with the lowest part of its order (a star per order).

    One output row per line item: the per-order minimum is a partial aggregate and
    the join back is many-to-one, so the adapter is linear in ``lineitem``.
    """
    li = table(spark, sf_dir, "lineitem")
    hub = li.groupBy("l_orderkey").agg(F.min("l_partkey").alias("hub_partkey"))
    a = li.join(hub, "l_orderkey")
    return a.select(
        F.when(F.col("l_returnflag") == "A", "intact")
        .when(F.col("l_returnflag") == "N", "string")
        .otherwise("reactome")
        .alias("sourceDatabase"),
        ens(F.col("hub_partkey")).alias("targetA"),
        F.concat(F.lit("P"), F.col("hub_partkey").cast("string")).alias("intA"),
        ens(F.col("l_partkey")).alias("targetB"),
        F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("intB"),
        F.col("l_quantity").cast("int").alias("count"),
        F.when(F.col("l_quantity") == 50, F.lit(1.25))
        .when(F.col("l_quantity") == 49, F.lit(None).cast("double"))
        .otherwise(F.round(F.col("l_discount") * 10, 2) + 0.0)
        .alias("scoring"),
    )


def _assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    return li.join(o, li.l_orderkey == o.o_orderkey).join(c, o.o_custkey == c.c_custkey)


def _shared_assoc_cols() -> dict[str, Column]:
    return {
        "targetId": ens(F.col("l_partkey")),
        "diseaseId": F.when(F.col("l_quantity") == 1, F.lit(None).cast("string")).otherwise(
            _disease_id(F.col("c_nationkey"), F.col("c_mktsegment"))
        ),
        "diseaseFromSource": F.col("c_mktsegment"),
        "score": _score(F.col("l_quantity"), F.col("l_discount")),
        "variantId": F.concat(
            F.lit("v"), F.col("l_suppkey").cast("string"), F.lit("_"), F.col("l_linenumber").cast("string")
        ),
        "variantRsId": F.concat(F.lit("rs"), F.col("l_orderkey").cast("string")),
        "datatypeId": F.lit("genetic_association"),
        "directionOnTrait": F.when(F.col("l_linestatus") == "O", "risk").otherwise("protect"),
    }


def gwas_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _shared_assoc_cols()
    a = _assoc(spark, sf_dir).where(F.col("l_returnflag") != "R")
    return a.select(
        F.lit("gwas_credible_sets").alias("datasourceId"),
        s["targetId"].alias("targetId"),
        s["diseaseId"].alias("diseaseId"),
        s["diseaseFromSource"].alias("diseaseFromSource"),
        s["score"].alias("score"),
        (-F.col("l_linenumber") * 3).cast("int").alias("pValueExponent"),
        (1 + F.round(F.col("l_tax") * 100).cast("int")).cast("double").alias("pValueMantissa"),
        (F.col("l_tax") - 0.04).alias("beta"),
        F.when(F.col("l_tax") == 0, F.lit(None).cast("double")).otherwise(1 + F.col("l_tax")).alias("oddsRatio"),
        s["variantId"].alias("variantId"),
        s["variantRsId"].alias("variantRsId"),
        F.concat(F.lit("GCST"), F.col("o_custkey").cast("string")).alias("studyId"),
        F.concat(F.lit("SL"), F.col("l_orderkey").cast("string")).alias("studyLocusId"),
        s["datatypeId"].alias("datatypeId"),
        (F.col("l_tax") + 0.0).alias("resourceScore"),
        s["directionOnTrait"].alias("directionOnTrait"),
    )


def gwas_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = _shared_assoc_cols()
    a = _assoc(spark, sf_dir).where(F.col("l_returnflag") == "R")
    prio = F.substring("o_orderpriority", 1, 1)
    null_s = F.lit(None).cast("string")
    sig = (
        F.when(prio == "1", F.array(F.lit("Pathogenic")))
        .when(prio == "2", F.array(F.lit("Likely pathogenic"), F.lit("Benign")))
        .when(prio == "3", F.array(F.lit("Likely benign")))
        .when(prio == "4", F.array(F.lit("Uncertain significance"), null_s))
        .otherwise(F.lit(None).cast("array<string>"))
    )
    return a.select(
        F.when(F.col("l_linestatus") == "O", "eva").otherwise("clinvar").alias("datasourceId"),
        s["targetId"].alias("targetId"),
        s["diseaseId"].alias("diseaseId"),
        s["diseaseFromSource"].alias("diseaseFromSource"),
        s["score"].alias("score"),
        sig.alias("clinicalSignificances"),
        s["variantId"].alias("variantId"),
        s["variantRsId"].alias("variantRsId"),
        F.concat(F.lit("RCV"), F.col("l_orderkey").cast("string")).alias("variantFromSourceId"),
        F.lit("SO_0001583").alias("variantFunctionalConsequenceId"),
        F.array(F.lit("germline")).alias("alleleOrigins"),
        s["datatypeId"].alias("datatypeId"),
        F.col("o_orderstatus").alias("confidence"),
        s["directionOnTrait"].alias("directionOnTrait"),
    )


def expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = (
        li.join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    return j.select(
        ens(F.col("l_partkey")).alias("id"),
        F.concat(F.lit("UBERON_"), F.lpad(F.col("s_nationkey").cast("string"), 7, "0")).alias("efo_code"),
        F.col("n_name").alias("label"),
        ((F.col("s_acctbal") - 1500.0) / 10.0).alias("rna_value"),
        (F.col("l_linenumber") - 4).cast("int").alias("rna_zscore"),
        F.when(F.col("l_quantity") >= 49, F.lit(None).cast("int"))
        .otherwise(F.col("l_linenumber") - 2)
        .cast("int")
        .alias("rna_level"),
        F.lit("TPM").alias("rna_unit"),
        F.array("n_name").alias("organs"),
        F.array("r_name").alias("anatomical_systems"),
        (F.col("l_linenumber") % 4).cast("int").alias("protein_level"),
        (F.col("l_linestatus") == "O").alias("protein_reliability"),
    )


def diseases(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    empty = F.array().cast("array<string>")
    terms = (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .select("c_nationkey", "c_mktsegment", "n_name", "n_regionkey")
        .distinct()
    )
    mondo = F.concat(F.lit("MONDO_"), F.col("n_regionkey").cast("string"))
    t = terms.select(
        # Terms of the last nations have ids that no association uses: all rows stay, coverage is below 100 %.
        F.when(F.col("c_nationkey") < 22, _disease_id(F.col("c_nationkey"), F.col("c_mktsegment")))
        .otherwise(F.concat(F.lit("OBSOLETE_"), _disease_id(F.col("c_nationkey"), F.col("c_mktsegment")))).alias("id"),
        F.concat(F.col("c_mktsegment"), F.lit(" "), F.col("n_name")).alias("name"),
        F.concat(F.lit("desc "), F.col("c_mktsegment")).alias("description"),
        F.array("c_mktsegment").alias("therapeuticAreas"),
        F.array(mondo).alias("parents"),
        F.array(mondo).alias("ancestors"),
        empty.alias("children"),
        F.array(F.lower("c_mktsegment")).alias("synonyms"),
    )
    roots = r.select(
        F.concat(F.lit("MONDO_"), F.col("r_regionkey").cast("string")).alias("id"),
        F.col("r_name").alias("name"),
        F.lit(None).cast("string").alias("description"),
        empty.alias("therapeuticAreas"),
        empty.alias("parents"),
        empty.alias("ancestors"),
        empty.alias("children"),
        F.lit(None).cast("array<string>").alias("synonyms"),
    )
    return t.unionByName(roots)


def trait_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-trait checkpoint entries (trait_id, status, timestamp, tiempo_s, seq, msg)."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("trait_id"),
        F.when((F.col("user_id") % 3 == 0) | (F.col("event_type") == "error"), "error")
        .otherwise("ok")
        .alias("status"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("tiempo_s"),
        F.col("event_id").alias("seq"),
        F.col("event_type").alias("msg"),
    )


BUILDERS = {
    "genes": genes,
    "interactome": interactome,
    "gwas_common": gwas_common,
    "gwas_rare": gwas_rare,
    "expression": expression,
    "diseases": diseases,
}


class _Lazy(dict):
    """Dataset name -> adapter DataFrame, built on first access."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self._spark, self._sf = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        df = BUILDERS[name](self._spark, self._sf)
        self[name] = df
        return df


def load_all(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _Lazy(spark, sf_dir)
