"""Ledger (L1-L5), materialised tables (M1-M4), sinks (S1/O1), streaming ledger."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from genenet_spark.operators import harmonize
from genenet_spark.params import DEFAULTS
from genenet_spark.plans import ledger, materialize, run, sinks
from genenet_spark.sources import fixtures as fx
from genenet_spark.sources import parquet as pq
from genenet_spark.streaming import ledger_stream


def test_checkpoint_any_ok_counts_as_done(spark, tmp_path):
    path = str(tmp_path / "ledger")
    ledger.checkpoint_save(spark, path, "t1", "ok")
    ledger.checkpoint_save(spark, path, "t1", "error", "later failure")
    ledger.checkpoint_save(spark, path, "t2", "error")
    led = ledger.read_ledger(spark, path)
    assert sorted(r.trait_id for r in ledger.done_traits(led).collect()) == ["t1"]
    assert ledger.is_done(led, "t1") and not ledger.is_done(led, "t2")
    traits = spark.createDataFrame([("t1",), ("t2",), ("t3",)], "trait_id string")
    assert sorted(r.trait_id for r in ledger.pending_traits(traits, led).collect()) == ["t2", "t3"]
    f = ledger.footer(led).first()
    assert (f.n_ok, f.n_total, f.n_err, f.n_entries) == (1, 2, 1, 3)


def test_manifest_statuses(spark, tmp_path):
    path = str(tmp_path / "manifest")
    ledger.manifest_append(spark, path, "network_genes", "ok", 1.2)
    ledger.manifest_append(spark, path, "analysis_latent", "omitido")
    assert spark.read.parquet(path).count() == 2


def test_eta_matches_brute_force(spark, sf0001):
    led = fx.trait_ledger(spark, sf0001)
    got = ledger.eta(led).toPandas().sort_values("rn").reset_index(drop=True)
    pdf = led.toPandas().sort_values(["timestamp", "seq"]).reset_index(drop=True)
    mean = pdf["tiempo_s"].rolling(10, min_periods=1).mean().round(6)
    n = len(pdf)
    assert list(got["rn"]) == list(range(1, n + 1))
    assert (got["mean_recent_s"] - mean).abs().max() < 1e-9
    assert got["eta_s"].isna().sum() == 1 and pd.isna(got["eta_s"].iloc[-1])


def test_materialize_hit_and_key(spark, tmp_path, sf0001):
    root = str(tmp_path / "tables")
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    key = materialize.cache_key("x", inputs=[f"{sf0001}/part.parquet"], spark=spark)
    a = materialize.materialize(spark, key, build, root=root)
    b = materialize.materialize(spark, key, build, root=root)
    assert a.count() == b.count() == 5 and len(calls) == 1
    assert materialize.exists(spark, key, root)
    other = materialize.cache_key("x", inputs=[f"{sf0001}/lineitem.parquet"], spark=spark)
    assert other != key
    assert materialize.invalidate(spark, key, root) and not materialize.exists(spark, key, root)
    materialize.materialize(spark, key, build, root=root, enabled=False)
    assert len(calls) == 2


def test_partitioned_sink_layout(spark, tmp_path):
    df = spark.createDataFrame([("t1", "gwas_comun", "g1", 1.0), ("t2", "expresion", "g2", 2.0)],
                               "trait_id string, capa string, gene_id string, score double")
    out = sinks.export_table(df, str(tmp_path), "genes_ranking", run_id="r1")
    assert os.path.isdir(os.path.join(out, "run_id=r1", "trait_id=t1", "capa=gwas_comun"))
    back = spark.read.parquet(out)
    assert back.count() == 2 and set(back.columns) >= {"run_id", "trait_id", "capa"}


def test_runs_are_exported_side_by_side(spark, tmp_path):
    def frame(score):
        return spark.createDataFrame([("t1", "gwas_comun", "g1", score), ("t2", "expresion", "g2", score)],
                                     "trait_id string, capa string, gene_id string, score double")

    for run, score in (("a", 1.0), ("b", 2.0), ("b", 3.0)):  # the second b replaces the first
        paths = sinks.export_all({"genes_ranking": frame(score), "resumen_global": frame(score)}, str(tmp_path), run)
    back = spark.read.parquet(paths["genes_ranking"])
    assert sorted((r.run_id, r.gene_id, r.score) for r in back.collect()) == [
        ("a", "g1", 1.0), ("a", "g2", 1.0), ("b", "g1", 3.0), ("b", "g2", 3.0)]
    with pytest.raises(ValueError):
        sinks.export_all({"unknown": frame(1.0)}, str(tmp_path), "a")


def test_stored_tables_expire(spark, tmp_path):
    root = str(tmp_path / "tables")
    materialize.materialize(spark, "k", lambda: spark.range(3), root=root)
    assert materialize.exists(spark, "k", root, max_age_days=1.0)
    done = os.path.join(root, "k", "_SUCCESS")
    os.utime(done, (1_000_000_000, 1_000_000_000))
    assert not materialize.exists(spark, "k", root, max_age_days=1.0)
    assert materialize.exists(spark, "k", root)


def test_eta_over_small_buckets(spark, sf0001):
    led = fx.trait_ledger(spark, sf0001)
    whole, small = (sorted(map(tuple, ledger.eta(led, bucket=b).collect())) for b in (4096, 10))
    assert [r[0] for r in small] == [r[0] for r in whole]
    assert all(a == b or abs(a[3] - b[3]) < 1e-6 for a, b in zip(small, whole))


def test_streaming_ledger_matches_batch(spark, tmp_path, sf0001):
    led = fx.trait_ledger(spark, sf0001).select(*ledger.TRAIT_LEDGER_SCHEMA.fieldNames())
    src = str(tmp_path / "ledger")
    # appended in three pieces, as a run would
    for i in range(3):
        led.where(F.col("seq") % 3 == i).write.mode("append").parquet(src)
    q = ledger_stream.trait_status_stream(spark, src, str(tmp_path / "status"), str(tmp_path / "ck1"))
    q.awaitTermination()
    status = spark.read.parquet(str(tmp_path / "status"))
    done_stream = {r.trait_id for r in status.where("done").collect()}
    done_batch = {r.trait_id for r in ledger.done_traits(led).collect()}
    assert done_stream == done_batch and status.count() == led.select("trait_id").distinct().count()
    q2 = ledger_stream.progress_stream(spark, src, str(tmp_path / "prog"), str(tmp_path / "ck2"))
    q2.awaitTermination()
    prog = spark.read.parquet(str(tmp_path / "prog"))
    batch = ledger_stream.progress(led).where(F.col("window_end") <= F.lit(
        led.agg(F.max("timestamp")).first()[0]))
    # every closed window was appended with the batch counts
    assert prog.select("window_start", "n_entries", "n_ok").exceptAll(
        batch.select("window_start", "n_entries", "n_ok")).count() == 0
    assert prog.count() > 0


def test_versions_are_whole_for_readers_and_writers(spark, tmp_path):
    root = str(tmp_path / "tables")
    old = materialize.put(spark.range(5), "k", root)
    first = materialize.location(spark, "k", root)
    new = materialize.put(spark.range(7), "k", root)
    # A reader of the old version goes on reading it; new readers see the new one.
    assert old.count() == 5 and new.count() == 7 and materialize.get(spark, "k", root).count() == 7
    # A writer that dies before it points to its version changes nothing.
    spark.range(9).write.parquet(f"{root}/k/unfinished")
    assert materialize.get(spark, "k", root).count() == 7
    assert materialize.forget_old(spark, "k", root) == 0  # written just now
    assert materialize.forget_old(spark, "k", root, older_than_days=-1.0) == 2
    assert not os.path.exists(first) and materialize.get(spark, "k", root).count() == 7
    assert materialize.invalidate(spark, "k", root) and materialize.location(spark, "k", root) is None


def test_keys_follow_the_files(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    keys = [materialize.cache_key("x", inputs=[a, b], spark=spark)]
    assert materialize.cache_key("x", inputs=[a, b], spark=spark) == keys[0]
    assert materialize.cache_key("x", inputs=[b, a], spark=spark) == keys[0]
    spark.range(1).write.parquet(b)
    keys.append(materialize.cache_key("x", inputs=[a, b], spark=spark))
    spark.range(3).write.mode("append").parquet(a)
    keys.append(materialize.cache_key("x", inputs=[a, b], spark=spark))
    assert len(set(keys)) == 3
    assert materialize.cache_key("x", inputs=[str(tmp_path / "none")], spark=spark)


def test_cache_settings_are_followed(spark, tmp_path):
    root, calls = str(tmp_path / "tables"), []

    def build():
        calls.append(1)
        return spark.range(2)

    for params in (DEFAULTS, DEFAULTS, DEFAULTS.with_(cache_enabled=False)):
        materialize.materialize(spark, "k", build, root=root, **materialize.policy(params))
    assert len(calls) == 2
    os.utime(os.path.join(root, "k", "_SUCCESS"), (1_000_000_000, 1_000_000_000))
    materialize.materialize(spark, "k", build, root=root, **materialize.policy(DEFAULTS.with_(cache_max_age_days=2.0)))
    assert len(calls) == 3


def test_first_row_in_the_files_is_kept(spark, tmp_path):
    """Several files with duplicates: the survivor is the first by file name, then by row."""
    genes, pairs = tmp_path / "genes", tmp_path / "pairs"
    for d in (genes, pairs):
        d.mkdir()
    loc = {"chromosome": "1", "start": 1}

    def gene(i, symbol, biotype="protein_coding"):
        return {"id": i, "approvedSymbol": symbol, "biotype": biotype, "approvedName": "n", "genomicLocation": loc}

    def pair(a, b, count, scoring=0.9):
        return {"sourceDatabase": "s", "targetA": a, "intA": "x", "targetB": b, "intB": "y", "count": count, "scoring": scoring}

    pd.DataFrame([gene("g1", "zz"), gene("g1", "aa"), gene("g2", "bb", "lncRNA")]).to_parquet(genes / "part-0.parquet")
    pd.DataFrame([gene("g1", "a0"), gene("g2", "yy"), gene("g2", "cc")]).to_parquet(genes / "part-1.parquet")
    pd.DataFrame([pair("g1", "g2", 9, 0.1), pair("g1", "g2", 1), pair("g1", "g2", 5)]).to_parquet(pairs / "part-0.parquet")
    pd.DataFrame([pair("g1", "g2", 7), pair("g2", "g1", 2), pair("g2", "g1", 8)]).to_parquet(pairs / "part-1.parquet")
    raw = {"genes": pq.read_genes(spark, str(genes), ordered=True), "interactome": pq.read_interactome(spark, str(pairs), ordered=True)}
    tables = harmonize.harmonize_all({n: df.repartition(3) for n, df in raw.items()})
    assert sorted((r.id, r.approvedSymbol) for r in tables["genes"].collect()) == [("g1", "zz"), ("g2", "yy")]
    assert sorted((r.targetA, r["count"]) for r in tables["interactome"].collect()) == [("g1", 1), ("g2", 2)]
    assert tables["genes"].columns == pq.GENES_COLUMNS and tables["interactome"].columns == pq.INTERACTOME_COLUMNS
    # Without the order of the files, a total order of the columns decides.
    plain = harmonize.harmonize_all({"genes": pq.read_genes(spark, str(genes))})["genes"]
    assert sorted((r.id, r.approvedSymbol) for r in plain.collect()) == [("g1", "a0"), ("g2", "cc")]


def test_surviving_rows_are_counted_while_written(spark, tmp_path, sf0001):
    tables = harmonize.harmonize_all(fx.load_all(spark, sf0001))
    root, manifest = str(tmp_path / "h"), str(tmp_path / "manifest")
    counts = run.store_harmonized(spark, tables, root, manifest)
    assert counts == {name: tables[name].count() for name in counts} and len(counts) == 6
    assert counts == {name: materialize.get(spark, name, root).count() for name in counts}
    entries = {r.paso: r.mensaje for r in spark.read.parquet(manifest).collect()}
    assert entries == {f"harmonize_{n}": f"{c} rows" for n, c in counts.items()}


def test_a_run_exports_its_seven_tables(spark, tmp_path, sf0001):
    from genenet_spark.plans.catalog import MULTILAYER

    tables = harmonize.harmonize_all(fx.load_all(spark, sf0001))
    root = str(tmp_path / "out")
    paths = run.export_run(spark, tables, root, "r1", MULTILAYER.with_(n_permutations=20))
    seen = {r.tabla: r for r in run.exported(spark, paths, "r1").collect()}
    assert set(seen) == set(sinks.EXPORT_TABLES) and all(r.n_rows > 0 for r in seen.values())
    assert seen["comunidades"].n_traits == seen["hypergraph"].n_traits and seen["metricas_red"].n_traits is None
    entries = spark.read.parquet(f"{root}/manifest").collect()
    assert sorted(r.paso for r in entries) == sorted(["analysis", *(f"export_{t}" for t in sinks.EXPORT_TABLES)])
    assert {r.estado for r in entries} == {"ok"}
