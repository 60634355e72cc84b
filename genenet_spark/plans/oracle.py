"""DuckDB oracle SQL for every registered query.

Each string runs against the driver's pre-registered table views. The adapter
CTEs mirror ``sources.fixtures`` expression by expression; the query part is
written independently from the Spark operators, from the documented semantics.
"""

from __future__ import annotations


# Unrolled rounds for the coreness oracle: more than the rounds Spark needs to
# reach the fixed point on these graphs; extra rounds leave a fixed point unchanged.
CORE_ROUNDS = 40
# Likewise for ranks (0.85 ** 150 is below 1e-10) and hub scores (20 and 80 rounds print the same).
PPR_ROUNDS, HUB_ROUNDS = 150, 40


def ENS(x: str) -> str:
    return f"concat('ENSG', lpad(CAST({x} AS VARCHAR), 11, '0'))"


DIS_NOTNULL = "concat('EFO_', lpad(CAST(c_nationkey AS VARCHAR), 3, '0'), '_', substr(c_mktsegment, 1, 2))"
DIS = f"CASE WHEN l_quantity = 1 THEN NULL ELSE {DIS_NOTNULL} END"
SC = "CASE WHEN l_quantity = 48 THEN CAST('NaN' AS DOUBLE) ELSE round(l_discount * 10, 2) + 0.0 END"

FIXTURE_CTES: dict[str, tuple[list[str], str]] = {
    "genes": ([], f"""
SELECT CASE WHEN p_partkey % 97 = 13 THEN concat('LRG_', CAST(p_partkey AS VARCHAR)) ELSE {ENS('p_partkey')} END AS id,
       CASE WHEN p_partkey % 50 = 7 THEN NULL ELSE upper(p_name) END AS approvedSymbol,
       CASE WHEN p_size % 5 = 0 THEN 'lncRNA' WHEN p_size % 11 = 0 THEN NULL ELSE 'protein_coding' END AS biotype,
       p_name AS approvedName,
       struct_pack(chromosome := CAST(p_size AS VARCHAR), start := p_partkey * 1000) AS genomicLocation
FROM part
UNION ALL
SELECT {ENS('p_partkey')}, concat('DUP_', p_name), 'protein_coding', p_name,
       struct_pack(chromosome := 'dup', start := p_partkey * 1000)
FROM part WHERE p_partkey % 40 = 3"""),
    "interactome": ([], f"""
SELECT CASE l.l_returnflag WHEN 'A' THEN 'intact' WHEN 'N' THEN 'string' ELSE 'reactome' END AS sourceDatabase,
       {ENS('h.hub_partkey')} AS targetA, concat('P', CAST(h.hub_partkey AS VARCHAR)) AS intA,
       {ENS('l.l_partkey')} AS targetB, concat('P', CAST(l.l_partkey AS VARCHAR)) AS intB,
       CAST(l.l_quantity AS INTEGER) AS count,
       CASE WHEN l.l_quantity = 50 THEN CAST(1.25 AS DOUBLE) WHEN l.l_quantity = 49 THEN NULL
            ELSE round(l.l_discount * 10, 2) + 0.0 END AS scoring
FROM lineitem l JOIN (SELECT l_orderkey, min(l_partkey) AS hub_partkey FROM lineitem GROUP BY l_orderkey) h
  ON l.l_orderkey = h.l_orderkey"""),
    "assoc": ([], """
SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey"""),
    "gwas_common": (["assoc"], f"""
SELECT 'gwas_credible_sets' AS datasourceId, {ENS('l_partkey')} AS targetId, {DIS} AS diseaseId,
       c_mktsegment AS diseaseFromSource, {SC} AS score,
       CAST(-l_linenumber * 3 AS INTEGER) AS pValueExponent,
       CAST(1 + CAST(round(l_tax * 100) AS INTEGER) AS DOUBLE) AS pValueMantissa,
       l_tax - 0.04 AS beta,
       CASE WHEN l_tax = 0 THEN NULL ELSE 1 + l_tax END AS oddsRatio,
       concat('v', CAST(l_suppkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS variantId,
       concat('rs', CAST(l_orderkey AS VARCHAR)) AS variantRsId,
       concat('GCST', CAST(o_custkey AS VARCHAR)) AS studyId,
       concat('SL', CAST(l_orderkey AS VARCHAR)) AS studyLocusId,
       'genetic_association' AS datatypeId,
       l_tax + 0.0 AS resourceScore,
       CASE WHEN l_linestatus = 'O' THEN 'risk' ELSE 'protect' END AS directionOnTrait
FROM assoc WHERE l_returnflag <> 'R'"""),
    "gwas_rare": (["assoc"], f"""
SELECT CASE WHEN l_linestatus = 'O' THEN 'eva' ELSE 'clinvar' END AS datasourceId,
       {ENS('l_partkey')} AS targetId, {DIS} AS diseaseId, c_mktsegment AS diseaseFromSource, {SC} AS score,
       CASE substr(o_orderpriority, 1, 1)
            WHEN '1' THEN ['Pathogenic']
            WHEN '2' THEN ['Likely pathogenic', 'Benign']
            WHEN '3' THEN ['Likely benign']
            WHEN '4' THEN ['Uncertain significance', CAST(NULL AS VARCHAR)]
            ELSE CAST(NULL AS VARCHAR[]) END AS clinicalSignificances,
       concat('v', CAST(l_suppkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)) AS variantId,
       concat('rs', CAST(l_orderkey AS VARCHAR)) AS variantRsId,
       concat('RCV', CAST(l_orderkey AS VARCHAR)) AS variantFromSourceId,
       'SO_0001583' AS variantFunctionalConsequenceId,
       ['germline'] AS alleleOrigins,
       'genetic_association' AS datatypeId,
       o_orderstatus AS confidence,
       CASE WHEN l_linestatus = 'O' THEN 'risk' ELSE 'protect' END AS directionOnTrait
FROM assoc WHERE l_returnflag = 'R'"""),
    "expression": ([], f"""
SELECT {ENS('l_partkey')} AS id,
       concat('UBERON_', lpad(CAST(s_nationkey AS VARCHAR), 7, '0')) AS efo_code,
       n_name AS label,
       (s_acctbal - CAST(1500.0 AS DOUBLE)) / CAST(10.0 AS DOUBLE) AS rna_value,
       CAST(l_linenumber - 4 AS INTEGER) AS rna_zscore,
       CAST(CASE WHEN l_quantity >= 49 THEN NULL ELSE l_linenumber - 2 END AS INTEGER) AS rna_level,
       'TPM' AS rna_unit, [n_name] AS organs, [r_name] AS anatomical_systems,
       CAST(l_linenumber % 4 AS INTEGER) AS protein_level,
       l_linestatus = 'O' AS protein_reliability
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
     JOIN region ON n_regionkey = r_regionkey"""),
    "diseases": ([], f"""
SELECT CASE WHEN c_nationkey < 22 THEN {DIS_NOTNULL} ELSE concat('OBSOLETE_', {DIS_NOTNULL}) END AS id, concat(c_mktsegment, ' ', n_name) AS name,
       concat('desc ', c_mktsegment) AS description, [c_mktsegment] AS therapeuticAreas,
       [concat('MONDO_', CAST(n_regionkey AS VARCHAR))] AS parents,
       [concat('MONDO_', CAST(n_regionkey AS VARCHAR))] AS ancestors,
       CAST([] AS VARCHAR[]) AS children, [lower(c_mktsegment)] AS synonyms
FROM (SELECT DISTINCT c_nationkey, c_mktsegment, n_name, n_regionkey
      FROM customer JOIN nation ON c_nationkey = n_nationkey)
UNION ALL
SELECT concat('MONDO_', CAST(r_regionkey AS VARCHAR)), r_name, CAST(NULL AS VARCHAR),
       CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]),
       CAST(NULL AS VARCHAR[])
FROM region"""),
    "ledger": ([], """
SELECT CAST(user_id AS VARCHAR) AS trait_id,
       CASE WHEN user_id % 3 = 0 OR event_type = 'error' THEN 'error' ELSE 'ok' END AS status,
       ts AS timestamp, value AS tiempo_s, event_id AS seq, event_type AS msg
FROM events"""),
    # ----------------------------------------------------------------- harmonised
    "h_genes": (["genes"], """
SELECT id, approvedSymbol, biotype, approvedName, genomicLocation FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY approvedSymbol ASC NULLS FIRST,
         approvedName ASC NULLS FIRST, biotype ASC NULLS FIRST, genomicLocation ASC NULLS FIRST) AS rn
  FROM genes WHERE biotype = 'protein_coding') WHERE rn = 1"""),
    "h_interactome": (["interactome", "h_genes"], """
SELECT sourceDatabase, targetA, intA, targetB, intB, count, scoring FROM (
  SELECT *, row_number() OVER (PARTITION BY targetA, targetB, sourceDatabase ORDER BY
         scoring DESC NULLS LAST, count DESC NULLS LAST, intA ASC NULLS FIRST, intB ASC NULLS FIRST) AS rn
  FROM interactome i
  WHERE scoring >= 0.5 AND NOT isnan(scoring)
    AND EXISTS (SELECT 1 FROM h_genes g WHERE g.id IS NOT DISTINCT FROM i.targetA)
    AND EXISTS (SELECT 1 FROM h_genes g WHERE g.id IS NOT DISTINCT FROM i.targetB)
    AND targetA <> targetB) WHERE rn = 1"""),
    "h_common": (["gwas_common", "h_genes"], """
SELECT * FROM gwas_common c
WHERE diseaseId IS NOT NULL AND score >= 0.5 AND NOT isnan(score)
  AND EXISTS (SELECT 1 FROM h_genes g WHERE g.id IS NOT DISTINCT FROM c.targetId)"""),
    "h_rare": (["gwas_rare", "h_genes"], """
SELECT * FROM gwas_rare r
WHERE diseaseId IS NOT NULL AND score >= 0.5 AND NOT isnan(score)
  AND EXISTS (SELECT 1 FROM h_genes g WHERE g.id IS NOT DISTINCT FROM r.targetId)
  AND (clinicalSignificances IS NULL
       OR len(list_filter(clinicalSignificances, lambda x: regexp_matches(x, '(?i)(benign|likely benign)'))) = 0)"""),
    "h_expression": (["expression", "h_genes"], """
SELECT * FROM expression e
WHERE rna_level >= 1 AND EXISTS (SELECT 1 FROM h_genes g WHERE g.id IS NOT DISTINCT FROM e.id)"""),
    "h_diseases": (["diseases", "h_common", "h_rare"], """
SELECT * FROM diseases d
WHERE EXISTS (SELECT 1 FROM (SELECT diseaseId FROM h_common UNION ALL SELECT diseaseId FROM h_rare) u
              WHERE u.diseaseId IS NOT DISTINCT FROM d.id)"""),
}


def with_ctes(names: list[str], body: str, extra: dict[str, tuple[list[str], str]] | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first)."""
    defs = dict(FIXTURE_CTES)
    defs.update(extra or {})
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in defs[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    ctes = ",\n".join(f"{n} AS ({defs[n][1]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


# ------------------------------------------------------------------ output formats
def D(c: str) -> str:
    return f"round({c}, 6) + 0.0 AS {c}"


def ARR(c: str) -> str:
    return f"array_to_string(list_transform({c}, lambda x: coalesce(x, 'NA')), '|') AS {c}"


def LOC(c: str) -> str:
    return f"concat_ws(':', {c}.chromosome, CAST({c}.start AS VARCHAR)) AS {c}"


SELECT_LISTS = {
    "genes": ["id", "approvedSymbol", "biotype", "approvedName", LOC("genomicLocation")],
    "interactome": ["sourceDatabase", "targetA", "intA", "targetB", "intB", "count", D("scoring")],
    "gwas_common": [
        "datasourceId", "targetId", "diseaseId", "diseaseFromSource", D("score"), "pValueExponent",
        D("pValueMantissa"), D("beta"), D("oddsRatio"), "variantId", "variantRsId", "studyId",
        "studyLocusId", "datatypeId", D("resourceScore"), "directionOnTrait",
    ],
    "gwas_rare": [
        "datasourceId", "targetId", "diseaseId", "diseaseFromSource", D("score"),
        ARR("clinicalSignificances"), "variantId", "variantRsId", "variantFromSourceId",
        "variantFunctionalConsequenceId", ARR("alleleOrigins"), "datatypeId", "confidence",
        "directionOnTrait",
    ],
    "expression": [
        "id", "efo_code", "label", D("rna_value"), "rna_zscore", "rna_level", "rna_unit", ARR("organs"),
        ARR("anatomical_systems"), "protein_level", "protein_reliability",
    ],
    "diseases": [
        "id", "name", "description", ARR("therapeuticAreas"), ARR("parents"), ARR("ancestors"),
        ARR("children"), ARR("synonyms"),
    ],
}

H_CTE = {
    "genes": "h_genes", "interactome": "h_interactome", "gwas_common": "h_common",
    "gwas_rare": "h_rare", "expression": "h_expression", "diseases": "h_diseases",
}


def _bigint(expr: str, name: str) -> str:
    return f"CAST({expr} AS BIGINT) AS {name}"


def UNIQ(c: str) -> str:
    return f"(count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0))"


def BADPAT(c: str) -> str:
    return f"count_if({c} IS NULL OR NOT regexp_matches({c}, '^ENSG\\d+'))"


def ORACLE() -> dict[str, str]:
    q: dict[str, str] = {}
    for ds, cols in SELECT_LISTS.items():
        q[f"read_{ds}"] = with_ctes([ds], f"SELECT {', '.join(cols)} FROM {ds}")
        q[f"harmonize_{ds}"] = with_ctes([H_CTE[ds]], f"SELECT {', '.join(cols)} FROM {H_CTE[ds]}")

    q["validate_genes"] = with_ctes(["genes"], f"""
SELECT {_bigint('count(*)', 'n_rows')},
       {_bigint('count_if(id IS NULL)', 'n_na_id')},
       {_bigint('count_if(approvedSymbol IS NULL)', 'n_na_approvedSymbol')},
       {_bigint(BADPAT('id'), 'n_bad_id')},
       {_bigint('count(*) - ' + UNIQ('id'), 'n_duplicate_ids')},
       {_bigint("count_if(biotype = 'protein_coding')", 'n_protein_coding')},
       {_bigint(UNIQ('id'), 'n_unique_ids')}
FROM genes""")

    q["validate_interactome"] = with_ctes(["interactome"], f"""
SELECT {_bigint('count(*)', 'n_rows')},
       {_bigint('count_if(targetA IS NULL)', 'n_na_targetA')},
       {_bigint('count_if(targetB IS NULL)', 'n_na_targetB')},
       {_bigint(BADPAT('targetA'), 'n_bad_targetA')},
       {_bigint(BADPAT('targetB'), 'n_bad_targetB')},
       {_bigint('count_if((scoring < 0 OR scoring > 1) AND NOT isnan(scoring))', 'n_scoring_out_of_range')},
       string_agg(DISTINCT sourceDatabase, ', ' ORDER BY sourceDatabase) AS sources,
       (SELECT {_bigint(UNIQ('g'), 'n')} FROM (SELECT targetA AS g FROM interactome
                                            UNION ALL SELECT targetB FROM interactome)) AS n_unique_genes
FROM interactome""")

    for ds in ["gwas_common", "gwas_rare"]:
        q[f"validate_{ds}"] = with_ctes([ds], f"""
SELECT {_bigint('count(*)', 'n_rows')},
       {_bigint('count_if(targetId IS NULL)', 'n_na_targetId')},
       {_bigint('count_if(diseaseId IS NULL)', 'n_na_diseaseId')},
       {_bigint(BADPAT('targetId'), 'n_bad_targetId')},
       {_bigint('count_if((score < 0 OR score > 1) AND NOT isnan(score))', 'n_score_out_of_range')},
       {_bigint(UNIQ('targetId'), 'n_genes')},
       {_bigint(UNIQ('diseaseId'), 'n_diseases')},
       string_agg(DISTINCT datasourceId, ', ' ORDER BY datasourceId) AS sources
FROM {ds}""")

    q["validate_expression"] = with_ctes(["expression"], f"""
SELECT {_bigint('count(*)', 'n_rows')},
       {_bigint('count_if(id IS NULL)', 'n_na_id')},
       {_bigint('count_if(efo_code IS NULL)', 'n_na_efo_code')},
       {_bigint(BADPAT('id'), 'n_bad_id')},
       {_bigint('count_if(rna_value < 0)', 'n_negative_rna_value')},
       {_bigint('count_if(rna_level IS NULL OR rna_level NOT IN (-1, 0, 1, 2, 3))', 'n_bad_rna_level')},
       {_bigint(UNIQ('id'), 'n_genes')},
       {_bigint(UNIQ('efo_code'), 'n_tissues')}
FROM expression""")

    q["validate_diseases"] = with_ctes(["diseases"], f"""
SELECT {_bigint('count(*)', 'n_rows')},
       {_bigint('count_if(id IS NULL)', 'n_na_id')},
       {_bigint('count_if(name IS NULL)', 'n_na_name')}
FROM diseases""")

    cov = []
    parts = {
        "ppi_genes_cov": ("(SELECT id AS k, count(*) AS w FROM genes GROUP BY id)",
                          "(SELECT targetA AS r FROM interactome UNION ALL SELECT targetB FROM interactome)"),
        "gwas_comun_genes_cov": ("(SELECT DISTINCT targetId AS k, 1 AS w FROM gwas_common)", "(SELECT id AS r FROM genes)"),
        "gwas_comun_dis_cov": ("(SELECT DISTINCT diseaseId AS k, 1 AS w FROM gwas_common)", "(SELECT id AS r FROM diseases)"),
        "gwas_rara_genes_cov": ("(SELECT DISTINCT targetId AS k, 1 AS w FROM gwas_rare)", "(SELECT id AS r FROM genes)"),
        "gwas_rara_dis_cov": ("(SELECT DISTINCT diseaseId AS k, 1 AS w FROM gwas_rare)", "(SELECT id AS r FROM diseases)"),
        "expresion_genes_cov": ("(SELECT DISTINCT id AS k, 1 AS w FROM expression)", "(SELECT id AS r FROM genes)"),
    }
    for name, (keys, ref) in parts.items():
        ratio = (f"(SELECT 100.0 * sum(CASE WHEN EXISTS (SELECT 1 FROM {ref} rr WHERE rr.r IS NOT DISTINCT FROM kk.k)"
                 f" THEN w ELSE 0 END) / sum(w) FROM {keys} kk)")
        cov.append(f"round_even(CAST({ratio} AS DOUBLE), 1) AS {name}")
        cov.append(f"round(CAST({ratio} AS DOUBLE), 6) + 0.0 AS {name}_raw")
    q["validate_cross"] = with_ctes(
        ["genes", "interactome", "gwas_common", "gwas_rare", "expression", "diseases"],
        "SELECT " + ",\n       ".join(cov),
    )

    q["ledger_pending"] = with_ctes(["ledger"], """
SELECT DISTINCT trait_id FROM ledger
WHERE trait_id NOT IN (SELECT trait_id FROM ledger WHERE status = 'ok')""")
    q["ledger_summary"] = with_ctes(["ledger"], f"""
SELECT {_bigint("count(DISTINCT CASE WHEN status = 'ok' THEN trait_id END)", 'n_ok')},
       {_bigint('count(DISTINCT trait_id)', 'n_total')},
       {_bigint('count(*)', 'n_entries')},
       round(sum(tiempo_s), 6) AS tiempo_total,
       {_bigint("count(DISTINCT trait_id) - count(DISTINCT CASE WHEN status = 'ok' THEN trait_id END)", 'n_err')}
FROM ledger""")
    q.update(NET_ORACLE(PPR_ROUNDS, 0.15, HUB_ROUNDS, CORE_ROUNDS))
    q["ledger_eta"] = with_ctes(["ledger"], """
SELECT rn, trait_id, status, mean_recent_s, n - rn AS remaining,
       CASE WHEN n - rn <= 0 THEN NULL ELSE round(mean_recent_s * (n - rn), 4) END AS eta_s
FROM (SELECT *, round(avg(tiempo_s) OVER (ORDER BY rn ROWS BETWEEN 9 PRECEDING AND CURRENT ROW), 6) AS mean_recent_s
      FROM (SELECT *, row_number() OVER (ORDER BY timestamp ASC NULLS FIRST, seq ASC NULLS FIRST) AS rn,
                   count(*) OVER () AS n FROM ledger))""")
    return q


# ------------------------------------------------------------------ 2.B (network)
NET_CTES: dict[str, tuple[list[str], str]] = {
    "graph": (["h_interactome"], """
SELECT least(targetA, targetB) AS gene_a, greatest(targetA, targetB) AS gene_b,
       max(scoring) AS weight, count(DISTINCT sourceDatabase) AS n_sources
FROM h_interactome WHERE targetA <> targetB GROUP BY 1, 2"""),
    "dedges": (["graph"], """
SELECT gene_a AS src, gene_b AS dst, weight FROM graph
UNION ALL SELECT gene_b, gene_a, weight FROM graph"""),
    "nodes": (["graph"], "SELECT gene_a AS gene_id FROM graph UNION SELECT gene_b FROM graph"),
    "layers_raw": (["h_common", "h_rare", "h_expression"], """
SELECT diseaseId AS trait_id, 'gwas_comun' AS capa, targetId AS gene_id, CAST(score AS DOUBLE) AS score FROM h_common
UNION ALL SELECT diseaseId, 'gwas_rara', targetId, CAST(score AS DOUBLE) FROM h_rare
UNION ALL SELECT efo_code, 'expresion', id, CAST(rna_level AS DOUBLE) / CAST(3 AS DOUBLE) FROM h_expression"""),
    "layers": (["layers_raw"], """
SELECT * FROM (SELECT trait_id, capa, gene_id, max(score) AS score FROM layers_raw GROUP BY ALL) p
WHERE EXISTS (SELECT 1 FROM (SELECT trait_id, capa FROM layers_raw GROUP BY ALL
                             HAVING count(DISTINCT gene_id) >= 2) k
              WHERE k.trait_id = p.trait_id AND k.capa = p.capa)"""),
    "seeds": (["layers", "nodes"], """
SELECT trait_id, capa, gene_id, raw / sum(raw) OVER (PARTITION BY trait_id, capa) AS seed
FROM (SELECT trait_id, capa, gene_id, score * 1.0 AS raw FROM layers
      WHERE gene_id IN (SELECT gene_id FROM nodes) AND score * 1.0 > 0)"""),
    "normed": (["layers"], """
SELECT l.trait_id, l.capa, l.gene_id, l.score,
       round(CASE WHEN s.mx - s.mn = 0 THEN 0.0 ELSE (l.score - s.mn) / (s.mx - s.mn) END, 12) AS norm_score
FROM layers l JOIN (SELECT trait_id, capa, min(score) AS mn, max(score) AS mx FROM layers GROUP BY ALL) s
  ON l.trait_id = s.trait_id AND l.capa = s.capa"""),
    "integrated": (["normed"], """
SELECT trait_id, gene_id, round(sum(ws) / sum(w), 12) AS score_mean, round(median(ws), 12) AS score_median,
       round(max(ws), 12) AS score_max, count(*) AS n_layers, round(sum(ws) / sum(w), 12) AS score
FROM (SELECT *, 1.0 AS w, 1.0 * norm_score AS ws FROM normed) GROUP BY trait_id, gene_id"""),
    "tedges": (["dedges"], """
SELECT src, dst, weight / sum(weight) OVER (PARTITION BY src) AS weight FROM dedges"""),
}


#: (trait, layer) keys that stand side by side as columns in the rank rounds.
PPR_BLOCK = 32


def _ppr_ctes(iterations: int, alpha: float) -> dict[str, tuple[list[str], str]]:
    """Rounds over rows (block of keys, node) with a column for each key, so that an edge is joined once a block."""
    cols = [f"v{j}" for j in range(PPR_BLOCK)]
    pick = ", ".join(f"sum(CASE WHEN k % {PPR_BLOCK} = {j} THEN seed ELSE 0.0 END) AS {c}" for j, c in enumerate(cols))
    out: dict[str, tuple[list[str], str]] = {
        "keyed": (["seeds"], """
SELECT *, dense_rank() OVER (ORDER BY trait_id, capa) - 1 AS k FROM seeds"""),
        "r0": (["keyed"], f"SELECT k // {PPR_BLOCK} AS block, gene_id AS node, {pick} FROM keyed GROUP BY ALL"),
        "restart": (["r0"], f"SELECT block, node, {', '.join(f'{alpha} * {c} AS {c}' for c in cols)} FROM r0"),
    }
    walk = ", ".join(f"{1.0 - alpha} * r.{c} * e.weight AS {c}" for c in cols)
    total = ", ".join(f"sum({c}) AS {c}" for c in cols)
    for i in range(1, iterations + 1):
        out[f"r{i}"] = ([f"r{i - 1}", "tedges", "restart"], f"""
SELECT block, node, {total} FROM (
  SELECT r.block, e.dst AS node, {walk} FROM r{i - 1} r JOIN tedges e ON r.node = e.src
  UNION ALL SELECT * FROM restart) GROUP BY block, node""")
    out["ranks"] = ([f"r{iterations}", "keyed"], f"""
SELECT t.trait_id, t.capa, x.node AS gene_id, x.rank
FROM (SELECT node, block * {PPR_BLOCK} + unnest(range({PPR_BLOCK})) AS k, unnest([{', '.join(cols)}]) AS rank FROM r{iterations}) x
JOIN (SELECT DISTINCT k, trait_id, capa FROM keyed) t ON t.k = x.k WHERE x.rank > 0""")
    return out


def _hits_ctes(iterations: int) -> dict[str, tuple[list[str], str]]:
    out: dict[str, tuple[list[str], str]] = {
        "x0": (["dedges"], "SELECT DISTINCT src AS node, 1.0 AS x FROM dedges"),
    }
    for i in range(1, iterations + 1):
        out[f"y{i}"] = ([f"x{i - 1}", "dedges"], f"""
SELECT e.dst AS node, sum(x.x * e.weight) AS x FROM x{i - 1} x JOIN dedges e ON x.node = e.src GROUP BY e.dst""")
        out[f"z{i}"] = ([f"y{i}", "dedges"], f"""
SELECT e.dst AS node, sum(y.x * e.weight) AS x FROM y{i} y JOIN dedges e ON y.node = e.src GROUP BY e.dst""")
        out[f"x{i}"] = ([f"z{i}"], f"SELECT node, x / (SELECT max(x) FROM z{i}) AS x FROM z{i}")
    return out


def _core_ctes(rounds: int) -> dict[str, tuple[list[str], str]]:
    out: dict[str, tuple[list[str], str]] = {
        "c0": (["dedges"], "SELECT src AS node, count(*) AS c FROM dedges GROUP BY src"),
    }
    for i in range(1, rounds + 1):
        out[f"c{i}"] = ([f"c{i - 1}", "dedges"], f"""
SELECT node, max(least(v, ge)) AS c FROM (
  SELECT node, v, sum(n) OVER (PARTITION BY node ORDER BY v DESC) AS ge FROM (
    SELECT e.src AS node, c.c AS v, count(*) AS n FROM dedges e JOIN c{i - 1} c ON e.dst = c.node GROUP BY ALL))
GROUP BY node""")
    return out


def NET_ORACLE(propagation_iterations: int, alpha: float, hub_iterations: int, core_rounds: int) -> dict[str, str]:
    def w(names, body, extra=None):
        e = dict(NET_CTES)
        e.update(extra or {})
        return with_ctes(names, body, e)

    q: dict[str, str] = {}
    q["interaction_graph"] = w(["graph"], "SELECT gene_a, gene_b, round(weight, 6) + 0.0 AS weight, n_sources FROM graph")
    q["trait_layers"] = w(["layers"], "SELECT trait_id, capa, gene_id, round(score, 6) + 0.0 AS score FROM layers")
    q["select_traits"] = w(["layers", "h_diseases"], """
SELECT DISTINCT trait_id FROM layers
WHERE trait_id IN (SELECT id FROM h_diseases
                   WHERE len(list_intersect(therapeuticAreas, ['AUTOMOBILE', 'MACHINERY'])) > 0)
  AND trait_id NOT IN ('EFO_001_AU')""")
    q["seed_scores"] = w(["seeds"], "SELECT trait_id, capa, gene_id, round(seed, 6) + 0.0 AS seed FROM seeds")
    q["node_metrics"] = w(["dedges"], """
SELECT src AS gene_id, count(*) AS degree, round(sum(weight), 6) + 0.0 AS strength FROM dedges GROUP BY src""")
    q["association_strength"] = w(["h_common"], """
SELECT diseaseId AS trait_id, targetId AS gene_id, variantId, studyId,
       round(-(log10(pValueMantissa) + CAST(pValueExponent AS DOUBLE)), 6) + 0.0 AS neg_log10_p
FROM h_common""")
    q["annotate_traits"] = w(["layers", "h_diseases"], """
SELECT t.trait_id, d.name AS trait_name,
       unnest(CASE WHEN d.therapeuticAreas IS NULL OR len(d.therapeuticAreas) = 0
                   THEN [CAST(NULL AS VARCHAR)] ELSE d.therapeuticAreas END) AS therapeutic_area
FROM (SELECT DISTINCT trait_id FROM layers) t LEFT JOIN h_diseases d ON d.id = t.trait_id""")
    q["normalize_layers"] = w(["normed"], """
SELECT trait_id, capa, gene_id, round(score, 6) + 0.0 AS score, round(norm_score, 6) + 0.0 AS norm_score FROM normed""")
    q["integrate_layers"] = w(["integrated"], """
SELECT trait_id, gene_id, round(score_mean, 6) + 0.0 AS score_mean, round(score_median, 6) + 0.0 AS score_median,
       round(score_max, 6) + 0.0 AS score_max, n_layers, round(score, 6) + 0.0 AS score FROM integrated""")
    q["rank_genes"] = w(["integrated"], """
SELECT trait_id, gene_id, round(score_mean, 6) + 0.0 AS score_mean, round(score_median, 6) + 0.0 AS score_median,
       round(score_max, 6) + 0.0 AS score_max, n_layers, round(score, 6) + 0.0 AS score, rank, n_genes
FROM (SELECT *, row_number() OVER (PARTITION BY trait_id ORDER BY score DESC, gene_id ASC) AS rank,
             count(*) OVER (PARTITION BY trait_id) AS n_genes
      FROM integrated WHERE score >= 0.1)
WHERE rank <= ceil(0.25 * n_genes)""")
    q["propagate"] = w(["ranks"], "SELECT trait_id, capa, gene_id, round(rank, 6) + 0.0 AS rank FROM ranks",
                       _ppr_ctes(propagation_iterations, alpha))
    xl = f"x{hub_iterations}"
    q["hub_score"] = w([xl], f"SELECT node AS gene_id, round(x, 6) + 0.0 AS hub_score FROM {xl}",
                       _hits_ctes(hub_iterations))
    cl = f"c{core_rounds}"
    q["coreness"] = w([cl], f"SELECT node AS gene_id, c AS coreness FROM {cl}", _core_ctes(core_rounds))
    return q
