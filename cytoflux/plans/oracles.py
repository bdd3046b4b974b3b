"""DuckDB SQL for the named queries, written from the definitions and not from the plans."""

from __future__ import annotations

R1, R2 = "0.21356677091082193", "104.95163748636298"
C1, C2 = "0.2474528917555431", "162.03696139428595"
PATTERN = "ACTGAAAATTTCGGGCCCCATTTGACT"
A6 = "ACTGID"


def tail(k: str, n: str, a: str, b: str) -> str:
    term = f"exp(lgamma({n}+1)-lgamma(i+1)-lgamma({n}-i+1)+lgamma(i+{a})+lgamma({n}-i+{b})-lgamma({n}+{a}+{b})-lgamma({a})-lgamma({b})+lgamma({a}+{b}))"
    return f"CASE WHEN {k} <= 0 OR {n} <= 0 THEN 1.0::DOUBLE ELSE round(list_sum(list_transform(range(({k})::BIGINT, ({n})::BIGINT + 1), lambda i: {term})), 4) END"


def place(key: str) -> str:
    return f"CASE WHEN {key} % 50 = 0 THEN 'chrM' ELSE 'chr' || ({key} % 22 + 1) END AS chrom, ({key} * 7 + ({key} % 13) * 40)::BIGINT AS pos"


def letter(letters: str, n: str) -> str:
    return f"substr('{letters}', ({n} + 1)::BIGINT, 1)"


def kind(key: str) -> str:
    return f"CASE WHEN {key} % 2 = 0 THEN 'Cancer' ELSE 'Non-Cancer' END"


RB = f"""rb AS (SELECT l_returnflag AS sample_id, {place('l_partkey')}, {letter('ACTG', 'l_partkey % 4')} AS ref,
 CASE WHEN l_partkey % 5 = 0 THEN CASE WHEN l_suppkey % 2 = 0 AND (l_orderkey + l_linenumber) % 3 <> 0 THEN {letter('CTGA', 'l_partkey % 4')} ELSE {letter('ACTG', 'l_partkey % 4')} END
 WHEN (l_orderkey * 7 + l_linenumber) % 10 < 8 THEN {letter('ACTG', 'l_partkey % 4')} ELSE {letter('ACTGID', '(l_orderkey + l_linenumber) % 6')} END AS allele,
 'CB' || l_suppkey AS cb, {kind('l_suppkey')} AS cell_type, l_quantity::INT AS bq, l_linestatus = 'F' AS rev FROM lineitem)"""


#: Reads made like the adapter's, their operations with what lies before each, and one row per covered place.
ALIGNED = rf"""lr AS (SELECT row_number() OVER () AS id, l_returnflag AS sample_id, {place('l_partkey')}, l_orderkey, replace(['20M', '5S8M2I5M', '6M3D14M', '7M{{}}N13M', '3H4S10M1P2I4M2P', '9=1X5M1D2I3M', '7M{{}}N2I11M'][((l_orderkey + l_linenumber) % 7 + 1)::INT], '{{}}', (l_orderkey % 50 + 20)::VARCHAR) AS cigar,
  substr(repeat('{PATTERN}', 2), (l_orderkey % 27 + 1)::INT, 20) AS seq, l_quantity::INT AS q, 'CB' || l_suppkey AS cb, {kind('l_suppkey')} AS cell_type, l_linestatus = 'F' AS rev FROM lineitem),
 lo AS (SELECT *, unnest(regexp_extract_all(cigar, '(\d+)([MIDNS=X])', 1))::INT AS n, unnest(regexp_extract_all(cigar, '(\d+)([MIDNS=X])', 2)) AS op, unnest(range(len(regexp_extract_all(cigar, '\d+[MIDNS=X]')))) AS k FROM lr),
 ls AS (SELECT *, sum(CASE WHEN op NOT IN ('I', 'S') THEN n ELSE 0 END) OVER w - CASE WHEN op NOT IN ('I', 'S') THEN n ELSE 0 END AS ahead, sum(CASE WHEN op NOT IN ('D', 'N') THEN n ELSE 0 END) OVER w - CASE WHEN op NOT IN ('D', 'N') THEN n ELSE 0 END AS begun FROM lo WINDOW w AS (PARTITION BY id ORDER BY k)),
 ln AS (SELECT *, lead(op) OVER w AS op2, lead(n) OVER w AS n2, lead(begun) OVER w AS begun2 FROM ls WINDOW w AS (PARTITION BY id ORDER BY k)),
 lp AS (SELECT *, unnest(range(n)) AS o FROM ln WHERE op IN ('M', '=', 'X', 'D', 'N')),
 lt AS (SELECT sample_id, chrom, (pos + l_orderkey % 3 + ahead + o)::BIGINT AS pos, cb, cell_type, rev, ((q + (begun + CASE WHEN op IN ('D', 'N') THEN 0 ELSE o END) * 7) % 41)::INT AS bq,
  CASE WHEN op = 'D' THEN '*' WHEN op = 'N' THEN CASE WHEN rev THEN '<' ELSE '>' END ELSE substr(seq, (begun + o + 1)::INT, 1) END || CASE WHEN o < n - 1 THEN '' WHEN op2 = 'I' THEN '+' || n2 || substr(seq, (begun2 + 1)::INT, n2) WHEN op2 = 'D' AND op <> 'D' THEN '-' || n2 || repeat('N', n2) ELSE '' END AS token
  FROM lp WHERE op <> 'N' OR (op2 = 'I' AND o = n - 1)),
 al AS (SELECT *, CASE WHEN rev THEN lower(token) ELSE token END AS raw_base FROM lt)"""


def counted(source: str = "rb", keys: str = "chrom, pos, ref, cell_type", dp: int = 5, cells: int = 5) -> str:
    cols = []
    for x in A6:
        i = x.lower()
        cols += [f"count(DISTINCT CASE WHEN allele = '{x}' THEN cb END) AS cc_{i}", f"count(*) FILTER (allele = '{x}') AS bc_{i}", f"coalesce(sum(bq) FILTER (allele = '{x}'), 0)::BIGINT AS bq_{i}"]
        cols += [f"count(*) FILTER (allele = '{x}' AND NOT rev) AS bcf_{i}", f"count(*) FILTER (allele = '{x}' AND rev) AS bcr_{i}"]
    return f"SELECT {keys}, count(*) AS dp, count(DISTINCT cb) AS nc, {', '.join(cols)} FROM {source} WHERE bq >= 5 GROUP BY {keys} HAVING count(*) >= {dp} AND count(DISTINCT cb) >= {cells}"


CNT = f"{RB}, cnt0 AS ({counted()}), cnt AS (SELECT *, (dp >= 8 AND nc >= 5) AS ok, bc_a+bc_c+bc_t+bc_g+bc_i+bc_d - CASE ref WHEN 'A' THEN bc_a WHEN 'C' THEN bc_c WHEN 'T' THEN bc_t ELSE bc_g END AS alt_bc, cc_a+cc_c+cc_t+cc_g+cc_i+cc_d - CASE ref WHEN 'A' THEN cc_a WHEN 'C' THEN cc_c WHEN 'T' THEN cc_t ELSE cc_g END AS alt_cc FROM cnt0)"
AL = (
    f"{CNT}, al0 AS ("
    + " UNION ALL ".join(f"SELECT chrom, pos, ref, cell_type, dp, nc, '{x}' AS alt, bc_{x.lower()} AS bc, cc_{x.lower()} AS cc FROM cnt WHERE ok AND ref <> '{x}' AND bc_{x.lower()} > 0" for x in "ACGT")
    + f"), al AS MATERIALIZED (SELECT *, round(bc::DOUBLE / dp, 4) AS vaf, round(cc::DOUBLE / nc, 4) AS mcf, {tail('bc', 'dp', R1, R2)} AS p_bc, {tail('cc', 'nc', C1, C2)} AS p_cc FROM al0)"
)
CT = f"""{AL}, ct AS (SELECT chrom, pos, ref, cell_type, any_value(dp) AS dp, any_value(nc) AS nc, count(*) AS n, string_agg(alt, '|' ORDER BY alt) AS alts, sum(bc)::BIGINT AS s_bc, sum(cc)::BIGINT AS s_cc,
 arg_min(alt, alt) AS alt, arg_min(bc, alt) AS bc, arg_min(cc, alt) AS cc, arg_min(vaf, alt) AS vaf, arg_min(mcf, alt) AS mcf,
 CASE WHEN min(p_bc) >= 0.05 OR min(p_cc) >= 0.05 THEN 'Non-Significant' WHEN (min(p_bc) > 0.001 AND min(p_bc) < 0.05) OR (min(p_cc) > 0.001 AND min(p_cc) < 0.05) THEN 'Low-Significance'
 WHEN count(*) > 1 THEN 'Multi-allelic' WHEN arg_min(cc, alt) < 2 THEN 'Low_cells' WHEN arg_min(bc, alt) < 3 THEN 'Low_reads' ELSE 'PASS' END AS filter FROM al GROUP BY chrom, pos, ref, cell_type)"""
SITE = f"""{CT}, site AS (SELECT c.chrom, c.pos, c.ref, count(*) FILTER (ok) AS n_callable, sum(CASE WHEN ok THEN alt_bc ELSE 0 END - coalesce(s_bc, 0))::BIGINT AS rest_bc, sum(CASE WHEN ok THEN alt_cc ELSE 0 END - coalesce(s_cc, 0))::BIGINT AS rest_cc,
 sum(CASE WHEN ok THEN c.dp ELSE 0 END - coalesce(s_bc, 0))::BIGINT AS rest_dp, sum(CASE WHEN ok THEN c.nc ELSE 0 END - coalesce(s_cc, 0))::BIGINT AS rest_nc, count(ct.filter) AS n_calls, count(DISTINCT alts) AS n_alts,
 count(*) FILTER (ct.filter = 'PASS') AS n_pass, count(*) FILTER (ct.filter = 'Non-Significant') AS n_non, count(*) FILTER (ct.filter = 'Multi-allelic') AS n_multi, list(alts) FILTER (alts IS NOT NULL) AS all_alts,
 string_agg(ct.filter, ',' ORDER BY c.cell_type) AS filters0, arg_min(ct.alt, c.cell_type) AS first_alt FROM cnt c LEFT JOIN ct ON c.chrom = ct.chrom AND c.pos = ct.pos AND c.cell_type = ct.cell_type GROUP BY c.chrom, c.pos, c.ref),
 noise AS (SELECT *, CASE WHEN rest_bc > 0 THEN {tail('rest_bc', 'rest_dp', R1, R2)} ELSE 1.0 END AS p_noise_bc, CASE WHEN rest_bc > 0 THEN {tail('rest_cc', 'rest_nc', C1, C2)} ELSE 1.0 END AS p_noise_cc FROM site)"""
CTX = f"ctx AS (SELECT {place('p_partkey')}, substr('{PATTERN}', p_partkey % 22 + 1, 5) AS up, substr('{PATTERN[::-1]}', p_partkey % 22 + 1, 5) AS down FROM part)"
RUNS = "'AAAA|CCCC|GGGG|TTTT|NNNN'"
STEP1 = f"""{SITE}, {CTX}, tagged AS (SELECT n.*, list_filter([CASE WHEN n_pass > 1 THEN 'Multiple_cell_types' END, CASE WHEN n_alts > 1 OR n_multi > 0 THEN 'Multi-allelic' END, CASE WHEN n_callable < 2 THEN 'Min_cell_types' END,
 CASE WHEN n_calls > n_pass + n_non THEN 'Cell_type_noise' END, CASE WHEN p_noise_bc < 0.05 OR p_noise_cc < 0.05 THEN 'Noisy_site' END,
 CASE WHEN len(list_filter(all_alts, lambda a: regexp_matches(up || a, {RUNS}))) > 0 THEN 'LC_Upstream' END, CASE WHEN len(list_filter(all_alts, lambda a: regexp_matches(a || down, {RUNS}))) > 0 THEN 'LC_Downstream' END], lambda x: x IS NOT NULL) AS tg
 FROM noise n JOIN ctx USING (chrom, pos) WHERE n_calls > 0), step1 AS (SELECT *, CASE WHEN len(tg) > 0 THEN tg WHEN n_pass > 0 THEN []::VARCHAR[] ELSE string_split(filters0, ',') END AS filters FROM tagged)"""


def black(k: int) -> str:
    return f"(chrom, pos) IN (SELECT (chrom, pos) FROM (SELECT {place('p_partkey')} FROM part WHERE p_size % 20 = {k}))"


STEP2 = f"""{STEP1}, af AS (SELECT {place('p_partkey')}, {letter('ACTG', 'p_partkey % 4')} AS ref, {letter('CTGA', 'p_partkey % 4')} AS first_alt, (p_partkey % 200) / 10000.0::DOUBLE AS af FROM part WHERE p_partkey % 4 = 0),
 near AS (SELECT *, lag(pos) OVER w AS before, lead(pos) OVER w AS behind FROM step1 WINDOW w AS (PARTITION BY chrom ORDER BY pos)),
 step2 AS (SELECT n.* EXCLUDE (filters), coalesce(af.af, 0)::DOUBLE AS af, list_concat(filters, list_filter([CASE WHEN {black(1)} THEN 'RNA_editing_db' END, CASE WHEN pos - before BETWEEN 1 AND 10 OR behind - pos BETWEEN 1 AND 10 THEN 'Clustered' END,
 CASE WHEN {black(2)} THEN 'PoN_SR' END, CASE WHEN {black(3)} THEN 'PoN_LR' END, CASE WHEN coalesce(af.af, 0) >= 0.01 THEN 'gnomAD' END], lambda x: x IS NOT NULL)) AS filters FROM near n LEFT JOIN af USING (chrom, pos, ref, first_alt))"""


def vec(prefix: str, x: str, t: str) -> str:
    return "CASE " + x + " " + " ".join(f"WHEN '{a}' THEN {t}.{prefix}_{a.lower()}" for a in "ACTG") + " END"


def zeroed(t: str) -> str:
    return "[" + ", ".join(f"CASE WHEN s.ref = '{a}' THEN 0 ELSE {t}.bc_{a.lower()} END" for a in "ACTG") + "]"


MAJOR = f"""{STEP2}, m0 AS (SELECT s.chrom, s.pos, s.ref, s.filters, (list_contains(s.filters, 'Multi-allelic') OR ca.n > 1 OR coalesce(no.n, 0) > 1) AS several, {zeroed('cac')} AS reads, ca.alt AS ca_alt, ca.bc AS ca_bc, ca.cc AS ca_cc, ca.vaf AS ca_vaf, ca.mcf AS ca_mcf, ca.dp AS ca_dp, ca.nc AS ca_nc, ca.filter AS ca_filter,
 no.alt AS no_alt, no.bc AS no_bc, no.cc AS no_cc, no.vaf AS no_vaf, no.mcf AS no_mcf, no.dp AS no_dp, no.nc AS no_nc, no.filter AS no_filter, no.alt IS NULL AS alone, cac AS cac, noc AS noc
 FROM step2 s JOIN ct ca ON s.chrom = ca.chrom AND s.pos = ca.pos AND ca.cell_type = 'Cancer' LEFT JOIN ct no ON s.chrom = no.chrom AND s.pos = no.pos AND no.cell_type = 'Non-Cancer'
 LEFT JOIN cnt cac ON s.chrom = cac.chrom AND s.pos = cac.pos AND cac.cell_type = 'Cancer' LEFT JOIN cnt noc ON s.chrom = noc.chrom AND s.pos = noc.pos AND noc.cell_type = 'Non-Cancer'),
 m1 AS (SELECT *, CASE WHEN several THEN ['A','C','T','G'][list_position(reads, list_max(reads))] ELSE ca_alt END AS alt FROM m0),
 m2 AS (SELECT *, {vec('bc', 'alt', 'cac')} AS x_ca_bc, {vec('cc', 'alt', 'cac')} AS x_ca_cc, {vec('bc', 'alt', 'noc')} AS x_no_bc, {vec('cc', 'alt', 'noc')} AS x_no_cc FROM m1),
 major AS (SELECT chrom, pos, ref, alt, several AND coalesce(list_reverse_sort(reads)[2]::DOUBLE / nullif(list_max(reads), 0) >= 0.05, false) AS multi, CASE WHEN several AND alone THEN list_filter(filters, lambda f: f <> 'Multi-allelic') ELSE filters END AS filters, alone, ca_dp, no_dp, ca_filter, no_filter, cac.dp AS cac_dp, noc.dp AS noc_dp, x_ca_bc, x_ca_cc,
 CASE WHEN several THEN x_ca_bc ELSE ca_bc END AS ca_bc, CASE WHEN several THEN x_ca_cc ELSE ca_cc END AS ca_cc, CASE WHEN several THEN round(x_ca_bc::DOUBLE / ca_dp, 4) ELSE ca_vaf END AS ca_vaf, CASE WHEN several THEN round(x_ca_cc::DOUBLE / ca_nc, 4) ELSE ca_mcf END AS ca_mcf,
 CASE WHEN alone THEN NULL WHEN several THEN x_no_bc ELSE no_bc END AS no_bc, CASE WHEN alone THEN NULL WHEN several THEN round(x_no_bc::DOUBLE / no_dp, 4) ELSE no_vaf END AS no_vaf, CASE WHEN alone THEN NULL WHEN several THEN round(x_no_cc::DOUBLE / no_nc, 4) ELSE no_mcf END AS no_mcf FROM m2)"""
CHRM = "list_has_any(filters, ['Min_cell_types','PoN_LR','gnomAD','LC_Upstream','LC_Downstream','RNA_editing_db'])"
HCCV_DROPS = "list_has_any(filters, ['Noisy_site','LC_Upstream','LC_Downstream','gnomAD','RNA_editing_db','PoN_SR','PoN_LR'])"
DROPS = "list_has_any(filters, ['Min_cell_types','Cell_type_noise','Noisy_site','LC_Upstream','LC_Downstream','gnomAD','RNA_editing_db','PoN_SR','PoN_LR'])"
CHRM_TAG = """CASE WHEN NOT alone THEN CASE WHEN ca_dp < 100 OR no_dp < 100 THEN 'LowDepth' WHEN ca_vaf - no_vaf < 0.05 THEN 'LowDeltaVAF' WHEN ca_mcf - no_mcf < 0.3 THEN 'LowDeltaMCF' END
 ELSE CASE WHEN ca_dp < 100 THEN 'LowDepth' WHEN ca_vaf < 0.05 THEN 'LowVAF' WHEN ca_mcf < 0.05 THEN 'LowMCF' END END"""
SUPPORT = "CASE WHEN cac_dp IS NULL THEN 'NoCov' WHEN x_ca_bc < 3 OR x_ca_cc < 2 THEN 'LowDepth' END"
CONSISTENT = "CASE WHEN ca_filter IN ('Non-Significant', 'Low-Significance') THEN 'CancerNonSig' WHEN no_filter IN ('PASS', 'Low-Significance') THEN 'NonCancerSig' END"
FINAL = f"""{MAJOR}, f0 AS (SELECT *, list_filter(CASE WHEN chrom = 'chrM' THEN [CASE WHEN multi THEN 'Multi-Allelic' END, {CHRM_TAG}] ELSE [CASE WHEN multi THEN 'Multi-Allelic' END, {SUPPORT}, {CONSISTENT}] END, lambda x: x IS NOT NULL) AS fin FROM major WHERE CASE WHEN chrom = 'chrM' THEN NOT {CHRM} ELSE NOT {DROPS} END),
 f1 AS (SELECT chrom, pos, alt FROM (SELECT *, lag(pos) OVER w AS b, lead(pos) OVER w AS a FROM f0 WHERE len(fin) = 0 WINDOW w AS (PARTITION BY chrom ORDER BY pos, alt)) WHERE chrom <> 'chrM' AND (pos - b < 400 OR a - pos < 400)),
 final AS (SELECT f0.*, chrom || ':' || pos || ':' || alt AS key, CASE WHEN f1.pos IS NOT NULL THEN list_append(fin, 'Clust_dist_400') ELSE fin END AS tags FROM f0 LEFT JOIN f1 USING (chrom, pos, alt))"""
HCCV = f"""{MAJOR}, h0 AS (SELECT *, chrom || ':' || pos || ':' || alt AS key, CASE WHEN alone THEN CASE WHEN ca_vaf >= 0.2 AND ca_mcf >= 0.25 THEN 'PASS' ELSE 'Low VAF/MCF' END ELSE CASE WHEN ca_vaf < 0.05 THEN 'NonSig' WHEN no_vaf > 0.1 AND ca_vaf - no_vaf < 0.4 THEN 'Heterozygous' WHEN no_vaf > 0.2 THEN 'Heterozygous' WHEN ca_mcf - no_mcf < 0.25 THEN 'LowDeltaMCF' ELSE 'PASS' END END AS hccv
 FROM major WHERE NOT multi AND cac_dp >= 8 AND noc_dp >= 8 AND CASE WHEN chrom = 'chrM' THEN NOT {CHRM} ELSE NOT {HCCV_DROPS} END)"""
EV = "ev AS (SELECT event_type || '--g' || (event_id % 40) || 'x' AS fusion, event_id % 3 AS part, 'CB' || (user_id % 20) AS bc, 'U' || (event_id % 97) AS umi, 'r' || event_id AS read_name, event_id FROM events)"
FUS = f"""{EV}, rows_ AS (SELECT fusion, part, min(event_id) AS ordinal FROM ev GROUP BY fusion, part), named AS (SELECT fusion AS old, part, ordinal, CASE WHEN count(*) OVER (PARTITION BY fusion) > 1 THEN fusion || row_number() OVER (PARTITION BY fusion ORDER BY ordinal) ELSE fusion END AS fusion FROM rows_ WHERE part <> 2),
 fr AS (SELECT n.fusion, bc, umi, read_name, CASE WHEN substr(bc, 3)::INT % 2 = 0 THEN 'Cancer' ELSE 'Non-Cancer' END AS kind FROM ev JOIN named n ON ev.fusion = n.old AND ev.part = n.part),
 fe AS (SELECT fusion, count(DISTINCT umi) FILTER (kind = 'Cancer') AS umi_cancer, count(DISTINCT umi) FILTER (kind = 'Non-Cancer') AS umi_noncancer, count(DISTINCT bc) FILTER (kind = 'Cancer') AS bc_cancer, count(DISTINCT bc) FILTER (kind = 'Non-Cancer') AS bc_noncancer FROM fr GROUP BY fusion),
 fd AS (SELECT *, round(bc_cancer / 10.0::DOUBLE, 6) AS mcf_cancer, round(bc_noncancer / 10.0::DOUBLE, 6) AS mcf_noncancer, CASE WHEN umi_cancer < 3 THEN 'Low_Cancer_UMI' WHEN bc_cancer < 2 THEN 'Low_Cancer_BC' WHEN bc_noncancer > 0 AND bc_cancer / 10.0::DOUBLE - bc_noncancer / 10.0::DOUBLE < 0.1 THEN 'Low_delta_MCF' WHEN bc_noncancer > 0 AND bc_noncancer / 10.0::DOUBLE > 0.7 THEN 'High_Non-Cancer_MCF' ELSE 'PASS' END AS decision FROM fe),
 fc AS (SELECT DISTINCT fusion, bc AS cb FROM fr WHERE fusion IN (SELECT fusion FROM fd WHERE decision = 'PASS'))"""
GT = f"""{RB}, v AS (SELECT {place('p_partkey')}, {letter('ACTG', 'p_partkey % 4')} AS ref, {letter('CTGA', 'p_partkey % 4')} AS alt FROM part), bar AS (SELECT 'CB' || s_suppkey AS cb, {kind('s_suppkey')} AS cell_type FROM supplier),
 gc AS (SELECT v.chrom, v.pos, v.alt, rb.cb, count(*) AS dp, count(*) FILTER (allele = v.alt) AS n_alt FROM v JOIN rb ON v.chrom = rb.chrom AND v.pos = rb.pos WHERE bq >= 5 GROUP BY ALL),
 g0 AS (SELECT v.chrom, v.pos, v.ref, v.alt, bar.cb, bar.cell_type, coalesce(dp, 0) AS dp, coalesce(n_alt, 0) AS n_alt, v.chrom || ':' || v.pos || ':' || v.alt AS key FROM v CROSS JOIN bar LEFT JOIN gc ON v.chrom = gc.chrom AND v.pos = gc.pos AND v.alt = gc.alt AND bar.cb = gc.cb),
 g1 AS (SELECT *, round(n_alt::DOUBLE / nullif(dp, 0), 4) AS vaf, CASE WHEN dp > 0 AND n_alt > 0 THEN {tail('n_alt', 'dp', C1, C2)} END AS p FROM g0),
 g2 AS (SELECT *, CASE WHEN dp = 0 THEN 'NoCoverage' WHEN n_alt = 0 THEN 'NoAltReads' WHEN chrom = 'chrM' AND vaf < 0.3 THEN 'LowVAFChrM' WHEN chrom = 'chrM' THEN 'PASS' WHEN p < 0.2 THEN 'PASS' ELSE 'BetaBin_problem' END AS status FROM g1),
 gt AS (SELECT *, CASE WHEN status = 'NoCoverage' THEN NULL WHEN status = 'PASS' THEN 1 ELSE 0 END::BIGINT AS mutated FROM g2)"""
LONG = f"{GT}, {FUS}, long AS (SELECT key, cb, dp, mutated, false AS is_fusion FROM gt UNION ALL SELECT fusion, cb, 1, 1, true FROM fc)"
SITES = f"s AS (SELECT {place('p_partkey')}, p_partkey, p_size FROM part)"
GENES = f"g AS (SELECT {place('p_partkey')} , p_size FROM part), genes AS (SELECT chrom, pos AS \"start\", (pos + p_size * 37)::BIGINT AS \"end\" FROM g)"
REGIONS = f"{GENES}, r AS (SELECT {place('p_partkey')}, p_size FROM part), regions AS (SELECT chrom, pos AS \"start\", (pos + p_size * 11)::BIGINT AS \"end\" FROM r)"
ISLANDS = "SELECT chrom, min(\"start\") AS \"start\", max(\"end\") AS \"end\" FROM (SELECT *, sum(new) OVER (PARTITION BY chrom ORDER BY \"start\", \"end\" ROWS UNBOUNDED PRECEDING) AS island FROM (SELECT *, CASE WHEN \"start\" <= max(\"end\") OVER (PARTITION BY chrom ORDER BY \"start\", \"end\" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {gap} THEN 0 ELSE 1 END AS new FROM {of})) GROUP BY chrom, island"
CL = "c AS (SELECT vec_id AS cell, (label + CASE WHEN vec_id % 5 = 0 THEN 1 ELSE 0 END)::BIGINT AS pred, label::BIGINT AS tr FROM embeddings)"
CONT = f"{CL}, n AS (SELECT pred, tr, count(*)::DOUBLE AS n FROM c GROUP BY ALL), a AS (SELECT pred, sum(n) AS n FROM n GROUP BY ALL), b AS (SELECT tr, sum(n) AS n FROM n GROUP BY ALL)"
MX = "mx0 AS (SELECT vec_id AS cell, unnest(embedding) AS x, unnest(range(len(embedding))) AS mut FROM embeddings), mx AS (SELECT cell, mut, CASE WHEN (cell + mut) % 17 <> 0 THEN (x > 0)::INT END AS v FROM mx0), both_ AS (SELECT v AS x, CASE WHEN (cell * 3 + mut) % 10 = 0 THEN 1 - v ELSE v END AS g FROM mx WHERE v IS NOT NULL)"
SMP = "smp AS (SELECT s_suppkey AS cell, sample, ((s_suppkey + sample % 3) // 10) % 5 AS cluster FROM supplier, range(8) t(sample)), sim AS (SELECT a.cell AS cell_a, b.cell AS cell_b, round(count(*) / 8.0::DOUBLE, 6) AS similarity FROM smp a JOIN smp b ON a.sample = b.sample AND a.cluster = b.cluster AND a.cell < b.cell GROUP BY ALL)"
TR = "tr AS (SELECT user_id % 4 AS chain, row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1 AS step, round(value, 3) AS ll, round(value + event_id % 7, 3) AS lpost FROM events)"


def batch(size: str, name: str) -> str:
    return f"{name} AS (SELECT chain, any_value(b) / greatest(count(*) - 1, 1) * sum(pow(m - mean, 2)) AS {name} FROM (SELECT chain, step // b AS batch, any_value(b) AS b, any_value(mean) AS mean, avg(ll) AS m FROM (SELECT *, {size} AS b FROM t) WHERE (step // b + 1) * b <= n GROUP BY chain, step // b) GROUP BY chain)"


TREE = "e AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN p_partkey // 2 ELSE p_partkey - 1 END AS parent, p_partkey AS child, p_size::BIGINT AS length FROM part WHERE p_partkey > 1)"


def oracle_sql() -> dict[str, str]:
    counts = lambda kinds: ", ".join(f"{k}_{x.lower()}" for k in kinds for x in A6)
    trim = "CASE WHEN {c} BETWEEN 20 AND 29 THEN 30 ELSE {c} END + 2"
    pon = counted("rb", "sample_id, chrom, pos, ref, cell_type", 2, 1)
    lf = "list_sum(list_transform(range(1, greatest({x}, 0) + 1), lambda j: ln(j)))"
    log_f = lambda x: f"coalesce({lf.format(x=x)}, 0)"
    fixed = f"({log_f('a + b')} + {log_f('c + d')} + {log_f('a + c')} + {log_f('b + d')} - {log_f('a + b + c + d')})"
    prob = lambda x: f"exp({fixed} - {log_f(x)} - {log_f('a + b - ' + x)} - {log_f('a + c - ' + x)} - {log_f('d - a + ' + x)})"
    return {
        "cell_type_binarize": "SELECT c_name AS \"Index\", CASE WHEN c_mktsegment = 'BUILDING' THEN 'Cancer' ELSE 'Non-Cancer' END AS \"Cell_type\", c_mktsegment AS \"Input_cell_type\" FROM customer",
        "clean_metadata": "SELECT DISTINCT regexp_replace(p_brand || '-' || p_partkey, '-.*$', '') AS cb, 'tissue__' || replace(p_type, ' ', '_') AS cell_type FROM part",
        "read_admission_report": "SELECT reason, count(*) AS n_reads FROM (SELECT CASE WHEN (l_orderkey + l_linenumber) % 11 = 0 THEN 'CB_not_found' WHEN l_suppkey % 13 = 0 THEN 'CB_not_matched' ELSE coalesce(nullif(concat_ws(';', CASE WHEN l_orderkey % 7 > 5 THEN 'nM' END, CASE WHEN l_partkey % 3 + 1 > 2 THEN 'NH' END, CASE WHEN l_quantity::INT * 5 + 20 < 40 THEN 'MAPQ' END), ''), 'PASS') END AS reason FROM lineitem) GROUP BY reason",
        "read_keys": "SELECT name, CASE WHEN nocb THEN 'NA' ELSE 'CB' || l_suppkey END || '^' || l_partkey || '^' || name AS key FROM (SELECT *, 'm_' || l_partkey || 'AAA_' || l_orderkey || '.' || l_linenumber AS name, (l_orderkey + l_linenumber) % 11 = 0 AS nocb FROM lineitem)",
        "qual_trim": f"SELECT o_orderkey, array_to_string(list_transform(range(45), lambda i: CASE WHEN i < l OR i >= 45 - r THEN 0 ELSE (o_orderkey + i + 1) % 40 + 1 END), ',') AS trimmed FROM (SELECT o_orderkey, {trim.format(c='(o_orderkey % 35)')} AS l, {trim.format(c='(o_custkey % 35)')} AS r FROM orders)",
        "reverse_complements": f"WITH {CTX} SELECT chrom, pos, reverse(translate(up, 'ACGT', 'TGCA')) AS rc FROM ctx",
        "token_classes": f"WITH {RB} SELECT CASE allele WHEN 'I' THEN ref || '+2AT' WHEN 'D' THEN ref || '-1G' ELSE CASE WHEN rev THEN lower(allele) ELSE allele END END AS raw_base, allele, count(*) AS n FROM rb GROUP BY ALL",
        "alignment_tokens": f"WITH {ALIGNED} SELECT sample_id, chrom, pos, raw_base, count(*) AS n, sum(bq)::BIGINT AS bq, count(DISTINCT cb) AS nc FROM al GROUP BY sample_id, chrom, pos, raw_base",
        "alignment_pileup": f"""WITH {ALIGNED}, ar AS (SELECT *, CASE WHEN pos > 0 AND (pos - 1) // 500 <= (SELECT max(p_partkey * 7 + (p_partkey % 13) * 40)::BIGINT // 500 FROM part) THEN substr('{PATTERN}', ((pos - 1) % 27 + 1)::INT, 1) END AS ref,
 CASE WHEN token[2] = '+' THEN 'I' WHEN token[2] = '-' THEN 'D' WHEN token = '*' THEN 'O' ELSE token END AS allele FROM al), cr AS ({counted('ar')}) SELECT * FROM cr WHERE ref IS NOT NULL""",
        "pileup_counts": f"WITH {CNT} SELECT chrom, pos, ref, cell_type, dp, {counts(('bc', 'bq', 'bcf', 'bcr'))} FROM cnt",
        "distinct_cells_per_base": f"WITH {CNT} SELECT chrom, pos, ref, cell_type, nc, {counts(('cc',))} FROM cnt",
        "frequent_alternative": f"WITH {CNT}, u AS (" + " UNION ALL ".join(f"SELECT chrom, pos, cell_type, '{x}' AS a, CASE WHEN ref = '{x}' THEN 0 ELSE bc_{x.lower()} END AS n FROM cnt" for x in A6) + "), m AS (SELECT *, max(n) OVER (PARTITION BY chrom, pos, cell_type) AS top FROM u) SELECT chrom, pos, cell_type, string_agg(a, '|' ORDER BY a) FILTER (n = top AND top > 0) AS top_alt FROM m GROUP BY chrom, pos, cell_type",
        "merge_cell_types": f"WITH {CNT} SELECT coalesce(a.chrom, b.chrom) AS chrom, coalesce(a.pos, b.pos) AS pos, a.dp AS dp_cancer, b.dp AS dp_noncancer FROM (SELECT * FROM cnt WHERE cell_type = 'Cancer') a FULL JOIN (SELECT * FROM cnt WHERE cell_type <> 'Cancer') b ON a.chrom = b.chrom AND a.pos = b.pos",
        "ref_conflict": f"WITH {RB}, n AS (SELECT chrom, pos, CASE WHEN bq % 5 = 0 THEN 'N' ELSE ref END AS ref, count(*) AS n FROM rb GROUP BY ALL) SELECT chrom, pos, string_agg(ref, '|' ORDER BY n DESC, ref) AS refs FROM n GROUP BY chrom, pos",
        "betabinom_pvalues": f"WITH {AL} SELECT chrom, pos, cell_type, alt, bc, cc, vaf, mcf, p_bc, p_cc FROM al",
        "celltype_filter": f"WITH {CT} SELECT chrom, pos, ref, cell_type, dp, nc, alts, filter FROM ct",
        "site_rollup": f"WITH {SITE} SELECT chrom, pos, ref, n_callable, rest_bc, rest_cc, rest_dp, rest_nc, n_calls FROM site",
        "site_filter": f"WITH {STEP1} SELECT chrom, pos, ref, n_alts, CASE WHEN len(filters) = 0 THEN 'PASS' ELSE array_to_string(filters, ',') END AS filter FROM step1",
        "nonvariant_noise": f"WITH {SITE.replace('FROM lineitem)', 'FROM lineitem), rb2 AS (SELECT * FROM rb WHERE allele IN (ref, $$I$$, $$D$$))').replace('FROM rb WHERE bq', 'FROM rb2 WHERE bq')} SELECT chrom, pos, rest_bc, rest_dp, p_noise_bc, p_noise_cc, CASE WHEN p_noise_bc < 0.001 OR p_noise_cc < 0.001 THEN 'Noisy_site' ELSE '.' END AS filter FROM noise WHERE n_calls = 0",
        "homopolymer_context": f"WITH {SITES}, x AS (SELECT chrom, pos, list_transform(range(pos - 6, pos + 5), lambda i: CASE WHEN i < 0 THEN '' ELSE substr('{PATTERN}', i % {len(PATTERN)} + 1, 1) END) AS b FROM s WHERE p_partkey > 0) SELECT chrom, pos, array_to_string(b[1:5], '') AS up, array_to_string(b[7:11], '') AS down, regexp_matches(array_to_string(b[1:5], '') || 'A', {RUNS}) AS lc_up, regexp_matches('T' || array_to_string(b[7:11], ''), {RUNS}) AS lc_down FROM x",
        "coverage_histogram": f"WITH {CNT}, o AS (SELECT *, count(*) FILTER (ok) OVER (PARTITION BY chrom, pos) AS k FROM cnt) SELECT chrom, cell_type, " + ", ".join(f"count(*) FILTER ({c} >= {t}) AS {c}_{t}" for c in ("dp", "nc") for t in (5, 8, 10, 20, 30)) + " FROM o WHERE k >= 2 GROUP BY chrom, cell_type",
        "blacklist_flags": f"WITH {SITES} SELECT chrom, pos, p_size % 20 = 1 AS edited, p_size % 20 = 2 AS in_sr, p_size % 20 = 3 AS in_lr FROM s",
        "neighbour_clustered": f"WITH {SITES} SELECT chrom, pos, coalesce(abs(pos - lag(pos) OVER w) BETWEEN 1 AND 10, false) OR coalesce(abs(lead(pos) OVER w - pos) BETWEEN 1 AND 10, false) AS clustered FROM s WINDOW w AS (PARTITION BY chrom ORDER BY pos)",
        "population_af": f"WITH {STEP2} SELECT chrom, pos, first_alt AS alt, af, af >= 0.01 AS common FROM step2",
        "annotated_filters": f"WITH {STEP2} SELECT chrom, pos, array_to_string(filters, ',') AS filter FROM step2",
        "multiallelic_major": f"WITH {MAJOR} SELECT chrom, pos, alt, multi, ca_bc AS bc_cancer, ca_cc AS cc_cancer, ca_vaf AS vaf_cancer, no_bc AS bc_noncancer, no_vaf AS vaf_noncancer, no_mcf AS mcf_noncancer FROM major",
        "chrm_branch": f"WITH {MAJOR} SELECT chrom, pos, alt, coalesce({CHRM_TAG}, 'PASS') AS tag FROM major WHERE chrom = 'chrM' AND NOT {CHRM}",
        "cancer_support": f"WITH {MAJOR} SELECT chrom, pos, alt, coalesce({SUPPORT}, 'PASS') AS tag FROM major",
        "betabin_consistency": f"WITH {MAJOR} SELECT chrom, pos, alt, coalesce({CONSISTENT}, 'PASS') AS tag FROM major",
        "clustered_snvs": f"WITH {SITES}, t AS (SELECT * FROM s) SELECT chrom, pos, chrom <> 'chrM' AND (coalesce(abs(pos - lag(pos) OVER w) < 400, false) OR coalesce(abs(lead(pos) OVER w - pos) < 400, false)) AS close, chrom <> 'chrM' AND (coalesce(abs(pos - lag(pos) OVER v) < 400, false) OR coalesce(abs(lead(pos) OVER v - pos) < 400, false)) AS close_text FROM t WINDOW w AS (PARTITION BY chrom ORDER BY pos), v AS (PARTITION BY chrom ORDER BY pos::VARCHAR)",
        "final_unfiltered": f"WITH {FINAL} SELECT key, array_to_string(tags, ',') AS final FROM final",
        "final_pass": f"WITH {FINAL} SELECT chrom, pos, ref, alt, key, ca_vaf AS vaf, ca_mcf AS mcf FROM final WHERE len(tags) = 0",
        "hccv_depth": f"WITH {MAJOR} SELECT chrom, pos, CASE WHEN cac_dp IS NULL OR noc_dp IS NULL THEN 'NoCov' WHEN cac_dp < 12 OR noc_dp < 12 THEN 'LowDepth' ELSE 'PASS' END AS tag FROM major",
        "hccv_candidates": f"WITH {HCCV} SELECT key, hccv FROM h0",
        "hccv_select": f"WITH {HCCV} SELECT key, ca_vaf AS vaf FROM (SELECT *, lag(pos) OVER w AS b, lead(pos) OVER w AS a FROM h0 WHERE hccv = 'PASS' WINDOW w AS (PARTITION BY chrom ORDER BY pos, alt)) WHERE chrom = 'chrM' OR NOT (coalesce(pos - b < 400, false) OR coalesce(a - pos < 400, false))",
        "fusion_explode": f"WITH {EV} SELECT fusion, bc, umi, read_name FROM ev",
        "fusion_rename": f"WITH {EV}, r AS (SELECT fusion, part, min(event_id) AS ordinal FROM ev GROUP BY ALL) SELECT CASE WHEN count(*) OVER (PARTITION BY fusion) > 1 THEN fusion || row_number() OVER (PARTITION BY fusion ORDER BY ordinal) ELSE fusion END AS fusion, ordinal FROM r",
        "fusion_filter": f"WITH {FUS} SELECT fusion, umi_cancer, umi_noncancer, bc_cancer, bc_noncancer, mcf_cancer, mcf_noncancer, decision FROM fd",
        "genotype_grid": f"WITH {GT} SELECT key, cb, dp, n_alt, vaf FROM gt",
        "genotype_status": f"WITH {GT} SELECT key, cb, p, status, mutated FROM gt",
        "matrix_pivot": f"WITH {GT} SELECT key, count(*) AS n_cells, count(mutated) AS n_known, coalesce(string_agg(cb || '=' || mutated, ',' ORDER BY cb || '=' || mutated) FILTER (mutated IS NOT NULL), '') AS cells FROM gt GROUP BY key",
        "pileup_by_sample": f"WITH {RB}, c AS ({counted(keys='sample_id, chrom, pos, ref, cell_type', dp=2, cells=1)}) SELECT * FROM c",
        "pileup_regions": f"WITH {GENES}, {RB}, r AS (SELECT * FROM rb WHERE EXISTS (SELECT 1 FROM genes WHERE genes.chrom = rb.chrom AND rb.pos >= genes.\"start\" AND rb.pos < genes.\"start\" + 200) AND rb.pos % 1000 >= 100), c AS ({counted('r')}) SELECT chrom, pos, ref, cell_type, dp, {counts(('bc',))} FROM c",
        "snv_fusion_union": f"WITH {LONG} SELECT key, count(*) AS n, sum(dp)::BIGINT AS dp, count(mutated) AS n_known, any_value(is_fusion) AS is_fusion FROM long GROUP BY key",
        "matrix_filter": f"WITH {LONG}, k AS (SELECT key FROM long WHERE NOT is_fusion GROUP BY key HAVING count(*) FILTER (mutated > 0) > 4), l2 AS (SELECT * FROM long WHERE NOT is_fusion AND key IN (SELECT key FROM k)), cc AS (SELECT cb FROM l2 GROUP BY cb HAVING count(mutated) > 2) SELECT key, cb, mutated FROM (SELECT * FROM l2 UNION ALL SELECT * FROM long WHERE is_fusion) WHERE cb IN (SELECT cb FROM cc)",
        "natural_sort": f"WITH {LONG}, k AS (SELECT DISTINCT key FROM long) SELECT key, row_number() OVER (ORDER BY contains(key, '--'), regexp_extract(key, '^chr([^:]+):', 1) = 'M', try_cast(regexp_extract(key, '^chr([0-9]+):', 1) AS INT) ASC NULLS LAST, regexp_extract(key, '^chr([^:]+):', 1), try_cast(regexp_extract(key, ':([0-9]+):', 1) AS BIGINT) ASC NULLS FIRST, key) AS place FROM k",
        "reannotate_cells": f"WITH {GT}, {FUS}, c AS (SELECT cb, count(*) FILTER (dp > 0) AS n_covered, count(*) FILTER (status = 'PASS') AS n_mutated FROM gt GROUP BY cb HAVING count(*) FILTER (dp > 0) >= 2), f AS (SELECT cb, count(*) AS n_fusions FROM fc GROUP BY cb) SELECT bar.cb, bar.cell_type AS before, CASE WHEN n_mutated + coalesce(n_fusions, 0) > 0 AND (n_mutated + coalesce(n_fusions, 0))::DOUBLE / n_covered >= 0.3 THEN 'Cancer' ELSE 'Non-Cancer' END AS cell_type, n_covered, n_mutated, coalesce(n_fusions, 0) AS n_fusions FROM bar JOIN c USING (cb) LEFT JOIN f USING (cb)",
        "panel_of_normals": f"WITH {RB}, p AS ({pon}), q AS (SELECT DISTINCT sample_id, chrom, pos FROM p WHERE CASE ref WHEN 'A' THEN bc_c + bc_t + bc_g WHEN 'C' THEN bc_a + bc_t + bc_g WHEN 'T' THEN bc_a + bc_c + bc_g ELSE bc_a + bc_c + bc_t END > 0) SELECT regexp_replace(chrom, '^chr', '') AS chrom, pos, count(*) AS n_samples, string_agg(sample_id, ',' ORDER BY sample_id) AS samples FROM q GROUP BY chrom, pos HAVING count(*) >= 2",
        "betabin_training": f"WITH {CNT}, t AS (SELECT chrom, pos, cell_type, dp, nc, alt_bc - bc_i - bc_d AS alt_reads, alt_cc - cc_i - cc_d AS alt_cells FROM cnt) SELECT * FROM t WHERE alt_cells::DOUBLE / nc < 0.10 AND alt_reads::DOUBLE / dp < 0.15",
        "betabin_histogram": f"WITH {CNT}, t AS (SELECT dp, nc, alt_bc - bc_i - bc_d AS alt_reads, alt_cc - cc_i - cc_d AS alt_cells FROM cnt) SELECT alt_reads, dp, count(*) AS n FROM t WHERE alt_cells::DOUBLE / nc < 0.10 AND alt_reads::DOUBLE / dp < 0.15 GROUP BY ALL",
        "fisher_strand": f"WITH {CNT}, t AS (SELECT DISTINCT bcf_a AS a, bcr_a AS b, bcf_c AS c, bcr_c AS d FROM cnt), u AS (SELECT *, {prob('a')} AS p0, list_transform(range(greatest(0, a - d), least(a + b, a + c) + 1), lambda x: {prob('x')}) AS ps FROM t) SELECT a AS bcf_A, b AS bcr_A, c AS bcf_C, d AS bcr_C, round(least(1.0, list_sum(list_filter(ps, lambda y: y <= p0 * (1 + 1e-7)))), 4) AS p FROM u",
        "range_neighbours": f"WITH {SITES} SELECT a.chrom, a.pos, b.pos AS r_pos FROM s a JOIN s b ON a.chrom = b.chrom AND abs(a.pos - b.pos) BETWEEN 1 AND 600",
        "interval_merge": f"WITH {GENES} {ISLANDS.format(gap=1, of='genes')}",
        "interval_overlaps": f"WITH {REGIONS} SELECT a.chrom, a.\"start\", a.\"end\", b.\"start\" AS r_start, b.\"end\" AS r_end FROM genes a JOIN regions b ON a.chrom = b.chrom AND a.\"start\" < b.\"end\" AND b.\"start\" < a.\"end\"",
        "interval_overlap_count": f"WITH {REGIONS} SELECT a.chrom, a.\"start\", a.\"end\", count(b.\"start\") AS n FROM genes a LEFT JOIN regions b ON a.chrom = b.chrom AND a.\"start\" < b.\"end\" AND b.\"start\" < a.\"end\" GROUP BY ALL",
        "interval_subtract": f"WITH {REGIONS}, mr AS ({ISLANDS.format(gap=0, of='regions')}), h AS (SELECT a.chrom, a.\"start\", a.\"end\", b.\"start\" AS rs, b.\"end\" AS re FROM genes a JOIN mr b ON a.chrom = b.chrom AND a.\"start\" < b.\"end\" AND b.\"start\" < a.\"end\"), e AS (SELECT chrom, \"start\", \"end\", \"start\" AS s FROM genes UNION ALL SELECT chrom, \"start\", \"end\", re FROM h) SELECT chrom, s AS \"start\", coalesce((SELECT min(rs) FROM h WHERE h.chrom = e.chrom AND h.\"start\" = e.\"start\" AND h.\"end\" = e.\"end\" AND rs >= e.s), \"end\") AS \"end\" FROM e WHERE s < \"end\" AND NOT EXISTS (SELECT 1 FROM h WHERE h.chrom = e.chrom AND h.\"start\" = e.\"start\" AND h.\"end\" = e.\"end\" AND rs <= e.s AND re > e.s)",
        "tree_collapse": f"WITH RECURSIVE {TREE}, u AS (SELECT parent AS node FROM e GROUP BY parent HAVING count(*) = 1 AND parent IN (SELECT child FROM e)), c AS (SELECT child, parent, length FROM e WHERE child NOT IN (SELECT node FROM u) UNION ALL SELECT c.child, e.parent, c.length + e.length FROM c JOIN u ON c.parent = u.node JOIN e ON e.child = c.parent) SELECT parent, child, length FROM c WHERE parent NOT IN (SELECT node FROM u)",
        "tree_placement": f"""WITH RECURSIVE {TREE}, a AS (SELECT node, node AS ancestor, 0 AS distance FROM (SELECT child AS node FROM e UNION SELECT parent FROM e) UNION ALL SELECT a.node, e.parent, a.distance + 1 FROM a JOIN e ON a.ancestor = e.child),
 m AS (SELECT DISTINCT l_orderkey AS "set", l_partkey AS node FROM lineitem WHERE l_partkey IN (SELECT node FROM a)), n AS (SELECT "set", count(*) AS n_members FROM m GROUP BY "set"), d AS (SELECT node AS ancestor, max(distance) AS depth FROM a GROUP BY node),
 c AS (SELECT m."set", ancestor, count(*) AS n FROM m JOIN a ON m.node = a.node GROUP BY m."set", ancestor), b AS (SELECT "set", n_members, arg_max(ancestor, depth) AS node FROM c JOIN n USING ("set") JOIN d USING (ancestor) WHERE n = n_members GROUP BY "set", n_members)
SELECT "set", b.node, n_members, (SELECT count(*) FROM a WHERE a.ancestor = b.node) AS n_under FROM b""",
        "tile_windows": f"WITH {GENES}, t AS (SELECT chrom, \"end\" AS e, unnest(range(\"start\", \"end\", 500)) AS s FROM genes) SELECT chrom, s AS \"start\", least(s + 500, e) AS \"end\" FROM t",
        "gene_counts": "SELECT p_brand AS gene, 'CB' || l_suppkey AS cb, sum(l_quantity)::BIGINT AS n FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_partkey % 4 <> 0 GROUP BY ALL",
        "ari": f"WITH {CONT}, x AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM n) AS both_, (SELECT sum(n * (n - 1) / 2) FROM a) AS pa, (SELECT sum(n * (n - 1) / 2) FROM b) AS pb, (SELECT sum(n) FROM n) AS t) SELECT round((both_ - pa * pb / (t * (t - 1) / 2)) / ((pa + pb) / 2 - pa * pb / (t * (t - 1) / 2)), 6) AS ari FROM x",
        "v_measure": f"WITH {CONT}, t AS (SELECT sum(n) AS t FROM n), e AS (SELECT (SELECT -sum(n / t * ln(n / t)) FROM n, t) AS hb, (SELECT -sum(n / t * ln(n / t)) FROM a, t) AS hp, (SELECT -sum(n / t * ln(n / t)) FROM b, t) AS ht), x AS (SELECT 1 - (hb - hp) / ht AS h, 1 - (hb - ht) / hp AS c FROM e) SELECT round(h, 6) AS homogeneity, round(c, 6) AS completeness, round(2 * h * c / (h + c), 6) AS v_measure FROM x",
        "hamming": f"WITH {MX} SELECT count(*) AS n_compared, count(*) FILTER (g <> x) AS n_differ, round(count(*) FILTER (g <> x) / count(*)::DOUBLE, 6) AS distance FROM both_",
        "fn_fp_empirical": f"WITH {MX} SELECT round((count(*) FILTER (g = 1 AND x = 0) + 1e-9) / (count(*) FILTER (g = 1) + 1e-9), 6) AS fn, round((count(*) FILTER (g = 0 AND x = 1) + 1e-9) / (count(*) FILTER (g = 0) + 1e-9), 6) AS fp FROM both_",
        "coclustering_similarity": f"WITH {SMP} SELECT * FROM sim",
        "mpear_score": f"WITH {SMP}, p AS (SELECT (a.cluster = b.cluster)::INT::DOUBLE AS i, coalesce(similarity, 0) AS s FROM smp a JOIN smp b ON a.sample = 0 AND b.sample = 0 AND a.cell < b.cell LEFT JOIN sim ON a.cell = cell_a AND b.cell = cell_b), x AS (SELECT sum(s * i) AS si, sum(s) AS s, sum(i) AS i, count(*) AS n FROM p) SELECT round((si - s * i / n) / ((s + i) / 2 - s * i / n), 6) AS mpear FROM x",
        "posterior_genotypes": f"WITH {MX}, {SMP}, th AS (SELECT sample, cluster, mut, (sum(v) + 1)::DOUBLE / (count(*) + 2) AS theta FROM mx JOIN smp USING (cell) WHERE v IS NOT NULL GROUP BY ALL), own AS (SELECT cell, CASE WHEN cluster <> 0 AND cell % 7 = 0 THEN 5 ELSE cluster END AS k FROM smp WHERE sample = 1), nk AS (SELECT k, count(*) AS n_k FROM own GROUP BY k), nc AS (SELECT sample, cluster, count(*) AS n_c FROM smp GROUP BY ALL), met AS (SELECT k, sample, cluster, count(*) AS n FROM smp JOIN own USING (cell) GROUP BY ALL), r AS (SELECT *, CASE WHEN n = n_k AND n = n_c THEN 0 WHEN n = n_k THEN 1 ELSE 2 END AS rank FROM met JOIN nk USING (k) JOIN nc USING (sample, cluster)), b AS (SELECT *, min(rank) OVER (PARTITION BY k) AS best FROM r), o AS (SELECT k AS cluster, mut, sum(theta * n) / sum(n) AS theta FROM b JOIN th USING (sample, cluster) WHERE rank = best GROUP BY k, mut) SELECT cluster, mut, round(theta, 6) AS theta, (round(theta, 9) >= 0.5)::INT AS called FROM o",
        "lugsail_psrf": f"WITH {TR}, t AS (SELECT *, count(*) OVER (PARTITION BY chain) AS n, avg(ll) OVER (PARTITION BY chain) AS mean FROM tr), {batch('floor(sqrt(n))::BIGINT', 'big')}, {batch('greatest(floor(floor(sqrt(n)) / 3), 1)::BIGINT', 'small')}, per AS (SELECT chain, count(*) AS n, var_samp(ll) AS s2 FROM tr GROUP BY chain), x AS (SELECT count(*) AS n_chains, min(n) AS n, avg(s2) AS s2, avg(2 * big - small) AS tau FROM per JOIN big USING (chain) JOIN small USING (chain)) SELECT n_chains, n, round(sqrt(((n - 1)::DOUBLE / n * s2 + tau / n) / s2), 6) AS psrf FROM x",
        "ml_map_estimate": f"WITH {TR} SELECT (SELECT chain FROM tr ORDER BY ll DESC, chain, step LIMIT 1) AS ml_chain, (SELECT step FROM tr ORDER BY ll DESC, chain, step LIMIT 1) AS ml_step, (SELECT chain FROM tr ORDER BY lpost DESC, chain, step LIMIT 1) AS map_chain, (SELECT step FROM tr ORDER BY lpost DESC, chain, step LIMIT 1) AS map_step",
        "latent_summary": f"WITH {TR} SELECT round(avg(ll), 6) AS ll_mean, round(stddev_pop(ll), 6) AS ll_sd, round(avg(lpost), 6) AS lpost_mean, round(stddev_pop(lpost), 6) AS lpost_sd FROM tr",
        "cluster_order": f"WITH {CL}, z AS (SELECT cell, pred AS cluster, count(*) OVER (PARTITION BY pred) AS size FROM c) SELECT cell, cluster, size, row_number() OVER (ORDER BY size DESC, cluster, cell) AS place FROM z",
    }
