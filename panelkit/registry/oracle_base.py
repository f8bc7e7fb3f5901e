"""Shared SQL building blocks of the oracle (DuckDB dialect, ANSI-leaning).

The oracle follows the reference's own step-by-step shape (one table per
family, roll-ups computed from the level below, national rows joined to a
label table) so it is an independent check of the one-pass Spark plan.
"""

F_MICRO = """
f_micro AS (
SELECT CAST(date_trunc('month', o.o_orderdate) AS DATE) AS date,
  CASE WHEN l.l_orderkey % 97 <> 0 THEN l.l_orderkey * 10 + l.l_linenumber END AS nss,
  CASE WHEN l.l_returnflag = 'R' THEN 2 ELSE 1 END AS ta,
  CASE WHEN p.p_size % 10 <> 0 THEN p.p_size % 10 END AS div_final,
  CASE o.o_orderpriority WHEN '1-URGENT' THEN 'S1' WHEN '2-HIGH' THEN 'S2' WHEN '3-MEDIUM' THEN 'S3' WHEN '4-NOT SPECIFIED' THEN 'S4' ELSE 'NA' END AS size_cierre,
  n.n_regionkey + 1 AS cve_del_final, n.n_nationkey + 1 AS cve_subdel_final,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN '10' WHEN 'FURNITURE' THEN '13' WHEN 'HOUSEHOLD' THEN '14' WHEN 'MACHINERY' THEN '32' ELSE '17' END AS mod,
  CASE WHEN l.l_linestatus = 'O' THEN '1' ELSE '2' END AS tipotrc,
  CASE WHEN l.l_linenumber < 7 THEN 1 ELSE 0 END AS aseg_cierre,
  CASE WHEN o.o_orderstatus <> 'P' THEN 1 ELSE 0 END AS aseg,
  CASE WHEN l.l_quantity < 49 THEN l.l_extendedprice END AS sal_cierre,
  CASE WHEN l.l_linenumber = 1 THEN 1 END AS empresas3
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN part p ON l.l_partkey = p.p_partkey)"""

F_DICT = """
f_dict AS (
SELECT * FROM (VALUES
 ('Asegurados','Modalidad','10.1','Modalidad 10.1','Asegurados por modalidad'),('Asegurados','Modalidad','10.2','Modalidad 10.2','Asegurados por modalidad'),
 ('Asegurados','Modalidad','13.1','Modalidad 13.1','Asegurados por modalidad'),('Asegurados','Modalidad','14.1','Modalidad 14','Asegurados por modalidad'),('Asegurados','Modalidad','32.1','Modalidad 32','Asegurados por modalidad'),
 ('Asegurados','Sector económico','1','Sector 1','Asegurados por sector'),('Asegurados','Sector económico','2','Sector 2','Asegurados por sector'),('Asegurados','Sector económico','3','Sector 3','Asegurados por sector'),
 ('Patrones','Modalidad','10.1','Patrones modalidad 10','Patrones por modalidad'),('Patrones','Modalidad','13.1','Patrones modalidad 13','Patrones por modalidad'),
 ('Patrones','Rango de trabajadores','s1','Un trabajador','Patrones por rango'),('Patrones','Rango de trabajadores','s2','Entre 2 y 5','Patrones por rango'),('Patrones','Rango de trabajadores',CAST(NULL AS VARCHAR(9)),'Sin rango','Patrones por rango'),
 ('Salario','Modalidad','10.1','Salario 10.1','Salario trabajadores'),('Salario','Modalidad','10.2','Salario 10.2','Salario trabajadores'),('Salario','Modalidad','32.1','Salario 32','Salario trabajadores')
) t(series, disaggregation, sheet_name_code, sheet_name, book_name))"""

F_GEO = """
f_geo AS (
SELECT r.r_regionkey + 1 AS clave_delegacion, r.r_name AS delegacion, n.n_nationkey + 1 AS clave_subdelegacion, n.n_name AS subdelegacion
FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL SELECT * FROM (VALUES (99, 'Nacional', CAST(NULL AS INT), CAST(NULL AS VARCHAR(20))), (99, 'Nacional', 99, 'Nacional')) t(a, b, c, d))"""

# Means rounded half up to 8 places, in whole numbers: a cell's wage sum in millionths over its wages.
CELL_MEAN = (
    "CAST((200 * sum(CAST(round(sal_cierre * 1000000) AS HUGEINT)) + count(sal_cierre)) // NULLIF(2 * count(sal_cierre), 0) AS DOUBLE) / 100000000.0"
)

CUBE = f"""
cube AS (
SELECT date, ta, cve_del_final, cve_subdel_final, mod, tipotrc, div_final, size_cierre,
  CAST(count(nss) AS BIGINT) AS asegurados, {CELL_MEAN} AS salario, CAST(sum(empresas3) AS BIGINT) AS patrones
FROM f_micro WHERE aseg_cierre = 1 AND aseg = 1
GROUP BY date, ta, cve_del_final, cve_subdel_final, mod, tipotrc, div_final, size_cierre)"""

CLEAN = """
clean AS (
SELECT date, ta, cve_del_final AS clave_delegacion, cve_subdel_final AS clave_subdelegacion, mod, tipotrc, div_final,
  CASE WHEN size_cierre <> 'NA' THEN lower(size_cierre) END AS size_cierre,
  CASE WHEN mod IN ('32', '33', '14') THEN mod || '.1' ELSE mod || '.' || tipotrc END AS cve_modalidad,
  asegurados, salario, patrones
FROM cube)"""

# Weighted mean of the cube's mean wage (in hundred-millionths), weights = worker
# counts, rows without a wage excluded from both sums, zero weight -> NULL.
_WEIGHT = "sum(asegurados) FILTER (WHERE salario IS NOT NULL)"
WMEAN = (
    "CAST((2 * sum(CAST(round(salario * 100000000) AS HUGEINT) * asegurados) FILTER (WHERE salario IS NOT NULL) + "
    f"{_WEIGHT}) // NULLIF(2 * {_WEIGHT}, 0) AS DOUBLE) / 100000000.0"
)

FAMILIES = f"""
fam_aseg_mod AS (
SELECT date, clave_delegacion, clave_subdelegacion, cve_modalidad AS code, 'Asegurados' AS series, 'Modalidad' AS disaggregation,
  CAST(sum(asegurados) AS DOUBLE) AS value
FROM clean WHERE ta = 1 GROUP BY date, clave_delegacion, clave_subdelegacion, cve_modalidad),
fam_aseg_sector AS (
SELECT date, clave_delegacion, clave_subdelegacion, CAST(div_final AS VARCHAR) AS code, 'Asegurados' AS series, 'Sector económico' AS disaggregation,
  CAST(sum(asegurados) AS DOUBLE) AS value
FROM clean WHERE ta = 1 AND div_final IS NOT NULL GROUP BY date, clave_delegacion, clave_subdelegacion, div_final),
fam_pat_mod AS (
SELECT date, clave_delegacion, clave_subdelegacion, mod || '.1' AS code, 'Patrones' AS series, 'Modalidad' AS disaggregation,
  CAST(coalesce(sum(patrones), 0) AS DOUBLE) AS value
FROM clean WHERE ta = 1 GROUP BY date, clave_delegacion, clave_subdelegacion, mod || '.1'),
fam_pat_size AS (
SELECT date, clave_delegacion, clave_subdelegacion, size_cierre AS code, 'Patrones' AS series, 'Rango de trabajadores' AS disaggregation,
  CAST(coalesce(sum(patrones), 0) AS DOUBLE) AS value
FROM clean WHERE ta = 1 GROUP BY date, clave_delegacion, clave_subdelegacion, size_cierre),
fam_wage AS (
SELECT date, clave_delegacion, clave_subdelegacion, cve_modalidad AS code, 'Salario' AS series, 'Modalidad' AS disaggregation,
  {WMEAN} AS value
FROM clean WHERE ta = 1 GROUP BY date, clave_delegacion, clave_subdelegacion, cve_modalidad)"""


def family_joined(name: str) -> str:
    """Family table left-joined to the dictionary (code null-safe)."""
    return f"""
SELECT f.date, f.clave_delegacion, f.clave_subdelegacion, f.series, f.disaggregation, d.sheet_name, d.book_name, f.value
FROM {name} f LEFT JOIN f_dict d ON d.series = f.series AND d.disaggregation = f.disaggregation
  AND d.sheet_name_code IS NOT DISTINCT FROM f.code"""


PANEL_STEPS = f"""
subdel AS (
SELECT * FROM ({family_joined('fam_aseg_mod')} UNION ALL {family_joined('fam_aseg_sector')} UNION ALL
  {family_joined('fam_pat_mod')} UNION ALL {family_joined('fam_pat_size')} UNION ALL {family_joined('fam_wage')}) u
WHERE sheet_name IS NOT NULL),
del_add AS (
SELECT date, clave_delegacion, series, disaggregation, sheet_name, book_name, sum(value) AS value
FROM subdel WHERE series <> 'Salario' GROUP BY date, clave_delegacion, series, disaggregation, sheet_name, book_name),
wage_del_raw AS (
SELECT date, clave_delegacion, cve_modalidad AS code, {WMEAN} AS value
FROM clean WHERE ta = 1 GROUP BY date, clave_delegacion, cve_modalidad),
wage_del AS (
SELECT w.date, w.clave_delegacion, 'Salario' AS series, 'Modalidad' AS disaggregation, d.sheet_name, d.book_name, w.value
FROM wage_del_raw w LEFT JOIN f_dict d ON d.series = 'Salario' AND d.disaggregation = 'Modalidad'
  AND d.sheet_name_code IS NOT DISTINCT FROM w.code),
sheets_new AS (
SELECT date, 'Subdelegación' AS level, clave_delegacion, clave_subdelegacion, series, disaggregation, sheet_name, book_name, value
FROM subdel WHERE value IS NOT NULL
UNION ALL
SELECT date, 'Delegación', clave_delegacion, CAST(NULL AS INT), series, disaggregation, sheet_name, book_name, value
FROM del_add WHERE sheet_name IS NOT NULL AND value IS NOT NULL
UNION ALL
SELECT date, 'Delegación', clave_delegacion, CAST(NULL AS INT), series, disaggregation, sheet_name, book_name, value
FROM wage_del WHERE sheet_name IS NOT NULL AND value IS NOT NULL),
totals_labs AS (
SELECT * FROM (VALUES ('Delegación', 99, CAST(NULL AS INT)), ('Subdelegación', 99, 99)) t(level, clave_delegacion, clave_subdelegacion)),
nat_add AS (
SELECT s.date, s.level, t.clave_delegacion, t.clave_subdelegacion, s.series, s.disaggregation, s.sheet_name, s.book_name, s.value
FROM (SELECT date, series, disaggregation, sheet_name, book_name, level, sum(value) AS value FROM sheets_new
      WHERE series <> 'Salario' GROUP BY date, series, disaggregation, sheet_name, book_name, level) s
LEFT JOIN totals_labs t ON s.level = t.level),
wage_nat_raw AS (
SELECT date, cve_modalidad AS code, {WMEAN} AS value FROM clean WHERE ta = 1 GROUP BY date, cve_modalidad),
wage_nat AS (
SELECT w.date, t.level, t.clave_delegacion, t.clave_subdelegacion, 'Salario' AS series, 'Modalidad' AS disaggregation,
  d.sheet_name, d.book_name, w.value
FROM wage_nat_raw w LEFT JOIN f_dict d ON d.series = 'Salario' AND d.disaggregation = 'Modalidad'
  AND d.sheet_name_code IS NOT DISTINCT FROM w.code
CROSS JOIN totals_labs t WHERE d.sheet_name IS NOT NULL),
panel_full AS (
SELECT * FROM sheets_new UNION ALL SELECT * FROM nat_add UNION ALL SELECT * FROM wage_nat),
panel_geo AS (
SELECT p.*, s.subdelegacion, dl.delegacion
FROM panel_full p
LEFT JOIN (SELECT DISTINCT clave_delegacion, clave_subdelegacion, subdelegacion FROM f_geo) s
  ON p.clave_delegacion IS NOT DISTINCT FROM s.clave_delegacion AND p.clave_subdelegacion IS NOT DISTINCT FROM s.clave_subdelegacion
LEFT JOIN (SELECT DISTINCT clave_delegacion, delegacion FROM f_geo) dl ON p.clave_delegacion IS NOT DISTINCT FROM dl.clave_delegacion)"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",".join(p.strip("\n") for p in parts)


BASE = with_ctes(F_MICRO, F_DICT, F_GEO, CUBE, CLEAN)
PANEL_BASE = with_ctes(F_MICRO, F_DICT, F_GEO, CUBE, CLEAN, FAMILIES, PANEL_STEPS)


def rv(expr: str) -> str:
    """Rounding used on both sides for non-integral doubles (see README);
    ``+ 0.0`` turns a rounded negative zero into zero."""
    return f"(round({expr} + 0.0000037, 4) + 0.0)"
