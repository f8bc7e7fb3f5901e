"""Registered historical-workbook queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from panelkit.functions.text import ACCENTED, PLAIN
from panelkit.operators import books as B
from panelkit.plans import history as H
from panelkit.registry import oracle_base as O
from panelkit.registry.common import panel_geo
from panelkit.session import cut_lineage, literal_table, scratch_path
from panelkit.sources.store import write_table
from panelkit.registry import published_books as S
from panelkit.sources.register import geo_dictionary

# Index / tab edge rows (a book without conflict, a book whose
# index names a sheet that has no tab) and label edge rows.
EDGE_INDEX = [
    ("b1", "Hoja 1", " Modalidad  10 "), ("b1", "Hoja 2", "Modalidad 13"), ("b1", "Hoja 3", "Resumen nacional"),
    ("b1", None, "sin hoja"), ("b2", "Hoja 1", "Sector 1"), ("b2", "Hoja 9", "Sector sin hoja"), ("b2", "Contenido", "Sector x"),
]
EDGE_TABS = [("b1", 1, "Contenido"), ("b1", 2, "1"), ("b1", 3, "2"), ("b1", 4, "3"), ("b1", 5, "2.1"), ("b2", 1, "1"), ("b2", 2, "(1)")]
EDGE_LABELS = [
    ("asegurados trabajadores por modalidad", "MODALIDAD 10", "Asegurados trabajadores", "Modalidad"),
    ("asegurados trabajadores por modalidad", "Modalidad general", "Asegurados trabajadores", "Modalidad"),
    ("patrones por rango", "Entre 501 y 1000 asegurados trabajadores", "Patrones", "Rango de trabajadores"),
    ("patrones por rango", "Más de 1000 asegurados trabajadores", "Patrones", "Rango de trabajadores"),
    ("patrones por modalidad", "Patrones modalidad 10 x", "Patrones", "Modalidad"),
    ("salario trab", "Salario 10", "Salario", "Modalidad"),
    ("trabsal", "Trabsal 10", "Trabsal", "Modalidad"),
    ("asegurados por sector", "total sector", "Asegurados trabajadores", "Sector económico"),
    ("sin regla", "Hoja 1", None, None),
]
INDEX_SCHEMA = StructType([StructField("path", StringType()), StructField("hoja", StringType()), StructField("contenido", StringType())])
TABS_SCHEMA = StructType([StructField("path", StringType()), StructField("position", IntegerType()), StructField("sheet_name", StringType())])
LABEL_SCHEMA = StructType([StructField(c, StringType()) for c in ("book_name", "sheet_name", "series", "disaggregation")])


def published(spark: SparkSession, sf: str):
    # The panel is checkpointed once; the month grid, the sheets and the
    # wide table all read it.
    p = cut_lineage(panel_geo(spark, sf))
    return p, cut_lineage(S.published_sheets(p))


def q_catalogue_classify(spark: SparkSession, sf: str) -> DataFrame:
    """Classified catalogue, exported as CSV and read back."""
    _, sh = published(spark, sf)
    cat = B.classify_catalogue(S.book_catalogue(spark, sh))
    path = scratch_path(spark, "catalogue")
    write_table(cat, path, "csv")
    return spark.read.schema(cat.schema).option("header", True).option("nullValue", "").csv(path)


def q_index_extract(spark: SparkSession, sf: str) -> DataFrame:
    _, sh = published(spark, sf)
    return B.extract_index(B.select_content_columns(S.raw_book_index(sh)))


def q_sheet_positions(spark: SparkSession, sf: str) -> DataFrame:
    _, sh = published(spark, sf)
    # The workbooks' tab lists as landed; the ordinal comes from the list.
    tabs = S.book_tabs(sh).groupBy("path").agg(F.sort_array(F.collect_list(F.struct("position", "sheet_name"))).alias("t"))
    return B.sheet_positions(B.explode_tabs(tabs.select("path", F.col("t.sheet_name").alias("tabs"))))


def q_index_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    _, sh = published(spark, sf)
    idx = S.book_index(sh).unionByName(literal_table(spark, EDGE_INDEX, INDEX_SCHEMA))
    tabs = S.book_tabs(sh).unionByName(literal_table(spark, EDGE_TABS, TABS_SCHEMA))
    return B.index_conflicts(B.join_index(B.extract_index(idx), B.sheet_positions(tabs)))


def _index(sh: DataFrame) -> DataFrame:
    return B.select_content_columns(S.raw_book_index(sh))


def _sheets(spark: SparkSession, sf: str):
    p, sh = published(spark, sf)
    return p, sh, H.indexed_sheets(S.book_catalogue(spark, sh), _index(sh), S.book_tabs(sh))


def q_assign_book_sheet_ids(spark: SparkSession, sf: str) -> DataFrame:
    _, _, s = _sheets(spark, sf)
    return s.select("path", "book_id", "sheet_id", "hoja", "contenido", "position", "sheet_name")


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    p, sh = published(spark, sf)
    return S.landed_sheets(p, sh)


def q_sheet_unpivot(spark: SparkSession, sf: str) -> DataFrame:
    return B.unpivot_sheets(_wide(spark, sf), H.SHEET)


def q_date_repair(spark: SparkSession, sf: str) -> DataFrame:
    return H.repaired_long(_wide(spark, sf))


def q_bad_date_report(spark: SparkSession, sf: str) -> DataFrame:
    return B.bad_date_report(B.unpivot_sheets(_wide(spark, sf), H.SHEET, drop_missing=False), H.SHEET)


def q_sheet_label_clean(spark: SparkSession, sf: str) -> DataFrame:
    _, _, s = _sheets(spark, sf)
    labels = s.select(
        F.col("name").alias("book_name"), F.col("contenido").alias("sheet_name"), "series", "disaggregation"
    ).unionByName(literal_table(spark, EDGE_LABELS, LABEL_SCHEMA))
    return B.clean_labels(labels)


def q_composite_code_split(spark: SparkSession, sf: str) -> DataFrame:
    w = _wide(spark, sf).select(
        "path", "position", F.col(f"`{S.H_DEL}`").alias("code_del"), F.col(f"`{S.H_SUB}`").alias("code_sub")
    )
    out = B.split_codes(w.withColumns({"clave_delegacion": F.col("code_del"), "clave_subdelegacion": F.col("code_sub")}))
    return out


def q_historical_panel(spark: SparkSession, sf: str) -> DataFrame:
    p, sh = published(spark, sf)
    out = H.historical_panel(
        S.book_catalogue(spark, sh), _index(sh), S.book_tabs(sh), S.landed_sheets(p, sh), geo_dictionary(spark, sf)
    )
    return out


# Series and geography key shared by the computed and the published panel
# (book names differ by construction, so they are not part of the key).
REVISED_EVERY, REVISED_MONTH, REVISION = 3, 3, 5.0
XV_KEY = ["level", "date", "clave_delegacion", "clave_subdelegacion", "series", "disaggregation", "sheet_name"]
XV_BLOCK = ["date", "level", "series", "disaggregation", "sheet_name"]


def revised(panel: DataFrame) -> DataFrame:
    """A recomputation in which some values came out different."""
    hit = (F.col("clave_subdelegacion") % REVISED_EVERY == 0) & (F.month("date") == REVISED_MONTH)
    return panel.withColumn("value", F.when(hit, F.col("value") + REVISION).otherwise(F.col("value")))


def q_cross_validation(spark: SparkSession, sf: str) -> DataFrame:
    """Computed panel vs the official historical sheets: values that differ by
    more than the tolerance, and series present on one side only.  Both sides
    carry canonical labels and no NULL values, which are cells that were
    never published."""
    from panelkit.operators.digests import block_digests, differing_blocks, revision_diff_of_blocks

    p, sh = published(spark, sf)
    # Materialised once: the comparison reads it for the months and the rows.
    official = cut_lineage(
        H.historical_panel(
            S.book_catalogue(spark, sh), _index(sh), S.book_tabs(sh), S.landed_sheets(p, sh), geo_dictionary(spark, sf)
        ).where("value IS NOT NULL")
    )
    computed = cut_lineage(revised(B.clean_labels(p)).where("value IS NOT NULL"))
    digests = [block_digests(side, XV_BLOCK, XV_KEY) for side in (computed, official)]
    return revision_diff_of_blocks(computed, official, cut_lineage(differing_blocks(*digests, XV_BLOCK)), XV_BLOCK, key=XV_KEY)


QUERIES = {
    "cross_validation": q_cross_validation,
    "catalogue_classify": q_catalogue_classify,
    "index_extract": q_index_extract,
    "sheet_positions": q_sheet_positions,
    "index_conflicts": q_index_conflicts,
    "assign_book_sheet_ids": q_assign_book_sheet_ids,
    "sheet_unpivot": q_sheet_unpivot,
    "date_repair": q_date_repair,
    "bad_date_report": q_bad_date_report,
    "sheet_label_clean": q_sheet_label_clean,
    "composite_code_split": q_composite_code_split,
    "historical_panel": q_historical_panel,
}


def _values(rows, names) -> str:
    def lit(v):
        if v is None:
            return "CAST(NULL AS VARCHAR)"
        if isinstance(v, int):
            return str(v)
        return "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {body}) t({', '.join(names)})"


def _squish(x: str) -> str:
    return f"trim(regexp_replace({x}, '[\\s\\p{{Z}}]+', ' ', 'g'))"


def _first_number(x: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({x}, '\\d+', 0), '') AS INT)"


def _sentence(x: str) -> str:
    first = "'(?s)^([^\\p{L}]*)(\\p{L})(.*)$'"
    part = (
        f"CASE WHEN regexp_matches(s, '\\p{{L}}') THEN regexp_extract(s, {first}, 1) || upper(regexp_extract(s, {first}, 2))"
        f" || lower(regexp_extract(s, {first}, 3)) ELSE lower(s) END"
    )
    marked = (
        f"regexp_replace(regexp_replace({x}, '([?!] +)', '\\1' || chr(1), 'g'), "
        f"'(\\. +)([^\\p{{L}}]*\\p{{Lu}})', '\\1' || chr(1) || '\\2', 'g')"
    )
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE array_to_string(list_transform(string_split({marked}, chr(1)), lambda s: {part}), '') END"


def _rules(x: str, rules) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({x}, '{p}') THEN '{lab}'" for p, lab in rules)


_STRIP_SUFFIX = "regexp_replace(raw, '_\\w+', '')"
_NAME = f"lower(translate(regexp_replace({_squish(_STRIP_SUFFIX)}, '\\.', ''), '{ACCENTED}', '{PLAIN}'))"

PUB = f""",
titles AS ({_values(S.BOOK_TITLES, ['series', 'disaggregation', 'title'])}),
folders AS ({_values(S.SERIES_FOLDERS, ['series', 'folder'])}),
lfolders AS ({_values(S.LEVEL_FOLDERS, ['level', 'ldir', 'lsuffix'])}),
pub0 AS (SELECT DISTINCT level, series, disaggregation, sheet_name FROM panel_geo),
pub1 AS (SELECT p.*, '/raw/' || l.ldir || '/' || f.folder || '/' || t.title || '_' || l.lsuffix || '.xlsx' AS path
  FROM pub0 p LEFT JOIN titles t ON p.series = t.series AND p.disaggregation = t.disaggregation
  LEFT JOIN folders f ON p.series = f.series LEFT JOIN lfolders l ON p.level = l.level),
pub AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY path ORDER BY sheet_name) AS INT) AS hoja FROM pub1),
cat AS (SELECT DISTINCT path FROM (SELECT path FROM pub UNION ALL {_values([(p,) for p in S.EXTRA_BOOKS], ['path'])}) x),
cls0 AS (SELECT path, regexp_extract(path, '([^/]+)\\.xlsx$', 1) AS raw FROM cat
  WHERE regexp_matches(path, '{B.SERIES_FOLDERS}')),
cls1 AS (SELECT path, raw, {_NAME} AS name,
  CASE WHEN contains(raw, 'Delegaciones') THEN 'Delegación' WHEN contains(raw, 'Subdelegaciones') THEN 'Subdelegación'
       WHEN contains(path, 'SUBDELEGACIONES') THEN 'Subdelegación' WHEN contains(path, 'DELEGACIONES') THEN 'Delegación' END AS level
  FROM cls0),
books AS (SELECT path, name, level, {_rules('name', B.SERIES_RULES)} END AS series,
  {_rules('name', B.DISAGGREGATION_RULES)} WHEN contains(path, '{B.DISAGGREGATION_PATH_RULE[0]}') THEN '{B.DISAGGREGATION_PATH_RULE[1]}' END AS disaggregation,
  CAST(row_number() OVER (ORDER BY path) AS INT) AS book_id
  FROM cls1 WHERE NOT regexp_matches(name, '{B.EXCLUDED_BOOKS}')),
idx_raw AS (SELECT path, ' Hoja ' || CAST(hoja AS VARCHAR) AS hoja, '  ' || replace(sheet_name, ' ', '  ') || ' ' AS contenido FROM pub
  UNION ALL SELECT path, 'Hoja ' || CAST(max(hoja) + 1 AS VARCHAR), 'Resumen nacional' FROM pub GROUP BY path
  UNION ALL SELECT path, CAST(NULL AS VARCHAR), 'Notas' FROM pub GROUP BY path),
tabs_raw AS (SELECT path, 1 AS position, 'Contenido' AS sheet_name FROM pub GROUP BY path
  UNION ALL SELECT path, hoja + 1, CAST(hoja AS VARCHAR) FROM pub
  UNION ALL SELECT path, max(hoja) + 2, '4.1' FROM pub GROUP BY path
  UNION ALL SELECT path, max(hoja) + 3, '(1)' FROM pub GROUP BY path)"""


def _extract(src: str) -> str:
    return f"""SELECT path, hoja, contenido FROM (
  SELECT path, {_first_number(_squish('hoja'))} AS hoja, {_squish('contenido')} AS contenido FROM {src}
  WHERE hoja IS NOT NULL AND contenido IS NOT NULL) e
  WHERE hoja IS NOT NULL AND contenido IS NOT NULL AND NOT regexp_matches(contenido, 'Resumen|resumen')"""


def _positions(src: str) -> str:
    return f"""SELECT path, CAST(position AS INT) AS position, sheet_name, {_first_number('sheet_name')} AS hoja FROM {src}
  WHERE NOT regexp_matches(sheet_name, '\\p{{L}}|,|\\.|\\(')"""


SHEETS = f""",
idx AS ({_extract('idx_raw')}),
pos AS ({_positions('tabs_raw')}),
j AS (SELECT i.path, i.hoja, i.contenido, p.position, p.sheet_name FROM idx i LEFT JOIN pos p ON i.path = p.path AND i.hoja = p.hoja
  WHERE i.path IN (SELECT path FROM books)),
sheets AS (SELECT j.*, b.book_id, CAST(row_number() OVER (ORDER BY b.book_id, j.position) AS INT) AS sheet_id,
  b.name, b.level, b.series, b.disaggregation FROM j JOIN books b ON j.path = b.path)"""

GRID = f""",
grid AS (SELECT date, CAST(row_number() OVER (ORDER BY date) AS INT) AS col_pos FROM (SELECT DISTINCT date FROM panel_geo) g),
hdr AS (SELECT date, col_pos, CASE WHEN col_pos = {S.BAD_HEADER_INDEX + 1} THEN '{S.BAD_HEADER}'
  ELSE CAST(date_diff('day', DATE '1899-12-30', date) AS VARCHAR) END AS header FROM grid),
cellsrc AS (SELECT pub.path, pub.hoja + 1 AS position, lpad(CAST(pg.clave_delegacion AS VARCHAR), 2, '0') AS clave_delegacion,
  CASE WHEN pg.clave_delegacion = 99 THEN '{S.NATIONAL_TITLE}' ELSE pg.delegacion END AS delegacion,
  CASE WHEN pg.level = 'Subdelegación' THEN lpad(CAST(pg.clave_delegacion AS VARCHAR), 2, '0') || lpad(CAST(pg.clave_subdelegacion AS VARCHAR), 2, '0') END AS clave_subdelegacion,
  CASE WHEN pg.level = 'Subdelegación' THEN pg.subdelegacion END AS subdelegacion, pg.date, pg.value
  FROM panel_geo pg JOIN pub ON pg.level = pub.level AND pg.series = pub.series AND pg.disaggregation = pub.disaggregation
    AND pg.sheet_name = pub.sheet_name),
rowsrc AS (SELECT DISTINCT path, position, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion FROM cellsrc),
long AS (SELECT r.path, r.position, r.clave_delegacion, r.delegacion, r.clave_subdelegacion, r.subdelegacion, h.col_pos, h.header,
    CASE WHEN h.header = '{S.BAD_HEADER}' THEN CAST(NULL AS DATE) ELSE h.date END AS date, c.value
  FROM rowsrc r CROSS JOIN hdr h
  LEFT JOIN cellsrc c ON c.path = r.path AND c.position = r.position AND c.clave_delegacion = r.clave_delegacion
    AND c.clave_subdelegacion IS NOT DISTINCT FROM r.clave_subdelegacion AND c.delegacion IS NOT DISTINCT FROM r.delegacion
    AND c.subdelegacion IS NOT DISTINCT FROM r.subdelegacion AND c.date = h.date),
bad AS (SELECT path, position, count(DISTINCT col_pos) FILTER (WHERE date IS NULL) AS bad_headers,
    count(*) FILTER (WHERE date IS NULL) AS bad_cells, min(col_pos) FILTER (WHERE date IS NOT NULL) AS anchor_pos
  FROM long WHERE value IS NOT NULL GROUP BY path, position HAVING count(*) FILTER (WHERE date IS NULL) > 0),
badh AS (SELECT bad.*, hdr.date AS anchor_date FROM bad LEFT JOIN hdr ON hdr.col_pos = bad.anchor_pos),
rep AS (SELECT l.* REPLACE (CASE WHEN b.path IS NOT NULL THEN CAST(b.anchor_date + to_months(l.col_pos - b.anchor_pos) AS DATE) ELSE l.date END AS date)
  FROM long l LEFT JOIN badh b ON b.path = l.path AND b.position = l.position)"""

COMPLETE = ("date IS NOT NULL AND value IS NOT NULL AND clave_delegacion IS NOT NULL AND delegacion IS NOT NULL "
            "AND ((clave_subdelegacion IS NULL) = (subdelegacion IS NULL))")
LONG_COLS = "path, position, clave_delegacion, delegacion, clave_subdelegacion, subdelegacion, col_pos, header, date"


def _clean(src: str) -> str:
    rec = " ".join(f"WHEN sheet_name = '{a}' THEN '{b}'" for a, b in B.SHEET_RECODES)
    return f"""SELECT * FROM (SELECT {_sentence('book_name')} AS book_name, {_sentence('sheet_name')} AS sheet_name, * EXCLUDE (book_name, sheet_name)
    FROM {src}) s0
  WHERE NOT regexp_matches(book_name, '{B.EXCLUDED_SERIES_BOOKS}') AND NOT regexp_matches(sheet_name, '{B.EXCLUDED_SHEETS}')
    AND ((disaggregation = 'Modalidad' AND regexp_matches(sheet_name, '\\d')) OR disaggregation <> 'Modalidad')"""


def _recode(cols: str) -> str:
    rec = " ".join(f"WHEN sheet_name = '{a}' THEN '{b}'" for a, b in B.SHEET_RECODES)
    return f"""{cols}
  CASE WHEN series = 'Salario' THEN '{B.WAGE_BOOK_NAME}' ELSE book_name END AS book_name,
  CASE {rec} WHEN contains(sheet_name, '{B.EMPLOYER_SHEET_PATTERN}') AND series = 'Patrones' THEN '{B.EMPLOYER_SHEET_LABEL}'
    ELSE sheet_name END AS sheet_name,
  CASE WHEN contains(series, 'Asegurados') THEN 'Asegurados' ELSE series END AS series, disaggregation"""


_EDGE_LAB = _values(EDGE_LABELS, ["book_name", "sheet_name", "series", "disaggregation"])

ORACLE = {
    "catalogue_classify": f"{O.PANEL_BASE}{PUB} SELECT path, name, level, series, disaggregation, book_id FROM books",
    "index_extract": f"{O.PANEL_BASE}{PUB} {_extract('idx_raw')}",
    "sheet_positions": f"{O.PANEL_BASE}{PUB} {_positions('tabs_raw')}",
    "index_conflicts": f"""{O.PANEL_BASE}{PUB},
        idx_all AS (SELECT * FROM idx_raw UNION ALL {_values(EDGE_INDEX, ['path', 'hoja', 'contenido'])}),
        tabs_all AS (SELECT * FROM tabs_raw UNION ALL {_values(EDGE_TABS, ['path', 'position', 'sheet_name'])}),
        i AS ({_extract('idx_all')}), p AS ({_positions('tabs_all')}),
        jj AS (SELECT i.path, i.hoja, p.position, p.sheet_name FROM i LEFT JOIN p ON i.path = p.path AND i.hoja = p.hoja),
        per AS (SELECT path, hoja, count(DISTINCT sheet_name) AS n_sheets, count(*) AS n_rows,
          max(CASE WHEN position IS NULL THEN 1 ELSE 0 END) AS missing FROM jj GROUP BY path, hoja)
        SELECT path, CAST(coalesce(sum(CASE WHEN n_sheets > 1 OR n_rows > 1 OR missing = 1 THEN n_rows END), 0) AS BIGINT) AS conflicts
        FROM per GROUP BY path""",
    "assign_book_sheet_ids": f"""{O.PANEL_BASE}{PUB}{SHEETS}
        SELECT path, book_id, sheet_id, hoja, contenido, position, sheet_name FROM sheets""",
    "sheet_unpivot": f"""{O.PANEL_BASE}{PUB}{GRID}
        SELECT {LONG_COLS}, value FROM long WHERE {COMPLETE}""",
    "date_repair": f"""{O.PANEL_BASE}{PUB}{GRID}
        SELECT {LONG_COLS}, value FROM rep WHERE {COMPLETE}""",
    "bad_date_report": f"""{O.PANEL_BASE}{PUB}{GRID}
        SELECT path, position, bad_headers, bad_cells, anchor_pos, anchor_date FROM badh""",
    "sheet_label_clean": f"""{O.PANEL_BASE}{PUB}{SHEETS},
        raw AS (SELECT name AS book_name, contenido AS sheet_name, series, disaggregation FROM sheets UNION ALL {_EDGE_LAB}),
        c AS ({_clean('raw')})
        SELECT {_recode('')} FROM c""",
    "composite_code_split": f"""{O.PANEL_BASE}{PUB}{GRID}
        SELECT path, position, clave_delegacion AS code_del, clave_subdelegacion AS code_sub,
          TRY_CAST(nullif(substr(clave_delegacion, 1, 2), '') AS INT) AS clave_delegacion,
          TRY_CAST(nullif(substr(clave_subdelegacion, 3, 2), '') AS INT) AS clave_subdelegacion FROM rowsrc""",
    "historical_panel": f"""{O.PANEL_BASE}{PUB}{SHEETS}{GRID},
        lab0 AS (SELECT path, position, book_id, sheet_id, name AS book_name, contenido AS sheet_name, level, series, disaggregation FROM sheets),
        lab AS (SELECT {_recode('path, position, book_id, sheet_id, level,')} FROM ({_clean('lab0')}) c),
        data AS (SELECT path, position, TRY_CAST(nullif(substr(clave_delegacion, 1, 2), '') AS INT) AS clave_delegacion,
          TRY_CAST(nullif(substr(clave_subdelegacion, 3, 2), '') AS INT) AS clave_subdelegacion, date, value FROM rep WHERE {COMPLETE}),
        hp AS (SELECT l.book_id, l.sheet_id, l.book_name, l.sheet_name, l.level, d.date, d.clave_delegacion, d.clave_subdelegacion,
          l.series, l.disaggregation, d.value FROM data d JOIN lab l ON d.path = l.path AND d.position = l.position)
        SELECT hp.book_id, hp.sheet_id, hp.book_name, hp.sheet_name, hp.level, hp.date, hp.clave_delegacion, hp.clave_subdelegacion,
          dl.delegacion, s.subdelegacion, hp.series, hp.disaggregation, hp.value
        FROM hp
        LEFT JOIN (SELECT DISTINCT clave_delegacion, clave_subdelegacion, subdelegacion FROM f_geo) s
          ON hp.clave_delegacion IS NOT DISTINCT FROM s.clave_delegacion AND hp.clave_subdelegacion IS NOT DISTINCT FROM s.clave_subdelegacion
        LEFT JOIN (SELECT DISTINCT clave_delegacion, delegacion FROM f_geo) dl ON hp.clave_delegacion IS NOT DISTINCT FROM dl.clave_delegacion""",
}


def _cross_validation_sql() -> str:
    hist = ORACLE["historical_panel"]
    labelled = _recode("level, date, clave_delegacion, clave_subdelegacion, value,")
    comp = f"""{O.PANEL_BASE} SELECT * REPLACE (CASE WHEN clave_subdelegacion % {REVISED_EVERY} = 0 AND month(date) = {REVISED_MONTH}
        THEN value + {REVISION} ELSE value END AS value) FROM (SELECT {labelled} FROM ({_clean('panel_geo')}) c) r"""
    key = XV_KEY
    join = " AND ".join(f"n.{k} IS NOT DISTINCT FROM s.{k}" for k in key)
    sel = ", ".join(f"coalesce(n.{k}, s.{k}) AS {k}" for k in key)
    return f"""WITH stored AS (SELECT * FROM ({hist}) h WHERE value IS NOT NULL), computed AS (SELECT * FROM ({comp}) x WHERE value IS NOT NULL),
common AS (SELECT date FROM computed INTERSECT SELECT date FROM stored),
n AS (SELECT *, TRUE AS present FROM computed WHERE date IN (SELECT date FROM common)),
s AS (SELECT *, TRUE AS present FROM stored WHERE date IN (SELECT date FROM common)),
j AS (SELECT {sel}, n.value AS new_value, s.value AS stored_value, n.value - s.value AS diff,
  CASE WHEN s.present IS NULL THEN 'missing_stored'
       WHEN n.present IS NULL THEN 'missing_new'
       WHEN s.value IS NULL THEN 'stored_null'
       WHEN abs(n.value - s.value) > 1.0 THEN 'changed' END AS status
  FROM n FULL OUTER JOIN s ON {join})
SELECT {', '.join(key)}, new_value, stored_value, diff, status
FROM j WHERE status IS NOT NULL"""


ORACLE["cross_validation"] = _cross_validation_sql()
