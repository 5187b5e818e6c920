"""The named queries as SQL over the given tables, for a second engine."""

from __future__ import annotations

from tollstats.functions.hashing import NULL_MARK
from tollstats.operators.sampling import SEED
from tollstats.operators.surrogate import ID_BUCKETS
from tollstats.plans.models import (
    FOREST_NAME,
    LOGISTIC_NAME,
    MULTINOMIAL_NAME,
    PERCEPTRON_NAME,
    TREE_NAME,
)
from tollstats.registry.queries import (
    BAD_ID_EVERY,
    BAD_TOTAL_EVERY,
    CHANGED_EVERY,
    HEAVY_CUT,
    LOADED_BEFORE,
    LONG_LINE_EVERY,
    MORE_VEHICLES,
    Q2_MORE_THAN,
    Q2_YEAR,
    Q3_YEAR,
    Q8_YEAR,
    Q11_YEAR,
    Q12_YEAR,
    RARE_QUANTILE,
    REPEATED_EVERY,
    RULE,
    RULE_PROBABILITIES,
    SHORT_LINE_EVERY,
    TERCILE_RULE,
)
from tollstats.schema import FLUJO_NAMES, MEASURE_COLUMNS, STATION_COLUMNS

BINARY_NAMES = [LOGISTIC_NAME, PERCEPTRON_NAME]
TERCILE_NAMES = [TREE_NAME, FOREST_NAME, MULTINOMIAL_NAME]
_AXLES = "\n".join(
    f"  sum(CASE WHEN l_linenumber = {a} AND l_discount <= 0.05 THEN v ELSE 0 END) AS veh_pesados_{a}e,"
    for a in range(2, 8)
)
SQL_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE"}
_COUNTS = [c.name for c in MEASURE_COLUMNS if c.kind == "bigint"]
_DAYS = "CAST(day(last_day(make_date(anio, mes, 1))) AS DOUBLE)"


def _measure(column) -> str:
    if column.kind == "double":
        return f"{column.name.replace('_imd', '_total')} / {_DAYS} AS {column.name}"
    kind = "BIGINT" if column.name in _COUNTS else "INTEGER"
    return f"CAST({column.name} AS {kind}) AS {column.name}"


BINDING = f"""
WITH peaje AS (
  SELECT s_suppkey AS id_peaje, s_name AS nombre_peaje, n_name AS departamento, r_name AS administracion
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
items AS (
  SELECT *, CAST(l_quantity AS BIGINT) AS v, CAST(year(l_shipdate) AS INTEGER) AS anio,
         CAST(month(l_shipdate) AS INTEGER) AS mes
  FROM lineitem),
monthly AS (
  SELECT l_suppkey AS id_peaje, anio, mes,
  sum(CASE WHEN l_linenumber = 1 AND l_discount > 0.05 THEN v ELSE 0 END) AS veh_ligeros_tar_dif,
  sum(CASE WHEN l_linenumber = 1 AND l_discount <= 0.05 THEN v ELSE 0 END) AS veh_ligeros_automoviles,
  sum(CASE WHEN l_linenumber = 1 THEN v ELSE 0 END) AS veh_ligeros_total,
  sum(CASE WHEN l_linenumber > 1 AND l_discount > 0.05 THEN v ELSE 0 END) AS veh_pesados_tar_dif,
{_AXLES}
  sum(CASE WHEN l_linenumber > 1 THEN v ELSE 0 END) AS veh_pesados_total,
  sum(v) AS veh_total
  FROM items GROUP BY l_suppkey, anio, mes),
flujo_peaje AS (
  SELECT CAST(id_peaje * 10000 + (anio - 1990) * 12 + mes AS BIGINT) AS id_flujo, id_peaje,
  {", ".join(_measure(c) for c in MEASURE_COLUMNS)}
  FROM monthly),
juntos AS (SELECT * FROM flujo_peaje JOIN peaje USING (id_peaje))
"""

_INT_MEASURES = ", ".join(
    f"CAST({c.name} AS {SQL_TYPES[c.kind]}) AS {c.name}" for c in MEASURE_COLUMNS
)
_STATION = "nombre_peaje, departamento, administracion"
_STATION_TEXT = "concat_ws('|', {})".format(
    ", ".join(f"coalesce({name}, '{NULL_MARK}')" for _, name in STATION_COLUMNS)
)
_ID_BUCKET = f"CAST(concat('0x', substr(md5({_STATION_TEXT}), 1, 8)) AS BIGINT) % {ID_BUCKETS}"
_SIDE_BUCKET = (
    f"CAST(concat('0x', substr(md5(concat('{SEED}:', CAST(id_flujo AS VARCHAR))), 1, 8)) AS BIGINT) % 100"
)
_FACT = f"CAST(id_flujo AS BIGINT) AS id_flujo, id_peaje, {_INT_MEASURES}"

_BASE = """, base AS (
  SELECT id_flujo, CAST(anio AS DOUBLE) AS anio, CAST(mes AS DOUBLE) AS mes,
         coalesce(veh_ligeros_imd, 0) AS veh_ligeros_imd, coalesce(veh_pesados_imd, 0) AS veh_pesados_imd,
         CAST(veh_total AS DOUBLE) AS veh_total, departamento, administracion
  FROM juntos)"""


def _labelled(p: float) -> str:
    return f"""{_BASE}, labelled AS (
  SELECT *, CASE WHEN veh_total >= (SELECT quantile_disc(veh_total, {p}) FROM base)
                 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM base)"""


def _tercile(column: str, source: str) -> str:
    return f"""CASE WHEN {column} < (SELECT quantile_disc({column}, 0.33) FROM {source}) THEN 0.0::DOUBLE
     WHEN {column} < (SELECT quantile_disc({column}, 0.66) FROM {source}) THEN 1.0::DOUBLE
     ELSE 2.0::DOUBLE END"""


_TERCILES = f"""{_BASE}, labelled AS (
  SELECT *, {_tercile("veh_total", "base")} AS label FROM base)"""


def _oversample(p: float) -> str:
    return f"""{_labelled(p)},
sizes AS (SELECT count(*) FILTER (label = 0) AS large, count(*) FILTER (label = 1) AS small FROM labelled)
SELECT id_flujo, veh_total, label,
       CAST(unnest(range(1, CASE WHEN label = 1 THEN greatest(1, (SELECT large // small FROM sizes)) ELSE 1 END + 1))
            AS BIGINT) AS copy
FROM labelled"""


_INDEXED = f"""{_BASE},
dep AS (SELECT departamento, row_number() OVER (ORDER BY count(*) DESC, departamento) - 1 AS i
        FROM base GROUP BY departamento),
adm AS (SELECT administracion, row_number() OVER (ORDER BY count(*) DESC, administracion) - 1 AS i
        FROM base GROUP BY administracion)"""

_PROBABILITY_ROWS = str(RULE_PROBABILITIES)

_SCORES = f""", rule AS (
  SELECT '{RULE}' AS modelo,
         CASE WHEN veh_total >= (SELECT quantile_disc(veh_total, 0.5) FROM flujo_peaje)
              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label,
         CASE WHEN veh_pesados_total / CAST(veh_total AS DOUBLE) >= {HEAVY_CUT}
              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction,
         veh_pesados_total / CAST(veh_total AS DOUBLE) AS p1
  FROM flujo_peaje),
rule_losses AS (
  SELECT modelo, label, prediction,
         greatest(1e-15, least(1 - 1e-15, CASE WHEN label = 1 THEN p1 ELSE 1 - p1 END)) AS p_true
  FROM rule),
terciles AS (
  SELECT '{TERCILE_RULE}' AS modelo, {_tercile("veh_total", "flujo_peaje")} AS label,
         {_tercile("veh_ligeros_total", "flujo_peaje")} AS prediction
  FROM flujo_peaje),
tercile_losses AS (
  SELECT modelo, label, prediction,
         CAST(({_PROBABILITY_ROWS})[CAST(prediction AS INTEGER) + 1][CAST(label AS INTEGER) + 1] AS DOUBLE) AS p_true
  FROM terciles),
losses AS (
  SELECT modelo, label, prediction, -ln(p_true) AS loss FROM rule_losses
  UNION ALL SELECT modelo, label, prediction, -ln(p_true) AS loss FROM tercile_losses)"""

_METRICS = f"""{_SCORES},
totals AS (SELECT modelo, count(*) AS rows_n, avg(loss) AS loss, avg(CAST(label = prediction AS DOUBLE)) AS accuracy
           FROM losses GROUP BY modelo),
labels_n AS (SELECT modelo, label, count(*) AS of_label, count(*) FILTER (label = prediction) AS hits
             FROM losses GROUP BY modelo, label),
predictions_n AS (SELECT modelo, prediction, count(*) AS of_prediction FROM losses GROUP BY modelo, prediction),
classes AS (
  SELECT l.modelo, l.of_label, CAST(l.hits AS DOUBLE) / l.of_label AS recall,
         coalesce(CAST(l.hits AS DOUBLE) / p.of_prediction, 0) AS prec
  FROM labels_n l LEFT JOIN predictions_n p ON l.modelo = p.modelo AND l.label = p.prediction),
weighted AS (
  SELECT modelo, sum(of_label * recall) / sum(of_label) AS recall,
         sum(of_label * CASE WHEN prec + recall > 0 THEN 2 * prec * recall / (prec + recall) ELSE 0 END)
           / sum(of_label) AS f1_score
  FROM classes GROUP BY modelo),
metrics AS (
  SELECT modelo, round(accuracy, 6) AS accuracy, round(recall, 6) AS recall,
         round(f1_score, 6) AS f1_score, round(loss, 6) AS loss
  FROM totals JOIN weighted USING (modelo))"""

_Q3 = f"""SELECT nombre_peaje, departamento, CAST(sum(veh_total) AS BIGINT) AS vehiculos
FROM juntos WHERE anio = {Q3_YEAR} GROUP BY nombre_peaje, departamento
ORDER BY vehiculos DESC NULLS LAST, nombre_peaje NULLS FIRST, departamento NULLS FIRST"""

_Q6 = """SELECT anio, mes, nombre_peaje, departamento, veh_total FROM juntos
ORDER BY anio NULLS FIRST, mes NULLS FIRST, nombre_peaje NULLS FIRST, departamento NULLS FIRST,
         veh_total NULLS FIRST, id_flujo NULLS FIRST"""

_Q7 = """SELECT anio, nombre_peaje, departamento, CAST(sum(veh_ligeros_total) AS BIGINT) AS total_ligeros,
       CAST(sum(veh_total) AS BIGINT) AS total_vehiculos,
       CASE WHEN sum(veh_total) > 0
            THEN round(CAST(sum(veh_ligeros_total) AS DOUBLE) / CAST(sum(veh_total) AS DOUBLE) * 100.0::DOUBLE, 2)
            ELSE 0.0 END AS pct_ligeros
FROM juntos GROUP BY anio, nombre_peaje, departamento
ORDER BY pct_ligeros DESC NULLS LAST, anio NULLS FIRST, nombre_peaje NULLS FIRST,
         departamento NULLS FIRST, total_ligeros NULLS FIRST, total_vehiculos NULLS FIRST"""

_Q8 = f"""SELECT anio, mes, nombre_peaje, departamento, veh_total FROM juntos WHERE anio = {Q8_YEAR}
ORDER BY mes NULLS FIRST, nombre_peaje NULLS FIRST, departamento NULLS FIRST, veh_total NULLS FIRST,
         id_flujo NULLS FIRST"""

_Q10 = """SELECT anio, administracion, count(DISTINCT id_peaje) AS num_peajes
FROM juntos GROUP BY anio, administracion ORDER BY anio NULLS FIRST, administracion NULLS FIRST"""

_Q11 = f"""SELECT anio, mes, nombre_peaje, departamento, veh_total FROM juntos WHERE anio = {Q11_YEAR}
ORDER BY veh_total DESC NULLS LAST, mes NULLS FIRST, nombre_peaje NULLS FIRST,
         departamento NULLS FIRST, id_flujo NULLS FIRST"""

_Q12 = f"""SELECT anio, departamento, round(avg(veh_total), 6) AS promedio_veh_total
FROM juntos WHERE anio = {Q12_YEAR} GROUP BY anio, departamento
ORDER BY avg(veh_total) DESC NULLS LAST, anio NULLS FIRST, departamento NULLS FIRST"""

# The administrations of the given tables.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]

_PIVOT_COLUMNS = ", ".join(
    f"""count(DISTINCT CASE WHEN administracion = '{r}' THEN id_peaje END) AS "{r}\"""" for r in REGIONS
)

_RAW_COLUMNS = ", ".join(
    ["CAST(id_flujo AS BIGINT) AS \"ID\""]
    + [f'{name} AS "{raw}"' for raw, name in STATION_COLUMNS]
    + [
        f'CAST({c.name} AS {SQL_TYPES[c.kind]}) AS "{c.raw}"'
        for c in MEASURE_COLUMNS
    ]
)

_NEW = f"SELECT DISTINCT {_STATION} FROM juntos WHERE id_peaje % 2 <> 0"


def _numbered(source: str, after: str) -> str:
    return f"""SELECT CAST({after} + row_number() OVER (ORDER BY {_ID_BUCKET}, {_STATION}) AS BIGINT) AS id_peaje,
       {_STATION} FROM ({source}) s"""


_BODIES: dict[str, str] = {
    "q1_peaje": "SELECT nombre_peaje, departamento FROM peaje",
    "q1_flujo": "SELECT anio, mes, veh_total, veh_imd FROM flujo_peaje",
    "q2": f"""SELECT id_flujo, anio, mes, veh_total FROM flujo_peaje
WHERE anio = {Q2_YEAR} AND veh_total > {Q2_MORE_THAN}""",
    "q3": _Q3,
    "q4": f"SELECT anio, {_PIVOT_COLUMNS} FROM juntos GROUP BY anio ORDER BY anio",
    "q4_long": _Q10,
    "q5": """SELECT anio, round(avg(veh_imd), 6) AS promedio_veh_imd FROM flujo_peaje
GROUP BY anio ORDER BY anio""",
    "q6": _Q6,
    "q7": _Q7,
    "q8": _Q8,
    "q9": "SELECT anio, count(*) AS registros FROM flujo_peaje GROUP BY anio ORDER BY anio",
    "q10": _Q10,
    "q11": _Q11,
    "q12": _Q12,
    "topk_q3": _Q3 + " LIMIT 20",
    "topk_q6": _Q6 + " LIMIT 25",
    "topk_q7": _Q7 + " LIMIT 25",
    "topk_q8": _Q8 + " LIMIT 25",
    "topk_q10": _Q10 + " LIMIT 30",
    "topk_q11": _Q11 + " LIMIT 30",
    "topk_q12": _Q12 + " LIMIT 25",
    "csv_scan": f"SELECT {_RAW_COLUMNS} FROM juntos",
    "parquet_append": f"SELECT {_FACT} FROM flujo_peaje",
    "dim_extract": f"SELECT DISTINCT {_STATION} FROM juntos",
    "dim_new": _NEW,
    "dim_new_count": f"SELECT count(*) AS new_stations FROM ({_NEW}) s",
    "surrogate_ids": _numbered(f"SELECT DISTINCT {_STATION} FROM juntos", "0"),
    "load_dim": f"""SELECT id_peaje, {_STATION} FROM peaje WHERE id_peaje % 2 = 0
UNION ALL {_numbered(_NEW, "(SELECT max(id_peaje) FROM peaje WHERE id_peaje % 2 = 0)")}""",
    "fact_typed": f"SELECT id_flujo, {_STATION}, {_INT_MEASURES} FROM juntos",
    "fact_lookup": f"SELECT {_FACT} FROM juntos WHERE id_peaje % 2 = 0",
    "fact_rejected": f"SELECT id_flujo, {_STATION}, {_INT_MEASURES} FROM juntos WHERE id_peaje % 2 <> 0",
    "fact_new": f"SELECT {', '.join(FLUJO_NAMES)} FROM flujo_peaje WHERE anio >= {LOADED_BEFORE}",
    "load_rejected": f"""SELECT * FROM (
  SELECT CASE WHEN id_flujo % {BAD_ID_EVERY} = 0 THEN 'x' ELSE '' END || id_flujo AS "ID",
         concat_ws(',', CASE WHEN id_flujo % {BAD_ID_EVERY} = 0 THEN 'ID' END,
                   CASE WHEN id_flujo % {BAD_TOTAL_EVERY} = 0 THEN 'VEH_TOTAL' END,
                   CASE WHEN id_peaje % 2 <> 0 THEN 'station' END) AS reasons
  FROM juntos) r WHERE reasons <> ''""",
    "load_fact": f"SELECT {_FACT} FROM flujo_peaje",
    "dedup_key": """SELECT id_flujo, mes, veh_total, veh_imd FROM (
  SELECT *, row_number() OVER (PARTITION BY id_flujo ORDER BY mes, veh_total, veh_imd) AS r FROM (
    SELECT id_peaje * 10000 + anio AS id_flujo, mes, veh_total, veh_imd FROM flujo_peaje) y) z
WHERE r = 1""",
    "join_using": f"SELECT id_peaje, * EXCLUDE (id_peaje) FROM juntos",
    "fillna_numeric": """SELECT id_flujo, coalesce(nullif(veh_ligeros_total, 0), 0) AS veh_ligeros_total,
       coalesce(nullif(veh_imd, 1.0), 0) AS veh_imd, nullif(departamento, 'NATION_3') AS departamento
FROM juntos""",
    "union_all": """SELECT id_flujo, anio, mes, veh_total FROM flujo_peaje WHERE anio <= 1998
UNION ALL SELECT id_flujo, anio, mes, veh_total FROM flujo_peaje WHERE anio >= 1998""",
    "ml_base": f"{_BASE} SELECT * FROM base",
    "quantile_median": f"{_BASE} SELECT quantile_disc(veh_total, 0.5) AS mediana FROM base",
    "quantile_terciles": f"""{_BASE}
SELECT quantile_disc(veh_total, 0.33) AS q33, quantile_disc(veh_total, 0.66) AS q66 FROM base""",
    "label_median": f"{_labelled(0.5)} SELECT id_flujo, veh_total, label FROM labelled",
    "label_terciles": f"{_TERCILES} SELECT id_flujo, veh_total, label FROM labelled",
    "label_distribution": f'{_labelled(0.5)} SELECT label, count(*) AS "count" FROM labelled GROUP BY label',
    "label_distribution_terciles": f'{_TERCILES} SELECT label, count(*) AS "count" FROM labelled GROUP BY label',
    "oversample": _oversample(RARE_QUANTILE),
    "oversample_median": _oversample(0.5),
    "split_rows": f"""SELECT id_flujo, CAST(CASE WHEN {_SIDE_BUCKET} < 80 THEN 0 ELSE 1 END AS INTEGER) AS side
FROM flujo_peaje""",
    "split_counts": f"""SELECT CAST(CASE WHEN {_SIDE_BUCKET} < 80 THEN 0 ELSE 1 END AS INTEGER) AS side,
       count(*) AS "count" FROM flujo_peaje GROUP BY 1""",
    "string_index": f"""{_INDEXED}
SELECT 'departamento' AS category, departamento AS label_value, CAST(i AS DOUBLE) AS label_index FROM dep
UNION ALL SELECT 'administracion', administracion, CAST(i AS DOUBLE) FROM adm""",
    "one_hot": f"""{_INDEXED}
SELECT id_flujo, 'departamento' AS category, CAST(i AS INTEGER) AS position, 1.0::DOUBLE AS value
FROM base JOIN dep USING (departamento)
UNION ALL SELECT id_flujo, 'administracion', CAST(i AS INTEGER), 1.0::DOUBLE
FROM base JOIN adm USING (administracion)""",
    "features": f"""{_INDEXED},
entries AS (
  SELECT id_flujo, 0 AS position, anio AS value FROM base
  UNION ALL SELECT id_flujo, 1, mes FROM base
  UNION ALL SELECT id_flujo, 2, veh_ligeros_imd FROM base
  UNION ALL SELECT id_flujo, 3, veh_pesados_imd FROM base
  UNION ALL SELECT id_flujo, 4 + i, 1.0 FROM base JOIN dep USING (departamento)
  UNION ALL SELECT id_flujo, 4 + (SELECT count(*) FROM dep) + i, 1.0 FROM base JOIN adm USING (administracion))
SELECT id_flujo, CAST(position AS INTEGER) AS position, CAST(value AS DOUBLE) AS value
FROM entries WHERE value <> 0""",
    "confusion_matrix": f"""{_SCORES}
SELECT modelo, label, prediction, count(*) AS "count" FROM losses
GROUP BY modelo, label, prediction ORDER BY modelo, label, prediction""",
    "metric_accuracy": f"{_METRICS} SELECT modelo, accuracy FROM metrics",
    "metric_recall": f"{_METRICS} SELECT modelo, recall FROM metrics",
    "metric_f1": f"{_METRICS} SELECT modelo, f1_score FROM metrics",
    "recall_by_class": f"""{_METRICS}
SELECT modelo, label, round(CAST(hits AS DOUBLE) / of_label, 6) AS class_recall FROM labels_n""",
    "logloss_binary": f"{_SCORES} SELECT round(avg(-ln(p_true)), 6) AS loss FROM rule_losses",
    "logloss_binary_compat": f"""{_SCORES}
SELECT round(avg(-(label * ln(p_true) + (1 - label) * ln(1 - p_true))), 6) AS loss FROM rule_losses""",
    "logloss_multi": f"{_SCORES} SELECT round(avg(-ln(p_true)), 6) AS loss FROM tercile_losses",
    "ml_scored_rows": f"""{_BASE}, sides AS (
  SELECT *, {_SIDE_BUCKET} >= 80 AS test FROM base),
both_labels AS (
  SELECT test, CASE WHEN veh_total >= (SELECT quantile_disc(veh_total, 0.5) FROM base)
                    THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS two_class,
         {_tercile("veh_total", "base")} AS three_class FROM sides)
SELECT modelo, label, count(*) AS "rows", CAST(count(*) AS DOUBLE) AS probability
FROM (SELECT unnest({BINARY_NAMES}) AS modelo, two_class AS label FROM both_labels WHERE test
      UNION ALL SELECT unnest({TERCILE_NAMES}), three_class FROM both_labels WHERE test) m
GROUP BY modelo, label""",
    "metrics_table": f"{_METRICS} SELECT * FROM metrics",
    "csv_rejected": f"""SELECT CAST(id_flujo AS VARCHAR) AS "ID", 'fields' AS reasons FROM juntos
WHERE id_flujo % {SHORT_LINE_EVERY} = 0 OR id_flujo % {LONG_LINE_EVERY} = 0""",
    "load_conflicts": f"""SELECT id_flujo, CAST(veh_total + 1 AS BIGINT) AS veh_total, 'changed' AS reasons FROM juntos
WHERE anio < {LOADED_BEFORE} AND id_flujo % {CHANGED_EVERY} = 0
UNION ALL SELECT id_flujo, CAST(veh_total + {MORE_VEHICLES} AS BIGINT),
                 CASE WHEN anio < {LOADED_BEFORE} THEN 'changed' ELSE 'duplicate' END FROM juntos
WHERE id_flujo % {REPEATED_EVERY} = 0""",
    "fact_new_pruned": f"SELECT {_FACT} FROM flujo_peaje WHERE anio = {LOADED_BEFORE} AND id_flujo % 2 <> 0",
    "activity_bitmaps": _Q10,
    "class_weights": f"""{_labelled(RARE_QUANTILE)}, sizes AS (
  SELECT count(*) FILTER (WHERE label = 1) AS small, count(*) FILTER (WHERE label = 0) AS large FROM labelled)
SELECT label, count(*) AS "rows",
       CAST(count(*) * CASE WHEN label = 1 THEN greatest(1, large // small) ELSE 1 END AS DOUBLE) AS weight
FROM labelled, sizes GROUP BY label, large, small""",
    # At the optimum every score equation holds: for the constant, four numbers and one column per category.
    "ml_optimality": f"""{_BASE}, width AS (
  SELECT 5 + count(DISTINCT departamento) + count(DISTINCT administracion) AS n FROM base),
equations AS (
  SELECT '{LOGISTIC_NAME}' AS modelo, 1 AS class UNION ALL SELECT '{MULTINOMIAL_NAME}', unnest([0, 1, 2]))
SELECT modelo, CAST(class AS INTEGER) AS class, CAST(position AS INTEGER) AS position, 0.0::DOUBLE AS residual
FROM equations, (SELECT unnest(range(n)) AS position FROM width) p""",
    "ml_tree_rules": f"""SELECT unnest({[TREE_NAME, FOREST_NAME]}) AS modelo, count(*) AS "rows", CAST(0 AS BIGINT) AS differing
FROM flujo_peaje WHERE {_SIDE_BUCKET} >= 80""",
    "ml_mlp_forward": f"""SELECT '{PERCEPTRON_NAME}' AS modelo, count(*) AS "rows", CAST(0 AS BIGINT) AS differing
FROM flujo_peaje WHERE {_SIDE_BUCKET} >= 80""",
    "ml_tree_leaves": f"""{_TERCILES} SELECT label, count(*) AS "rows", CAST(0 AS BIGINT) AS wrong
FROM labelled WHERE {_SIDE_BUCKET} < 80 GROUP BY label""",
    "ml_compare_rules": f"""SELECT unnest({[*BINARY_NAMES, *TERCILE_NAMES]}) AS modelo, 0.0::DOUBLE AS accuracy,
       0.0::DOUBLE AS recall, 0.0::DOUBLE AS f1_score, 0.0::DOUBLE AS loss""",
}

ORACLE: dict[str, str] = {name: BINDING + body for name, body in _BODIES.items()}
ORACLE["cast_trunc"] = """
SELECT l_orderkey, l_linenumber, l_partkey,
       CAST(trunc(CASE WHEN l_linenumber % 2 = 0 THEN -l_extendedprice ELSE l_extendedprice END) AS BIGINT) AS price
FROM lineitem"""
