"""DuckDB SQL for the named queries, written from the definitions and not from the Spark code."""

from __future__ import annotations

# Output columns of the feature blocks, in order.
MODEL_FEATURES = (
    "cnt_24h sum_24h avg_amount amount_std unique_merchants unique_subsidiaries amount_cv amount_range "
    "merchant_concentration subsidiary_concentration same_amount_ratio avg_interval_minutes std_interval_minutes"
).split()
SLIDING_FEATURES = (
    "cnt_24h sum_24h avg_amount unique_merchants unique_subsidiaries hour_dispersion amount_cv amount_range "
    "merchant_concentration subsidiary_concentration same_amount_ratio avg_interval_minutes std_interval_minutes"
).split()
ANCHOR_FEATURES = (
    "cnt_24h sum_24h avg_amount unique_merchants unique_subsidiaries amount_cv merchant_concentration "
    "same_amount_ratio avg_interval_minutes"
).split()
BASELINE_METRICS = "cnt_24h sum_24h avg_amount unique_merchants merchant_concentration same_amount_ratio avg_interval_minutes".split()

AMOUNT = "transaction_amount"
TS = "transaction_date"
WEIGHTED = [
    "cnt_24h",
    "sum_24h",
    "avg_interval_minutes",
    "same_amount_ratio",
    "merchant_concentration",
    "amount_cv",
    "unique_merchants",
    "hour_dispersion",
]
ALERT_COLUMNS = ["user_id", "date", "cnt_24h", "sum_24h", "avg_amount", "unique_merchants"]
RANGE = "BETWEEN DATE '2024-01-04' AND DATE '2024-01-23'"


def r(expression: str, name: str | None = None) -> str:
    """Rounding used at every output."""
    return f"round(({expression}) + 1e-8, 6) + 0.0 AS {name or expression}"


# ---------------------------------------------------------------- inputs

TXE = """txe AS (
  SELECT CAST(event_id AS VARCHAR) AS _id, user_id, ts AS transaction_date, value AS transaction_amount,
         CASE WHEN event_type IN ('purchase', 'click', 'view') THEN 'DEBITO' ELSE 'CREDITO' END AS transaction_type,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 10 AS merchant_id,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) % 3 AS subsidiary
  FROM events)"""

TXR = """txr AS (
  SELECT o_orderkey || '-' || l_linenumber AS _id, o_custkey AS user_id,
         o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 1009 + l_partkey * 31) % 86400) AS transaction_date,
         l_extendedprice AS transaction_amount,
         CASE WHEN l_returnflag = 'R' THEN 'CREDITO' ELSE 'DEBITO' END AS transaction_type,
         l_suppkey AS merchant_id, l_suppkey % 10 AS subsidiary
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DEDUP_ORDER = "transaction_date, transaction_amount, merchant_id, transaction_type, subsidiary, user_id"
TXO = f"""{TXR}, txo AS (
  SELECT * FROM txr QUALIFY row_number() OVER (PARTITION BY _id ORDER BY {DEDUP_ORDER}) = 1)"""

HOLES = f"""{TXE}, holes AS (
  SELECT _id, user_id, CASE WHEN CAST(_id AS BIGINT) % 11 <> 0 THEN transaction_date END AS transaction_date,
         CASE WHEN CAST(_id AS BIGINT) % 7 <> 0 THEN transaction_amount END AS transaction_amount, transaction_type,
         CASE WHEN CAST(_id AS BIGINT) % 5 <> 0 THEN merchant_id END AS merchant_id, subsidiary
  FROM txe)"""

IDS = f"""{TXR}, ids AS (
  SELECT * REPLACE (CASE WHEN CAST(split_part(_id, '-', 1) AS BIGINT) % 5 = 0 THEN upper(md5(_id))
                         WHEN CAST(split_part(_id, '-', 1) AS BIGINT) % 7 = 0 THEN _id
                         WHEN CAST(split_part(_id, '-', 1) AS BIGINT) % 11 = 0 THEN NULL
                         ELSE md5(_id) END AS _id)
  FROM txr)"""


# ---------------------------------------------------------------- features


def feature_ctes(source: str, keys: str, name: str = "feats") -> str:
    """CTE ``name`` with every behaviour feature of the rows of ``source`` per ``keys``."""
    on = " AND ".join(f"b.{k.strip()} = {{t}}.{k.strip()}" for k in keys.split(","))

    def top(alias: str, column: str) -> str:
        return f"""{name}_{alias} AS (
  SELECT {keys}, max(c) AS top FROM (
    SELECT {keys}, {column}, count(*) AS c FROM {source} WHERE {column} IS NOT NULL GROUP BY {keys}, {column})
  GROUP BY {keys})"""

    return f"""{name}_g AS (
  SELECT *, (epoch_us({TS}) - epoch_us(lag({TS}) OVER (PARTITION BY {keys} ORDER BY {TS}))) / 6e7 AS gap FROM {source}),
{name}_b AS (
  SELECT {keys}, count(*) AS n, count({AMOUNT}) AS cnt_24h, coalesce(sum({AMOUNT}), 0.0) AS sum_24h,
         avg({AMOUNT}) AS avg_raw, coalesce(stddev_samp({AMOUNT}), 0.0) AS amount_std,
         max({AMOUNT}) - min({AMOUNT}) AS amount_range, count(DISTINCT merchant_id) AS unique_merchants,
         count(DISTINCT subsidiary) AS unique_subsidiaries, count(DISTINCT hour({TS})) AS hour_dispersion,
         coalesce(avg(gap), 0.0) AS avg_interval_minutes, coalesce(stddev_samp(gap), 0.0) AS std_interval_minutes
  FROM {name}_g GROUP BY {keys}),
{top("m", "merchant_id")},
{top("s", "subsidiary")},
{top("a", AMOUNT)},
{name} AS (
  SELECT b.*, avg_raw AS avg_amount,
         CASE WHEN coalesce(avg_raw, 0) = 0 THEN 0.0 ELSE amount_std / avg_raw END AS amount_cv,
         m.top / b.n AS merchant_concentration, s.top / b.n AS subsidiary_concentration, a.top / b.n AS same_amount_ratio
  FROM {name}_b b LEFT JOIN {name}_m m ON {on.format(t="m")} LEFT JOIN {name}_s s ON {on.format(t="s")}
  LEFT JOIN {name}_a a ON {on.format(t="a")})"""


INTEGERS = {"cnt_24h", "unique_merchants", "unique_subsidiaries", "hour_dispersion"}


def outputs(columns: list[str], fill_avg: bool = False) -> str:
    parts = []
    for c in columns:
        if c in INTEGERS:
            parts.append(c)
        elif c == "avg_amount" and fill_avg:
            parts.append(r("coalesce(avg_amount, 0.0)", c))
        else:
            parts.append(r(c))
    return ", ".join(parts)


def day_features(ctes: str, table: str) -> str:
    return f"""{ctes}, deb AS (
  SELECT *, CAST({TS} AS DATE) AS date FROM {table} WHERE transaction_type = 'DEBITO' AND {TS} IS NOT NULL AND user_id IS NOT NULL),
{feature_ctes("deb", "user_id, date")}"""


def rolling(amount: str) -> str:
    """Windows of each debit; sums of 1e15 and more are left out."""
    total = f"CASE WHEN sum({AMOUNT}) OVER w < 1e15 THEN sum({AMOUNT}) OVER w END"
    return f"""WITH {TXE}, deb AS (SELECT * REPLACE ({amount} AS {AMOUNT}) FROM txe WHERE transaction_type = 'DEBITO')
        SELECT _id, user_id, {TS}, count({AMOUNT}) OVER w AS cnt_24h, {r(total, "sum_24h")}, count(DISTINCT merchant_id) OVER w AS unique_merchants
        FROM deb WINDOW w AS (PARTITION BY user_id ORDER BY {TS} RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW)"""


def user_day(ctes: str, table: str, where: str = "TRUE") -> str:
    return f"WITH {day_features(ctes, table)} SELECT user_id, date, {outputs(MODEL_FEATURES, True)} FROM feats WHERE {where}"


END = f"(SELECT max({TS}) FROM txe)"
START = f"({END} - INTERVAL 30 DAY)"
HISTORY = f"""hist AS (
  SELECT * FROM txe WHERE transaction_type = 'DEBITO' AND {TS} >= {START} AND {TS} < {END})"""


def anchored(step_days: int, first: int = 0) -> str:
    """CTE ``anch``: history rows with every anchor whose closed 24 h window holds them."""
    return f"""anchors AS (
  SELECT {START} + i * INTERVAL {step_days} DAY AS analysis_date FROM range({first}, {30 // step_days + 1}) t(i)),
anch AS (
  SELECT h.*, a.analysis_date FROM hist h JOIN anchors a
  ON h.{TS} BETWEEN a.analysis_date - INTERVAL 24 HOUR AND a.analysis_date)"""


ANCHORS = f"{TXE}, {HISTORY}, {anchored(3)}, {feature_ctes('anch', 'user_id, analysis_date', 'af')}"
WINDOW = f"""win AS (
  SELECT * FROM txe WHERE transaction_type = 'DEBITO' AND {TS} BETWEEN {END} - INTERVAL 24 HOUR AND {END})"""


def moments(table_alias: str = "") -> str:
    return ", ".join(
        f"avg({table_alias}{m}) AS {m}_mean, stddev_samp({table_alias}{m}) AS {m}_std" for m in BASELINE_METRICS
    )


def rounded_moments() -> str:
    return ", ".join(f"{r(f'{m}_mean')}, {r(f'{m}_std')}" for m in BASELINE_METRICS)


def suspicion_ctes(anchor_filter: str = "TRUE", repair: bool = False) -> str:
    z = []
    for m in WEIGHTED:
        if m in BASELINE_METRICS:
            mean = f"CASE WHEN u.user_id IS NOT NULL THEN u.{m}_mean ELSE g.{m}_mean END"
            own = f"coalesce(u.{m}_std, g.{m}_std)" if repair else f"u.{m}_std"
            std = f"(CASE WHEN u.user_id IS NOT NULL THEN {own} ELSE g.{m}_std END)"
            z.append(f"(f.{m} - ({mean})) / (CASE WHEN {std} = 0 THEN 1 ELSE {std} END) AS z_{m}")
        else:
            z.append(f"CAST(f.{m} AS DOUBLE) AS z_{m}")
    return f"""{ANCHORS}, {WINDOW}, {feature_ctes("win", "user_id", "wf")},
ub AS (SELECT user_id, {moments()} FROM af WHERE {anchor_filter} GROUP BY user_id),
gb AS (SELECT {moments()} FROM af WHERE {anchor_filter}),
zs AS (SELECT f.*, {", ".join(z)} FROM wf f LEFT JOIN ub u ON f.user_id = u.user_id CROSS JOIN gb g),
sc0 AS (
  SELECT *, (3.5 * z_cnt_24h + z_sum_24h + 1.5 * abs(z_avg_interval_minutes) * (CASE WHEN z_avg_interval_minutes < 0 THEN 1 ELSE 0.5 END)
    + z_same_amount_ratio + z_merchant_concentration - 0.3 * z_amount_cv - 0.3 * z_unique_merchants - 0.3 * z_hour_dispersion)
    * (CASE WHEN cnt_24h <= 3 THEN 0.5 ELSE 1 END) AS suspicion_score
  FROM zs),
sc AS (
  SELECT *, CASE WHEN suspicion_score IS NULL THEN NULL WHEN suspicion_score <= 1 THEN 'Bajo' WHEN suspicion_score <= 2.5 THEN 'Medio'
                 WHEN suspicion_score <= 4 THEN 'Alto' ELSE 'Crítico' END AS risk_level,
         coalesce(suspicion_score >= 4.0, FALSE) AS flag_suspicious
  FROM sc0)"""


# ---------------------------------------------------------------- descriptive


def day_counts(ctes: str, table: str) -> str:
    return f"""{ctes}, cnts AS (
  SELECT user_id, CAST({TS} AS DATE) AS date, count(*) AS cnt_24h FROM {table} GROUP BY ALL)"""


COUNTS_E = day_counts(TXE, "txe")
COUNTS_O = day_counts(TXO, "txo")


def histogram(source: str, column: str, bins: int, extra: str = "") -> str:
    """Bins found by comparing every value with every edge."""
    return f"""SELECT bin, {r(f"lo + bin * ((hi - lo) / {bins})", "bin_lo")},
  {r(f"CASE WHEN bin = {bins - 1} THEN hi ELSE lo + (bin + 1) * ((hi - lo) / {bins}) END", "bin_hi")}, n{extra} FROM (
  SELECT i AS bin, any_value(lo) AS lo, any_value(hi) AS hi,
         count(*) FILTER (v >= lo + i * ((hi - lo) / {bins}) AND (i = {bins - 1} OR v < lo + (i + 1) * ((hi - lo) / {bins}))) AS n
  FROM (SELECT CAST({column} AS DOUBLE) AS v,
               CASE WHEN min({column}) OVER () = max({column}) OVER () THEN min({column}) OVER () - 0.5 ELSE min({column}) OVER () END AS lo,
               CASE WHEN min({column}) OVER () = max({column}) OVER () THEN max({column}) OVER () + 0.5 ELSE max({column}) OVER () END AS hi
        FROM {source}) CROSS JOIN range(0, {bins}) t(i)
  GROUP BY i)"""


def profile_ctes(first: int | None = None) -> str:
    limited = f"ORDER BY high_days DESC, user_id LIMIT {first}" if first else ""

    def top(alias: str, column: str) -> str:
        return f"""{alias} AS (
  SELECT user_id, max(c) AS top FROM (
    SELECT user_id, {column}, count(*) AS c FROM px WHERE {column} IS NOT NULL GROUP BY ALL) GROUP BY user_id)"""

    return f"""{COUNTS_O}, pers AS (
  SELECT user_id, count(*) AS high_days FROM cnts WHERE cnt_24h > 3 GROUP BY user_id HAVING count(*) >= 3 {limited}),
px0 AS (SELECT *, hour({TS}) AS hh FROM txo WHERE user_id IN (SELECT user_id FROM pers)),
px1 AS (
  SELECT *, (epoch_us({TS}) - epoch_us(lag({TS}) OVER (PARTITION BY user_id ORDER BY {TS}))) / 6e7 AS gap,
         min({AMOUNT}) OVER (PARTITION BY user_id) AS lo, max({AMOUNT}) OVER (PARTITION BY user_id) AS hi,
         least(20, count(*) OVER (PARTITION BY user_id) // 2) AS bins
  FROM px0),
px AS (
  SELECT *, CASE WHEN hi = lo THEN 0 ELSE least(floor(({AMOUNT} - lo) / (hi - lo) * bins), bins - 1) END AS bin FROM px1),
{top("ph", "hh")}, {top("pb", "bin")}, {top("pm", "merchant_id")}, {top("ps", "subsidiary")},
pg AS (
  SELECT user_id, count(*) AS total_trans, count(DISTINCT CAST({TS} AS DATE)) AS dias_activos,
         CASE WHEN avg({AMOUNT}) > 0 THEN stddev_samp({AMOUNT}) / avg({AMOUNT}) ELSE 0 END AS cv_monto,
         CASE WHEN avg(gap) > 0 THEN stddev_samp(gap) / avg(gap) ELSE 0 END AS cv_intervalos,
         coalesce(quantile_cont(gap, 0.5), 0) AS mediana_intervalo_min,
         coalesce(count(*) FILTER (gap < 2) / nullif(count(gap), 0), 0) AS pct_rafagas,
         count(*) FILTER ({AMOUNT} % 10 = 0) / count(*) AS pct_montos_exactos,
         count(*) FILTER ({AMOUNT} % 5 = 0 AND {AMOUNT} % 10 <> 0) / count(*) AS pct_montos_terminan_5,
         count(DISTINCT merchant_id) AS comercios_unicos, count(DISTINCT subsidiary) AS sucursales_unicas,
         avg({AMOUNT}) AS monto_promedio, sum({AMOUNT}) AS monto_total
  FROM px GROUP BY user_id HAVING count(*) >= 5),
prof0 AS (
  SELECT g.*, h.top / total_trans AS concentracion_horaria, b.top / total_trans AS concentracion_montos,
         m.top / total_trans AS concentracion_comercio, s.top / total_trans AS concentracion_sucursal
  FROM pg g LEFT JOIN ph h USING (user_id) LEFT JOIN pb b USING (user_id) LEFT JOIN pm m USING (user_id) LEFT JOIN ps s USING (user_id)),
prof AS (
  SELECT *, CAST((CASE WHEN cv_monto < 0.2 THEN 25 ELSE 0 END + CASE WHEN concentracion_horaria > 0.3 THEN 20 ELSE 0 END
     + CASE WHEN pct_rafagas > 0.3 THEN 20 ELSE 0 END + CASE WHEN pct_montos_exactos > 0.5 THEN 15 ELSE 0 END
     + CASE WHEN comercios_unicos = 1 AND total_trans > 20 THEN 10 ELSE 0 END
     + CASE WHEN concentracion_montos > 0.4 THEN 10 ELSE 0 END) AS DOUBLE) / 100 AS score_fraccionamiento
  FROM prof0)"""


PROFILE_INTEGERS = ["total_trans", "dias_activos", "comercios_unicos", "sucursales_unicas"]
PROFILE_DOUBLES = [
    "cv_monto",
    "concentracion_horaria",
    "cv_intervalos",
    "mediana_intervalo_min",
    "pct_rafagas",
    "pct_montos_exactos",
    "pct_montos_terminan_5",
    "concentracion_montos",
    "concentracion_comercio",
    "concentracion_sucursal",
    "score_fraccionamiento",
    "monto_promedio",
    "monto_total",
]
PROFILE_OUT = f"user_id, {', '.join(PROFILE_INTEGERS)}, {', '.join(r(c) for c in PROFILE_DOUBLES)}"
INDICATORS = [
    "cv_monto",
    "concentracion_horaria",
    "pct_montos_exactos",
    "pct_rafagas",
    "concentracion_montos",
    "score_fraccionamiento",
]


def profile(select: str, first: int | None = None) -> str:
    return f"WITH {profile_ctes(first)} {select}"


# Users with one habit each that a rule looks for.
SECOND = f"(hour({TS}) * 3600 + minute({TS}) * 60 + second({TS}))"
SIXTH = " * ".join([f"({AMOUNT} / 10000)"] * 6)
PATTERNED = TXO.replace("txo AS (", "txo0 AS (") + f""", txo AS (
  SELECT * REPLACE (
    CASE user_id % 7 WHEN 0 THEN {AMOUNT} / 100000 + 100 WHEN 3 THEN floor({AMOUNT} / 10) * 10 WHEN 5 THEN {SIXTH} ELSE {AMOUNT} END AS {AMOUNT},
    CASE user_id % 7 WHEN 1 THEN date_trunc('day', {TS}) + to_seconds(36000 + {SECOND} // 24)
      WHEN 2 THEN date_trunc('day', {TS}) + to_seconds({SECOND} // 1440) ELSE {TS} END AS {TS},
    CASE WHEN user_id % 7 = 4 THEN 1 ELSE merchant_id END AS merchant_id) FROM txo0)"""


# ---------------------------------------------------------------- isolation forest


def path_length(n: str) -> str:
    return (
        f"(CASE WHEN {n} <= 1 THEN 0.0 WHEN {n} = 2 THEN 1.0 "
        f"ELSE 2.0 * (ln({n} - 1.0) + 0.5772156649015329) - 2.0 * ({n} - 1.0) / {n} END)"
    )


def forest_ctes(
    day_ctes: str, where: str, trees: int = 100, contamination: float = 0.01, scaled: bool = False
) -> str:
    """Growth and scoring unrolled over the eight levels; CTEs ``nodes``, ``al`` (alerts), ``thr``."""
    k = len(MODEL_FEATURES)
    values = ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), 0.0), 6)" for c in MODEL_FEATURES)
    lows = ", ".join(f"min(x[{i}])" for i in range(1, k + 1))
    highs = ", ".join(f"max(x[{i}])" for i in range(1, k + 1))
    means = ", ".join(f"avg(x[{i}])" for i in range(1, k + 1))
    deviations = ", ".join(f"stddev_pop(x[{i}])" for i in range(1, k + 1))
    ctes = [
        day_ctes,
        f"""act0 AS MATERIALIZED (
  SELECT * REPLACE (coalesce(avg_amount, 0.0) AS avg_amount), [{values}] AS x FROM feats WHERE cnt_24h > 3 AND {where})""",
        f"""spread AS (SELECT [{means}] AS mu, [{deviations}] AS sd FROM act0)""",
        "act AS MATERIALIZED (SELECT * REPLACE (list_transform(range(1, "
        f"{k + 1}), lambda i: (x[i] - mu[i]) / CASE WHEN sd[i] = 0 THEN 1 ELSE sd[i] END) AS x) FROM act0 CROSS JOIN spread)"
        if scaled
        else "act AS (SELECT * FROM act0)",
        "psi AS (SELECT least(256, count(*)) AS psi, ceil(log2(greatest(least(256, count(*)), 2))) AS height FROM act)",
        f"""l0 AS MATERIALIZED (
  SELECT tree, 0::BIGINT AS node, x FROM (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY substr(md5(user_id || '|' || date || '|' || tree || '|42'), 1, 15), user_id, date) AS rk
    FROM act CROSS JOIN range(0, {trees}) t(tree)) WHERE rk <= (SELECT psi FROM psi))""",
    ]
    for d in range(9):
        ctes.append(
            f"""g{d} AS (
  SELECT tree, node, count(*) AS size, [{lows}] AS lo, [{highs}] AS hi FROM l{d} GROUP BY tree, node),
u{d} AS (SELECT *, list_filter(range(1, {k + 1}), lambda i: hi[i] > lo[i]) AS usable FROM g{d}),
f{d} AS (
  SELECT *, CASE WHEN {d} >= (SELECT height FROM psi) OR len(usable) = 0 THEN NULL ELSE
    usable[1 + CAST(floor(('0x' || substr(md5('f|42|' || tree || '|' || node), 1, 8))::BIGINT / 4294967296.0 * len(usable)) AS BIGINT)] END AS feat
  FROM u{d}),
n{d} AS MATERIALIZED (
  SELECT tree, node, size, feat,
    lo[feat] + ('0x' || substr(md5('t|42|' || tree || '|' || node), 1, 8))::BIGINT / 4294967296.0 * (hi[feat] - lo[feat]) AS cut0,
    lo[feat] AS lo_f, hi[feat] AS hi_f FROM f{d})"""
        )
        if d < 8:
            ctes.append(
                f"""l{d + 1} AS MATERIALIZED (
  SELECT l.tree, CASE WHEN x[feat] <= (CASE WHEN cut0 >= hi_f THEN lo_f ELSE cut0 END) THEN 2 * l.node + 1 ELSE 2 * l.node + 2 END AS node, x
  FROM l{d} l JOIN n{d} n ON l.tree = n.tree AND l.node = n.node WHERE feat IS NOT NULL)"""
            )
    union = " UNION ALL ".join(f"SELECT *, {d} AS depth FROM n{d}" for d in range(9))
    ctes.append(
        f"""nodes AS MATERIALIZED (
  SELECT CAST(tree AS INTEGER) AS tree, node, CAST(depth AS INTEGER) AS depth, CAST(coalesce(feat - 1, -1) AS INTEGER) AS feature,
    CASE WHEN feat IS NULL THEN 0.0 WHEN cut0 >= hi_f THEN lo_f ELSE cut0 END AS threshold, size, feat IS NULL AS is_leaf FROM ({union}))"""
    )
    ctes.append(
        f"w0 AS (SELECT user_id, date, x, tree, 0::BIGINT AS node FROM act CROSS JOIN range(0, {trees}) t(tree))"
    )
    for d in range(8):
        ctes.append(
            f"""w{d + 1} AS (
  SELECT w.user_id, w.date, w.x, w.tree, CASE WHEN n.is_leaf THEN w.node WHEN w.x[n.feature + 1] <= n.threshold THEN 2 * w.node + 1 ELSE 2 * w.node + 2 END AS node
  FROM w{d} w JOIN nodes n ON w.tree = n.tree AND w.node = n.node)"""
        )
    ctes.append(
        f"""sco AS MATERIALIZED (
  SELECT w.user_id, w.date, round(-pow(2.0, -avg(n.depth + {path_length("n.size")}) / (SELECT {path_length("psi")} FROM psi)), 12) AS score
  FROM w8 w JOIN nodes n ON w.tree = n.tree AND w.node = n.node GROUP BY w.user_id, w.date),
dec AS MATERIALIZED (
  SELECT user_id, date, round(score - (SELECT quantile_cont(score, {contamination}) FROM sco), 12) AS anomaly_score FROM sco),
thr AS (SELECT date, quantile_cont(anomaly_score, {contamination}) AS threshold FROM dec GROUP BY date),
al AS (
  SELECT a.*, d.anomaly_score, d.anomaly_score < 0 AS flag_suspicious, d.anomaly_score < t.threshold AS flag_suspicious_dynamic
  FROM act a JOIN dec d ON a.user_id = d.user_id AND a.date = d.date JOIN thr t ON a.date = t.date)"""
    )
    return ",\n".join(ctes)


ALERTS_OUT = (
    f"user_id, date, cnt_24h, {r('sum_24h')}, {r('avg_amount')}, unique_merchants, {r('anomaly_score')}, "
    "flag_suspicious, flag_suspicious_dynamic"
)
DAYS_O = day_features(TXO, "txo")


def forest(select: str, where: str = "TRUE", days: str = DAYS_O, scaled: bool = False) -> str:
    return f"WITH {forest_ctes(days, where, scaled=scaled)} {select}"


# ---------------------------------------------------------------- queries


def build() -> dict[str, str]:
    found = {
        "user_day_features": user_day(TXO, "txo"),
        "user_day_features_events": user_day(TXE, "txe"),
        "user_day_features_holes": user_day(HOLES, "holes"),
        "source_union_counts": f"""WITH {TXE}, {TXR}
            SELECT 'events' AS source, count(*) AS rows FROM txe UNION ALL SELECT 'orders', count(*) FROM txr
            UNION ALL SELECT unnest(['both', 'total']), (SELECT count(*) FROM txe) + (SELECT count(*) FROM txr)""",
        "coerced_transactions": f"""WITH {TXE} SELECT _id, CAST(user_id AS VARCHAR) AS user_id,
            CASE WHEN CAST(_id AS BIGINT) % 11 <> 0 THEN {TS} END AS {TS},
            {r(f"CASE WHEN CAST(_id AS BIGINT) % 7 > 2 THEN {AMOUNT} END", AMOUNT)}, transaction_type,
            CAST(merchant_id AS VARCHAR) AS merchant_id, CAST(subsidiary AS VARCHAR) AS subsidiary FROM txe""",
        "one_day_debits": f"""WITH {TXE} SELECT * REPLACE ({r(AMOUNT)}) FROM txe
            WHERE transaction_type = 'DEBITO' AND CAST({TS} AS DATE) = DATE '2024-01-15'""",
        "calendar_parts": f"""WITH {TXE} SELECT isodow({TS}) - 1 AS weekday, hour({TS}) AS hour, count(*) AS transactions,
            max(minute({TS})) AS last_minute, min(CAST({TS} AS DATE)) AS first_day FROM txe GROUP BY 1, 2""",
        "dedup_transactions": f"WITH {TXO} SELECT * REPLACE ({r(AMOUNT)}) FROM txo",
        "dedup_within_day": f"""WITH {TXR} SELECT * REPLACE ({r(AMOUNT)}) FROM (SELECT * FROM txr
            QUALIFY row_number() OVER (PARTITION BY _id, CAST({TS} AS DATE) ORDER BY {DEDUP_ORDER}) = 1)""",
        "duplicate_rows": f"""WITH {TXR} SELECT * REPLACE ({r(AMOUNT)}) FROM (
            SELECT * FROM txr QUALIFY count(*) OVER (PARTITION BY _id) > 1)""",
        "duplicate_ids": f"WITH {TXR} SELECT _id, count(*) AS copies FROM txr GROUP BY _id HAVING count(*) > 1",
        "duplicate_count": f"""WITH {IDS}, c AS (SELECT _id, count(*) AS k FROM ids GROUP BY _id)
            SELECT CAST(sum(k) AS BIGINT) AS rows, count(*) AS ids, count(*) FILTER (k > 1) AS repeated_ids,
                   CAST(sum(k) - count(*) AS BIGINT) AS surplus_rows FROM c""",
        "null_profile": f"WITH {HOLES} "
        + " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls FROM holes"
            for c in ["_id", "user_id", TS, AMOUNT, "transaction_type", "merchant_id", "subsidiary"]
        ),
        "columns_with_nulls": f"WITH {HOLES} SELECT CAST("
        + " + ".join(
            f"CAST(count(*) > count({c}) AS INTEGER)"
            for c in ["_id", "user_id", TS, AMOUNT, "transaction_type", "merchant_id", "subsidiary"]
        )
        + " AS BIGINT) AS columns_with_nulls FROM holes",
        "sketched_cardinality": f"WITH {TXE} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(DISTINCT CAST({c} AS VARCHAR)) AS exact, TRUE AS within_5_pct FROM txe WHERE CAST({TS} AS DATE) {RANGE}"""
            for c in ["_id", "user_id", "merchant_id"]
        ),
        "text_cardinality": f"WITH {TXR} "
        + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS distinct_values,
                array_to_string(CASE WHEN count(*) <= 20 THEN list(v ORDER BY v) ELSE list(v ORDER BY v)[1:5] END, '|') AS "values"
                FROM (SELECT DISTINCT {c} AS v FROM txr WHERE {c} IS NOT NULL)"""
            for c in ["_id", "transaction_type"]
        ),
        "type_frequency": f"WITH {TXR} SELECT transaction_type, count(*) AS n FROM txr GROUP BY 1",
        "nonpositive_amounts": f"""WITH {TXR} SELECT count(*) AS rows, count(*) FILTER ({AMOUNT} - 2000 <= 0) AS nonpositive,
            {r(f"count(*) FILTER ({AMOUNT} - 2000 <= 0) * 100.0 / count(*)", "pct")} FROM txr""",
        "date_range_check": f"""WITH {TXR} SELECT min({TS}) AS first_date, max({TS}) AS last_date,
            count(*) FILTER ({TS} < DATE '1996-01-01' OR {TS} > DATE '2000-12-31') AS outside,
            {r(f"count(*) FILTER ({TS} < DATE '1996-01-01' OR {TS} > DATE '2000-12-31') * 100.0 / count(*)", "pct_outside")} FROM txr""",
        "id_length_distribution": f"""WITH {IDS} SELECT CAST(length(_id) AS INTEGER) AS length, count(*) AS ids,
            {r("count(*) * 100.0 / (SELECT count(*) FROM ids)", "pct")} FROM ids WHERE _id IS NOT NULL GROUP BY 1""",
        "id_format_check": f"""WITH {IDS} SELECT count(*) FILTER (_id IS NULL OR NOT regexp_full_match(_id, '[0-9a-f]+')) AS not_hex,
            count(*) FILTER (regexp_matches(_id, '[^0-9a-fA-F]')) AS with_special FROM ids""",
        "id_format_examples": f"""WITH {IDS} (SELECT 'not_hex' AS rule, _id FROM ids WHERE _id IS NULL OR NOT regexp_full_match(_id, '[0-9a-f]+')
            ORDER BY _id NULLS FIRST LIMIT 5) UNION ALL
            (SELECT 'with_special', _id FROM ids WHERE regexp_matches(_id, '[^0-9a-fA-F]') ORDER BY _id NULLS FIRST LIMIT 5)""",
        "amount_describe": f"""WITH {TXO} SELECT count({AMOUNT}) AS count, {r(f"avg({AMOUNT})", "mean")}, {r(f"stddev_samp({AMOUNT})", "std")},
            {r(f"min({AMOUNT})", "min")}, {r(f"quantile_cont({AMOUNT}, 0.25)", "q25")}, {r(f"quantile_cont({AMOUNT}, 0.5)", "q50")},
            {r(f"quantile_cont({AMOUNT}, 0.75)", "q75")}, {r(f"max({AMOUNT})", "max")}, count(DISTINCT {AMOUNT}) AS distinct_values FROM txo""",
        "amount_quantiles": f"WITH {TXO} SELECT "
        + ", ".join(r(f"quantile_cont({AMOUNT}, 0.{q})", f"q{q}") for q in (25, 50, 75, 90, 95, 99))
        + " FROM txo",
        "amount_bands": f"""WITH {TXE} SELECT CASE WHEN {AMOUNT} <= 100 THEN '<=100' WHEN {AMOUNT} <= 500 THEN '100-500' ELSE '>500' END AS band,
            count(*) AS transactions, {r("count(*) * 100.0 / (SELECT count(*) FROM txe)", "pct")} FROM txe WHERE {AMOUNT} IS NOT NULL GROUP BY 1""",
        "amount_bands_all": f"""WITH {TXE}, big AS (SELECT * REPLACE ({AMOUNT} * 10 AS {AMOUNT}) FROM txe) SELECT CASE WHEN {AMOUNT} <= 100 THEN '<=100' WHEN {AMOUNT} <= 500 THEN '100-500' ELSE '>500' END AS band,
            count(*) AS transactions, {r("count(*) * 100.0 / (SELECT count(*) FROM big)", "pct")} FROM big WHERE {AMOUNT} IS NOT NULL GROUP BY 1""",
        "amount_histogram": f"WITH {TXO} {histogram('txo', AMOUNT, 50)}",
        "user_day_counts": f"WITH {COUNTS_E} SELECT * FROM cnts",
        "user_day_summary": f"""WITH {COUNTS_E} SELECT count(*) AS cases, count(DISTINCT user_id) AS users, count(DISTINCT date) AS days,
            CAST(sum(cnt_24h) AS BIGINT) AS transactions, {r("avg(cnt_24h)", "mean_per_day")},
            {r("quantile_cont(CAST(cnt_24h AS DOUBLE), 0.5)", "median_per_day")}, max(cnt_24h) AS max_per_day FROM cnts""",
        "activity_bands": f"""WITH {COUNTS_E}, b AS (SELECT CASE WHEN cnt_24h = 1 THEN '1' WHEN cnt_24h <= 5 THEN '2-5' WHEN cnt_24h <= 10 THEN '6-10'
            WHEN cnt_24h <= 20 THEN '11-20' WHEN cnt_24h <= 50 THEN '21-50' WHEN cnt_24h <= 100 THEN '51-100' ELSE '>100' END AS band FROM cnts)
            SELECT band, count(*) AS cases, {r("count(*) * 100.0 / (SELECT count(*) FROM b)", "pct")},
            {r("CASE WHEN band <> '1' THEN count(*) * 100.0 / (SELECT count(*) FROM b WHERE band <> '1') END", "pct_of_active")} FROM b GROUP BY band""",
        "activity_thresholds": f"""WITH {COUNTS_E} SELECT count(*) AS cases, count(*) FILTER (cnt_24h = 1) AS one, count(*) FILTER (cnt_24h > 1) AS over_1,
            count(*) FILTER (cnt_24h BETWEEN 2 AND 5) AS from_2_to_5, count(*) FILTER (cnt_24h BETWEEN 6 AND 10) AS from_6_to_10,
            count(*) FILTER (cnt_24h > 10) AS over_10, count(*) FILTER (cnt_24h > 100) AS over_100,
            {r("count(*) FILTER (cnt_24h = 1) * 100.0 / count(*)", "pct_one")}, {r("count(*) FILTER (cnt_24h > 1) * 100.0 / count(*)", "pct_over_1")} FROM cnts""",
        "activity_bands_all": f"""WITH {COUNTS_E}, spread AS (SELECT * REPLACE (CASE WHEN cnt_24h <= 5 THEN cnt_24h * cnt_24h WHEN cnt_24h = 6 THEN 64 ELSE cnt_24h * cnt_24h * cnt_24h END AS cnt_24h) FROM cnts), b AS (SELECT CASE WHEN cnt_24h = 1 THEN '1' WHEN cnt_24h <= 5 THEN '2-5' WHEN cnt_24h <= 10 THEN '6-10'
            WHEN cnt_24h <= 20 THEN '11-20' WHEN cnt_24h <= 50 THEN '21-50' WHEN cnt_24h <= 100 THEN '51-100' ELSE '>100' END AS band FROM spread)
            SELECT band, count(*) AS cases, {r("count(*) * 100.0 / (SELECT count(*) FROM b)", "pct")},
            {r("CASE WHEN band <> '1' THEN count(*) * 100.0 / (SELECT count(*) FROM b WHERE band <> '1') END", "pct_of_active")} FROM b GROUP BY band""",
        "activity_thresholds_all": f"""WITH {COUNTS_E}, spread AS (SELECT * REPLACE (CASE WHEN cnt_24h <= 5 THEN cnt_24h * cnt_24h WHEN cnt_24h = 6 THEN 64 ELSE cnt_24h * cnt_24h * cnt_24h END AS cnt_24h) FROM cnts) SELECT count(*) AS cases, count(*) FILTER (cnt_24h = 1) AS one, count(*) FILTER (cnt_24h > 1) AS over_1,
            count(*) FILTER (cnt_24h BETWEEN 2 AND 5) AS from_2_to_5, count(*) FILTER (cnt_24h BETWEEN 6 AND 10) AS from_6_to_10,
            count(*) FILTER (cnt_24h > 10) AS over_10, count(*) FILTER (cnt_24h > 100) AS over_100,
            {r("count(*) FILTER (cnt_24h = 1) * 100.0 / count(*)", "pct_one")}, {r("count(*) FILTER (cnt_24h > 1) * 100.0 / count(*)", "pct_over_1")} FROM spread""",
        "count_histograms": f"WITH {COUNTS_O} "
        + " UNION ALL ".join(
            f"SELECT *, '{name}' AS part FROM ({histogram(f'(SELECT * FROM cnts WHERE {cond})', 'cnt_24h', bins)})"
            for name, cond, bins in [
                ("all", "TRUE", 50),
                ("active", "cnt_24h > 1", 30),
                ("middle", "cnt_24h BETWEEN 2 AND 20", 19),
                ("extreme", "cnt_24h > 5", 20),
            ]
        ),
        "recurrent_users": f"""WITH {COUNTS_E} SELECT count(*) AS recurrent_users FROM (
            SELECT user_id FROM cnts WHERE cnt_24h > 1 GROUP BY user_id HAVING count(*) > 5)""",
        "top_user_days": f"WITH {COUNTS_O} SELECT * FROM cnts WHERE cnt_24h > 3 ORDER BY cnt_24h DESC, user_id, date LIMIT 3",
        "consistent_users": f"""WITH {COUNTS_O} SELECT user_id, count(*) AS active_days, max(cnt_24h) AS max_per_day, {r("avg(cnt_24h)", "mean_per_day")}
            FROM cnts WHERE cnt_24h > 1 GROUP BY user_id ORDER BY active_days DESC, user_id LIMIT 5""",
        "persistent_users": f"""WITH {COUNTS_O} SELECT user_id, count(*) AS high_days FROM cnts WHERE cnt_24h > 3
            GROUP BY user_id HAVING count(*) >= 3""",
        "persistent_first100": f"""WITH {COUNTS_O} SELECT user_id, count(*) AS high_days FROM cnts WHERE cnt_24h > 3
            GROUP BY user_id HAVING count(*) >= 3 ORDER BY high_days DESC, user_id LIMIT 100""",
        "normal_users": f"""WITH {COUNTS_O} SELECT user_id, {r(f"avg({AMOUNT})", "amount_mean")}, {r(f"stddev_samp({AMOUNT})", "amount_std")},
            count({AMOUNT}) AS tx_count, {r(f"stddev_samp({AMOUNT}) / avg({AMOUNT})", "amount_cv")} FROM txo
            WHERE user_id NOT IN (SELECT user_id FROM cnts WHERE cnt_24h > 3) GROUP BY user_id HAVING count({AMOUNT}) >= 5""",
        "normal_vs_active_cv": profile(
            f"""SELECT {r("avg(cv_monto)", "active_cv")}, {r(f'''(SELECT avg(cv) FROM (
                SELECT stddev_samp({AMOUNT}) / avg({AMOUNT}) AS cv FROM txo WHERE user_id NOT IN (SELECT user_id FROM cnts WHERE cnt_24h > 3)
                GROUP BY user_id HAVING count({AMOUNT}) >= 5))''', "normal_cv")} FROM prof"""
        ),
        "structuring_profile": profile(f"SELECT {PROFILE_OUT} FROM prof"),
        "structuring_rules": profile(f"SELECT {PROFILE_OUT} FROM prof").replace(TXO, PATTERNED),
        "structuring_profile_first100": profile(f"SELECT {PROFILE_OUT} FROM prof", first=100),
        "structuring_top5": profile(
            f"SELECT {PROFILE_OUT} FROM (SELECT * FROM prof ORDER BY score_fraccionamiento DESC, user_id LIMIT 5)"
        ),
        "structuring_critical": profile(f"SELECT {PROFILE_OUT} FROM prof WHERE prof.score_fraccionamiento > 0.05"),
        "indicator_shares": profile(
            "SELECT count(*) AS users, "
            + ", ".join(
                f"count(*) FILTER ({cond}) AS n_{name}, {r(f'count(*) FILTER ({cond}) * 100.0 / count(*)', f'pct_{name}')}"
                for name, cond in [
                    ("low_cv", "cv_monto < 0.2"),
                    ("hour_concentrated", "concentracion_horaria > 0.3"),
                    ("round_amounts", "pct_montos_exactos > 0.5"),
                    ("bursts", "pct_rafagas > 0.3"),
                    ("single_merchant", "comercios_unicos = 1"),
                    ("critical", "score_fraccionamiento > 0.5"),
                ]
            )
            + ", "
            + ", ".join(r(f"avg({c})", f"mean_{c}") for c in ("cv_monto", "concentracion_horaria", "pct_montos_exactos"))
            + " FROM prof"
        ),
        "indicator_medians": profile(
            " UNION ALL ".join(
                f"SELECT '{c}' AS indicator, {r(f'quantile_cont({c}, 0.5)', 'median')} FROM prof" for c in INDICATORS
            )
        ),
        "profile_histograms": profile(
            " UNION ALL ".join(
                f"SELECT *, '{c}' AS indicator FROM ({histogram(source, c, 25)})"
                for c, source in [
                    *[(c, "prof") for c in INDICATORS],
                    ("mediana_intervalo_min", "(SELECT * FROM prof WHERE mediana_intervalo_min < 1440)"),
                ]
            )
        ),
        "merchant_histogram": profile(
            """SELECT i AS bin, count(p.user_id) AS n FROM range(1, (SELECT max(comercios_unicos) + 1 FROM prof)) t(i)
               LEFT JOIN prof p ON p.comercios_unicos = i GROUP BY i"""
        ),
        "short_gap_profiles": profile(f"SELECT {PROFILE_OUT} FROM prof WHERE prof.mediana_intervalo_min < 300"),
        "profile_scatter": profile(
            f"SELECT user_id, {r('cv_monto')}, {r('concentracion_horaria')}, {r('score_fraccionamiento')} FROM prof"
        ),
        "sliding_24h_features": f"WITH {TXE}, {WINDOW}, {feature_ctes('win', 'user_id')} SELECT user_id, {outputs(SLIDING_FEATURES)} FROM feats",
        "daily_sliding_features": f"""WITH {TXE}, {HISTORY}, {anchored(1, 1)}, {feature_ctes("anch", "user_id, analysis_date")}
            SELECT user_id, analysis_date, {outputs(SLIDING_FEATURES)} FROM feats""",
        "rolling_24h": rolling(AMOUNT),
        "rolling_24h_large": rolling(f"CASE WHEN CAST(_id AS BIGINT) % 50 = 0 THEN 1e16 ELSE {AMOUNT} END"),
        "anchor_features": f"WITH {ANCHORS} SELECT user_id, analysis_date, {outputs(ANCHOR_FEATURES)} FROM af",
        "top_merchant": f"""WITH {TXE}, {HISTORY}, {anchored(3)}
            SELECT * FROM (SELECT user_id, analysis_date, merchant_id AS top_merchant, count(*) AS tx_count FROM anch WHERE merchant_id IS NOT NULL
            GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id, analysis_date ORDER BY tx_count DESC, top_merchant) = 1""",
        "user_baseline": f"""WITH {ANCHORS}, b AS (SELECT user_id, {moments()} FROM af GROUP BY user_id)
            SELECT user_id, {rounded_moments()} FROM b""",
        "global_baseline": f"WITH {ANCHORS}, b AS (SELECT {moments()} FROM af) SELECT {rounded_moments()} FROM b",
        "fallback_baseline": f"""WITH {TXE}, {HISTORY}, u AS (
            SELECT user_id, count({AMOUNT}) AS cnt_24h, sum({AMOUNT}) AS sum_24h, avg({AMOUNT}) AS avg_amount FROM hist GROUP BY user_id) SELECT """
        + ", ".join(
            f"{r(f'avg({m})', f'{m}_mean')}, {r(f'stddev_samp({m})', f'{m}_std')}" for m in ("cnt_24h", "sum_24h", "avg_amount")
        )
        + " FROM u",
        "z_scores": f"WITH {suspicion_ctes()} SELECT user_id, {', '.join(r(f'z_{m}') for m in WEIGHTED)} FROM sc",
        "suspicion_scores": f"WITH {suspicion_ctes()} SELECT user_id, {r('suspicion_score')}, risk_level, flag_suspicious FROM sc",
        "suspicion_repaired": f"""WITH {suspicion_ctes(f"analysis_date < {END}", repair=True)}
            SELECT user_id, {r("suspicion_score")}, risk_level, flag_suspicious FROM sc""",
        "risk_distribution": f"WITH {suspicion_ctes()} SELECT risk_level, count(*) AS users FROM sc WHERE risk_level IS NOT NULL GROUP BY 1",
        "detection_rate": f"""WITH {suspicion_ctes()} SELECT count(*) AS users, count(*) FILTER (flag_suspicious) AS alerts,
            {r("count(*) FILTER (flag_suspicious) * 100.0 / count(*)", "detection_pct")}, {r("max(suspicion_score)", "max_score")} FROM sc""",
        "suspicion_alerts": f"""WITH {suspicion_ctes()} SELECT user_id, {r("suspicion_score")}, risk_level,
            CASE WHEN sc.suspicion_score <= 5 THEN 'Media' WHEN sc.suspicion_score <= 8 THEN 'Alta' ELSE 'Crítica' END AS investigation_priority
            FROM sc WHERE flag_suspicious""",
        "suspicion_top10": f"""WITH {suspicion_ctes()} SELECT user_id, {r("suspicion_score")}, risk_level, cnt_24h, {r("sum_24h")},
            {r("avg_interval_minutes")}, {r("same_amount_ratio")}, unique_merchants
            FROM (SELECT * FROM sc WHERE flag_suspicious ORDER BY suspicion_score DESC, user_id LIMIT 10)""",
        "z_importance": f"WITH {suspicion_ctes()} "
        + " UNION ALL ".join(f"SELECT '{m}' AS metric, {r(f'avg(abs(z_{m}))', 'mean_abs_z')} FROM sc" for m in WEIGHTED),
        "score_scatter": f"WITH {suspicion_ctes()} SELECT user_id, cnt_24h, {r('suspicion_score')} FROM sc",
        "score_histogram": f"WITH {suspicion_ctes()} {histogram('sc', 'suspicion_score', 30)}",
        "daily_coverage": f"""WITH {TXO}, d AS (SELECT unnest(generate_series(
              (SELECT min(CAST({TS} AS DATE)) FROM txo), (SELECT max(CAST({TS} AS DATE)) FROM txo), INTERVAL 1 DAY))::DATE AS date)
            SELECT d.date, count(t._id) AS transactions FROM d LEFT JOIN txo t ON CAST(t.{TS} AS DATE) = d.date GROUP BY d.date""",
        "features_in_range": user_day(TXE, "txe", f"date {RANGE}"),
        "features_one_day": user_day(TXE, "txe", "date = DATE '2024-01-10'"),
        "features_quiet_day": user_day(TXE, "txe", f"date {RANGE} AND date <> DATE '2024-01-10'"),
        "active_users": f"WITH {DAYS_O} SELECT count(DISTINCT user_id) AS users FROM feats WHERE cnt_24h > 3",
        "forest_nodes": forest(f"SELECT tree, node, depth, feature, {r('threshold')}, size, is_leaf FROM nodes"),
        "forest_scores": forest(f"SELECT {ALERTS_OUT} FROM al"),
        "forest_scaled_scores": forest(f"SELECT {ALERTS_OUT} FROM al", scaled=True),
        "forest_day_thresholds": forest(f"SELECT date, {r('threshold')} FROM thr"),
        "forest_score_stats": forest(
            f"""SELECT count(*) AS n, {r("avg(anomaly_score)", "mean")}, {r("stddev_samp(anomaly_score)", "std")}, {r("min(anomaly_score)", "min")},
            {r("max(anomaly_score)", "max")}, count(*) FILTER (anomaly_score < 0) AS anomalies,
            {r("count(*) FILTER (anomaly_score < 0) * 100.0 / count(*)", "anomaly_pct")}, """
            + ", ".join(r(f"quantile_cont(anomaly_score, 0.{q})", f"p{q}") for q in ("01", "05", "25", "50", "75", "95", "99"))
            + " FROM dec"
        ),
        "forest_flag_totals": forest(
            """SELECT count(*) AS scored, count(*) FILTER (flag_suspicious) AS static_flags,
               count(*) FILTER (flag_suspicious_dynamic) AS dynamic_flags FROM al"""
        ),
        "flagged_alerts": forest(f"SELECT {ALERTS_OUT} FROM al WHERE flag_suspicious OR flag_suspicious_dynamic"),
        "forest_top10": forest(f"SELECT {ALERTS_OUT} FROM (SELECT * FROM al ORDER BY anomaly_score, user_id, date LIMIT 10)"),
        "backfilled_alerts": forest(f"SELECT {ALERTS_OUT} FROM al", f"date {RANGE}", day_features(TXE, "txe")),
        "stream_24h_counts_batches": f"""WITH {TXE}, deb AS (SELECT * FROM txe WHERE transaction_type = 'DEBITO'), w AS (
              SELECT user_id, date_trunc('hour', {TS}) - i * INTERVAL 1 HOUR AS window_start, {AMOUNT} FROM deb CROSS JOIN range(0, 24) t(i))
            SELECT user_id, window_start, count({AMOUNT}) AS cnt_24h, {r(f"sum({AMOUNT})", "sum_24h")} FROM w GROUP BY user_id, window_start""",
        "stream_day_alerts_batches": f"""WITH {TXE} SELECT user_id, CAST({TS} AS DATE) AS date, count({AMOUNT}) AS cnt_24h,
              CASE WHEN count({AMOUNT}) > 5 THEN 'Alta' ELSE 'Media' END AS alert FROM txe WHERE transaction_type = 'DEBITO'
            GROUP BY 1, 2 HAVING count({AMOUNT}) > 3""",
        "stream_24h_merchants": f"""WITH {TXE}, deb AS (SELECT * FROM txe WHERE transaction_type = 'DEBITO'), w AS (
              SELECT user_id, date_trunc('hour', {TS}) - i * INTERVAL 1 HOUR AS window_start, {AMOUNT}, merchant_id FROM deb CROSS JOIN range(0, 24) t(i))
            SELECT user_id, window_start, count({AMOUNT}) AS cnt_24h, {r(f"sum({AMOUNT})", "sum_24h")}, count(DISTINCT merchant_id) AS merchants
            FROM w GROUP BY user_id, window_start""",
        "stream_distinct_ids": "SELECT DISTINCT l_orderkey || '-' || l_linenumber AS _id FROM lineitem",
        "stream_model_alerts": forest(f"SELECT {ALERTS_OUT} FROM al", days=day_features(TXE, "txe")),
    }
    # The same results by another way: hot keys, several micro-batches, a model without contamination.
    same = {
        "dedup_in_batches": "dedup_transactions",
        "user_day_features_hot": "user_day_features_events",
        "anchor_features_hot": "anchor_features",
        "structuring_profile_hot": "structuring_profile",
        "rolling_24h_hot": "rolling_24h",
        "rolling_24h_large_hot": "rolling_24h_large",
        "forest_default_contamination": "forest_scores",
        "stream_24h_counts": "stream_24h_counts_batches",
        "stream_day_alerts": "stream_day_alerts_batches",
        "stream_24h_merchants_batches": "stream_24h_merchants",
        "stream_distinct_ids_batches": "stream_distinct_ids",
        "stream_model_alerts_batches": "stream_model_alerts",
    }
    found["coerced_formats"] = f"WITH {TXE} SELECT * REPLACE ({r(AMOUNT)}) FROM txe"
    return found | {name: found[other] for name, other in same.items()}
