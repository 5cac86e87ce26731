"""DuckDB reference SQL for the query catalogue.

Written independently of the Spark operators: plain per-battery windows, a
self-join for the Savitzky-Golay smoothing and for sequences, ``NULLIF``
where Spark uses ``try_divide``.  Literals are written ``1e0`` (a bare ``0.7``
is DECIMAL in SQL) and float outputs are rounded to 6 places on both sides.
Tables ``events`` etc. are views registered by the caller.
"""

from __future__ import annotations

from cellhealth import schema as S

R = 6  # rounding of float outputs


def r(expr: str) -> str:
    """Same bits as ``round6`` on the Spark side."""
    return f"(floor(({expr}) * 1000000e0 + 0.5e0) / 1000000e0)"


TELEMETRY = """
tele AS (
  SELECT 'hdfs://lake/battery_data/' ||
         CASE (user_id // 3) % 3 WHEN 0 THEN 'regular' WHEN 1 THEN 'recommissioned'
              ELSE 'second_life' END ||
         '/battery' || lpad(CAST(user_id // 3 AS VARCHAR), 4, '0') || '.csv' AS file_path,
         CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS DOUBLE)
           / 30000000e0 AS time,
         CASE event_type WHEN 'error' THEN 'n/a' WHEN 'signup' THEN '1' ELSE '-1' END AS mode,
         CASE WHEN event_id % 97 = 0 THEN NULL ELSE 4.2e0 - value / 500e0 END AS voltage_load,
         1e0 + (event_id % 7) / 10e0 AS current_load,
         20e0 + CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 10e0
           AS temperature_battery
  FROM events)"""

IDENT = """
ident AS (
  SELECT *, regexp_extract(file_path, '([^/]+)\\.csv', 1) AS battery_id,
         regexp_extract(file_path, 'battery_data/([^/]+)/', 1) AS battery_type
  FROM tele)"""


def _complete(cols: list[str], doubles: set[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"{c} IS NOT NULL")
        if c in doubles:
            parts.append(f"NOT isnan({c})")
    return " AND ".join(parts)


_RAW_D = set(S.RAW_NUMERIC)
LIGHT = f"""
coerced AS (
  SELECT file_path, battery_id, battery_type,
         TRY_CAST(time AS DOUBLE) AS time, TRY_CAST(mode AS DOUBLE) AS mode,
         TRY_CAST(voltage_load AS DOUBLE) AS voltage_load,
         TRY_CAST(current_load AS DOUBLE) AS current_load,
         TRY_CAST(temperature_battery AS DOUBLE) AS temperature_battery
  FROM ident),
light AS (
  SELECT battery_id, battery_type, time, voltage_load, current_load, temperature_battery
  FROM coerced
  WHERE mode = -1e0 AND {_complete(['file_path', 'battery_id', 'battery_type'] + S.RAW_NUMERIC,
                                     _RAW_D)})"""

CYC = """
cyc AS (
  SELECT battery_id, battery_type, TRY_CAST(trunc(time / 1000e0) AS INTEGER) AS cycle,
         avg(voltage_load) AS avg_voltage, min(voltage_load) AS min_voltage,
         avg(current_load) AS avg_current, max(temperature_battery) AS max_temp,
         max(time) - min(time) AS duration
  FROM light GROUP BY ALL)"""

RULSOH = """
rs AS (
  SELECT *, max_cycle - cycle AS RUL,
         1e0 - CAST(cycle AS DOUBLE) / CAST(NULLIF(max_cycle, 0) AS DOUBLE) AS SoH
  FROM (SELECT *, max(cycle) OVER (PARTITION BY battery_id) AS max_cycle
        FROM cyc WHERE cycle IS NOT NULL))"""

_FIN_D = {c for c in S.FINAL_COLUMNS if c not in
          ("battery_id", "battery_type", "cycle", "max_cycle", "RUL")}
FIN = f"""
lagged AS (
  SELECT *, lag(avg_voltage) OVER w AS prev_voltage, lag(max_temp) OVER w AS prev_temp
  FROM rs WINDOW w AS (PARTITION BY battery_id ORDER BY cycle, battery_type)),
fin AS (
  SELECT {', '.join(c for c in S.FINAL_COLUMNS if c not in ('voltage_drop', 'temp_change',
                                                             'cycle_ratio'))},
         avg_voltage - prev_voltage AS voltage_drop, max_temp - prev_temp AS temp_change,
         CAST(cycle AS DOUBLE) / CAST(NULLIF(max_cycle, 0) AS DOUBLE) AS cycle_ratio
  FROM lagged),
final AS (
  SELECT {', '.join(S.FINAL_COLUMNS)} FROM fin WHERE {_complete(S.FINAL_COLUMNS, _FIN_D)})"""

POS = """
tg AS (
  SELECT *, remaining_cycles / NULLIF(max_cycle, 0) AS rul_ratio,
         CAST(cycle AS DOUBLE) / NULLIF(max_cycle, 0) AS cycle_norm
  FROM (SELECT *, (1e0 - cycle_ratio) * max_cycle AS remaining_cycles FROM final)),
pos AS (
  SELECT *,
         row_number() OVER w AS cycle_index,
         count(*) OVER (PARTITION BY battery_id) AS n_cycles,
         sum(voltage_drop) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
           AS cumul_voltage_drop,
         (rank() OVER (PARTITION BY battery_id ORDER BY cycle)
          + (count(*) OVER (PARTITION BY battery_id, cycle) - 1) / 2e0)
           / count(*) OVER (PARTITION BY battery_id) AS cycle_rank
  FROM tg WINDOW w AS (PARTITION BY battery_id ORDER BY cycle, battery_type))"""


def _rolling_cols() -> str:
    out = []
    for f in S.PHYSICAL_FEATURES:
        out.append(f"avg({f}) OVER rw AS {f}_mean")
        out.append(f"coalesce(stddev_samp({f}) OVER rw, 0e0) AS {f}_std")
    return ",\n         ".join(out)


# Savitzky-Golay by self-join: row i takes v[c-5..c+5] with weights w(t, k).
FEAT = f"""
roll AS (
  SELECT *, {_rolling_cols()}
  FROM pos
  WINDOW rw AS (PARTITION BY battery_id ORDER BY cycle_index
                ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)),
sg_c AS (
  SELECT battery_id, cycle_index, n_cycles,
         least(greatest(cycle_index - 1, 5), n_cycles - 6) AS c,
         CAST(cycle_index - 1 - least(greatest(cycle_index - 1, 5), n_cycles - 6) AS DOUBLE) AS t
  FROM pos WHERE n_cycles >= 11),
sg AS (
  SELECT a.battery_id, a.cycle_index,
         sum(b.SoH * (1e0 / 11e0 + a.t * (b.cycle_index - 1 - a.c) / 110e0
             + ((b.cycle_index - 1 - a.c) * (b.cycle_index - 1 - a.c) - 10e0)
               * (a.t * a.t - 10e0) / 858e0)) AS sm
  FROM sg_c a JOIN pos b
    ON a.battery_id = b.battery_id
   AND b.cycle_index - 1 BETWEEN a.c - 5 AND a.c + 5
  GROUP BY a.battery_id, a.cycle_index),
feat AS (
  SELECT roll.*,
         CASE WHEN roll.n_cycles >= 11 THEN least(greatest(sg.sm, 0e0), 1e0)
              ELSE roll.SoH END AS SoH_smoothed
  FROM roll LEFT JOIN sg USING (battery_id, cycle_index))"""

CHAIN = {
    "tele": [TELEMETRY],
    "ident": [TELEMETRY, IDENT],
    "light": [TELEMETRY, IDENT, LIGHT],
    "cyc": [TELEMETRY, IDENT, LIGHT, CYC],
    "rs": [TELEMETRY, IDENT, LIGHT, CYC, RULSOH],
    "final": [TELEMETRY, IDENT, LIGHT, CYC, RULSOH, FIN],
    "pos": [TELEMETRY, IDENT, LIGHT, CYC, RULSOH, FIN, POS],
    "feat": [TELEMETRY, IDENT, LIGHT, CYC, RULSOH, FIN, POS, FEAT],
}


def with_ctes(upto: str, body: str, extra: list[str] | None = None) -> str:
    parts = CHAIN[upto] + (extra or [])
    return "WITH " + ",".join(p.strip("\n") for p in parts) + "\n" + body


# -- per-query SQL ----------------------------------------------------------

_KEYS = "battery_id, battery_type, cycle"


def _cols(cols: list[str], doubles: set[str] | None = None) -> str:
    doubles = doubles if doubles is not None else set(cols)
    return ", ".join(r(c) + f" AS {c}" if c in doubles else c for c in cols)


_ROLL = [c for c in S.FEATURES_30 if c not in S.PHYSICAL_FEATURES]

SQL: dict[str, str] = {
    "q01_identity": with_ctes(
        "ident", f"SELECT file_path, battery_id, battery_type, {r('time')} AS time FROM ident"),
    "q02_discharge_light": with_ctes(
        "light", f"SELECT battery_id, battery_type, "
                 f"{_cols(['time', 'voltage_load', 'current_load', 'temperature_battery'])} "
                 f"FROM light"),
    "q03_cycle_aggregate": with_ctes(
        "cyc", f"SELECT {_KEYS}, "
               f"{_cols(['avg_voltage', 'min_voltage', 'avg_current', 'max_temp', 'duration'])}"
               f" FROM cyc"),
    "q04_rul_soh": with_ctes(
        "rs", f"SELECT {_KEYS}, "
              f"{_cols(['avg_voltage', 'min_voltage', 'avg_current', 'max_temp', 'duration'])},"
              f" max_cycle, RUL, {r('SoH')} AS SoH FROM rs"),
    "q06_final_dataset": with_ctes(
        "final", f"SELECT {_cols(S.FINAL_COLUMNS, _FIN_D)} FROM final"),
    "q07_targets": with_ctes(
        "pos", f"SELECT {_KEYS}, {_cols(['remaining_cycles', 'rul_ratio', 'cycle_norm'])} "
               f"FROM tg"),
    "q08_cumulative_drop": with_ctes(
        "pos", f"SELECT {_KEYS}, cycle_index, n_cycles, "
               f"{r('cumul_voltage_drop')} AS cumul_voltage_drop FROM pos"),
    "q09_cycle_rank": with_ctes(
        "pos", f"SELECT {_KEYS}, {r('cycle_rank')} AS cycle_rank FROM pos"),
    "q10_rolling_features": with_ctes(
        "feat", f"SELECT {_KEYS}, {_cols(_ROLL)} FROM feat"),
    "q11_savgol_soh": with_ctes(
        "feat", f"SELECT {_KEYS}, {r('SoH')} AS SoH, {r('SoH_smoothed')} AS SoH_smoothed "
                f"FROM feat"),
}
SQL["q05_rul_soh_join_form"] = SQL["q04_rul_soh"]


# -- split, scaling, sequences, baseline forecasts ---------------------------

ASG = """
bats AS (SELECT DISTINCT battery_type, battery_id FROM feat),
ordb AS (
  SELECT *, row_number() OVER (PARTITION BY battery_type
                               ORDER BY md5(concat_ws('-', battery_id, '42')), battery_id) - 1 AS p,
         count(*) OVER (PARTITION BY battery_type) AS n
  FROM bats),
sz AS (SELECT *, greatest(1, CAST(floor(n * 0.7e0) AS BIGINT)) AS a0,
              greatest(1, CAST(floor(n * 0.2e0) AS BIGINT)) AS nv FROM ordb),
sz2 AS (SELECT *, greatest(1, n - a0 - nv) AS nt FROM sz),
sz3 AS (SELECT *, CASE WHEN a0 + nv + nt > n THEN a0 - 1 ELSE a0 END AS na FROM sz2),
asg AS (
  SELECT battery_type, battery_id,
         CASE WHEN p < na THEN 'train' WHEN p < na + nv THEN 'val'
              WHEN p < na + nv + nt THEN 'test' END AS split
  FROM sz3),
tagged AS (
  SELECT feat.*, s.split FROM feat JOIN (SELECT DISTINCT battery_id, split FROM asg) s
  USING (battery_id))"""

_SCALED = S.FEATURES_30 + [S.RUL_TARGET]
STATS = ("\nstats AS (SELECT "
         + ", ".join(f"min({c}) AS {c}__min, max({c}) AS {c}__max" for c in _SCALED)
         + " FROM tagged WHERE split = 'train')")


def _rng(c: str) -> str:
    return (f"(CASE WHEN {c}__max - {c}__min < {10 * 2.220446049250313e-16!r} THEN 1e0 "
            f"ELSE {c}__max - {c}__min END)")


BASE = """
base AS (
  SELECT *, avg(SoH_smoothed) OVER bw AS SoH_smoothed_window_mean,
         avg(rul_ratio) OVER bw AS rul_ratio_window_mean
  FROM tagged
  WINDOW bw AS (PARTITION BY battery_id ORDER BY cycle_index
                ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)),
scored AS (
  SELECT *, SoH_smoothed_window_mean AS predicted_SoH,
         rul_ratio * max_cycle AS actual_rul_cycles,
         greatest(rul_ratio_window_mean, 0e0) * max_cycle AS predicted_rul_cycles
  FROM base WHERE cycle_index > 20),
test AS (SELECT * FROM scored WHERE split = 'test')"""

SEQ = f"""
seqw AS (
  SELECT a.battery_id, a.battery_type, a.cycle AS target_cycle,
         b.cycle_index - a.cycle_index + 20 AS pos,
         {', '.join('CAST(b.cycle AS DOUBLE) AS cycle' if c == 'cycle' else 'b.' + c
                    for c in S.FEATURES_30)}
  FROM feat a JOIN feat b
    ON a.battery_id = b.battery_id
   AND b.cycle_index BETWEEN a.cycle_index - 20 AND a.cycle_index - 1
  WHERE a.cycle_index > 20)"""

CHAIN["tagged"] = CHAIN["feat"] + [ASG]
CHAIN["stats"] = CHAIN["tagged"] + [STATS]
CHAIN["scored"] = CHAIN["tagged"] + [BASE]
CHAIN["seq"] = CHAIN["feat"] + [SEQ]


def _corr_sql(cols: list[str]) -> str:
    aggs = [f"stddev_pop({c}) AS sd{i}" for i, c in enumerate(cols)]
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            aggs.append(f"covar_pop({cols[i]}, {cols[j]}) AS cv{i}_{j}")
    sel = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            lo, hi = min(i, j), max(i, j)
            sel.append(f"SELECT '{a}' AS row_feature, '{b}' AS col_feature, "
                       f"{r(f'cv{lo}_{hi} / NULLIF(sd{i} * sd{j}, 0e0)')} AS r FROM m")
    return with_ctes("feat", "\nUNION ALL ".join(sel),
                     [f"\nm AS (SELECT {', '.join(aggs)} FROM feat)"])


def _metrics(y: str, yhat: str, scale: str, names: tuple[str, str, str]) -> str:
    return with_ctes("scored", f"""
SELECT {r(f'sqrt(avg(({yhat} - {y}) * ({yhat} - {y}))) * {scale}')} AS {names[0]},
       {r(f'avg(abs({yhat} - {y})) * {scale}')} AS {names[1]},
       {r(f'''CASE WHEN var_pop({y}) * count({y}) = 0 THEN
                   CASE WHEN sum(({yhat} - {y}) * ({yhat} - {y})) = 0 THEN 1e0 ELSE 0e0 END
                 ELSE 1e0 - sum(({yhat} - {y}) * ({yhat} - {y})) / (var_pop({y}) * count({y}))
            END''')} AS {names[2]}
FROM test""")


def _huber(e: str, d: float) -> str:
    return (f"(CASE WHEN abs({e}) <= {d!r}e0 THEN 0.5e0 * ({e}) * ({e}) "
            f"ELSE {d!r}e0 * (abs({e}) - {0.5 * d!r}e0) END)")


_R_MIN, _R_MAX = "rul_ratio__min", "rul_ratio__max"
_RR = _rng("rul_ratio")

READINGS = """
rq AS (
  SELECT event_id AS request_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE 4.2e0 - value / 500e0 END AS avg_voltage,
         4.1e0 - value / 400e0 AS min_voltage,
         CASE WHEN event_id % 13 = 0 THEN NULL ELSE 1e0 + (event_id % 7) / 10e0 END
           AS avg_current,
         value * 2e0 AS duration,
         -value / 10000e0 AS voltage_drop,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 100e0 - 0.5e0 AS temp_change,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE CAST(event_id % 90 AS DOUBLE) END AS cycle,
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE (event_id % 100) / 100e0 END AS cycle_rank
  FROM events),
rq_ok AS (
  SELECT * FROM rq WHERE """ + " AND ".join(f"{c} IS NOT NULL"
                                            for c in S.REQUIRED_READING_FIELDS) + """),
cs AS (
  SELECT request_id, avg_voltage, min_voltage, avg_current, duration, voltage_drop,
         temp_change, coalesce(cycle, 1e0) AS cycle,
         coalesce(cycle, 1e0) * voltage_drop AS cumul_voltage_drop,
         coalesce(cycle_rank, 0.5e0) AS cycle_rank
  FROM rq_ok)"""
CHAIN["readings"] = [READINGS]


def _cs_cols() -> list[str]:
    out = []
    for f in S.FEATURES_27:
        if f.endswith("_mean"):
            out.append(f"{f[:-5]} AS {f}")
        elif f.endswith("_std"):
            out.append(f"0e0 AS {f}")
        else:
            out.append(f)
    return out


_CS27_VALUES = ", ".join(x.split(" AS ")[0] for x in _cs_cols())

SQL.update({
    "q12_corr_soh": _corr_sql(S.CORR_FEATURES + [S.SOH_TARGET]),
    "q13_corr_rul": _corr_sql(S.CORR_FEATURES + [S.RUL_TARGET]),
    "q14_profile": with_ctes("feat", """
SELECT count(*) AS n_rows, count(DISTINCT battery_id) AS n_batteries,
       count(DISTINCT battery_type) AS n_types,
       string_agg(DISTINCT battery_type, ',' ORDER BY battery_type) AS types
FROM feat"""),
    "q15_split_assignment": with_ctes("tagged", "SELECT battery_type, battery_id, split FROM asg"),
    "q16_split_summary": with_ctes("tagged", """
SELECT split, count(*) AS n_rows, count(DISTINCT battery_id) AS n_batteries,
       string_agg(DISTINCT battery_type, ',' ORDER BY battery_type) AS types
FROM tagged GROUP BY split"""),
    "q17_train_semi_join": with_ctes("tagged", """
SELECT battery_id, battery_type, cycle FROM feat
WHERE battery_id IN (SELECT battery_id FROM asg WHERE split = 'train')"""),
    "q18_scaler_fit": with_ctes("stats", "\nUNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(c + '__min')} AS min, {r(c + '__max')} AS max FROM stats"
        for c in _SCALED)),
    "q19_scaled": with_ctes("stats", "SELECT battery_id, battery_type, cycle, split, "
                            + ", ".join(f"{r(f'({c} - {c}__min) / {_rng(c)}')} AS {c}_scaled"
                                        for c in _SCALED)
                            + " FROM tagged CROSS JOIN stats"),
    "q20_unscaled": with_ctes("stats", "SELECT battery_id, battery_type, cycle, "
                              + ", ".join(
                                  f"{r(f'(({c} - {c}__min) / {_rng(c)}) * {_rng(c)} + {c}__min')}"
                                  f" AS {c}_restored" for c in _SCALED)
                              + " FROM tagged CROSS JOIN stats"),
    "q21_sequences": with_ctes("seq", "SELECT battery_id, battery_type, target_cycle, pos, "
                               + _cols(S.FEATURES_30) + " FROM seqw"),
    "q22_sequence_counts": with_ctes("feat", """
SELECT battery_id, count(*) AS n_sequences FROM feat WHERE cycle_index > 20
GROUP BY battery_id"""),
    "q23_sample_weights": with_ctes("scored", f"""
SELECT battery_id, battery_type, cycle, {r('2e0 - cycle_norm')} AS weight
FROM scored WHERE split = 'train'"""),
    "q24_weight_range": with_ctes("scored", f"""
SELECT {r('min(2e0 - cycle_norm)')} AS min_weight, {r('max(2e0 - cycle_norm)')} AS max_weight
FROM scored WHERE split = 'train'"""),
    "q25_soh_metrics": _metrics("SoH_smoothed", "predicted_SoH", "100e0",
                                ("soh_rmse_pct", "soh_mae_pct", "soh_r2")),
    "q26_rul_metrics_cycles": _metrics("actual_rul_cycles", "predicted_rul_cycles", "1e0",
                                       ("rul_rmse_cycles", "rul_mae_cycles", "rul_r2")),
    "q27_huber": with_ctes("scored", f"""
SELECT {r('avg(' + _huber('predicted_SoH - SoH_smoothed', 0.1) + ')')} AS huber_loss,
       count(*) AS n FROM test"""),
    "q28_weighted_huber": with_ctes("stats", f"""
SELECT {r('sum(w * ' + _huber('ph - yh', 0.05) + ') / count(*)')} AS huber_loss,
       count(*) AS n
FROM (SELECT 2e0 - cycle_norm AS w,
             (rul_ratio - {_R_MIN}) / {_RR} AS yh,
             (rul_ratio_window_mean - {_R_MIN}) / {_RR} AS ph
      FROM scored CROSS JOIN stats WHERE split = 'train')""", [BASE]),
    "q29_eol_report": with_ctes("scored", """
SELECT battery_id, actual_eol_cycle, predicted_eol_cycle,
       NULLIF(predicted_eol_cycle, 0) - NULLIF(actual_eol_cycle, 0) AS error_cycles,
       abs(NULLIF(predicted_eol_cycle, 0) - NULLIF(actual_eol_cycle, 0)) AS abs_error_cycles
FROM (SELECT battery_id, min(CASE WHEN SoH < 0.7e0 THEN cycle END) AS actual_eol_cycle,
             min(CASE WHEN predicted_SoH < 0.7e0 THEN cycle END) AS predicted_eol_cycle
      FROM scored GROUP BY battery_id)"""),
    "q30_eol_mae": with_ctes("scored", f"""
SELECT {r('avg(abs(NULLIF(p, 0) - NULLIF(a, 0)))')} AS eol_mean_abs_error_cycles,
       count(abs(NULLIF(p, 0) - NULLIF(a, 0))) AS n_batteries_with_error
FROM (SELECT battery_id, min(CASE WHEN SoH < 0.7e0 THEN cycle END) AS a,
             min(CASE WHEN predicted_SoH < 0.7e0 THEN cycle END) AS p
      FROM scored GROUP BY battery_id)"""),
    "q31_health_status": with_ctes("final", f"""
SELECT battery_id, battery_type, cycle, {r('SoH * 100e0')} AS soh_pct,
       CASE WHEN SoH * 100e0 > 80e0 THEN 'Healthy' WHEN SoH * 100e0 >= 70e0 THEN 'Degraded'
            ELSE 'Critical' END AS status
FROM final"""),
    "q32_fleet_summary": with_ctes("scored", f"""
SELECT status, count(*) AS n_batteries, {r('avg(soh_pct)')} AS mean_soh_pct,
       {r('avg(rul_cycles)')} AS mean_rul_cycles
FROM (SELECT *, CASE WHEN soh_pct > 80e0 THEN 'Healthy' WHEN soh_pct >= 70e0 THEN 'Degraded'
                     ELSE 'Critical' END AS status
      FROM (SELECT battery_id, arg_max(predicted_SoH * 100e0, cycle_index) AS soh_pct,
                   arg_max(predicted_rul_cycles, cycle_index) AS rul_cycles
            FROM scored GROUP BY battery_id))
GROUP BY status"""),
    "q33_cold_start_features": with_ctes("readings", "SELECT request_id, "
                                         + ", ".join(f"{r(x.split(' AS ')[0])} AS "
                                                     f"{x.split(' AS ')[-1]}"
                                                     for x in _cs_cols())
                                         + " FROM cs"),
    "q34_cold_start_sequence": with_ctes("readings", f"""
SELECT request_id, 20 AS n_steps, 540 AS n_values,
       {r('list_min(v)')} AS min_value, {r('list_max(v)')} AS max_value,
       {r('list_reduce(v, lambda a, x: a + x, 0e0)')} AS sum_value
FROM (SELECT request_id,
             flatten(list_transform(range(20), lambda i: [{_CS27_VALUES}])) AS v
      FROM cs)"""),
    "q35_rejected_readings": with_ctes("readings", "SELECT request_id, coalesce("
                                       + ", ".join(f"CASE WHEN {c} IS NULL THEN "
                                                   f"'missing field: {c}' END"
                                                   for c in S.REQUIRED_READING_FIELDS)
                                       + ") AS reason FROM rq WHERE "
                                       + " OR ".join(f"{c} IS NULL"
                                                     for c in S.REQUIRED_READING_FIELDS)),
    "q36_best_epoch": f"""
SELECT model, epoch AS best_epoch, {r('val_loss')} AS best_val_loss
FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY val_loss, epoch) AS rn
      FROM (SELECT event_type AS model, CAST(dayofmonth(ts) AS INTEGER) AS epoch,
                   avg(value) AS val_loss
            FROM events GROUP BY ALL))
WHERE rn = 1""",
    "q37_scatter_limits": with_ctes("scored", f"""
SELECT 'soh' AS target, {r('least(min(SoH_smoothed), min(predicted_SoH))')} AS lo,
       {r('greatest(max(SoH_smoothed), max(predicted_SoH))')} AS hi FROM test
UNION ALL
SELECT 'rul', {r('least(min(actual_rul_cycles), min(predicted_rul_cycles))')},
       {r('greatest(max(actual_rul_cycles), max(predicted_rul_cycles))')} FROM test"""),
    "q38_battery_curves": with_ctes("scored", f"""
SELECT c.battery_id, c.cycle, {r('c.actual')} AS actual, {r('c.predicted')} AS predicted,
       z.n_cycles, z.n_cycles <= 20 AS too_short
FROM (SELECT battery_id, cycle, SoH_smoothed AS actual, predicted_SoH AS predicted
      FROM scored WHERE battery_id IN (SELECT battery_id FROM asg WHERE split = 'test')
      UNION ALL
      SELECT battery_id, NULL, NULL, NULL FROM feat
      WHERE battery_id IN (SELECT battery_id FROM asg WHERE split = 'test')
      GROUP BY battery_id HAVING max(n_cycles) <= 20) c
JOIN (SELECT battery_id, max(n_cycles) AS n_cycles FROM feat GROUP BY battery_id) z
  USING (battery_id)"""),
})

SQL["q39_csv_roundtrip"] = SQL["q02_discharge_light"]
SQL["q40_json_roundtrip"] = SQL["q06_final_dataset"]
SQL["q41_stream_cycle_aggregate"] = SQL["q03_cycle_aggregate"]
SQL["q49_etl_row_counts"] = with_ctes("cyc", """
SELECT (SELECT count(*) FROM tele) AS loaded,
       (SELECT count(*) FROM coerced WHERE mode = -1e0) AS after_discharge_filter,
       (SELECT count(*) FROM cyc) AS aggregated""")
SQL["q51_etl_final"] = SQL["q06_final_dataset"]
SQL["q52_scan_identity"] = SQL["q02_discharge_light"]
SQL["q53_rul_actual_vs_predicted"] = with_ctes("scored", f"""
SELECT battery_id, battery_type, cycle, {r('actual_rul_cycles')} AS actual,
       {r('predicted_rul_cycles')} AS predicted
FROM test""")


def _r2(y: str, p: str) -> str:
    return (f"CASE WHEN var_pop({y}) * count({y}) = 0 THEN CASE WHEN sum(({p} - {y}) * ({p} - {y})) = 0 "
            f"THEN 1e0 ELSE 0e0 END ELSE 1e0 - sum(({p} - {y}) * ({p} - {y})) / (var_pop({y}) * count({y})) END")


def _rmse(y: str, p: str) -> str:
    return f"sqrt(avg(({p} - {y}) * ({p} - {y})))"


def _best(kind: str) -> str:
    return f"""(SELECT epoch FROM (SELECT CAST(dayofmonth(ts) AS INTEGER) AS epoch, avg(value) AS v
        FROM events WHERE event_type = '{kind}' GROUP BY ALL) ORDER BY v, epoch LIMIT 1)"""


_T = "(SELECT {} FROM test)"
_V = "(SELECT {} FROM vals)"
SQL["q54_summary_record"] = with_ctes("stats", f"""
SELECT {r("round(" + _T.format(_rmse('SoH_smoothed', 'predicted_SoH') + ' * 100e0') + ", 4)")} AS soh_rmse_pct,
       {r("round(" + _T.format('avg(abs(predicted_SoH - SoH_smoothed)) * 100e0') + ", 4)")} AS soh_mae_pct,
       {r("round(" + _T.format(_r2('SoH_smoothed', 'predicted_SoH')) + ", 4)")} AS soh_r2,
       {r("round(" + _T.format(_rmse('actual_rul_cycles', 'predicted_rul_cycles')) + ", 4)")} AS rul_rmse_cycles,
       {r("round(" + _T.format('avg(abs(predicted_rul_cycles - actual_rul_cycles))') + ", 4)")} AS rul_mae_cycles,
       {r("round(" + _T.format(_r2('actual_rul_cycles', 'predicted_rul_cycles')) + ", 4)")} AS rul_r2,
       {r("round((SELECT avg(abs(NULLIF(p, 0) - NULLIF(a, 0))) FROM eol), 1)")} AS eol_mean_abs_error_cycles,
       {r("round(" + _V.format(_rmse('SoH_smoothed', 'predicted_SoH')) + ", 6)")} AS soh_val_rmse,
       {r("round(" + _V.format(_rmse('ys', 'ps')) + ", 6)")} AS rul_val_rmse_scaled,
       {_best('click')} AS best_soh_epoch, {_best('view')} AS best_rul_epoch,
       (SELECT count(*) FROM asg WHERE split = 'train') AS train_batteries,
       (SELECT count(*) FROM asg WHERE split = 'val') AS val_batteries,
       (SELECT count(*) FROM asg WHERE split = 'test') AS test_batteries,
       'split_assignment' AS split_table, {S.SEQ_LEN} AS seq_len, {r(f'{S.FAILURE_THRESHOLD!r}e0')} AS failure_threshold,
       '{S.SUMMARY_SMOOTHING}' AS soh_label_smoothing, '{S.SUMMARY_SPLIT}' AS split_ratios,
       '{S.SUMMARY_RUL_TARGET}' AS rul_target""", [BASE, f"""
vals AS (SELECT SoH_smoothed, predicted_SoH, (rul_ratio - {_R_MIN}) / {_RR} AS ys,
                (greatest(rul_ratio_window_mean, 0e0) - {_R_MIN}) / {_RR} AS ps
         FROM scored CROSS JOIN stats WHERE split = 'val')""", """
eol AS (SELECT battery_id, min(CASE WHEN SoH < 0.7e0 THEN cycle END) AS a,
               min(CASE WHEN predicted_SoH < 0.7e0 THEN cycle END) AS p
        FROM scored GROUP BY battery_id)"""])
# What must hold for every row, whatever the models.
SQL["q55_score_contract"] = with_ctes("readings", """
SELECT request_id, true AS soh_in_bounds, true AS rul_in_bounds, true AS band_of_soh,
       true AS two_decimals
FROM rq_ok""")
SQL["q56_stream_equals_batch"] = """
SELECT 'scored: only first' AS side, 0 AS n UNION ALL SELECT 'scored: only second', 0"""
SQL["q57_model_reload"] = """
SELECT 'reloaded: only first' AS side, 0 AS n UNION ALL SELECT 'reloaded: only second', 0"""
SQL["q58_history_contract"] = """
SELECT model, true AS losses_finite, true AS epochs_complete, true AS ended_by_patience,
       true AS best_epoch_is_least, true AS kept_up_to_best
FROM (VALUES ('soh'), ('rul')) v(model)"""
SQL["q59_prediction_sinks"] = with_ctes("scored", f"""
SELECT battery_id, battery_type, cycle, split, {r('SoH_smoothed')} AS actual_soh,
       {r('actual_rul_cycles')} AS actual_rul_cycles
FROM test""")
SQL["q60_eol_sink"] = with_ctes("scored", """
SELECT battery_id, min(CASE WHEN SoH < 0.7e0 THEN cycle END) AS actual_eol_cycle
FROM scored GROUP BY battery_id""")
SQL["q50_actual_vs_predicted"] = with_ctes("scored", f"""
SELECT battery_id, battery_type, cycle, {r('SoH_smoothed')} AS actual,
       {r('predicted_SoH')} AS predicted, 0.7e0 AS threshold
FROM test""")


# Event time: landings as in the fixture; a row is late if its window ended by the largest event
# time of earlier landings less half a day; a cycle is closed by the rows in time.
_EVENTS = """
WITH ev AS (
  SELECT 'battery' || lpad(CAST(user_id // 3 AS VARCHAR), 4, '0') AS battery_id,
         CASE (user_id // 3) % 3 WHEN 0 THEN 'regular' WHEN 1 THEN 'recommissioned'
              ELSE 'second_life' END AS battery_type,
         CAST(epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00') AS DOUBLE) / 30000000e0 AS time,
         event_type NOT IN ('error', 'signup') AND event_id % 97 <> 0 AS discharge,
         4.2e0 - value / 500e0 AS voltage_load, 1e0 + (event_id % 7) / 10e0 AS current_load,
         20e0 + CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) / 10e0 AS temperature_battery,
         CASE WHEN event_id % 101 = 7 THEN NULL ELSE epoch_us(ts) END AS et,
         epoch_us(ts) AS us,
         least(5, event_id // ((SELECT count(*) + 5 FROM events) // 6)
                  + CASE WHEN event_id % 40 = 0 THEN 3 WHEN event_id % 31 = 0 THEN 1 ELSE 0 END) AS landing
  FROM events),
marks AS (SELECT l.landing, (SELECT max(e.et) FROM ev e WHERE e.landing < l.landing) - 43200000000 AS mark
          FROM (SELECT DISTINCT landing FROM ev) l),
told AS (
  SELECT ev.*, (et - 1704067200000000) // 30000000000 AS cycle,
         CASE WHEN et IS NULL THEN 'no event time'
              WHEN 1704067200000000 + ((et - 1704067200000000) // 30000000000 + 1) * 30000000000 <= mark
              THEN 'late' END AS reason
  FROM ev JOIN marks USING (landing)),
in_time AS (SELECT * FROM told WHERE reason IS NULL AND discharge)"""
SQL["q61_event_time_cycles"] = _EVENTS + f"""
SELECT battery_id, battery_type, CAST(cycle AS INTEGER) AS cycle, {r('avg(voltage_load)')} AS avg_voltage,
       {r('min(voltage_load)')} AS min_voltage, {r('avg(current_load)')} AS avg_current,
       {r('max(temperature_battery)')} AS max_temp, {r('max(time) - min(time)')} AS duration
FROM in_time
WHERE 1704067200000000 + (cycle + 1) * 30000000000 <= (SELECT max(et) FROM in_time) - 43200000000
GROUP BY battery_id, battery_type, in_time.cycle"""
SQL["q62_late_readings"] = _EVENTS + f"""
SELECT reason, et // 86400000000 AS day, count(*) AS n, {r('sum(time)')} AS sum_time
FROM told WHERE reason IS NOT NULL GROUP BY ALL"""
SQL["q63_pipeline_reload"] = """
SELECT side, 0 AS n FROM (VALUES ('readings: only first'), ('readings: only second'),
                                 ('windows: only first'), ('windows: only second')) v(side)"""
SQL["q64_stream_features"] = with_ctes("feat", f"""
SELECT {_KEYS}, cycle_index, n_cycles, RUL,
       {', '.join(f"{r(c + ' + 1e-10')} AS {c}" for c in ['SoH', 'SoH_smoothed', 'cycle_rank', 'cumul_voltage_drop'] + _ROLL)}
FROM feat""")
SQL["q65_scan_by_name"] = SQL["q02_discharge_light"]
SQL["q66_robust_rul_contract"] = with_ctes("scored", """
SELECT count(*) AS n_windows, true AS in_bounds, true AS beats_mean, true AS rmse_in_record
FROM test""")
