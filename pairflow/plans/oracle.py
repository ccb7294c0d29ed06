"""ANSI SQL twins of the registered queries, runnable by DuckDB on the
driver's tables. They restate each operator's semantics independently of
the Spark plan (plain joins and global windows where the Spark plan uses
segmented ones), so agreement is evidence, not tautology.

Non-exact aggregates (sums of fractional doubles, averages, deviations,
correlations) are rounded to 9 decimals on both sides: the two engines add
in different orders and differ in the last bits.
"""

from __future__ import annotations

from . import fixtures as fx

ROUND = 9

TICKS = """ticks AS (
  SELECT event_id, ts, event_type, value AS price,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""

GAPPY_TICKS = f"""gticks AS (
  SELECT event_id, ts, event_type,
         CASE WHEN size % {fx.GAP_SIZE_DIVISOR} <> 0 THEN price END AS price, size
  FROM ticks)"""


def in_session(ts: str = "ts") -> str:
    tod = f"(hour({ts}) * 60 + minute({ts}))"
    return f"({tod} >= {fx.SESSION_OPEN_MINUTE} AND {tod} < {fx.SESSION_CLOSE_MINUTE})"


def candles_cte(name: str, src: str, symbol: str, where: str = "TRUE",
                metrics: str | None = "base") -> str:
    """metrics: 'base' (with is_bullish), 'ref' (without) or None."""
    raw = f"""{name}_c AS (
  SELECT '{symbol}' AS symbol, date_trunc('minute', ts) AS ts_minute_utc,
         CAST(date_trunc('minute', ts) AS DATE) AS execution_date,
         first(price ORDER BY ts, event_id) FILTER (WHERE price IS NOT NULL) AS open,
         max(price) AS high, min(price) AS low,
         last(price ORDER BY ts, event_id) FILTER (WHERE price IS NOT NULL) AS close,
         CAST(sum(size) AS DOUBLE) AS volume, count(*) AS trades,
         date_trunc('minute', ts) + INTERVAL 1 MINUTE AS ingested_at_utc
  FROM {src} WHERE {where}
  GROUP BY date_trunc('minute', ts))"""
    if metrics is None:
        return raw + f",\n{name} AS (SELECT * FROM {name}_c)"
    bull = ", close > open AS is_bullish" if metrics == "base" else ""
    return raw + f""",
{name} AS (
  SELECT *, high - low AS price_range, close - open AS price_change,
         CASE WHEN open <> 0 THEN (close - open) / open * 100 ELSE 0 END AS price_change_pct{bull}
  FROM {name}_c)"""


BASE = candles_cte("base", "ticks", "ALL")
REF = candles_cte("ref", "ticks", "REF",
                  f"event_type = 'purchase' AND {in_session()}", metrics="ref")
SCENARIO_REF = f"""sref AS (
  SELECT * REPLACE (CASE WHEN execution_date = DATE '{fx.UNMATCHED_DAY}'
                         THEN ts_minute_utc + INTERVAL 30 SECOND
                         ELSE ts_minute_utc END AS ts_minute_utc)
  FROM ref
  WHERE execution_date NOT IN (DATE '{fx.REF_ABSENT_DAY}', DATE '{fx.NO_SEED_DAYS[0]}',
                               DATE '{fx.NO_SEED_DAYS[1]}'))"""
GAPPY = candles_cte("gappy", "gticks", "ALL", metrics=None)


def overlap_cte(name: str, src: str) -> str:
    p = fx.PULL_MINUTES
    return f"""{name} AS (
  SELECT * FROM {src}
  UNION ALL
  SELECT * REPLACE (close + 0.5 AS close, greatest(high, close + 0.5) AS high,
                    ingested_at_utc + INTERVAL {p} MINUTE AS ingested_at_utc)
  FROM {src} WHERE minute(ts_minute_utc) % {p} = {p - 1})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


# --- lead/lag features -------------------------------------------------------

def features_sql(ref_name: str = "ref", seed: str = "previous_day", max_lag: int = 5,
                 bp: str = "base", rp: str = "ref", warmup: bool = True,
                 base_name: str = "base") -> str:
    """The feature table as plain SQL: LEFT JOIN, LEFT JOIN seed, global
    windows per day."""
    rcols = ["close", "volume", "high", "low"]
    if seed == "previous_day":
        seed_cte = f"""seed AS (
  SELECT CAST(execution_date + INTERVAL 1 DAY AS DATE) AS execution_date,
         {', '.join(f'last({c} ORDER BY ts_minute_utc) AS {c}' for c in rcols)}
  FROM {ref_name} GROUP BY execution_date)"""
    elif seed == "last_known":
        daily = ", ".join(
            f"last({c} ORDER BY ts_minute_utc) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in rcols)
        carry = ", ".join(
            f"last_value({c} IGNORE NULLS) OVER (ORDER BY d.execution_date "
            f"ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS {c}" for c in rcols)
        seed_cte = f"""rdaily AS (
  SELECT execution_date, {daily} FROM {ref_name} GROUP BY execution_date),
alldays AS (
  SELECT execution_date FROM {base_name} UNION SELECT execution_date FROM {ref_name}),
seed AS (
  SELECT d.execution_date, {carry}
  FROM alldays d LEFT JOIN rdaily USING (execution_date))"""
    else:
        seed_cte = f"""seed AS (
  SELECT NULL::DATE AS execution_date, {', '.join(f'NULL::DOUBLE AS {c}' for c in rcols)}
  WHERE FALSE)"""
    fill = ",\n         ".join(
        f"coalesce(last_value(o.{c} IGNORE NULLS) OVER wf, s.{c}) AS {rp}_{c}" for c in rcols)
    lags = []
    for k in range(1, max_lag + 1):
        lags += [f"lag({bp}_close, {k}) OVER w AS {bp}_close_lag_{k}",
                 f"lead({bp}_close, {k}) OVER w AS {bp}_close_lead_{k}",
                 f"lag({bp}_volume, {k}) OVER w AS {bp}_volume_lag_{k}",
                 f"CASE WHEN has_ref THEN lag({rp}_close, {k}) OVER w END AS {rp}_close_lag_{k}",
                 f"CASE WHEN has_ref THEN lead({rp}_close, {k}) OVER w END AS {rp}_close_lead_{k}"]
    lag_sql = ",\n         ".join(lags)
    where = f"WHERE {bp}_close_lag_1 IS NOT NULL" if warmup else ""
    return f"""{seed_cte},
refdays AS (SELECT DISTINCT execution_date FROM {ref_name}),
joined AS (
  SELECT b.execution_date, b.ts_minute_utc,
         b.close AS {bp}_close, b.volume AS {bp}_volume, b.high AS {bp}_high,
         b.low AS {bp}_low, b.price_change_pct AS {bp}_change_pct,
         {fill},
         o.close IS NOT NULL AS {rp}_market_open,
         h.execution_date IS NOT NULL AS has_ref
  FROM {base_name} b
  LEFT JOIN {ref_name} o ON o.execution_date = b.execution_date AND o.ts_minute_utc = b.ts_minute_utc
  LEFT JOIN seed s ON s.execution_date = b.execution_date
  LEFT JOIN refdays h ON h.execution_date = b.execution_date
  WINDOW wf AS (PARTITION BY b.execution_date ORDER BY b.ts_minute_utc
                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
shifted AS (
  SELECT *,
         {lag_sql}
  FROM joined
  WINDOW w AS (PARTITION BY execution_date ORDER BY ts_minute_utc)),
features AS (
  SELECT ts_minute_utc, {bp}_close, {bp}_volume, {bp}_high, {bp}_low, {bp}_change_pct,
         {rp}_close, {rp}_volume, {rp}_high, {rp}_low, {rp}_market_open,
         {', '.join(x.split(' AS ')[-1] for x in lags)},
         CASE WHEN {bp}_close_lag_1 IS NOT NULL AND {bp}_close_lag_1 <> 0
              THEN ({bp}_close - {bp}_close_lag_1) / {bp}_close_lag_1 * 100 END AS {bp}_return_1m,
         CASE WHEN has_ref AND {rp}_close_lag_1 IS NOT NULL AND {rp}_close_lag_1 <> 0
              THEN ({rp}_close - {rp}_close_lag_1) / {rp}_close_lag_1 * 100 END AS {rp}_return_1m,
         execution_date
  FROM shifted {where})"""
