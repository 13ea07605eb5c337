"""The same results in SQL, for comparison on another engine."""

from __future__ import annotations

TX = """
tx AS (
  SELECT event_id AS txn_id, user_id, user_id AS card_id,
         CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month,
         CAST(day(ts) AS INTEGER) AS day, strftime(ts, '%H:%M') AS time,
         value AS amount, event_type AS use_chip, event_id AS merchant_id,
         json_extract_string(props, '$.k') AS merchant_city,
         CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END AS merchant_state,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS mcc,
         CASE WHEN event_type = 'error' AND value > 100 THEN 1 ELSE 0 END AS is_fraud,
         ts AS event_ts
  FROM events)
"""
TX_COLUMNS = (
    "txn_id, user_id, card_id, year, month, day, time, amount, use_chip, merchant_id, "
    "merchant_city, merchant_state, mcc, is_fraud"
)
FLAGS = "r1_amount_anomaly, r2_velocity, r4_odd_hour, risk_score, risk_level"

SCORED = TX + """,
ceilings AS (
  SELECT card_id, round(avg(amount) + 3 * coalesce(stddev_samp(amount), 0), 6) AS ceiling
  FROM tx GROUP BY card_id),
hours AS (
  SELECT card_id, date_trunc('hour', event_ts) AS h, count(*) AS n FROM tx GROUP BY ALL),
top_share AS (SELECT quantile_cont(amount, 0.9) AS q FROM tx),
flags AS (
  SELECT tx.*,
         CASE WHEN amount > ceiling OR amount > 300 THEN 1 ELSE 0 END AS r1_amount_anomaly,
         CASE WHEN n > 1 THEN 1 ELSE 0 END AS r2_velocity,
         CASE WHEN hour(event_ts) >= 0 AND hour(event_ts) < 5
               AND amount >= (SELECT q FROM top_share) THEN 1 ELSE 0 END AS r4_odd_hour
  FROM tx JOIN ceilings USING (card_id)
  JOIN hours ON hours.card_id = tx.card_id AND hours.h = date_trunc('hour', tx.event_ts)),
scores AS (
  SELECT *, CAST(2 * r1_amount_anomaly + r2_velocity + r4_odd_hour AS DOUBLE) AS risk_score
  FROM flags),
scored AS (
  SELECT *, CASE WHEN risk_score >= 3 THEN 'HIGH' WHEN risk_score >= 1.5 THEN 'MEDIUM'
                 ELSE 'LOW' END AS risk_level
  FROM scores)
"""

ORDER_DAYS = """
od AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         CAST(day(o_orderdate) AS INTEGER) AS day,
         CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_fraud
  FROM orders)
"""

# Source text, and what cleaning makes of it.
SOURCE = TX + """,
src AS (
  SELECT txn_id, CAST(user_id AS VARCHAR) AS "User", CAST(card_id AS VARCHAR) AS "Card",
         CAST(year AS VARCHAR) AS "Year", CAST(month AS VARCHAR) AS "Month",
         CAST(day AS VARCHAR) AS "Day", time AS "Time",
         CASE WHEN use_chip = 'click' THEN '$-' || printf('%.2f', amount)
              WHEN use_chip = 'signup' AND amount < 10 THEN 'n/a'
              ELSE '$' || printf('%.2f', amount) END AS "Amount",
         use_chip AS "Use Chip", CAST(merchant_id AS VARCHAR) AS "Merchant Name",
         merchant_city AS "Merchant City", merchant_state AS "Merchant State",
         CAST(mcc AS VARCHAR) AS "MCC",
         CASE WHEN is_fraud = 1 AND amount > 150 THEN ' Yes ' WHEN is_fraud = 1 THEN 'Yes'
              WHEN use_chip <> 'view' THEN 'No' END AS "Is Fraud?"
  FROM tx),
clean AS (
  SELECT txn_id, user_id, card_id, year, month, day, time,
         CASE WHEN use_chip = 'click' THEN -amount
              WHEN use_chip = 'signup' AND amount < 10 THEN NULL ELSE amount END AS amount,
         use_chip, merchant_id, merchant_city, merchant_state, mcc, is_fraud
  FROM tx)
"""

PREVIOUS = TX + """,
prev AS (
  SELECT tx.*, lag(event_ts) OVER w AS prev_ts, lag(merchant_state) OVER w AS prev_state
  FROM tx WINDOW w AS (PARTITION BY card_id ORDER BY event_ts, txn_id)),
gaps AS (
  SELECT *, (epoch_us(event_ts) - epoch_us(prev_ts)) / 6e7 AS gap_min,
         prev_state IS NOT NULL AND merchant_state IS DISTINCT FROM prev_state AS changed
  FROM prev)
"""

WINDOW = """
run AS (
  SELECT a.year, a.month, a.day AS first_day, a.day + 6 AS last_day,
         CAST(sum(b.fraud) AS BIGINT) AS frauds, CAST(sum(b.total) AS BIGINT) AS total
  FROM daily a JOIN daily b
    ON a.year = b.year AND a.month = b.month AND b.day BETWEEN a.day AND a.day + 6
  GROUP BY a.year, a.month, a.day HAVING count(*) = 7),
best AS (
  SELECT * FROM run ORDER BY frauds DESC, year, month, first_day LIMIT 1)
"""
DAILY = """
daily AS (
  SELECT year, month, day, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud
  FROM {rows} GROUP BY year, month, day)
"""
ORDER_YEARS = "(1996, 1998, 2000)"


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _pct(part: str, whole: str, digits: int) -> str:
    return f"round(100.0 * CAST({part} AS DOUBLE) / nullif({whole}, 0), {digits})"


def _per_rule(select: str) -> str:
    names = ("r1_amount_anomaly", "r2_velocity", "r4_odd_hour")
    parts = [
        f"SELECT '{r}' AS rule_name, CAST(sum({r}) AS BIGINT) AS n_flagged, "
        f"CAST(sum(CASE WHEN {r} = 1 AND is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_correct, "
        "count(*) AS n_all, CAST(sum(is_fraud) AS BIGINT) AS total_real_frauds FROM scored"
        for r in names
    ]
    return _with(SCORED + ", per_rule AS (" + " UNION ALL ".join(parts) + ")", select)


def _describe(value: str, percentiles: dict[str, float], rows: str, label: str = "") -> str:
    columns = [f"{label}"] if label else []
    columns += [
        f'count({value}) AS "count"', f"round(avg({value}), 6) AS mean",
        f"round(stddev_samp({value}), 6) AS std", f'min({value}) AS "min"',
    ]
    columns += [f"round(quantile_cont({value}, {p}), 6) AS {n}" for n, p in percentiles.items()]
    columns += [f'max({value}) AS "max"']
    group = f" GROUP BY {label}" if label else ""
    return f"SELECT {', '.join(columns)} FROM {rows}{group}"


def _limits(rows: str, test: str, limits, label: str, share: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {k} AS {label}, "
        + _pct(f"sum(CASE WHEN {test.format(k=k)} THEN 1 ELSE 0 END)", "count(*)", 4)
        + f" AS {share} FROM {rows}"
        for k in limits
    )


HOTSPOTS = (
    "SELECT merchant_city, merchant_state, count(*) AS total_txns, "
    "CAST(sum(is_fraud) AS BIGINT) AS real_frauds, "
    + _pct("sum(is_fraud)", "count(*)", 3)
    + " AS fraud_rate_pct FROM scored {where} GROUP BY merchant_city, merchant_state "
    "ORDER BY real_frauds DESC, merchant_city NULLS LAST, merchant_state NULLS LAST LIMIT 10"
)
DAY_BREAKDOWN = (
    "SELECT year, month, day, count(*) AS total_txns, CAST(sum(is_fraud) AS BIGINT) AS real_frauds, "
    "CAST(sum(CASE WHEN risk_score > 0 AND is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS frauds_caught, "
    "CAST(sum(CASE WHEN risk_score > 0 THEN 1 ELSE 0 END) AS BIGINT) AS total_flagged "
    "FROM scored GROUP BY year, month, day"
)
HOURS = TX + (
    ", hours AS (SELECT card_id, date_trunc('hour', event_ts) AS h, count(*) AS n "
    "FROM tx GROUP BY ALL)"
)
YEARS = (
    "SELECT year, count(*) AS total, CAST(sum(is_fraud) AS BIGINT) AS fraud, "
    + _pct("sum(is_fraud)", "count(*)", 4)
    + " AS fraud_pct FROM od GROUP BY year"
)
QUOTED = (
    """'Joe "The Bar"' || {city} || CASE WHEN CAST({city} AS INTEGER) % 3 = 0 """
    "THEN chr(10) || 'North' ELSE ', North' END"
)
RAW = _with(TX, f"SELECT {TX_COLUMNS} FROM tx")
CLEAN_COLUMNS = TX_COLUMNS.removeprefix("txn_id, ")
SCORED_ALL = _with(SCORED, f"SELECT {TX_COLUMNS}, event_ts, {FLAGS} FROM scored")


def _rolling(days: int) -> str:
    seconds = days * 86400
    return _with(
        TX,
        f"""
        , t AS (SELECT *, epoch_us(event_ts) // 1000000 AS s FROM tx),
        m AS (SELECT *, avg(amount) OVER (PARTITION BY user_id ORDER BY s
                RANGE BETWEEN {seconds} PRECEDING AND 1 PRECEDING) AS mean FROM t)
        SELECT txn_id, CASE WHEN amount > 3 * mean THEN 1 ELSE 0 END AS r_amount_rolling FROM m
        """,
    )


def _velocity(limit: int) -> str:
    return _with(
        HOURS,
        f"""
        SELECT txn_id, CASE WHEN n > {limit} THEN 1 ELSE 0 END AS r2_velocity
        FROM tx JOIN hours ON hours.card_id = tx.card_id
         AND hours.h = date_trunc('hour', tx.event_ts)
        """,
    )


def _odd_hour(start: int) -> str:
    return _with(
        TX,
        f"""
        SELECT txn_id, CASE WHEN hour(event_ts) >= {start} AND hour(event_ts) < 5
          AND amount >= (SELECT quantile_cont(amount, 0.9) FROM tx) THEN 1 ELSE 0 END AS r4_odd_hour
        FROM tx
        """,
    )


SAMPLED = TX + """,
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY is_fraud
    ORDER BY CAST('0x' || substr(md5('42|' || txn_id), 1, 15) AS BIGINT), txn_id) AS rn
  FROM tx),
kept AS (
  SELECT * FROM ranked
  WHERE is_fraud = 1 OR rn <= 4000 - (SELECT sum(is_fraud) FROM tx))
"""

PRECISION = """
SELECT rule_name, n_flagged, n_correct,
       CASE WHEN n_flagged = 0 THEN 0 ELSE round(100.0 * CAST(n_correct AS DOUBLE) / n_flagged, 2)
       END AS precision_pct,
       total_real_frauds,
       CASE WHEN total_real_frauds = 0 THEN 0
            ELSE round(100.0 * CAST(n_correct AS DOUBLE) / total_real_frauds, 2) END AS recall_pct
FROM per_rule
"""
LEVELS = (
    "SELECT risk_level, count(*) AS n_transactions, CAST(sum(is_fraud) AS BIGINT) AS n_real_frauds, "
    + _pct("sum(is_fraud)", "count(*)", 3)
    + " AS fraud_rate_pct FROM scored GROUP BY risk_level"
)

SQL: dict[str, str] = {
    # sources and sinks
    "read_source": _with(SOURCE, "SELECT * EXCLUDE (txn_id) FROM src"),
    "read_raw_transactions": RAW,
    "read_raw_transactions_recursive": RAW,
    "read_raw_transactions_own_recursive": RAW,
    "read_raw_transactions_quoted": _with(
        TX, f"SELECT * REPLACE ({QUOTED.format(city='merchant_city')} AS merchant_city) FROM (SELECT {TX_COLUMNS} FROM tx)"
    ),
    "read_source_quoted": _with(
        SOURCE,
        f"SELECT * REPLACE ({QUOTED.format(city='merchant_city')} AS merchant_city) "
        f"FROM (SELECT {CLEAN_COLUMNS} FROM clean)",
    ),
    "parse_source": _with(SOURCE, f"SELECT {CLEAN_COLUMNS} FROM clean WHERE txn_id % 50 > 1"),
    "parse_source_quarantine": _with(
        SOURCE,
        "SELECT count(*) FILTER (txn_id % 50 > 1) AS n_good, count(*) FILTER (txn_id % 50 <= 1) AS n_bad, "
        "count(*) FILTER (txn_id % 50 <= 1) AS n_written FROM clean",
    ),
    "write_raw_partitions": _with(
        TX,
        "SELECT printf('year=%04d/month=%02d/day=%02d', year, month, day) AS folder, txn_id, time, amount, "
        "merchant_city, merchant_state FROM tx",
    ),
    "register_curated_table_moved": _with(TX, "SELECT * FROM tx WHERE day > 10"),
    "write_curated": SCORED_ALL,
    "write_curated_dynamic": _with(
        TX,
        "SELECT * REPLACE (CASE WHEN day > 20 THEN amount * 2 ELSE amount END AS amount) FROM tx",
    ),
    "write_scored_csv": SCORED_ALL,
    "register_curated_table": SCORED_ALL,
    "register_curated_table_merge_schema": _with(
        SCORED,
        f"SELECT * REPLACE (CASE WHEN day > 15 THEN risk_score END AS risk_score, "
        f"CASE WHEN day > 15 THEN risk_level END AS risk_level) "
        f"FROM (SELECT {TX_COLUMNS}, event_ts, {FLAGS} FROM scored)",
    ),
    "run_daily_batch": _with(
        SCORED,
        f"SELECT {TX_COLUMNS}, date_trunc('minute', event_ts) AS event_ts, {FLAGS} FROM scored",
    ),
    "register_days": _with(TX, "SELECT * FROM tx"),
    # days after the 20th come with an amount of 1, with the cuts learnt from them alone
    "run_daily_batch_again": _with(
        SCORED
        + """,
        late_hours AS (SELECT card_id, date_trunc('hour', event_ts) AS h, count(*) AS n
                       FROM tx WHERE day > 20 GROUP BY ALL),
        late_flags AS (
          SELECT tx.* REPLACE (1.0::DOUBLE AS amount), 0 AS r1_amount_anomaly,
                 CASE WHEN n > 1 THEN 1 ELSE 0 END AS r2_velocity,
                 CASE WHEN hour(event_ts) < 5 THEN 1 ELSE 0 END AS r4_odd_hour
          FROM tx JOIN late_hours l ON l.card_id = tx.card_id AND l.h = date_trunc('hour', tx.event_ts)
          WHERE day > 20),
        late AS (SELECT *, CAST(r2_velocity + r4_odd_hour AS DOUBLE) AS risk_score,
                        CASE WHEN r2_velocity + r4_odd_hour >= 1.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
                 FROM late_flags)""",
        f"""
        SELECT {TX_COLUMNS}, date_trunc('minute', event_ts) AS event_ts, {FLAGS} FROM scored WHERE day <= 20
        UNION ALL SELECT {TX_COLUMNS}, date_trunc('minute', event_ts), {FLAGS} FROM late
        """,
    ),
    "gold_tables": _per_rule(
        f"""
        , spots AS ({HOTSPOTS.format(where='WHERE is_fraud = 1')}), days AS ({DAY_BREAKDOWN})
        SELECT 'risk_level_distribution' AS report, risk_level AS label,
               CAST(sum(is_fraud) AS BIGINT) AS number
        FROM scored GROUP BY risk_level
        UNION ALL SELECT 'rule_precision', rule_name, n_correct FROM per_rule
        UNION ALL SELECT 'daily_fraud_breakdown', CAST(day AS VARCHAR), frauds_caught FROM days
        UNION ALL SELECT 'fraud_hotspots', concat_ws('/', merchant_city, merchant_state), real_frauds
        FROM spots
        """
    ),
    "prepare_dataset": _with(
        SOURCE + "," + DAILY.format(rows="clean") + "," + WINDOW,
        f"""
        SELECT {CLEAN_COLUMNS} FROM clean JOIN best USING (year, month)
        WHERE day BETWEEN first_day AND last_day
        """,
    ),
    "prepare_dataset_sampled": _with(
        SOURCE + "," + DAILY.format(rows="clean") + "," + WINDOW,
        """
        , picked AS (SELECT is_fraud FROM clean JOIN best USING (year, month)
                     WHERE day BETWEEN first_day AND last_day),
        sizes AS (SELECT count(*) AS n, count(*) FILTER (is_fraud = 1) AS frauds FROM picked)
        SELECT is_fraud, n FROM (
          SELECT 1 AS is_fraud, frauds AS n FROM sizes
          UNION ALL SELECT 0, least(greatest(1000 - frauds, 0), n - frauds) FROM sizes) WHERE n > 0
        """,
    ),
    # cleaning and predicates
    "rename_source_columns": _with(
        SOURCE,
        """
        SELECT "User" AS user_id, "Card" AS card_id, "Year" AS year, "Month" AS month, "Day" AS day,
               "Time" AS time, "Amount" AS amount, "Use Chip" AS use_chip,
               "Merchant Name" AS merchant_id, "Merchant City" AS merchant_city,
               "Merchant State" AS merchant_state, "MCC" AS mcc, "Is Fraud?" AS is_fraud
        FROM src
        """,
    ),
    "clean_source": _with(SOURCE, f"SELECT {CLEAN_COLUMNS} FROM clean"),
    "parse_amount": _with(SOURCE, "SELECT txn_id, amount FROM clean"),
    "parse_fraud_flag": _with(SOURCE, "SELECT txn_id, is_fraud FROM clean"),
    "build_event_ts": _with(
        TX,
        """
        SELECT txn_id, CASE WHEN use_chip = 'signup' OR (use_chip = 'click' AND time < '03:00')
                       THEN NULL ELSE date_trunc('minute', event_ts) END AS event_ts
        FROM tx
        """,
    ),
    "filter_years": _with(ORDER_DAYS, f"SELECT * FROM od WHERE year IN {ORDER_YEARS}"),
    "extract_window": _with(
        TX + "," + DAILY.format(rows="tx") + "," + WINDOW,
        "SELECT tx.* FROM tx JOIN best USING (year, month) WHERE day BETWEEN first_day AND last_day",
    ),
    "extract_window_days": _with(
        TX, "SELECT * FROM tx WHERE year = 2024 AND month = 1 AND day BETWEEN 8 AND 14"
    ),
    "flagged_only": SCORED_ALL + " WHERE risk_score > 0",
    "drop_helpers": _with(TX, "SELECT * FROM tx"),
    # rules
    "card_stats": _with(
        TX,
        """
        SELECT card_id, round(avg(amount), 6) AS card_mean,
               round(coalesce(stddev_samp(amount), 0), 6) AS card_std
        FROM tx GROUP BY card_id
        """,
    ),
    "card_stats_per_row": _with(
        TX,
        """
        SELECT txn_id, round(avg(amount) OVER w, 6) AS card_mean,
               round(coalesce(stddev_samp(amount) OVER w, 0), 6) AS card_std
        FROM tx WINDOW w AS (PARTITION BY card_id)
        """,
    ),
    "rule_amount_anomaly": _with(SCORED, "SELECT txn_id, r1_amount_anomaly FROM scored"),
    "txns_per_card_hour": _with(
        TX,
        """
        SELECT txn_id, card_id, CAST(epoch_us(event_ts) // 3600000000 AS BIGINT) AS hour_bucket,
               count(*) OVER (PARTITION BY card_id, date_trunc('hour', event_ts)) AS txn_in_hour
        FROM tx
        """,
    ),
    "rule_velocity": _velocity(1),
    "amount_quantile": _with(TX, "SELECT quantile_cont(amount, 0.9) AS amount_quantile FROM tx"),
    "amount_quantile_by_days": _with(TX, "SELECT count(amount) AS n_amounts, TRUE AS within_bound FROM tx"),
    "amount_quantile_approx": _with(
        TX, "SELECT quantile_disc(amount, 0.9) AS amount_quantile FROM tx"
    ),
    "rule_odd_hour": _odd_hour(0),
    "risk_score": _with(SCORED, "SELECT txn_id, risk_score FROM scored"),
    "risk_level": _with(SCORED, "SELECT txn_id, risk_level FROM scored"),
    "score_transactions": SCORED_ALL,
    "score_transactions_stored_inputs": SCORED_ALL,
    "score_transactions_lazy": SCORED_ALL,
    "score_transactions_shuffled": SCORED_ALL,
    # rules outside the default score
    "rule_amount_rolling": _rolling(30),
    "rule_amount_rolling_3d": _rolling(3),
    "rule_velocity_5": _with(
        TX,
        "SELECT txn_id, CASE WHEN count(*) OVER (PARTITION BY user_id % 5, date_trunc('hour', event_ts)) > 5 "
        "THEN 1 ELSE 0 END AS r2_velocity FROM tx",
    ),
    "rule_amount_rolling_odd": _rolling(3).replace(
        TX.strip(), TX.strip().replace("value AS amount", "CASE WHEN event_id % 40 = 1 THEN 1e19 "
                                       "WHEN event_id % 40 > 3 THEN value END AS amount")
    ).replace("avg(amount)", "avg(CASE WHEN amount < 1e18 THEN amount END)"),
    "rule_state_change": _with(
        PREVIOUS,
        "SELECT txn_id, CASE WHEN changed AND gap_min < 60 THEN 1 ELSE 0 END AS r3_state_change "
        "FROM gaps",
    ),
    "rule_geo_impossible": _with(
        TX,
        """
        , p AS (SELECT *, mcc * 1.8::DOUBLE - 90 AS lat, mcc * 3.6::DOUBLE - 180 AS lon FROM tx),
        w AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(event_ts) OVER w AS pts
              FROM p WINDOW w AS (PARTITION BY card_id ORDER BY event_ts, txn_id)),
        d AS (SELECT *, (epoch_us(event_ts) - epoch_us(pts)) / 6e7 AS gap,
                2 * 6371.0 * asin(sqrt(least(1.0, pow(sin(radians(lat - plat) / 2), 2)
                  + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))))
                AS km FROM w)
        SELECT txn_id, CASE WHEN km > 500 AND gap <= 60 THEN 1 ELSE 0 END AS r3_geo_impossible FROM d
        """,
    ),
    "rule_odd_hour_2_5": _odd_hour(2),
    # source profiles
    "year_fraud_profile": _with(ORDER_DAYS, YEARS),
    "year_fraud_profile_total": _with(
        ORDER_DAYS,
        YEARS
        + " UNION ALL SELECT NULL, count(*), CAST(sum(is_fraud) AS BIGINT), "
        + _pct("sum(is_fraud)", "count(*)", 4)
        + " FROM od",
    ),
    "fraud_flag_values": _with(SOURCE, 'SELECT DISTINCT trim("Is Fraud?") AS flag_value FROM src'),
    "top_fraud_years": _with(
        ORDER_DAYS,
        """
        SELECT year, CAST(sum(is_fraud) AS BIGINT) AS fraud FROM od GROUP BY year
        HAVING sum(is_fraud) > 0 ORDER BY fraud DESC, year LIMIT 5
        """,
    ),
    "day_fraud_profile": _with(
        ORDER_DAYS + "," + DAILY.format(rows="od"),
        f"SELECT * FROM daily WHERE year IN {ORDER_YEARS}",
    ),
    "prepared_summary": _with(
        TX,
        "SELECT count(*) AS n_rows, CAST(sum(is_fraud) AS BIGINT) AS n_frauds, "
        + _pct("sum(is_fraud)", "count(*)", 3)
        + " AS fraud_pct FROM tx",
    ),
    # reports
    "risk_level_counts": _with(
        SCORED, "SELECT risk_level, count(*) AS n_transactions FROM scored GROUP BY risk_level"
    ),
    "risk_level_distribution": _with(SCORED, LEVELS),
    "rule_precision": _per_rule(PRECISION),
    "rule_precision_simple": _per_rule(
        "SELECT rule_name, round(100.0 * CAST(n_correct AS DOUBLE) / n_flagged, 2) AS precision_pct, "
        "n_correct, n_flagged FROM per_rule WHERE n_flagged > 0"
    ),
    "rule_firing_counts": _per_rule(
        f"SELECT rule_name, n_flagged, {_pct('n_flagged', 'n_all', 4)} AS pct_of_traffic FROM per_rule"
    ),
    "overall_alignment": _with(
        SCORED,
        f"""
        , t AS (SELECT count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS real_frauds,
            CAST(sum(CASE WHEN risk_score > 0 AND is_fraud = 1 THEN 1 ELSE 0 END) AS BIGINT)
              AS frauds_caught,
            CAST(sum(CASE WHEN risk_score > 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_flagged FROM scored)
        SELECT real_frauds, frauds_caught, {_pct('frauds_caught', 'real_frauds', 4)} AS recall_pct,
               n_flagged, {_pct('n_flagged', 'n', 4)} AS flagged_pct,
               {_pct('frauds_caught', 'n_flagged', 4)} AS precision_pct
        FROM t
        """,
    ),
    "risk_fraud_crosstab": _with(
        SCORED,
        """
        SELECT risk_level, count(*) FILTER (WHERE is_fraud = 0) AS legit,
               count(*) FILTER (WHERE is_fraud = 1) AS fraud
        FROM scored GROUP BY risk_level
        """,
    ),
    "daily_fraud_breakdown": _with(SCORED, DAY_BREAKDOWN),
    "fraud_hotspots": _with(SCORED, HOTSPOTS.format(where="WHERE is_fraud = 1")),
    "fraud_hotspots_all_txns": _with(SCORED, HOTSPOTS.format(where="")),
    # distributions
    "card_hour_distribution": _with(
        HOURS,
        _describe(
            "CAST(n AS DOUBLE)", {"p50": 0.5, "p90": 0.9, "p95": 0.95, "p99": 0.99}, "hours"
        ),
    ),
    "card_hour_exceedance": _with(
        HOURS, _limits("hours", "n > {k}", (1, 2, 5, 20, 50), "more_than", "pct_of_card_hours")
    ),
    "card_previous_txn": _with(PREVIOUS, "SELECT txn_id, prev_ts, prev_state, gap_min FROM gaps"),
    "state_change_gap_distribution": _with(
        PREVIOUS,
        _describe("gap_min", {"p10": 0.1, "p25": 0.25, "p50": 0.5}, "gaps WHERE changed"),
    ),
    "state_change_share": _with(
        PREVIOUS,
        "SELECT count(*) AS n_transactions, count(*) FILTER (WHERE changed) AS n_state_changes, "
        + _pct("count(*) FILTER (WHERE changed)", "count(*)", 4)
        + " AS pct_of_transactions FROM gaps",
    ),
    "state_change_within": _with(
        PREVIOUS,
        _limits(
            "gaps WHERE changed", "gap_min <= {k}", (5, 10, 15, 30, 600),
            "within_minutes", "pct_of_changes",
        ),
    ),
    "amount_by_label": _with(
        TX, _describe("amount", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, "tx", "is_fraud")
    ),
    "amount_by_label_by_cells": _with(
        TX
        + """, labelled AS (
          SELECT CASE WHEN use_chip = 'signup' THEN 2 ELSE is_fraud END AS is_fraud,
                 CASE WHEN use_chip <> 'signup' AND txn_id % 50 > 3 THEN amount END AS amount FROM tx)""",
        _describe("amount", {"p50": 0.5, "p90": 0.9, "p99": 0.99}, "labelled", "is_fraud"),
    ),
    # windows, order, sampling
    "pick_fraud_window": _with(
        TX + "," + DAILY.format(rows="tx") + "," + WINDOW, "SELECT * FROM best"
    ),
    "pick_fraud_window_years": _with(
        ORDER_DAYS
        + f", cand AS (SELECT * FROM od WHERE year IN {ORDER_YEARS}),"
        + DAILY.format(rows="cand")
        + ","
        + WINDOW,
        "SELECT * FROM best",
    ),
    "order_by_day_time": _with(TX, "SELECT * FROM tx ORDER BY day, time, txn_id"),
    "order_by_card_ts": _with(TX, "SELECT * FROM tx ORDER BY card_id, event_ts, txn_id"),
    "sample_keep_fraud": _with(SAMPLED, "SELECT * EXCLUDE (rn) FROM kept"),
    "sample_keep_fraud_approx": _with(
        TX,
        """
        , sizes AS (SELECT count(*) AS n, sum(is_fraud) AS frauds FROM tx),
        limits AS (SELECT CAST(floor(least(CAST(greatest(4000 - frauds, 0) AS DOUBLE)
                     / CAST(n - frauds AS DOUBLE), 1.0::DOUBLE) * 1152921504606846976.0::DOUBLE) AS BIGINT) AS m FROM sizes)
        SELECT tx.* FROM tx, limits
        WHERE is_fraud = 1 OR CAST('0x' || substr(md5('42|' || txn_id), 1, 15) AS BIGINT) < m
        """,
    ),
    "sample_keep_fraud_sizes": _with(
        SAMPLED, "SELECT is_fraud, count(*) AS n FROM kept GROUP BY is_fraud"
    ),
}

# The same results by the paths for large tables.
for _variant, _name in {
    "card_previous_txn_sliced": "card_previous_txn",
    "card_previous_txn_by_days": "card_previous_txn",
    "card_previous_txn_bucketed": "card_previous_txn",
    "card_stats_by_days": "card_stats",
    "rule_amount_anomaly_by_days": "rule_amount_anomaly",
    "rule_amount_rolling_sliced": "rule_amount_rolling_3d",
    "state_change_gap_distribution_sliced": "state_change_gap_distribution",
    "amount_quantile_by_cells": "amount_quantile",
    "state_change_share_sliced": "state_change_share",
    "state_change_within_sliced": "state_change_within",
    "register_days_evolve": "register_curated_table_merge_schema",
    "risk_level_counts_from_cells": "risk_level_counts",
    "risk_fraud_crosstab_from_cells": "risk_fraud_crosstab",
    "rule_precision_simple_from_cells": "rule_precision_simple",
    "rule_firing_counts_from_cells": "rule_firing_counts",
    "overall_alignment_from_cells": "overall_alignment",
    "gold_tables_risk_level_distribution": "risk_level_distribution",
    "gold_tables_rule_precision": "rule_precision",
    "gold_tables_daily_fraud_breakdown": "daily_fraud_breakdown",
    "gold_tables_fraud_hotspots": "fraud_hotspots",
}.items():
    SQL[_variant] = SQL[_name]
