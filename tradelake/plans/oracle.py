"""The registered queries once more, as plain SQL on the test tables, for checking."""

from __future__ import annotations

# --- Views, written as common table expressions ----------------------------------------

_VIEWS = {
    "places": """
        SELECT n_nationkey, n_name, r_regionkey, r_name
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "trades": """
        SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS trade_id,
               e.event_type,
               CASE WHEN l_quantity = 7 THEN 'X' ELSE 'I' END || l_partkey AS instrument_id,
               CASE WHEN l_quantity = 1 THEN CAST(0 AS DECIMAL(20,4))
                    WHEN l_quantity = 2 THEN NULL
                    ELSE CAST(l_extendedprice AS DECIMAL(20,4)) END AS notional,
               CASE WHEN l_quantity = 3 THEN NULL WHEN l_quantity = 4 THEN 'usd' WHEN l_quantity = 8 THEN 'CHF'
                    WHEN r_name = 'AMERICA' THEN 'USD' WHEN r_name = 'EUROPE' THEN 'EUR'
                    WHEN r_name = 'ASIA' THEN 'JPY' WHEN r_name = 'AFRICA' THEN 'ZAR'
                    ELSE 'AED' END AS currency,
               CAST(o_orderdate AS DATE) AS trade_date,
               CAST(l_shipdate AS DATE) AS settlement_date,
               'T' || l_suppkey AS trader_id,
               'B' || c_nationkey AS book_id,
               'LEI' || lpad(CAST(o_custkey AS VARCHAR), 17, '0') AS counterparty_lei,
               CASE WHEN l_quantity = 5 THEN NULL WHEN l_quantity = 6 THEN 'PENDING'
                    ELSE e.event_type END AS status,
               CAST(o_orderdate AS TIMESTAMP) AS created_at,
               CAST(l_shipdate AS TIMESTAMP) AS updated_at,
               l_partkey AS tie_part, l_suppkey AS tie_supp
        FROM (SELECT *, CASE WHEN l_returnflag = 'N' THEN 'NEW' WHEN l_returnflag = 'A' THEN 'AMEND'
                             WHEN l_linestatus = 'O' THEN 'CANCEL' ELSE 'SETTLE' END AS event_type
              FROM lineitem) e
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN places ON c_nationkey = n_nationkey""",
    "newest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY trade_id, event_type
                ORDER BY updated_at DESC, tie_part, tie_supp) AS rn FROM trades) WHERE rn = 1""",
    "judged": """
        SELECT *, coalesce(trade_id IS NOT NULL AND instrument_id IS NOT NULL
                  AND notional IS NOT NULL AND notional > 0
                  AND regexp_matches(currency, '^[A-Z]{3}$')
                  AND status IN ('NEW','AMEND','CANCEL','SETTLE'), false) AS ok
        FROM newest""",
    "valid": "SELECT * EXCLUDE (ok) FROM judged WHERE ok",
    "instruments": """
        SELECT 'I' || p_partkey AS instrument_id, p_name AS instrument_name,
               CASE p_type WHEN 'ECONOMY' THEN 'EQUITY' WHEN 'SMALL' THEN 'FX'
                    WHEN 'MEDIUM' THEN 'RATES' WHEN 'LARGE' THEN 'CREDIT'
                    WHEN 'STANDARD' THEN 'COMMODITY' ELSE 'OTHER' END AS asset_class,
               CASE WHEN v.old THEN p_brand || '-v1' ELSE p_brand END AS sector,
               'USD' AS currency, NOT v.old AS is_active,
               CASE WHEN v.old OR p_partkey % 2 = 1 THEN TIMESTAMP '1995-01-01'
                    ELSE TIMESTAMP '1998-06-01' END AS valid_from,
               CASE WHEN v.old THEN TIMESTAMP '1998-06-01' END AS valid_to
        FROM part JOIN (VALUES (true), (false)) v(old) ON NOT v.old OR p_partkey % 2 = 0""",
    "traders": """
        SELECT 'T' || s_suppkey AS trader_id, s_name AS trader_name, 'DESK_' || (s_suppkey % 8) AS desk
        FROM supplier""",
    "books": "SELECT 'B' || n_nationkey AS book_id, n_name AS book_name, r_name AS region FROM places",
    "counterparties": """
        SELECT 'LEI' || lpad(CAST(c_custkey AS VARCHAR), 17, '0') AS lei_code,
               c_name AS counterparty_name,
               CASE WHEN c_acctbal < 0 THEN 'C' WHEN c_acctbal < 3000 THEN 'B'
                    WHEN c_acctbal < 6000 THEN 'A' ELSE 'AA' END AS credit_rating
        FROM customer""",
    "fx": """
        SELECT currency, trade_date AS rate_date,
               CAST(CAST(CASE currency WHEN 'USD' THEN 1 WHEN 'EUR' THEN 1.1 WHEN 'JPY' THEN 0.007
                         WHEN 'ZAR' THEN 0.055 ELSE 0.2723 END AS DECIMAL(8,4))
                    * ((1000 + day(trade_date) % 10) * CAST(0.001 AS DECIMAL(4,3)))
                    AS DECIMAL(12,6)) AS usd_rate
        FROM (SELECT DISTINCT currency, trade_date FROM trades
              WHERE currency NOT IN ('usd', 'CHF'))""",
}


def _fact(version: str) -> str:
    return f"""
        SELECT md5(t.trade_id || '-' || t.event_type) AS trade_sk, t.trade_id, t.event_type,
               t.instrument_id, i.instrument_name, i.asset_class, i.sector, t.notional, t.currency,
               f.usd_rate, CAST(t.notional * f.usd_rate AS DECIMAL(20,4)) AS notional_usd,
               t.trade_date, t.settlement_date, t.trader_id, r.trader_name, r.desk, t.book_id,
               b.book_name, b.region, t.counterparty_lei, c.counterparty_name, c.credit_rating,
               t.status, t.created_at, t.updated_at
        FROM valid t
        LEFT JOIN instruments i ON t.instrument_id = i.instrument_id AND {version}
        LEFT JOIN fx f ON t.currency = f.currency AND t.trade_date = f.rate_date
        LEFT JOIN traders r ON t.trader_id = r.trader_id
        LEFT JOIN books b ON t.book_id = b.book_id
        LEFT JOIN counterparties c ON t.counterparty_lei = c.lei_code"""


_VIEWS["fact"] = _fact("t.trade_date >= i.valid_from AND "
                       "(i.valid_to IS NULL OR t.trade_date < i.valid_to)")
_VIEWS["fact_current"] = _fact("i.is_active")
_VIEWS["pnl"] = """
        SELECT trade_date AS report_date, book_id, max(book_name) AS book_name, max(region) AS region,
               asset_class, CAST(sum(notional_usd) AS DECIMAL(20,4)) AS total_notional_usd,
               count(*) AS trade_count, CAST(NULL AS DECIMAL(20,4)) AS realized_pnl_usd
        FROM fact GROUP BY trade_date, book_id, asset_class"""
_VIEWS["changes"] = """
        SELECT instrument_id, instrument_name, asset_class, currency, sector, valid_from AS changed_at
        FROM instruments
        UNION ALL
        SELECT instrument_id, instrument_name, asset_class, currency, sector, TIMESTAMP '1996-03-01'
        FROM instruments WHERE valid_from = TIMESTAMP '1995-01-01'"""
_VIEWS["sides"] = """
        SELECT *, 0 AS src FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, event_type
              ORDER BY updated_at DESC, tie_part, tie_supp) AS rn
              FROM trades WHERE updated_at < TIMESTAMP '1999-07-01') WHERE rn = 1
        UNION ALL
        SELECT * REPLACE (CAST(notional + 1 AS DECIMAL(20,4)) AS notional,
               CASE WHEN event_type = 'SETTLE' THEN updated_at - INTERVAL 200 DAY
                    ELSE updated_at END AS updated_at), 1 AS src
        FROM (SELECT *, row_number() OVER (PARTITION BY trade_id, event_type
              ORDER BY updated_at DESC, tie_part, tie_supp) AS rn
              FROM trades WHERE updated_at >= TIMESTAMP '1998-01-01') WHERE rn = 1"""
_VIEWS["event_text"] = """
        SELECT event_id, ts, epoch_us(ts) // 1000 AS ms, user_id,
               CASE event_id % 3 WHEN 1 THEN 'LEI' || lpad(CAST(user_id AS VARCHAR), 17, '0')
                                 WHEN 2 THEN 'LEI9' || lpad(CAST(user_id AS VARCHAR), 16, '0') END AS lei,
               CAST(value AS DECIMAL(20,4)) AS notional,
               CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 89 = 0 THEN 'short'
                    ELSE 'full' END AS kind
        FROM events"""
_VIEWS["event_json"] = """
        SELECT *, CASE kind WHEN 'bad' THEN '{bad'
                  WHEN 'short' THEN '{"tradeId":"E' || event_id || '"}'
                  ELSE '{"tradeId":"E' || event_id || '","instrumentId":"I' || user_id
                       || '","notional":' || notional || ',"currency":"USD","eventTimestamp":'
                       || ms || coalesce(',"counterpartyLei":"' || lei || '"', '') || '}' END AS raw,
               CASE WHEN kind = 'full' THEN make_timestamp(ms * 1000) ELSE ts END AS event_ts
        FROM event_text"""
_VIEWS["event_ok"] = """
        SELECT 'E' || event_id AS trade_id, 'I' || user_id AS instrument_id, notional,
               'USD' AS currency, event_ts, raw, ms, lei FROM event_json WHERE kind = 'full'"""
_VIEWS["win"] = """
        SELECT time_bucket(INTERVAL 5 MINUTE, event_ts, TIMESTAMP '1970-01-01') AS window_start,
               time_bucket(INTERVAL 5 MINUTE, event_ts, TIMESTAMP '1970-01-01')
                   + INTERVAL 5 MINUTE AS window_end,
               instrument_id, CAST(sum(notional) AS DECIMAL(20,4)) AS total_notional,
               count(*) AS trade_count
        FROM event_ok GROUP BY ALL"""
_VIEWS["closed"] = """
        SELECT * FROM win
        WHERE window_end <= (SELECT max(event_ts) FROM event_ok) - INTERVAL 10 SECOND"""
_VIEWS["confirms"] = """
        SELECT 'C' || trade_id || '-' || tie_part || '-' || tie_supp AS trade_id,
               trade_id AS our_ref, 'IS' || tie_part AS instrument_isin, notional,
               coalesce(currency, '') AS currency, CAST(trade_date AS VARCHAR) AS trade_date,
               CAST(settlement_date AS VARCHAR) AS settlement_date, counterparty_lei,
               CAST(1.5 AS DECIMAL(20,4)) AS price,
               CASE WHEN event_type = 'NEW' THEN 'BUY' ELSE 'SELL' END AS direction,
               book_id AS source_file_id,
               CASE WHEN notional IS NULL THEN 'Bad number: notional' END AS error
        FROM trades"""
_VIEWS["theirs"] = """
        SELECT trade_id AS their_ref,
               nullif(CASE day(CAST(settlement_date AS DATE)) WHEN 1 THEN '' WHEN 2 THEN 'X' || our_ref
                      ELSE our_ref END, '') AS our_ref,
               CASE day(CAST(settlement_date AS DATE)) WHEN 3 THEN CAST(notional + 1 AS DECIMAL(20,4))
                    ELSE notional END AS their_notional,
               CASE day(CAST(settlement_date AS DATE)) WHEN 4 THEN 'CHF'
                    ELSE nullif(currency, '') END AS their_currency,
               CASE day(CAST(settlement_date AS DATE)) WHEN 5 THEN 1.6 ELSE 1.5 END::DECIMAL(20,4) AS their_price
        FROM confirms"""
_VIEWS["ours"] = """
        SELECT trade_id AS our_ref, notional AS our_notional, currency AS our_currency,
               event_type FROM (
            SELECT *, row_number() OVER (PARTITION BY trade_id
                ORDER BY updated_at DESC, event_type DESC) AS r FROM newest) WHERE r = 1"""

_NEEDS = {
    "places": [], "trades": ["places"], "newest": ["trades"], "judged": ["newest"],
    "valid": ["judged"], "instruments": [], "traders": [], "books": ["places"],
    "counterparties": [], "fx": ["trades"],
    "fact": ["valid", "instruments", "traders", "books", "counterparties", "fx"],
    "fact_current": ["valid", "instruments", "traders", "books", "counterparties", "fx"],
    "pnl": ["fact"], "changes": ["instruments"], "sides": ["trades"], "event_text": [],
    "event_json": ["event_text"], "event_ok": ["event_json"], "win": ["event_ok"],
    "closed": ["win"], "confirms": ["trades"], "theirs": ["confirms"], "ours": ["newest"],
}


def _with(sql: str, *views: str) -> str:
    """``sql`` preceded by the views it needs, each after those it builds on."""
    order: list[str] = []

    def add(name):
        for base in _NEEDS[name]:
            add(base)
        if name not in order:
            order.append(name)

    for view in views:
        add(view)
    ctes = ",\n".join(f"{name} AS ({_VIEWS[name]})" for name in order)
    return f"WITH {ctes}\n{sql}"


ORACLE: dict[str, str] = {}


def _add(name: str, sql: str, *views: str) -> None:
    ORACLE[name] = _with(sql, *views) if views else sql


# --- Batch lane ----------------------------------------------------------------------------

_add("read_raw_by_date",
     "SELECT * EXCLUDE (tie_part, tie_supp) FROM trades WHERE trade_date = DATE '1998-06-01'",
     "trades")
ORACLE["read_raw_partition"] = ORACLE["read_raw_by_date"]
_add("read_dim_columns", "SELECT p_partkey, p_name, p_type FROM part")
_add("dedup_latest", "SELECT * FROM newest", "newest")
_add("validate_valid", "SELECT * FROM valid", "valid")
_add("validate_invalid", """
    SELECT * EXCLUDE (ok), 'FAILED_DQ_CHECK' AS quarantine_reason,
           concat_ws(',', CASE WHEN notional IS NULL THEN 'notional_present' END,
                     CASE WHEN notional > 0 THEN NULL ELSE 'notional_positive' END,
                     CASE WHEN regexp_matches(currency, '^[A-Z]{3}$') THEN NULL
                          ELSE 'currency_iso' END,
                     CASE WHEN status IN ('NEW','AMEND','CANCEL','SETTLE') THEN NULL
                          ELSE 'status_known' END) AS failed_checks
    FROM judged WHERE NOT ok""", "judged")
_add("run_metrics", """
    SELECT count(*) FILTER (ok) AS valid_count, count(*) FILTER (NOT ok) AS quarantined_count
    FROM judged""", "judged")
_add("enrich_instruments", """
    SELECT t.*, i.instrument_name, i.asset_class, i.sector
    FROM valid t LEFT JOIN instruments i ON t.instrument_id = i.instrument_id AND i.is_active""",
     "valid", "instruments")
_GUARDED = """
    SELECT * EXCLUDE (rn, src, pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY trade_id, event_type
            ORDER BY updated_at DESC, src) AS pick FROM sides) WHERE pick = 1"""
_add("upsert_guarded", _GUARDED, "sides")
_add("upsert_table", _GUARDED, "sides")
_add("upsert_unguarded", """
    SELECT * EXCLUDE (rn, src, pick) FROM (
        SELECT *, row_number() OVER (PARTITION BY trade_id, event_type ORDER BY src DESC) AS pick
        FROM sides) WHERE pick = 1""", "sides")
ORACLE["upsert_table_unguarded"] = ORACLE["upsert_unguarded"]
_add("trades_as_of", """
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY trade_id, event_type
            ORDER BY updated_at DESC, tie_part, tie_supp) AS rn
        FROM trades WHERE updated_at <= TIMESTAMP '1999-01-01') WHERE rn = 1""", "trades")
_add("backlog_gate", """
    SELECT landed, curated, landed - curated AS backlog, landed - curated <= 10000 AS proceed
    FROM (SELECT (SELECT count(*) FROM trades) AS landed, (SELECT count(*) FROM valid) AS curated)""",
     "valid")

# --- Warehouse lane ------------------------------------------------------------------------------

_add("incremental_slice", """
    SELECT * FROM trades WHERE updated_at >
        (SELECT max(updated_at) FROM trades WHERE updated_at < TIMESTAMP '2000-01-01')""", "trades")
_add("incremental_slice_lookback", """
    SELECT * FROM trades WHERE updated_at >
        (SELECT max(updated_at) - INTERVAL 30 DAY FROM trades
         WHERE updated_at < TIMESTAMP '2000-01-01')""", "trades")
_add("fct_trades", "SELECT * FROM fact", "fact")
_add("fct_trades_current_dims", "SELECT * FROM fact_current", "fact_current")
_add("fct_trades_audited", """
    SELECT 'run-1' AS dbt_invocation_id, count(*) AS rows, count(*) AS stamped FROM fact""", "fact")
_add("trade_surrogate_key", """
    SELECT md5(trade_id || '-' || event_type) AS trade_sk,
           md5(trade_id || '-' || coalesce(status, '_dbt_utils_surrogate_key_null_')) AS status_sk,
           trade_id, event_type FROM newest""", "newest")
_add("dim_instruments_scd2", """
    SELECT md5(instrument_id || '-' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS instrument_sk,
           instrument_id, instrument_name, asset_class, sector, currency, valid_from, valid_to,
           valid_to IS NULL AS is_active
    FROM (SELECT *, lead(valid_from) OVER (PARTITION BY instrument_id ORDER BY valid_from) AS valid_to
          FROM (SELECT * EXCLUDE (changed_at, before), changed_at AS valid_from
                FROM (SELECT *, lag(sector) OVER (PARTITION BY instrument_id ORDER BY changed_at)
                             AS before FROM changes)
                WHERE before IS DISTINCT FROM sector))""", "changes")
_add("trade_status_history", """
    WITH states AS (
        SELECT trade_id, updated_at AS valid_from,
               max({'a': coalesce(status, ''), 'b': coalesce(currency, '')}) AS s
        FROM trades GROUP BY ALL),
    changed AS (
        SELECT * FROM (SELECT *, lag(s) OVER (PARTITION BY trade_id ORDER BY valid_from) AS before,
                              row_number() OVER (PARTITION BY trade_id ORDER BY valid_from) AS n
                       FROM states) WHERE n = 1 OR before <> s)
    SELECT trade_id, nullif(s.a, '') AS status, nullif(s.b, '') AS currency, valid_from,
           lead(valid_from) OVER w AS valid_to, lead(valid_from) OVER w IS NULL AS is_active
    FROM changed WINDOW w AS (PARTITION BY trade_id ORDER BY valid_from)""".replace(
    "    WITH states AS", "    , states AS", 1), "trades")
_add("overlapping_versions", """
    SELECT instrument_id, valid_from, valid_to, versions, next_valid_from FROM (
        SELECT *, lead(valid_from) OVER (PARTITION BY instrument_id ORDER BY valid_from)
                  AS next_valid_from
        FROM (SELECT 'I' || l_partkey AS instrument_id, CAST(l_shipdate AS TIMESTAMP) AS valid_from,
                     max(CAST(l_shipdate AS TIMESTAMP) + INTERVAL 60 DAY) AS valid_to,
                     count(*) AS versions
              FROM lineitem GROUP BY 1, 2))
    WHERE versions > 1 OR next_valid_from < valid_to""")
_add("asof_instrument", """
    SELECT t.trade_id, t.event_type, t.instrument_id, t.trade_date, i.instrument_name,
           i.asset_class, i.sector
    FROM valid t LEFT JOIN instruments i ON t.instrument_id = i.instrument_id
         AND t.trade_date >= i.valid_from AND (i.valid_to IS NULL OR t.trade_date < i.valid_to)""",
     "valid", "instruments")
ORACLE["asof_instrument_carried"] = ORACLE["asof_instrument"]
_add("current_instrument", """
    SELECT t.trade_id, t.event_type, t.instrument_id, i.instrument_name, i.sector
    FROM valid t LEFT JOIN instruments i ON t.instrument_id = i.instrument_id AND i.is_active""",
     "valid", "instruments")
_add("daily_pnl", "SELECT * FROM pnl", "pnl")
_add("load_times", """
    SELECT 'instruments' AS table_name, count(*) AS rows, count(*) AS stamped, count(*) FILTER (instrument_id = 'I1' AND is_active) AS kept FROM instruments
    UNION ALL SELECT 'daily_pnl', count(*), count(*), 0 FROM pnl""", "instruments", "pnl")
_add("daily_pnl_custom", """
    SELECT trade_date AS report_date, book_id, max(book_name) AS book_name, max(region) AS region,
           asset_class, CAST(sum(notional_usd) AS DECIMAL(20,4)) AS total_notional_usd,
           count(*) AS trade_count,
           CAST(sum(notional_usd) FILTER (status = 'SETTLE') AS DECIMAL(20,4)) AS realized_pnl_usd
    FROM fact WHERE status <> 'CANCEL' GROUP BY trade_date, book_id, asset_class""", "fact")
_add("daily_pnl_region", """
    SELECT * FROM pnl WHERE report_date = DATE '1998-06-01' AND region = 'ASIA'""", "pnl")
_add("daily_notional_by_class", """
    SELECT trade_date, region, asset_class,
           CAST(sum(notional_usd) AS DECIMAL(20,4)) AS total_notional_usd, count(*) AS trade_count
    FROM fact GROUP BY trade_date, region, asset_class""", "fact")
_add("daily_pnl_table", """
    SELECT CAST(date_trunc('year', trade_date) AS DATE) AS report_date, book_id,
           max(book_name) AS book_name, max(region) AS region, asset_class,
           CAST(sum(notional_usd) AS DECIMAL(20,4)) AS total_notional_usd, count(*) AS trade_count,
           CAST(NULL AS DECIMAL(20,4)) AS realized_pnl_usd
    FROM fact GROUP BY 1, book_id, asset_class""", "fact")

# --- Layouts ---------------------------------------------------------------------------------------

_YEARLY = """
    SELECT t.* EXCLUDE (tie_part, tie_supp)
               REPLACE (CAST(date_trunc('year', t.trade_date) AS DATE) AS trade_date),
           i.instrument_name, i.asset_class, i.sector
    FROM valid t LEFT JOIN instruments i ON t.instrument_id = i.instrument_id AND i.is_active"""
_add("curated_layout", _YEARLY, "valid", "instruments")
_add("compact_preserves_rows", _YEARLY, "valid", "instruments")
_add("expired_partitions", """
    SELECT DISTINCT CAST(date_trunc('year', trade_date) AS DATE) AS trade_date FROM valid
    WHERE date_trunc('year', trade_date) < DATE '1998-06-30' - INTERVAL 365 DAY""", "valid")
_add("quarantine_layout", """
    SELECT DATE '1998-06-01' AS process_date, 'FAILED_DQ_CHECK' AS quarantine_reason,
           count(*) AS rows FROM judged WHERE NOT ok""", "judged")
_add("sorted_layout", "SELECT * FROM fact", "fact")
_add("sorted_layout_bounds", "SELECT count(*) AS rows, 0::BIGINT AS overlaps FROM trades", "trades")
_add("bucketed_layout", "SELECT trade_id, count(*) AS events FROM fact GROUP BY trade_id", "fact")
_add("union_evolving", """
    SELECT * EXCLUDE (tie_part, tie_supp)
           REPLACE (CASE WHEN trade_date >= DATE '1998-01-01' THEN status END AS status)
    FROM trades""", "trades")
_add("replay_hours", """
    SELECT trade_id, instrument_id, notional, event_ts FROM event_ok
    WHERE event_ts >= TIMESTAMP '2024-01-05 06:30:00'
      AND event_ts < TIMESTAMP '2024-01-09 17:15:00'""", "event_ok")

# --- Quality ---------------------------------------------------------------------------------------


def _suite(table: str, checks: dict[str, str], uniques: dict[str, str]) -> str:
    parts = [f"SELECT '{name}' AS test, count(*) FILTER ({cond}) AS failures FROM {table}"
             for name, cond in checks.items()]
    parts += [f"SELECT '{name}' AS test, count(*) AS failures FROM "
              f"(SELECT {cols} FROM {table} {where} GROUP BY {cols} HAVING count(*) > 1)"
              for name, (cols, where) in uniques.items()]
    return ("SELECT test, failures, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status "
            "FROM (" + " UNION ALL ".join(parts) + ")")


_LIFE = "('NEW','AMEND','CANCEL','SETTLE')"
_FACT_CHECKS = {
    "not_null_trade_sk": "trade_sk IS NULL",
    "not_null_trade_id": "trade_id IS NULL",
    "not_null_event_type": "event_type IS NULL",
    "accepted_values_event_type": f"event_type NOT IN {_LIFE}",
    "not_null_notional": "notional IS NULL",
    "at_least_notional": "notional < 0",
    "not_null_notional_usd": "notional_usd IS NULL AND currency <> 'USD'",
    "not_null_currency": "currency IS NULL",
    "matches_currency": "NOT regexp_matches(currency, '^[A-Z]{3}$')",
    "not_null_trade_date": "trade_date IS NULL",
    "on_or_after_trade_date": "trade_date < DATE '2020-01-01'",
    "holds_settlement_not_before_trade": "settlement_date < trade_date",
    "not_null_status": "status IS NULL",
    "accepted_values_status": f"status NOT IN {_LIFE}",
}
_FACT_UNIQUE = {"unique_trade_sk": ("trade_sk", "WHERE trade_sk IS NOT NULL")}
_add("dq_fct_trades", _suite("fact", _FACT_CHECKS, _FACT_UNIQUE), "fact")
_add("dq_raw_trades", _suite(
    "(SELECT *, md5(trade_id || '-' || event_type) AS trade_sk, notional AS notional_usd FROM trades)",
    _FACT_CHECKS, _FACT_UNIQUE), "trades")
_INSTRUMENTS_SK = ("(SELECT *, md5(instrument_id || '-' || strftime(valid_from, "
                   "'%Y-%m-%d %H:%M:%S')) AS instrument_sk, CAST(NULL AS VARCHAR) AS isin, "
                   "CAST(NULL AS VARCHAR) AS issuer FROM instruments)")
_SK_UNIQUE = {"unique_instrument_sk": ("instrument_sk", "WHERE instrument_sk IS NOT NULL")}
_add("dq_dim_instruments", _suite(_INSTRUMENTS_SK, {
    "not_null_instrument_sk": "instrument_sk IS NULL",
    "not_null_instrument_id": "instrument_id IS NULL",
    "not_null_asset_class": "asset_class IS NULL",
    "accepted_values_asset_class":
        "asset_class NOT IN ('EQUITY','FX','RATES','CREDIT','COMMODITY')",
    "not_null_currency": "currency IS NULL",
}, _SK_UNIQUE), "instruments")
_add("dq_daily_pnl", _suite("pnl", {
    "not_null_report_date": "report_date IS NULL",
    "not_null_book_id": "book_id IS NULL",
    "at_least_total_notional_usd": "total_notional_usd < 0",
}, {"unique_report_date_book_id_asset_class": ("report_date, book_id, asset_class", "")}), "pnl")
_add("dq_schema_constraints", _suite(_INSTRUMENTS_SK, {
    **{f"not_null_{c}": f"{c} IS NULL" for c in
       ("instrument_sk", "instrument_id", "instrument_name", "asset_class", "currency",
        "valid_from")},
    **{f"max_length_{c}": f"length({c}) > {n}" for c, n in
       (("instrument_id", 50), ("instrument_name", 200), ("isin", 12), ("asset_class", 50),
        ("sector", 100), ("issuer", 200), ("currency", 3))},
}, _SK_UNIQUE), "instruments")
_add("dq_fact_schema_constraints", _suite("fact", {
    **{f"not_null_{c}": f"{c} IS NULL" for c in ("trade_sk", "trade_id", "event_type",
                                                 "trade_date")},
    **{f"max_length_{c}": f"length({c}) > {n}" for c, n in
       (("trade_id", 100), ("event_type", 50), ("instrument_id", 50), ("instrument_name", 200),
        ("asset_class", 50), ("sector", 100), ("currency", 3), ("trader_id", 50),
        ("trader_name", 200), ("desk", 100), ("book_id", 50), ("book_name", 200), ("region", 50),
        ("counterparty_lei", 20), ("counterparty_name", 200), ("credit_rating", 10),
        ("status", 50))},
}, _FACT_UNIQUE), "fact")
_DIM_TABLES = {
    "traders": ("""(SELECT md5('T' || s_suppkey) AS trader_sk, 'T' || s_suppkey AS trader_id, s_name AS trader_name,
                    'DESK_' || (s_suppkey % 8) AS desk, r_name AS region, CAST(NULL AS VARCHAR) AS cost_centre,
                    TIMESTAMP '1995-01-01' AS valid_from FROM supplier JOIN places ON s_nationkey = n_nationkey)""",
                ["trader_sk", "trader_id", "trader_name", "valid_from"],
                {"trader_id": 50, "trader_name": 200, "desk": 100, "region": 50, "cost_centre": 50}, ["trader_sk"]),
    "books": ("""(SELECT md5('B' || n_nationkey) AS book_sk, 'B' || n_nationkey AS book_id, n_name AS book_name,
                  r_name AS region, 'LE_' || r_regionkey AS legal_entity FROM places)""",
              ["book_sk", "book_id"], {"book_id": 50, "book_name": 200, "region": 50, "legal_entity": 100}, ["book_sk"]),
    "counterparties": ("""(SELECT md5(lei_code) AS counterparty_sk, *, '' AS country FROM counterparties)""",
                       ["counterparty_sk", "lei_code"],
                       {"lei_code": 20, "counterparty_name": 200, "credit_rating": 10, "country": 50}, ["counterparty_sk"]),
    "fx_rates": ("fx", ["currency", "rate_date"], {"currency": 3}, ["currency", "rate_date"]),
}
_add("dq_dim_schema_constraints", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, * FROM (" + _suite(table, {
        **{f"not_null_{c}": f"{c} IS NULL" for c in needed},
        **{f"max_length_{c}": f"length({c}) > {n}" for c, n in longest.items()},
    }, {"unique_" + "_".join(pk): (", ".join(pk), "")}) + ")"
    for name, (table, needed, longest, pk) in _DIM_TABLES.items()), "places", "counterparties", "fx")
_add("source_freshness", """
    SELECT source, (SELECT max(updated_at) FROM trades) AS max_loaded_at, status
    FROM (VALUES ('a_equal_warn', 'pass'), ('b_past_warn', 'warn'), ('c_past_error', 'error'),
                 ('d_fresh', 'pass')) v(source, status)""", "trades")
_add("failed_publishes", """
    SELECT CASE WHEN kind = 'short' THEN 'E' || event_id END AS key,
           CASE WHEN kind = 'short' THEN '{"trade_id":"E' || event_id || '"' ELSE '{"trade_id":null' END
           || ',"instrument_id":null,"notional":null}' AS value, 0 AS headers
    FROM event_json WHERE kind <> 'full'""", "event_json")
_add("table_statistics", """
    SELECT 'rows' AS about, count(*) AS rows, CAST(NULL AS BIGINT) AS nulls FROM part
    UNION ALL SELECT 'p_partkey', NULL, 0
    UNION ALL SELECT 'p_size', NULL, count(*) FILTER (p_size <= 10) FROM part""")
_add("publishable_events", """
    SELECT CASE WHEN kind = 'full' THEN 'publish' ELSE 'dead_letter' END AS route, count(*) AS rows
    FROM event_json GROUP BY 1""", "event_json")

# --- Events -------------------------------------------------------------------------------------------

_add("parse_events_valid", """
    SELECT trade_id, instrument_id, notional, currency, CAST(event_ts AS DATE) AS trade_date,
           event_ts, event_ts AS updated_at, raw FROM event_ok""", "event_ok")
_REASON = """CASE kind WHEN 'bad' THEN 'Malformed JSON'
           ELSE 'Missing fields: {currency, eventTimestamp, instrumentId, notional}' END"""
_add("parse_events_invalid", f"""
    SELECT CASE WHEN kind = 'short' THEN 'E' || event_id END AS trade_id, {_REASON} AS reason,
           raw, event_ts FROM event_json WHERE kind <> 'full'""", "event_json")
_add("dead_letters", f"""
    SELECT CASE WHEN kind = 'short' THEN 'E' || event_id END AS key,
           '{{"valid":false,"reason":"' || {_REASON} || '","raw":"' || replace(raw, '"', '\\"')
           || '"}}' AS value
    FROM event_json WHERE kind <> 'full'""", "event_json")
_add("notional_5m", "SELECT * FROM win", "win")
_add("enrich_stream_batchwise", """
    SELECT e.trade_id, e.instrument_id,
           coalesce(i.instrument_name, 'INSTRUMENT_' || e.instrument_id) AS instrument_name,
           i.asset_class, c.counterparty_name, e.notional
    FROM event_ok e LEFT JOIN instruments i ON e.instrument_id = i.instrument_id AND i.is_active
    LEFT JOIN counterparties c ON e.lei = c.lei_code""",
     "event_ok", "instruments", "counterparties")
_add("keyed_envelope", """
    SELECT instrument_id AS key,
           '{"trade_id":"' || trade_id || '","instrument_id":"' || instrument_id
           || '","notional":' || notional || ',"currency":"USD","book_id":null,"event_ms":' || ms
           || '}' AS value,
           'correlationId=' || md5(trade_id) || ';sourceSystem=LAKE;schemaVersion=v1' AS headers
    FROM event_ok""", "event_ok")

_add("sequenced_envelope", """
    SELECT instrument_id AS key, trade_id, row_number() OVER (PARTITION BY instrument_id ORDER BY ms, trade_id) AS sequence
    FROM event_ok""", "event_ok")

# --- Reads -----------------------------------------------------------------------------------------------

_ROW = """trade_id, instrument_id, instrument_name, asset_class, notional, notional_usd, currency,
          trade_date, {}trader_id, desk, book_id, counterparty_name, credit_rating, status,
          event_type"""
_add("search_trades", f"""
    SELECT {_ROW.format('')} FROM fact
    WHERE trade_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
      AND asset_class = 'RATES' AND desk = 'DESK_3'
    ORDER BY trade_id, event_type LIMIT 50""", "fact")
_add("search_trades_after_cursor", """
    SELECT trade_id, event_type, notional_usd FROM fact
    WHERE trade_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31' AND status = 'NEW'
      AND (trade_id, event_type) > ('2', 'NEW')
    ORDER BY trade_id, event_type LIMIT 1000""", "fact")
_add("search_connection", """
    , hits AS (SELECT trade_id, event_type, row_number() OVER (ORDER BY trade_id, event_type) AS n
               FROM fact WHERE trade_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'
               AND book_id = 'B3')
    SELECT string_agg(trade_id, ',' ORDER BY n) FILTER (n <= 20) AS trade_ids,
           count(*) FILTER (n <= 20) AS page_count, count(*) > 20 AS has_next_page,
           CASE WHEN count(*) > 20 THEN max(trade_id) FILTER (n = 20) END AS cursor_trade_id,
           CASE WHEN count(*) > 20 THEN max(event_type) FILTER (n = 20) END AS cursor_event_type
    FROM hits""", "fact")
_add("search_trades_page", """
    SELECT trade_id, event_type FROM fact
    WHERE trade_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    ORDER BY trade_id, event_type LIMIT 100 OFFSET 700""", "fact")
_add("search_trades_deep_page", """
    SELECT trade_id, event_type FROM fact
    WHERE trade_date BETWEEN DATE '1995-01-01' AND DATE '2001-12-31'
    ORDER BY trade_id, event_type LIMIT 1000 OFFSET 40000""", "fact")
_add("api_trade_rows", f"SELECT {_ROW.format('settlement_date, ')} FROM fact", "fact")
_add("api_instrument_rows", """
    SELECT instrument_id, instrument_name, asset_class, sector, currency, is_active
    FROM instruments""", "instruments")
_add("find_trade", """
    SELECT trade_id, event_type, status, notional FROM fact WHERE trade_id = '1000-1'
    ORDER BY updated_at DESC, event_type DESC LIMIT 1""", "fact")
_add("find_instrument", """
    SELECT instrument_id, instrument_name, asset_class, sector, currency, is_active
    FROM instruments WHERE is_active AND instrument_id = 'I102'""", "instruments")
_add("trade_lifecycle", """
    SELECT trade_id, string_agg(strftime(updated_at, '%Y-%m-%d') || ':' || event_type, ','
                                ORDER BY updated_at, event_type) AS steps
    FROM newest GROUP BY trade_id""", "newest")
_add("trade_lifecycle_raw", """
    SELECT trade_id, string_agg(strftime(updated_at, '%Y-%m-%d') || ':' || event_type, ','
                                ORDER BY updated_at, event_type) AS steps
    FROM trades WHERE trade_id IS NOT NULL GROUP BY trade_id""", "trades")
_add("lifecycle_steps", """
    SELECT trade_id, updated_at, event_type, status, notional FROM trades
    WHERE trade_id IS NOT NULL""", "trades")
_add("latest_trade_state", """
    SELECT trade_id, event_type, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY trade_id
            ORDER BY updated_at DESC, event_type DESC) AS r FROM newest) WHERE r = 1""", "newest")
_RECENT = """
    SELECT instrument_id, position, trade_id, event_type, trade_date FROM (
        SELECT *, row_number() OVER (PARTITION BY instrument_id
            ORDER BY trade_date DESC, trade_id, event_type) AS position
        FROM fact WHERE trade_date > DATE '1998-12-31' - 365 AND trade_date <= DATE '1998-12-31')
    WHERE position <= 3"""
_add("recent_trades_per_instrument", _RECENT.replace("position,", "CAST(position AS INTEGER) AS position,", 1),
     "fact")
_add("instruments_nested", f"""
    SELECT i.instrument_id, i.instrument_name, i.is_active, coalesce(r.recent, '') AS recent
    FROM instruments i LEFT JOIN (
        SELECT instrument_id, string_agg(trade_id || '/' || event_type, ',' ORDER BY position) AS recent
        FROM ({_RECENT}) GROUP BY instrument_id) r ON i.instrument_id = r.instrument_id
    WHERE i.is_active""", "fact", "instruments")

# --- Confirmations -------------------------------------------------------------------------------------------

_add("confirmations_csv", "SELECT * FROM confirms", "confirms")
_add("confirmations_fpml", "SELECT * FROM confirms", "confirms")
_add("confirmations_fpml_odd", """
    SELECT *, NULL::VARCHAR AS reason FROM confirms
    UNION ALL BY NAME
    SELECT '' AS trade_id, '' AS our_ref, '' AS instrument_isin, 0::DECIMAL(20,4) AS notional, '' AS currency, '' AS trade_date,
           '' AS settlement_date, '' AS counterparty_lei, 0::DECIMAL(20,4) AS price, 'BUY' AS direction, source_file_id
    FROM (SELECT DISTINCT source_file_id, trade_date[1:4] FROM confirms)
    UNION ALL BY NAME
    SELECT DISTINCT source_file_id, 'MALFORMED_XML' AS reason FROM confirms""", "confirms")
_add("confirmations_csv_multiline", """
    SELECT * REPLACE (CASE WHEN trade_date LIKE '%3' THEN direction || ',' || chr(10) || '"side"' || chr(10)
                           ELSE direction END AS direction) FROM confirms""", "confirms")
_add("confirmations_mapped_csv", """
    SELECT trade_id, our_ref, notional, currency, CAST(0 AS DECIMAL(20,4)) AS price,
           '' AS direction, error FROM confirms""", "confirms")
_add("new_files", """
    WITH arrivals AS (SELECT 'F' || o_custkey AS file_id, CAST(o_orderdate AS TIMESTAMP) AS received_at,
                             CAST(o_orderkey AS VARCHAR) AS path, o_custkey FROM orders),
    done AS (SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
    ranked AS (SELECT a.*, d.c_custkey IS NOT NULL AS known,
                      row_number() OVER (PARTITION BY file_id ORDER BY received_at, path) AS n
               FROM arrivals a LEFT JOIN done d ON a.o_custkey = d.c_custkey)
    SELECT file_id, received_at, path, 'NEW' AS outcome, CAST(1 AS BIGINT) AS copies
    FROM ranked WHERE NOT known AND n = 1
    UNION ALL
    SELECT file_id, NULL, NULL, 'DUPLICATE', count(*) FROM ranked WHERE known OR n > 1
    GROUP BY file_id""")
_add("checksums", """
    SELECT DISTINCT book_id AS sender,
           CASE WHEN book_id = 'B0' THEN 'CHECKSUM_MISMATCH' ELSE 'SOUND' END AS outcome
    FROM trades""", "trades")
_add("file_outcomes", """
    SELECT source_file_id AS sender,
           CASE WHEN source_file_id IN ('B0', 'B1', 'B2') THEN 'REJECTED'
                WHEN count(error) > 0 THEN 'PARTIAL' ELSE 'COMPLETE' END AS status,
           CASE WHEN source_file_id IN ('B0', 'B1', 'B2') THEN 0
                ELSE count(*) - count(error) END AS processed,
           CASE WHEN source_file_id IN ('B0', 'B1', 'B2') THEN 0 ELSE count(error) END AS failed,
           CASE source_file_id WHEN 'B0' THEN 'CHECKSUM_MISMATCH'
                WHEN 'B1' THEN 'Format not implemented: MT518'
                WHEN 'B2' THEN 'Unsupported file format: FIX' END AS reason
    FROM confirms GROUP BY source_file_id""", "confirms")
_add("reconcile_confirmations", """
    , met AS (
        SELECT coalesce(t.our_ref, o.our_ref) AS our_ref, t.their_ref, o.our_ref IS NOT NULL AS found,
               t.their_ref IS NOT NULL AS confirmed, our_notional, their_notional,
               our_currency, their_currency, CASE WHEN o.our_ref IS NOT NULL THEN 1.5::DECIMAL(20,4) END AS our_price, their_price,
               our_notional IS DISTINCT FROM their_notional AS amount_off,
               our_currency IS DISTINCT FROM their_currency AS currency_off, their_price <> 1.5 AS price_off
        FROM theirs t FULL JOIN ours o ON t.our_ref = o.our_ref)
    SELECT our_ref, their_ref,
           CASE WHEN NOT found THEN 'MISSING_OURS' WHEN NOT confirmed THEN 'MISSING_THEIRS'
                WHEN amount_off OR currency_off OR price_off THEN 'BREAK' ELSE 'MATCHED' END AS status,
           CASE WHEN NOT found OR NOT confirmed THEN ''
                ELSE concat_ws(',', CASE WHEN amount_off THEN 'notional' END, CASE WHEN currency_off THEN 'currency' END,
                               CASE WHEN price_off THEN 'price' END) END AS breaks,
           our_notional, their_notional, our_currency, their_currency, our_price, their_price
    FROM met""", "theirs", "ours")
_add("confirmation_ledger", """
    SELECT source_file_id AS sender, 'RECEIVED' AS state, 1::BIGINT AS entries, NULL::BIGINT AS processed, NULL::BIGINT AS failed
    FROM confirms GROUP BY 1
    UNION ALL
    SELECT source_file_id, 'COMPLETED', 1, count(*) FILTER (error IS NULL), count(error) FROM confirms GROUP BY 1""", "confirms")
_add("confirmation_messages", """
    SELECT trade_id AS key, our_ref, currency,
           'sourceSystem=FILE_GATEWAY;senderDuns=' || source_file_id || ';sourceFileId='
           || source_file_id || ';schemaVersion=v1' AS headers
    FROM confirms WHERE error IS NULL""", "confirms")

# --- Streams ---------------------------------------------------------------------------------------------------

_add("stream_notional_5m", "SELECT * FROM closed", "closed")
_add("stream_start_all", """
    SELECT 'dead_letters' AS output, count(*) AS rows, CAST(NULL AS DECIMAL(20,4)) AS notional
    FROM event_json WHERE kind <> 'full'
    UNION ALL SELECT 'raw', count(*), CAST(sum(notional) AS DECIMAL(20,4)) FROM event_ok
    UNION ALL SELECT 'metrics', CAST(sum(trade_count) AS BIGINT),
                     CAST(sum(total_notional) AS DECIMAL(20,4)) FROM closed""", "closed")
_add("stream_late_data", """
    SELECT 'raw' AS output, 2 * count(*) AS rows FROM event_ok
    UNION ALL SELECT 'windows', CAST(sum(trade_count) AS BIGINT) FROM closed""", "closed")
_add("stream_late_rows", """
    SELECT count(*) AS dropped FROM (SELECT DISTINCT CAST(trade_id[2:] AS BIGINT) % 104, instrument_id,
        time_bucket(INTERVAL 5 MINUTE, event_ts, TIMESTAMP '1970-01-01') FROM event_ok)""", "event_ok")
_add("stream_upsert", """
    SELECT instrument_id AS trade_id, 'NEW' AS event_type, notional, currency,
           event_ts AS updated_at
    FROM (SELECT *, row_number() OVER (PARTITION BY instrument_id ORDER BY event_ts DESC, notional)
                 AS r FROM event_ok) WHERE r = 1""", "event_ok")
_add("stream_redelivery", """
    SELECT trade_id, instrument_id, notional, event_ts FROM event_ok""", "event_ok")
