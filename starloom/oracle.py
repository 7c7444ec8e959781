"""Independent SQL statements of the registered queries, for comparison in another engine."""

from __future__ import annotations

NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"

# ------------------------------------------------------------------ shared parts
RX_FACT = """
fact AS (
  SELECT o_custkey AS person, l_partkey AS part_key, c_nationkey AS place,
         CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y-%m') AS year_month,
         CAST(l_quantity AS BIGINT) AS trx, p_brand, p_type,
         CAST(substr(p_brand, 7) AS INTEGER) <= 10 AS own
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN customer ON o_custkey = c_custkey
)"""

CONTACTS = """
contact AS (
  SELECT event_id, user_id, CAST(ts AS DATE) AS day, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
)"""

SCRIPTS_AND_CALLS = CONTACTS + """,
rx AS (
  SELECT user_id, day, CAST(sum(floor(value)) AS BIGINT) AS trx
  FROM contact WHERE event_type = 'purchase' GROUP BY user_id, day
), call AS (
  SELECT user_id, day FROM contact WHERE event_type = 'click'
)"""

CONTACT_VERSIONS = CONTACTS + """,
attribute AS (
  SELECT user_id, min(day) - 1 AS day, CAST(NULL AS BIGINT) AS decile FROM contact GROUP BY user_id
  UNION ALL
  SELECT user_id, day, CAST(floor(arg_max(value, event_id)) AS BIGINT) % 10 + 1
  FROM contact WHERE event_type = 'signup' GROUP BY user_id, day
), changed AS (
  SELECT *, row_number() OVER w = 1
            OR decile IS DISTINCT FROM lag(decile) OVER w AS opens
  FROM attribute WINDOW w AS (PARTITION BY user_id ORDER BY day)
), version AS (
  SELECT user_id, decile, day AS valid_from,
         coalesce(lead(day) OVER (PARTITION BY user_id ORDER BY day) - 1, DATE '9999-12-31')
           AS valid_to
  FROM changed WHERE opens
)"""

RX_TEXT = """
line AS (
  SELECT *, CAST(round(l_discount * 100) AS INTEGER) AS disc,
         CAST(round(l_tax * 100) AS INTEGER) AS tax
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
), feed AS (
  SELECT
    CASE WHEN disc = 8 AND tax = 8 THEN '2024-02-30' WHEN disc = 8 AND tax = 7 THEN '1998-3-7'
         WHEN disc = 8 AND tax = 6 THEN '1998' WHEN disc = 8 AND tax = 5 THEN NULL
         WHEN disc = 8 AND tax = 4 THEN '1998-05-01T10:00'
         ELSE strftime(l_shipdate, '%Y-%m-%d') END AS rx_date,
    CASE WHEN disc = 7 AND tax = 7 THEN 'GHOST' WHEN disc = 7 AND tax = 6 THEN NULL
         ELSE CAST(o_custkey AS VARCHAR) END AS hcp_id,
    CASE WHEN disc = 7 AND tax = 8 THEN 'UNKNOWN-99'
         ELSE CAST(l_partkey AS VARCHAR) END AS product_code,
    CASE WHEN disc = 10 THEN
           CASE tax WHEN 8 THEN 'N/A' WHEN 7 THEN '' WHEN 6 THEN '3.7' WHEN 5 THEN '-1'
                    WHEN 4 THEN '2147483648' WHEN 3 THEN ' +4 ' WHEN 2 THEN '1e1'
                    WHEN 1 THEN '7.0' WHEN 0 THEN 'inf' END
         ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS trx_count,
    CAST(CAST(l_quantity AS INTEGER) // 3 AS VARCHAR) AS nrx_count,
    CASE WHEN disc = 9 AND tax > 0 THEN
           CASE tax WHEN 8 THEN 'n.a.' WHEN 7 THEN NULL WHEN 6 THEN '1.005'
                    WHEN 5 THEN '99999999999.99' WHEN 4 THEN '0x10' WHEN 3 THEN '1_000'
                    WHEN 2 THEN '1d' WHEN 1 THEN ' ' END
         ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS units,
    CAST(CAST(l_extendedprice AS DECIMAL(14,2)) AS VARCHAR) AS gross_sales
  FROM line
)"""


def _number(column: str) -> str:
    return (f"CASE WHEN regexp_matches({column}, '{NUMBER}') "
            f"THEN TRY_CAST(trim({column}) AS DOUBLE) END")


def _money(column: str, digits: int) -> str:
    return (f"CASE WHEN regexp_matches({column}, '{NUMBER}') "
            f"THEN TRY_CAST(trim({column}) AS DECIMAL({digits},2)) END")


def _number_reason(column: str, digits: int | None) -> str:
    """Reason text of one numeric column; whole numbers (no digits) must lie in 0..2^31-1."""
    parts = [
        f"WHEN {column} IS NULL OR trim({column}) = '' THEN 'missing value in {column}'",
        f"WHEN {column}_n IS NULL THEN 'non-numeric value in {column}'",
    ]
    if digits is None:
        parts += [
            f"WHEN {column}_n <> trunc({column}_n) THEN 'non-integer value in {column}'",
            f"WHEN {column}_n < 0 OR {column}_n > 2147483647 "
            f"THEN 'out-of-range value in {column}'",
        ]
    else:
        parts.append(f"WHEN {column}_m IS NULL THEN 'out-of-range value in {column}'")
    return "CASE " + " ".join(parts) + " END"


TYPED = RX_TEXT + f""",
parsed AS (
  SELECT *, {_number('units')} AS units_n, {_money('units', 12)} AS units_m,
         {_number('gross_sales')} AS gross_sales_n, {_money('gross_sales', 14)} AS gross_sales_m,
         {_number('trx_count')} AS trx_count_n, {_number('nrx_count')} AS nrx_count_n,
         CASE WHEN regexp_matches(rx_date, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$')
              THEN TRY_CAST(rx_date AS DATE) END AS day
  FROM feed
), judged AS (
  SELECT *, coalesce(
    {_number_reason('units', 12)}, {_number_reason('gross_sales', 14)},
    {_number_reason('trx_count', None)}, {_number_reason('nrx_count', None)},
    CASE WHEN day IS NULL THEN 'unparseable date in rx_date' END) AS type_reason
  FROM parsed
)"""

# Overlaps are counted per line, so lines get a number.
RESOLVED = TYPED + """,
numbered AS (SELECT *, row_number() OVER () AS line_no FROM judged),
span AS (
  SELECT o_orderkey AS hcp_key, CAST(o_custkey AS VARCHAR) AS hcp_id, c_nationkey AS territory_key,
         CAST(o_orderdate AS DATE) AS valid_from, CAST(o_orderdate AS DATE) + 199 AS valid_to
  FROM orders JOIN customer ON o_custkey = c_custkey
), hit AS (
  SELECT line_no, count(*) AS hits, min(s.hcp_key) AS hcp_key, min(territory_key) AS territory_key
  FROM numbered n JOIN span s ON n.hcp_id = s.hcp_id AND n.day BETWEEN s.valid_from AND s.valid_to
  GROUP BY line_no
), bounds AS (
  SELECT min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day
  FROM orders
), resolved AS (
  SELECT n.*, h.hcp_key, h.territory_key, p_partkey AS product_key,
         CAST(strftime(n.day, '%Y%m%d') AS BIGINT) AS date_key,
         CASE WHEN p_partkey IS NULL THEN 'unknown product_code'
              WHEN n.hcp_id IS NULL OR n.hcp_id NOT IN (SELECT hcp_id FROM span)
                THEN 'unknown hcp_id'
              WHEN h.hits > 1 THEN 'overlapping HCP versions'
              WHEN h.hits IS NULL THEN 'no valid HCP version'
              WHEN n.day < first_day OR n.day > last_day THEN 'date outside dim_date'
         END AS key_reason
  FROM numbered n LEFT JOIN hit h USING (line_no)
  LEFT JOIN part ON n.product_code = CAST(p_partkey AS VARCHAR)
  CROSS JOIN bounds
)"""

ORDER_CHANGES = """
change AS (
  SELECT o_custkey AS hcp_id, CAST(o_orderdate AS DATE) AS day,
         arg_min(o_orderpriority, o_orderkey) AS priority,
         arg_min(o_orderstatus, o_orderkey) AS status
  FROM orders GROUP BY 1, 2
), opening AS (
  SELECT *, lag(day) OVER w IS NULL OR (priority, status) IS DISTINCT FROM
            (lag(priority) OVER w, lag(status) OVER w) AS opens
  FROM change WINDOW w AS (PARTITION BY hcp_id ORDER BY day)
), history AS (
  SELECT hcp_id, priority, status, day AS valid_from,
         coalesce(lead(day) OVER w - 1, DATE '9999-12-31') AS valid_to,
         lead(day) OVER w IS NULL AS is_current
  FROM opening WHERE opens WINDOW w AS (PARTITION BY hcp_id ORDER BY day)
)"""

HCP_ROWS = """
hcp_line AS (
  SELECT 'HCP-' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') AS hcp_id, c_name AS full_name,
         c_mktsegment AS specialty, c_nationkey AS nation, CAST(o_orderdate AS DATE) AS day,
         o_orderpriority AS priority, o_orderkey AS ordinal
  FROM orders JOIN customer ON o_custkey = c_custkey
), place AS (
  SELECT nation, row_number() OVER (ORDER BY nation) AS territory_key
  FROM (SELECT DISTINCT nation FROM hcp_line WHERE nation > 0)
), hcp_row AS (
  SELECT l.*, territory_key,
         CASE priority WHEN '1-URGENT' THEN '9' WHEN '2-HIGH' THEN '7' WHEN '3-MEDIUM' THEN '5.0'
                       WHEN '5-LOW' THEN ' 1' ELSE 'N/A' END AS decile_text,
         CASE WHEN priority = '4-NOT SPECIFIED' THEN 'non-numeric value in decile'
              WHEN nation = 0 THEN 'unknown territory_code' END AS reason
  FROM hcp_line l LEFT JOIN place USING (nation)
)"""

HISTORY_ROWS = f"""
WITH {ORDER_CHANGES}
SELECT hcp_id, priority, status, CAST(valid_from AS VARCHAR) AS valid_from,
       CAST(valid_to AS VARCHAR) AS valid_to, is_current
FROM history"""

SPANS = """
span AS (
  SELECT o_orderkey AS hcp_key, o_custkey AS hcp_id, CAST(o_orderdate AS DATE) AS valid_from,
         CAST(o_orderdate AS DATE) + 199 AS valid_to, o_orderstatus = 'O' AS is_current,
         c_nationkey AS territory_key
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""

EXPOSURE = f"""
WITH {SCRIPTS_AND_CALLS}
SELECT rx.user_id AS hcp_id, CAST(rx.day AS VARCHAR) AS day, rx.trx,
       count(call.user_id) AS prior_calls
FROM rx LEFT JOIN call ON call.user_id = rx.user_id
                      AND rx.day - call.day BETWEEN 1 AND 14
GROUP BY rx.user_id, rx.day, rx.trx"""

DIFFERENCES = """
source AS (
  SELECT hcp_id, product_code, day, CAST(trx_count_n AS BIGINT) AS trx, units_m AS units,
         gross_sales_m AS gross
  FROM resolved WHERE type_reason IS NULL AND key_reason IS NULL
)"""

ORACLE_SQL: dict[str, str] = {}

# ----------------------------------------------------------------------- reports
ORACLE_SQL["brand_share_mom"] = f"""
WITH {RX_FACT}, brand AS (
  SELECT year_month, p_type, p_brand, sum(trx) AS trx FROM fact GROUP BY ALL
), market AS (
  SELECT year_month, p_type, sum(trx) AS whole FROM fact GROUP BY ALL
), share AS (
  SELECT brand.*, round(100.0 * trx / nullif(whole, 0), 2) AS pct
  FROM brand JOIN market USING (year_month, p_type)
), earlier AS (
  SELECT now.year_month, now.p_type, now.p_brand, max(past.year_month) AS year_month_before
  FROM share now JOIN share past ON now.p_type = past.p_type AND now.p_brand = past.p_brand
       AND past.year_month < now.year_month
  GROUP BY ALL
)
SELECT s.year_month, s.p_brand AS brand_name, CAST(s.trx AS BIGINT) AS trx,
       CAST(s.pct AS DOUBLE) AS share_pct, round(s.pct - p.pct, 2) AS share_delta_pp,
       s.p_type AS therapeutic_area
FROM share s LEFT JOIN earlier e USING (year_month, p_type, p_brand)
LEFT JOIN share p ON p.p_type = s.p_type AND p.p_brand = s.p_brand
     AND p.year_month = e.year_month_before"""

ORACLE_SQL["prescriber_ranking"] = f"""
WITH {RX_FACT}, volume AS (
  SELECT person, place, sum(trx) AS total FROM fact WHERE own GROUP BY person, place
)
SELECT person AS hcp_id, c_name AS full_name, c_mktsegment AS specialty,
       n_name AS territory_name, CAST(total AS BIGINT) AS total_trx,
       ntile(10) OVER (PARTITION BY place ORDER BY total DESC, person) AS calculated_decile,
       rank() OVER (PARTITION BY place ORDER BY total DESC) AS territory_rank
FROM volume JOIN customer ON c_custkey = person JOIN nation ON n_nationkey = place"""

ORACLE_SQL["territory_attainment"] = f"""
WITH {RX_FACT}, monthly AS (
  SELECT place, year_month, left(year_month, 4) AS year, CAST(sum(trx) AS BIGINT) AS actual,
         row_number() OVER (PARTITION BY place ORDER BY year_month) AS seq
  FROM fact WHERE own GROUP BY place, year_month
), quota AS (
  SELECT place, sum(actual) AS base, count(*) AS months FROM monthly WHERE seq <= 6 GROUP BY place
), planned AS (
  SELECT monthly.*, CAST((2 * 108 * base + 100 * months) // (2 * 100 * months) AS BIGINT) AS target
  FROM monthly JOIN quota USING (place)
), running AS (
  SELECT *, CAST(sum(actual) OVER y AS BIGINT) AS ytd_actual,
         CAST(sum(target) OVER y AS BIGINT) AS ytd_target
  FROM planned WINDOW y AS (PARTITION BY place, year ORDER BY year_month)
)
SELECT 'T-' || lpad(CAST(place AS VARCHAR), 3, '0') AS territory_code, n_name AS territory_name,
       r_name AS region, year_month, actual AS actual_trx, target AS target_trx,
       actual - target AS gap_to_target_trx,
       round(100.0 * actual / nullif(target, 0), 1) AS attainment_pct,
       ytd_actual AS ytd_actual_trx, ytd_target AS ytd_target_trx,
       round(100.0 * ytd_actual / nullif(ytd_target, 0), 1) AS ytd_attainment_pct,
       rank() OVER (PARTITION BY year_month ORDER BY actual / nullif(target, 0) DESC NULLS FIRST)
         AS attainment_rank_in_month,
       CASE WHEN seq <= 6 THEN 'BASELINE PERIOD' WHEN actual >= target THEN 'AT/ABOVE PLAN'
            WHEN 10 * actual >= 9 * target THEN 'WATCH' ELSE 'BEHIND PLAN' END AS plan_status
FROM running JOIN nation ON n_nationkey = place JOIN region ON r_regionkey = n_regionkey"""

ORACLE_SQL["call_effectiveness"] = f"""
WITH {CONTACT_VERSIONS}, rx AS (
  SELECT user_id, day, CAST(sum(floor(value)) AS BIGINT) AS trx
  FROM contact WHERE event_type = 'purchase' AND k < 50 GROUP BY user_id, day
), call AS (
  SELECT user_id, day FROM contact WHERE event_type = 'click' AND k < 50
), exposure AS (
  SELECT *, EXISTS (SELECT 1 FROM call WHERE call.user_id = rx.user_id
                    AND rx.day - call.day BETWEEN 1 AND 14) AS exposed
  FROM rx
), person_month AS (
  SELECT user_id, strftime(day, '%Y-%m') AS month, max(day) AS last_day, sum(trx) AS trx,
         count(*) AS days, count_if(exposed) AS exposed_days,
         CASE WHEN bool_or(exposed) THEN 'CALLED' ELSE 'NOT CALLED' END AS cohort
  FROM exposure GROUP BY 1, 2
), labelled AS (
  SELECT p.*, decile FROM person_month p JOIN version v
    ON v.user_id = p.user_id AND p.last_day BETWEEN v.valid_from AND v.valid_to
), stratified AS (
  SELECT 'ALL DECILES' AS stratum, * FROM labelled
  UNION ALL
  SELECT CASE WHEN decile IS NULL THEN 'DECILE UNKNOWN'
              ELSE 'DECILE ' || lpad(CAST(decile AS VARCHAR), 2, '0') END, * FROM labelled
), figures AS (
  SELECT stratum, cohort, count(DISTINCT user_id) AS hcps, count(*) AS hcp_months,
         CAST(sum(trx) AS BIGINT) AS total, round(avg(trx), 2) AS mean,
         round(median(trx), 2) AS middle, round(avg(100.0 * exposed_days / days), 1) AS pct
  FROM stratified GROUP BY stratum, cohort
)
SELECT f.stratum, f.cohort, f.hcps, f.hcp_months, f.total AS total_trx,
       f.mean AS avg_trx_per_hcp_month, f.middle AS median_trx_per_hcp_month,
       f.pct AS pct_of_rx_days_exposed, round(f.mean - u.mean, 2) AS trx_lift_vs_uncalled,
       round(100.0 * f.mean / nullif(u.mean, 0) - 100, 1) AS lift_pct
FROM figures f LEFT JOIN figures u ON u.stratum = f.stratum AND u.cohort = 'NOT CALLED'"""

ORACLE_SQL["monthly_brand_rollup"] = f"""
WITH {RX_FACT}
SELECT year_month, p_brand AS brand_name, CAST(sum(trx) AS BIGINT) AS trx FROM fact GROUP BY 1, 2"""

ORACLE_SQL["prescriber_drilldown"] = f"""
WITH {RX_FACT}
SELECT year_month, CAST(sum(trx) AS BIGINT) AS trx FROM fact WHERE person = 742 GROUP BY 1"""

# ---------------------------------------------------------------------- exposure
ORACLE_SQL["exposure_days"] = EXPOSURE
ORACLE_SQL["exposure_days_range_join"] = EXPOSURE

# ------------------------------------------------------------------------ typing
ORACLE_SQL["coerce_clean"] = f"""
WITH {TYPED}
SELECT CAST(day AS VARCHAR) AS rx_date, hcp_id, product_code,
       CAST(trx_count_n AS BIGINT) AS trx_count, CAST(nrx_count_n AS BIGINT) AS nrx_count,
       CAST(units_m AS DOUBLE) AS units, CAST(gross_sales_m AS DOUBLE) AS gross_sales
FROM judged WHERE type_reason IS NULL"""

ORACLE_SQL["coerce_rejects"] = f"""
WITH {TYPED}
SELECT rx_date, hcp_id, product_code, trx_count, nrx_count, units, gross_sales,
       type_reason AS reject_reason
FROM judged WHERE type_reason IS NOT NULL"""

ORACLE_SQL["coerce_reject_summary"] = f"""
WITH {TYPED}
SELECT coalesce(type_reason, 'clean') AS reject_reason, count(*) AS lines FROM judged GROUP BY 1"""

# -------------------------------------------------------------------- dimensions
ORACLE_SQL["calendar_dim"] = f"""
WITH {RX_TEXT}, day AS (
  SELECT CASE WHEN regexp_matches(rx_date, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$')
              THEN TRY_CAST(rx_date AS DATE) END AS d FROM feed
  UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders
), calendar AS (
  SELECT CAST(unnest(generate_series(min(d), max(d), INTERVAL 1 DAY)) AS DATE) AS d FROM day
)
SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, CAST(d AS VARCHAR) AS full_date,
       year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
       strftime(d, '%Y-%m') AS year_month
FROM calendar"""

ORACLE_SQL["territory_dim"] = """
WITH code AS (
  SELECT DISTINCT 'T-' || lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS code FROM customer
), keyed AS (SELECT code, row_number() OVER (ORDER BY code) AS key FROM code)
SELECT key AS territory_key, code AS territory_code, 'Territory ' || substr(code, 3) AS territory_name,
       CASE (key - 1) % 5 WHEN 0 THEN 'North' WHEN 1 THEN 'South' WHEN 2 THEN 'East'
                          WHEN 3 THEN 'West' ELSE 'Central' END AS region,
       'India' AS country
FROM keyed"""

ORACLE_SQL["hcp_dimension"] = f"""
WITH {HCP_ROWS}, clean AS (
  SELECT *, CAST(CAST(trim(decile_text) AS DOUBLE) AS BIGINT) AS decile
  FROM hcp_row WHERE reason IS NULL
  QUALIFY row_number() OVER (PARTITION BY hcp_id, day ORDER BY ordinal) = 1
), opening AS (
  SELECT *, lag(day) OVER w IS NULL OR decile <> lag(decile) OVER w AS opens
  FROM clean WINDOW w AS (PARTITION BY hcp_id ORDER BY day)
)
SELECT row_number() OVER (ORDER BY hcp_id, day) AS hcp_key, hcp_id, full_name, specialty, decile,
       territory_key, CAST(day AS VARCHAR) AS valid_from,
       CAST(coalesce(lead(day) OVER w - 1, DATE '9999-12-31') AS VARCHAR) AS valid_to,
       lead(day) OVER w IS NULL AS is_current
FROM opening WHERE opens WINDOW w AS (PARTITION BY hcp_id ORDER BY day)"""

ORACLE_SQL["hcp_rejects"] = f"""
WITH {HCP_ROWS}
SELECT hcp_id, full_name, specialty, decile_text AS decile,
       CASE WHEN nation > 0 THEN 'T-' || lpad(CAST(nation AS VARCHAR), 3, '0') END AS territory_code,
       CAST(day AS VARCHAR) AS effective_date, reason AS reject_reason
FROM hcp_row WHERE reason IS NOT NULL"""

ORACLE_SQL["scd2_versions"] = HISTORY_ROWS
ORACLE_SQL["scd2_incremental"] = HISTORY_ROWS

ORACLE_SQL["scd2_conflicts"] = """
WITH change AS (
  SELECT o_custkey AS hcp_id, CAST(o_orderdate AS DATE) AS day, o_orderkey,
         o_orderpriority || '|' || o_orderstatus AS tracked FROM orders
), opening AS (
  SELECT * FROM change
  QUALIFY tracked IS DISTINCT FROM
          lag(tracked) OVER (PARTITION BY hcp_id ORDER BY day, o_orderkey)
), paired AS (
  SELECT *, lag(day) OVER (PARTITION BY hcp_id ORDER BY day, o_orderkey) AS live_from FROM opening
)
SELECT DISTINCT hcp_id, CAST(day AS VARCHAR) AS effective_date FROM paired WHERE day <= live_from"""

# -------------------------------------------------------------------- resolution
ORACLE_SQL["resolve_keys"] = f"""
WITH {RESOLVED}
SELECT CAST(trx_count_n AS BIGINT) AS trx_count, CAST(nrx_count_n AS BIGINT) AS nrx_count,
       CAST(units_m AS DOUBLE) AS units, CAST(gross_sales_m AS DOUBLE) AS gross_sales,
       date_key, hcp_key, product_key, CAST(territory_key AS BIGINT) AS territory_key
FROM resolved WHERE type_reason IS NULL AND key_reason IS NULL"""

ORACLE_SQL["resolve_rejects"] = f"""
WITH {RESOLVED}
SELECT CAST(day AS VARCHAR) AS rx_date, hcp_id, product_code,
       CAST(trx_count_n AS BIGINT) AS trx_count, CAST(nrx_count_n AS BIGINT) AS nrx_count,
       CAST(units_m AS DOUBLE) AS units, CAST(gross_sales_m AS DOUBLE) AS gross_sales,
       key_reason AS reject_reason
FROM resolved WHERE type_reason IS NULL AND key_reason IS NOT NULL"""

ORACLE_SQL["label_as_of"] = f"""
WITH {ORDER_CHANGES}
SELECT priority, status, strftime(l_shipdate, '%Y-%m') AS year_month, count(*) AS lines,
       CAST(sum(l_quantity) AS BIGINT) AS trx
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN history ON hcp_id = o_custkey AND CAST(l_shipdate AS DATE) BETWEEN valid_from AND valid_to
GROUP BY 1, 2, 3"""

ORACLE_SQL["reconcile"] = f"""
WITH {RESOLVED}, {CONTACT_VERSIONS.strip()}, judged_call AS (
  SELECT event_type IN ('click', 'view', 'signup') AND EXISTS (
           SELECT 1 FROM version v WHERE v.user_id = c.user_id
           AND c.day BETWEEN v.valid_from AND v.valid_to) AS ok
  FROM contact c
)
SELECT 'prescriptions' AS feed, (SELECT count(*) FROM lineitem) AS staged,
       CAST(count_if(type_reason IS NULL AND key_reason IS NULL) AS BIGINT) AS loaded,
       CAST(count_if(type_reason IS NOT NULL OR key_reason IS NOT NULL) AS BIGINT) AS rejected,
       TRUE AS reconciled
FROM resolved
UNION ALL
SELECT 'sales_calls', (SELECT count(*) FROM events), CAST(count_if(ok) AS BIGINT),
       CAST(count_if(NOT ok) AS BIGINT), TRUE
FROM judged_call"""

# ------------------------------------------------------------------------ checks
ORACLE_SQL["fk_orphans"] = f"""
WITH {RX_TEXT}
SELECT 'lineitem.p_partkey has no dimension row' AS "check", count(*) AS violations
FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
UNION ALL
SELECT 'lineitem.s_suppkey has no dimension row', count(*)
FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)
UNION ALL
SELECT 'lineitem.date_key has no dimension row', count(*)
FROM lineitem WHERE l_shipdate < (SELECT min(o_orderdate) FROM orders)
                 OR l_shipdate > (SELECT max(o_orderdate) FROM orders)
UNION ALL
SELECT 'orders.c_custkey has no dimension row', count(*)
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
UNION ALL
SELECT 'customer.n_nationkey has no dimension row', count(*)
FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation)
UNION ALL
SELECT 'feed.p_partkey has no dimension row', count(*) FROM feed
WHERE product_code NOT IN (SELECT CAST(p_partkey AS VARCHAR) FROM part)"""

ORACLE_SQL["null_and_range_checks"] = f"""
WITH {TYPED}, {SPANS.strip()}, typed AS (
  SELECT hcp_id, day, units_m AS units, gross_sales_m AS gross,
         CASE WHEN trx_count_n = trunc(trx_count_n) AND abs(trx_count_n) < 2147483648
              THEN trx_count_n END AS trx, nrx_count_n AS nrx
  FROM judged
)
SELECT 'fact.trx_count is null' AS "check", CAST(count_if(trx IS NULL) AS BIGINT) AS violations
FROM typed
UNION ALL SELECT 'fact.nrx_count is null', CAST(count_if(nrx IS NULL) AS BIGINT) FROM typed
UNION ALL SELECT 'fact.units is null', CAST(count_if(units IS NULL) AS BIGINT) FROM typed
UNION ALL SELECT 'fact.gross_sales is null', CAST(count_if(gross IS NULL) AS BIGINT) FROM typed
UNION ALL SELECT 'fact.hcp_id is null', CAST(count_if(hcp_id IS NULL) AS BIGINT) FROM typed
UNION ALL SELECT 'fact.rx_date is null', CAST(count_if(day IS NULL) AS BIGINT) FROM typed
UNION ALL SELECT 'small or negative measure', CAST(count_if(units < 2 OR trx < 2) AS BIGINT) FROM typed
UNION ALL SELECT 'nrx above a third of units', CAST(count_if(nrx * 3 > units) AS BIGINT) FROM typed
UNION ALL SELECT 'inverted window', CAST(count_if(valid_from > valid_to) AS BIGINT) FROM span
UNION ALL SELECT 'territory outside 1..20', CAST(count_if(territory_key NOT BETWEEN 1 AND 20) AS BIGINT) FROM span"""

ORACLE_SQL["row_condition_checks"] = """
WITH fact AS (
  SELECT *, l_extendedprice * (l_discount - l_tax) AS gross FROM lineitem
), contact AS (
  SELECT e.*, c_nationkey FROM events e LEFT JOIN customer ON user_id = c_custkey
), version AS (
  SELECT l.*, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) + 30 AS valid_to
  FROM lineitem l JOIN orders ON l_orderkey = o_orderkey
), counted AS (
  FROM fact SELECT {
    'fact_prescriptions.date_key is null': count_if(l_shipdate IS NULL),
    'fact_prescriptions.hcp_key is null': count_if(l_orderkey IS NULL),
    'fact_prescriptions.product_key is null': count_if(l_partkey IS NULL),
    'fact_prescriptions.territory_key is null': count_if(l_suppkey IS NULL),
    'fact_prescriptions.trx_count is null': count_if(l_quantity IS NULL),
    'fact_prescriptions.nrx_count is null': count_if(l_linenumber IS NULL),
    'fact_prescriptions.units is null': count_if(l_extendedprice IS NULL),
    'fact_prescriptions.gross_sales is null': count_if(gross IS NULL),
    'fact_prescriptions has a negative measure':
      count_if(l_quantity < 0 OR l_linenumber < 0 OR l_extendedprice < 0 OR gross < 0),
    'fact_prescriptions has nrx above trx': count_if(l_linenumber > l_quantity)} AS found
), counted_calls AS (
  FROM contact SELECT {
    'fact_sales_calls.date_key is null': count_if(ts IS NULL),
    'fact_sales_calls.hcp_key is null': count_if(user_id IS NULL),
    'fact_sales_calls.product_key is null': count_if(event_id IS NULL),
    'fact_sales_calls.territory_key is null': count_if(c_nationkey IS NULL),
    'fact_sales_calls.call_type is null': count_if(event_type IS NULL),
    'fact_sales_calls.duration_minutes is null': count_if(value IS NULL),
    'fact_sales_calls.samples_dropped is null': count_if(value IS NULL),
    'fact_sales_calls has an unlisted call_type': count_if(event_type <> 'click')} AS found
), counted_versions AS (
  FROM version SELECT {
    'dim_hcp.hcp_key is null': count_if(l_orderkey IS NULL),
    'dim_hcp.hcp_id is null': count_if(o_custkey IS NULL),
    'dim_hcp.full_name is null': count_if(l_returnflag IS NULL),
    'dim_hcp.specialty is null': count_if(l_linestatus IS NULL),
    'dim_hcp.territory_key is null': count_if(l_suppkey IS NULL),
    'dim_hcp.valid_from is null': count_if(l_shipdate IS NULL),
    'dim_hcp.valid_to is null': count_if(valid_to IS NULL),
    'dim_hcp.is_current is null': count_if(o_orderstatus IS NULL),
    'dim_hcp has a decile outside 1..10': count_if(l_quantity NOT BETWEEN 1 AND 10),
    'dim_hcp has an inverted window': count_if(CAST(l_shipdate AS DATE) > valid_to)} AS found
), listed AS (
  SELECT unnest(json_keys(to_json(found))) AS "check", to_json(found) AS found FROM counted
  UNION ALL SELECT unnest(json_keys(to_json(found))), to_json(found) FROM counted_calls
  UNION ALL SELECT unnest(json_keys(to_json(found))), to_json(found) FROM counted_versions
)
SELECT "check", CAST(json_extract_string(found, '$."' || "check" || '"') AS BIGINT) AS violations
FROM listed"""

ORACLE_SQL["scd2_invariants"] = f"""
WITH {SPANS}, bounds AS (SELECT min(valid_from) AS lo, max(valid_from) AS hi FROM span)
SELECT 'people without exactly one current version' AS "check", count(*) AS violations
FROM (SELECT hcp_id FROM span GROUP BY hcp_id HAVING count_if(is_current) <> 1)
UNION ALL
SELECT 'pairs of overlapping versions', count(*)
FROM span a JOIN span b ON a.hcp_id = b.hcp_id AND a.hcp_key < b.hcp_key
WHERE a.valid_from <= b.valid_to AND b.valid_from <= a.valid_to
UNION ALL
SELECT 'lineitem rows outside their version''s window', count(*)
FROM lineitem JOIN span ON l_orderkey = hcp_key, bounds
WHERE CAST(l_shipdate AS DATE) BETWEEN lo AND hi
  AND CAST(l_shipdate AS DATE) NOT BETWEEN valid_from AND valid_to
UNION ALL
SELECT 'closed versions', CAST(count_if(NOT is_current) AS BIGINT) FROM span"""

ORACLE_SQL["uniqueness_checks"] = """
SELECT 'orders.o_orderkey is repeated' AS "check", count(*) AS violations
FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL SELECT 'customer.c_custkey is repeated', count(*)
FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
UNION ALL SELECT 'part.p_partkey is repeated', count(*)
FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1)
UNION ALL SELECT 'lineitem (order, line) is repeated', count(*)
FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'prescription grain is repeated', count(*)
FROM (SELECT 1 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
      GROUP BY o_custkey, l_partkey, CAST(o_orderdate AS DATE) HAVING count(*) > 1)"""

ORACLE_SQL["distribution_checks"] = f"""
WITH {ORDER_CHANGES}, bounds AS (
  SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders
)
SELECT 'distinct_deciles' AS measure, count(DISTINCT priority || status) AS value,
       count(DISTINCT priority || status) >= 5 AS enough
FROM history
UNION ALL
SELECT 'closed_versions', CAST(count_if(NOT is_current) AS BIGINT), count_if(NOT is_current) >= 1
FROM history
UNION ALL
SELECT 'distinct_months', date_diff('month', lo, hi) + 1, date_diff('month', lo, hi) + 1 >= 12
FROM bounds"""

ORACLE_SQL["source_vs_warehouse"] = f"""
WITH {RESOLVED}, {DIFFERENCES.strip()}, loaded AS (
  SELECT s.hcp_id, CAST(p_partkey AS VARCHAR) AS product_code, r.day,
         CAST(trx_count_n AS BIGINT) AS trx, units_m AS units, gross_sales_m AS gross
  FROM resolved r JOIN span s ON r.hcp_key = s.hcp_key JOIN part ON r.product_key = p_partkey
  WHERE type_reason IS NULL AND key_reason IS NULL
), a AS (
  SELECT hcp_id, product_code, day, count(*) AS n, sum(trx) AS trx, sum(units) AS units,
         sum(gross) AS gross FROM source GROUP BY ALL
), b AS (
  SELECT hcp_id, product_code, day, count(*) AS n, sum(trx) AS trx, sum(units) AS units,
         sum(gross) AS gross FROM loaded GROUP BY ALL
)
SELECT hcp_id, product_code, CAST(day AS VARCHAR) AS day,
       coalesce(a.n, 0) - coalesce(b.n, 0) AS rows_diff,
       CAST(coalesce(a.trx, 0) - coalesce(b.trx, 0) AS BIGINT) AS trx_count_diff,
       CAST(coalesce(a.units, 0) - coalesce(b.units, 0) AS DOUBLE) AS units_diff,
       CAST(coalesce(a.gross, 0) - coalesce(b.gross, 0) AS DOUBLE) AS gross_sales_diff
FROM a FULL JOIN b USING (hcp_id, product_code, day)
WHERE a.n IS DISTINCT FROM b.n OR a.trx IS DISTINCT FROM b.trx
   OR a.units IS DISTINCT FROM b.units OR a.gross IS DISTINCT FROM b.gross"""

ORACLE_SQL["source_vs_damaged_warehouse"] = f"""
WITH {RESOLVED}, {DIFFERENCES.strip()}
SELECT hcp_id, if(sign = 1, product_code, 'MOVED') AS product_code, CAST(day AS VARCHAR) AS day,
       CAST(sum(sign) AS BIGINT) AS rows_diff, CAST(sum(sign * trx) AS BIGINT) AS trx_count_diff,
       CAST(sum(sign * units) AS DOUBLE) AS units_diff,
       CAST(sum(sign * gross) AS DOUBLE) AS gross_sales_diff
FROM source, (VALUES (1), (-1)) side(sign) WHERE trx <= 1 GROUP BY 1, 2, 3"""


# --------------------------------------------------------------------- load path
ORACLE_SQL["quoted_feed"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source,
       replace(replace(text, chr(13) || chr(10), chr(10)), chr(13), chr(10)) AS text,
       CAST(NULL AS VARCHAR) AS malformed_line
FROM documents"""

ORACLE_SQL["fact_load"] = f"""
WITH {RESOLVED}, verdict AS (
  SELECT *, coalesce(type_reason, key_reason) AS reason FROM resolved
)
SELECT CASE WHEN reason IS NULL THEN date_key END AS date_key,
       CASE WHEN reason IS NULL THEN hcp_key END AS hcp_key,
       CASE WHEN reason IS NULL THEN product_key END AS product_key,
       CASE WHEN reason IS NULL THEN CAST(territory_key AS BIGINT) END AS territory_key,
       CASE WHEN reason IS NULL THEN CAST(trx_count_n AS BIGINT) END AS trx_count,
       CASE WHEN reason IS NULL THEN CAST(nrx_count_n AS BIGINT) END AS nrx_count,
       CASE WHEN reason IS NULL THEN CAST(units_m AS DOUBLE) END AS units,
       CASE WHEN reason IS NULL THEN CAST(gross_sales_m AS DOUBLE) END AS gross_sales,
       CASE WHEN reason IS NOT NULL THEN rx_date END AS raw_rx_date,
       CASE WHEN reason IS NOT NULL THEN hcp_id END AS raw_hcp_id,
       CASE WHEN reason IS NOT NULL THEN product_code END AS raw_product_code,
       CASE WHEN reason IS NOT NULL THEN trx_count END AS raw_trx_count,
       CASE WHEN reason IS NOT NULL THEN nrx_count END AS raw_nrx_count,
       CASE WHEN reason IS NOT NULL THEN units END AS raw_units,
       CASE WHEN reason IS NOT NULL THEN gross_sales END AS raw_gross_sales,
       reason AS reject_reason, if(reason IS NULL, 'loaded', 'rejected') AS outcome,
       if(reason IS NULL, strftime(day, '%Y-%m'), 'none') AS year_month
FROM verdict"""

ORACLE_SQL["reject_sink"] = f"""
WITH {RESOLVED}, {HCP_ROWS.strip()}
SELECT hcp_id, full_name, specialty, decile_text AS decile,
       CASE WHEN nation > 0 THEN 'T-' || lpad(CAST(nation AS VARCHAR), 3, '0') END AS territory_code,
       CAST(day AS VARCHAR) AS effective_date, reason AS reject_reason, 'hcp' AS entity
FROM hcp_row WHERE reason IS NOT NULL
UNION ALL BY NAME
SELECT rx_date, hcp_id, product_code, trx_count, nrx_count, units, gross_sales,
       coalesce(type_reason, key_reason) AS reject_reason, 'prescriptions' AS entity
FROM resolved WHERE type_reason IS NOT NULL OR key_reason IS NOT NULL
UNION ALL BY NAME
SELECT strftime(ts, '%Y-%m-%d') AS call_date, CAST(user_id AS VARCHAR) AS hcp_id,
       json_extract_string(props, '$.k') AS product_code,
       if(event_type = 'purchase', 'PURCHASE', NULL) AS call_type,
       CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS duration_minutes, '0' AS samples_dropped,
       'invalid call_type' AS reject_reason, 'sales_calls' AS entity
FROM events WHERE event_type NOT IN ('click', 'view', 'signup')"""

ORACLE_SQL["literal_products"] = """
WITH product(n, product_code, brand_name, is_competitor) AS (VALUES
  (1, 'RX-CARDIO-01', 'Cardiova', FALSE), (2, 'RX-ENDO-01', 'Glucoron', FALSE),
  (3, 'RX-RESP-01', 'Pulmovent', FALSE), (4, 'CM-CARDIO-01', 'Lipitrex', TRUE),
  (5, 'CM-CARDIO-02', 'Statinex', TRUE), (6, 'CM-ENDO-01', 'Glycomet', TRUE),
  (7, 'CM-RESP-01', 'Airomax', TRUE), (8, 'CM-RESP-02', 'Bronchol', TRUE))
SELECT product_code, brand_name, is_competitor, CAST(sum(l_quantity) AS BIGINT) AS trx
FROM lineitem JOIN product ON l_partkey % 8 + 1 = n GROUP BY ALL"""

ORACLE_SQL["corrected_history"] = f"""
SELECT * EXCLUDE (hcp_key) FROM ({ORACLE_SQL["hcp_dimension"]})"""

ORACLE_SQL["dimension_checks"] = """
WITH bounds AS (SELECT count(*) AS n FROM orders WHERE o_orderdate IS NULL), dates AS (
  SELECT unnest(['date_key', 'full_date', 'year', 'quarter', 'month', 'month_name', 'year_month']) AS c
), products AS (
  FROM part SELECT {
    'dim_product.product_key is null': count_if(p_partkey IS NULL),
    'dim_product.product_code is null': count_if(p_name IS NULL),
    'dim_product.brand_name is null': count_if(p_brand IS NULL OR p_size <= 5),
    'dim_product.molecule is null': count_if(p_type IS NULL OR p_size <= 10),
    'dim_product.therapeutic_area is null': count_if(p_type IS NULL),
    'dim_product.is_competitor is null': count_if(p_size >= 49)} AS found
), places AS (
  FROM customer SELECT {
    'dim_territory.territory_key is null': count_if(c_custkey % 9 = 0),
    'dim_territory.territory_code is null': count_if(c_name IS NULL),
    'dim_territory.territory_name is null': count_if(c_mktsegment IS NULL),
    'dim_territory.region is null': count_if(c_acctbal <= 0),
    'dim_territory.country is null': count_if(FALSE)} AS found
), listed AS (
  SELECT unnest(json_keys(to_json(found))) AS "check", to_json(found) AS found FROM products
  UNION ALL SELECT unnest(json_keys(to_json(found))), to_json(found) FROM places
)
SELECT "check", CAST(json_extract_string(found, '$."' || "check" || '"') AS BIGINT) AS violations
FROM listed
UNION ALL SELECT 'dim_date.' || c || ' is null', n FROM dates, bounds"""

ORACLE_SQL["stored_drilldown"] = ORACLE_SQL["prescriber_drilldown"]

# ------------------------------------------------------------------ large groups
ORACLE_SQL["scanned_lines"] = """
SELECT p_brand AS brand, strftime(l_shipdate, '%Y-%m-%d') AS day, l_orderkey AS order_key,
       CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS BIGINT) AS trx,
       l_extendedprice AS price, l_returnflag, l_linestatus,
       lag(l_extendedprice) OVER w AS price_before,
       CAST(sum(CAST(l_quantity AS BIGINT)) OVER w AS BIGINT) AS trx_to_date,
       row_number() OVER w = 1 OR (l_returnflag, l_linestatus) IS DISTINCT FROM
         (lag(l_returnflag) OVER w, lag(l_linestatus) OVER w) AS changed
FROM lineitem JOIN part ON l_partkey = p_partkey
WINDOW w AS (PARTITION BY p_brand ORDER BY CAST(l_shipdate AS DATE), l_orderkey, l_linenumber
             ROWS UNBOUNDED PRECEDING)"""

ORACLE_SQL["median_prices"] = """
SELECT p_brand AS brand, median(CAST(round(l_extendedprice * 100) AS BIGINT)) AS median_cents
FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand"""

ORACLE_SQL["distinct_buyers"] = f"""
WITH {RX_FACT}
SELECT p_brand AS brand_name, year_month, count(DISTINCT person) AS ids,
       CAST(2 * grouping(p_brand) + grouping(year_month) AS BIGINT) AS set_id
FROM fact GROUP BY GROUPING SETS ((p_brand, year_month), (p_brand), (year_month), ())"""
