"""DuckDB SQL for every registered query, over the raw benchmark tables.

The journey views are rebuilt in SQL (``ev``, ``pr``, ``se``, ``od``) from
``events``, ``customer``, ``nation``, ``region`` and ``orders``; event
properties are derived from ``props`` directly, so the Spark side's
properties are checked rather than shared.  Constants that both sides need are
typed here again, so a wrong one in the library shows.
"""

from __future__ import annotations

from journey.plans import catalog as C

# fixed values, typed here again on purpose: the library's own must not check themselves
DURATION_BUCKETS = ("< 30s", "30s-2m", "2m-5m", "5m-15m", "15m+")
WEEKDAY_NAMES = ("Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun")
ERFC = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
        -0.82215223, 0.17087277)
POWER_DELTA = 2.8015817870135784  # of a two-sided test at 5 % with power 80 %

SPEC = C.SPEC
R = C.R


def q(s: str) -> str:
    return "'" + str(s).replace("'", "''") + "'"


def dbl(x: float) -> str:
    """Exact double literal (a bare decimal literal would be DECIMAL in DuckDB)."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def D(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def RND(x: str) -> str:
    return f"(ROUND(CAST({x} AS DOUBLE), {C.ROUND_DP}) + 0.0)"


def PCT(a: str, b: str) -> str:
    return f"ROUND(CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0), 2)"


def inlist(xs) -> str:
    return ", ".join(q(x) for x in xs)


BASE = f"""
ev AS (
  SELECT event_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(CAST(ts AS DATE), '%Y%m%d') AS session_id,
         user_id, ts AS event_timestamp, event_type AS event_name, value,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k
  FROM events),
pr AS (
  SELECT *,
    CASE WHEN event_name IN ('view', 'click', 'purchase') THEN k END AS product_id,
    CASE WHEN event_name IN ('view', 'click', 'purchase') THEN 'c' || CAST(k % 5 AS VARCHAR) END AS category,
    CASE WHEN event_name IN ('view', 'click', 'purchase') THEN value END AS price,
    CASE WHEN event_name IN ('click', 'error') THEN 'm' || CAST(k % 4 AS VARCHAR) END AS method,
    CASE WHEN event_name = 'error' THEN 'r' || CAST(k % 3 AS VARCHAR) END AS reason
  FROM ev),
se AS (
  SELECT c.session_id, c.user_id,
         CAST(c.st AS DATE) AS session_date,
         CAST(hour(c.st) AS INTEGER) AS session_hour,
         CAST(isodow(c.st) - 1 AS INTEGER) AS session_day_of_week,
         d.c_mktsegment AS device_type, d.r_name AS traffic_source, d.n_name AS city, d.r_name AS state,
         CAST(c.st AS DATE) = u.first_date AS is_new_user,
         CAST(floor((epoch_us(c.en) - epoch_us(c.st)) / 1000000) AS INTEGER) AS session_duration_seconds
  FROM (SELECT session_id, min(user_id) AS user_id, min(event_timestamp) AS st, max(event_timestamp) AS en
        FROM ev WHERE session_id IS NOT NULL GROUP BY session_id) c
  LEFT JOIN (SELECT user_id AS f_user, CAST(min(event_timestamp) AS DATE) AS first_date FROM ev GROUP BY user_id) u
         ON c.user_id = u.f_user
  LEFT JOIN (SELECT c_custkey, c_mktsegment, n_name, r_name
             FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                           LEFT JOIN region ON n_regionkey = r_regionkey) d
         ON c.user_id = d.c_custkey),
od AS (
  SELECT event_id AS order_id, session_id, user_id, event_timestamp AS order_date, value AS gmv,
         'm' || CAST(k % 4 AS VARCHAR) AS payment_method
  FROM ev WHERE event_name = 'purchase')"""


def W(*ctes: str) -> str:
    return "WITH " + ",\n".join([BASE.strip()] + [c.strip() for c in ctes if c]) + "\n"


def flags_cte(name: str, stages, all_sessions: bool = False, src: str = "ev", keep_null: bool = False) -> str:
    cols = ", ".join(f"MAX(CASE WHEN event_name = {q(n)} THEN 1 ELSE 0 END) AS s{i}" for i, n in enumerate(stages))
    where = ("true" if keep_null else "session_id IS NOT NULL") + ("" if all_sessions else f" AND event_name IN ({inlist(stages)})")
    return f"{name} AS (SELECT session_id, {cols} FROM {src} WHERE {where} GROUP BY session_id)"


def sums(n: int, src: str = "") -> str:
    p = f"{src}." if src else ""
    return ", ".join(f"CAST(COALESCE(SUM({p}s{i}), 0) AS BIGINT) AS c{i}" for i in range(n))


def union(parts) -> str:
    return "\nUNION ALL\n".join(parts)


# --- overall funnel family ---------------------------------------------------

def _funnel_rows(spec, extra=lambda i: "") -> list[str]:
    rows = []
    for i, (n, lbl) in enumerate(spec.stages):
        if i == 0:
            rates = f"{RND(D('c0', 'c0'))} AS overall_conv_rate, {RND('1.0')} AS stage_conv_rate, " \
                    f"CAST(NULL AS BIGINT) AS dropoff_count, CAST(NULL AS DOUBLE) AS dropoff_rate"
        else:
            rates = (f"{RND(D(f'c{i}', 'c0'))} AS overall_conv_rate, {RND(D(f'c{i}', f'c{i-1}'))} AS stage_conv_rate, "
                     f"(c{i-1} - c{i}) AS dropoff_count, {RND(D(f'(c{i-1} - c{i})', f'c{i-1}'))} AS dropoff_rate")
        rows.append(f"SELECT CAST({i} AS INTEGER) AS stage_idx, {q(n)} AS stage_name, {q(lbl)} AS stage_label, "
                    f"c{i} AS session_count, {rates}{extra(i)} FROM cnt")
    return rows


FUNNEL_CTES = [flags_cte("fl", SPEC.names), f"cnt AS (SELECT {sums(SPEC.n)} FROM fl)"]
MONEY = "CAST(SUM(CAST({} AS DECIMAL(18, 6))) AS DOUBLE)"
GMV = f"COALESCE({MONEY.format('gmv')}, 0.0)"
AOV = f"(SELECT COALESCE({GMV} / NULLIF(COUNT(*), 0), 0) FROM od)"
FINAL = D(f"c{SPEC.n - 1}", "c0")


def _leak_extra(i):
    if i == 0:
        return ", CAST(NULL AS DOUBLE) AS revenue_lost"
    return f", (CAST(c{i-1} - c{i} AS DOUBLE) * {FINAL} * {AOV}) AS revenue_lost"


LEAK_CTE = "leak AS (" + union(_funnel_rows(SPEC, _leak_extra)) + ")"

ORACLE = {}

ORACLE["q01_overall_funnel"] = W(*FUNNEL_CTES) + union(_funnel_rows(SPEC))

ORACLE["q02_revenue_leakage"] = W(*FUNNEL_CTES, LEAK_CTE) + f"""
SELECT stage_idx, stage_name, stage_label, session_count, overall_conv_rate, stage_conv_rate, dropoff_count,
       dropoff_rate, {RND('revenue_lost')} AS revenue_lost FROM leak"""

ORACLE["q03_leak_ranking"] = W(*FUNNEL_CTES, LEAK_CTE) + f"""
SELECT stage_idx, stage_name, stage_label, dropoff_count, {RND('revenue_lost')} AS revenue_lost,
       CAST(ROW_NUMBER() OVER (ORDER BY dropoff_count DESC, stage_idx) AS INTEGER) AS leak_rank,
       ROW_NUMBER() OVER (ORDER BY dropoff_count DESC, stage_idx) <= 2 AS is_top_leak
FROM leak WHERE dropoff_count IS NOT NULL"""

ORACLE["q04_leak_total"] = W(*FUNNEL_CTES, LEAK_CTE) + f"""
SELECT {RND('COALESCE(SUM(revenue_lost), 0)')} AS total_revenue_lost FROM leak"""


def _flow():
    parts = []
    for i in range(SPEC.n - 1):
        src = q(SPEC.labels[i])
        parts.append(f"SELECT CAST({i} AS INTEGER) AS source_idx, {src} AS source_stage, "
                     f"{q(SPEC.labels[i + 1])} AS target_stage, c{i + 1} AS value FROM cnt")
        parts.append(f"SELECT CAST({i} AS INTEGER) AS source_idx, {src} AS source_stage, "
                     f"'Dropped Off' AS target_stage, c{i} - c{i + 1} AS value FROM cnt")
    return union(parts)


ORACLE["q05_funnel_flow"] = W(*FUNNEL_CTES) + _flow()


def _waterfall():
    parts = []
    for i in range(1, SPEC.n):
        v = f"0.0 - COALESCE({D(f'(c{i-1} - c{i})', f'c{i-1}')}, 0.0)"
        parts.append(f"SELECT CAST({i} AS INTEGER) AS stage_idx, {q(SPEC.labels[i])} AS stage_label, "
                     f"'relative' AS measure, {RND(v)} AS value FROM cnt")
    parts.append(f"SELECT CAST({SPEC.n} AS INTEGER) AS stage_idx, 'Total' AS stage_label, 'total' AS measure, "
                 f"{RND(FINAL)} AS value FROM cnt")
    return union(parts)


ORACLE["q06_conversion_waterfall"] = W(*FUNNEL_CTES) + _waterfall()

# --- payments ----------------------------------------------------------------

ORACLE["q07_payment_failure_rate"] = W() + f"""
SELECT initiated, failed, {RND(f"COALESCE({D('failed', 'initiated')}, 0.0)")} AS failure_rate FROM (
  SELECT CAST(SUM(CASE WHEN event_name = {q(R.initiated)} THEN 1 ELSE 0 END) AS BIGINT) AS initiated,
         CAST(SUM(CASE WHEN event_name = {q(R.failed)} THEN 1 ELSE 0 END) AS BIGINT) AS failed
  FROM ev)"""

ORACLE["q08_failure_reasons"] = W() + f"""
SELECT COALESCE(reason, 'unknown') AS reason, COUNT(*) AS count FROM pr
WHERE event_name = {q(R.failed)} GROUP BY 1"""


def _method_failure(names):
    return W() + f"""
SELECT method, {RND('1.0 - AVG(CAST(ok AS DOUBLE))')} AS failure_rate FROM (
  SELECT session_id,
         BOOL_OR(event_name = {q(R.initiated)}) AS init,
         BOOL_OR(event_name = {q(R.success)}) AS ok,
         COALESCE(arg_min(COALESCE(method, 'unknown'), event_id) FILTER (WHERE COALESCE(method, 'unknown') <> 'unknown'),
                  'unknown') AS method
  FROM pr WHERE session_id IS NOT NULL AND event_name IN ({inlist(names)}) GROUP BY session_id)
WHERE init GROUP BY method"""


ORACLE["q25_method_failure_rate"] = _method_failure([R.initiated, R.success, R.failed])
ORACLE["q25_method_failure_rate_selected"] = _method_failure([R.initiated, R.success, R.failed, R.method_selected])

# --- segments ------------------------------------------------------------------


def _seg_wide(seg_expr: str, stages, where: str = "", name: str = "w") -> list[str]:
    n = len(stages)
    cond = f"WHERE ({seg_expr}) IS NOT NULL" + (f" AND {where}" if where else "")
    return [
        flags_cte("sf", stages),
        f"sj AS (SELECT {seg_expr} AS segment, se.session_id AS sid, sf.* EXCLUDE (session_id) FROM se LEFT JOIN sf "
        f"ON se.session_id = sf.session_id {cond})",
        f"{name} AS (SELECT segment, COUNT(*) AS total_sessions, " + ", ".join(
            f"COUNT(DISTINCT CASE WHEN s{i} = 1 THEN sid END) AS c{i}" for i in range(n)) + " FROM sj GROUP BY segment)",
    ]


def _seg_funnel(seg_expr: str) -> str:
    parts = [
        f"SELECT segment, CAST({i} AS INTEGER) AS stage_idx, {q(nm)} AS stage_name, {q(lbl)} AS stage_label, "
        f"c{i} AS session_count, total_sessions, {RND(D(f'c{i}', 'total_sessions'))} AS conv_rate FROM w"
        for i, (nm, lbl) in enumerate(SPEC.stages)
    ]
    return W(*_seg_wide(seg_expr, SPEC.names)) + union(parts)


LAST = [SPEC.names[-1]]
ORACLE["q09_segment_funnel"] = _seg_funnel("se.device_type")

ORACLE["q10_segment_gap"] = W(*_seg_wide("se.device_type", LAST, f"se.device_type IN ({inlist([C.SEG_A, C.SEG_B])})")) + f"""
SELECT {q(C.SEG_A)} AS segment_a, {q(C.SEG_B)} AS segment_b, {RND('cr_a')} AS cr_a, {RND('cr_b')} AS cr_b,
       {RND('(cr_a - cr_b) * 100.0')} AS gap_pp FROM (
  SELECT MAX(CASE WHEN segment = {q(C.SEG_A)} THEN {D('c0', 'total_sessions')} END) AS cr_a,
         MAX(CASE WHEN segment = {q(C.SEG_B)} THEN {D('c0', 'total_sessions')} END) AS cr_b FROM w)"""

ORACLE["q11_segment_conversion"] = W(*_seg_wide("se.traffic_source", LAST),
                                     f"r AS (SELECT segment, total_sessions, c0 AS conversions, "
                                     f"{D('c0', 'total_sessions')} AS conv_rate FROM w)") + f"""
SELECT segment, total_sessions, conversions, {RND('conv_rate')} AS conv_rate,
       COALESCE(segment = (SELECT segment FROM r WHERE conv_rate IS NOT NULL
                           ORDER BY conv_rate DESC, segment LIMIT 1), false) AS is_best
FROM r"""

TIER_SQL = (f"CASE WHEN se.{C.TIER_COL} IN ({inlist(C.TIER1)}) THEN 'Tier 1' "
            f"WHEN se.{C.TIER_COL} IN ({inlist(C.TIER2)}) THEN 'Tier 2' ELSE 'Tier 3' END")
ORACLE["q12_city_tier_funnel"] = _seg_funnel(TIER_SQL)

ORACLE["q13_payment_mix_by_tier"] = W() + f"""
SELECT segment, orders, method_orders, {RND(f"COALESCE({D('method_orders', 'orders')}, 0.0)")} AS method_rate FROM (
  SELECT {TIER_SQL} AS segment, COUNT(*) AS orders,
         CAST(SUM(CASE WHEN od.payment_method = {q(C.MIX_METHOD)} THEN 1 ELSE 0 END) AS BIGINT) AS method_orders
  FROM od JOIN (SELECT DISTINCT session_id, {C.TIER_COL} FROM se) se ON od.session_id = se.session_id GROUP BY 1)"""

CELLS = f"""cells AS (
  SELECT se.traffic_source, se.device_type, COUNT(od.order_id) * 1.0 / COUNT(*) AS rate
  FROM se LEFT JOIN od ON se.session_id = od.session_id
  WHERE se.traffic_source IS NOT NULL AND se.device_type IS NOT NULL
  GROUP BY se.traffic_source, se.device_type)"""
ORACLE["q14_conversion_matrix"] = W(CELLS) + "SELECT traffic_source, " + ", ".join(
    f"{RND(f'MAX(CASE WHEN device_type = {q(v)} THEN rate END)')} AS \"{v}\"" for v in C.DEVICE_VALUES
) + " FROM cells GROUP BY traffic_source"

ORACLE["q15_matrix_extremes"] = W(CELLS) + f"""
SELECT * FROM (SELECT 'best' AS kind, traffic_source, device_type, {RND('rate')} AS rate FROM cells
               ORDER BY rate DESC, device_type, traffic_source LIMIT 1)
UNION ALL
SELECT * FROM (SELECT 'worst' AS kind, traffic_source, device_type, {RND('rate')} AS rate FROM cells
               ORDER BY rate ASC, device_type, traffic_source LIMIT 1)"""

ORACLE["q30_device_dropoff"] = W(flags_cte("sf", [R.product_view, R.add_to_cart, R.checkout, R.purchase], True)) + f"""
SELECT device_type, total_sessions, product_views, cart_adds, checkouts, purchases,
       {RND(PCT('purchases', 'total_sessions'))} AS cr_percentage,
       {RND(PCT('checkouts - purchases', 'checkouts'))} AS checkout_abandonment_rate
FROM (SELECT se.device_type, COUNT(*) AS total_sessions,
             CAST(SUM(s0) AS BIGINT) AS product_views, CAST(SUM(s1) AS BIGINT) AS cart_adds,
             CAST(SUM(s2) AS BIGINT) AS checkouts, CAST(SUM(s3) AS BIGINT) AS purchases
      FROM sf JOIN (SELECT DISTINCT session_id, device_type FROM se) se ON sf.session_id = se.session_id
      GROUP BY se.device_type)"""

ORACLE["q38_dashboard_segment_funnel"] = W(*_seg_wide("se.traffic_source", SPEC.names)) + union([
    f"SELECT segment, CAST({i} AS INTEGER) AS step_idx, {q(nm)} AS step, c{i} AS sessions, "
    f"{RND(D(f'c{i}', 'c0'))} AS pct_initial FROM w"
    for i, nm in enumerate(SPEC.names)
])

ORACLE["q45_segment_share"] = W() + f"""
, g AS (
  SELECT se.device_type AS segment, COUNT(*) AS sessions, CAST(COALESCE(SUM(o.n), 0) AS BIGINT) AS orders,
         COALESCE(CAST(SUM(o.rev) AS DOUBLE), 0.0) AS revenue
  FROM se LEFT JOIN (SELECT session_id, COUNT(*) AS n, SUM(CAST(gmv AS DECIMAL(18, 6))) AS rev FROM od
                     WHERE session_id IS NOT NULL GROUP BY session_id) o
         ON se.session_id = o.session_id
  WHERE se.device_type IS NOT NULL GROUP BY 1)
SELECT segment, sessions, orders, {RND('revenue')} AS revenue,
       {RND(D('sessions', '(SELECT SUM(sessions) FROM g)'))} AS session_share,
       {RND(D('orders', '(SELECT SUM(orders) FROM g)'))} AS order_share,
       {RND(D('revenue', '(SELECT SUM(revenue) FROM g)'))} AS revenue_share
FROM g""".replace("\n, g AS", ", g AS", 1)

# --- time ----------------------------------------------------------------------

MERGED = "mg AS (SELECT se.*, od.order_id, od.gmv FROM se LEFT JOIN od ON se.session_id = od.session_id)"
CONV = "CASE WHEN order_id IS NOT NULL THEN 1 ELSE 0 END"

ORACLE["q16_hourly_conversion"] = W(MERGED, f"""h AS (
  SELECT session_hour, COUNT(session_id) AS sessions, CAST(SUM({CONV}) AS BIGINT) AS conversions
  FROM mg WHERE session_hour IS NOT NULL GROUP BY session_hour)""") + f"""
SELECT session_hour, sessions, conversions, {RND(D('conversions', 'sessions'))} AS conv_rate FROM h"""

ORACLE["q17_peak_hour"] = W(MERGED, f"""h AS (
  SELECT session_hour, {D(f'SUM({CONV})', 'COUNT(session_id)')} AS conv_rate
  FROM mg WHERE session_hour IS NOT NULL GROUP BY session_hour)""") + f"""
SELECT session_hour, {RND('conv_rate')} AS conv_rate FROM h WHERE conv_rate IS NOT NULL
ORDER BY conv_rate DESC, session_hour LIMIT 1"""

ORACLE["q18_hour_day_matrix"] = W(MERGED) + "SELECT session_hour, " + ", ".join(
    f"{RND(D(f'SUM(CASE WHEN session_day_of_week = {d} THEN {CONV} END)', f'SUM(CASE WHEN session_day_of_week = {d} THEN 1 END)'))} AS d{d}"
    for d in range(7)
) + " FROM mg WHERE session_hour IS NOT NULL AND session_day_of_week IS NOT NULL GROUP BY session_hour"

DAYS = "[" + ", ".join(q(d) for d in WEEKDAY_NAMES) + "]"
ORACLE["q19_weekday_conversion"] = W(MERGED, f"""r AS (
  SELECT session_day_of_week, {D(f'SUM({CONV})', 'COUNT(*)')} AS conv_rate
  FROM mg WHERE session_day_of_week IS NOT NULL GROUP BY 1)""") + f"""
SELECT session_day_of_week, list_extract({DAYS}, session_day_of_week + 1) AS day_name, {RND('conv_rate')} AS conv_rate,
       COALESCE(session_day_of_week = (SELECT session_day_of_week FROM r WHERE conv_rate IS NOT NULL
                                       ORDER BY conv_rate DESC, session_day_of_week LIMIT 1), false) AS is_best
FROM r"""

ORACLE["q20_monthly_trend"] = W(MERGED) + f"""
SELECT month, sessions, conversions, {RND('gmv')} AS gmv, {RND(D('conversions', 'sessions'))} AS conv_rate FROM (
  SELECT strftime(session_date, '%Y-%m') AS month, COUNT(session_id) AS sessions,
         CAST(SUM({CONV}) AS BIGINT) AS conversions, {GMV} AS gmv
  FROM mg GROUP BY 1)"""

BUCKET = ("CASE WHEN session_duration_seconds < 30 THEN 0 WHEN session_duration_seconds < 120 THEN 1 "
          "WHEN session_duration_seconds < 300 THEN 2 WHEN session_duration_seconds < 900 THEN 3 ELSE 4 END")
BUCKETS = ", ".join(f"({i}, {q(b)})" for i, b in enumerate(DURATION_BUCKETS))
ORACLE["q21_duration_conversion"] = W(MERGED) + f"""
SELECT CAST(b.i AS INTEGER) AS bucket_idx, b.label AS duration_bucket, {RND('x.rate')} AS conv_rate
FROM (VALUES {BUCKETS}) b(i, label)
LEFT JOIN (SELECT {BUCKET} AS i, {D(f'SUM({CONV})', 'COUNT(*)')} AS rate FROM mg GROUP BY 1) x ON b.i = x.i"""

ORACLE["q22_bounce_rate"] = W(MERGED) + f"""
SELECT {RND(D('SUM(CASE WHEN session_duration_seconds < 30 THEN 1 ELSE 0 END)', 'COUNT(*)'))} AS bounce_rate FROM mg"""

ORACLE["q31_time_to_purchase"] = W() + f"""
SELECT {RND('ROUND(AVG(CAST(epoch_us(pt) - epoch_us(st) AS DOUBLE) / 1000000.0 / 60.0), 2)')} AS avg_minutes_to_purchase
FROM (SELECT session_id, MIN(event_timestamp) AS st,
             MAX(CASE WHEN event_name = {q(R.purchase)} THEN event_timestamp END) AS pt
      FROM ev GROUP BY session_id
      HAVING MAX(CASE WHEN event_name = {q(R.purchase)} THEN 1 ELSE 0 END) = 1)"""

ORACLE["q35_daily_revenue"] = W() + f"""
SELECT CAST(order_date AS DATE) AS date, {RND(GMV)} AS gmv FROM od GROUP BY 1"""

# --- products ------------------------------------------------------------------

PS = f"""ps AS (
  SELECT session_id, BOOL_OR(event_name = {q(R.product_view)}) AS viewed, BOOL_OR(event_name = {q(R.add_to_cart)}) AS added,
         MAX(price) AS price, arg_min(COALESCE(category, 'unknown'), event_id) AS category
  FROM pr WHERE session_id IS NOT NULL AND event_name IN ({inlist([R.product_view, R.add_to_cart])}) GROUP BY session_id)"""

ORACLE["q23_price_cart_histogram"] = W(PS) + f"""
SELECT {RND(f'FLOOR(price / {dbl(C.PRICE_BIN)}) * {dbl(C.PRICE_BIN)}')} AS price_bin, added, COUNT(*) AS sessions
FROM ps WHERE viewed AND price IS NOT NULL GROUP BY 1, 2"""

ORACLE["q24_category_cart_rate"] = W(PS) + f"""
SELECT category, {RND('AVG(CAST(added AS DOUBLE))')} AS add_rate FROM ps WHERE viewed GROUP BY category"""


def _abandoned(reached: str) -> str:
    """``reached``: rows (product_id, category, a, p), one per session that added or bought the product."""
    return W(reached) + f"""
SELECT product_id, category, a AS added_to_cart_sessions, p AS purchased_sessions, a - p AS abandonments,
       {RND(PCT('a - p', 'a'))} AS abandonment_rate
FROM (SELECT product_id, category, CAST(SUM(a) AS BIGINT) AS a, CAST(SUM(p) AS BIGINT) AS p FROM reached GROUP BY ALL)
WHERE a > {C.ABANDON_MIN_SESSIONS} ORDER BY abandonments DESC, product_id, category LIMIT {C.ABANDON_TOP_K}"""


ORACLE["q32_abandoned_products"] = _abandoned(f"""reached AS (
  SELECT product_id, category, session_id, MAX((event_name = {q(R.add_to_cart)})::INT) AS a,
         MAX((event_name = {q(R.purchase)})::INT) AS p
  FROM pr WHERE product_id IS NOT NULL AND session_id IS NOT NULL GROUP BY ALL)""")

ORACLE["q32_abandoned_products_via_session"] = _abandoned(f"""reached AS (
  SELECT DISTINCT product_id, category, session_id, 1 AS a,
         (session_id IN (SELECT b.session_id FROM ev b WHERE b.event_name = {q(R.purchase)} AND b.session_id IS NOT NULL))::INT AS p
  FROM pr WHERE product_id IS NOT NULL AND session_id IS NOT NULL AND event_name = {q(R.add_to_cart)})""")

# --- revenue -------------------------------------------------------------------


def _roi(dedup: bool) -> str:
    """Per session: its row count, purchase events and revenue; a session row joins every purchase event and order."""
    times = "1" if dedup else "n_rows * greatest(buys, 1)"
    return W(f"""per AS (
  SELECT traffic_source, session_id, COUNT(*) AS n_rows,
         (SELECT COUNT(*) FROM ev b WHERE b.session_id = se.session_id AND b.event_name = {q(R.purchase)}) AS buys,
         (SELECT SUM(CAST(o.gmv AS DECIMAL(18, 6))) FROM od o WHERE o.session_id = se.session_id) AS gmv
  FROM se GROUP BY traffic_source, session_id)""", f"""src AS (
  SELECT traffic_source, COUNT(session_id) AS n, COUNT(CASE WHEN buys > 0 THEN session_id END) AS c,
         COALESCE(CAST(SUM(gmv * {times}) AS DOUBLE), 0.0) AS r
  FROM per GROUP BY traffic_source)""") + f"""
SELECT traffic_source, n AS total_sessions, c AS converting_sessions, {RND(PCT('c', 'n'))} AS conversion_rate,
       {RND('r')} AS total_revenue, {RND('ROUND(r / NULLIF(n, 0), 2)')} AS revenue_per_session
FROM src"""


ORACLE["q33_channel_roi"] = _roi(False)
ORACLE["q33_channel_roi_dedup"] = _roi(True)

ORACLE["q34_kpi_overview"] = W() + f"""
SELECT {RND(GMV)} AS total_revenue, COUNT(*) AS total_orders, {RND(MONEY.format('gmv') + ' / NULLIF(COUNT(gmv), 0)')} AS avg_order_value,
       {RND(D(f"(SELECT COUNT(DISTINCT session_id) FROM ev WHERE event_name = {q(R.purchase)})", "(SELECT COUNT(DISTINCT session_id) FROM se)") + " * 100.0")} AS conversion_rate
FROM od"""

# --- funnel SQL forms ----------------------------------------------------------


def _wide():
    names = SPEC.names
    cols = ["total_sessions"] + [f"c{i} AS sessions_with_{names[i]}" for i in range(SPEC.n)]
    cols += [f"{RND(PCT(f'c{i}', f'c{i-1}'))} AS {names[i-1]}_to_{names[i]}_rate" for i in range(1, SPEC.n)]
    cols.append(f"{RND(PCT(f'c{SPEC.n - 1}', 'total_sessions'))} AS overall_conversion_rate")
    return W(flags_cte("fl", names, all_sessions=True, keep_null=True),
             f"cnt AS (SELECT COUNT(session_id) AS total_sessions, {sums(SPEC.n)} FROM fl)") + "SELECT " + ", ".join(cols) + " FROM cnt"


ORACLE["q29_wide_funnel"] = _wide()

ORACLE["q36_dashboard_funnel"] = W(*FUNNEL_CTES) + union([
    f"SELECT CAST({i} AS INTEGER) AS step_idx, {q(n)} AS step, {q(lbl)} AS label, c{i} AS sessions, "
    f"{RND(D(f'c{i}', 'c0'))} AS pct_initial, {RND('1.0' if i == 0 else D(f'c{i}', f'c{i-1}'))} AS pct_previous FROM cnt"
    for i, (n, lbl) in enumerate(SPEC.stages)
])

_ab = [R.add_to_cart, R.checkout, R.purchase]
ORACLE["q37_abandonment_rates"] = W(flags_cte("fl", _ab), f"cnt AS (SELECT {sums(3)} FROM fl)") + f"""
SELECT {RND('CASE WHEN c0 > 0 THEN 100.0 - (CAST(c1 AS DOUBLE) / CAST(c0 AS DOUBLE)) * 100.0 ELSE 0.0 END')} AS cart_abandonment,
       {RND('CASE WHEN c1 > 0 THEN 100.0 - (CAST(c2 AS DOUBLE) / CAST(c1 AS DOUBLE)) * 100.0 ELSE 0.0 END')} AS checkout_abandonment
FROM cnt"""

# --- statistics ----------------------------------------------------------------


def _erfc(x: str) -> str:
    t = f"(1.0 / (1.0 + 0.5 * ({x})))"
    poly = " + ".join(f"{dbl(c)} * {t} ** {i}" for i, c in enumerate(ERFC))
    return f"({t} * EXP({poly} - ({x}) * ({x})))"


def _ab(seg_col: str, a, b, a_sql: str, b_sql: str) -> str:
    na, xa, nb, xb = "CAST(n_a AS DOUBLE)", "CAST(x_a AS DOUBLE)", "CAST(n_b AS DOUBLE)", "CAST(x_b AS DOUBLE)"
    p = f"(({xa} + {xb}) / NULLIF({na} + {nb}, 0))"
    var = f"({p} * (1.0 - {p}) * ((1.0 / NULLIF({na}, 0)) + (1.0 / NULLIF({nb}, 0))))"
    z = f"(CASE WHEN {var} > 0 THEN (({xa} / NULLIF({na}, 0)) - ({xb} / NULLIF({nb}, 0))) / SQRT({var}) END)"
    return W(*_seg_wide(f"se.{seg_col}", LAST, f"se.{seg_col} IN ({a_sql}, {b_sql})"),
             f"""one AS (
  SELECT CAST(COALESCE(MAX(CASE WHEN segment = {a_sql} THEN total_sessions END), 0) AS BIGINT) AS n_a,
         CAST(COALESCE(MAX(CASE WHEN segment = {a_sql} THEN c0 END), 0) AS BIGINT) AS x_a,
         CAST(COALESCE(MAX(CASE WHEN segment = {b_sql} THEN total_sessions END), 0) AS BIGINT) AS n_b,
         CAST(COALESCE(MAX(CASE WHEN segment = {b_sql} THEN c0 END), 0) AS BIGINT) AS x_b FROM w)""",
             f"zz AS (SELECT *, {z} AS z FROM one)",
             f"pp AS (SELECT *, {_erfc(f'ABS(z) / {dbl(2.0 ** 0.5)}')} AS p_value FROM zz)") + f"""
SELECT {q(str(a))} AS label_a, {q(str(b))} AS label_b, n_a, x_a, n_b, x_b,
       {RND(D('x_a', 'n_a'))} AS conv_a, {RND(D('x_b', 'n_b'))} AS conv_b, {RND('z')} AS z, {RND('p_value')} AS p_value,
       COALESCE(p_value < 0.05, false) AS significant,
       CASE WHEN p_value < 0.05 THEN 'significant' ELSE 'not significant' END AS verdict
FROM pp"""


ORACLE["q26_ab_significance_device"] = _ab("device_type", C.SEG_A, C.SEG_B, q(C.SEG_A), q(C.SEG_B))
ORACLE["q26_ab_significance_new_user"] = _ab("is_new_user", True, False, "true", "false")

_K = 2.0 * POWER_DELTA ** 2
ORACLE["q28_experiment_sample_size"] = W(*_seg_wide("se.traffic_source", LAST),
                                         f"b AS (SELECT segment, {D('c0', 'total_sessions')} AS baseline FROM w)",
                                         f"m AS (SELECT segment, baseline, baseline * {dbl(C.LIFT)} AS mde FROM b)",
                                         "e AS (SELECT *, ABS(mde) / NULLIF(SQRT(baseline * (1.0 - baseline)), 0) AS effect FROM m)") + f"""
SELECT segment, {RND('baseline')} AS baseline, {RND('mde')} AS mde,
       CASE WHEN effect > 0 THEN CAST(FLOOR({dbl(_K)} / (effect * effect)) AS BIGINT) END AS n_per_variant
FROM e"""

EFFORT_VALUES = ", ".join(f"({q(k)}, {v})" for k, v in sorted(C.EFFORT.items()))


def _priority():
    parts = []
    for i in range(1, SPEC.n):
        parts.append(f"SELECT segment, CAST({i} AS INTEGER) AS stage_idx, {q(SPEC.names[i])} AS stage_name, "
                     f"c{i-1} - c{i} AS sessions, CAST(c{i-1} - c{i} AS DOUBLE) * {D(f'c{SPEC.n - 1}', 'c0')} * {AOV} "
                     f"AS revenue_impact FROM w")
    return W(*_seg_wide("se.device_type", SPEC.names), "lg AS (" + union(parts) + ")") + f"""
SELECT lg.segment, lg.stage_idx, lg.stage_name, CAST(ef.ease AS INTEGER) AS ease, {RND('lg.revenue_impact')} AS revenue_impact,
       lg.sessions,
       CASE WHEN ef.ease >= 6 AND lg.revenue_impact >= 400000 THEN 'Quick Wins'
            WHEN ef.ease < 6 AND lg.revenue_impact >= 400000 THEN 'Major Projects'
            WHEN ef.ease >= 6 AND lg.revenue_impact < 400000 THEN 'Fill-ins'
            WHEN ef.ease < 6 AND lg.revenue_impact < 400000 THEN 'Don''t Bother' END AS category
FROM lg LEFT JOIN (VALUES {EFFORT_VALUES}) ef(stage_name, ease) ON lg.stage_name = ef.stage_name"""


ORACLE["q27_priority_matrix"] = _priority()

# --- users ---------------------------------------------------------------------

ROLLUP = f"""ru AS (
  SELECT c.c_custkey AS user_id, CAST(COALESCE(s.n, 0) AS BIGINT) AS total_sessions,
         CAST(COALESCE(o.n, 0) AS BIGINT) AS total_orders, COALESCE(o.r, 0.0) AS total_revenue
  FROM customer c
  LEFT JOIN (SELECT user_id, COUNT(*) AS n FROM se GROUP BY user_id) s ON c.c_custkey = s.user_id
  LEFT JOIN (SELECT o_custkey, COUNT(o_orderkey) AS n, {MONEY.format('o_totalprice')} AS r FROM orders GROUP BY o_custkey) o
         ON c.c_custkey = o.o_custkey)"""
ORACLE["q39_user_rollup"] = W(ROLLUP) + f"SELECT user_id, total_sessions, total_orders, {RND('total_revenue')} AS total_revenue FROM ru"
ORACLE["q40_loyalty_tiers"] = W(ROLLUP) + f"""
SELECT user_id, total_sessions, total_orders, {RND('total_revenue')} AS total_revenue,
       CASE WHEN total_orders = 0 THEN 'new' WHEN total_orders = 1 THEN 'bronze'
            WHEN total_orders <= 3 THEN 'silver' ELSE 'gold' END AS loyalty_tier
FROM ru"""

ORACLE["q41_first_seen"] = W() + """
SELECT c.c_custkey AS user_id, COALESCE(f.d, (SELECT MIN(session_date) FROM se)) AS first_seen_date
FROM customer c LEFT JOIN (SELECT user_id, MIN(session_date) AS d FROM se GROUP BY user_id) f ON c.c_custkey = f.user_id"""

ORACLE["q42_new_session_flag"] = W() + """
SELECT session_id, user_id,
       COALESCE(ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY session_date, session_hour, session_id) = 1
                AND user_id IS NOT NULL, false) AS is_new_user
FROM se"""

ORACLE["q43_campaign_tag"] = W() + f"""
SELECT session_id,
       CASE WHEN traffic_source IN ({inlist(C.PAID_SOURCES)})
            THEN 'campaign_' || traffic_source || '_' || strftime(session_date, '%b') END AS utm_campaign
FROM se"""

ORACLE["q44_dataset_summary"] = W() + f"""
SELECT (SELECT COUNT(*) FROM se) AS n_sessions, (SELECT COUNT(*) FROM ev) AS n_events,
       (SELECT COUNT(*) FROM customer) AS n_users, COUNT(*) AS n_orders,
       {RND(D('COUNT(*)', '(SELECT COUNT(*) FROM se)'))} AS conversion_rate
FROM od"""

# --- scalar columns and sinks ----------------------------------------------------

ORACLE["c13_peak_hours"] = W() + "SELECT session_hour IN (20, 21, 22) AS is_peak_hour, COUNT(*) AS sessions FROM se GROUP BY 1"
ORACLE["c15_text_timestamps"] = ORACLE["q31_time_to_purchase"]
ORACLE["c18_page_urls"] = W() + """
SELECT '/' || replace(event_name, '_', '-') AS page_url,
       array_to_string(list_transform(string_split(event_name, '_'), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS title,
       COUNT(*) AS events FROM ev GROUP BY 1, 2"""
ORACLE["c20_display_formats"] = W() + f"""
SELECT '₹' || format('{{:,}}', CAST(ROUND(total_revenue, 0) AS BIGINT)) AS revenue_text, format('{{:,}}', total_orders) AS orders_text,
       '₹' || printf('%.1f', total_revenue / 100000.0) || 'L' AS revenue_lakh, printf('%.2f%%', conversion_rate) AS conversion_text
FROM (SELECT {GMV} AS total_revenue, COUNT(*) AS total_orders,
             {D(f"(SELECT COUNT(DISTINCT session_id) FROM ev WHERE event_name = {q(R.purchase)})", "(SELECT COUNT(DISTINCT session_id) FROM se)")} * 100.0
             AS conversion_rate FROM od)"""
ORACLE["c23_properties_json"] = W() + """
SELECT '{' || array_to_string(list_filter(['"category":"' || category || '"', '"method":"' || method || '"',
                                           '"reason":"' || reason || '"'], lambda x: x IS NOT NULL), ',') || '}' AS properties,
       COUNT(*) AS events FROM pr GROUP BY 1"""
ORACLE["c24_count_arrays"] = W(*_seg_wide("se.device_type", SPEC.names)) + union([
    f"SELECT segment, total_sessions, CAST({i} AS INTEGER) AS stage_idx, c{i} AS session_count, "
    f"{RND(D(f'c{i}', 'total_sessions'))} AS conv_rate FROM w" for i in range(SPEC.n)])
ORACLE["s04_named_tables"] = W() + """
SELECT se.device_type AS segment, COUNT(*) AS events FROM ev JOIN se ON ev.session_id = se.session_id GROUP BY 1"""
ORACLE["s07_csv_round_trip"] = W() + f"""
SELECT payment_method, COUNT(*) AS orders, {RND(GMV)} AS gmv, CAST(MIN(order_date) AS DATE) AS first_date,
       CAST(MAX(order_date) AS DATE) AS last_date FROM od GROUP BY 1"""

# --- stored and incremental forms -------------------------------------------------

ORACLE["b09_bucketed_segment_funnel"] = ORACLE["q09_segment_funnel"]
ORACLE["b13_bucketed_payment_mix"] = ORACLE["q13_payment_mix_by_tier"]
ORACLE["b30_bucketed_device_dropoff"] = ORACLE["q30_device_dropoff"]
ORACLE["b33_bucketed_channel_roi"] = ORACLE["q33_channel_roi"]
ORACLE["b45_bucketed_segment_share"] = ORACLE["q45_segment_share"]
ORACLE["v08_variant_failure_reasons"] = ORACLE["q08_failure_reasons"]
ORACLE["v23_variant_price_histogram"] = ORACLE["q23_price_cart_histogram"]
ORACLE["v24_variant_category_cart_rate"] = ORACLE["q24_category_cart_rate"]
ORACLE["v25_variant_method_failure_rate"] = ORACLE["q25_method_failure_rate"]
ORACLE["a03_incremental_funnel"] = ORACLE["q01_overall_funnel"]

ORACLE["a03_incremental_ledger"] = W("""dy AS (SELECT session_id, CAST(event_timestamp AS DATE) AS day FROM ev)""",
    """mid AS (SELECT min(day) + CAST(floor(date_diff('day', min(day), max(day)) / 2) AS INTEGER) AS m FROM dy)""") + """
SELECT CAST(CASE WHEN day < (SELECT m FROM mid) THEN 1 ELSE 2 END AS BIGINT) AS "update",
       COUNT(DISTINCT day) AS days, COUNT(DISTINCT session_id || CAST(day AS VARCHAR)) AS sessions
FROM dy WHERE day IS NOT NULL GROUP BY 1"""

ORACLE["w05_first_sessions"] = W() + """
SELECT session_id, user_id, session_date, session_hour FROM se WHERE user_id IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY session_date, session_hour, session_id) = 1"""

ORACLE["s03_load_report"] = W() + """
SELECT * FROM (VALUES ('users', 'missing table', NULL, 1), ('orders', 'missing column', 'coupon_code', 1),
                      ('sessions', 'missing column', 'utm_campaign', 1), ('sessions', 'unknown column', 'campaign', 1)
              ) f(table_name, problem, detail, n)
UNION ALL SELECT 'orders', 'bad row', NULL, COUNT(*) FROM od WHERE order_id % 50 IN (0, 1)
UNION ALL SELECT 'orders', 'loaded', NULL, COUNT(*) FROM od WHERE order_id % 50 NOT IN (0, 1)
UNION ALL SELECT 'sessions', 'loaded', NULL, COUNT(*) FROM se
UNION ALL SELECT 'events', 'loaded', NULL, COUNT(*) FROM ev"""


def _cube(grouping: str, cols: str) -> str:
    group = f" GROUP BY {cols}" if cols else ""
    pick = ", ".join(x if x in cols.split(", ") else f"NULL AS {x}" for x in ("hour", "weekday", "month", "bucket"))
    return (f"SELECT {q(grouping)} AS \"grouping\", {pick}, COUNT(*) AS merged, COUNT(session_id) AS sessions, "
            f"CAST(SUM({CONV}) AS BIGINT) AS conversions, {RND(GMV)} AS gmv, "
            f"CAST(SUM(CASE WHEN session_duration_seconds < 30 THEN 1 ELSE 0 END) AS BIGINT) AS bounces FROM cu{group}")


ORACLE["a16_time_cube"] = W(MERGED, f"""cu AS (SELECT session_id, order_id, gmv, session_duration_seconds, session_hour AS hour,
  session_day_of_week AS weekday, strftime(session_date, '%Y-%m') AS month, CAST({BUCKET} AS INTEGER) AS bucket FROM mg)""") + union(
    [_cube("hour", "hour"), _cube("weekday", "weekday"), _cube("hour_weekday", "hour, weekday"), _cube("month", "month"),
     _cube("duration", "bucket"), _cube("all", "")])


# --- bins from the data, table functions, bitmaps -------------------------------

def _width(src: str, group: str) -> str:
    """Freedman-Diaconis widths of ``src`` (x, and ``group``) from exact quartiles, rounded to 1, 2, 5 x 10^k."""
    return f"""qs_{src} AS (
  SELECT {group} category, COUNT(*) AS n, MIN(x) AS low, MAX(x) AS high, quantile_disc(x, 0.75) - quantile_disc(x, 0.25) AS iqr
  FROM {src} {'GROUP BY ALL' if group == '' else ''}),
wr_{src} AS (
  SELECT *, CASE WHEN n < 2 OR high = low THEN 1.0::DOUBLE WHEN iqr > 0 THEN 2.0::DOUBLE * iqr / power(n::DOUBLE, 1.0::DOUBLE / 3.0::DOUBLE)
    ELSE (high - low) / (ceil(log2(n::DOUBLE)) + 1) END AS raw FROM qs_{src} WHERE n > 0),
wd_{src} AS (
  SELECT *, CASE WHEN part < sqrt(2.0::DOUBLE) THEN 1 WHEN part < sqrt(10.0::DOUBLE) THEN 2 WHEN part < sqrt(50.0::DOUBLE) THEN 5 ELSE 10 END * base
    AS bin_width
  FROM (SELECT *, power(10.0::DOUBLE, floor(log10(raw))) AS base, raw / power(10.0::DOUBLE, floor(log10(raw))) AS part FROM wr_{src}))"""


PRICES = "px AS (SELECT price AS x, category, added FROM ps WHERE viewed AND price IS NOT NULL)"

ORACLE["a19_auto_price_bins"] = W(PS, PRICES, _width("px", "NULL AS")) + f"""
SELECT {RND('FLOOR(x / bin_width) * bin_width')} AS price_bin, {RND('bin_width')} AS bin_width, added, COUNT(*) AS sessions
FROM px, (SELECT bin_width FROM wd_px) GROUP BY ALL"""

ORACLE["a19_category_bin_widths"] = W(PS, PRICES, "py AS (SELECT * FROM px)", _width("px", ""), _width("py", "CAST(NULL AS VARCHAR) AS")) + union([
    f"SELECT category, n, {RND('low')} AS low, {RND('high')} AS high, {RND('bin_width')} AS bin_width FROM wd_{s}" for s in ("px", "py")])

ORACLE["x05_sql_overall_funnel"] = ORACLE["q01_overall_funnel"]
ORACLE["x05_sql_segment_funnel"] = ORACLE["q09_segment_funnel"]
ORACLE["x05_sql_revenue_leakage"] = ORACLE["q02_revenue_leakage"]
ORACLE["o03_bitmap_abandoned"] = ORACLE["o03_daily_bitmaps"] = ORACLE["q32_abandoned_products"]

ORACLE_SQL = {k: ORACLE[k] for k in C.QUERIES if k in ORACLE}
