"""DuckDB twins of the registered queries (same column names and types).

Half-to-even rounding at 2 places is written ``round_even(x * 100, 0) / 100``;
division guards use NULLIF (DuckDB's x/0.0 is inf).  Sums of money go through
DECIMAL, exactly as on the Spark side.
"""

from __future__ import annotations


def r2(x: str) -> str:
    return f"round_even(({x}) * 100.0, 0) / 100.0"


def two_stage_sql(src: str, station: str, group: list, period: str, stage1: list, derive: dict,
                  stage2: list, diffs: list = (), complete: bool = False) -> str:
    """SQL twin of :func:`regiostat.plans.climate.two_stage`: float means of
    float means (compensated sums), differences, then one half-even rounding.

    stage1/stage2: (out, fn, input); derive: name -> SQL over stage-1 columns.
    """
    keys1 = [station, *group, period]
    k1 = ", ".join(keys1)
    g2 = ", ".join([*group, period])
    nn = " AND ".join(f"{k} IS NOT NULL" for k in keys1)

    def agg(out, fn, x):
        x = f"CAST({x} AS DOUBLE)"
        # compensated sums of values in one order: an unordered sum varies with the number of threads
        return {"mean": f"FSUM({x} ORDER BY {x}) / NULLIF(COUNT({x}), 0)", "sum": f"COALESCE(FSUM({x} ORDER BY {x}), 0)",
                "std": f"STDDEV_SAMP({x})", "max": f"MAX({x})", "min": f"MIN({x})"}[fn] + f" AS {out}"

    having = "HAVING bit_count(bit_or(1 << month)) = 12" if complete else ""
    dsel = "".join(f", {e} AS {n}" for n, e in (derive or {}).items())
    a1 = [agg(*spec) for spec in stage1]
    a2 = [agg(*spec) for spec in stage2]
    dd = "".join(f", {x} - LAG({x}) OVER (PARTITION BY {group[0]} ORDER BY {period}) AS {o}" for x, o in diffs)
    final = [f"{r2(c)} AS {c}" for c in [*(o for o, _, _ in stage2), *(o for _, o in diffs)]]
    nn2 = " AND ".join(f"{k} IS NOT NULL" for k in [*group, period])
    return f"""
WITH {src},
s1 AS (SELECT {k1}, {", ".join(a1)} FROM obs WHERE {nn} GROUP BY {k1} {having}),
st AS (SELECT *{dsel} FROM s1),
f AS (SELECT {g2}, {", ".join(a2)} FROM st WHERE {nn2} GROUP BY {g2}),
d AS (SELECT *{dd} FROM f)
SELECT {g2}, {", ".join(final)} FROM d"""


OBS = """
obs AS (
  SELECT n.n_nationkey AS station, n.n_name AS station_name, n.n_regionkey AS sd_code,
         r.r_name AS sd_name_std,
         CAST(year(o.o_orderdate) AS INTEGER) AS year, CAST(month(o.o_orderdate) AS INTEGER) AS month,
         round_even(CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) * 100.0, 0) / 100.0
           AS mean_price,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total_price,
         MAX(o.o_totalprice) AS max_price, MIN(o.o_totalprice) AS min_price, COUNT(*) AS order_cnt
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL
)"""

DISTRICT = OBS + """,
dm AS (
  SELECT year, month, CAST(sd_code AS INTEGER) AS sd_code, sd_name_std AS sd_name,
         station_name AS sgg_name, order_cnt AS house_cnt, mean_price AS power_usage, min_price AS bill
  FROM obs
)"""


TREND_STAGE1 = [
    ("avg_price", "mean", "mean_price"), ("avg_max_price", "mean", "max_price"),
    ("avg_min_price", "mean", "min_price"), ("year_max_price", "max", "max_price"),
    ("year_min_price", "min", "min_price"), ("total_price", "sum", "total_price"),
    ("avg_orders", "mean", "order_cnt"),
]
TREND_STAGE2 = [
    ("avg_price", "mean", "avg_price"), ("avg_max_price", "mean", "avg_max_price"),
    ("avg_min_price", "mean", "avg_min_price"), ("year_max_price", "max", "year_max_price"),
    ("year_min_price", "min", "year_min_price"), ("total_price", "mean", "total_price"),
    ("avg_orders", "mean", "avg_orders"), ("avg_price_range", "mean", "avg_price_range"),
]
_GROUP = ["sd_code", "sd_name_std"]


def _trend(complete: bool) -> str:
    return two_stage_sql(OBS, "station", _GROUP, "year", TREND_STAGE1,
                         {"avg_price_range": "avg_max_price - avg_min_price"}, TREND_STAGE2,
                         [("avg_price", "price_yoy_diff")], complete)


_NORMALS1 = [
    ("avg_price", "mean", "mean_price"), ("avg_max_price", "mean", "max_price"),
    ("avg_min_price", "mean", "min_price"), ("avg_price_spread", "mean", "max_price - min_price"),
    ("avg_total", "mean", "total_price"), ("total_stddev", "std", "total_price"),
    ("avg_orders", "mean", "order_cnt"),
]
REGION_MONTH_NORMALS = two_stage_sql(OBS, "station", _GROUP, "month", _NORMALS1, {},
                                     [(o, "mean", o) for o, _, _ in _NORMALS1])

REGION_YEAR_EXTREMES = two_stage_sql(
    OBS, "station", _GROUP, "year",
    [("year_max_price", "max", "max_price"), ("year_min_price", "min", "min_price"),
     ("max_monthly_total", "max", "total_price"), ("total_price", "sum", "total_price"),
     ("max_monthly_orders", "max", "order_cnt")],
    {"year_price_range": "year_max_price - year_min_price"},
    [("year_max_price", "max", "year_max_price"), ("year_min_price", "min", "year_min_price"),
     ("year_price_range", "max", "year_price_range"), ("max_monthly_total", "max", "max_monthly_total"),
     ("total_price", "mean", "total_price"), ("max_monthly_orders", "max", "max_monthly_orders")],
    [("max_monthly_total", "max_monthly_total_yoy_diff"), ("year_max_price", "max_price_yoy_diff")])

SEASON_CASE = """CASE month WHEN 1 THEN '겨울' WHEN 2 THEN '겨울' WHEN 3 THEN '봄' WHEN 4 THEN '봄'
  WHEN 5 THEN '봄' WHEN 6 THEN '여름' WHEN 7 THEN '여름' WHEN 8 THEN '여름' WHEN 9 THEN '가을'
  WHEN 10 THEN '가을' WHEN 11 THEN '겨울' WHEN 12 THEN '겨울' END"""
TARIFF_CASE = "CASE WHEN month IN (7, 8) THEN '하계' WHEN month BETWEEN 1 AND 12 THEN '기타' END"

NATION_MONTH_MOM_YOY = f"""
WITH {DISTRICT}
SELECT year, month, CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
       {SEASON_CASE} AS season, {TARIFF_CASE} AS season_tariff,
       sd_code, sd_name, sgg_name, house_cnt,
       power_usage AS avg_usage_kwh, bill AS avg_bill_won,
       house_cnt * power_usage AS total_usage_kwh, house_cnt * bill AS total_bill_won,
       bill / NULLIF(power_usage, 0.0) AS unit_price,
       (power_usage / NULLIF(LAG(power_usage, 12) OVER w, 0.0) - 1.0) * 100.0 AS usage_yoy_pct,
       (power_usage / NULLIF(LAG(power_usage, 1) OVER w, 0.0) - 1.0) * 100.0 AS usage_mom_pct
FROM dm
WINDOW w AS (PARTITION BY sd_code, sgg_name ORDER BY year, month)"""

NATION_MONTH_YOY_CALENDAR = f"""
WITH {DISTRICT}
SELECT a.year, a.month, a.sd_code, a.sgg_name, a.power_usage,
       (a.power_usage / NULLIF(b.power_usage, 0.0) - 1.0) * 100.0 AS usage_yoy_cal_pct
FROM dm a LEFT JOIN dm b
  ON a.sd_code = b.sd_code AND a.sgg_name = b.sgg_name AND a.year = b.year + 1 AND a.month = b.month"""

ACCTBAL_INTERPOLATE = """
WITH c AS (
  SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS v FROM customer
),
w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS i FROM c),
x AS (
  SELECT *,
    LAST_VALUE(v IGNORE NULLS) OVER b AS pv,
    LAST_VALUE(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER b AS pi,
    FIRST_VALUE(v IGNORE NULLS) OVER f AS nv,
    FIRST_VALUE(CASE WHEN v IS NOT NULL THEN i END IGNORE NULLS) OVER f AS ni
  FROM w
  WINDOW b AS (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY c_nationkey ORDER BY c_custkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
)
SELECT c_custkey, c_nationkey,
  CASE WHEN v IS NOT NULL THEN v WHEN pv IS NULL THEN NULL WHEN nv IS NULL THEN pv
       ELSE pv + (nv - pv) * CAST(i - pi AS DOUBLE) / CAST(ni - pi AS DOUBLE) END AS c_acctbal
FROM x"""

FLAGS = """
flags AS (
  SELECT l_linestatus || '/' || l_returnflag AS sgg_name,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         COUNT(*) AS house_cnt, CAST(MAX(l_extendedprice) AS DECIMAL(18,2)) AS power_usage,
         CAST(SUM(l_quantity) AS BIGINT) AS bill
  FROM lineitem GROUP BY ALL
),
merged AS (
  SELECT 'F' AS sgg_name, year, month, SUM(house_cnt) AS house_cnt,
    round_even(CAST(COALESCE(SUM(power_usage * house_cnt), 0) AS DOUBLE)
               / CAST(SUM(house_cnt) AS DOUBLE) * 100.0, 0) / 100.0 AS power_usage,
    CAST(round_even(CAST(COALESCE(SUM(bill * house_cnt), 0) AS DOUBLE)
               / CAST(SUM(house_cnt) AS DOUBLE), 0) AS BIGINT) AS bill
  FROM flags WHERE contains(sgg_name, 'F/') GROUP BY year, month
)"""

WEIGHTED_MERGE = f"""
WITH {FLAGS}
SELECT sgg_name, year, month, house_cnt, CAST(power_usage AS DOUBLE) AS power_usage, bill
FROM flags WHERE NOT contains(sgg_name, 'F/')
UNION ALL
SELECT sgg_name, year, month, CAST(house_cnt AS BIGINT), power_usage, bill FROM merged"""

SURROGATE_IDS = f"""
WITH {FLAGS}
SELECT CAST((SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY year, month) AS BIGINT) AS id,
       year, month, sgg_name
FROM merged"""

SAME_MONTH_OVERRIDE = f"""
WITH {DISTRICT},
src AS (
  SELECT sd_name, sgg_name, month, power_usage, bill FROM dm
  WHERE sd_name = 'ASIA' AND sgg_name = 'NATION_7' AND year = 1995 AND month IN (1, 2)
)
SELECT d.year, d.month, d.sd_code, d.sd_name, d.sgg_name, d.house_cnt,
       CASE WHEN s.month IS NOT NULL THEN s.power_usage ELSE d.power_usage END AS power_usage,
       CASE WHEN s.month IS NOT NULL THEN s.bill ELSE d.bill END AS bill
FROM dm d LEFT JOIN src s
  ON d.sd_name = s.sd_name AND d.sgg_name = s.sgg_name AND d.month = s.month AND d.year = 1996"""

POINT_UPDATE = """
SELECT p_partkey, p_name,
       CASE WHEN p_name = 'red widget' THEN 'CUSTOM RED' WHEN p_name = 'small ring' THEN 'CUSTOM RING'
            ELSE p_type END AS p_type
FROM part"""

STATION_PRUNE = """
WITH m AS (
  SELECT o_orderkey, o_custkey, o_orderpriority,
         CASE WHEN o_orderstatus <> 'O' THEN strftime(o_orderdate, '%Y-%m-%d') END AS closed
  FROM orders
),
c AS (SELECT *, COUNT(*) OVER (PARTITION BY o_custkey, o_orderpriority) AS n FROM m)
SELECT o_orderkey, o_custkey, o_orderpriority, closed FROM c
WHERE NOT (n = 1 AND COALESCE(closed <= '1997-12-31', false))"""

KEEP_LAST_PER_KEY = """
SELECT user_id, event_id, ts, event_type, value FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events
) WHERE rn = 1"""

FIRST_IN_GROUP = """
SELECT event_type, MIN(event_id) AS first_event_id, arg_min(user_id, event_id) AS first_user,
       arg_min(value, event_id) AS first_value, COUNT(*) AS n_events
FROM events GROUP BY event_type"""

ALIAS_VALUES = """(VALUES ('small', 1), ('large', 1), ('red', 2), ('blue', 2), ('hot', 3), ('cold', 3),
                   ('new', 4)) AS a(sd_name_alias, sd_code)"""

FIRST_TOKEN_LOOKUP = f"""
SELECT p.p_partkey, CAST(a.sd_code AS INTEGER) AS sd_code
FROM part p JOIN {ALIAS_VALUES}
  ON nullif(regexp_extract(p.p_name, '^\\s*(\\S+)', 1), '') = a.sd_name_alias"""

UNMATCHED_REPORT = f"""
SELECT p.p_partkey, p.p_name, nullif(regexp_extract(p.p_name, '^\\s*(\\S+)', 1), '') AS sd_raw
FROM part p LEFT JOIN {ALIAS_VALUES}
  ON nullif(regexp_extract(p.p_name, '^\\s*(\\S+)', 1), '') = a.sd_name_alias
WHERE a.sd_code IS NULL"""

NUM = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INT = r"^\s*[+-]?\d+\s*$"

LENIENT_CAST = f"""
WITH u AS (
  SELECT 'events' AS src, event_id AS key, regexp_extract(props, '"k":\\s*([^,}}]*)', 1) AS raw FROM events
  UNION ALL SELECT 'part', p_partkey, p_name FROM part
  UNION ALL SELECT 'customer', c_custkey, split_part(c_name, '#', 2) FROM customer
)
SELECT src, key, raw,
       CASE WHEN regexp_matches(raw, '{NUM}') THEN TRY_CAST(trim(raw) AS DOUBLE) END AS as_double,
       CASE WHEN regexp_matches(raw, '{INT}') THEN TRY_CAST(trim(raw) AS BIGINT) END AS as_long
FROM u"""

CALENDAR = f"""
WITH m AS (SELECT strftime(o_orderdate, '%Y-%m') AS ym, COUNT(*) AS n_orders FROM orders GROUP BY 1),
p AS (SELECT ym, CAST(substr(ym, 1, 4) AS INTEGER) AS year, CAST(substr(ym, 6, 2) AS INTEGER) AS month,
             n_orders FROM m)
"""

CALENDAR_DIMS = CALENDAR + f"""
SELECT ym, year, month, lpad(CAST(month AS VARCHAR), 2, '0') AS month_padded,
       CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter, {SEASON_CASE} AS season,
       {TARIFF_CASE} AS season_tariff, n_orders
FROM p"""

UNIT_PRICE = """
SELECT l_orderkey, l_linenumber,
       l_extendedprice / NULLIF(l_quantity, 0.0) AS unit_price,
       l_tax / NULLIF(l_discount, 0.0) AS tax_per_discount
FROM lineitem"""

ROUND_HALF_EVEN = f"""
SELECT l_orderkey, l_linenumber,
       {r2('l_extendedprice * (1.0 - l_discount)')} AS disc_price,
       {r2('l_extendedprice * (1.0 - l_discount) * (1.0 + l_tax)')} AS charge,
       {r2('l_quantity / 7.0')} AS qty_share
FROM lineitem"""

CLEAN_HEADERS = """
SELECT n_nationkey AS n_nationkey_id, n_name AS nation_name, n_regionkey AS region_key_C,
       n_nationkey + n_regionkey AS key_sum
FROM nation"""

MISSING_SLOTS = """
WITH b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS lo, date_trunc('month', MAX(o_orderdate)) AS hi
           FROM orders),
grid AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS sd_code, CAST(year(t.m) AS INTEGER) AS year,
         CAST(month(t.m) AS INTEGER) AS month
  FROM nation n, b, generate_series(b.lo, b.hi, INTERVAL 1 MONTH) AS t(m)
),
got AS (
  SELECT DISTINCT CAST(c.c_nationkey AS INTEGER) AS sd_code, CAST(year(o.o_orderdate) AS INTEGER) AS year,
         CAST(month(o.o_orderdate) AS INTEGER) AS month
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
SELECT g.year, g.month, g.sd_code FROM grid g
WHERE NOT EXISTS (SELECT 1 FROM got WHERE got.sd_code = g.sd_code AND got.year = g.year
                  AND got.month = g.month)"""

NEXT_PERIOD = """
WITH l AS (
  SELECT CAST(c.c_nationkey AS INTEGER) AS sd_code,
         MAX(CAST(date_trunc('month', o.o_orderdate) AS DATE)) AS last_period
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1
)
SELECT sd_code, CAST(year(last_period) AS INTEGER) AS last_year, CAST(month(last_period) AS INTEGER) AS last_month,
       CAST(year(last_period + INTERVAL 1 MONTH) AS INTEGER) AS next_year,
       CAST(month(last_period + INTERVAL 1 MONTH) AS INTEGER) AS next_month
FROM l"""

SLOT_ATOMICITY = """
SELECT user_id, CAST(ts AS DATE) AS day, COUNT(*) AS n_rows,
       CAST(SUM(CAST(event_type = 'error' AS INTEGER)) AS BIGINT) AS n_bad,
       CASE WHEN SUM(CAST(event_type = 'error' AS INTEGER)) > 0 THEN 'rejected' ELSE 'accepted' END AS status
FROM events GROUP BY user_id, CAST(ts AS DATE)"""

RETRY_QUEUE = """
SELECT user_id, COUNT(*) AS attempts,
       CASE WHEN COUNT(*) < 10 THEN 'retry' ELSE 'dead_letter' END AS status
FROM events WHERE event_type = 'error' GROUP BY user_id"""


TOP_PREVIEW = """
SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5"""

JSON_EXPLODE = f"""
WITH {DISTRICT}
SELECT sd_code, year, month, sd_name, sgg_name, house_cnt, power_usage, CAST(floor(bill) AS BIGINT) AS bill
FROM dm"""

BRONZE_INGEST = f"""
WITH {DISTRICT},
bad AS (SELECT DISTINCT year, month, sd_code FROM dm WHERE house_cnt < 3)
SELECT sd_code, year, month, sd_name, sgg_name, house_cnt, power_usage, CAST(floor(bill) AS BIGINT) AS bill
FROM dm WHERE NOT EXISTS (SELECT 1 FROM bad WHERE bad.year = dm.year AND bad.month = dm.month
                          AND bad.sd_code = dm.sd_code)"""

BRONZE_DEAD_LETTER = f"""
WITH {DISTRICT},
bad AS (SELECT DISTINCT year, month, sd_code FROM dm WHERE house_cnt < 3)
SELECT dm.sd_code, dm.year, dm.month, dm.sgg_name, dm.house_cnt,
       CASE WHEN dm.house_cnt < 3 THEN 'invalid value' ELSE 'slot rejected' END AS reason, a.attempt
FROM dm JOIN bad ON bad.year = dm.year AND bad.month = dm.month AND bad.sd_code = dm.sd_code
JOIN (VALUES (1, 1995), (2, NULL), (2, 1996)) AS a(attempt, only_year) ON a.only_year IS NULL OR dm.year = a.only_year
UNION ALL
SELECT CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT),
       'unreadable response', 2
FROM (SELECT DISTINCT year, month, sd_code FROM dm WHERE year = 1997)"""

BRONZE_RETRY_QUEUE = f"""
WITH {DISTRICT},
bad AS (SELECT DISTINCT year, month, sd_code FROM dm WHERE house_cnt < 3)
SELECT year, month, sd_code, CAST(CASE WHEN year = 1995 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CASE WHEN (CASE WHEN year = 1995 THEN 2 ELSE 1 END) < 10 THEN 'retry' ELSE 'dead_letter' END AS status
FROM bad"""

INCREMENTAL_INGEST = """
SELECT event_id, ts, user_id, event_type, value, CAST(ts AS DATE) AS day FROM events"""

WRITE_READ_ROUNDTRIP = f"""
WITH {DISTRICT}
SELECT year, month, sd_code, sd_name, sgg_name, house_cnt, power_usage,
       (SELECT COUNT(*) FROM dm) AS loaded_rows
FROM dm WHERE year >= 1996"""

RANGE_BUCKET_LAYOUT = """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, left(o_orderpriority, 2) AS priority_code FROM orders)
SELECT CASE WHEN year >= 1996 AND year < 2000 THEN year END AS year_range, priority_code,
       MIN(year) AS first_year, MAX(year) AS last_year, COUNT(*) AS n_orders
FROM o GROUP BY 1, 2"""

CSV_LEGACY_CHARSET = CALENDAR + f"""
SELECT ym, {SEASON_CASE} AS season, {TARIFF_CASE} AS season_tariff, n_orders FROM p"""

def _interp(v: str, keys: str, order: str) -> tuple[str, str]:
    """Window columns and the value expression of position-linear interpolation."""
    b = f"(PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    f = f"(PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    cols = (f"LAST_VALUE({v} IGNORE NULLS) OVER {b} AS {v}_pv, "
            f"LAST_VALUE(CASE WHEN {v} IS NOT NULL THEN i END IGNORE NULLS) OVER {b} AS {v}_pi, "
            f"FIRST_VALUE({v} IGNORE NULLS) OVER {f} AS {v}_nv, "
            f"FIRST_VALUE(CASE WHEN {v} IS NOT NULL THEN i END IGNORE NULLS) OVER {f} AS {v}_ni")
    expr = (f"CASE WHEN {v} IS NOT NULL THEN {v} WHEN {v}_pv IS NULL THEN NULL WHEN {v}_nv IS NULL THEN {v}_pv "
            f"ELSE {v}_pv + ({v}_nv - {v}_pv) * CAST(i - {v}_pi AS DOUBLE) / CAST({v}_ni - {v}_pi AS DOUBLE) END")
    return cols, expr


_PU_COLS, _PU_EXPR = _interp("pu", "sd_name, sgg_name", "year, month")
_BL_COLS, _BL_EXPR = _interp("bl", "sd_name, sgg_name", "year, month")

POWER_SILVER_CTE = f"""
WITH {OBS},
b AS (
  SELECT CAST(year * 12 + month AS BIGINT) * 1000000000 + station AS id, CAST(sd_code AS INTEGER) AS sd_code,
         year, month, sd_name_std AS sd_name, station_name AS sgg_name, order_cnt AS house_cnt,
         mean_price - 200000.0 AS power_usage, CAST(floor(min_price) AS BIGINT) AS bill
  FROM obs
),
src AS (
  SELECT sd_name, sgg_name, month, arg_min(power_usage, id) AS pu, arg_min(bill, id) AS bl
  FROM b WHERE year = 1995 AND sd_name = 'ASIA' AND sgg_name = 'NATION_7' AND month IN (1, 2)
  GROUP BY sd_name, sgg_name, month
),
o AS (
  SELECT b.id, b.sd_code, b.year, b.month, b.sd_name, b.sgg_name, b.house_cnt,
         CASE WHEN s.month IS NOT NULL THEN s.pu ELSE b.power_usage END AS power_usage,
         CASE WHEN s.month IS NOT NULL THEN s.bl ELSE b.bill END AS bill
  FROM b LEFT JOIN src s
    ON b.sd_name = s.sd_name AND b.sgg_name = s.sgg_name AND b.month = s.month AND b.year = 1996
),
mg AS (
  SELECT year, month, arg_min(sd_code, id) AS sd_code, arg_min(sd_name, id) AS sd_name,
         SUM(house_cnt) AS house_cnt,
         round_even(CAST(COALESCE(SUM(CAST(power_usage AS DECIMAL(38,6)) * house_cnt), 0) AS DOUBLE)
           / CAST(SUM(house_cnt) AS DOUBLE) * 100.0, 0) / 100.0 AS power_usage,
         CAST(round_even(CAST(COALESCE(SUM(bill * house_cnt), 0) AS DOUBLE) / CAST(SUM(house_cnt) AS DOUBLE), 0)
           AS BIGINT) AS bill
  FROM o WHERE contains(sgg_name, 'NATION_1') GROUP BY year, month
),
u AS (
  SELECT id, sd_code, year, month, sd_name, sgg_name, house_cnt, CAST(power_usage AS DOUBLE) AS power_usage,
         CAST(bill AS DOUBLE) AS bill
  FROM o WHERE NOT contains(sgg_name, 'NATION_1')
  UNION ALL
  SELECT CAST((SELECT MAX(id) FROM o) + ROW_NUMBER() OVER (ORDER BY year, month) AS BIGINT), sd_code, year, month,
         sd_name, 'NATION_1', CAST(house_cnt AS BIGINT), power_usage, CAST(bill AS DOUBLE)
  FROM mg
),
c AS (
  SELECT id, sd_code, year, month, sd_name, sgg_name, house_cnt,
         CASE WHEN power_usage >= 0 THEN power_usage END AS pu, CASE WHEN bill >= 0 THEN bill END AS bl
  FROM u
),
w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY sd_name, sgg_name ORDER BY year, month) AS i FROM c),
x AS (SELECT *, {_PU_COLS}, {_BL_COLS} FROM w),
silver AS (
  SELECT id, sd_code, year, month, sd_name, sgg_name, house_cnt, {_PU_EXPR} AS power_usage, {_BL_EXPR} AS bill
  FROM x
)"""

POWER_SILVER = POWER_SILVER_CTE + """
SELECT * FROM silver"""

POWER_GOLD = POWER_SILVER_CTE + f"""
SELECT year, month, CAST((month - 1) // 3 + 1 AS INTEGER) AS quarter,
       {SEASON_CASE} AS season, {TARIFF_CASE} AS season_tariff,
       sd_code, sd_name, sgg_name, house_cnt,
       power_usage AS avg_usage_kwh, bill AS avg_bill_won,
       house_cnt * power_usage AS total_usage_kwh, house_cnt * bill AS total_bill_won,
       bill / NULLIF(power_usage, 0.0) AS unit_price,
       (power_usage / NULLIF(LAG(power_usage, 12) OVER w, 0.0) - 1.0) * 100.0 AS usage_yoy_pct,
       (power_usage / NULLIF(LAG(power_usage, 1) OVER w, 0.0) - 1.0) * 100.0 AS usage_mom_pct
FROM silver
WINDOW w AS (PARTITION BY sd_code, sgg_name ORDER BY year, month)"""

# climate chain: the raw roles of regiostat.plans.tpch.CLIMATE_RAW_ROLES
# ('' -> missing, 'x' -> malformed -> missing)
_NULL = "CAST(NULL AS DOUBLE)"
CLIMATE_TREND = two_stage_sql(
    OBS, "station", _GROUP, "year",
    [("avg_temp", "mean", "mean_price"), ("avg_max_temp", "mean", "max_price"),
     ("avg_min_temp", "mean", "min_price"), ("year_max_temp", "max", "max_price"),
     ("year_min_temp", "min", "min_price"), ("total_precip_mm", "sum", "total_price"),
     ("avg_humidity_pct", "mean", "order_cnt"), ("avg_pressure_hpa", "mean", "order_cnt"),
     ("total_sunshine_hr", "sum", "order_cnt"), ("avg_ground_temp", "mean", "mean_price")],
    {"avg_temp_range": "avg_max_temp - avg_min_temp"},
    [("avg_temp", "mean", "avg_temp"), ("avg_max_temp", "mean", "avg_max_temp"),
     ("avg_min_temp", "mean", "avg_min_temp"), ("year_max_temp", "max", "year_max_temp"),
     ("year_min_temp", "min", "year_min_temp"), ("total_precip_mm", "mean", "total_precip_mm"),
     ("avg_humidity_pct", "mean", "avg_humidity_pct"), ("avg_pressure_hpa", "mean", "avg_pressure_hpa"),
     ("total_sunshine_hr", "mean", "total_sunshine_hr"), ("avg_ground_temp", "mean", "avg_ground_temp"),
     ("avg_temp_range", "mean", "avg_temp_range")],
    [("avg_temp", "temp_yoy_diff")], complete=True)

_COMPARE1 = [
    ("avg_temp", "mean", "mean_price"), ("avg_max_temp", "mean", "max_price"),
    ("avg_min_temp", "mean", "min_price"), ("avg_daily_range", "mean", "max_price - min_price"),
    ("avg_precip_mm", "mean", "total_price"), ("precip_stddev", "std", "total_price"),
    ("avg_humidity_pct", "mean", "order_cnt"), ("avg_wind_speed", "mean", "order_cnt"),
    ("avg_cloud_cover", "mean", _NULL), ("avg_sunshine_hr", "mean", "order_cnt"),
    ("avg_solar_mj", "mean", "mean_price"), ("avg_ground_temp", "mean", "mean_price"),
]
CLIMATE_COMPARE = two_stage_sql(OBS, "station", _GROUP, "month", _COMPARE1, {},
                                [(o, "mean", o) for o, _, _ in _COMPARE1])

CLIMATE_EXTREME = two_stage_sql(
    OBS, "station", _GROUP, "year",
    [("year_max_temp", "max", "max_price"), ("year_min_temp", "min", "min_price"),
     ("max_daily_precip", "max", "max_price"), ("max_monthly_precip", "max", "total_price"),
     ("total_precip_mm", "sum", "total_price"), ("max_wind_speed", "max", "order_cnt"),
     ("max_snowfall_cm", "max", _NULL)],
    {"year_temp_range": "year_max_temp - year_min_temp"},
    [("year_max_temp", "max", "year_max_temp"), ("year_min_temp", "min", "year_min_temp"),
     ("year_temp_range", "max", "year_temp_range"), ("max_daily_precip", "max", "max_daily_precip"),
     ("max_monthly_precip", "max", "max_monthly_precip"), ("total_precip_mm", "mean", "total_precip_mm"),
     ("max_wind_speed", "max", "max_wind_speed"), ("max_snowfall_cm", "max", "max_snowfall_cm")],
    [("max_daily_precip", "max_daily_precip_yoy_diff"), ("year_max_temp", "max_temp_yoy_diff")])

def _lerp(lst: str, n: str, q: float) -> str:
    """numpy 'linear' quantile of a sorted list (1-based list indexing)."""
    pos = f"(CAST({n} - 1 AS DOUBLE) * {q!r})"
    t = f"({pos} - floor({pos}))"
    a = f"{lst}[CAST(floor({pos}) AS BIGINT) + 1]"
    b = f"{lst}[CAST(ceil({pos}) AS BIGINT) + 1]"
    return f"CASE WHEN {t} >= 0.5 THEN {b} - ({b} - {a}) * (1.0 - {t}) ELSE {a} + ({b} - {a}) * {t} END"


def _profile_sql(src: str, cols: list) -> str:
    parts = []
    for c in cols:
        parts.append(f"""
SELECT '{c}' AS "column", n AS count, n_distinct, mean, std, min,
       {_lerp('l', 'n', 0.25)} AS p25, {_lerp('l', 'n', 0.5)} AS p50, {_lerp('l', 'n', 0.75)} AS p75, max
FROM (
  SELECT COUNT({c}) AS n, COUNT(DISTINCT {c}) AS n_distinct,
         CAST(SUM(CAST({c} AS DECIMAL(38,6))) AS DOUBLE) / COUNT({c}) AS mean,
         round_even(STDDEV_SAMP({c}) * 1000000.0, 0) / 1000000.0 AS std,
         MIN({c}) AS min, MAX({c}) AS max,
         list_sort(list({c}) FILTER (WHERE {c} IS NOT NULL)) AS l
  FROM {src}
)""")
    return "\nUNION ALL".join(parts)


PROFILE = _profile_sql("lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])

CLIMATE_TREND_PROFILE = _profile_sql(f"({CLIMATE_TREND}) AS fact", [
    "avg_temp", "avg_max_temp", "avg_min_temp", "year_max_temp", "year_min_temp",
    "total_precip_mm", "avg_temp_range", "temp_yoy_diff"])

CLIMATE_SILVER_SUMMARY = f"""
WITH {OBS}
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT sd_name_std) AS n_provinces, COUNT(DISTINCT station) AS n_stations
FROM obs WHERE sd_code IS NOT NULL"""

ORACLE = {
    "region_year_trend": _trend(False),
    "region_year_trend_complete": _trend(True),
    "region_month_normals": REGION_MONTH_NORMALS,
    "region_year_extremes": REGION_YEAR_EXTREMES,
    "nation_month_mom_yoy": NATION_MONTH_MOM_YOY,
    "nation_month_yoy_calendar": NATION_MONTH_YOY_CALENDAR,
    "acctbal_interpolate": ACCTBAL_INTERPOLATE,
    "weighted_merge": WEIGHTED_MERGE,
    "surrogate_ids": SURROGATE_IDS,
    "same_month_override": SAME_MONTH_OVERRIDE,
    "point_update": POINT_UPDATE,
    "station_prune": STATION_PRUNE,
    "keep_last_per_key": KEEP_LAST_PER_KEY,
    "first_in_group": FIRST_IN_GROUP,
    "first_token_lookup": FIRST_TOKEN_LOOKUP,
    "unmatched_report": UNMATCHED_REPORT,
    "lenient_cast": LENIENT_CAST,
    "calendar_dims": CALENDAR_DIMS,
    "unit_price": UNIT_PRICE,
    "round_half_even": ROUND_HALF_EVEN,
    "clean_headers": CLEAN_HEADERS,
    "missing_slots": MISSING_SLOTS,
    "next_period": NEXT_PERIOD,
    "slot_atomicity": SLOT_ATOMICITY,
    "retry_queue": RETRY_QUEUE,
    "profile": PROFILE,
    "top_preview": TOP_PREVIEW,
    "json_explode": JSON_EXPLODE,
    "incremental_ingest": INCREMENTAL_INGEST,
    "write_read_roundtrip": WRITE_READ_ROUNDTRIP,
    "range_bucket_layout": RANGE_BUCKET_LAYOUT,
    "csv_legacy_charset": CSV_LEGACY_CHARSET,
    "bronze_ingest": BRONZE_INGEST,
    "bronze_dead_letter": BRONZE_DEAD_LETTER,
    "bronze_stream": BRONZE_INGEST,
    "bronze_retry_queue": BRONZE_RETRY_QUEUE,
    "power_silver": POWER_SILVER,
    "power_gold": POWER_GOLD,
    "climate_trend_fact": CLIMATE_TREND,
    "climate_compare_fact": CLIMATE_COMPARE,
    "climate_extreme_fact": CLIMATE_EXTREME,
    "climate_trend_profile": CLIMATE_TREND_PROFILE,
    "climate_silver_summary": CLIMATE_SILVER_SUMMARY,
}

# ------------------------------------------------------- queries over stored state
RETRY_STREAM = """
SELECT user_id, COUNT(*) AS attempts, CASE WHEN COUNT(*) < 10 THEN 'retry' ELSE 'dead_letter' END AS status,
       MAX(ts) AS last_failed_at, CASE WHEN COUNT(*) < 10 THEN MAX(ts) + INTERVAL 1 HOUR END AS due_at
FROM events WHERE event_type = 'error' GROUP BY user_id"""

POWER_COLLECT = f"""
WITH {DISTRICT},
b AS (SELECT date_trunc('month', MIN(o_orderdate)) AS lo, date_trunc('month', MAX(o_orderdate)) AS hi FROM orders),
grid AS (
  SELECT CAST(r.r_regionkey AS INTEGER) AS sd_code, CAST(year(t.m) AS INTEGER) AS year,
         CAST(month(t.m) AS INTEGER) AS month
  FROM region r, b, generate_series(b.lo, b.hi, INTERVAL 1 MONTH) AS t(m)
),
slots AS (SELECT year, month, sd_code, MIN(house_cnt) < 3 AS bad FROM dm GROUP BY year, month, sd_code)
SELECT g.year, g.month, g.sd_code,
       CAST(CASE WHEN NOT COALESCE(s.bad, false) THEN 0 WHEN g.year = 1995 THEN 2 ELSE 1 END AS BIGINT) AS attempts,
       CASE WHEN s.year IS NULL THEN 'pending' WHEN s.bad AND g.year = 1995 THEN 'dead_letter' ELSE 'stored' END AS status
FROM grid g LEFT JOIN slots s ON s.year = g.year AND s.month = g.month AND s.sd_code = g.sd_code"""

MISSING_SLOTS_PRUNED = f"SELECT * FROM ({MISSING_SLOTS}) WHERE year IN (1996, 1997)"

STABLE_KEYS = f"""
WITH {DISTRICT}
SELECT CAST(ROW_NUMBER() OVER (ORDER BY year < 1997, year, month, sgg_name) AS BIGINT) AS id, year, month, sgg_name
FROM (SELECT DISTINCT year, month, sgg_name FROM dm)"""

PROFILE_SKETCHED = "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", COUNT({c}) AS count, MIN({c}) AS min, MAX({c}) AS max, true AS quantiles_near,
       true AS distinct_near FROM lineitem HAVING COUNT(*) > 0""" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))

CSV_QUARANTINE = f"""
WITH {OBS},
s AS (SELECT DISTINCT station FROM obs WHERE station % 2 = 0)
SELECT * FROM (
  SELECT 'row' AS kind, CASE WHEN month = 7 THEN 'quarantined' ELSE 'good' END AS name, COUNT(*) AS n FROM obs GROUP BY ALL
  UNION ALL SELECT 'missing', '평균기온(°C)', COUNT(*) FROM s
  UNION ALL SELECT 'extra', '비고', COUNT(*) FROM s
  UNION ALL SELECT 'unparsed', 'x', COUNT(*) FROM obs WHERE station % 2 = 1 AND month = 5
) WHERE n > 0"""

ZORDER_LAYOUT = """
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n_orders, true AS o_custkey_skips, true AS o_orderdate_skips
FROM orders GROUP BY 1"""

STREAM_METRICS = """
WITH e AS (SELECT CASE WHEN day(ts) <= 15 THEN 0 ELSE 1 END AS batch_id, event_type FROM events),
m AS (SELECT batch_id, COUNT(*) AS landed, COUNT(*) FILTER (event_type = 'error') AS rejected,
             COUNT(*) FILTER (event_type <> 'error') AS stored FROM e GROUP BY batch_id)
SELECT CAST(batch_id AS BIGINT) AS batch_id, metric, value FROM m UNPIVOT (value FOR metric IN (landed, rejected, stored))"""

# J-5 and J-6 from the metadata rows on (regiostat.plans.tpch.climate_meta_traps)
TRAP_META = """
meta AS (
  SELECT n_nationkey AS station, CASE WHEN k = 5 THEN '서청주(예)' ELSE n_name END AS name, m.address, m.closed
  FROM (SELECT n.*, r.r_name || ' ' || n.n_name AS here, r.r_name, n.n_nationkey % 8 AS k
        FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) x,
  LATERAL (SELECT unnest(CASE k
      WHEN 0 THEN [{'address': here || ' (산지)', 'closed': NULL::VARCHAR}]
      WHEN 1 THEN [{'address': here, 'closed': '1999-12-31'}]
      WHEN 2 THEN [{'address': here, 'closed': '2001-05-31'}]
      WHEN 3 THEN [{'address': here, 'closed': NULL::VARCHAR}]
      WHEN 4 THEN [{'address': here, 'closed': '2015-03-01'}, {'address': 'ASIA ' || n_name, 'closed': '2015-03-01'}]
      WHEN 5 THEN [{'address': NULL::VARCHAR, 'closed': NULL::VARCHAR}]
      WHEN 6 THEN [{'address': 'UNKNOWN ' || n_name, 'closed': NULL::VARCHAR}]
      ELSE [{'address': 'OLD ' || r_name, 'closed': '1994-12-31'}, {'address': '  ' || here, 'closed': NULL::VARCHAR}] END) AS m)
),
fixed AS (SELECT station, name, CASE WHEN name = '서청주(예)' THEN '충청북도 청주시' ELSE address END AS address, closed FROM meta),
counted AS (SELECT *, COUNT(*) OVER (PARTITION BY station) AS n FROM fixed),
open_ones AS (
  SELECT * FROM counted WHERE NOT (n = 1 AND COALESCE(closed <= '2000-12-31', false))
     AND NOT COALESCE(contains(address, '(산지)'), false)
),
latest AS (
  SELECT *, regexp_extract(address, '^\\s*(\\S+)', 1) AS sd_raw FROM open_ones
  QUALIFY ROW_NUMBER() OVER (PARTITION BY station ORDER BY COALESCE(closed, '9999-12-31') DESC, address DESC) = 1
),
alias AS (
  SELECT DISTINCT a, r_regionkey FROM region, LATERAL (SELECT unnest([r_name, lower(r_name), split_part(r_name, ' ', 1)]) AS a)
  UNION ALL SELECT '충청북도', MIN(r_regionkey) FROM region
),
mapped AS (SELECT l.station, l.name, l.sd_raw, CAST(a.r_regionkey AS INTEGER) AS sd_code FROM latest l LEFT JOIN alias a ON l.sd_raw = a.a)"""

CLIMATE_TRAPS_STATIONS = f"""
WITH {TRAP_META}
SELECT CAST(station AS BIGINT) AS station, sd_code FROM mapped WHERE sd_code IS NOT NULL"""

CLIMATE_TRAPS_UNMATCHED = f"""
WITH {TRAP_META}
SELECT CAST(station AS BIGINT) AS station, name, sd_raw FROM mapped WHERE sd_code IS NULL"""

# the same fact over observations whose province comes from the metadata
CLIMATE_TRAPS_TREND = CLIMATE_TREND.replace(OBS, OBS.replace("obs AS (", "every_obs AS (", 1) + "," + TRAP_META + """,
obs AS (
  SELECT o.* REPLACE (m.sd_code AS sd_code, r.r_name AS sd_name_std)
  FROM every_obs o JOIN mapped m ON m.station = o.station AND m.sd_code IS NOT NULL
  LEFT JOIN region r ON r.r_regionkey = m.sd_code
)""", 1)

ORACLE.update({
    "climate_traps_trend": CLIMATE_TRAPS_TREND,
    "climate_traps_stations": CLIMATE_TRAPS_STATIONS,
    "climate_traps_unmatched": CLIMATE_TRAPS_UNMATCHED,
    "interpolate_incremental": ACCTBAL_INTERPOLATE,
    "profile_sketched": PROFILE_SKETCHED,
    "csv_quarantine": CSV_QUARANTINE,
    "zorder_layout": ZORDER_LAYOUT,
    "stream_metrics": STREAM_METRICS,
    "retry_stream": RETRY_STREAM,
    "power_collect": POWER_COLLECT,
    "power_collect_bronze": BRONZE_INGEST,
    "power_collect_stream": BRONZE_INGEST,
    "incremental_trend": _trend(True),
    "missing_slots_pruned": MISSING_SLOTS_PRUNED,
    "stable_keys": STABLE_KEYS,
})
