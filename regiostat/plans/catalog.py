"""Registered queries: each takes (spark, table folder) and returns a DataFrame.

Every query reads the test tables (see :mod:`regiostat.plans.tpch` for the
roles they play) and exercises one or more operators of the inventory; the
DuckDB twin of each lives in :mod:`regiostat.plans.oracle`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.names import clean_headers
from regiostat.functions.scalars import (
    code_prefix, lenient_double, lenient_int, quarter_of, season_of, tariff_of,
    year_month_parts, zero_pad, inf_to_null,
)
from regiostat.operators.aggregates import first_by, profile as profile_op
from regiostat.operators.corrections import (
    point_update, replace_matching, same_period_override, weighted_merge,
)
from regiostat.operators.filters import null_out_invalid, prune_single_closed
from regiostat.operators.joins import Bounded
from regiostat.operators.ingest import next_period as next_period_op
from regiostat.operators.ingest import (
    convert_payload, pending_slots, retry_queue as retry_queue_op, slot_grid, slot_status,
)
from regiostat.operators.projections import (
    derive, drop, head, rename, round_float_columns, select_columns,
)
from regiostat.operators.timeseries import (
    interpolate_linear, keep_last, pct_change_calendar, surrogate_ids,
)
from regiostat.plans.climate import ClimateCols, station_map, two_stage
from regiostat.plans.power import power_fact
from regiostat.plans.tpch import district_month, orders_by_nation, station_month_obs
from regiostat.session import configure, materialize, scratch_path
from regiostat.sources.landing import read_landing, read_legacy_csv, write_legacy_csv
from regiostat.sources.sinks import range_bucket, write_table
from regiostat.sources.tables import read_table

GROUP = ["sd_code", "sd_name_std"]

# --------------------------------------------------------------- climate facts
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


def _trend(spark, d, complete):
    configure(spark)
    obs = station_month_obs(spark, d)
    return two_stage(obs, "station", GROUP, "year", TREND_STAGE1,
                     {"avg_price_range": F.col("avg_max_price") - F.col("avg_min_price")},
                     TREND_STAGE2, diffs=[("avg_price", "price_yoy_diff")], complete_only=complete)


def region_year_trend(spark: SparkSession, d: str) -> DataFrame:
    """J-7 with every year (O-34b/c, O-40a, O-40d, O-45, O-58)."""
    return _trend(spark, d, False)


def region_year_trend_complete(spark: SparkSession, d: str) -> DataFrame:
    """J-7 on station-years with all 12 months (O-31, O-35, O-40e)."""
    return _trend(spark, d, True)


def region_month_normals(spark: SparkSession, d: str) -> DataFrame:
    """J-8: station x calendar month over all years, then province means (O-40b, O-40d, S24)."""
    configure(spark)
    obs = station_month_obs(spark, d).withColumn("_spread", F.col("max_price") - F.col("min_price"))
    stage1 = [
        ("avg_price", "mean", "mean_price"), ("avg_max_price", "mean", "max_price"),
        ("avg_min_price", "mean", "min_price"), ("avg_price_spread", "mean", "_spread"),
        ("avg_total", "mean", "total_price"), ("total_stddev", "std", "total_price"),
        ("avg_orders", "mean", "order_cnt"),
    ]
    stage2 = [(o, "mean", o) for o, _, _ in stage1]
    return two_stage(obs, "station", GROUP, "month", stage1, None, stage2)


def region_year_extremes(spark: SparkSession, d: str) -> DataFrame:
    """J-9: station-year extremes, province max/min/mean, YoY diffs (O-40c, O-24, O-45, S23)."""
    configure(spark)
    obs = station_month_obs(spark, d)
    stage1 = [
        ("year_max_price", "max", "max_price"), ("year_min_price", "min", "min_price"),
        ("max_monthly_total", "max", "total_price"), ("total_price", "sum", "total_price"),
        ("max_monthly_orders", "max", "order_cnt"),
    ]
    stage2 = [
        ("year_max_price", "max", "year_max_price"), ("year_min_price", "min", "year_min_price"),
        ("year_price_range", "max", "year_price_range"), ("max_monthly_total", "max", "max_monthly_total"),
        ("total_price", "mean", "total_price"), ("max_monthly_orders", "max", "max_monthly_orders"),
    ]
    return two_stage(obs, "station", GROUP, "year", stage1,
                     {"year_price_range": F.col("year_max_price") - F.col("year_min_price")}, stage2,
                     diffs=[("max_monthly_total", "max_monthly_total_yoy_diff"),
                            ("year_max_price", "max_price_yoy_diff")])


# ----------------------------------------------------------------- power fact
def nation_month_mom_yoy(spark: SparkSession, d: str) -> DataFrame:
    """J-3 on nation-months: calendar dims, totals, unit price, MoM, 12-row YoY
    (O-21, O-24, O-44a/b, O-49, O-59..O-62)."""
    configure(spark)
    return power_fact(district_month(spark, d))


def nation_month_yoy_calendar(spark: SparkSession, d: str) -> DataFrame:
    """Calendar-safe YoY through a self join on (year-1, month) (O-44b variant, O-38)."""
    configure(spark)
    dm = district_month(spark, d).select("year", "month", "sd_code", "sgg_name", "power_usage")
    return pct_change_calendar(dm, ["sd_code", "sgg_name"], "power_usage", "usage_yoy_cal_pct")


# --------------------------------------------------------------- power silver
ACCTBAL_BLOCK = 256  # customers per interpolation block (bounds one window task)


def acctbal_interpolate(spark: SparkSession, d: str) -> DataFrame:
    """Negative balances -> NULL, then position-linear interpolation per nation
    ordered by customer key, on blocks of customer keys (O-29, O-46)."""
    configure(spark)
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    c = null_out_invalid(c, ["c_acctbal"])
    return interpolate_linear(c, ["c_nationkey"], ["c_custkey"], ["c_acctbal"],
                              block=F.floor(F.col("c_custkey") / F.lit(ACCTBAL_BLOCK)))


def _flag_months(spark, d):
    li = read_table(spark, d, "lineitem", ["l_linestatus", "l_returnflag", "l_shipdate",
                                           "l_extendedprice", "l_quantity"])
    return (li.groupBy(F.concat_ws("/", "l_linestatus", "l_returnflag").alias("sgg_name"),
                       F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"))
              .agg(F.count(F.lit(1)).alias("house_cnt"),
                   F.max("l_extendedprice").cast("decimal(18,2)").alias("power_usage"),
                   F.sum("l_quantity").cast("long").alias("bill")))


MERGE_NEEDLE, MERGE_NAME = "F/", "F"


def _merged_flags(flags):
    return weighted_merge(flags, "sgg_name", MERGE_NEEDLE, MERGE_NAME,
                          group=["year", "month"], weight="house_cnt", means=["power_usage", "bill"],
                          round_scales={"power_usage": 2, "bill": 0}, int_cols=["bill"])


def weighted_merge_q(spark: SparkSession, d: str) -> DataFrame:
    """City merge on flag-months: linestatus F's return flags merged into 'F',
    mean weighted by row count; other rows kept (O-42, O-40g, O-27, O-51..O-53)."""
    configure(spark)
    flags = materialize(_flag_months(spark, d))  # read twice: merged part and kept rows
    merged = _merged_flags(flags)
    out = replace_matching(flags, "sgg_name", MERGE_NEEDLE, merged)
    return out.select("sgg_name", "year", "month", "house_cnt",
                      F.col("power_usage").cast("double").alias("power_usage"), "bill")


def surrogate_ids_q(spark: SparkSession, d: str) -> DataFrame:
    """Merged rows numbered after the largest order key, in (year, month) order (O-47, O-40i)."""
    configure(spark)
    max_id = read_table(spark, d, "orders", ["o_orderkey"]).agg(F.max("o_orderkey")).first()[0] or 0
    merged = _merged_flags(_flag_months(spark, d)).select("year", "month", "sgg_name")
    return surrogate_ids(merged, int(max_id), ["year", "month"]).select("id", "year", "month", "sgg_name")


OVERRIDE_RULES = [("ASIA", "NATION_7", 1, 1995, 1996), ("ASIA", "NATION_7", 2, 1995, 1996)]


def same_month_override(spark: SparkSession, d: str) -> DataFrame:
    """January/February 1996 of one nation replaced by 1995's values (O-33, O-26, O-38)."""
    configure(spark)
    dm = materialize(district_month(spark, d))  # read twice: source lookup and targets
    rules = Bounded.literal(spark, OVERRIDE_RULES,
                            "sd_name string, sgg_name string, month int, src_year int, dst_year int")
    return same_period_override(dm, rules, ["sd_name", "sgg_name"], ["power_usage", "bill"], strict=False)


# ---------------------------------------------------------- climate meta steps
POINT_RULES = [("red widget", "CUSTOM RED"), ("small ring", "CUSTOM RING")]


def point_update_q(spark: SparkSession, d: str) -> DataFrame:
    """Constant set by a rule table on a name match (O-32)."""
    configure(spark)
    p = read_table(spark, d, "part", ["p_partkey", "p_name", "p_type"])
    return point_update(p, Bounded.literal(spark, POINT_RULES, "match string, value string"), "p_name", "p_type")


def station_prune(spark: SparkSession, d: str) -> DataFrame:
    """Single-record groups closed on or before a cutoff removed; open (NULL) kept
    (O-43, O-30, O-63, S7)."""
    configure(spark)
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                                        "o_orderdate"])
    o = o.select("o_orderkey", "o_custkey", "o_orderpriority",
                 F.when(F.col("o_orderstatus") != "O", F.date_format("o_orderdate", "yyyy-MM-dd"))
                 .alias("closed"))
    return prune_single_closed(o, ["o_custkey", "o_orderpriority"], "closed", "1997-12-31")


def keep_last_per_key(spark: SparkSession, d: str) -> DataFrame:
    """Last event per user by (ts, event_id) (O-48)."""
    configure(spark)
    e = read_table(spark, d, "events", ["user_id", "event_id", "ts", "event_type", "value"])
    return keep_last(e, "user_id", ["ts", "event_id"])


def first_in_group(spark: SparkSession, d: str) -> DataFrame:
    """First row per event type by event id (O-40h)."""
    configure(spark)
    e = read_table(spark, d, "events", ["event_type", "event_id", "user_id", "value"])
    return e.groupBy("event_type").agg(F.min("event_id").alias("first_event_id"),
                                       first_by("user_id", "event_id").alias("first_user"),
                                       first_by("value", "event_id").alias("first_value"),
                                       F.count(F.lit(1)).alias("n_events"))


# Alias list (first name word -> code); 'old' is deliberately unmapped.
ALIASES = [("small", 1), ("large", 1), ("red", 2), ("blue", 2), ("hot", 3), ("cold", 3), ("new", 4)]


def _part_station_map(spark, d):
    p = read_table(spark, d, "part", ["p_partkey", "p_name"]).withColumn("closed", F.lit(None).cast("string"))
    alias = Bounded.literal(spark, ALIASES, "sd_name_alias string, sd_code int")
    cols = ClimateCols(station="p_partkey", station_name="p_name", address="p_name", closed="closed")
    return station_map(p, alias, cols)


def first_token_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Meta path of J-6 on part names: keep last per key, first token, alias
    join, drop unmapped (O-48, O-57, O-34a, O-28)."""
    configure(spark)
    return _part_station_map(spark, d)[0]


def unmatched_report(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose first token has no alias (O-39)."""
    configure(spark)
    return _part_station_map(spark, d)[1]


# ------------------------------------------------------------------- scalars
def lenient_cast(spark: SparkSession, d: str) -> DataFrame:
    """``to_numeric(errors='coerce')`` on JSON fragments, names and id suffixes (O-54, O-12)."""
    configure(spark)
    e = read_table(spark, d, "events", ["event_id", "props"]).select(
        F.lit("events").alias("src"), F.col("event_id").alias("key"),
        F.regexp_extract("props", r'"k":\s*([^,}]*)', 1).alias("raw"))
    p = read_table(spark, d, "part", ["p_partkey", "p_name"]).select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("key"), F.col("p_name").alias("raw"))
    c = read_table(spark, d, "customer", ["c_custkey", "c_name"]).select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("key"),
        F.substring_index("c_name", "#", -1).alias("raw"))
    u = e.unionByName(p).unionByName(c)
    return u.withColumns({"as_double": lenient_double("raw"), "as_long": lenient_int("raw")})


def calendar_dims(spark: SparkSession, d: str) -> DataFrame:
    """Month string -> year, month, padded month, quarter, season, tariff (O-56, O-60..O-62, O-16)."""
    configure(spark)
    o = read_table(spark, d, "orders", ["o_orderdate"])
    m = o.groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("ym")).agg(F.count(F.lit(1)).alias("n_orders"))
    y, mo = year_month_parts("ym")
    m = m.withColumns({"year": y, "month": mo})
    return m.select("ym", "year", "month", zero_pad("month").alias("month_padded"),
                    quarter_of("month").alias("quarter"), season_of("month").alias("season"),
                    tariff_of("month").alias("season_tariff"), "n_orders")


def unit_price(spark: SparkSession, d: str) -> DataFrame:
    """Ratios with zero divisors -> NULL instead of inf (O-24, O-59, S1)."""
    configure(spark)
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                           "l_tax", "l_discount"])
    return li.select("l_orderkey", "l_linenumber",
                     inf_to_null(F.try_divide("l_extendedprice", "l_quantity")).alias("unit_price"),
                     inf_to_null(F.try_divide("l_tax", "l_discount")).alias("tax_per_discount"))


def round_half_even_q(spark: SparkSession, d: str) -> DataFrame:
    """Every float column of a derived projection rounded half-to-even (O-58, O-25, S4)."""
    configure(spark)
    li = read_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity",
                                           "l_tax", "l_discount"])
    disc = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    out = li.select("l_orderkey", "l_linenumber", disc.alias("disc_price"),
                    (disc * (F.lit(1.0) + F.col("l_tax"))).alias("charge"),
                    (F.col("l_quantity") / F.lit(7.0)).alias("qty_share"))
    return round_float_columns(out, 2)


NOISY_HEADERS = {"n_nationkey": "n nationkey(id)", "n_name": "n.name (text)",
                 "n_regionkey": "  region key/°C "}


def clean_headers_q(spark: SparkSession, d: str) -> DataFrame:
    """Header cleaning, subset, rename, drop, derive (O-20..O-24, O-64)."""
    configure(spark)
    n = read_table(spark, d, "nation", list(NOISY_HEADERS))
    noisy = n.toDF(*[NOISY_HEADERS[c] for c in n.columns]).withColumn("unused (x)", F.lit(1))
    clean = clean_headers(noisy)
    clean = select_columns(clean, ["n_nationkey_id", "n_name_text", "region_key_C", "unused_x"])
    clean = drop(clean, ["unused_x"])
    clean = derive(clean, {"key_sum": F.col("n_nationkey_id") + F.col("region_key_C")})
    return rename(clean, {"n_name_text": "nation_name", "absent": "ignored"})


# -------------------------------------------------------------------- ingest
def _order_bounds(spark, d):
    o = read_table(spark, d, "orders", ["o_orderdate"])
    r = o.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("lo"),
              F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("hi")).first()
    return r["lo"], r["hi"]


def missing_slots(spark: SparkSession, d: str) -> DataFrame:
    """Nation x month work list minus the slots holding orders (O-11, O-36, O-37, O-05)."""
    configure(spark)
    lo, hi = _order_bounds(spark, d)
    nations = read_table(spark, d, "nation", ["n_nationkey"])
    if lo is None:  # no orders: the data-derived bounds are empty, so is the work list
        nations = nations.limit(0)
        lo = hi = "2000-01"
    grid = slot_grid(nations, "n_nationkey", lo, hi, prefix_len=None)
    got = orders_by_nation(spark, d).select(F.col("nation").cast("int").alias("sd_code"), "year", "month")
    return pending_slots(grid, got)


def next_period(spark: SparkSession, d: str) -> DataFrame:
    """Latest month with orders per nation and the next month to collect (O-17)."""
    configure(spark)
    got = orders_by_nation(spark, d).select(F.col("nation").cast("int").alias("sd_code"), "year", "month")
    return next_period_op(got, ["sd_code"])


def slot_atomicity(spark: SparkSession, d: str) -> DataFrame:
    """Per (user, day) slot: an error event rejects the whole slot (O-13, O-14)."""
    configure(spark)
    e = read_table(spark, d, "events", ["user_id", "ts", "event_type"])
    e = e.select("user_id", F.to_date("ts").alias("day"), (F.col("event_type") == "error").alias("_bad"))
    return slot_status(e, ["user_id", "day"])


def retry_queue(spark: SparkSession, d: str) -> DataFrame:
    """Error events as failed attempts per user: retry below 10, else dead letter (O-18)."""
    configure(spark)
    e = read_table(spark, d, "events", ["user_id", "event_type"]).where(F.col("event_type") == "error")
    return retry_queue_op(e, ["user_id"])


def profile(spark: SparkSession, d: str) -> DataFrame:
    """``describe()`` of the numeric lineitem columns with exact quartiles (O-41, O-40f, O-40j)."""
    configure(spark)
    li = read_table(spark, d, "lineitem", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
    # scales only so that the comparison with SQL does not depend on the order of summation
    return profile_op(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], std_scale=6, mean_scale=6)


def top_preview(spark: SparkSession, d: str) -> DataFrame:
    """First five orders by key: ``head()`` on an explicit order (O-50)."""
    configure(spark)
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    return head(o, ["o_orderkey"], 5)


def _landing_payload(spark, d):
    """Responses the API would give, without planted faults."""
    return _payload(spark, d, faults=False)


# A reading from fewer orders than this is reported as 'n/a' by the landed API
# payload, which makes the value invalid and rejects its whole slot.
MIN_READINGS = 3


def _land_bronze_run(spark, d):
    """J-1 twice over landed responses: 1995 first, then everything (1995
    landed again).  Returns (bronze path, dead-letter path)."""
    from regiostat.plans.power import bronze_ingest
    root = scratch_path(spark, "bronze")
    landing, bronze, dead = f"{root}/landing", f"{root}/bronze", f"{root}/dead_letter"
    payload = materialize(_payload(spark, d))  # two landings from one derivation
    payload.where(F.col("year") == "1995").write.mode("overwrite").json(f"{landing}/drop1")
    _land_second_drop(payload, f"{landing}/drop2")
    for attempt, drop in enumerate(("drop1", "drop2"), start=1):
        existing = spark.read.parquet(bronze) if attempt > 1 else None
        good, rejected = bronze_ingest(spark, read_landing(spark, f"{landing}/{drop}"), existing)
        write_table(good, bronze, mode="append")
        # rejected slots never reach bronze, so a later run tries them again:
        # the failure log keeps one row per row and attempt (input of O-18)
        write_table(rejected.withColumn("attempt", F.lit(attempt)), dead, mode="append")
    return bronze, dead


def _payload(spark, d, faults=True):
    """One JSON object per (year, month, region) with one element per nation
    (bounded by nations per region).  A reading from few orders is invalid: in
    odd months its value, in even months its year."""
    dm = district_month(spark, d)
    few = F.lit(faults) & (F.col("house_cnt") < MIN_READINGS)
    even = F.col("month") % 2 == 0
    el = F.struct(F.when(few & even, F.lit("bad")).otherwise(F.col("year").cast("string")).alias("year"),
                  zero_pad("month").alias("month"), F.col("sd_name").alias("metro"), F.col("sgg_name").alias("city"),
                  F.col("house_cnt").cast("string").alias("houseCnt"),
                  F.when(few & ~even, F.lit("n/a")).otherwise(F.col("power_usage").cast("string")).alias("powerUsage"),
                  F.floor("bill").cast("string").alias("bill"))
    return (dm.groupBy("year", "month", "sd_code").agg(F.collect_list(el).alias("data"))
              .select(F.col("year").cast("string").alias("year"), zero_pad("month").alias("month"),
                      F.col("sd_code").cast("string").alias("metroCd"), "data"))


def _land_second_drop(payload, folder):
    """Everything, 1996's responses once more, and 1997's once more cut off in the middle."""
    payload.write.json(folder)
    payload.where(F.col("year") == "1996").write.mode("append").json(folder)
    cut = F.substring(F.to_json(F.struct("*")), 1, 30).alias("value")
    payload.where(F.col("year") == "1997").select(cut).write.mode("append").text(folder)


def bronze_stream(spark: SparkSession, d: str) -> DataFrame:
    """J-1 as an availableNow stream: 1995's responses land first, then all of
    them (1995 again); two runs on one checkpoint give the batch J-1 result (O-19)."""
    from regiostat.streaming.incremental import ingest_landing_stream
    configure(spark)
    root = scratch_path(spark, "bronze-stream")
    landing = f"{root}/landing"
    payload = materialize(_payload(spark, d))
    kw = dict(bronze_path=f"{root}/bronze", dead_letter_path=f"{root}/dead_letter",
              checkpoint=f"{root}/checkpoint")
    payload.where(F.col("year") == "1995").write.json(f"{landing}/drop1")
    ingest_landing_stream(spark, f"{landing}/*", **kw)
    _land_second_drop(payload, f"{landing}/drop2")
    ingest_landing_stream(spark, f"{landing}/*", **kw)
    return spark.read.parquet(kw["bronze_path"]).select("sd_code", "year", "month", "sd_name", "sgg_name",
                                                        "house_cnt", "power_usage", "bill")


def bronze_ingest_q(spark: SparkSession, d: str) -> DataFrame:
    """J-1: landed JSON -> typed rows -> skip collected slots -> all-or-nothing
    slot validation -> append (O-01, O-05, O-06, O-12..O-15, O-36)."""
    configure(spark)
    bronze, _ = _land_bronze_run(spark, d)
    return spark.read.parquet(bronze).select("sd_code", "year", "month", "sd_name", "sgg_name",
                                             "house_cnt", "power_usage", "bill")


def bronze_dead_letter(spark: SparkSession, d: str) -> DataFrame:
    """J-1 failure log: every row of a slot holding an invalid reading, with
    the reason and the attempt; 1995's bad slots are tried twice (O-13, O-14)."""
    configure(spark)
    _, dead = _land_bronze_run(spark, d)
    return spark.read.parquet(dead).select("sd_code", "year", "month", "sgg_name", "house_cnt", "reason",
                                           "attempt")


def bronze_retry_queue(spark: SparkSession, d: str) -> DataFrame:
    """O-18 over the J-1 failure log: attempts per rejected slot, retry below
    the limit, dead letter from it."""
    configure(spark)
    _, dead = _land_bronze_run(spark, d)
    # an unreadable response names no slot; its slot stays pending in the work list
    attempts = spark.read.parquet(dead).where("reason <> 'unreadable response'")
    attempts = attempts.select("year", "month", "sd_code", "attempt").distinct()
    return retry_queue_op(attempts, ["year", "month", "sd_code"])


def json_explode(spark: SparkSession, d: str) -> DataFrame:
    """Landed JSON responses read with a schema, exploded and typed (O-01, O-15, O-12)."""
    configure(spark)
    path = scratch_path(spark, "landing-json")
    _landing_payload(spark, d).write.mode("overwrite").json(path)
    typed = convert_payload(read_landing(spark, path))
    return typed.select("sd_code", "year", "month", "sd_name", "sgg_name", "house_cnt", "power_usage", "bill")


def incremental_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events landed in two drops (the second repeats part of the first) and
    ingested with an availableNow stream; the result holds each event once (O-19, O-06)."""
    from regiostat.streaming.incremental import ingest_available
    configure(spark)
    root = scratch_path(spark, "incremental")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/checkpoint"
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"]) \
        .withColumn("day", F.to_date("ts"))
    first = e.where(F.dayofmonth("day") <= 15)
    second = e.where(F.dayofmonth("day") > 15)
    schema = e.schema
    first.write.mode("append").parquet(f"{landing}/drop1")
    kw = dict(source_format="parquet", schema=schema, bronze_path=bronze, checkpoint=ckpt,
              slot_keys=["user_id", "day"])
    ingest_available(spark, f"{landing}/*", **kw)
    second.write.mode("append").parquet(f"{landing}/drop2")
    first.where(F.dayofmonth("day") <= 3).write.mode("append").parquet(f"{landing}/drop3")
    ingest_available(spark, f"{landing}/*", **kw)
    return spark.read.parquet(bronze)


def write_read_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Truncate-and-load partitioned by year, clustered by names; read back with
    a partition filter and a column subset (O-02, O-03, O-07..O-10, O-69)."""
    configure(spark)
    path = scratch_path(spark, "fact")
    fact = district_month(spark, d)
    n = write_table(fact, path, partition_by=["year"], cluster_by=["sd_name", "sgg_name"])
    # explicit schema: no inference, and an empty load reads back as an empty table
    back = spark.read.schema(fact.schema).parquet(path).where(F.col("year") >= 1996)
    return back.select("year", "month", "sd_code", "sd_name", "sgg_name", "house_cnt", "power_usage") \
        .withColumn("loaded_rows", F.lit(n).cast("long"))


def range_bucket_layout(spark: SparkSession, d: str) -> DataFrame:
    """Orders stored by year, years outside [1996, 2000) in the default
    partition; read back and counted by partition and code prefix (O-09, O-16)."""
    configure(spark)
    o = read_table(spark, d, "orders", ["o_orderpriority", "o_orderdate"])
    rows = o.select(F.year("o_orderdate").alias("year"), code_prefix("o_orderpriority").alias("priority_code"))
    name, bucket = range_bucket("year", 1996, 2000)
    rows = rows.withColumn(name, bucket)
    path = scratch_path(spark, "range")
    write_table(rows, path, partition_by=[name])
    back = spark.read.schema(rows.schema).parquet(path)
    return back.groupBy(name, "priority_code").agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("n_orders"))


def csv_legacy_charset(spark: SparkSession, d: str) -> DataFrame:
    """Korean labels written and read back as CP949 CSV (O-04)."""
    configure(spark)
    cal = calendar_dims(spark, d).select("ym", "season", "season_tariff", "n_orders")
    path = scratch_path(spark, "csv-cp949")
    write_legacy_csv(cal, path)
    return read_legacy_csv(spark, path, "ym string, season string, season_tariff string, n_orders long")


# J-2 on nation-months: one nation's early months overridden, the NATION_1*
# "districts" merged into one, negatives nulled, gaps interpolated.
SILVER_OVERRIDES = [("ASIA", "NATION_7", 1, 1995, 1996), ("ASIA", "NATION_7", 2, 1995, 1996)]
SILVER_MERGE = "NATION_1"


def _power_silver(spark, d):
    from regiostat.plans.power import SilverParams, power_silver
    from regiostat.plans.tpch import district_bronze
    params = SilverParams(override_rules=SILVER_OVERRIDES, merge_city=SILVER_MERGE, strict_override=False)
    # bronze is a stored table in the real flow; the derived one is checkpointed
    # because the silver plan reads it several times
    return power_silver(materialize(district_bronze(spark, d)), params)


def power_silver_q(spark: SparkSession, d: str) -> DataFrame:
    """J-2 end to end (O-33, O-42, O-47, O-54, O-29, O-46)."""
    configure(spark)
    return _power_silver(spark, d)


def power_gold(spark: SparkSession, d: str) -> DataFrame:
    """J-3 on the J-2 output (O-21, O-22, O-24, O-44a/b, O-59..O-62)."""
    configure(spark)
    return power_fact(_power_silver(spark, d))


def _climate_silver(spark, d):
    """J-4 raw CSV (CP949) -> J-5 transform -> station map -> J-6 silver."""
    from regiostat.plans.climate import climate_silver, climate_transform
    from regiostat.plans.tpch import climate_meta, climate_raw, region_lookups
    path = scratch_path(spark, "climate-raw")
    write_legacy_csv(climate_raw(spark, d), path)
    raw = read_legacy_csv(spark, path)
    region, alias, std = region_lookups(spark, d)
    raw, meta = climate_transform(raw, climate_meta(spark, d, region))
    stations, _ = station_map(meta, alias)
    # the station map is a small dimension that the silver join reads twice
    # (size check and join): checkpoint it instead of re-running the meta chain
    return climate_silver(raw, materialize(stations), std)


def climate_trend_fact(spark: SparkSession, d: str) -> DataFrame:
    """J-4..J-7 end to end with the reference's headers; complete years only (D1)."""
    from regiostat.plans.climate import fact_climate_trend
    configure(spark)
    return fact_climate_trend(_climate_silver(spark, d), complete_years_only=True)


def climate_compare_fact(spark: SparkSession, d: str) -> DataFrame:
    """J-4..J-6 then J-8 (province x calendar month normals)."""
    from regiostat.plans.climate import fact_regional_compare
    configure(spark)
    return fact_regional_compare(_climate_silver(spark, d))


def climate_extreme_fact(spark: SparkSession, d: str) -> DataFrame:
    """J-4..J-6 then J-9 (province x year extremes)."""
    from regiostat.plans.climate import fact_extreme_weather
    configure(spark)
    return fact_extreme_weather(_climate_silver(spark, d))


TREND_PROFILE_COLS = ["avg_temp", "avg_max_temp", "avg_min_temp", "year_max_temp", "year_min_temp",
                      "total_precip_mm", "avg_temp_range", "temp_yoy_diff"]


def climate_trend_profile(spark: SparkSession, d: str) -> DataFrame:
    """``fact_trend.describe()`` on the J-7 output (O-41)."""
    from regiostat.plans.climate import fact_climate_trend
    configure(spark)
    fact = fact_climate_trend(_climate_silver(spark, d), complete_years_only=True)
    return profile_op(fact, TREND_PROFILE_COLS, std_scale=6, mean_scale=6)


def climate_silver_summary(spark: SparkSession, d: str) -> DataFrame:
    """Silver row count, distinct provinces and stations (O-40f, O-40j)."""
    configure(spark)
    silver = _climate_silver(spark, d)
    return silver.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_distinct("sd_name_std").alias("n_provinces"),
                      F.count_distinct("지점").alias("n_stations"))


def _trap_chain(spark, d):
    """J-4..J-6 with a fault planted for every step: (silver, stations, unmatched report)."""
    from regiostat.plans.climate import climate_silver, climate_transform
    from regiostat.plans.tpch import climate_meta_traps, climate_raw, region_std, trap_alias
    root = scratch_path(spark, "climate-traps")
    write_legacy_csv(climate_raw(spark, d), f"{root}/raw")
    write_legacy_csv(climate_meta_traps(spark, d), f"{root}/meta")  # landed as CSV too: ids arrive as text
    raw, meta = climate_transform(read_legacy_csv(spark, f"{root}/raw"), read_legacy_csv(spark, f"{root}/meta"))
    stations, report = station_map(materialize(meta), materialize(trap_alias(spark, d)))
    stations = materialize(stations)
    return climate_silver(raw, stations, region_std(spark, d)), stations, report


def climate_traps_trend(spark: SparkSession, d: str) -> DataFrame:
    """J-7 over metadata with planted faults: mountain, single closed, late
    closed and open stations, equal closing dates, a missing address, an
    unmapped province, leading blanks (O-27, O-30, O-32, O-48, O-57, O-39)."""
    from regiostat.plans.climate import fact_climate_trend
    configure(spark)
    return fact_climate_trend(_trap_chain(spark, d)[0], complete_years_only=True)


def climate_traps_stations(spark: SparkSession, d: str) -> DataFrame:
    """Stations and provinces that J-5 and J-6 leave of the faulty metadata."""
    configure(spark)
    return _trap_chain(spark, d)[1].select(F.col("지점").cast("long").alias("station"), "sd_code")


def climate_traps_unmatched(spark: SparkSession, d: str) -> DataFrame:
    """The unmatched report of the chain (O-39)."""
    configure(spark)
    return _trap_chain(spark, d)[2].select(F.col("지점").cast("long").alias("station"), F.col("지점명").alias("name"), "sd_raw")


QUERIES = {
    "climate_traps_trend": climate_traps_trend,
    "climate_traps_stations": climate_traps_stations,
    "climate_traps_unmatched": climate_traps_unmatched,
    "region_year_trend": region_year_trend,
    "region_year_trend_complete": region_year_trend_complete,
    "region_month_normals": region_month_normals,
    "region_year_extremes": region_year_extremes,
    "nation_month_mom_yoy": nation_month_mom_yoy,
    "nation_month_yoy_calendar": nation_month_yoy_calendar,
    "acctbal_interpolate": acctbal_interpolate,
    "weighted_merge": weighted_merge_q,
    "surrogate_ids": surrogate_ids_q,
    "same_month_override": same_month_override,
    "point_update": point_update_q,
    "station_prune": station_prune,
    "keep_last_per_key": keep_last_per_key,
    "first_in_group": first_in_group,
    "first_token_lookup": first_token_lookup,
    "unmatched_report": unmatched_report,
    "lenient_cast": lenient_cast,
    "calendar_dims": calendar_dims,
    "unit_price": unit_price,
    "round_half_even": round_half_even_q,
    "clean_headers": clean_headers_q,
    "missing_slots": missing_slots,
    "next_period": next_period,
    "slot_atomicity": slot_atomicity,
    "retry_queue": retry_queue,
    "profile": profile,
    "top_preview": top_preview,
    "json_explode": json_explode,
    "incremental_ingest": incremental_ingest,
    "write_read_roundtrip": write_read_roundtrip,
    "range_bucket_layout": range_bucket_layout,
    "csv_legacy_charset": csv_legacy_charset,
    "bronze_ingest": bronze_ingest_q,
    "bronze_dead_letter": bronze_dead_letter,
    "bronze_stream": bronze_stream,
    "bronze_retry_queue": bronze_retry_queue,
    "power_silver": power_silver_q,
    "power_gold": power_gold,
    "climate_trend_fact": climate_trend_fact,
    "climate_compare_fact": climate_compare_fact,
    "climate_extreme_fact": climate_extreme_fact,
    "climate_trend_profile": climate_trend_profile,
    "climate_silver_summary": climate_silver_summary,
}

# queries over stored state build on this module's helpers
from regiostat.plans.stateful import QUERIES as STATEFUL  # noqa: E402

QUERIES.update(STATEFUL)
