"""Domain roles played by the test tables.

The reference works on station-month climate observations and district-month
power readings.  On the TPC-H-like tables: a nation is a station (and a
district), a region is a province, an order is an observation dated by its
order month.  Every registered query reads these tables, so its work grows
with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.scalars import round_half_even
from regiostat.operators.joins import Bounded, broadcast_if_small, lookup_join
from regiostat.sources.tables import read_table

# Customers are joined to orders by broadcast only below this many rows; above
# it the planner's shuffle join (with AQE) takes over.
CUSTOMER_BROADCAST_ROWS = 2_000_000


def orders_by_nation(spark: SparkSession, d: str) -> DataFrame:
    """orders ⋈ customer: (nation, year, month, price) per order."""
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                                        "o_orderstatus", "o_orderpriority"])
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey"])
    c = broadcast_if_small(c, CUSTOMER_BROADCAST_ROWS)
    j = o.join(c, o["o_custkey"] == c["c_custkey"], "inner")
    return j.select("o_orderkey", "o_custkey", F.col("c_nationkey").alias("nation"),
                    F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"),
                    "o_totalprice", "o_orderdate", "o_orderstatus", "o_orderpriority")


def station_month_obs(spark: SparkSession, d: str) -> DataFrame:
    """One observation row per nation-month (the climate raw grain).

    Money is summed as DECIMAL, so sums and means do not depend on row order:
    mean_price = Σprice/n to the cent (half-even), total_price = Σprice,
    max/min price, order count.
    """
    obn = orders_by_nation(spark, d)
    agg = (obn.groupBy("nation", "year", "month")
              .agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("_tot"),
                   F.count(F.lit(1)).alias("order_cnt"),
                   F.max("o_totalprice").alias("max_price"),
                   F.min("o_totalprice").alias("min_price")))
    agg = agg.select("nation", "year", "month",
                     round_half_even(F.col("_tot").cast("double") / F.col("order_cnt"), 2).alias("mean_price"),
                     F.col("_tot").cast("double").alias("total_price"),
                     "max_price", "min_price", "order_cnt")
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    stations = lookup_join(n, r, "n_regionkey", "r_regionkey", how="left").select(
        F.col("n_nationkey").alias("station"), F.col("n_name").alias("station_name"),
        F.col("n_regionkey").alias("sd_code"), F.col("r_name").alias("sd_name_std"))
    return lookup_join(agg, stations, "nation", "station", how="inner").drop("nation")


def district_month(spark: SparkSession, d: str) -> DataFrame:
    """Power-silver grain: one row per nation (district) and month.

    sd_code = region key, sd_name = region name, sgg_name = nation name,
    house_cnt = orders, power_usage = mean order price, bill = min price.
    """
    obs = station_month_obs(spark, d)
    return obs.select("year", "month", F.col("sd_code").cast("int").alias("sd_code"),
                      F.col("sd_name_std").alias("sd_name"), F.col("station_name").alias("sgg_name"),
                      F.col("order_cnt").alias("house_cnt"),
                      F.col("mean_price").alias("power_usage"), F.col("min_price").alias("bill"))


# Usage offset that turns part of the nation-month means negative (invalid
# readings that the silver layer nulls and interpolates).
USAGE_OFFSET = 200_000.0


def district_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Power bronze grain with an insert-ordered id: id grows with (year, month)."""
    obs = station_month_obs(spark, d)
    return obs.select(
        # room for 1e9 station keys a month
        ((F.col("year") * 12 + F.col("month")).cast("long") * 1_000_000_000 + F.col("station")).alias("id"),
        F.col("sd_code").cast("int").alias("sd_code"), "year", "month",
        F.col("sd_name_std").alias("sd_name"), F.col("station_name").alias("sgg_name"),
        F.col("order_cnt").alias("house_cnt"),
        (F.col("mean_price") - F.lit(USAGE_OFFSET)).alias("power_usage"),
        F.floor("min_price").cast("long").alias("bill"))


# Raw climate header -> expression over the nation-month observations.  Empty
# strings are missing readings, 'x' a malformed one.
CLIMATE_RAW_ROLES = [
    ("지점", "station"), ("지점명", "station_name"), ("일시", "_ym"),
    ("평균기온(°C)", "mean_price"), ("평균최고기온(°C)", "max_price"), ("평균최저기온(°C)", "min_price"),
    ("최고기온(°C)", "max_price"), ("최저기온(°C)", "min_price"), ("평균해면기압(hPa)", "order_cnt"),
    ("평균수증기압(hPa)", "''"), ("평균이슬점온도(°C)", "''"), ("평균상대습도(%)", "order_cnt"),
    ("월합강수량(00~24h만)(mm)", "total_price"), ("일최다강수량(mm)", "max_price"),
    ("평균풍속(m/s)", "order_cnt"), ("최대풍속(m/s)", "order_cnt"), ("최다풍향(16방위)", "'NW'"),
    ("평균운량(1/10)", "''"), ("합계 일조시간(hr)", "order_cnt"), ("합계 일사량(MJ/m2)", "mean_price"),
    ("최심적설(cm)", "'x'"), ("평균지면온도(°C)", "mean_price"), ("비고", "''"),
]


def climate_raw(spark: SparkSession, d: str) -> DataFrame:
    """Climate raw rows (all strings, the reference's raw headers) from the
    nation-month observations."""
    obs = station_month_obs(spark, d).withColumn(
        "_ym", F.format_string("%04d-%02d", F.col("year"), F.col("month")))
    return obs.select(*[F.expr(e).cast("string").alias(h) for h, e in CLIMATE_RAW_ROLES])


def region_lookups(spark: SparkSession, d: str):
    """(region, alias, standard names) with row bounds from one count of the
    region table: the alias table has at most three forms per region."""
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    n = r.count()
    return Bounded(r, n), Bounded(region_alias(spark, d), 3 * n), Bounded(region_std(spark, d), n)


def climate_meta(spark: SparkSession, d: str, region=None) -> DataFrame:
    """Station metadata: each nation has an old closed record (old address) and
    a current open one; the address starts with the region name."""
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = region if region is not None else read_table(spark, d, "region", ["r_regionkey", "r_name"])
    j = lookup_join(n, r, "n_regionkey", "r_regionkey", how="left")
    cur = j.select(F.col("n_nationkey").alias("지점"), F.col("n_name").alias("지점명"),
                   F.concat_ws(" ", "r_name", "n_name").alias("지점주소"),
                   F.lit(None).cast("string").alias("종료일"))
    old = j.select(F.col("n_nationkey").alias("지점"), F.col("n_name").alias("지점명"),
                   F.concat_ws(" ", F.lit("OLD"), "r_name").alias("지점주소"),
                   F.lit("1994-12-31").alias("종료일"))
    return cur.unionByName(old)


def region_alias(spark: SparkSession, d: str) -> DataFrame:
    """Alias -> code: the region name, its lower-case form and its first word
    (several aliases per code, each alias once)."""
    from regiostat.functions.scalars import first_token
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    forms = [F.col("r_name"), F.lower("r_name"), first_token("r_name")]
    out = None
    for f in forms:
        part = r.select(f.alias("sd_name_alias"), F.col("r_regionkey").alias("sd_code"))
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def region_std(spark: SparkSession, d: str) -> DataFrame:
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    return r.select(F.col("r_regionkey").cast("int").alias("sd_code"), F.col("r_name").alias("sd_name"))


# Faults planted in the station metadata, by station key modulo their number:
# each is caught by one step of J-5 or J-6 and changes the facts without it.
TRAPS = ("mountain", "single closed", "single closed late", "single open", "equal dates", "fixed", "unmapped", "two records")


def climate_meta_traps(spark: SparkSession, d: str) -> DataFrame:
    """Station metadata with a fault for every step of J-5 and J-6."""
    from regiostat.plans.climate import META_FIX, MOUNTAIN_MARKER
    n = read_table(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read_table(spark, d, "region", ["r_regionkey", "r_name"])
    j = lookup_join(n, r, "n_regionkey", "r_regionkey", how="left")
    kind = F.col("n_nationkey") % len(TRAPS)
    here, other = F.concat_ws(" ", "r_name", "n_name"), F.concat(F.lit("ASIA "), F.col("n_name"))

    def record(address, closed):
        return F.struct(address.alias("address"), closed.cast("string").alias("closed"))

    open_ = F.lit(None)
    records = (F.when(kind == 0, F.array(record(F.concat(here, F.lit(" " + MOUNTAIN_MARKER)), open_)))
                .when(kind == 1, F.array(record(here, F.lit("1999-12-31"))))
                .when(kind == 2, F.array(record(here, F.lit("2001-05-31"))))
                .when(kind == 3, F.array(record(here, open_)))
                .when(kind == 4, F.array(record(here, F.lit("2015-03-01")), record(other, F.lit("2015-03-01"))))
                .when(kind == 5, F.array(record(F.lit(None).cast("string"), open_)))
                .when(kind == 6, F.array(record(F.concat(F.lit("UNKNOWN "), F.col("n_name")), open_)))
                .otherwise(F.array(record(F.concat(F.lit("OLD "), F.col("r_name")), F.lit("1994-12-31")),
                                   record(F.concat(F.lit("  "), here), open_))))
    rows = j.select("n_nationkey", F.when(kind == 5, F.lit(META_FIX[0])).otherwise(F.col("n_name")).alias("name"),
                    F.explode(records).alias("m"))
    return rows.select(F.col("n_nationkey").alias("지점"), F.col("name").alias("지점명"),
                       F.col("m.address").alias("지점주소"), F.col("m.closed").alias("종료일"))


def trap_alias(spark: SparkSession, d: str) -> DataFrame:
    """The region aliases and the province of the corrected address, mapped to the first region."""
    from regiostat.plans.climate import META_FIX
    first = read_table(spark, d, "region", ["r_regionkey"]).agg(F.min("r_regionkey").alias("sd_code"))
    fixed = first.where("sd_code IS NOT NULL").select(F.lit(META_FIX[1].split()[0]).alias("sd_name_alias"), "sd_code")
    return region_alias(spark, d).unionByName(fixed)
