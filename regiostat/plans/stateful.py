"""Registered queries over stored state: retries, closed collection loop,
incremental facts, membership in a partitioned store, stable keys, growing
series, sketched profiles, checked CSV, clustered files, stream metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiostat.operators.filters import null_out_invalid
from regiostat.operators.ingest import slot_grid
from regiostat.operators.membership import new_rows
from regiostat.operators.series_store import SeriesStore
from regiostat.operators.sketches import DISTINCT_ERROR, RANK_ERROR, profile_of, stored_sketches, update_profile
from regiostat.plans.collect import SLOT, PowerStore
from regiostat.plans.incremental import FactSpec, IncrementalFact
from regiostat.plans.tpch import district_month, orders_by_nation, station_month_obs
from regiostat.session import configure, materialize, scratch_path
from regiostat.sources.epochs import path_exists, read_if_exists
from regiostat.sources.keys import KeyDictionary
from regiostat.sources.landing import read_csv_checked, read_landing, unparsed_values
from regiostat.sources.layout import file_ranges, write_clustered
from regiostat.sources.sinks import write_table
from regiostat.sources.tables import read_table
from regiostat.streaming.metrics import MetricsListener, batch_metrics, observed
from regiostat.streaming.retry import LOG_TYPES, current_status, run_retries


def retry_stream(spark: SparkSession, d: str) -> DataFrame:
    """O-18 as stream state: error events are failed attempts of their user,
    landed in three drops and taken in by three runs on one checkpoint."""
    configure(spark)
    root = scratch_path(spark, "retry-stream")
    e = read_table(spark, d, "events", ["user_id", "ts", "event_type"]).where("event_type = 'error'")
    e = e.select("user_id", F.col("ts").cast("timestamp").alias("failed_at"))
    log = f"{root}/log"
    for n in range(3):
        e.where(F.dayofmonth("failed_at") % 3 == n).write.parquet(f"{root}/attempts/drop{n}")
        run_retries(spark, f"{root}/attempts/*", e.schema, ["user_id"], "failed_at", log, f"{root}/checkpoint")
    rows = read_if_exists(spark, log, StructType([e.schema["user_id"], *LOG_TYPES]))
    times = {c: F.col(c).cast("timestamp_ntz") for c in ("last_failed_at", "due_at")}
    return current_status(rows, ["user_id"]).withColumns(times)


#: Attempts after which the query's slots are dead, so that two runs show it.
COLLECT_ATTEMPTS = 2


def power_collect(spark: SparkSession, d: str) -> DataFrame:
    """J-1 as a closed loop (O-11, O-05, O-36, O-13, O-14, O-18, O-06): 1995
    lands with faults, then everything, then everything without faults.  What
    failed twice is dead and stays out although its last response is valid."""
    from regiostat.plans.catalog import _land_second_drop, _order_bounds, _payload
    configure(spark)
    root = scratch_path(spark, "collect")
    store = PowerStore(spark, f"{root}/store", max_attempts=COLLECT_ATTEMPTS)
    payload = materialize(_payload(spark, d))
    payload.where("year = '1995'").write.json(f"{root}/landing/drop1")
    _land_second_drop(payload, f"{root}/landing/drop2")
    _payload(spark, d, faults=False).write.json(f"{root}/landing/drop3")
    for n in (1, 2, 2, 3):  # the second run is repeated: it is committed already
        store.ingest(read_landing(spark, f"{root}/landing/drop{n}"), run=f"drop{n}")
    lo, hi = _order_bounds(spark, d)
    regions = read_table(spark, d, "region", ["r_regionkey"])
    grid = slot_grid(regions if lo else regions.limit(0), "r_regionkey", lo or "2000-01", hi or "2000-01", prefix_len=None)
    return store.status(grid)


def power_collect_bronze(spark: SparkSession, d: str) -> DataFrame:
    """Bronze rows of the closed loop, over two drops, the second with the first's slots again."""
    from regiostat.plans.catalog import _payload
    configure(spark)
    root = scratch_path(spark, "collect-bronze")
    store = PowerStore(spark, f"{root}/store")
    payload = materialize(_payload(spark, d))
    payload.where("year <= '1996'").write.json(f"{root}/landing/drop1")
    payload.write.json(f"{root}/landing/drop2")
    for n in (1, 2):
        store.ingest(read_landing(spark, f"{root}/landing/drop{n}"), run=f"drop{n}")
    return store.bronze().drop("epoch")


def power_collect_stream(spark: SparkSession, d: str) -> DataFrame:
    """The closed loop as an availableNow stream over two drops (O-19)."""
    from regiostat.plans.catalog import _land_second_drop, _payload
    from regiostat.streaming.incremental import collect_stream
    configure(spark)
    root = scratch_path(spark, "collect-stream")
    store = PowerStore(spark, f"{root}/store")
    payload = materialize(_payload(spark, d))
    payload.where("year = '1995'").write.json(f"{root}/landing/drop1")
    collect_stream(spark, f"{root}/landing/*", store, f"{root}/checkpoint")
    _land_second_drop(payload, f"{root}/landing/drop2")
    collect_stream(spark, f"{root}/landing/*", store, f"{root}/checkpoint")
    return store.bronze().drop("epoch")


def incremental_trend(spark: SparkSession, d: str) -> DataFrame:
    """J-7 kept up to date (O-08): a first load without some months and with
    wrong readings, then a delta of late and corrected slots."""
    from regiostat.plans.catalog import GROUP, TREND_STAGE1, TREND_STAGE2
    configure(spark)
    obs = materialize(station_month_obs(spark, d))
    late = (F.col("year") == 1997) & F.col("month").isin(2, 3) & (F.col("station") % 5 == 0)
    wrong = (F.col("year") == 1996) & (F.col("station") % 7 == 1)
    spec = FactSpec("station", GROUP, "year", TREND_STAGE1, TREND_STAGE2,
                    {"avg_price_range": F.col("avg_max_price") - F.col("avg_min_price")},
                    [("avg_price", "price_yoy_diff")], complete_only=True, row_keys=("station", "year", "month"))
    fact = IncrementalFact(spark, scratch_path(spark, "incremental-trend"), spec, obs.schema)
    fact.apply(obs.where(~late).withColumn("mean_price", F.when(wrong, F.lit(1.0)).otherwise(F.col("mean_price"))))
    fact.apply(obs.where(late | wrong))
    return fact.fact()


MEMBERSHIP_YEARS = (1996, 1997)


def missing_slots_pruned(spark: SparkSession, d: str) -> DataFrame:
    """Slots of two years that are not stored, from a store partitioned by year
    and month, by a Bloom filter and an exact rest (O-05, O-36)."""
    configure(spark)
    path = scratch_path(spark, "slot-store")
    got = orders_by_nation(spark, d).select(F.col("nation").cast("int").alias("sd_code"), "year", "month", "o_orderkey")
    write_table(got, path, partition_by=["year", "month"])
    first, last = MEMBERSHIP_YEARS
    nations = read_table(spark, d, "nation", ["n_nationkey"])
    grid = materialize(slot_grid(nations, "n_nationkey", f"{first}-01", f"{last}-12", prefix_len=None))
    return new_rows(grid, spark.read.schema(got.schema).parquet(path), SLOT, partition_by=["year", "month"])


KEYS_FIRST_YEAR = 1997


def stable_keys(spark: SparkSession, d: str) -> DataFrame:
    """O-47 with a key dictionary: the later years are numbered first, then all
    of them; the later years keep their ids."""
    configure(spark)
    dm = materialize(district_month(spark, d).select("year", "month", "sgg_name"))
    keys = KeyDictionary(spark, scratch_path(spark, "keys"), dm.schema)
    keys.extend(dm.where(F.col("year") >= KEYS_FIRST_YEAR), run="first")
    keys.extend(dm, run="second")
    keys.extend(dm, run="third")  # nothing is new
    return keys.ids(dm).select("id", "year", "month", "sgg_name")


INTERPOLATION_RUNS = 3


def interpolate_incremental(spark: SparkSession, d: str) -> DataFrame:
    """O-46 on a growing series: customers arrive in three runs by key; each
    reads the blocks of open gaps only.  Equals one pass over all."""
    from regiostat.plans.catalog import ACCTBAL_BLOCK
    configure(spark)
    c = read_table(spark, d, "customer", ["c_custkey", "c_nationkey", "c_acctbal"])
    c = null_out_invalid(c, ["c_acctbal"])
    c = materialize(c.withColumn("block", F.floor(F.col("c_custkey") / F.lit(ACCTBAL_BLOCK)).cast("long")))
    store = SeriesStore(spark, scratch_path(spark, "series"), c.schema, ["c_nationkey"], "c_custkey", "c_acctbal")
    top = (c.agg(F.max("c_custkey")).first()[0] or 0) + 1
    for n in range(INTERPOLATION_RUNS):
        low, high = (top * i // INTERPOLATION_RUNS for i in (n, n + 1))
        store.append(c.where((F.col("c_custkey") >= low) & (F.col("c_custkey") < high)), run=f"run{n}")
    return store.read().drop("block")


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def profile_sketched(spark: SparkSession, d: str) -> DataFrame:
    """O-41 from stored sketches by ship year; a year is replaced alone.  The
    sketched quantiles and distinct counts are held against the table itself."""
    configure(spark)
    li = read_table(spark, d, "lineitem", [*PROFILE_COLS, "l_shipdate"]).withColumn("year", F.year("l_shipdate"))
    li = li.drop("l_shipdate")
    path = scratch_path(spark, "sketches")
    update_profile(li.where("year <= 1998").withColumn("l_tax", F.lit(9.0)), path, PROFILE_COLS, ["year"])
    update_profile(li.where("year >= 1998"), path, PROFILE_COLS, ["year"])  # 1998 again, as it is
    update_profile(li.where("year < 1998"), path, PROFILE_COLS, ["year"])
    sketches = stored_sketches(spark, path, StructType([li.schema["year"]]))
    found = materialize(profile_of(sketches))  # one row a column

    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).alias("v")) for c in PROFILE_COLS]))
    rows = li.select(pairs.alias("p")).select("p.*").where("v IS NOT NULL")
    tags = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    ranks = rows.join(F.broadcast(found), F.col("c") == F.col("column")).groupBy("c").agg(
        F.count_distinct("v").alias("distinct"), F.count(F.lit(1)).alias("n"),
        *[F.sum((F.col("v") < F.col(t)).cast("long")).alias(f"below_{t}") for t in tags],
        *[F.sum((F.col("v") <= F.col(t)).cast("long")).alias(f"upto_{t}") for t in tags])
    near = F.lit(True)
    for t, at in tags.items():  # the rank that the value stands for is within the bound of the one asked for
        near = near & (F.col(f"below_{t}") <= (at + 2 * RANK_ERROR) * F.col("n")) & \
            (F.col(f"upto_{t}") >= (at - 2 * RANK_ERROR) * F.col("n"))
    close = F.abs(F.col("n_distinct") - F.col("distinct")) <= F.greatest(F.lit(1.0), 2 * DISTINCT_ERROR * F.col("distinct"))
    return found.join(ranks, F.col("c") == F.col("column"), "left").select(
        "column", "count", "min", "max", F.coalesce(near, F.lit(True)).alias("quantiles_near"),
        F.coalesce(close, F.lit(True)).alias("distinct_near"))


def csv_quarantine(spark: SparkSession, d: str) -> DataFrame:
    """O-04 with drift: one file a station; files of even stations have another
    column order, lack a column and have one more; short lines are planted."""
    configure(spark)
    obs = station_month_obs(spark, d)
    even = F.col("station") % 2 == 0
    ym = F.format_string("%04d-%02d", "year", "month")
    price = F.when(F.col("month") == 5, F.lit("x")).otherwise(F.col("mean_price").cast("string"))
    line = (F.when(F.col("month") == 7, F.concat_ws(",", "station", ym))  # a short line
             .when(even, F.concat_ws(",", ym, "station", F.lit("note")))
             .otherwise(F.concat_ws(",", "station", ym, price)))
    header = F.when(even, F.lit("일시,지점,비고")).otherwise(F.lit("지점,일시,평균기온(°C)"))
    # a station's months are bounded by the calendar
    texts = obs.groupBy("station").agg(F.array_join(F.sort_array(F.collect_list(line)), "\n").alias("lines"))
    path = scratch_path(spark, "csv-drift") + "/files"
    texts.select("station", F.concat(header, F.lit("\n"), "lines").alias("value")).repartition("station") \
         .write.partitionBy("station").text(path)
    if not path_exists(spark, path) or texts.isEmpty():
        return spark.createDataFrame([], "kind string, name string, n long")
    rows, bad, drift = read_csv_checked(spark, f"{path}/*", ["지점", "일시", "평균기온(°C)"], "UTF-8")
    parts = [rows.select(F.lit("row").alias("kind"), F.lit("good").alias("name")),
             bad.select(F.lit("row").alias("kind"), F.lit("quarantined").alias("name")),
             drift.select(F.col("kind"), F.col("column").alias("name"))]
    counts = parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("kind", "name").agg(F.count(F.lit(1)).alias("n"))
    unread = unparsed_values(rows, ["평균기온(°C)"]).select(
        F.lit("unparsed").alias("kind"), F.col("value").alias("name"), F.col("rows").alias("n"))
    return counts.unionByName(unread)


CLUSTER_FILES = 16


def zorder_layout(spark: SparkSession, d: str) -> DataFrame:
    """O-09 on two columns: orders along a Z-curve of customer and date.  A
    filter on either one can skip at least half of the files."""
    configure(spark)
    o = read_table(spark, d, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    path = scratch_path(spark, "zorder")
    cols = ["o_custkey", "o_orderdate"]
    write_clustered(o, path, cols, CLUSTER_FILES)
    back = spark.read.schema(o.schema).parquet(path)
    ranges = materialize(file_ranges(back, cols))  # one row a file
    marks = o.agg(*[F.percentile_approx(c, 0.5).alias(c) for c in cols])
    held = ranges.join(F.broadcast(marks), F.lit(True)).agg(*[
        F.coalesce(F.avg(F.col(c).between(F.col(f"min_{c}"), F.col(f"max_{c}")).cast("int")) <= 0.5, F.lit(True)).alias(f"{c}_skips")
        for c in cols]).first()
    years = back.groupBy(F.year("o_orderdate").alias("year")).agg(F.count(F.lit(1)).alias("n_orders"))
    return years.withColumns({f"{c}_skips": F.lit(held[f"{c}_skips"]) for c in cols})


def stream_metrics(spark: SparkSession, d: str) -> DataFrame:
    """O-10 on a stream: rows landed, rejected (error events) and stored of each
    micro-batch, as a listener wrote them."""
    configure(spark)
    root = scratch_path(spark, "metrics")
    e = read_table(spark, d, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    name = f"metrics-{root.rsplit('-', 1)[-1]}"
    listener = MetricsListener(spark, f"{root}/metrics", {name})
    spark.streams.addListener(listener)
    try:
        for n, part in enumerate((F.dayofmonth("ts") <= 15, F.dayofmonth("ts") > 15)):
            e.where(part).write.parquet(f"{root}/landing/drop{n}")
            landed = spark.readStream.schema(e.schema).parquet(f"{root}/landing/*")
            bad = F.col("event_type") == "error"
            landed = observed(landed, "landing", {"landed": F.count(F.lit(1)), "rejected": F.count_if(bad)})
            stored = observed(landed.where(~bad), "bronze", {"stored": F.count(F.lit(1))})
            stored.writeStream.queryName(name).format("parquet").option("path", f"{root}/bronze") \
                  .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()  # progress is reported after the batch
    finally:
        spark.streams.removeListener(listener)
    if listener.faults:
        raise RuntimeError(listener.faults[0])
    return batch_metrics(spark, f"{root}/metrics").select("batch_id", "metric", "value")


QUERIES = {f.__name__: f for f in (retry_stream, power_collect, power_collect_bronze, power_collect_stream, incremental_trend,
                                   missing_slots_pruned, stable_keys, interpolate_incremental, profile_sketched,
                                   csv_quarantine, zorder_layout, stream_metrics)}
