"""Commits of several tables, membership, closed collection loop, incremental facts, stable keys."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from conftest import SF_SMALL, have
from regiostat.operators.joins import anti_join
from regiostat.operators.membership import bloom_filter, might_contain, new_rows, partition_filter
from regiostat.plans import collect
from regiostat.plans.catalog import GROUP, TREND_STAGE1, TREND_STAGE2
from regiostat.plans.climate import two_stage
from regiostat.plans.incremental import FactSpec, IncrementalFact
from regiostat.session import scratch_path
from regiostat.sources import epochs
from regiostat.sources.epochs import EpochLog, read_committed, write_run
from regiostat.sources.keys import KeyDictionary
from regiostat.sources.landing import read_landing

ROW = StructType([StructField("k", LongType()), StructField("v", StringType())])


# ------------------------------------------------------------ one commit
def test_run_that_fails_between_tables_is_not_seen(spark, monkeypatch):
    root = scratch_path(spark, "epochs")
    log = EpochLog(spark, f"{root}/commits")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], ROW)
    one, two = f"{root}/one", f"{root}/two"

    def seen():
        return [sorted((r.k, r.v) for r in read_committed(spark, p, ROW, log).collect()) for p in (one, two)]

    assert seen() == [[], []] and log.last() is None
    assert write_run(log, "r1", {one: (rows, []), two: (rows.where("k = 1"), [])}) == 0
    first = [[(1, "a"), (2, "b")], [(1, "a")]]
    assert seen() == first

    later = spark.createDataFrame([(3, "c"), (4, "d")], ROW)
    broken = later.withColumn("v", F.when(F.col("k") > 0, F.raise_error(F.lit("lost"))).cast("string"))
    with pytest.raises(Exception, match="lost"):  # the first table is written, the second fails
        write_run(log, "r2", {one: (later, []), two: (broken, [])})
    assert os.path.exists(f"{one}/epoch=1".replace("file:", "")) and seen() == first
    # the replay has other rows: what the failed run left is gone
    assert write_run(log, "r2", {one: (later.where("k = 3"), []), two: (later, [])}) == 1
    assert seen() == [[(1, "a"), (2, "b"), (3, "c")], [(1, "a"), (3, "c"), (4, "d")]]
    assert write_run(log, "r2", {one: (later, []), two: (later, [])}) is None  # committed already
    assert log.table().orderBy("epoch").collect()[1].counts == {"one": 1, "two": 2}


def test_only_a_missing_table_reads_as_empty(spark):
    path = scratch_path(spark, "missing") + "/not-there"
    assert epochs.read_if_exists(spark, path, ROW).count() == 0
    spark.createDataFrame([(1,)], "other int").write.parquet(path)
    assert epochs.read_if_exists(spark, path, ROW).select("k").collect()[0].k is None
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "k string").write.mode("overwrite").parquet(path)
        epochs.read_if_exists(spark, path, ROW).collect()


# ------------------------------------------------------------- membership
def test_bloom_filter_has_no_false_negative_and_few_false_positives(spark):
    stored = spark.range(5000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("s"))
    bits = 1 << 16
    bloom = bloom_filter(stored, ["k", "s"], bits)
    assert len(bloom.first().bloom) == bits // 64
    probe = spark.range(15000).select(F.col("id").alias("k"), F.lit("x").alias("s"))
    hit = probe.withColumn("hit", might_contain(bloom.scalar(), ["k", "s"], bits))
    r = hit.agg(F.sum(F.when(F.col("k") % 3 == 0, F.col("hit").cast("int"))).alias("true"),
                F.sum(F.when(F.col("k") % 3 != 0, F.col("hit").cast("int"))).alias("false")).first()
    assert r.true == 5000 and r.false < 10000 * 0.02


@pytest.mark.parametrize("bits", [64, 1 << 12])  # a filter full of ones leaves all to the exact join
def test_new_rows_is_the_plain_anti_join(spark, bits):
    stored = spark.createDataFrame([(y, m, c) for y in (2000, 2001, 2002) for m in range(1, 13) for c in range(6) if (y + m + c) % 3],
                                   "year int, month int, sd_code int")
    stored = stored.unionByName(stored)
    path = scratch_path(spark, "membership") + "/store"
    stored.write.partitionBy("year", "month").parquet(path)
    back = spark.read.schema(stored.schema).parquet(path)
    batch = spark.createDataFrame([(2001, m, c) for m in (1, 2, None) for c in [*range(8), None]] + [(1990, 1, 1), (2001, 1, 0)],
                                  stored.schema)
    got = new_rows(batch, back, collect.SLOT, ["year", "month"], bits)
    want = anti_join(batch, stored, collect.SLOT)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    read = [line for line in plan.split("\n") if "PartitionFilters" in line and "membership" in line]
    assert read and all("month" in line.split("PartitionFilters")[1] for line in read)


def test_partition_filter_values(spark):
    df = spark.createDataFrame([(1, 1), (1, None), (None, 2), (2, 2), (3, 1)], "a int, b int")
    got = df.where(partition_filter([(1, None), (None, 2), (3, 1)], ["a", "b"])).collect()
    assert sorted(map(str, got)) == sorted(map(str, df.where("(a = 1 AND b IS NULL) OR a IS NULL OR a = 3").collect()))
    assert df.where(partition_filter([], ["a"])).count() == 0


# ---------------------------------------------------------- closed loop
def response(year, month, code, good=True, city="c"):
    item = {"year": str(year), "month": f"{month:02d}", "metro": "m", "city": city, "houseCnt": "5" if good else "n/a",
            "powerUsage": "1.5", "bill": "10"}
    return {"year": str(year), "month": f"{month:02d}", "metroCd": str(code), "data": [item, dict(item, city=city + "2", houseCnt="7")]}


def land(spark, folder, responses, junk=()):
    import json
    lines = [json.dumps(r) for r in responses] + list(junk)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(2).write.text(folder)
    return read_landing(spark, folder)


def slots(df):
    return sorted((r.year, r.month, r.sd_code) for r in df.select(*collect.SLOT).distinct().collect())


def test_closed_loop(spark, monkeypatch):
    root = scratch_path(spark, "loop")
    store = collect.PowerStore(spark, f"{root}/store", max_attempts=2)
    grid = spark.createDataFrame([(2020, m, c) for m in (1, 2) for c in (11, 26)], "year int, month int, sd_code int")
    assert slots(store.wanted(grid)) == slots(grid)
    one = land(spark, f"{root}/1", [response(2020, 1, 11), response(2020, 1, 26, False), response(2020, 1, 26, False)], ["{cut"])

    # the dead letter can't be written: nothing of the run counts
    real = collect.write_run

    def failing(log, run, tables):
        (path, (rows, parts)), _ = tables.items()
        rows.write.mode("overwrite").partitionBy(*parts).parquet(f"{path}/epoch=0")
        raise OSError("lost between the two tables")

    monkeypatch.setattr(collect, "write_run", failing)
    with pytest.raises(OSError):
        store.ingest(one, "one")
    assert store.bronze().count() == 0 and slots(store.wanted(grid)) == slots(grid)
    monkeypatch.setattr(collect, "write_run", real)

    assert store.ingest(one, "one") == 0 and store.ingest(one, "one") is None
    assert store.bronze().count() == 2 and store.dead_letter().count() == 5
    assert slots(store.wanted(grid)) == [(2020, 1, 26), (2020, 2, 11), (2020, 2, 26)]
    two = land(spark, f"{root}/2", [response(2020, 1, 11, city="again"), response(2020, 1, 26, False), response(2020, 2, 11)])
    store.ingest(two, "two")
    assert slots(store.wanted(grid)) == [(2020, 2, 26)]  # two failures: dead
    three = land(spark, f"{root}/3", [response(2020, 1, 26), response(2020, 2, 26)])
    store.ingest(three, "three")
    got = {(r.month, r.sd_code): (r.status, r.attempts) for r in store.status(grid).collect()}
    assert got == {(1, 11): ("stored", 0), (1, 26): ("dead_letter", 2), (2, 11): ("stored", 0), (2, 26): ("stored", 0)}
    assert store.bronze().count() == 6 and store.bronze().where("sgg_name LIKE 'again%'").count() == 0
    assert {f.split("/bronze/")[1].rsplit("/", 1)[0] for f in store.bronze().inputFiles()} == {
        "epoch=0/year=2020/month=1", "epoch=1/year=2020/month=2", "epoch=2/year=2020/month=2"}


# ------------------------------------------------------ incremental facts
OBS = ("station int, station_name string, sd_code int, sd_name_std string, year int, month int, mean_price double, "
       "total_price double, max_price double, min_price double, order_cnt long")


def observations():
    rows = []
    for s in range(6):
        for y in (2000, 2001, 2003, 2004):
            for m in range(1, 13):
                v = float((s * 37 + y * 11 + m * 7) % 90)
                rows.append((s, f"s{s}", s % 3, f"p{s % 3}", y, m, v, v * 3, v + 5, v - 5, s + m))
    return rows


def spec(complete):
    return FactSpec("station", GROUP, "year", TREND_STAGE1, TREND_STAGE2,
                    {"avg_price_range": F.col("avg_max_price") - F.col("avg_min_price")},
                    [("avg_price", "price_yoy_diff")], complete_only=complete)


def whole(df, complete):
    s = spec(complete)
    return two_stage(df, s.station, s.group, s.period, s.stage1, s.derive, s.stage2, s.diffs, complete)


def files(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(root.replace("file:", "")) for f in names if f.endswith(".parquet")}


def same(a, b):
    cols = sorted(b.columns)
    return sorted(map(str, a.select(cols).collect())) == sorted(map(str, b.select(cols).collect()))


@pytest.mark.parametrize("complete", [False, True])
def test_incremental_fact_is_the_full_one(spark, complete):
    rows = observations()
    base = [r for r in rows if not (r[4] == 2001 and r[2] == 1 and r[5] in (3, 4)) and not (r[4] == 2003 and r[2] == 2)]
    fact = IncrementalFact(spark, scratch_path(spark, "fact"), spec(complete), spark.createDataFrame([], OBS).schema)
    fact.apply(spark.createDataFrame(base, OBS))
    assert same(fact.fact(), whole(spark.createDataFrame(base, OBS), complete))
    steps = [
        [r for r in rows if r[4] == 2001 and r[2] == 1 and r[5] == 3],  # late
        [r for r in rows if r[4] == 2001 and r[2] == 1 and r[5] == 4],
        [(*r[:6], r[6] + 1, *r[7:]) for r in rows if r[0] == 4 and r[4] == 2000 and r[5] == 5],  # corrected
        [r for r in rows if r[4] == 2003 and r[2] == 2],  # a year between two others: the later one's difference moves
        [(*r[:4], 2010, *r[5:]) for r in rows if r[0] == 0 and r[4] == 2004],
    ]
    now = {(r[0], r[4], r[5]): r for r in base}
    for delta in steps:
        before = files(f"{fact.root}/fact"), files(f"{fact.root}/station")
        written = fact.apply(spark.createDataFrame(delta, OBS))
        now.update({(r[0], r[4], r[5]): r for r in delta})
        assert same(fact.fact(), whole(spark.createDataFrame(list(now.values()), OBS), complete))
        touched = {(r[2], r[4]) for r in delta}
        assert touched <= set(written) and len(written) <= 2 * len(touched)
        for level, old, parts in (("fact", before[0], set(written)), ("station", before[1], touched)):
            folders = {f"sd_code={g}/year={y}" for g, y in parts}
            kept = {f: t for f, t in old.items() if not any(x in f for x in folders)}
            new = files(f"{fact.root}/{level}")
            assert kept and all(new.get(f) == t for f, t in kept.items())
    again = files(fact.root)
    assert fact.apply(spark.createDataFrame([], OBS)) == [] and files(fact.root) == again
    fact.apply(spark.createDataFrame(steps[-1], OBS))  # a repeated delta
    assert same(fact.fact(), whole(spark.createDataFrame(list(now.values()), OBS), complete))


def test_partition_that_loses_its_rows(spark):
    """A correction without a reading key: complete years that become incomplete leave the fact."""
    rows = [r for r in observations() if r[0] == 0]
    fact = IncrementalFact(spark, scratch_path(spark, "fact-empty"), spec(True), spark.createDataFrame([], OBS).schema)
    fact.apply(spark.createDataFrame(rows, OBS))
    assert {r.year for r in fact.fact().collect()} == {2000, 2001, 2003, 2004}
    # station 0's April 2001 is reported for March, twice in effect: eleven months are left
    moved = [(*r[:5], 3, *r[6:]) if r[4] == 2001 and r[5] == 4 else r for r in rows if r[4] == 2001]
    fact.spec.row_keys = ("station", "year")  # the whole year is replaced
    fact.apply(spark.createDataFrame(moved, OBS))
    want = [r for r in rows if r[4] != 2001]
    assert same(fact.fact(), whole(spark.createDataFrame(want, OBS), True))
    assert fact.read("fact", [(0, 2001)]).count() == 0


# ------------------------------------------------------------ stable keys
def test_keys_stay(spark):
    schema = StructType([StructField("y", LongType()), StructField("name", StringType())])
    keys = KeyDictionary(spark, scratch_path(spark, "keys"), schema, start_after=100)
    runs = [[(2001, "b"), (2001, "a"), (2001, "a"), (None, "x")], [(2000, "z"), (2001, "a")], [], [(1999, "q"), (2002, "b"), (2000, "z")]]
    held = {}
    for n, rows in enumerate(runs):
        df = spark.createDataFrame(rows, schema)
        keys.extend(df, f"run{n}")
        now = {(r.y, r.name): r.id for r in keys.table().collect()}
        assert {k: now[k] for k in held} == held and len(set(now.values())) == len(now)
        assert sorted(now.values()) == list(range(101, 101 + len(now)))  # no gap
        held = now
    assert held == {(2001, "a"): 101, (2001, "b"): 102, (2000, "z"): 103, (1999, "q"): 104, (2002, "b"): 105}
    got = keys.ids(spark.createDataFrame([(2000, "z"), (None, "x"), (5, "no")], schema)).collect()
    assert sorted((r.id is None, r.id) for r in got if r.id) == [(False, 103)] and len(got) == 3


def test_keys_after_a_lost_run(spark, monkeypatch):
    schema = StructType([StructField("k", LongType())])
    keys = KeyDictionary(spark, scratch_path(spark, "keys-lost"), schema)
    keys.extend(spark.range(3).select(F.col("id").alias("k")), "one")
    monkeypatch.setattr(EpochLog, "commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        keys.extend(spark.range(10).select(F.col("id").alias("k")), "two")
    monkeypatch.undo()
    assert keys.table().count() == 3
    keys.extend(spark.range(5).select(F.col("id").alias("k")), "two")  # fewer keys than the lost run had
    assert sorted(r.id for r in keys.table().collect()) == [1, 2, 3, 4, 5]
