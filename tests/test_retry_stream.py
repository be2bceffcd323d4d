"""Retry state of slots as a stream, against the batch query on the same failures."""

import datetime as dt

import pytest

from regiostat.operators.ingest import retry_queue
from regiostat.session import scratch_path
from regiostat.streaming.retry import current_status, run_retries

SCHEMA = "sd_code int, month string, failed_at timestamp, stored boolean"
KEYS = ["sd_code", "month"]
START = dt.datetime(2024, 1, 1)


def failures():
    rows = []
    for slot in range(12):
        n = (1, 3, 9, 10, 11, 25, 2, 9, 10, 1, 4, 400)[slot]
        rows += [(slot % 5, f"m{slot}", START + dt.timedelta(hours=2 * k + slot), False) for k in range(n)]
    return rows


def batch(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.sd_code, r.month): (r.attempts, r.status) for r in retry_queue(df, KEYS).collect()}


def run(spark, drops, **kw):
    root = scratch_path(spark, "retry-test")
    args = dict(attempts_dir=f"{root}/in/*", schema=spark.createDataFrame([], SCHEMA).schema, slot_keys=KEYS,
                failed_at="failed_at", log_path=f"{root}/log", checkpoint=f"{root}/ckpt", stored="stored") | kw
    for i, (rows, restart) in enumerate(drops):
        spark.createDataFrame(rows, SCHEMA).write.parquet(f"{root}/in/{i}")
        if restart:
            run_retries(spark, **args)
    return spark.read.parquet(args["log_path"])


@pytest.mark.parametrize("parts,restarts", [(1, True), (3, True), (4, False)])
def test_any_split_gives_the_batch_result(spark, parts, restarts):
    rows = failures()
    drops = [(rows[i::parts], restarts or i == parts - 1) for i in range(parts)]  # attempts of a slot in every drop
    log = run(spark, drops)
    got = {(r.sd_code, r.month): r for r in current_status(log, KEYS).collect()}
    assert {k: (r.attempts, r.status) for k, r in got.items()} == batch(spark, rows)
    for (code, month), r in got.items():
        last = max(t for c, m, t, _ in rows if (c, m) == (code, month))
        assert r.last_failed_at == last
        assert r.due_at == (last + dt.timedelta(hours=1) if r.status == "retry" else None)


def test_due_time_is_waited_for_and_success_clears(spark):
    later = dt.datetime.now() + dt.timedelta(days=400)
    one = [(1, "waits", later, False), (1, "due", START, False), (1, "stored", START, False)] + [(1, "dead", START, False)] * 10
    two = [(1, "stored", START, True), (None, "no slot", START, False), (1, "no time", None, False)]
    log = run(spark, [(one, True), (two, True), ([(1, "stored", START, False)], True)])
    got = {r.month: (r.attempts, r.status) for r in current_status(log, KEYS).collect()}
    assert got == {"due": (1, "retry"), "dead": (10, "dead_letter"), "stored": (1, "retry"), "no time": (1, "retry")}


def test_no_duplicates_in_the_log(spark):
    log = run(spark, [(failures(), True), ([(9, "x", START, False)], True)])
    rows = [(r.sd_code, r.month, r.attempts, r.status) for r in log.collect()]
    assert len(rows) == len(set(rows))
