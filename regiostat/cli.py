"""Command-line runner for the pipeline steps (what the reference's notebooks do).

    python -m regiostat power-ingest   --landing DIR --bronze DIR --dead-letter DIR
    python -m regiostat power-silver   --bronze DIR --silver DIR [--override-missing skip]
    python -m regiostat power-fact     --silver DIR --fact DIR
    python -m regiostat climate-raw    --raw-csv FILE --meta-csv FILE --raw DIR --meta DIR
    python -m regiostat climate-transform --raw DIR --meta DIR --raw-out DIR --meta-out DIR
    python -m regiostat climate-facts  --raw DIR --meta DIR --alias DIR --std DIR --out DIR
                                       [--all-years]

Every output is a truncate-and-load parquet table (the bronze and dead-letter
tables are appended to); facts are partitioned by year where they have one.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def _existing(spark: SparkSession, path: str):
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def power_ingest(spark, a) -> dict:
    from pyspark.sql import functions as F

    from regiostat.plans.power import bronze_ingest
    from regiostat.sources.landing import read_landing
    from regiostat.sources.sinks import write_table
    bronze = _existing(spark, a.bronze)
    good, rejected = bronze_ingest(spark, read_landing(spark, a.landing), bronze)
    n_good = write_table(good, a.bronze, mode="append")
    n_bad = write_table(rejected.withColumn("loaded_at", F.current_timestamp()), a.dead_letter, mode="append")
    return {"bronze_rows": n_good, "dead_letter_rows": n_bad}


def power_silver(spark, a) -> dict:
    from regiostat.plans.power import SilverParams
    from regiostat.plans.power import power_silver as job
    from regiostat.sources.sinks import write_table
    params = SilverParams(strict_override=a.override_missing == "fail")
    return {"silver_rows": write_table(job(spark.read.parquet(a.bronze), params), a.silver)}


def power_fact(spark, a) -> dict:
    from regiostat.plans.power import power_fact as job
    from regiostat.sources.sinks import write_table
    fact = job(spark.read.parquet(a.silver))
    return {"fact_rows": write_table(fact, a.fact, partition_by=["year"], cluster_by=["sd_name", "sgg_name"])}


def climate_raw(spark, a) -> dict:
    from regiostat.sources.landing import read_legacy_csv
    from regiostat.sources.sinks import write_table
    raw = read_legacy_csv(spark, a.raw_csv, encoding=a.encoding)
    meta = read_legacy_csv(spark, a.meta_csv, encoding=a.encoding)
    return {"raw_rows": write_table(raw, a.raw), "meta_rows": write_table(meta, a.meta)}


def climate_transform(spark, a) -> dict:
    from regiostat.plans.climate import climate_transform as job
    from regiostat.sources.sinks import write_table
    raw, meta = job(spark.read.parquet(a.raw), spark.read.parquet(a.meta))
    return {"raw_rows": write_table(raw, a.raw_out), "meta_rows": write_table(meta, a.meta_out)}


def climate_facts(spark, a) -> dict:
    from regiostat.plans.climate import (
        climate_silver, fact_climate_trend, fact_extreme_weather, fact_regional_compare, station_map,
    )
    from regiostat.session import materialize
    from regiostat.sources.sinks import write_table
    stations, report = station_map(spark.read.parquet(a.meta), spark.read.parquet(a.alias))
    silver = materialize(climate_silver(spark.read.parquet(a.raw), materialize(stations),
                                        spark.read.parquet(a.std)))
    out = a.out.rstrip("/")
    return {
        "unmatched_stations": write_table(report, f"{out}/unmatched_stations"),
        "silver_rows": write_table(silver, f"{out}/silver", partition_by=["year"]),
        "fact_climate_trend": write_table(fact_climate_trend(silver, complete_years_only=not a.all_years),
                                          f"{out}/fact_climate_trend"),
        "fact_regional_compare": write_table(fact_regional_compare(silver), f"{out}/fact_regional_compare"),
        "fact_extreme_weather": write_table(fact_extreme_weather(silver), f"{out}/fact_extreme_weather"),
    }


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="regiostat")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("power-ingest")
    s.add_argument("--landing", required=True)
    s.add_argument("--bronze", required=True)
    s.add_argument("--dead-letter", required=True)
    s = sub.add_parser("power-silver")
    s.add_argument("--bronze", required=True)
    s.add_argument("--silver", required=True)
    s.add_argument("--override-missing", choices=["fail", "skip"], default="fail",
                   help="an override rule whose source row is absent: fail (as the reference) or skip")
    s = sub.add_parser("power-fact")
    s.add_argument("--silver", required=True)
    s.add_argument("--fact", required=True)
    s = sub.add_parser("climate-raw")
    s.add_argument("--raw-csv", required=True)
    s.add_argument("--meta-csv", required=True)
    s.add_argument("--raw", required=True)
    s.add_argument("--meta", required=True)
    s.add_argument("--encoding", default="x-windows-949")
    s = sub.add_parser("climate-transform")
    s.add_argument("--raw", required=True)
    s.add_argument("--meta", required=True)
    s.add_argument("--raw-out", required=True)
    s.add_argument("--meta-out", required=True)
    s = sub.add_parser("climate-facts")
    for k in ("--raw", "--meta", "--alias", "--std", "--out"):
        s.add_argument(k, required=True)
    s.add_argument("--all-years", action="store_true", help="keep years with fewer than 12 months in the trend")
    return p


COMMANDS = {"power-ingest": power_ingest, "power-silver": power_silver, "power-fact": power_fact,
            "climate-raw": climate_raw, "climate-transform": climate_transform, "climate-facts": climate_facts}


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    from regiostat.session import configure, get_session
    args = parser().parse_args(argv)
    spark = configure(spark) if spark is not None else get_session()
    result = COMMANDS[args.cmd](spark, args)
    print(result)
    return result


if __name__ == "__main__":
    main(sys.argv[1:])
