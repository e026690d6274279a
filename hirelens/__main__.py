"""Command line: the source project's jobs as Spark jobs.

    python -m hirelens ingest   --landing DIR --target PATH [--variant v1|v2]
    python -m hirelens seniority --clean PATH --out PATH
    python -m hirelens models   --clean PATH --out DIR [--seniority PATH]
    python -m hirelens skills   --sheets DIR --out PATH [--master FILE]

Paths are parquet folders (``--target`` is appended to); ``--master`` is
the sheet file to skip (by default the first sheet). The session comes from ``spark-submit`` settings;
``--master`` URL and shuffle partitions can be given for local runs.
"""

from __future__ import annotations

import argparse
import os

from pyspark.sql import SparkSession


def _session(args) -> SparkSession:
    from hirelens.session import build_session
    return build_session(args.spark_master, shuffle_partitions=args.shuffle_partitions)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def cmd_ingest(args) -> None:
    from hirelens.plans.ingest import ingest
    from hirelens.sources.feed import read_landed_json
    spark = _session(args)
    from hirelens.schemas import CLEAN_SCHEMA
    stored = spark.read.schema(CLEAN_SCHEMA).parquet(args.target) if _exists(spark, args.target) else None
    batch = ingest(read_landed_json(spark, args.landing), stored, variant=args.variant)
    batch.write.mode("append").parquet(args.target)


def cmd_seniority(args) -> None:
    from hirelens.plans.enrich import seniority_dictionary
    spark = _session(args)
    seniority_dictionary(spark.read.parquet(args.clean)).write.mode("overwrite").parquet(args.out)


def cmd_models(args) -> None:
    from hirelens.plans import enrich, models
    from hirelens.session import written
    spark = _session(args)
    clean = spark.read.parquet(args.clean)
    profiles = written(models.posting_profiles(clean), "profiles")[0]
    seniority = (spark.read.parquet(args.seniority) if args.seniority
                 else enrich.seniority_dictionary(profiles))
    out = args.out.rstrip("/")

    def save(df, name):
        df.write.mode("overwrite").parquet(f"{out}/{name}")
        return spark.read.parquet(f"{out}/{name}")

    city = save(models.base_city(profiles), "base_city")
    save(models.base_state(city), "base_state")
    fact = save(models.fact_postings(clean, seniority, profiles=profiles), "int_postings")
    save(models.job_links(clean), "int_job_links")
    daily = save(models.jobs_daily(fact), "mart_total_jobs_daily")
    save(models.jobs_by_city(fact), "mart_total_jobs_by_city")
    save(models.jobs_by_org(fact), "mart_total_jobs_by_org")
    save(models.jobs_by_state(fact), "mart_total_jobs_by_state")
    save(models.jobs_by_type(fact), "mart_total_jobs_by_type")
    save(models.jobs_wow_trend(daily), "mart_total_jobs_wow_trend")


def cmd_skills(args) -> None:
    from hirelens.plans.enrich import top_job_skills
    from hirelens.sources.sheets import read_sheets
    spark = _session(args)
    descriptions = read_sheets(spark, args.sheets, master=args.master)
    top_job_skills(descriptions).write.mode("overwrite").parquet(args.out)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="hirelens")
    ap.add_argument("--spark-master", default=os.environ.get("HIRELENS_MASTER", "local[*]"))
    ap.add_argument("--shuffle-partitions", type=int, default=None)
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("ingest")
    p.add_argument("--landing", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--variant", default="v2", choices=["v1", "v2"])
    p.set_defaults(fn=cmd_ingest)
    p = sub.add_parser("seniority")
    p.add_argument("--clean", required=True)
    p.add_argument("--out", required=True)
    p.set_defaults(fn=cmd_seniority)
    p = sub.add_parser("models")
    p.add_argument("--clean", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--seniority", default=None)
    p.set_defaults(fn=cmd_models)
    p = sub.add_parser("skills")
    p.add_argument("--sheets", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--master", default=None)
    p.set_defaults(fn=cmd_skills)
    args = ap.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
