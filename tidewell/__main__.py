"""python -m tidewell run|verify|trace CONFIG [--topics FOLDER] [--once] [--table NAME] [--entity KEY]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .config import load_config
from .sources.bronze import read_lines
from .streaming.runner import run, supervise
from .trace import trace_entity
from .verify import details, report


#: Of the session, where nothing else is configured.  Fixed values of the reference's session.
DEFAULTS = {"spark.sql.session.timeZone": "UTC", "spark.sql.streaming.fileSource.log.cleanupDelay": "60000", "spark.sql.adaptive.enabled": "true"}


def session() -> SparkSession:
    spark = SparkSession.builder.appName("tidewell").getOrCreate()
    given = spark.sparkContext.getConf()
    for name, value in DEFAULTS.items():
        if not given.contains(name):
            spark.conf.set(name, value)
    return spark


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidewell")
    parser.add_argument("command", choices=["run", "verify", "trace"])
    parser.add_argument("config")
    parser.add_argument("--topics", help="folder whose subfolders are topics; those that no table reads are reported")
    parser.add_argument("--once", action="store_true", help="take what is there and end")
    parser.add_argument("--table", help="only this table")
    parser.add_argument("--entity", help="trace: the first key of the entity; one is sampled by default")
    args = parser.parse_args()
    tables = {n: s for n, s in load_config(args.config).items() if args.table in (None, n)}
    spark = session()
    if args.command == "verify":
        report(spark, tables).show(truncate=False)
        for name, spec in tables.items():
            for part, frame in details(spark, spec).items() if spec.enabled else ():
                print(f"{name}: {part}")
                frame.show(truncate=False)
        return
    if args.command == "trace":
        for name, spec in tables.items():
            print(name)
            trace_entity(read_lines(spark, spec.bronze_path), spec, args.entity).show(200, truncate=False)
        return
    queries = run(spark, tables, args.topics, once=args.once)
    if not args.once:
        supervise(spark, tables, queries)


if __name__ == "__main__":
    main()
