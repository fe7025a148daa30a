"""Run one registered query over a folder of tables and write its result.

    python -m tempest <query> <input_dir> <output_path> [--format parquet|csv|json] [--mode overwrite]
    python -m tempest --list

Use the same module with ``spark-submit`` on a cluster; the session comes from the submit config.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tempest.plans.registry import QUERIES


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="python -m tempest", description=__doc__.splitlines()[0])
    p.add_argument("query", nargs="?")
    p.add_argument("input_dir", nargs="?")
    p.add_argument("output", nargs="?")
    p.add_argument("--format", default="parquet", choices=["parquet", "csv", "json"])
    p.add_argument("--mode", default="errorifexists", choices=["errorifexists", "overwrite", "append", "ignore"])
    p.add_argument("--list", action="store_true", help="list the registered queries")
    a = p.parse_args(argv)
    if a.list:
        print("\n".join(QUERIES))
        return 0
    if not (a.query and a.input_dir and a.output) or a.query not in QUERIES:
        p.error("need a registered query name (see --list), an input folder and an output path")
    spark = SparkSession.builder.appName(f"tempest-{a.query}").getOrCreate()
    QUERIES[a.query](spark, a.input_dir.rstrip("/")).write.mode(a.mode).format(a.format).save(a.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())
