"""python -m lexloom QUERY FOLDER [--out PATH] [--format FORMAT] [--config FILE]: run a registered query and write or show it."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from lexloom.config import settings, toml_section
from lexloom.plans import corpus_queries, format_queries, layout_queries, lexicon_queries

DEFAULTS = {"out": "", "format": "parquet", "rows": 20}


def main(args: list[str] | None = None) -> int:
    queries = {k: f for p in (corpus_queries, lexicon_queries, layout_queries, format_queries) for k, f in p.QUERIES.items()}
    parser = argparse.ArgumentParser(prog="lexloom", description=__doc__)
    parser.add_argument("query", choices=sorted(queries))
    parser.add_argument("folder")
    parser.add_argument("--config", default="lexloom.toml")
    for name, value in DEFAULTS.items():
        parser.add_argument(f"--{name}", type=type(value))
    given = vars(parser.parse_args(args))
    s = settings(DEFAULTS, toml_section(given["config"], "lexloom"), given)
    df = queries[given["query"]](SparkSession.builder.appName("lexloom").getOrCreate(), given["folder"])
    if s["out"]:
        df.write.mode("overwrite").format(s["format"]).save(s["out"])
    else:
        df.show(s["rows"], truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
