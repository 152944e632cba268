"""Command line: ``python -m paperloom validate --source PATH --output FOLDER [--until STAGE]``.

Prints the package's summary; the exit code is 0 if it may be committed, else 1.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators.security import Budget
from .plans import ingest
from .sources.request import for_path, normalized


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser("paperloom")
    parser.add_argument("command", choices=["validate", "ingest"])
    parser.add_argument("--source", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--until", choices=[n for n, _ in ingest.STAGES])
    args = parser.parse_args(arguments)
    request = normalized(for_path(args.source))
    limits = request["resource_budget"]
    policy = ingest.Policy(Budget(limits["source_bytes"], limits["decompressed_bytes"], limits["parts"]), request["rendering_policy"]["mode"], profiles=tuple(request["rendering_policy"]["profiles"]))
    spark = SparkSession.builder.appName("paperloom").getOrCreate()
    tables = ingest.write(spark, request["sources"][0]["uri"], args.output, policy, args.until)
    if "package" not in tables:
        print(json.dumps({"stages": sorted(tables)}))
        return 0
    summary = tables["package"].first().asDict()
    print(json.dumps(summary))
    return 0 if summary["eligible"] else 1


if __name__ == "__main__":
    raise SystemExit(main())
