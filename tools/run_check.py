"""Run the end-to-end check from a harness-style JSON config and print the summary.

Usage: python tools/run_check.py config.json [--warehouse PATH]
"""

from __future__ import annotations

import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from streamledger.plans.harness import harness_options, integration_run  # noqa: E402
from streamledger.session import build_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    warehouse = None
    if "--warehouse" in args:
        i = args.index("--warehouse")
        warehouse = args[i + 1]
        args = args[:i] + args[i + 2 :]
    with open(args[0]) as fh:
        opts = harness_options(json.load(fh))
    spark = build_session()
    row = integration_run(spark, warehouse=warehouse, **opts).first()
    print(json.dumps(row.asDict(), default=str))
    spark.stop()


if __name__ == "__main__":
    main()
