"""`python -m millrace <job> --input-stream … --output …`, also the file to hand to spark-submit."""

from __future__ import annotations

import sys

from millrace.config import Options
from millrace.plans.jobs import JOBS, run
from millrace.session import build_session


def main(arguments: list[str]) -> int:
    if not arguments or arguments[0] not in JOBS:
        print(f"usage: millrace ({' | '.join(JOBS)}) [--option value]...", file=sys.stderr)
        return 2
    options = Options.from_arguments(arguments[1:])
    spark = build_session(options.get("jobName", arguments[0]))
    run(spark, arguments[0], options)
    return 0


def command() -> None:
    sys.exit(main(sys.argv[1:]))


if __name__ == "__main__":
    command()
