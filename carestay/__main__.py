"""``python -m carestay <stays | tables dir> <out_dir> [--no-model] [--cluster]``: run the whole flow and write its tables.

The input is a CSV file or folder of raw stays (``.csv``), a Parquet table of raw stays (``.parquet``), or a folder of the
tables that stays are projected from.
"""

import sys

from carestay.plans.layers import run_all, run_stays
from carestay.session import build_session
from carestay.sources.io import read_stays


def main(argv: list[str]) -> None:
    argv_pos = [a for a in argv if not a.startswith("--")]
    if len(argv_pos) < 2:
        print(__doc__)
        raise SystemExit(2)
    source, out = argv_pos[:2]
    fit_model = "--no-model" not in argv
    spark = build_session(profile="cluster" if "--cluster" in argv else "local")
    if source.rstrip("/").lower().endswith((".csv", ".parquet")):
        paths = run_stays(spark, lambda: read_stays(spark, source), out, fit_model)
    else:
        paths = run_all(spark, source, out, fit_model)
    for name, path in paths.items():
        print(f"{name}\t{path}")
    spark.stop()


def cli() -> None:
    main(sys.argv[1:])


if __name__ == "__main__":
    cli()
