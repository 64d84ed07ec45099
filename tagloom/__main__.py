"""python -m tagloom ENTRY ARGUMENTS: the steps of `entries` on the command line, recorded in a folder (--runs)."""

from __future__ import annotations

import argparse
import inspect
import sys

from pyspark.sql import SparkSession

from tagloom.entries import ENTRIES
from tagloom.sources.runs import recorded


def parser() -> argparse.ArgumentParser:
    """Arguments without a default are positional, switches and values with one are options."""
    top = argparse.ArgumentParser(prog="tagloom", description=__doc__)
    top.add_argument("--runs", default="runs", help="where calls and errors are recorded")
    steps = top.add_subparsers(dest="entry", required=True)
    for name, f in ENTRIES.items():
        step = steps.add_parser(name.replace("_", "-"), help=f.__doc__)
        for p in list(inspect.signature(f).parameters.values())[1:]:
            option, kind = f"--{p.name.replace('_', '-')}", str(p.annotation)
            if p.default is inspect.Parameter.empty:
                step.add_argument(p.name)
            elif p.default is False:
                step.add_argument(option, action="store_true")
            else:
                step.add_argument(option, default=p.default, type=float if "float" in kind else int if "int" in kind else str)
    return top


def main(arguments: list[str]) -> None:
    given = vars(parser().parse_args(arguments))
    entry, folder = given.pop("entry").replace("-", "_"), given.pop("runs")
    spark = SparkSession.builder.appName(f"tagloom {entry}").getOrCreate()
    with recorded(folder, entry, **given):
        for name, table in (ENTRIES[entry](spark, **given) or {}).items():
            print(f"{name}:")
            table.show(20, False)


if __name__ == "__main__":
    main(sys.argv[1:])
