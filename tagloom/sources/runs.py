"""Records of runs: what was called, what failed, and a page of a run's report tables."""

from __future__ import annotations

import html
import json
import traceback
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from tagloom.sources.fastq import _where


def _write(path: str, text: str) -> None:
    where, inner = _where(path)
    where.create_dir(inner.rsplit("/", 1)[0])
    with where.open_output_stream(inner, compression=None) as out:
        out.write(text.encode())


@contextmanager
def recorded(folder: str, entry: str, **params) -> Iterator[None]:
    """Write the call of an entry to a folder (calls/), and if it raises what it raised (errors/); the error goes on."""
    at = datetime.now(timezone.utc)
    row = {"entry": entry, "at": at.isoformat(), "params": json.dumps(params, default=str, sort_keys=True)}
    name = f"{at:%Y%m%dT%H%M%S%f}-{entry}.json"
    _write(f"{folder}/calls/{name}", json.dumps(row) + "\n")
    try:
        yield
    except Exception as e:
        _write(f"{folder}/errors/{name}", json.dumps(row | {"message": str(e), "trace": traceback.format_exc()}) + "\n")
        raise


def calls(spark: SparkSession, folder: str) -> DataFrame:
    """entry, at and params of all recorded calls."""
    return spark.read.schema("entry string, at string, params string").json(f"{folder}/calls")


def errors(spark: SparkSession, folder: str) -> DataFrame:
    schema = "entry string, at string, params string, message string, trace string"
    where, inner = _where(f"{folder}/errors")
    found = where.get_file_info(inner).type == fs.FileType.Directory
    return spark.read.schema(schema).json(f"{folder}/errors") if found else spark.createDataFrame([], schema)


def write_report(tables: dict[str, DataFrame | None], path: str, title: str = "Run", most: int = 10_000) -> None:
    """A page with the given report tables, which have a row a sample or bin; a step that wasn't run (None) is said to be missing. A table of more than `most` rows isn't one of a report, and raises."""
    parts = []
    for name, table in tables.items():
        parts.append(f"<h2>{html.escape(name)}</h2>")
        if table is None:
            parts.append("<p>This step was not run.</p>")
            continue
        rows = table.limit(most + 1).collect()
        if len(rows) > most:
            raise ValueError(f"{name} has more than {most} rows, report its aggregate")
        cell = lambda tag, x: f"<{tag}>{html.escape('.' if x is None else f'{x:.6g}' if isinstance(x, float) else str(x))}</{tag}>"
        parts.append("<table><tr>" + "".join(cell("th", c) for c in table.columns) + "</tr>" + "".join("<tr>" + "".join(cell("td", x) for x in r) + "</tr>" for r in rows) + "</table>")
    _write(path, f"<!doctype html><html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>{''.join(parts)}</body></html>\n")
