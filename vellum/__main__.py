"""``python -m vellum FOLDER [QUERY ...]``: runs catalogue queries over a folder of tables and prints them;
``--report FILE`` writes them as a Markdown report instead, ``--list`` names the queries."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from .plans import catalog


def markdown(title: str, df: DataFrame, rows: int = 50) -> str:
    """The first rows of a result as a Markdown table."""
    cell = lambda v: f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = [f"## {title}", "", "| " + " | ".join(df.columns) + " |", "|" + " --- |" * len(df.columns)]
    return "\n".join([*lines, *("| " + " | ".join(map(cell, r)) + " |" for r in df.limit(rows).collect())]) + "\n"


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="vellum")
    parser.add_argument("folder", nargs="?")
    parser.add_argument("queries", nargs="*")
    parser.add_argument("--list", action="store_true")
    parser.add_argument("--report")
    args = parser.parse_args(argv)
    if args.list or not args.folder:
        print("\n".join(sorted(catalog.QUERIES)))
        return 0
    spark = SparkSession.builder.getOrCreate()
    chosen = args.queries or ["corpus_scorecard", "placement_summary"]
    if unknown := [q for q in chosen if q not in catalog.QUERIES]:
        parser.error("unknown: " + ", ".join(unknown))
    made = [markdown(q, catalog.QUERIES[q](spark, args.folder)) for q in chosen]
    if args.report:
        Path(args.report).write_text("\n".join(made), encoding="utf-8")
    else:
        print("\n".join(made))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
