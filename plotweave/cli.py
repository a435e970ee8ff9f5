"""Command line: ``python -m plotweave.cli --place "City, State"``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from plotweave.config import PipelineConfig, parse_parcel_source, parse_place

SWITCHES = ("overture", "microsoft", "osm", "nsi", "census", "parcels")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="Build enriched structure tables for cities.")
    p.add_argument("--place", action="append", required=True, type=parse_place, help="'City, State'; repeatable")
    p.add_argument("--country", default="USA")
    p.add_argument("--parcel-source", action="append", default=[], type=parse_parcel_source, help="slug=path_or_url; repeatable")
    p.add_argument("--boundary-source", action="append", default=[], type=parse_parcel_source, help="slug=path; repeatable")
    p.add_argument("--no-download", action="store_true", help="use local files only")
    for name in SWITCHES:
        p.add_argument(f"--no-{name}", action="store_true")
    return p


def configure(arguments: Sequence[str] | None = None) -> tuple[list[tuple[str, str]], PipelineConfig]:
    a = parser().parse_args(arguments)
    config = PipelineConfig(
        country=a.country, download_missing=not a.no_download, parcel_sources=dict(a.parcel_source), boundary_sources=dict(a.boundary_source),
        **{f"use_{name}": not getattr(a, f"no_{name}") for name in SWITCHES},
    )
    return a.place, config


def main(arguments: Sequence[str] | None = None) -> None:
    from plotweave.plans.pipeline import Connectors, build_many_cities

    places, config = configure(arguments)
    spark = SparkSession.builder.getOrCreate()
    build_many_cities(spark, places, config, Connectors.public(spark))


if __name__ == "__main__":
    main()
