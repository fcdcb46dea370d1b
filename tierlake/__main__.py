"""Command line: ``python -m tierlake land|run ...``; see ``--help``."""

from __future__ import annotations

import argparse
import logging
import os

from pyspark.sql import SparkSession

from tierlake.config import azure_settings, load_job, setting
from tierlake.operators.preview import preview
from tierlake.plans.medallion import LAYERS, run
from tierlake.session import builder, mount
from tierlake.sources.layers import read_layer
from tierlake.sources.pages import land_pages

log = logging.getLogger("tierlake")


def _link(text: str) -> tuple[str, str]:
    """``/lake=abfss://...`` as its two parts."""
    folder, equals, uri = text.partition("=")
    if not folder.startswith("/") or not equals or not uri:
        raise argparse.ArgumentTypeError(f"{text!r} is not FOLDER=URI")
    return folder, uri


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tierlake")
    commands = parser.add_subparsers(dest="command", required=True)
    land = commands.add_parser("land", help="fetch the pages of a service")
    land.add_argument("--url", required=True)
    land.add_argument("--per-page", type=int, default=50)
    land.add_argument("--rate", type=float, default=0, help="requests a second the service allows")
    land.add_argument("--retries", type=int, default=3, help="of a page that a busy service refuses")
    layers = commands.add_parser("run", help="refresh layers")
    layers.add_argument("--layers", nargs="+", choices=LAYERS, default=list(LAYERS))
    layers.add_argument("--preview", action="store_true", help="show 20 rows of each layer")
    for command in (land, layers):
        command.add_argument("--job", required=True, help="JSON file with the job settings")
        command.add_argument(
            "--mount", action="append", default=[], type=_link, metavar="FOLDER=URI",
            help="what viewfs://lake/FOLDER in the job file stands for",
        )
    return parser.parse_args(argv)


def _session() -> SparkSession:
    account = setting("AZURE_ACCOUNT_NAME", "")
    key = setting("AZURE_STORAGE_ACCOUNT_KEY", "")
    settings: dict[str, str] = {}
    if account and key:
        settings = {**azure_settings(account, key), **azure_settings(account, key, "abfss")}
    return builder("tierlake", settings).getOrCreate()


def main(argv: list[str] | None = None) -> None:
    arguments = _arguments(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = _session()
    if arguments.mount:
        mount(spark, dict(arguments.mount), "lake")
    job = load_job(arguments.job, os.environ)
    if arguments.command == "land":
        asked = land_pages(
            spark,
            arguments.url,
            job.pages,
            per_page=arguments.per_page,
            swap=job.swap,
            on_bad_page=job.on_bad_page,
            retries=arguments.retries,
            rate=arguments.rate,
        )
        log.info("asked for %d pages, landed at %s", asked, job.pages)
        return
    schemas = {"bronze": job.schema, "silver": job.silver_schema, "gold": job.gold_schema}
    for layer, result in run(spark, job, arguments.layers).items():
        log.info("%s: %d rows at %s", layer, result.rows, result.target)
        if arguments.preview:
            preview(read_layer(spark, result.target, schemas[layer])).show(truncate=False)


if __name__ == "__main__":
    main()
