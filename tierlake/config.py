"""Job settings from a JSON file and the environment; no credentials in either code or file."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping

from pyspark.sql import types as T

from tierlake.plans.medallion import Medallion


def setting(name: str, default: str, environ: Mapping[str, str] = os.environ) -> str:
    """An environment variable; one that is set but empty counts as not set."""
    return environ.get(name) or default


def azure_settings(account: str, key: str, scheme: str = "wasbs") -> dict[str, str]:
    """The session setting that lets Spark into an Azure storage account."""
    host = "blob" if scheme.startswith("wasb") else "dfs"
    return {f"spark.hadoop.fs.azure.account.key.{account}.{host}.core.windows.net": key}


def load_job(path: str, environ: Mapping[str, str] = os.environ) -> Medallion:
    """A ``Medallion`` from a JSON file; ``${NAME}`` in its texts is an environment variable.

    Needs a running session: Spark reads the schema text.
    """
    with open(path, encoding="utf-8") as file:
        values = _filled(json.load(file), environ)
    values["schema"] = T.StructType.fromDDL(values["schema"])
    return Medallion(**values)


def _filled(value, environ: Mapping[str, str]):
    if isinstance(value, str):
        for name, text in environ.items():
            if text:
                value = value.replace("${" + name + "}", text)
        if "${" in value:
            raise KeyError(f"unset environment variable in {value!r}")
        return value
    if isinstance(value, list):
        return [_filled(item, environ) for item in value]
    if isinstance(value, dict):
        return {key: _filled(item, environ) for key, item in value.items()}
    return value
