"""Going on with the staged summary of a run that failed later.

Beside a finished summary lies a manifest of what it was made from: the input
files with their sizes and times of change, and the rules. A run with the same
manifest takes the summary as it is and reads no trip. Once its reports are
published the manifest is removed, so only failed runs are gone on with.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from waybill.rules import Rules
from waybill.sinks.publish import Store, listed_files

#: Changes with the layout of the summary.
LAYOUT = 2
PREFIX = "_trip_summary"
_MANIFEST = "_manifest.json"


def manifest(spark: SparkSession, sources: Mapping[str, DataFrame], rules: Rules) -> dict:
    """What a summary of ``sources``, plain reads of files, depends on."""
    inputs = {
        service: [[path, *state] for path, state in sorted(listed_files(spark, source).items())]
        for service, source in sources.items()
    }
    zone = spark.conf.get("spark.sql.session.timeZone")
    return {"layout": LAYOUT, "inputs": inputs, "rules": asdict(rules), "time_zone": zone}


def _digest(made_from: dict) -> str:
    return hashlib.sha256(json.dumps(made_from, sort_keys=True).encode()).hexdigest()[:24]


def new_summary(staging: str, made_from: dict | None) -> str:
    name = _digest(made_from) if made_from else "any"
    return f"{staging.rstrip('/')}/{PREFIX}-{name}-{uuid.uuid4().hex}"


def finished(spark: SparkSession, path: str, made_from: dict, schema: str) -> None:
    """Note that the summary at ``path`` is whole."""
    text = json.dumps({"made_from": made_from, "schema": schema}, sort_keys=True)
    Store(spark, path).write_text(f"{path}/{_MANIFEST}", text)


def find(spark: SparkSession, staging: str, made_from: dict) -> tuple[str, str] | None:
    """Path and schema of a whole summary made from the same, if there is one."""
    staging = staging.rstrip("/")
    store = Store(spark, staging)
    for name in store.names(staging):
        listed = f"{staging}/{name}/{_MANIFEST}"
        if name.startswith(f"{PREFIX}-{_digest(made_from)}-") and store.exists(listed):
            noted = json.loads(store.read_text(listed))
            if noted["made_from"] == json.loads(json.dumps(made_from)):
                return f"{staging}/{name}", noted["schema"]
    return None


def done(spark: SparkSession, path: str) -> None:
    """The reports are published: later runs read the trips again."""
    Store(spark, path).remove(f"{path}/{_MANIFEST}")
