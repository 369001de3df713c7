"""Agent registry: small YAML files (flat keys and one level of nesting) or the agents table."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def parse_flat_yaml(text: str) -> dict:
    """Keys, scalars and one nested level: what agent files use."""
    out: dict = {}
    inner = None
    for line in text.splitlines():
        bare = line.split(" #")[0].rstrip()
        if not bare or bare.lstrip().startswith("#") or ":" not in bare:
            continue
        name, _, value = bare.strip().partition(":")
        value = value.strip().strip("'\"")
        if bare[0] in " \t" and inner is not None:
            inner[name] = value
        elif value:
            out[name], inner = value, None
        else:
            inner = out[name] = {}
    return out


def read_agents(spark: SparkSession, folder: str) -> DataFrame:
    """(agent_id, display_name, route, raw_folder, collection_name, config) of the *.yaml files of a folder, by agent_id."""
    rows = {}
    for path in sorted(Path(folder).glob("*.yaml")):
        config = parse_flat_yaml(path.read_text())
        ui = config.get("ui") if isinstance(config.get("ui"), dict) else {}
        name = config.get("agent_id") or path.stem
        rows[name] = (name, config.get("display_name"), ui.get("route"), config.get("raw_folder"), config.get("collection_name"), json.dumps(config))
    return spark.createDataFrame(list(rows.values()), "agent_id string, display_name string, route string, raw_folder string, collection_name string, config string")
