"""Stage receipts: what a stage read, its parameters and the hashes of what it wrote."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import SparkSession

from tidegrid.config import ContractError, canonical_json, digest
from tidegrid.sources.catalog import contained, file_hashes
from tidegrid.sources.sinks import read_text, write_text


def _hashes(spark: SparkSession, folder: str, outputs: list[str]) -> dict:
    found = file_hashes(spark, [contained(folder, o) for o in outputs]).collect()
    root = folder.rstrip("/").removeprefix("file://") + "/"
    return dict(sorted((r["path"].split(root, 1)[-1], [r["bytes"], r["sha256"]]) for r in found))


def write_receipt(spark: SparkSession, folder: str, stage: str, *, inputs: Mapping, parameters: Mapping, outputs: list[str], validation: Mapping) -> dict:
    """Hash the outputs (files or folders below ``folder``) and write ``stage.json``; an incomplete stage gets none."""
    if validation.get("complete") is not True:
        raise ContractError("a receipt needs a complete stage")
    body = {"stage": stage, "inputs": dict(inputs), "parameters": dict(parameters), "outputs": _hashes(spark, folder, outputs), "listed": sorted(outputs), "validation": dict(validation)}
    receipt = body | {"identity": digest(body)}
    write_text(spark, f"{folder.rstrip('/')}/stage.json", canonical_json(receipt))
    return receipt


def verify_receipt(spark: SparkSession, folder: str) -> dict:
    """The receipt, if it is whole and its outputs are unchanged."""
    receipt = json.loads(read_text(spark, f"{folder.rstrip('/')}/stage.json"))
    body = {k: v for k, v in receipt.items() if k != "identity"}
    if digest(body) != receipt.get("identity") or _hashes(spark, folder, body["listed"]) != body["outputs"]:
        raise ContractError("a stage or its outputs were changed")
    return receipt
