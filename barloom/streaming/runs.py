"""Telling micro-batches of different runs apart."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The identity a stream keeps for as long as its checkpoint: a new checkpoint is a new run."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def batch_mark(spark: SparkSession, checkpoint: str, batch_id: int) -> str:
    """Names one micro-batch of one run; a repeat of the batch has the same name."""
    return f"{run_id(spark, checkpoint)}-{batch_id}"
