"""Folders for files that an operator writes and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from ..sources import store


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new path in the application's part of the shared folder."""
    return f"{store.application_folder(spark)}/{kind}-{uuid.uuid4().hex}"
