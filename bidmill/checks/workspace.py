"""Files that registered queries write and read back."""

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

from bidmill.plans.store import Store, build_store
from bidmill.sources.tables import ad_events


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names for checkpoints; a temporary one only on a local master."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder()


def new_folder(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/bidmill-{what}-{uuid.uuid4().hex}"


def store(spark: SparkSession, sf_dir: str) -> Store:
    """The store of a test-data folder, built on first use."""
    return Store(spark, _store_path(spark, sf_dir))


@cache
def _store_path(spark: SparkSession, sf_dir: str) -> str:
    path = new_folder(spark, "store")
    build_store(ad_events(spark, sf_dir, spread=True), path)
    return path


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="bidmill-")
