"""Ad-event rollups and declarative queries on Spark DataFrames."""

from bidmill.operators.rollups import BASES, ROLLUPS, Rollup, rollup
from bidmill.operators.spec import Spec, run_spec
from bidmill.plans.answer import answer, answer_from_rollup, covering_tables, rollup_covers
from bidmill.plans.batch import format_times, run_batch, write_result
from bidmill.plans.store import (
    Store,
    build_store,
    prepare,
    read_manifest,
    read_rollup,
    write_manifest,
    write_rollups,
)
from bidmill.sources.csv_events import clean_events, read_raw_events
from bidmill.sources.layout import read_by_type, write_by_type
from bidmill.sources.tables import ad_events, raw_ad_events

__all__ = [
    "BASES", "ROLLUPS", "Rollup", "Spec", "Store", "ad_events", "answer", "answer_from_rollup",
    "build_store", "clean_events", "covering_tables", "format_times", "prepare", "raw_ad_events",
    "read_by_type", "read_manifest", "read_raw_events", "read_rollup", "rollup", "rollup_covers",
    "run_batch", "run_spec", "write_by_type", "write_manifest", "write_result", "write_rollups",
]
