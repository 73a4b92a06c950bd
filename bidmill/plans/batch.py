"""Result files, and batches of specs."""

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from bidmill.functions.measures import first_partials, merged_partials
from bidmill.functions.timekeys import SPAN_DAYS, as_text, with_time_keys
from bidmill.operators.predicates import all_of
from bidmill.operators.rollups import BY_NAME
from bidmill.operators.spec import Spec
from bidmill.plans.answer import answer, source_for
from bidmill.plans.shared import result_of, shareable, shared_partials
from bidmill.plans.store import Store
from bidmill.sources.layout import write_once

_AT_ONCE = 8

_RECORD = "query int, rows bigint, status string, error string"


def format_times(result: DataFrame) -> DataFrame:
    """Time keys as text: ``2024-01-31`` for day, week, month; ``2024-01-31 09:30`` for minute."""
    texts = {
        name: F.expr(as_text(name))
        for name, kind in result.dtypes
        if name in SPAN_DAYS and kind == "timestamp_ntz"
    }
    return result.withColumns(texts) if texts else result


def write_result(result: DataFrame, path: str) -> int:
    """Write a result as CSV with a header, in its order; returns its row count."""
    seen = Observation()
    counted = format_times(result).observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("header", True).csv(path)
    return seen.get["rows"]


def run_batch(store: Store, specs: Iterable[dict], out_dir: str) -> DataFrame:
    """Answer each spec into ``out_dir/q1``, ``q2``, ...; returns (and writes) one record each.

    Specs that are answered from the same table, or from the events, share one scan of it, as far
    as their measures are kept by partial rows. A spec that fails is recorded with its error
    and does not stop the others.
    """
    numbered = dict(enumerate(specs, 1))
    shared = _shared(store, numbered, f"{out_dir}/shared")

    def run(number: int) -> tuple:
        try:
            if number in shared:
                result = result_of(shared[number], number, Spec.of(numbered[number]))
            else:
                result = answer(store, numbered[number])
            rows = write_result(result, f"{out_dir}/q{number}")
        except Exception as error:  # noqa: BLE001 - whatever went wrong belongs to this spec
            return number, None, "failed", f"{type(error).__name__}: {error}"
        return number, rows, "success", None

    # Specs run a few at a time, so that small ones share the cluster.
    with ThreadPoolExecutor(_AT_ONCE) as pool:
        records = list(pool.map(run, numbered))
    result = store.spark.createDataFrame(records, _RECORD)
    result.coalesce(1).write.mode("overwrite").json(f"{out_dir}/records")
    return result


def shared_sources(store: Store, specs: dict[int, dict]) -> dict[str | None, dict[int, Spec]]:
    """The specs that share a scan, by the stored table (None: the events) that answers them."""
    out: dict[str | None, dict[int, Spec]] = {}
    for number, given in specs.items():
        try:
            spec = Spec.of(given)
            name = source_for(store, spec)
            source = store.events() if name is None else store.partials(name)
            with_keys = with_time_keys(source, sorted(spec.columns))
            all_of(with_keys.schema, spec.where)  # raises if it cannot be meant
            if not set(spec.group_by) <= set(with_keys.columns):
                continue
        except Exception:  # noqa: BLE001 - the spec fails on its own, with its own record
            continue
        if name is not None and BY_NAME[name].type is not None:  # it holds no other type
            spec = spec.without_conditions_on("type")
        if shareable(spec):
            out.setdefault(name, {})[number] = spec
    return {name: some for name, some in out.items() if len(some) > 1}


def _shared(store: Store, specs: dict[int, dict], path: str) -> dict[int, DataFrame]:
    """For each spec that shares a scan, the written partial rows that hold its own."""
    sources = shared_sources(store, specs)

    def scan(name: str | None) -> dict[int, DataFrame]:
        rows = store.events() if name is None else store.partials(name)
        measures = first_partials(rows.schema) if name is None else merged_partials()
        try:
            found = shared_partials(rows, sources[name], measures)
            written, _ = write_once(found, f"{path}/{name or 'events'}")
        except Exception:  # noqa: BLE001 - then each of them runs, and fails, on its own
            return {}
        return dict.fromkeys(sources[name], written)

    with ThreadPoolExecutor(_AT_ONCE) as pool:
        return {number: rows for part in pool.map(scan, sources) for number, rows in part.items()}
