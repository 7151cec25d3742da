"""The poll job: stored change documents to emitted observations, with a report per cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.changes import changed_since_previous, cycle_counters, cycle_state, merge_state
from ..session import scratch_dir
from ..sources import versions
from ..sources.documents import change_stops
from ..sources.sinks import write_jsonl_run
from . import ingest


def cycle_report(documents: DataFrame, plan: DataFrame, rows: DataFrame,
                 emitted: DataFrame) -> DataFrame:
    """One row per cycle: stations polled and failed; stops changed, identified, unidentified
    and in scope; rows seen, written and suppressed."""
    parts = [
        ingest.poll_counters(change_stops(documents), plan, "cycle"),
        cycle_counters(rows, emitted),
    ]
    report = ingest.poll_outcomes(documents, "cycle")
    for part in parts:
        report = report.join(part, "cycle", "left")
    return report.fillna(0)


def _stored(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _newest_cycle(state: DataFrame | None) -> int | None:
    return None if state is None else state.agg(F.max("cycle")).first()[0]


def run(documents: DataFrame, plan: DataFrame, out: str,
        earlier: DataFrame | None = None, *, only_long_distance: bool = True
        ) -> tuple[DataFrame, DataFrame]:
    """(report, state) of the whole cycles in `documents`; emits what changed to `out`.

    `documents` carries document, station_eva, station_name, observed_at and cycle; `plan` has
    one row per stop id; `earlier` is the state an earlier run returned. What differs from the
    previous cycle is written to `out/run=<n>` as JSON lines, one folder per day. `n` is the
    cycle after that of the state: a run that is repeated from the same state, after a crash or
    by mistake, replaces its own lines. Rows, emitted rows and state are stored once in the
    shared folder, as several steps read them.
    """
    rows = _stored(ingest.poll_rows(documents, plan, only_long_distance=only_long_distance),
                   "polled")
    emitted = _stored(changed_since_previous(rows, earlier), "emitted")
    last = _newest_cycle(earlier)
    write_jsonl_run(emitted.select(*[f.name for f in S.PAYLOAD]), out,
                    0 if last is None else last + 1)
    known = merge_state(cycle_state(rows), earlier).drop("current")
    newest = known.agg(F.max("cycle")).scalar()
    state = _stored(known.filter(F.col("cycle") == newest), "state")
    return cycle_report(documents, plan, rows, emitted), state


def advance(documents: DataFrame, plan: DataFrame, root: str, *,
            only_long_distance: bool = True) -> int | None:
    """Take the cycles of `documents` that `root` does not know yet; its new number.

    `root` is a versioned set (`sources.versions`) of `state` and `report`, with the emitted
    lines in `root/lines`. State and report are published together after the lines are written.
    A run that breaks off before that leaves the state as it was, and the next one from there
    writes the same lines in the same place. Documents that were taken before are passed over:
    if there are no others, nothing is written and the result is None.
    """
    spark = documents.sparkSession
    draft = versions.Draft(spark, root)
    earlier, before = draft.read("state"), draft.read("report")
    last = None if before is None else before.agg(F.max("cycle")).first()[0]
    fresh = documents if last is None else documents.filter(F.col("cycle") > last)
    if fresh.isEmpty():
        return None
    report, state = run(fresh, plan, f"{root}/lines", earlier,
                        only_long_distance=only_long_distance)
    draft.replace("state", state)
    draft.replace("report", report if before is None else before.unionByName(report))
    return draft.publish()
