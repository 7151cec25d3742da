from __future__ import annotations

import random

import pytest

from stoptide.operators.changes import (
    changed_since_previous,
    cycle_counters,
    number_cycles,
)
from stoptide.streaming.changes import filter_changes
from tests.conftest import rows

SCHEMA = "key STRING, cycle INT, position BIGINT, digest STRING"


def frame(spark, data):
    return spark.createDataFrame([(k, c, i, d) for i, (k, c, d) in enumerate(data)], SCHEMA)


def expected(data):
    """State of the previous cycle only; rows of one key share the last digest."""
    seen, out = {}, []
    numbered = [(k, c, i, d) for i, (k, c, d) in enumerate(data)]
    for cycle in range(min(c for _, c, _ in data), max(c for _, c, _ in data) + 1):
        now = [r for r in numbered if r[1] == cycle]
        current = {k: d for k, _, _, d in now}
        out += [r for r in now if seen.get(r[0]) != current[r[0]]]
        seen = current
    return sorted(out, key=repr)


def test_first_cycle_emits_all_the_same_again_nothing_one_change_only_it(spark):
    data = [("a", 1, "x"), ("b", 1, "y"), ("a", 2, "x"), ("b", 2, "y"), ("a", 3, "x"),
            ("b", 3, "z")]
    got = rows(changed_since_previous(frame(spark, data)), "key", "cycle")
    assert got == [("a", 1), ("b", 1), ("b", 3)]


def test_state_is_replaced_not_merged(spark):
    data = [("a", 1, "x"), ("b", 1, "y"), ("a", 2, "x"), ("a", 3, "x"), ("b", 3, "y")]
    got = rows(changed_since_previous(frame(spark, data)), "key", "cycle")
    assert got == [("a", 1), ("b", 1), ("b", 3)]


def test_rows_of_one_key_share_the_last_digest(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "x"), ("a", 3, "y"), ("a", 3, "z")]
    assert rows(changed_since_previous(frame(spark, data)), "cycle") == [(1,), (3,), (3,)]


def test_against_brute_force_with_a_dominating_key(spark):
    rng = random.Random(7)
    data = []
    for cycle in range(12):
        for _ in range(60):
            key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(15)}"
            data.append((key, cycle, f"d{rng.randrange(2)}"))
    got = rows(changed_since_previous(frame(spark, data)), "key", "cycle", "position", "digest")
    assert got == expected(data)


def test_failed_polls_do_not_count_and_empty_ones_do(spark):
    polls = spark.createDataFrame(
        [(1, True), (2, False), (3, True), (7, True)], "poll INT, ok BOOLEAN")
    assert rows(number_cycles(polls)) == [(1, 1), (3, 2), (7, 3)]


def test_empty_cycle_clears_the_state(spark):
    # Poll 2 fails: poll 3 is compared with poll 1. Poll 4 is empty: poll 5 starts anew.
    polls = spark.createDataFrame(
        [(1, True), (2, False), (3, True), (4, True), (5, True)], "poll INT, ok BOOLEAN")
    found = spark.createDataFrame(
        [("a", 1, 0, "x"), ("a", 3, 1, "x"), ("a", 5, 2, "x")],
        "key STRING, poll INT, position BIGINT, digest STRING").join(number_cycles(polls), "poll")
    assert rows(changed_since_previous(found), "poll") == [(1,), (5,)]


def test_counters(spark):
    data = frame(spark, [("a", 1, "x"), ("b", 1, "y"), ("a", 2, "x"), ("b", 2, "z")])
    got = rows(cycle_counters(data, changed_since_previous(data)))
    assert got == [(1, 2, 2, 0), (2, 2, 1, 1)]


def drain(spark, tmp_path, parts, cycles, max_files=None):
    """Deliver `parts` one after the other, each as a run of its own on the same checkpoint."""
    source, table = str(tmp_path / "in"), str(tmp_path / "cycles")
    spark.createDataFrame(cycles, "cycle INT, rows LONG").write.parquet(table)
    for number, part in enumerate(parts):
        spark.createDataFrame(part, SCHEMA).repartition(max(1, len(part)) if max_files else 1) \
            .write.parquet(f"{source}/part={number}")
        reader = spark.readStream.schema(SCHEMA + ", part INT")
        if max_files:
            reader = reader.option("maxFilesPerTrigger", str(max_files))
        filter_changes(reader.parquet(source).drop("part"), table, str(tmp_path / "out"),
                       str(tmp_path / "state"), str(tmp_path / "checkpoint"))
    return rows(spark.read.parquet(str(tmp_path / "out")), "key", "cycle", "position", "digest")


def numbered(data):
    return [(k, c, i, d) for i, (k, c, d) in enumerate(data)]


def sizes(data):
    return [(c, sum(1 for _, x, _ in data if x == c))
            for c in range(min(c for _, c, _ in data), max(c for _, c, _ in data) + 1)]


# One key with several rows in a cycle, keys that come and go, an empty cycle.
REPEATED = [("p", 1, "m"), ("q", 1, "m"), ("p", 2, "n"), ("p", 2, "m"), ("q", 2, "m"),
            ("q", 4, "m"), ("q", 5, "k"), ("q", 5, "m"), ("p", 5, "m"), ("p", 6, "m"),
            ("p", 6, "n")]


@pytest.mark.parametrize("seed", [None, 1, 2, 3])
def test_any_cut_gives_the_batch_result(spark, tmp_path, seed):
    """As they come, or shuffled and cut at random places."""
    data = numbered(REPEATED)
    parts = [data]
    if seed is not None:
        rng = random.Random(seed)
        rng.shuffle(data)
        cut = sorted(rng.sample(range(1, len(data)), 3))
        parts = [data[a:b] for a, b in zip([0, *cut], [*cut, len(data)], strict=True)]
    got = drain(spark, tmp_path, parts, sizes(REPEATED))
    assert got == expected(REPEATED)


def test_one_row_per_file_and_one_file_per_batch(spark, tmp_path):
    data = numbered(REPEATED)
    got = drain(spark, tmp_path, [data[::-1]], sizes(REPEATED), max_files=1)
    assert got == expected(REPEATED)


def test_rows_of_an_open_cycle_wait(spark, tmp_path):
    data = numbered(REPEATED)
    got = drain(spark, tmp_path, [data], [(c, n) for c, n in sizes(REPEATED) if c != 4])
    assert got == expected([r for r in REPEATED if r[1] < 4][:5])


def test_surplus_rows_are_set_aside(spark, tmp_path):
    data = numbered(REPEATED)
    extra = [("p", 1, 99, "late")]
    got = drain(spark, tmp_path, [data, extra], sizes(REPEATED))
    assert got == expected(REPEATED)
    aside = spark.read.parquet(str(tmp_path / "state" / "surplus"))
    assert rows(aside, "position") == [(99,)]
