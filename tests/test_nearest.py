import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reachgrid.operators import smallest
from reachgrid.operators.analyses import redundanz_analyse
from reachgrid.operators.nearest import (
    cell_table,
    cell_units,
    grid_cell_data,
    minimum_times,
    nearest_hospitals,
    nearest_times,
    nearest_times_compared,
)
from reachgrid.operators.smallest import two_nearest
from reachgrid.schema import LAYOUT_COMBINED, LAYOUT_SPLIT

FACT = "Gitterzellen_ID string, Krankenhaus_Standortnummer string, Fahrzeit_Sekunden int"


def hospitals(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "Krankenhaus_Standortnummer string")


def fact(spark, data):
    return spark.createDataFrame(data, FACT)


def as_counter(df):
    return Counter(
        (r.Gitterzellen_ID, r.Krankenhaus_Standortnummer, r.Fahrzeit_Sekunden)
        for r in df.collect()
    )


def brute_force(data, chosen):
    kept = [r for r in data for c in chosen if r[1] == c]
    result = Counter()
    for row in kept:
        times = [r[2] for r in kept if r[0] == row[0] and r[2] is not None]
        if row[0] is not None and row[2] is not None and row[2] == min(times):
            result[row] += 1
    return result


def test_ties_survive_and_unknown_times_do_not(spark):
    data = [("1", "a", 60), ("1", "b", 60), ("1", "c", 90), ("2", "a", None), ("3", "z", 1)]
    df = nearest_hospitals(fact(spark, data), hospitals(spark, "a", "b", "c"))
    assert as_counter(df) == {("1", "a", 60): 1, ("1", "b", 60): 1}


def test_a_hospital_listed_twice_counts_twice(spark):
    data = [("1", "a", 60), ("1", "b", 90)]
    listed = hospitals(spark, "a", "a", "b")
    assert as_counter(nearest_hospitals(fact(spark, data), listed)) == {("1", "a", 60): 2}
    row = nearest_times(fact(spark, data), listed).collect()[0]
    assert row.Anzahl_Naechste == 2


def test_one_hospital_per_cell_on_request(spark):
    data = [("1", "b", 60), ("1", "a", 60), ("2", "a", None), ("2", "b", 30)]
    df = nearest_hospitals(fact(spark, data), hospitals(spark, "a", "b"), ties="one")
    assert as_counter(df) == {("1", "a", 60): 1, ("2", "b", 30): 1}
    with pytest.raises(ValueError, match="ties"):
        nearest_hospitals(fact(spark, data), hospitals(spark, "a"), ties="some")


def test_either_way_the_same_cells_are_reached(spark):
    data = [("1", "a", 60), ("1", "b", 60), ("2", "a", None), ("3", "b", 5)]
    found = {
        ties: {
            r.Gitterzellen_ID
            for r in nearest_hospitals(fact(spark, data), hospitals(spark, "a", "b"), ties).collect()
        }
        for ties in ("all", "one")
    }
    assert found["one"] == found["all"] == {"1", "3"}


def plan_of(df) -> str:
    """The physical plan as it is before anything has run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return text[text.rindex("Initial Plan") :] if "Initial Plan" in text else text


@pytest.fixture
def stored_times(spark, tmp_path):
    data = [(str(i % 40), f"h{i % 7}", i % 11) for i in range(400)]
    fact(spark, data).write.parquet(f"{tmp_path}/times")
    return spark.read.parquet(f"{tmp_path}/times")


@pytest.mark.parametrize("limit", ["-1", "10485760"])
def test_times_are_read_once_and_shuffled_by_cell_once(spark, stored_times, limit):
    """One scan, and what is shuffled are states: the hospitals join before."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    listed = hospitals(spark, "h1", "h2", "h2")
    try:
        plans = {
            "hospitals": plan_of(nearest_hospitals(stored_times, listed)),
            "times": plan_of(nearest_times(stored_times, listed)),
            "compared": plan_of(
                nearest_times_compared(stored_times, listed, hospitals(spark, "h3"))
            ),
            "redundancy": plan_of(redundanz_analyse(stored_times, 3)),
            "two": plan_of(two_nearest(stored_times)),
        }
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for name, plan in plans.items():
        lines = plan.splitlines()
        assert sum("FileScan" in line for line in lines) == 1, name
        by_cell = [line for line in lines if "hashpartitioning(Gitterzellen_ID" in line]
        # the second one deals out the chunks of counted rows
        assert len(by_cell) <= 2 and sum("_chunk" not in line for line in by_cell) <= 1, plan
        state = next(i for i, line in enumerate(lines) if "MapInArrow" in line)
        assert not any("Join" in line for line in lines[:state]), name
        if name in ("hospitals", "times", "compared"):
            assert any("Join" in line for line in lines[state:]), name


def test_states_are_the_same_however_often_they_are_merged(spark, monkeypatch):
    """Tasks that reduce after a few rows, and hand states on early."""
    random.seed(8)
    data = [
        (random.choice([None, "a", "b", "c"]), random.choice([None, "x", "y", "z"]),
         random.choice([None, *range(6)]))
        for _ in range(500)
    ]
    known = [r for r in data if r[2] is not None]
    for n in (1, 2, 3, 9):
        expected = Counter(
            r for r in known if sum(o[0] == r[0] and o[2] < r[2] for o in known) < n
        )
        for read, held in ((500_000, 2_000_000), (7, 9)):
            monkeypatch.setattr(smallest, "READ_ROWS", read)
            monkeypatch.setattr(smallest, "HELD_ROWS", held)
            found = smallest.smallest_times(fact(spark, data).repartition(3), n).collect()
            got = {tuple(r[:3]): r[3] for r in found}
            assert got == expected and len(found) == len(got)


def test_rows_that_a_task_reduces_at_once_are_few(spark):
    """However many cells there are, none of which can be left out."""
    df, reduced_rows = fact(spark, []).select("Gitterzellen_ID"), []

    class Rows:
        schema = df.schema

        def mapInArrow(self, parts, schema):
            return parts

    def reduce(table):
        reduced_rows.append(len(table))
        return table

    batch = pa.RecordBatch.from_arrays([pa.array(["c"] * 10_000)], ["Gitterzellen_ID"])
    found = smallest.reduced(Rows(), reduce)(iter([batch] * 300))
    assert sum(b.num_rows for b in found) == 3_000_000
    assert max(reduced_rows) <= 600_000


def test_two_nearest_hospitals_of_every_cell(spark, monkeypatch):
    random.seed(9)
    data = [
        (f"c{random.randint(0, 60)}", random.choice([None, "x", "y", "z"]),
         random.choice([None, 1, 2, 3]))
        for _ in range(300)
    ]
    data += [("copies", "x", 4)] * 200 + [("copies", "y", 9), ("alone", "x", 1), ("none", "x", None)]
    monkeypatch.setattr(smallest, "READ_ROWS", 50)
    order = lambda r: (r[2] is None, r[2] or 0, r[1] is not None, r[1] or "")
    for r in two_nearest(fact(spark, data).repartition(4)).collect():
        own = [d for d in data if d[0] == r.Gitterzellen_ID]
        first = min(own, key=order)
        others = [d[2] for d in own if d[1] != first[1] and d[2] is not None]
        assert (r[1], r[2]) == first[1:]
        assert r.Naechste_Sekunden == (min(others) if others else None)
    assert two_nearest(fact(spark, [])).count() == 0


def test_minimum_of_unknown_times_is_unknown(spark):
    df = minimum_times(fact(spark, [("1", "a", None), ("2", "a", 5), ("2", "b", 4)]))
    assert {r[0]: r[1] for r in df.collect()} == {"1": None, "2": 4}


def test_against_brute_force_with_a_heavy_cell_and_copies(spark):
    """A third of the rows is one cell, another third one row repeated."""
    random.seed(3)
    names = [f"h{i}" for i in range(12)]
    data = [("heavy", random.choice(names), random.randint(50, 60)) for _ in range(200)]
    data += [("copies", "h1", 30)] * 200
    data += [
        (f"c{random.randint(0, 30)}", random.choice(names),
         random.choice([None, *range(10)]))
        for _ in range(200)
    ]
    chosen = names[:8] + ["h1"]
    expected = brute_force(data, chosen)
    table, listed = fact(spark, data), hospitals(spark, *chosen)
    assert as_counter(nearest_hospitals(table, listed)) == expected
    counts = Counter()
    for (cell, _, seconds), n in expected.items():
        counts[cell, seconds] += n
    found = {
        (r.Gitterzellen_ID, r.Fahrzeit_Sekunden): r.Anzahl_Naechste
        for r in nearest_times(table, listed).collect()
    }
    assert found == counts


def test_order_of_rows_does_not_matter(spark):
    data = [(str(i % 5), f"h{i % 3}", i % 4) for i in range(40)]
    listed = hospitals(spark, "h0", "h1")
    forward = as_counter(nearest_hospitals(fact(spark, data), listed))
    assert forward == as_counter(nearest_hospitals(fact(spark, data[::-1]), listed))


def cells(spark):
    return spark.createDataFrame(
        [("1", "m1", 10), ("2", "m9", None)],
        "Gitterzellen_ID string, Gemeindeschluessel string, Einwohner long",
    )


def units(spark):
    return spark.createDataFrame(
        [("m1", "Ort", "L")],
        "Gemeindeschluessel string, Gemeindename string, Bundesland string",
    )


def test_layouts(spark):
    combined = cells(spark)
    assert cell_table(LAYOUT_COMBINED, combined).count() == 2
    split = cell_table(
        LAYOUT_SPLIT,
        municipality=combined.select("Gitterzellen_ID", "Gemeindeschluessel"),
        people=combined.filter(F.col("Gitterzellen_ID") == "1").select(
            "Gitterzellen_ID", "Einwohner"
        ),
    )
    assert {r[0]: r.Einwohner for r in split.collect()} == {"1": 10, "2": None}
    with pytest.raises(ValueError, match="gitterzellen_layout"):
        cell_table("other", combined)


def test_grid_cells_keep_rows_without_mapping(spark):
    near = nearest_hospitals(
        fact(spark, [("1", "a", 5), ("2", "a", 6), ("3", "a", 7)]), hospitals(spark, "a")
    )
    found = {
        r.Gitterzellen_ID: (r.Einwohner, r.Gemeindeschluessel, r.Gemeindename)
        for r in grid_cell_data(near, cells(spark), units(spark)).collect()
    }
    assert found == {
        "1": (10, "m1", "Ort"),
        "2": (None, "m9", None),
        "3": (None, None, None),
    }
    assert cell_units(cells(spark), units(spark)).count() == 2
