"""Change sets, totals kept by them, and numbers in a global order."""

import math
import random
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from siltstone.operators.merge import CHANGE, apply_changes, change_set, merge_rows
from siltstone.operators.ordering import with_positions
from siltstone.operators.rollup import rollup_measure
from siltstone.operators.running import signed_totals, state_totals, totals_state, touched_state, updated_state
from siltstone.sinks.tables import upsert_table, upsert_with_changes

FACT = "id long, part string, at int, g string, h int, v double"
KEYS = ["g", "h"]


def _facts(chosen, count, odd=()):
    values = [0.1, 2.675, -3.0, 1e6, None, *odd]
    return [
        (
            chosen.choice([None, *range(40)]), chosen.choice("pq"), chosen.randint(0, 5), chosen.choice(["a", "b", None]),
            chosen.choice([1, 2, None]), chosen.choice(values),
        )
        for _ in range(count)
    ]


def _one_per_key(rows):
    return list({r[0]: r for r in rows}.values())


def _bag(df):
    norm = lambda v: "nan" if isinstance(v, float) and math.isnan(v) else v
    return Counter(tuple(norm(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("options", [{}, {"only_if_newer": True}, {"delete_when": "h = 1"}])
def test_change_sets_do_what_merging_does(spark, options):
    chosen = random.Random(len(options))
    target = spark.createDataFrame(_one_per_key(_facts(chosen, 60)), FACT)
    source = spark.createDataFrame(_facts(chosen, 30), FACT)
    options = {k: F.expr(v) if k == "delete_when" else v for k, v in options.items()}
    changes = change_set(target, source, ["id"], "at", **options)
    merged = merge_rows(target, source, ["id"], "at", **options)
    assert _bag(apply_changes(target, changes, ["id"])) == _bag(merged)
    # what the set adds and takes away is the difference of the contents
    signed = Counter()
    for row in changes.collect():
        signed[tuple(row)[:-1]] += row[CHANGE]
    difference = Counter(_bag(merged))
    difference.subtract(_bag(target))
    assert {k: n for k, n in signed.items() if n} == {k: n for k, n in difference.items() if n}


@pytest.mark.parametrize("odd", [(), (float("nan"), float("inf"), 1e30, 1e-15)])
@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_running_totals_equal_full_ones(spark, conf, odd, broadcast):
    conf(**{"spark.sql.autoBroadcastJoinThreshold": broadcast})
    chosen = random.Random(7)
    facts = spark.createDataFrame(_one_per_key(_facts(chosen, 60, odd)), FACT)
    state = totals_state(facts, KEYS, "v")
    for _ in range(3):
        source = spark.createDataFrame(_facts(chosen, 25, odd), FACT)
        condition = F.col("at") == 0
        changes = change_set(facts, source, ["id"], "at", delete_when=condition)
        delta = signed_totals(changes, KEYS, "v")
        facts = spark.createDataFrame(merge_rows(facts, source, ["id"], "at", delete_when=condition).collect(), FACT)
        state = spark.createDataFrame(updated_state(state, delta, KEYS).collect(), state.schema)
        assert _bag(state) == _bag(totals_state(facts, KEYS, "v"))
        assert _bag(state_totals(state, KEYS, "v", facts)) == _bag(rollup_measure(facts, KEYS, "v"))


def test_a_group_goes_with_its_last_row_and_exact_sums_leave_nothing(spark):
    facts = spark.createDataFrame([(1, "p", 0, "a", 1, 0.1), (2, "p", 0, "a", 1, 0.2), (3, "p", 0, "b", 1, 0.3)], FACT)
    state = totals_state(facts, KEYS, "v")
    leaving = facts.where("g = 'a'").withColumn(CHANGE, F.lit(-1))
    delta = signed_totals(leaving, KEYS, "v")
    (touched,) = touched_state(state, delta, KEYS).collect()
    assert (touched.rows, touched.measured, touched.exact_sum) == (0, 0, 0)
    assert [r.g for r in updated_state(state, delta, KEYS).collect()] == ["b"]


@pytest.mark.parametrize("kind", ["decimal(12,2)", "int", "float"])
def test_running_totals_of_other_types(spark, kind):
    facts = spark.createDataFrame([("a", "1.25"), ("a", "2.5"), ("b", None)], "g string, v string").withColumn("v", F.col("v").cast("double").cast(kind))
    found = state_totals(totals_state(facts, ["g"], "v"), ["g"], "v", facts)
    assert _bag(found) == _bag(rollup_measure(facts, ["g"], "v"))


def test_an_empty_state(spark):
    none = spark.createDataFrame([], FACT)
    state = totals_state(none, KEYS, "v")
    assert state.collect() == []
    assert updated_state(state, signed_totals(none.withColumn(CHANGE, F.lit(1)), KEYS, "v"), KEYS).collect() == []


@pytest.fixture
def new_table(spark):
    made = []

    def make(partitioned):
        name = f"running_{uuid.uuid4().hex}"
        by = "PARTITIONED BY (part)" if partitioned else ""
        spark.sql(f"CREATE TABLE {name} ({FACT.replace(',', ',')}) USING parquet {by}")
        made.append(name)
        return name

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


@pytest.mark.parametrize("partitioned", [False, True])
def test_upserts_hand_out_their_changes(spark, new_table, partitioned):
    chosen = random.Random(3)
    one, two = new_table(partitioned), new_table(partitioned)
    order = [c.split()[0] for c in FACT.split(", ")]
    for _ in range(2):
        rows = spark.createDataFrame(_facts(chosen, 40), FACT)
        before = _bag(spark.table(two).select(*order))
        upsert_table(rows, one, ["id"], "at", delete_when="h = 2")
        with upsert_with_changes(rows, two, ["id"], "at", delete_when="h = 2") as (_, changes):
            handed = changes.select(*order, CHANGE).collect()
        after = _bag(spark.table(two).select(*order))
        assert after == _bag(spark.table(one).select(*order))
        for row in handed:
            before[tuple(row)[:-1]] += row[CHANGE]
        assert +before == after


@pytest.mark.parametrize("partitioned", [False, True])
def test_a_batch_without_rows_changes_nothing(spark, new_table, partitioned):
    table = new_table(partitioned)
    upsert_table(spark.createDataFrame([(1, "p", 0, "a", 1, 0.1)], FACT), table, ["id"], "at")
    files = spark.table(table).inputFiles()
    with upsert_with_changes(spark.createDataFrame([], FACT), table, ["id"], "at") as (rows, changes):
        assert rows == 0 and changes.isEmpty()
    assert spark.table(table).inputFiles() == files


# --- positions ------------------------------------------------------------------------


@pytest.mark.parametrize("count", [0, 1, 5000])
def test_positions_follow_the_order(spark, count):
    chosen = random.Random(count)
    rows = [(n, chosen.choice([None, "a", "b", "c"]), chosen.random()) for n in range(count)]
    df = spark.createDataFrame(rows, "id long, k string, v double").repartition(7)
    order = [F.col("k").desc_nulls_last(), F.col("v").asc(), F.col("id").asc()]
    found = with_positions(df, order)
    assert found.columns == ["id", "k", "v", "position"]
    by_place = [tuple(r)[:3] for r in sorted(found.collect(), key=lambda r: r.position)]
    ranked = sorted(rows, key=lambda r: (r[1] is None, -ord(r[1]) if r[1] else 0, r[2], r[0]))
    assert by_place == ranked
    assert sorted(r.position for r in found.collect()) == list(range(1, count + 1))
