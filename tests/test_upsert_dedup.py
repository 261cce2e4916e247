"""Keyed upsert (any arrival order / batch split gives the same table) and first-arrival dedup."""

import datetime as dt
import random

from hypothesis import given, settings, strategies as st

from candela.functions.ids import dense_sequence_id
from candela.operators.dedup import first_arrival
from candela.operators.upsert import latest_per_key, upsert

SCHEMA = "symbol string, open_time_ts timestamp, v int, ingestion_timestamp timestamp, is_final boolean, number_of_trades int"
D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def rows(spark, data):
    return spark.createDataFrame(
        [(s, t, v, dt.datetime(2024, 2, 1) + dt.timedelta(seconds=q), f, n) for s, t, v, q, f, n in data], SCHEMA)


def table(df):
    return sorted((r.symbol, r.open_time_ts, r.v) for r in df.collect())


def test_fixture_batches(spark):
    b1 = rows(spark, [("A", D1, 1, 1, True, 1), ("A", D2, 2, 5, True, 1), ("A", D1, 9, 0, True, 1)])
    t1 = latest_per_key(b1)
    assert table(t1) == [("A", D1, 1), ("A", D2, 2)]
    b2 = rows(spark, [("A", D2, 3, 4, True, 1), ("A", D1, 7, 6, True, 1), ("B", dt.datetime(2023, 1, 1), 8, 6, True, 1)])
    t2 = upsert(t1, b2)
    assert table(t2) == [("A", D1, 7), ("A", D2, 2), ("B", dt.datetime(2023, 1, 1), 8)]
    # replaying a batch changes nothing
    assert table(upsert(t2, b2)) == table(t2)


def test_tie_break_final_then_fullest(spark):
    same = [("A", D1, 1, 5, False, 9), ("A", D1, 2, 5, True, 3), ("A", D1, 3, 5, True, 4)]
    assert table(latest_per_key(rows(spark, same))) == [("A", D1, 3)]


change = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from([D1, D2]), st.integers(0, 99),
                   st.integers(0, 50), st.booleans(), st.integers(0, 5))


@settings(max_examples=12, deadline=None)
@given(st.lists(change, min_size=1, max_size=12, unique_by=lambda c: (c[0], c[1], c[3], c[4], c[5])),
       st.integers(0, 10_000))
def test_any_order_any_split(spark, changes, seed):
    expected = table(latest_per_key(rows(spark, changes)))
    rnd = random.Random(seed)
    shuffled = changes[:]
    rnd.shuffle(shuffled)
    cut = rnd.randint(0, len(shuffled))
    t = latest_per_key(rows(spark, shuffled[:cut] or shuffled[:1]))
    t = upsert(t, rows(spark, shuffled[cut:] or shuffled[:1]))
    assert table(t) == expected


def test_first_arrival(spark):
    df = spark.createDataFrame(
        [("A", D1, 1, dt.datetime(2024, 1, 1, 0, 1), "live"), ("A", D1, 2, dt.datetime(2024, 1, 1, 0, 1), "archive"),
         ("A", D1, 3, dt.datetime(2024, 1, 1, 0, 0), "live"), ("A", D2, 4, dt.datetime(2024, 1, 3), "live")],
        "symbol string, open_time_ts timestamp, v int, ingestion_timestamp timestamp, source_system string")
    assert sorted((r.open_time_ts, r.v) for r in first_arrival(df).collect()) == [(D1, 3), (D2, 4)]


def test_dense_sequence_id_matches_row_number(spark):
    names = [f"S{i:03d}" for i in range(200)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "symbol string").repartition(7)
    got = {r.symbol: r.id for r in dense_sequence_id(df, ["symbol"], "id", num_partitions=5).collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}
