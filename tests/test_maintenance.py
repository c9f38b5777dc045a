from datetime import datetime, timedelta
from decimal import Decimal as D
from random import Random

import pytest
from pyspark.sql import functions as F

from feira.operators import history, increment, merge, scd2
from feira.plans import dimension, incremental, places, tables
from feira.schemas import DIM_PRODUCTS

V = "id long, x string, version_timestamp timestamp_ntz"
T0, T1, T2 = datetime(2025, 1, 1), datetime(2025, 1, 2), datetime(2025, 1, 3)


def test_latest_version(spark, rows):
    df = spark.createDataFrame(
        [(1, "old", T0), (1, "new", T1), (2, "a", T0), (2, "b", T0), (3, "dated", T2), (3, "undated", None)], V
    )
    assert rows(merge.latest_version(df), "id", "x") == [(1, "new"), (2, "b"), (3, "undated")]


def test_upsert_stamps_every_touched_row(spark, rows):
    target = spark.createDataFrame([(1, "a", T0), (2, "b", T0), (3, "c", T0)], V)
    batch = spark.createDataFrame([(2, "b"), (3, "changed"), (4, "new")], "id long, x string")
    after = merge.upsert(target, batch, stamp=F.lit(T1).cast("timestamp_ntz"))
    assert rows(after) == [(1, "a", T0), (2, "b", T1), (3, "changed", T1), (4, "new", T1)]


def test_empty_batch_changes_nothing(spark, rows):
    target = spark.createDataFrame([(1, "a", T0)], V)
    assert rows(merge.upsert(target, target.limit(0))) == rows(target)


def test_duplicates_in_a_batch_raise(spark):
    with pytest.raises(merge.DuplicateKeyError):
        merge.require_unique(spark.createDataFrame([(1, "a"), (1, "b")], "id long, x string"), "id")


def test_merge_twice_is_merge_once(spark, rows):
    target = spark.createDataFrame([(1, "a", T2), (2, "b", T0)], V)
    inc = spark.createDataFrame([(1, "late", T0), (3, "n", T0), (3, "n2", T1)], V)
    once = merge.merge_increment(target, inc)
    assert rows(once) == [(1, "late", T0), (2, "b", T0), (3, "n2", T1)]
    assert rows(merge.merge_increment(once, inc)) == rows(once)
    assert rows(merge.merge_increment(target, inc, newer_only=True), "id", "x") == [(1, "a"), (2, "b"), (3, "n2")]


SRC = "id long, id_cliente long, data_hora timestamp_ntz, metodo_pagamento string, version_timestamp timestamp_ntz"


def test_increment_bounds(spark, rows):
    since = datetime(2025, 1, 10)
    edge = datetime(2025, 1, 8)
    df = spark.createDataFrame(
        [(1, 1, edge, "m", T0), (2, 1, datetime(2025, 1, 7, 23, 59, 59), "m", T0), (3, 1, None, "m", T0),
         (4, 1, datetime(2025, 2, 1), "m", T0)], SRC,
    )
    inc = increment.increment_since(df, since)
    assert rows(inc, "id") == [(1,), (4,)]
    assert increment.next_checkpoint(inc, since).first()[0] == datetime(2025, 2, 1)
    # It never moves back, not even on a batch of only late rows.
    assert increment.next_checkpoint(inc.where("id = 1"), since).first()[0] == since


def test_incremental_runs(spark, rows, tmp_path):
    fact, state = str(tmp_path / "fact"), str(tmp_path / "state")
    first = [(1, 1, datetime(2025, 1, 1), "a", T0), (2, 1, datetime(2025, 1, 10), "a", T0)]
    source = spark.createDataFrame(first, SRC)
    assert incremental.run_incremental(source.limit(0), fact, state) == increment.EPOCH
    for _ in range(2):  # the second run re-reads the overlap and changes nothing
        assert incremental.run_incremental(source, fact, state, buckets=2) == datetime(2025, 1, 10)
        assert rows(tables.read_table(spark, fact).select(*source.columns)) == first
    later = spark.createDataFrame(
        [(1, 1, datetime(2025, 1, 1), "too late", T1), (2, 1, datetime(2025, 1, 10), "fixed", T1),
         (3, 2, datetime(2025, 1, 9), "late", T1), (9, 2, datetime(2025, 1, 20), "new", T1)], SRC,
    )
    assert incremental.run_incremental(later, fact, state, buckets=2) == datetime(2025, 1, 20)
    got = rows(tables.read_table(spark, fact), "id", "metodo_pagamento")
    assert got == [(1, "a"), (2, "fixed"), (3, "late"), (9, "new")]


def versioned(spark, ids, x):
    return spark.createDataFrame([(i, x, T0) for i in ids], "id long, x string, version_timestamp timestamp_ntz")


def test_merge_rewrites_only_touched_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_into(versioned(spark, range(40), "x"), path, buckets=4)
    first = tables.live(spark, path)
    tables.merge_into(versioned(spark, [0], "y"), path)
    second = tables.live(spark, path)
    assert sum(second.partitions[b] != first.partitions[b] for b in first.partitions) == 1
    assert tables.read_table(spark, path).where("x = 'y'").count() == 1
    assert tables.read_table(spark, path).count() == 40


def test_merge_that_dies_before_its_commit(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.merge_into(versioned(spark, [1, 2, 3], "x"), path, buckets=1)
    with monkeypatch.context() as m:
        def die(*_):
            raise RuntimeError("lost")
        m.setattr(type(spark), "createDataFrame", die)
        with pytest.raises(RuntimeError):
            tables.merge_into(tables.read_table(spark, path).where("id = 2").withColumn("x", F.lit("y")), path)
    assert rows(tables.read_table(spark, path), "id", "x") == [(1, "x"), (2, "x"), (3, "x")]
    tables.merge_into(versioned(spark, [2], "y"), path)
    assert rows(tables.read_table(spark, path), "id", "x") == [(1, "x"), (2, "y"), (3, "x")]


def test_number_of_buckets_is_kept(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_into(versioned(spark, [2, 3], "x"), path, buckets=2)
    with pytest.raises(ValueError):
        tables.merge_into(versioned(spark, [2, 3], "y"), path, buckets=5)
    tables.merge_into(versioned(spark, [2, 3], "y"), path)
    assert rows(tables.read_table(spark, path), "id", "x") == [(2, "y"), (3, "y")]


def test_sparse_keys_make_few_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_into(versioned(spark, [i * 10**12 for i in range(200)], "x"), path, buckets=8)
    assert len(tables.live(spark, path).partitions) <= 8
    assert tables.read_table(spark, path).count() == 200


EVENT = "id long, x string, data_hora timestamp_ntz, version_timestamp timestamp_ntz"


def events(spark, *rows_):
    return spark.createDataFrame([(i, x, at_, T0) for i, x, at_ in rows_], EVENT)


def test_a_day_rewrites_its_month_only(spark, rows, tmp_path):
    """A batch touches the months of its rows and those that its keys leave, no others."""
    path, at = str(tmp_path / "t"), F.col("data_hora")
    day = lambda k: datetime(2024, 1, 1) + timedelta(days=k)
    tables.merge_into(events(spark, *[(k, "x", day(k)) for k in range(366)]), path, at=at)
    first = tables.live(spark, path)
    assert len(first.partitions) == 12 and first.column == tables.MONTH

    def changed(before):
        after = tables.live(spark, path)
        return {m for m in after.partitions.keys() | before.partitions.keys()
                if after.partitions.get(m) != before.partitions.get(m)}, after

    # One day: ids of that day, and new ones.
    tables.merge_into(events(spark, (365, "y", day(365)), (1000, "new", day(365)), (1001, "new", day(365))), path, at=at)
    touched, now = changed(first)
    assert touched == {"2024-12"} and tables.read_table(spark, path).count() == 368
    # One id moves from March to May, one to a month that is new, one loses its date.
    tables.merge_into(events(spark, (60, "moved", day(130)), (61, "moved", datetime(2025, 2, 1)), (62, "gone", None)), path, at=at)
    touched, now = changed(now)
    assert touched == {"2024-03", "2024-05", "2025-02", "undated"}
    got = {r.id: (r.x, r.data_hora) for r in tables.read_table(spark, path).collect()}
    assert len(got) == 368 and got[60] == ("moved", day(130)) and got[62] == ("gone", None)
    # All of a month leave it.
    tables.merge_into(events(spark, *[(k, "all", day(0)) for k in range(31, 60)]), path, at=at)
    touched, now = changed(now)
    assert touched == {"2024-01", "2024-02"} and "2024-02" not in now.partitions
    assert tables.read_table(spark, path).count() == 368
    with pytest.raises(ValueError, match="partitioned by"):
        tables.merge_into(events(spark, (1, "x", day(1))), path, buckets=2)


@pytest.mark.parametrize("bits_per_key", [1, 16])
def test_places_are_exact_however_full_the_maps_are(spark, rows, tmp_path, monkeypatch, bits_per_key):
    monkeypatch.setattr(places, "LEAST_BITS", 64)
    monkeypatch.setattr(places, "BITS_PER_KEY", bits_per_key)
    path, at = str(tmp_path / "t"), F.col("data_hora")
    month = lambda k: datetime(2024, 1 + k % 12, 1)
    random, held = Random(bits_per_key), {}
    for turn in range(4):
        batch = {random.randrange(300): (f"t{turn}", month(random.randrange(12))) for _ in range(80)}
        tables.merge_into(events(spark, *[(k, *v) for k, v in batch.items()]), path, at=at)
        held |= batch
        assert rows(tables.read_table(spark, path), "id", "x", "data_hora") == sorted(((k, *v) for k, v in held.items()), key=repr)


def test_older_versions_do_not_move_rows(spark, rows, tmp_path):
    path, at = str(tmp_path / "t"), F.col("data_hora")
    new = [(1, "new", datetime(2024, 3, 1), T1), (2, "new", datetime(2024, 3, 1), T0)]
    old = [(1, "old", datetime(2024, 1, 1), T0), (2, "newer", datetime(2024, 5, 1), T1)]
    for batch in (new, old):
        tables.merge_into(spark.createDataFrame(batch, EVENT), path, at=at, newer_only=True)
    assert rows(tables.read_table(spark, path), "id", "x") == [(1, "new"), (2, "newer")]
    assert set(tables.live(spark, path).partitions) == {"2024-03", "2024-05"}


def test_buckets_grow_with_the_first_batch(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "BUCKET_ROWS", 10)
    for n, want in ((1, 1), (10, 1), (11, 2), (95, 10)):
        tables.merge_into(versioned(spark, range(n), "x"), str(tmp_path / str(n)))
        assert tables.live(spark, str(tmp_path / str(n))).buckets == want


def test_repeated_keys_are_refused(spark, tmp_path):
    with pytest.raises(merge.DuplicateKeyError):
        tables.merge_into(versioned(spark, [1, 1], "x"), str(tmp_path / "t"), dedupe=False)
    with pytest.raises(merge.DuplicateKeyError):
        merge.upsert(versioned(spark, [1], "x"), versioned(spark, [1, 1], "y"))


def test_snapshots(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    assert tables.current(spark, path) is None
    assert tables.publish(spark.range(1), path) == 0
    assert tables.publish(spark.range(2), path) == 1
    assert tables.publish(spark.range(9), path, version=1) == 1  # replayed: skipped
    assert tables.current(spark, path).count() == 2
    # A snapshot can be derived from the one it replaces.
    tables.publish(tables.current(spark, path).where("id = 0"), path)
    assert rows(tables.current(spark, path)) == [(0,)]
    # A write that was never committed is invisible.
    spark.range(50).write.parquet(f"{path}/snapshots/version=3")
    assert tables.current(spark, path).count() == 1


P = "id long, nome string, categoria string, fornecedor string, preco decimal(10,2)"


def at(day):
    return F.lit(f"2025-01-0{day} 00:00:00")


def brief(rows, dim):
    return rows(dim.selectExpr(
        "id", "nome", "preco", "day(start_date) as s", "day(end_date) as e", "is_current"
    ))


@pytest.mark.parametrize("strict", [False, True])
def test_scd2_life_cycle(spark, rows, strict):
    first = spark.createDataFrame(
        [(1, "same", "c", "f", D("1.00")), (2, "dearer", "c", "f", D("2.00")), (3, "gone", "c", "f", D("3.00")),
         (4, "renamed", "c", "f", D("4.00"))], P)
    empty = spark.createDataFrame([], DIM_PRODUCTS)
    dim = scd2.apply_scd2(empty, first, at(1), strict)
    assert brief(rows, dim) == brief(rows, scd2.initial_dimension(first, at(1)))
    second = spark.createDataFrame(
        [(1, "same", "c", "f", D("1.00")), (2, "dearer", "c", "f", D("2.50")), (4, "new name", "c", "f", D("4.00")),
         (5, "new", "c", "f", D("5.00"))], P)
    after = scd2.apply_scd2(dim, second, at(2), strict)
    old_name = (4, "renamed", D("4.00"), 1, 2, False) if strict else (4, "renamed", D("4.00"), 1, None, True)
    assert brief(rows, after) == sorted([
        (1, "same", D("1.00"), 1, None, True),
        (2, "dearer", D("2.00"), 1, 2, False), (2, "dearer", D("2.50"), 2, None, True),
        (3, "gone", D("3.00"), 1, None, True),
        old_name, (4, "new name", D("4.00"), 2, None, True),
        (5, "new", D("5.00"), 2, None, True),
    ], key=repr)
    assert brief(rows, scd2.apply_scd2(after, second, at(3), strict)) == brief(rows, after)


def test_scd2_ignores_price_digits_the_dimension_cannot_hold(spark):
    src = spark.createDataFrame([(1, "a", "c", "f", 1.001)], P.replace("decimal(10,2)", "double"))
    dim = scd2.initial_dimension(src, at(1))
    assert scd2.apply_scd2(dim, src, at(2)).count() == 1


def test_scd2_repricing_closes_every_current_row_of_the_id(spark, rows):
    old = spark.createDataFrame([(1, "a", "c", "f", D("1.00"))], P)
    renamed = spark.createDataFrame([(1, "b", "c", "f", D("1.00"))], P)
    dim = scd2.apply_scd2(scd2.initial_dimension(old, at(1)), renamed, at(2))
    assert dim.where("is_current").count() == 2
    dearer = spark.createDataFrame([(1, "b", "c", "f", D("2.00"))], P)
    after = scd2.apply_scd2(dim, dearer, at(3))
    assert brief(rows, after.where("is_current")) == [(1, "b", D("2.00"), 3, None, True)]
    assert after.count() == 3


def test_stored_dimension_never_rewrites_history(spark, rows, tmp_path):
    path = tmp_path / "dim"
    assert dimension.read_dimension(spark, str(path)).isEmpty()
    for day, price in ((1, "1.00"), (2, "2.00"), (3, "2.00"), (4, "3.00")):
        src = spark.createDataFrame([(1, "a", "c", "f", D(price)), (2, "b", "c", "f", D("9.00"))], P)
        dimension.update_dimension(src, str(path), datetime(2025, 1, day))
    assert brief(rows, dimension.read_dimension(spark, str(path))) == sorted([
        (1, "a", D("1.00"), 1, 2, False), (1, "a", D("2.00"), 2, 4, False), (1, "a", D("3.00"), 4, None, True),
        (2, "b", D("9.00"), 1, None, True),
    ], key=repr)
    last = spark.read.parquet(str(path / "snapshots/version=3"))
    assert last.count() == 3  # two current rows and the one closed in that run


@pytest.mark.parametrize("strict", [False, True])
def test_history_equals_snapshots_one_by_one(spark, rows, strict):
    """Ids that come, change names and prices, go and come back; missing values; late snapshots."""
    random, snapshots = Random(7), []
    for day in range(1, 7):
        made = [
            (i, random.choice("ab"), random.choice(["c", "c", "c", None]), "f", random.choice([D("1.00"), D("2.00"), None]))
            for i in range(1, 60) if random.random() < 0.8
        ]
        snapshots.append((datetime(2025, 1, day), [*made, (None, "a", "c", "f", D("1.00"))]))
    schema = "id long, nome string, categoria string, fornecedor string, preco decimal(10,2)"
    dim = spark.createDataFrame([], DIM_PRODUCTS)
    for as_of, made in snapshots:
        dim = scd2.apply_scd2(dim, spark.createDataFrame(made, schema), F.lit(as_of), strict)
    late = snapshots[::2] + snapshots[1::2]
    landed = spark.createDataFrame([(*r, t) for t, made in late for r in made], f"{schema}, at timestamp")
    assert rows(history.history(landed, "at", strict)) == rows(dim)
