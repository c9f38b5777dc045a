import shutil
from collections import Counter
from datetime import datetime, timedelta, timezone
from random import Random

import pytest
from pyspark.sql import functions as F

from feira.operators import anonymity, clicks, features, merge, pii
from feira.streaming import clicks as click_stream
from feira.streaming import incremental as change_stream
from feira.streaming import late, versions
from feira.plans import tables
from feira.plans.tables import staged

EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
START = datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def events(spark):
    """One user with a third of all events, session gaps of exactly 30 minutes, ties."""
    r = Random(1)
    made = [(START, 1), (START + timedelta(minutes=30), 1), (START + timedelta(minutes=60, microseconds=1), 1), (START, 1)]
    made += [(START + timedelta(seconds=r.randint(0, 6 * 86400)), 1) for _ in range(300)]
    made += [(START + timedelta(seconds=r.randint(0, 6 * 86400)), r.randint(2, 40)) for _ in range(600)]
    # A session that runs on through many slices.
    made += [(START + timedelta(days=2, minutes=20 * i), 99) for i in range(40)]
    data = [(i, ts, user, r.choice(["view", "buy"]), r.randint(0, 999) / 100, "{}") for i, (ts, user) in enumerate(made)]
    return spark.createDataFrame(data, EVENT)


@pytest.mark.parametrize("slice_by", ["hour", "day", "minute"])
def test_sessions_equal_the_native_window(events, rows, slice_by):
    native = events.groupBy("user_id", F.session_window("ts", "30 minutes").alias("w")).agg(F.count("*"))
    want = rows(native, "user_id", "w.start", "w.end", "count(1)")
    got = rows(clicks.sessions(events, slice_by=slice_by), "user_id", "session_start", "session_end", "n_events")
    assert got == want


def test_sliding_equals_the_native_window(events, rows):
    native = events.groupBy(F.window("ts", "1 hour", "15 minutes").alias("w"), "event_type").agg(F.count("*"))
    want = rows(native, "event_type", "w.start", "w.end", "count(1)")
    assert rows(clicks.sliding(events), "event_type", "window_start", "window_end", "n_events") == want


@pytest.mark.parametrize("size, slide", [("60 minutes", "25 minutes"), ("1 hour", "1 hour"), ("2 hours", "45 minutes")])
def test_sliding_of_other_sizes(events, rows, size, slide):
    native = events.groupBy(F.window("ts", size, slide).alias("w"), "event_type").agg(F.count("*"))
    want = rows(native, "event_type", "w.start", "w.end", "count(1)")
    got = clicks.sliding(events, size, slide)
    assert rows(got, "event_type", "window_start", "window_end", "n_events") == want


@pytest.mark.parametrize("windows", [clicks.tumbling, clicks.sliding, clicks.sessions])
def test_small_values_are_summed_before_rounding(spark, windows):
    events = spark.createDataFrame([(i, START, 1, "view", 0.004, "{}") for i in range(1000)], EVENT)
    assert {str(r.total_value) for r in windows(events).collect()} == {"4.00"}


def test_sessions_of_nobody(spark):
    events = spark.createDataFrame([(1, START, None, "view", 1.0, "{}"), (2, START, 7, "view", 1.0, "{}")], EVENT)
    assert [r.user_id for r in clicks.sessions(events).collect()] == [7]


@pytest.mark.parametrize("name,end", [("tumbling", "window_end"), ("sliding", "window_end"), ("sessions", "session_end")])
def test_stream_equals_batch_on_closed_windows(spark, events, rows, tmp_path, name, end):
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    stream = getattr(click_stream, name)(click_stream.read_clicks(spark, str(tmp_path / "in")))
    click_stream.run_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    closed = events.agg(F.max("ts") - F.expr("interval 2 days")).first()[0]
    batch = getattr(clicks, name)(events).where(F.col(end) <= F.lit(closed).cast("timestamp_ntz"))
    out = spark.read.parquet(str(tmp_path / "out"))
    assert rows(out, *batch.columns) == rows(batch)
    # A restart finds nothing new.
    click_stream.run_available(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == out.count()


def test_streamed_merge(spark, rows, tmp_path):
    schema = "id long, x string, version_timestamp timestamp_ntz"
    fact, checkpoint = str(tmp_path / "fact"), str(tmp_path / "checkpoint")

    def deliver(n, *records):
        spark.createDataFrame(list(records), schema).coalesce(1).write.parquet(str(tmp_path / f"in/{n}"))
        source = change_stream.read_changes(
            spark, str(tmp_path / "in/*"), spark.createDataFrame([], schema).schema, maxFilesPerTrigger="1"
        )
        change_stream.merge_available(source, fact, checkpoint, buckets=3)
        return rows(tables.read_table(spark, fact), "id", "x")

    assert deliver(1, (1, "a", START), (1, "b", START + timedelta(1)), (5, "c", START)) == [(1, "b"), (5, "c")]
    assert deliver(2, (5, "d", START), (6, "e", START)) == [(1, "b"), (5, "d"), (6, "e")]


def test_pii(spark, rows):
    df = spark.createDataFrame(
        [(1, "write to ana.silva+x@mail.example.com, or b@c.pt"), (2, "card 4952935900253052 from 97.51.17.173"),
         (3, "call +1 (017) 555-7713 or +351 912 345 678"), (4, "nothing. at all + 12 @ home"), (5, None)],
        "id long, text string",
    )
    assert rows(pii.scan(df, "id", "text")) == [
        (1, "email", 2), (2, "card", 1), (2, "ipv4", 1), (3, "phone", 2),
    ]
    assert [r[0] for r in df.select("id", pii.mask(F.col("text")).alias("m")).orderBy("id").select("m").collect()] == [
        "write to <email>, or <email>", "card <card> from <ipv4>", "call <phone> or <phone>",
        "nothing. at all + 12 @ home", None,
    ]
    classes = {(r.coluna, r.tipo): (r.linhas_com_dados, r.classe) for r in pii.classify_columns(df, ["text"], 0.25).collect()}
    assert classes == {
        ("text", "email"): (1, "limpa"), ("text", "card"): (1, "limpa"),
        ("text", "phone"): (1, "limpa"), ("text", "ipv4"): (1, "limpa"),
    }
    assert {r.classe for r in pii.classify_columns(df, ["text"], 0.2).collect()} == {"pessoal"}


def test_pii_finds_data_anywhere_in_long_text(spark):
    text = "word " * 20000 + "z@z.pt"
    df = spark.createDataFrame([(1, text)], "id long, text string")
    assert df.select(pii.mask(F.col("text"))).first()[0] == "word " * 20000 + "<email>"


def test_pseudonym_is_keyed_and_stable(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "x string")
    keys = [r[0] for r in df.select(pii.pseudonym(F.col("x"), "k1")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert df.select(pii.pseudonym(F.col("x"), "k2")).first()[0] != keys[0]


def test_features_as_of(spark, rows):
    orders = spark.createDataFrame(
        [(1, datetime(2025, 1, 5), 10.0), (1, datetime(2025, 1, 20), 5.0), (1, datetime(2025, 4, 1), 1.0),
         (2, datetime(2025, 2, 2), 7.0), (None, datetime(2025, 2, 2), 7.0)],
        "customer_id long, data_hora timestamp_ntz, receita double",
    )
    versions = features.customer_features(orders)
    assert rows(versions.selectExpr(
        "customer_id", "cast(valid_from as string)", "cast(valid_to as string)", "orders_to_date", "cast(spend_to_date as int)"
    )) == [
        (1, "2025-02-01", "2025-05-01", 2, 15), (1, "2025-05-01", None, 3, 16), (2, "2025-03-01", None, 1, 7),
    ]
    labels = spark.createDataFrame(
        [(1, 1, datetime(2025, 1, 31)), (2, 1, datetime(2025, 2, 1)), (3, 1, datetime(2025, 4, 30, 23)),
         (4, 1, datetime(2026, 1, 1)), (5, 3, datetime(2026, 1, 1)), (6, 1, datetime(2025, 4, 2))],
        "label_id long, customer_id long, at timestamp_ntz",
    )
    got = rows(features.as_of(labels, versions, "at", "v1"), "label_id", "orders_to_date")
    assert got == [(1, None), (2, 2), (3, 2), (4, 3), (5, None), (6, 2)]


def test_as_of_with_any_bounds_and_several_versions(spark, rows):
    at = lambda m, d, y=2025: datetime(y, m, d)
    versions = spark.createDataFrame(
        [(1, "v1", at(3, 15), at(4, 10), 1, None, None), (1, "v1", at(4, 20), None, 2, None, None),
         (1, "v2", at(3, 1), None, 9, None, None), (2, "v1", at(1, 1, 2020), at(2, 1, 2024), 5, None, None),
         (None, "v1", at(1, 1), None, 7, None, None)],
        "customer_id long, feature_version string, valid_from timestamp_ntz, valid_to timestamp_ntz,"
        " orders_to_date int, spend_to_date double, last_order timestamp_ntz",
    )
    labels = spark.createDataFrame(
        [(1, 1, at(3, 14)), (2, 1, at(3, 15)), (3, 1, at(3, 20)), (4, 1, at(4, 10)), (5, 1, at(5, 1, 2031)),
         (6, 2, at(6, 1, 2022)), (7, 2, at(2, 1, 2024)), (8, None, at(6, 1)), (9, 3, at(6, 1)), (10, 1, None), (2, 1, at(3, 15))],
        "label_id long, customer_id long, at timestamp_ntz",
    )
    got = rows(features.as_of(labels, versions, "at", "v1"), "label_id", "orders_to_date", "feature_version")
    v1 = "v1"
    assert got == sorted([
        (1, None, None), (2, 1, v1), (2, 1, v1), (3, 1, v1), (4, None, None), (5, 2, v1), (6, 5, v1), (7, None, None),
        (8, None, None), (9, None, None), (10, None, None),
    ], key=repr)
    assert {r.orders_to_date for r in features.as_of(labels, versions, "at", "v2").where("customer_id = 1 and at is not null").collect()} == {9}


VERSION = "id long, name string, n int, version_timestamp timestamp_ntz"


def follow(spark, root, deliveries, **options):
    """Each delivery arrives, and the stream is started anew for it; the newest versions."""
    for k, rows_ in enumerate(deliveries):
        spark.createDataFrame(rows_, VERSION).coalesce(1).write.parquet(f"{root}/in/delivery={k}")
        changes = change_stream.read_changes(spark, f"{root}/in/delivery=*", spark.createDataFrame([], VERSION).schema)
        versions.follow_available(changes, f"{root}/out", f"{root}/check", **options)
    return versions.read_newest(spark, f"{root}/out")


def test_newest_versions_of_many_keys(spark, rows, tmp_path):
    r = Random(3)
    at = lambda k: START + timedelta(hours=r.randint(24 * k, 24 * k + 48))
    deliveries = [
        [(r.randint(1, 300), r.choice([None, "", "a", "b"]), r.choice([None, 2, 10]), at(k)) for _ in range(1500)]
        for k in range(3)
    ]
    got = rows(follow(spark, str(tmp_path), [*deliveries, deliveries[-1]]))
    everything = spark.createDataFrame([row for d in deliveries for row in d], VERSION)
    assert got == rows(merge.latest_version(everything))
    # Each is newer than all of its key before it: one of a key in a batch, none twice.
    passed = {}
    for n, *row in sorted((r.batch, r.id, r.version_timestamp, r.n or 0, r.name or "") for r in spark.read.parquet(f"{tmp_path}/out").collect()):
        passed.setdefault(row[0], []).append((tuple(row[1:]), n))
    for of_key in passed.values():
        assert [x[0][0] for x in of_key] == sorted(x[0][0] for x in of_key)
        assert len({x[0] for x in of_key}) == len({x[1] for x in of_key}) == len(of_key)
    # No step of it passes keys one by one through Python.
    changes = change_stream.read_changes(spark, f"{tmp_path}/in/delivery=*", everything.schema)
    query = versions.newest_versions(changes).writeStream.format("noop").outputMode("update").option(
        "checkpointLocation", f"{tmp_path}/other"
    ).trigger(availableNow=True).start()
    query.awaitTermination()
    operators = {o["operatorName"] for p in query.recentProgress for o in p["stateOperators"]}
    assert operators == {"stateStoreSave"}


def test_newest_versions_of_files_out_of_order(spark, rows, tmp_path):
    at = lambda d, h=0: datetime(2025, 1, d, h)
    deliveries = [
        [(1, "a", 1, at(10)), (2, "x", 9, at(9)), (2, "x", 10, at(9)), (3, None, None, at(9)), (None, "k", 1, at(9)), (4, "t", 1, None)],
        [(1, "older", 5, at(9, 12)), (2, "x", 2, at(9)), (3, "", 0, at(9)), (5, "b", 1, at(8, 1))],
        [(1, "b", 1, at(11)), (5, "c", 2, at(20))],
        [(1, "b", 1, at(11)), (6, "new", 1, at(21))],
    ]
    got = rows(follow(spark, str(tmp_path), deliveries))
    assert got == [(1, "b", 1, at(11)), (2, "x", 10, at(9)), (3, "", 0, at(9)), (5, "c", 2, at(20)), (6, "new", 1, at(21))]
    everything = spark.createDataFrame([r for d in deliveries for r in d if r[0] and r[3]], VERSION)
    assert rows(merge.latest_version(everything)) == got


def test_keys_behind_the_watermark_are_forgotten(spark, rows, tmp_path):
    at = lambda d: datetime(2025, 1, d)
    deliveries = [[(k, "a", 1, at(1)) for k in range(20)], [(100, "b", 1, at(10))], [(101, "c", 1, at(11))], [(1, "late", 1, at(2))]]
    got = follow(spark, str(tmp_path), deliveries)
    assert got.count() == 22 and rows(got.where("id = 1"), "name") == [("a",)]
    held = spark.read.format("statestore").load(str(tmp_path / "check"))
    assert {r["key"]["_key"] for r in held.select("key").collect()} == {"100", "101"}


EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def test_late_events_and_corrections(spark, rows, tmp_path):
    at = lambda d, h=0, m=0: datetime(2025, 1, d, h, m, tzinfo=timezone.utc)
    deliveries = [
        [(1, at(10, 1), 1, "view", 1.0, None), (2, at(10, 1, 30), 1, "view", 2.0, None), (3, at(5), 1, "buy", 3.0, None)],
        [(4, at(10, 1, 59), 1, "view", 4.0, None), (5, at(7, 23), 1, "view", 5.0, None), (6, None, 1, "view", 6.0, None)],
        [(7, at(20), 1, "view", 7.0, None)],
        [(8, at(10, 1, 1), 1, "view", 0.125, None), (9, at(19), 1, "buy", 9.0, None), (10, at(5), 2, "view", 1.0, None)],
    ]
    root = str(tmp_path)
    for k, events in enumerate(deliveries):
        spark.createDataFrame(events, EVENTS).coalesce(1).write.parquet(f"{root}/in/delivery={k}")
        stream = click_stream.read_clicks(spark, f"{root}/in/delivery=*")
        for _ in range(2):  # a start without news changes nothing
            late.split_available(stream, f"{root}/out", f"{root}/check")
    # Event 3 came first, before any watermark; 5 came when the watermark stood at the 8th, 1:30.
    assert rows(late.late_events(spark, f"{root}/out", EVENTS), "event_id", "batch") == [(10, 3), (5, 1), (8, 3)]
    closed = late.closed_windows(spark, f"{root}/out")
    fixed = late.corrections(spark, f"{root}/out", EVENTS)
    assert {(r.event_type, r.window_start.day, r.n_events) for r in closed.collect()} == {("view", 10, 3), ("buy", 5, 1)}
    assert {(r.event_type, r.window_start.day, r.n_events) for r in fixed.collect()} == {("view", 10, 4), ("view", 7, 1), ("view", 5, 1)}
    everything = spark.createDataFrame([e for d in deliveries for e in d if e[1]], EVENTS)
    batch = clicks.tumbling(everything).where("window_end <= timestamp_ntz'2025-01-18 00:00:00'")
    columns = ["event_type", "window_start", "window_end", "n_events", "total_value"]
    assert rows(late.corrected_windows(closed, fixed), *columns) == rows(batch, *columns)


def test_an_uncommitted_batch_is_not_read(spark, rows, tmp_path, monkeypatch):
    root, at = str(tmp_path), lambda d: datetime(2025, 1, d, tzinfo=timezone.utc)
    first = [(1, at(1), 1, "view", 1.0, None), (2, at(9), 1, "view", 2.0, None)]
    spark.createDataFrame(first, EVENTS).coalesce(1).write.parquet(f"{root}/in/delivery=0")
    stream = click_stream.read_clicks(spark, f"{root}/in/delivery=*")
    late.split_available(stream, f"{root}/out", f"{root}/check")
    before = rows(late.closed_windows(spark, f"{root}/out"))
    # A batch that crashed before its commit left its files behind.
    shutil.copytree(f"{root}/out/timely/batch=0", f"{root}/out/timely/batch=1")
    shutil.copytree(f"{root}/out/late/batch=0", f"{root}/out/late/batch=1")
    assert rows(late.closed_windows(spark, f"{root}/out")) == before


@pytest.mark.parametrize("slice_days", [90, 366])
def test_trailing_features(spark, rows, slice_days):
    """Against sums over all pairs of days; customers with very many and very few orders."""
    r = Random(3)
    made = [(c, datetime(2024, 1, 1) + timedelta(hours=r.randint(0, 24 * 700)), r.randint(1, 99) / 4)
            for c, n in ((1, 300), (2, 20), (3, 1)) for _ in range(n)]
    made += [(4, datetime(2024, 1, 1, 23, 59), 1.0), (4, datetime(2024, 1, 30), 2.0), (4, datetime(2024, 1, 31), 4.0),
             (4, datetime(2024, 3, 30), 8.0), (4, datetime(2024, 3, 31), 16.0), (None, datetime(2024, 1, 1), 1.0), (5, None, 1.0)]
    orders = spark.createDataFrame(made, "customer_id long, data_hora timestamp_ntz, receita double")
    want = []
    for c, day in {(c, t.date()) for c, t, _ in made if c and t}:
        row = [c, day]
        for n in (30, 90):
            inside = [v for x, t, v in made if x == c and t and day - timedelta(days=n - 1) <= t.date() <= day]
            row += [len(inside), round(sum(inside), 2)]
        want.append(tuple(row))
    got = features.trailing_features(orders, slice_days=slice_days).drop("feature_version")
    assert sorted((*r[:3], float(r[3]), r[4], float(r[5])) for r in got.collect()) == sorted(want)
    with pytest.raises(ValueError):
        features.trailing_features(orders, slice_days=89)


@pytest.mark.parametrize("k", [1, 2, 5, 40, 1000])
def test_groups_have_k_rows(spark, k):
    r = Random(k)
    made = [(i, r.choice(["n1", "n2", "n3", None]), f"{r.randint(2020, 2022)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}" if i % 9 else None)
            for i in range(200)] + [(200, "n9", "1999-01-01")] * 3
    df = spark.createDataFrame(made, "id int, place string, day string")
    levels = {"day": anonymity.date_levels(F.col("day").cast("date")), "place": [F.substring("place", 1, 1), F.col("place")]}
    got = anonymity.k_anonymous(df, levels, k, lambda x: staged(x, "k")).collect()
    if k > len(made):
        assert got == []
        return
    assert sorted(g.id for g in got) == sorted(m[0] for m in made)
    sizes = Counter((g.place, g.day) for g in got)
    assert min(sizes.values()) >= k
    by_id = {m[0]: m for m in made}
    for g in got:  # what is told is true
        _, place, day = by_id[g.id]
        assert g.place in ("*", place or "?", (place or "?")[0])
        assert g.day in ("*", "?") and (g.day == "*" or day is None) or day.startswith(g.day[:4])
    if k == 1:
        assert all(g.day == (by_id[g.id][2] or "?") and g.place == (by_id[g.id][1] or "?") for g in got)
