"""What is kept from run to run: zones, moments, states, snapshots, indexes."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from support import explained, rows
from tierflow.audit import Audit
from tierflow.operators import moments, states
from tierflow.operators.timeseries import hourly_profile, on_grid
from tierflow.plans import layers, turbine
from tierflow.plans import reports as rep
from tierflow.plans.specs import turbine_specs
from tierflow.sinks import snapshots as snap
from tierflow.sinks.tables import save_table
from tierflow.sinks.tokens import TokenMapping
from tierflow.sinks.upsert import upsert
from tierflow.sources.files import load_window
from tierflow.sources.zones import ZoneMap
from tierflow.streaming import ingest as ing
from tierflow.streaming import seen
from tierflow.streaming.seen import RowIndex, row_hashes

DAY = datetime(2024, 3, 1)
READING = "timestamp timestamp_ntz, turbine_id string, wind_speed double, wind_direction double, power_output double"


# --- zone map ----------------------------------------------------------------


def write_day(folder, day, name=None, hours=range(24)):
    lines = ["timestamp,turbine_id,wind_speed,wind_direction,power_output"]
    for h in hours:
        at = DAY + timedelta(days=day, hours=h)
        lines += [f"{at},T{t},{h + t},{10 * t},{(day + 1) * h}" for t in (1, 2)]
    (folder / (name or f"day{day:02}.csv")).write_text("\n".join(lines) + "\n")


def opened_files(df):
    return sorted(f.rsplit("/", 1)[1] for f in df.inputFiles())


def test_a_window_opens_the_files_it_needs(spark, database, tmp_path):
    for day in range(30):
        write_day(tmp_path, day)
    zones = ZoneMap(spark, f"{database}.zones")
    start, end = DAY + timedelta(days=10), DAY + timedelta(days=11)
    expected = rows(load_window(spark, str(tmp_path), start, end, READING))
    with zones.window(str(tmp_path), start, end, READING) as found:
        assert (found.opened, found.skipped) == (30, 0)
        assert rows(found.rows) == expected
    with zones.window(str(tmp_path), start, end, READING) as found:
        assert (found.opened, found.skipped) == (2, 28)
        assert rows(found.rows) == expected
        assert opened_files(found.rows) == ["day10.csv", "day11.csv"]
    # New and changed files are read whatever their names say.
    write_day(tmp_path, 10, "late.csv", hours=[3])
    write_day(tmp_path, 29, "day00.csv")
    (tmp_path / "empty.csv").write_text("timestamp,turbine_id,wind_speed,wind_direction,power_output\n")
    expected = rows(load_window(spark, str(tmp_path), start, end, READING))
    for files in (5, 3):
        with zones.window(str(tmp_path), start, end, READING) as found:
            assert found.opened == files
            assert rows(found.rows) == expected
    later = DAY + timedelta(days=29)
    with zones.window(str(tmp_path), later, later, READING) as found:
        assert (found.opened, found.rows.count()) == (2, 4)
    nothing = DAY - timedelta(days=9)
    with zones.window(str(tmp_path), nothing, nothing, READING) as found:
        assert (found.opened, found.rows.count()) == (0, 0)
        assert found.rows.dtypes == load_window(spark, str(tmp_path), start, end, READING).dtypes


def test_times_that_are_null_or_cannot_be_read(spark, database, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,turbine_id,wind_speed,wind_direction,power_output\n,T1,1,1,1\nsoon,T1,1,1,1\n")
    zones = ZoneMap(spark, f"{database}.zones")
    for opened in (1, 0):
        with zones.window(str(tmp_path), DAY, DAY, READING) as found:
            assert (found.opened, found.rows.count()) == (opened, 0)


# --- moments -----------------------------------------------------------------


def readings(spark, days, seed=1):
    rng = random.Random(seed)
    data = []
    for day in days:
        for h in range(24):
            for t in ("a", "b"):
                for _ in range(rng.randint(0, 2)):
                    value = rng.choice([None, 1e9 + rng.random(), 1e9 + rng.gauss(0, 5)])
                    data.append((DAY + timedelta(days=day, hours=h), t, rng.random() * 9, value, float(day)))
    return spark.createDataFrame(data, READING)


def close(left, right):
    a, b = (sorted(map(tuple, df.collect()), key=lambda r: r[:2]) for df in (left, right))
    assert [r[:2] for r in a] == [r[:2] for r in b]
    for x, y in zip(a, b):
        for p, q in zip(x[2:], y[2:]):
            assert p == pytest.approx(q, abs=5e-5, rel=1e-9) if p is not None and q is not None else p == q


def test_merged_moments_are_the_profile(spark, database):
    every = readings(spark, range(9))
    start, end = DAY, DAY + timedelta(days=9)
    placed = on_grid(every, start, end).cache()
    table = f"{database}.moments"
    moments.store_moments(spark, placed, table, [str(DAY + timedelta(days=d))[:10] for d in range(8)])
    # The window moves on by a day: that day alone is read.
    new = date(2024, 3, 9)
    one = placed.where(F.to_date("timestamp") == F.lit(new))
    moments.store_moments(spark, one, table, [new])
    for first, last in ((0, 8), (1, 8), (3, 5), (8, 8)):
        window = placed.where(F.to_date("timestamp").between(F.lit(DAY + timedelta(days=first)).cast("date"), F.lit(DAY + timedelta(days=last)).cast("date")))
        names = hourly_profile(window).columns
        stored = moments.stored_profile(spark, table, DAY.date() + timedelta(days=first), DAY.date() + timedelta(days=last))
        assert stored.columns == names
        close(stored, hourly_profile(window))
    # A day that is corrected replaces its moments, one that is gone loses them.
    moments.store_moments(spark, one.where("hour < 3"), table, [new, date(2024, 3, 1)])
    left = placed.where("to_date(timestamp) > date'2024-03-01' AND (to_date(timestamp) < date'2024-03-09' OR hour < 3)")
    close(moments.stored_profile(spark, table, DAY.date(), new), hourly_profile(left))


def test_moments_of_nothing(spark, database):
    placed = on_grid(readings(spark, []), DAY, DAY + timedelta(days=1))
    moments.store_moments(spark, placed, f"{database}.m", ["2024-03-01"])
    assert moments.stored_profile(spark, f"{database}.m", "2024-03-01", "2024-03-02").count() == 0


# --- states and reports --------------------------------------------------------


METRICS = {
    "total": "sum(v * (1 + 1))",
    "n": "count(*)",
    "n_v": "count(v)",
    "least": "min(v)",
    "most": "MAX(v)",
    "mean": "avg(v)",
    "users": "count(distinct u)",
}


def sales(spark, seed, n=300):
    rng = random.Random(seed)
    data = [
        (rng.choice("xyz"), rng.choice([None, *range(9)]), rng.choice([None, 1.5, 2.25, -3.0]),
         None if rng.random() < 0.05 else DAY + timedelta(hours=rng.randrange(24 * 50)))
        for _ in range(n)
    ]
    return spark.createDataFrame(data, "k string, u int, v double, at timestamp_ntz")


def reported(spark, reports, grain):
    return rows(spark.table(reports.table(grain)).drop("period_start"))


def expected_report(spark, df, grain):
    unit = {"hourly": "hour", "daily": "day", "weekly": "week", "monthly": "month"}[grain]
    df = df.withColumn("agg_date", F.date_trunc(unit, "at").cast("timestamp_ntz"))
    return rows(df.groupBy("k", "agg_date").agg(*[F.expr(e).alias(n) for n, e in METRICS.items()]))


def test_reports_follow_the_days_that_change(spark, database):
    first, second = sales(spark, 1), sales(spark, 2, 20)
    reports = rep.Reports(f"{database}.s", f"{database}.g", "at", ("k",), METRICS)
    save_table(first, reports.source)
    rep.refresh_reports(spark, reports)
    save_table(second, reports.source, "append")
    rep.refresh_reports(spark, reports, rep.changed_days(second, "at"))
    every = first.union(second)
    for grain in reports.grains:
        assert reported(spark, reports, grain) == expected_report(spark, every, grain)
    # A day's rows go: its periods shrink or vanish.
    day = date(2024, 3, 1)
    rest = every.where("at IS NULL OR to_date(at) <> date'2024-03-01'")
    save_table(rest, reports.source)
    rep.refresh_reports(spark, reports, [day, None])
    for grain in reports.grains:
        assert reported(spark, reports, grain) == expected_report(spark, rest, grain)
    before = [reported(spark, reports, g) for g in reports.grains]
    rep.refresh_reports(spark, reports, [])
    rep.refresh_reports(spark, reports, [day])
    assert [reported(spark, reports, g) for g in reports.grains] == before


def test_only_rows_of_changed_days_are_read(spark):
    df = sales(spark, 1)
    plan = explained(rep._of_days(df, "at", [date(2024, 3, 5), date(2024, 3, 7)]))
    assert "2024-03-05 00:00:00" in plan and "2024-03-08 00:00:00" in plan


@pytest.mark.parametrize("text", ["stddev(v)", "sum(v) + 1", "sum(v) / count(v)", "max(distinct v)", "v"])
def test_metrics_without_mergeable_states(text):
    with pytest.raises(ValueError, match="no state"):
        states.Metric.parse("m", text)


def test_periods():
    day = date(2024, 2, 29)
    assert [rep.first_day(day, g) for g in ("daily", "weekly", "monthly")] == [day, date(2024, 2, 26), date(2024, 2, 1)]
    assert rep.last_day(date(2024, 2, 1), "monthly") == day
    assert rep.last_day(date(2024, 12, 1), "monthly") == date(2024, 12, 31)
    assert rep.last_day(date(2024, 2, 26), "weekly") == date(2024, 3, 3)


# --- snapshots -------------------------------------------------------------------


def numbers(spark, n, tag):
    return spark.range(n).select("id", F.lit(tag).alias("v"))


def test_readers_see_one_state(spark, database):
    name = f"{database}.t"
    upsert(spark, numbers(spark, 5, "a"), name, ["id"])
    before = spark.table(name)
    upsert(spark, numbers(spark, 9, "b").where("id > 2"), name, ["id"])
    # A read that was planned before finds the old state, whole.
    assert rows(before) == [(i, "a") for i in range(5)]
    assert rows(spark.table(name)) == sorted([(i, "a") for i in range(3)] + [(i, "b") for i in range(3, 9)], key=repr)
    assert len(snap.snapshots(spark, name)) == 2
    for tag in "cde":
        snap.publish_snapshot(numbers(spark, 2, tag), name)
        assert len(snap.snapshots(spark, name)) == 2
    assert rows(spark.table(name)) == [(0, "e"), (1, "e")]


def test_a_publication_that_fails_changes_nothing(spark, database):
    name = f"{database}.t"
    upsert(spark, numbers(spark, 5, "a"), name, ["id"])
    broken = numbers(spark, 9, "b").withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("lost"))).otherwise("b"))
    for write in (lambda: upsert(spark, broken, name, ["id"], source_is_stored=True, keys_are_unique=True), lambda: snap.publish_snapshot(broken, name)):
        with pytest.raises(Exception, match="lost"):
            write()
        assert rows(spark.table(name)) == [(i, "a") for i in range(5)]
        assert len(snap.snapshots(spark, name)) == 1


def test_saves_follow_a_publication(spark, database):
    name = f"{database}.t"
    save_table(numbers(spark, 3, "a"), name)
    snap.publish_snapshot(numbers(spark, 3, "b"), name)
    save_table(numbers(spark, 1, "c"), name, "append")
    assert spark.table(name).count() == 4
    save_table(numbers(spark, 2, "d"), name)
    assert rows(spark.table(name)) == [(0, "d"), (1, "d")]
    before = spark.table(name)
    save_table(numbers(spark, 1, "e").withColumn("w", F.lit(1)), name, at_once=True)
    assert rows(spark.table(name)) == [(0, "e", 1)] and before.count() == 2


def test_partitioned_tables_are_refused(spark, database):
    save_table(numbers(spark, 3, "a"), f"{database}.t", partitions=["v"])
    with pytest.raises(ValueError, match="partitioned"):
        snap.publish_snapshot(numbers(spark, 3, "a"), f"{database}.t")


def test_small_tables_are_compacted(spark, database):
    name = f"{database}.t"
    for i in range(5):
        save_table(numbers(spark, 1, str(i)).coalesce(1), name, "append")
    assert not snap.compact_table(spark, name, 5)
    assert snap.compact_table(spark, name, 4)
    assert len(spark.table(name).inputFiles()) == 1 and spark.table(name).count() == 5


# --- ingest ----------------------------------------------------------------------


@pytest.fixture(autouse=True)
def few_buckets(monkeypatch):
    monkeypatch.setattr(seen, "BUCKETS", 4)


def put(folder, name, lines):
    (folder / f"{name}.csv").write_text("".join(f"{x}\n" for x in lines))


def run(spark, folder, table, **options):
    return ing.ingest_new_files(spark, str(folder), table, "a string, b int", distinct_on=list, **options)


def test_duplicates_across_runs(spark, database, tmp_path):
    table = f"{database}.t"

    def check(expected):
        stored = spark.table(table).select("a", "b")
        assert rows(stored) == sorted(expected, key=repr)

    put(tmp_path, "one", ["x,1", "x,1", ",2", "y,"])
    assert run(spark, tmp_path, table).target_count == 3
    put(tmp_path, "two", ["x,1", "z,3", ",2", "y,", ",", "2,"])
    assert run(spark, tmp_path, table).target_count == 3
    check([("x", 1), (None, 2), ("y", None), ("z", 3), (None, None), ("2", None)])
    assert run(spark, tmp_path, table).files == 0
    # The first file changes: rows that were left out for its sake come back from the second.
    put(tmp_path, "one", ["y,", "new,9", "z,3"])
    run(spark, tmp_path, table)
    check([("x", 1), (None, 2), ("y", None), ("z", 3), (None, None), ("2", None), ("new", 9)])
    put(tmp_path, "three", ["x,1"])
    put(tmp_path, "two", ["q,1"])
    run(spark, tmp_path, table)
    check([("y", None), ("new", 9), ("z", 3), ("q", 1), ("x", 1)])


@pytest.mark.parametrize("files", [None, 1])
def test_any_order_of_deliveries_gives_one_full_run(spark, database, tmp_path, files):
    rng = random.Random(files or 0)
    for turn in range(3 if files else 2):
        for name in rng.sample("abcde", 3):
            put(tmp_path, name, [f"{rng.choice('xyz')},{rng.randint(0, 4 + turn)}" for _ in range(turn * 7 + rng.randint(1, 9))])
        run(spark, tmp_path, f"{database}.t", max_files_per_batch=files)
        full = spark.read.csv(str(tmp_path), "a string, b int").distinct()
        assert rows(spark.table(f"{database}.t"), "a", "b") == rows(full)


def test_looking_rows_up_shuffles_no_index(spark, database, tmp_path):
    put(tmp_path, "one", ["x,1"])
    run(spark, tmp_path, f"{database}.t")
    index = RowIndex(spark, f"{database}.t", ing.ledger_of(f"{database}.t"), "ingest_file", "ingest_batch")
    new = spark.range(5000).select(F.col("id").cast("string").alias("a"), F.col("id").cast("int").alias("b"))
    hashed = new.select("*", *row_hashes(["a", "b"])).hint("merge")
    plan = explained(hashed.join(spark.table(index.name).select("row_hash", "kept"), "row_hash"))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1


def test_a_hash_alone_decides_nothing(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(seen, "row_hashes", lambda columns: [F.lit(7).cast("long").alias(n) for n in seen.HASHES])
    put(tmp_path, "one", ["x,1", "y,2"])
    run(spark, tmp_path, f"{database}.t")
    put(tmp_path, "two", ["x,1", "z,3"])
    run(spark, tmp_path, f"{database}.t")
    assert rows(spark.table(f"{database}.t"), "a", "b") == [("x", 1), ("y", 2), ("z", 3)]


def test_a_broken_batch_leaves_no_trace_in_the_index(spark, database, tmp_path, monkeypatch):
    put(tmp_path, "one", ["x,1"])
    run(spark, tmp_path, f"{database}.t")
    put(tmp_path, "two", ["x,1", "y,2"])
    enter = ing._Ledger.enter

    def broken(self, files, batch, done):
        if done:
            raise OSError("gone")
        enter(self, files, batch, done)

    monkeypatch.setattr(ing._Ledger, "enter", broken)
    with pytest.raises(OSError):
        run(spark, tmp_path, f"{database}.t")
    monkeypatch.setattr(ing._Ledger, "enter", enter)
    run(spark, tmp_path, f"{database}.t")
    assert rows(spark.table(f"{database}.t"), "a", "b") == [("x", 1), ("y", 2)]


@pytest.mark.parametrize(("count", "size"), [(3, None), (None, 25), (4, 30)])
def test_batches_are_cut_in_the_store(spark, tmp_path, count, size):
    rng = random.Random(3)
    sizes = {f"f{i:02}": rng.randint(1, 20) for i in range(23)}
    for name, n in sizes.items():
        (tmp_path / name).write_text("x" * n)
    files = ing.pending_files(spark, str(tmp_path), "no.ledger")
    batches = list(ing.batches_of_files(files, count, size))
    seen = [f for b in batches for f in b]
    assert sorted(f.file.rsplit("/", 1)[1] for f in seen) == sorted(sizes)
    assert [(f.modified, f.file) for f in seen] == sorted((f.modified, f.file) for f in seen)
    for b in batches:
        assert not count or len(b) <= count
        assert not size or sum(f.size for f in b[:-1]) < size
    assert len(batches) < len(sizes)


def test_the_ledger_is_compacted(spark, database, tmp_path, monkeypatch):
    monkeypatch.setattr(ing, "compact_table", lambda s, t: snap.compact_table(s, t, 2))
    for i in range(4):
        put(tmp_path, f"f{i}", [f"x,{i}"])
        run(spark, tmp_path, f"{database}.t")
    assert len(spark.table(ing.ledger_of(f"{database}.t")).inputFiles()) <= 3
    assert spark.table(f"{database}.t").count() == 4


# --- tokens ------------------------------------------------------------------------


def test_tokens_last_and_restore(spark, database):
    name = f"{database}.tokens"
    first = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "v string, n int")
    later = spark.createDataFrame([("c", 1), ("a", 2), (None, 3)], "v string, n int")
    assert TokenMapping(spark, name, "v", "s").extend(first) == 3
    held = dict(rows(spark.table(name)))
    mapping = TokenMapping(spark, name, "v", "other salt")
    assert mapping.extend(later) == 1 and mapping.extend(later) == 0
    now = dict(rows(spark.table(name)))
    assert {k: now[k] for k in held} == held and len(now) == 4
    hidden = mapping.tokenize(later)
    assert hidden.columns == ["n", "v_token"]
    assert rows(mapping.restore(hidden), "v", "n") == rows(later)
    unknown = spark.createDataFrame([("zzz", 1)], "v string, n int")
    assert rows(mapping.tokenize(unknown, keep=True)) == [("zzz", 1, None)]


def test_a_token_for_two_values_is_refused(spark, database, monkeypatch):
    from tierflow.sinks import tokens

    name = f"{database}.tokens"
    one = spark.createDataFrame([("a",)], "v string")
    TokenMapping(spark, name, "v").extend(one)
    same = rows(spark.table(name))[0][1]
    monkeypatch.setattr(
        tokens, "create_token_mapping", lambda df, c, salt: df.select(c).distinct().withColumn("v_token", F.lit(same))
    )
    with pytest.raises(ValueError, match="several values"):
        TokenMapping(spark, name, "v").extend(spark.createDataFrame([("b",)], "v string"))
    assert spark.table(name).count() == 1


# --- jobs a day at a time, and again -------------------------------------------------


def test_daily_runs_equal_a_run_over_the_window(spark, database, tmp_path):
    for day in range(6):
        write_day(tmp_path, day, hours=[h for h in range(24) if (h + day) % 5])
    # An entity of the third day alone gets a grid on the last one, too.
    with open(tmp_path / "day02.csv", "a") as lines:
        lines.write("".join(f"{DAY + timedelta(days=2, hours=h)},T9,{h},1,{h * h}\n" for h in range(24)))
    full = turbine.Outputs(f"{database}.c1", f"{database}.a1", f"{database}.s1")
    daily = turbine.Outputs(f"{database}.c2", f"{database}.a2", f"{database}.s2")
    turbine.run_turbines(spark, f"{tmp_path}/*.csv", DAY + timedelta(days=1), DAY + timedelta(days=6), full, schema=READING)
    path = f"{tmp_path}/*.csv"
    turbine.refresh_moments(spark, path, date(2024, 3, 1), date(2024, 3, 4), READING, daily)
    for day in (5, 6):
        turbine.run_turbines_daily(spark, path, date(2024, 3, day), 5, READING, daily)
    on_last = "date = date'2024-03-06'"
    for a, b in ((full.cleaned, daily.cleaned), (full.anomalies, daily.anomalies), (full.statistics, daily.statistics)):
        left, right = (
            sorted(tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in spark.table(t).where(on_last).select(*spark.table(a).columns).collect())
            for t in (a, b)
        )
        assert left == right and (left or a == full.anomalies)


def test_a_mended_run_goes_on_where_it_failed(spark, database, tmp_path):
    put(tmp_path, "in", ["timestamp,turbine_id,wind_speed,power_output,temperature", "2024-01-01 00:00:00,T1,4.0,8.0,1.0"])
    audit = {"audit_table": f"{database}.audit", "error_table": f"{database}.errors"}
    bronze, silver, gold = ({**s, "audit": audit} for s in turbine_specs(f"{tmp_path}/*.csv", database))
    broken = {**gold, "transform": {**gold["transform"], "dimensions": ["nope"]}}
    with pytest.raises(ValueError):
        layers.run_layers(spark, bronze, silver, broken, job_id="j")
    files = spark.table(f"{database}.bronze_turbines").inputFiles()
    results = layers.run_layers(spark, bronze, silver, gold, job_id="j")
    assert spark.table(f"{database}.bronze_turbines").inputFiles() == files
    assert [(r.source_count, r.target_count) for r in results] == [(1, 1)] * 3
    again = layers.run_layers(spark, bronze, silver, gold, job_id="j")
    assert [r.table for r in again] == [r.table for r in results] and again[2].view == results[2].view

    def runs():
        return {tuple(r[:2]): r[2] for r in spark.table(f"{database}.audit").groupBy("layer", "status").count().collect()}

    once = {("BRONZE", "SUCCESS"): 1, ("SILVER", "SUCCESS"): 1, ("GOLD", "FAILED"): 1, ("GOLD", "SUCCESS"): 1}
    assert runs() == once
    # Another job, and a source that has changed, run everything again.
    layers.run_layers(spark, bronze, silver, gold, job_id="k")
    put(tmp_path, "more", ["timestamp,turbine_id,wind_speed,power_output,temperature", "2024-01-01 01:00:00,T1,4.0,8.0,1.0"])
    assert layers.run_layers(spark, bronze, silver, gold, job_id="j")[0].source_count == 2
    assert runs()["BRONZE", "SUCCESS"] == 3 and runs()["GOLD", "SUCCESS"] == 3


def test_audit_tables_of_earlier_times_gain_columns(spark, database):
    name = f"{database}.audit"
    spark.sql(f"CREATE TABLE {name} (run_id string, layer string, source_count long, target_count long, status string, started_at timestamp, ended_at timestamp) USING parquet")
    audit = Audit(spark, "BRONZE", {"audit_table": name, "job_id": "j", "source_version": "1"})
    assert audit.completed() is None
    audit.log_run(1, 1)
    assert audit.completed().run_id == audit.run_id
