"""Structured Streaming flows: exactly-once file pickup, keyed upsert on state, named tables,
batch = stream."""

import datetime as dt
import re
import threading
import uuid

import pytest
from pyspark.sql import functions as F

from rankforge import queries as q
from rankforge.plans import encounters as enc
from rankforge.session import shared_path
from rankforge.sources.files import (attach_metadata, read_landing, stamp_from_file_name,
                                     write_landing)
from rankforge.streaming import flows, tables
from rankforge.streaming import upsert as up
from rankforge.streaming.flows import append_checked, append_to_table, bronze_stream, ledger_totals
from rankforge.streaming.tables import create_table, read_rows, read_table_stream
from rankforge.streaming.upsert import BUCKET, KeyedTable, upsert_stream


def fresh(kind="t"):
    return f"{kind}_{uuid.uuid4().hex[:10]}"


def keyed(spark, keys, **options):
    name = fresh("keyed")
    return KeyedTable(name, keys, path=shared_path(spark, "test", name), **options)


class Feed:
    """A stream of small frames: each ``put`` is one file, one micro-batch."""

    def __init__(self, spark, schema):
        self.spark, self.schema, self.path, self.n = spark, schema, shared_path(spark, "test", "feed"), 0

    def put(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").json(f"{self.path}/part{self.n:04d}")
        self.n += 1

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
        return reader.json(self.path)


def test_versioned_loads_newest_first(spark, sf_small):
    """Three loads of overlapping event ranges, the newest written first; key
    (event_id % 900, event_type with 'error' as NULL); load time from the file name."""
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    root = shared_path(spark, "test", "versioned")
    landing = f"{root}/landing"
    target = keyed(spark, ["k", "etype"], tie=["event_id"], num_buckets=4)

    def shape(bronze):
        parsed = bronze.select("ldts", F.from_json("worldData", "array<struct<event_id:bigint, event_type:string>>").alias("a"))
        rows = parsed.select("ldts", F.explode("a").alias("r"))
        return rows.select("ldts", (F.col("r.event_id") % 900).alias("k"),
                           F.nullif(F.col("r.event_type"), F.lit("error")).alias("etype"), F.col("r.event_id").alias("event_id"))

    for day, lo, hi in [(3, 600, 999), (1, 0, 399), (2, 300, 699)]:
        part = ev.where(F.col("event_id").between(lo, hi))
        doc = part.agg(F.collect_list(F.struct("event_id", "event_type")).alias("worldData"))
        write_landing(doc, landing, "load", dt.datetime(2026, 1, day))
        upsert_stream(bronze_stream(spark, landing, "encounters", "t", stamp_from_file_name()),
                      target, f"{root}/_chk", transform=shape)
    out = target.read(spark)
    assert out.count() == 977
    by_day = {r.d: r.n for r in out.groupBy(F.dayofmonth("ldts").alias("d")).agg(F.count("*").alias("n")).collect()}
    assert by_day == {3: 400, 2: 300, 1: 277}
    assert out.where("etype IS NULL").count() == 197
    # each landing file was consumed exactly once: a rerun with no new files changes nothing
    upsert_stream(bronze_stream(spark, landing, "encounters", "t", stamp_from_file_name()),
                  target, f"{root}/_chk", transform=shape)
    assert sorted(target.read(spark).collect()) == sorted(out.collect())


def test_stream_equals_batch(spark, sf_small):
    streamed = q.stream_latest_encounters(spark, sf_small)
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    landing = shared_path(spark, "test", "batch-landing")
    for day in q.LOAD_DAYS:
        shifted = ev.withColumn("value", F.col("value") + F.lit(float(3 - day)))
        q._land_encounters(spark, sf_small, shifted, dt.datetime(2026, 1, day), landing)
    bronze = attach_metadata(read_landing(spark, landing, "encounters"), q.SOURCE, stamp_from_file_name())
    batch = q._ntz(enc.deduplicate(enc.silver_clean(bronze)).drop("rsrc"), "ldts", "ranked_date")
    assert streamed.count() > 0
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_capped_micro_batches_equal_one_batch(spark, sf_small):
    """A pull larger than the per-batch file cap is taken in several micro-batches; the
    upsert result equals the batch newest-per-key of all files."""
    from rankforge.plans import guilds as gld
    from rankforge.sources import fixtures

    customer = spark.read.parquet(f"{sf_small}/customer.parquet")
    root = shared_path(spark, "test", "capped")
    landing = f"{root}/landing"
    for day in (2, 1):
        docs = fixtures.guild_documents(customer, as_text=False, tag=str(day)).select("guildData")
        write_landing(docs, landing, "guilds", dt.datetime(2026, 1, day), layout="document")
    target = keyed(spark, ["guild_id"], tie=gld.TIE_BREAK, num_buckets=4)
    stream = bronze_stream(spark, landing, "guilds", "t", stamp_from_file_name(), "document", max_files_per_trigger=1)
    upsert_stream(stream, target, f"{root}/_chk", transform=gld.silver_clean)
    assert tables.exists(spark, f"{root}/_chk/commits/3")          # 4 files, one per batch
    bronze = attach_metadata(read_landing(spark, landing, "guilds", layout="document"), "t", stamp_from_file_name())
    want = gld.deduplicate(gld.silver_clean(bronze))
    got = target.read(spark)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


ROWS = "key int, ver int, payload string"


def versions():
    return {d: [(k % 7, d, f"v{k}-{d}") for k in range(50)] for d in (1, 2, 3)}


@pytest.mark.parametrize("order", [(1, 2, 3), (3, 1, 2), (2, 3, 1)])
def test_upsert_does_not_depend_on_the_order_of_arrival(spark, order):
    feed, target = Feed(spark, ROWS), keyed(spark, ["key"], version="ver", tie=["payload"], num_buckets=3)
    for d in order:
        feed.put(versions()[d])
    upsert_stream(feed.stream(), target, shared_path(spark, "test", "chk"))
    got = sorted(target.read(spark).collect())
    assert len(got) == 7 and all(r.ver == 3 for r in got)
    assert [r.payload for r in got] == [max(f"v{k}-3" for k in range(50) if k % 7 == j) for j in range(7)]


def test_state_partitions_follow_the_cores_not_the_shuffle_width(spark):
    import os

    feed, target, chk = Feed(spark, ROWS), keyed(spark, ["key"], version="ver"), shared_path(spark, "test", "chk")
    width, most = "spark.sql.shuffle.partitions", 2 * spark.sparkContext.defaultParallelism
    before = spark.conf.get(width)
    try:
        spark.conf.set(width, str(most + 7))
        for ver in (1, 2):
            feed.put([(k, ver, f"v{ver}") for k in range(200)])
            upsert_stream(feed.stream(), target, chk)
            assert spark.conf.get(width) == str(most + 7)
    finally:
        spark.conf.set(width, before)
    parts = [d for d in os.listdir(f"{chk.replace('file:', '')}/state/0") if d.isdigit()]
    assert len(parts) == most
    assert sorted((r.key, r.ver) for r in target.read(spark).collect()) == [(k, 2) for k in range(200)]


def test_a_late_version_changes_nothing_and_touches_only_its_buckets(spark):
    import glob
    import os

    feed, target, chk = Feed(spark, ROWS), keyed(spark, ["key"], version="ver", bucket=F.col("key") % 3), shared_path(spark, "test", "chk")
    feed.put([(k, 5, "new") for k in range(9)])
    upsert_stream(feed.stream(), target, chk)
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{target.path.replace('file:', '')}/_bucket=*/*.parquet")}
    feed.put([(4, 1, "late"), (4, 6, "newest")])
    upsert_stream(feed.stream(), target, chk)
    feed.put([(7, 2, "late")])
    upsert_stream(feed.stream(), target, chk)
    assert sorted((r.key, r.ver, r.payload) for r in target.read(spark).collect()) == sorted(
        [(k, 5, "new") for k in range(9) if k != 4] + [(4, 6, "newest")])
    kept = {f for f in stamps if "_bucket=1/" not in f}
    assert kept and all(os.stat(f).st_mtime_ns == stamps[f] for f in kept)


@pytest.mark.parametrize("moment", ["before", "middle"])
def test_a_batch_that_crashes_is_run_again(spark, monkeypatch, moment):
    """The driver dies before the partitions are replaced, or after some are gone: the restarted
    query runs the batch again from its staged rows and loses none, not even of other keys."""
    feed, target, chk = Feed(spark, ROWS), keyed(spark, ["key"], version="ver", num_buckets=2), shared_path(spark, "test", "chk")
    feed.put([(k, 1, "old") for k in range(12)])
    upsert_stream(feed.stream(), target, chk)
    feed.put([(3, 2, "new")])

    def crash(merged, table):
        if moment == "middle":
            for r in merged.select(BUCKET).distinct().collect():
                tables.forget(spark, f"{table.path}/{BUCKET}={r[0]}")
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(up, "publish", crash)
        with pytest.raises(Exception, match="driver lost"):
            upsert_stream(feed.stream(), target, chk)
    feed.put([(5, 3, "after")])
    upsert_stream(feed.stream(), target, chk)
    got = {r.key: (r.ver, r.payload) for r in target.read(spark).collect()}
    assert got == {k: (1, "old") for k in range(12)} | {3: (2, "new"), 5: (3, "after")}


def test_a_new_checkpoint_keeps_what_the_table_holds(spark):
    """A new query starts with an empty state and batch 0; older versions that it meets do not win."""
    target = keyed(spark, ["key"], version="ver", num_buckets=3)
    first, second = Feed(spark, ROWS), Feed(spark, ROWS)
    first.put([(k, 5, "first") for k in range(7)])
    upsert_stream(first.stream(), target, shared_path(spark, "test", "chk"))
    second.put([(2, 6, "second"), (3, 4, "older")])
    upsert_stream(second.stream(), target, shared_path(spark, "test", "chk"))
    assert {r.key: r.ver for r in target.read(spark).collect()} == {k: 6 if k == 2 else 5 for k in range(7)}


def test_gold_follows_the_touched_buckets(spark):
    schema = "key int, ver int, value int"
    feed, chk = Feed(spark, schema), shared_path(spark, "test", "chk")
    silver, gold = keyed(spark, ["key"], version="ver", num_buckets=4), keyed(spark, ["key"])

    def make(rows, keep=()):
        return rows.where("value > 0").select("key", "value", *keep)

    def follow(rows):
        feed.put(rows)
        upsert_stream(feed.stream(), silver, chk, derived=(gold, make))

    follow([(k, 1, 1) for k in range(20)])
    assert gold.read(spark).count() == 20
    follow([(k, 2, -1) for k in range(20) if k != 3])   # rows leave gold, whole buckets too
    assert [tuple(r) for r in gold.read(spark).collect()] == [(3, 1)]
    follow([(5, 3, 9)])
    assert sorted(tuple(r) for r in gold.read(spark).collect()) == [(3, 1), (5, 9)]


def test_null_buckets_and_keys_and_pruning(spark):
    schema = "key int, day string, ver int, payload string"
    feed = Feed(spark, schema)
    target = keyed(spark, ["key", "day"], version="ver", bucket=F.regexp_replace("day", "-", ""))
    feed.put([(1, None, 1, "a"), (2, "2024-01-02", 1, "c"), (None, "2024-01-02", 1, "n")])
    feed.put([(1, None, 2, "b"), (None, "2024-01-02", 2, "m")])
    upsert_stream(feed.stream(), target, shared_path(spark, "test", "chk"))
    assert sorted((str(r.key), r.payload) for r in target.read(spark).collect()) == [("1", "b"), ("2", "c"), ("None", "m")]
    one = target.read(spark, with_bucket=True).where(f"{BUCKET} = 20240102")
    assert one.count() == 2 and "PartitionFilters: [isnotnull(_bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_a_table_keeps_its_rows_over_a_new_session_catalog(spark):
    target, chk = keyed(spark, ["key"], version="ver", num_buckets=3), shared_path(spark, "test", "chk")
    feed = Feed(spark, ROWS)
    feed.put([(k, 1, "x") for k in range(5)])
    upsert_stream(feed.stream(), target, chk)
    spark.sql(f"DROP TABLE {target.name}")            # what a catalog in memory forgets; the files stay
    feed.put([(1, 2, "y")])
    upsert_stream(feed.stream(), target, chk)
    assert {r.key: r.ver for r in target.read(spark).collect()} == {0: 1, 1: 2, 2: 1, 3: 1, 4: 1}


def test_a_hop_is_one_shuffle_by_key_and_reads_only_touched_buckets(spark, monkeypatch):
    """The merge of a batch: a partition-pruned scan of the table and the batch, one aggregate."""
    from pyspark.sql.readwriter import DataFrameWriter

    plans, real = [], DataFrameWriter.parquet

    def spy(self, path, *a, **k):
        plans.append((path, self._df._jdf.queryExecution().executedPlan().toString()))
        return real(self, path, *a, **k)

    feed, target, chk = Feed(spark, ROWS), keyed(spark, ["key"], version="ver", bucket=F.col("key") % 5), shared_path(spark, "test", "chk")
    feed.put([(k, 1, "x") for k in range(50)])
    upsert_stream(feed.stream(), target, chk)
    feed.put([(7, 2, "y")])
    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    upsert_stream(feed.stream(), target, chk)
    merged = [p for path, p in plans if path.endswith("/merged")]
    assert len(merged) == 1 and "partial_max" in merged[0] and re.search(r"PartitionFilters: \[[^\]]*_bucket", merged[0])
    assert tables.exists(spark, f"{chk}/state")


# ------------------------------------------------------------------ named tables
def test_a_table_can_be_read_while_a_hop_runs(spark):
    """The table is there, with its comment, before the first row and during every batch."""
    name, root = fresh("appended"), shared_path(spark, "test", "appended")
    spark.range(12).repartition(12).write.json(f"{root}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(f"{root}/in")
    create_table(spark, name, stream.schema, "it's a table", f"{root}/out")
    assert read_rows(spark, name).count() == 0
    seen, failed, stop = set(), [], threading.Event()

    def watch():
        while not stop.is_set():
            try:
                seen.add(read_rows(spark, name).count())
            except Exception as e:   # noqa: BLE001
                failed.append(str(e))

    watcher = threading.Thread(target=watch)
    watcher.start()
    append_to_table(stream, name, f"{root}/_chk", "another comment", f"{root}/out")
    stop.set()
    watcher.join()
    assert not failed and read_rows(spark, name).count() == 12 and seen <= set(range(13))
    assert spark.catalog.getTable(name).description == "it's a table"       # created once
    append_to_table(stream, name, f"{root}/_chk")
    assert read_rows(spark, name).count() == 12
    assert read_table_stream(spark, name).isStreaming


def test_rule_counts_cover_every_batch(spark):
    root, name, ledger = shared_path(spark, "test", "many"), fresh("checked"), fresh("ledger")
    spark.range(0, 104, 1, 8).write.json(f"{root}/in")
    stream = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).json(f"{root}/in")
    append_checked(stream, {"even": "id % 2 = 0"}, name, ledger, "q", f"{root}/_chk", None, f"{root}/out", f"{root}/ledger")
    assert [tuple(r) for r in ledger_totals(spark, ledger).collect()] == [("q", "even", 104, 52)]
    assert read_rows(spark, ledger).select("batch").distinct().count() == 8
    assert read_rows(spark, name).count() == 52


def test_a_query_stopped_midway_has_the_counts_of_all_batches_once(spark, monkeypatch):
    """The third batch dies after its rows are written, before its counts are: the restarted query
    replaces both, and the ledger holds every batch once."""
    root, name, ledger = shared_path(spark, "test", "stopped"), fresh("checked"), fresh("ledger")
    feed = Feed(spark, "id long")
    for n in range(5):
        feed.put([(i,) for i in range(10 * n, 10 * n + 10)])
    rules = {"even": "id % 2 = 0", "small": "id < 44"}
    run = lambda: append_checked(feed.stream(), rules, name, ledger, "q", f"{root}/_chk", None, f"{root}/out", f"{root}/ledger")
    real, calls = flows.Observation, []

    class Dies(real):
        @property
        def get(self):
            calls.append(1)
            if len(calls) == 3:
                raise RuntimeError("driver lost")
            return super().get

    with monkeypatch.context() as m:
        m.setattr(flows, "Observation", Dies)
        with pytest.raises(Exception, match="driver lost"):
            run()
    assert read_rows(spark, ledger).select("batch").distinct().count() == 2
    run()
    run()
    totals = {r.rule: (r.rows_tested, r.rows_failed) for r in ledger_totals(spark, ledger, "q").collect()}
    assert totals == {"even": (50, 25), "small": (50, 6)}
    assert sorted(r.id for r in read_rows(spark, name).collect()) == list(range(0, 44, 2))


def test_chained_hops_report_rule_failures(spark, sf_small):
    from rankforge.operators.quality import SILVER_ENCOUNTER_RULES, expectation_report
    from rankforge.sources import fixtures

    flow = q._versioned_encounter_flow(spark, sf_small)
    names = flow["tables"]
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    n_events = ev.count()
    for day in q.LOAD_DAYS:
        got = {r.rule: r for r in ledger_totals(spark, names["ledger"], f"silver_clean day {day}").collect()}
        shifted = ev.withColumn("value", F.col("value") + F.lit(float(3 - day)))
        docs = attach_metadata(fixtures.rank_documents(shifted).drop("_doc"), "t")
        report = {r.rule: r.rows_failed for r in expectation_report(q._clean_rows(docs), SILVER_ENCOUNTER_RULES).collect()}
        assert all(r.rows_tested == n_events and r.rows_failed == report[rule] for rule, r in got.items())
        assert set(got) == set(SILVER_ENCOUNTER_RULES)
    assert read_rows(spark, names["silver_clean"]).count() < 3 * n_events
    for layer, comment in q.COMMENTS.items():
        assert spark.catalog.getTable(names[layer]).description == comment


def test_lines_hold_many_documents_in_few_files(spark):
    import glob

    landing = shared_path(spark, "test", "lines")
    docs = spark.range(500).select(F.struct(F.col("id").alias("n"), F.lit("a\nb").alias("t")).alias("worldData"))
    folder = write_landing(docs.coalesce(2), landing, "many", dt.datetime(2026, 1, 1))
    assert len(glob.glob(f"{folder.replace('file:', '')}/*.json")) == 2
    back = read_landing(spark, landing, "encounters")
    assert back.select(F.get_json_object("worldData", "$.n").cast("int").alias("n")).distinct().count() == 500
    with pytest.raises(ValueError):
        read_landing(spark, landing, layout="csv")
