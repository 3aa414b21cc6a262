"""Landing files, SQL preview, raw preview, namespaces, stage runner."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from rankforge.plans import guilds as gld
from rankforge.plans.stages import guild_spec, run_pipeline, run_stages, stage_counts
from rankforge.session import shared_path
from rankforge.sources.catalog import ensure_schemas, read_table, save_table
from rankforge.sources.files import (attach_metadata, landing_file_name, preview_sql, raw_preview,
                                     read_landing, stamp_from_file_name, write_landing)

from test_chains import GUILDS, guild_doc


def test_documents_land_in_a_folder_per_task(spark):
    """One document per file, without a checksum file or a move by the driver for each; a second
    pull under the same stamp is added; null fields are left out as Spark's writer does."""
    landing, when = shared_path(spark, "test", "landing"), dt.datetime(2024, 6, 1, 12, 30, 5)
    docs = spark.range(40).repartition(4).select(
        F.struct("id", F.when(F.col("id") % 2 == 0, F.lit("\u00e9\n")).alias("name")).alias("worldData"))
    for _ in range(2):
        target = write_landing(docs, landing, "pull", when, "document").replace("file:", "")
    assert len([f for f in os.listdir(target) if not f.startswith(("_", "."))]) <= 8
    files = [os.path.join(d, f) for d, _, fs in os.walk(target) for f in fs if f != "_SUCCESS"]
    assert len(files) == 80 and all(f.endswith(".json") for f in files)
    plain = [r.value for r in docs.select(F.to_json(F.struct("worldData")).alias("value")).collect()]
    assert sorted(open(f, encoding="utf-8").read() for f in files) == sorted(t + "\n" for t in 2 * plain)
    back = attach_metadata(read_landing(spark, landing, layout="document"), "src", stamp_from_file_name()).collect()
    assert len(back) == 80 and {r.ldts for r in back} == {when}


def test_a_failed_write_of_documents_leaves_none(spark):
    landing = shared_path(spark, "test", "landing")
    docs = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id").cast("string"))
                                  .alias("worldData"))
    with pytest.raises(Exception, match="broken"):
        write_landing(docs, landing, "pull", dt.datetime(2024, 6, 1), "document")
    assert read_landing(spark, landing, layout="document").count() == 0


def test_documents_are_read_in_lists_of_files(spark):
    """Tasks follow the bytes and the cores, not the number of files; all are read, with the file
    each came from, and the landing column is the only one shown."""
    landing, when = shared_path(spark, "test", "landing"), dt.datetime(2024, 6, 1, 12, 30, 5)
    docs = spark.range(1_500).repartition(3).select(F.struct("id").alias("worldData"))
    write_landing(docs, landing, "pull", when, "document")
    narrow = {"spark.sql.files.maxPartitionBytes": "16m", "spark.sql.files.openCostInBytes": "4m"}
    before = {name: spark.conf.get(name) for name in narrow}
    try:
        for name, value in narrow.items():
            spark.conf.set(name, value)
        found = read_landing(spark, landing, layout="document")
        assert found.columns == ["worldData"]
        assert found.rdd.getNumPartitions() <= max(spark.sparkContext.defaultParallelism, 2)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    rows = found.select("worldData", "_metadata.file_path", "_metadata.file_size", stamp_from_file_name().alias("ldts")).collect()
    assert sorted(int(r.worldData[6:-1]) for r in rows) == list(range(1_500)) and {r.ldts for r in rows} == {when}
    assert len({r.file_path for r in rows}) == 1_500
    assert all(os.path.getsize(r.file_path.removeprefix("file:")) == r.file_size for r in rows)


def test_odd_documents_are_read_as_by_sparks_reader(spark):
    """Text as it stands in the file; lists, blanks, broken files, encodings, hidden names."""
    landing = shared_path(spark, "test", "odd").removeprefix("file:")
    docs = {"plain": b'{"worldData": { "a" :  1.10 , "b":[1e3, 0.30000000000000004441,"\\u00e9"] }}\n',
            "lines": b'{\n "x": 1,\n "worldData": {\n  "a": "l\xc3\xa9"\n }\n}\n', "empty": b"", "blank": b" \n\t ",
            "list": b'[{"worldData": {"a": 1}}, {"worldData":2}, {}]', "no items": b" [ ] ", "null item": b"[null]",
            "mixed": b'[{"worldData":1}, 5]', "lists": b'[[{"worldData":1}]]', "cut list": b'[{"worldData":1}, {"worldData":',
            "text": b'{"worldData":"t\\u00e9xt \\n \\ud800 x"}', "number": b'{"worldData": 1.50 }', "null": b'{"worldData":null}',
            "other": b'{"other":1}', "none": b"{}", "twice": b'{"worldData":1,"worldData":{"b": 2}}', "case": b'{"WORLDDATA":1}',
            "cut": b'{"worldData":{"a":1', "open": b'{"worldData":{"a":1}', "no json": b"{this is not", "scalar": b"5",
            "two": b'{"worldData":1}{"worldData":2}', "more": b'{"worldData":{"a":1}} more', "quotes": b"{'worldData': 'x'}",
            "nan": b'{"worldData":{"a":NaN}}', "zero": b'{"worldData":01}', "tab": b'{"worldData":"a\tb"}',
            "latin": b'{"worldData":{"a":"\xe9"}}', "mark": b'\xef\xbb\xbf{"worldData": {"a": 1}}', "only mark": b"\xef\xbb\xbf",
            "utf16": '{"worldData":{"a":"\u00e9"}}'.encode("utf-16"), "utf32": '{"worldData":"\u00e9"}'.encode("utf-32"),
            "comma": b'{"worldData":1,}', "deep": b'{"worldData":' + b"[" * 1500 + b"]" * 1500 + b"}",
            "digits": b'{"worldData":' + b"1" * 1500 + b"}", "many": b'{"worldData":[' + b'{"a": [] }, ' * 2000 + b"{}]}",
            "sp ace%\u00e9": b'{"worldData":7}', "_hidden": b'{"worldData":8}', ".hidden": b'{"worldData":9}', "_a=b": b'{"worldData":10}'}
    for folder in ("p_20240601_123005", "_left", "_k=1/sub"):
        os.makedirs(f"{landing}/{folder}")
        for name, data in docs.items():
            with open(f"{landing}/{folder}/{name}.json", "wb") as out:
                out.write(data)
    plain = spark.read.schema("worldData string").option("multiLine", True).option("recursiveFileLookup", True)
    found, known = ([tuple(r) for r in frame.select("worldData", "_metadata", stamp_from_file_name()).collect()]
                    for frame in (read_landing(spark, landing, layout="document"),
                                  plain.option("pathGlobFilter", "*.json").json(landing)))
    assert sorted(map(repr, found)) == sorted(map(repr, known))
    assert len(found) > 60 and any(r[0] == '{ "a" :  1.10 , "b":[1e3, 0.30000000000000004441,"\\u00e9"] }' for r in found)


def test_landing_roundtrip_one_document_per_file(spark):
    landing = shared_path(spark, "test", "landing")
    docs = spark.createDataFrame([(i, [i, i + 1]) for i in range(6)], "id int, arr array<int>")
    docs = docs.select(F.struct("id", "arr").alias("worldData"))
    target = write_landing(docs, landing, "pull", dt.datetime(2024, 6, 1, 12, 30, 5))
    folder = target.replace("file:", "")
    files = [f for f in os.listdir(folder) if f.endswith(".json") and os.path.getsize(os.path.join(folder, f))]
    assert len(files) == 6                            # (an empty task may leave an empty file)
    back = attach_metadata(read_landing(spark, landing), "src", stamp_from_file_name())
    rows = back.collect()
    assert len(rows) == 6 and all(r.ldts == dt.datetime(2024, 6, 1, 12, 30, 5) for r in rows)
    assert all(r.rsrc == "src" for r in rows)
    assert landing_file_name("x", dt.datetime(2024, 1, 2, 3, 4, 5)) == "x_20240102_030405.json"


def test_corrupt_landing_file_gives_null_payload(spark):
    landing = shared_path(spark, "test", "corrupt")
    os.makedirs(landing, exist_ok=True)
    with open(os.path.join(landing, "bad_20240101_000000.json"), "w") as fh:
        fh.write("{this is not json")
    rows = read_landing(spark, landing).collect()
    assert len(rows) <= 1 and all(r.worldData is None for r in rows)


def test_preview_sql_drops_one_column_and_limits(spark):
    landing = shared_path(spark, "test", "preview")
    docs = spark.createDataFrame([(i, f"n{i}") for i in range(9)], "id int, name string")
    write_landing(docs.select(F.struct("id", "name").alias("guildData"), F.col("id").alias("dropme")),
                  landing, "g", dt.datetime(2024, 1, 1))
    out = preview_sql(spark, landing, "src", drop="dropme")
    assert out.columns == ["guildData", "ldts", "rsrc"] and out.count() == 5


def test_raw_preview_first_three_records(spark):
    docs = spark.createDataFrame([(guild_doc(GUILDS),)], "guildData string")
    row = raw_preview(docs, "guilds", 3).first()
    assert [g.id for g in row.guildData.guilds.data] == [41, 42, 43]
    assert row.guildData.guilds.total == 2


def test_schemas_and_tables(spark):
    names = ensure_schemas(spark, "t_", location=shared_path(spark, "test", "wh"))
    assert names == ["t_bronze", "t_silver", "t_gold"]
    ensure_schemas(spark, "t_")                       # idempotent
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    save_table(df, "t_gold.tiny", comment="it's tiny")
    assert read_table(spark, "t_gold.tiny").collect() == [(1, "a")]


def test_stage_runner_order_and_contract(spark):
    raw = spark.createDataFrame([(guild_doc(GUILDS),)], "guildData string")
    frames = run_pipeline(raw, guild_spec("src"))
    assert {name: df.count() for name, df in frames.items()} == {"raw": 1, "bronze": 1, "silver": 3, "gold": 3}
    counts = {r.stage: r.rows for r in stage_counts(raw, guild_spec("src")).collect()}
    assert counts == {"raw": 1, "bronze": 1, "silver": 3, "gold": 3}
    with pytest.raises(ValueError):
        run_stages(None, {"define": gld.define, "clean": gld.clean})
    with pytest.raises(ValueError):
        run_stages(raw, {"define": gld.define})
    with pytest.raises(ValueError):
        run_stages(raw, {"define": gld.define, "clean": gld.clean, "bogus": gld.clean})


def test_preview_sql_with_declared_schema(spark):
    from rankforge import schemas
    landing = shared_path(spark, "test", "preview2")
    docs = spark.createDataFrame([(guild_doc(GUILDS),)], "t string").select(
        F.from_json("t", schemas.GUILD_DATA).alias("guildData"))
    write_landing(docs, landing, "g", dt.datetime(2024, 1, 1))
    out = preview_sql(spark, landing, "src", schema=schemas.landing_schema("guilds", as_text=False))
    row = out.first()
    assert out.columns == ["guildData", "ldts", "rsrc"] and row.guildData.guilds.data[0].id == 41


def test_stage_counts_run_the_chain_once(spark):
    """Every raw document is read once for all four counts."""
    reads = spark.sparkContext.accumulator(0)
    raw = spark.createDataFrame([(guild_doc(GUILDS),)] * 5, "guildData string")
    watched = raw.mapInArrow(lambda batches: ((reads.add(b.num_rows), b)[1] for b in batches), raw.schema)
    assert [tuple(r) for r in stage_counts(watched, guild_spec("src")).collect()] == [
        (0, "raw", 5), (1, "bronze", 5), (2, "silver", 3), (3, "gold", 3)]
    assert reads.value == 5


def test_broken_documents_are_kept_and_counted(spark):
    """A cut-off line, a cut-off payload and a payload of another kind are set aside with their
    text; an empty document, a null one and one with a malformed field are not."""
    from rankforge.plans.quarantine import document_report, mark_broken, quarantined, readable

    good = guild_doc(GUILDS)
    bad_field = good.replace('"total": 2', '"total": "many"') if '"total": 2' in good else good
    rows = [good, good[:len(good) // 2], "not json", "[1, 2", None, "{}", bad_field, "", '"text"']
    folder = shared_path(spark, "test", "broken")
    bronze = attach_metadata(spark.createDataFrame([(r,) for r in rows], "guildData string"), "src")
    marked = mark_broken(bronze, "guilds")
    aside = quarantined(marked, "guilds")
    assert {r.document for r in aside.collect()} >= {good[:len(good) // 2], "not json", "[1, 2"}
    assert all(r.broken == "payload" and r.rsrc == "src" and r.ldts is not None for r in aside.collect())
    went_on = {r.guildData for r in readable(marked).collect()}
    assert {good, None, "{}", bad_field} <= went_on and readable(marked).columns == bronze.columns
    report = {r.rule: (r.rows_tested, r.rows_failed) for r in document_report(marked).collect()}
    assert report["readable_document"] == (len(rows), aside.count())
    lines = ['{"guildData": {"guilds": {"total": 1}}}', '{"guildData": {"guilds": {"to', '{"guildData": 5}', "{}"]
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(folder)
    landed = mark_broken(attach_metadata(read_landing(spark, folder, "guilds", file_filter="*.txt", corrupt=True), "s"), "guilds")
    found = {r.document: r.broken for r in quarantined(landed, "guilds").collect()}
    assert found[lines[1]] == "line" and lines[0] not in found
    assert readable(landed).count() + len(found) == 4
