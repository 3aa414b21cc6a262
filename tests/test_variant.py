"""Documents parsed once: bronze holds a VARIANT, silver extracts the declared fields from it."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankforge import schemas
from rankforge import queries as q
from rankforge.operators.nested import explode_variant, typed_value
from rankforge.plans import encounters as enc
from rankforge.plans import guilds as gld
from rankforge.plans.quarantine import mark_broken, quarantined, readable
from rankforge.session import shared_path
from rankforge.sources.files import attach_metadata, read_landing

ENCOUNTERS = [
    '{"encounter":{"id":7,"name":"a b","characterRankings":{"rankings":['
    '{"name":"x","spec":"RedMage","amount":12.345,"aDPS":1,"startTime":1700000000123,"duration":61000,'
    '"lodestoneID":9007199254740993,"guild":{"id":3,"name":"g"},"server":{"id":1,"name":"s"},"more":[1,{}]},'
    '{"name":null,"amount":"no number","guild":null},null,{},{"name":"Ünï\\n\\"q\\"","amount":1e-3}]}}}',
    '{"encounter":{"id":8,"characterRankings":{"rankings":[]}}}',
    '{"encounter":{"id":9,"characterRankings":null}}',
    '{"encounter":{"id":9,"characterRankings":{"rankings":{"name":"no array"}}}}',
    '{"encounter":null}', '{}', None,
]
GUILDS = ['{"guilds":{"total":2,"data":[{"id":1,"name":" a  b ","description":"","server":{"id":4,"region":{"id":2}},'
          '"zoneRanking":{"progress":{"worldRank":{"number":5},"regionRank":null},"speed":null}},{"id":2}]}}', '{"guilds":{}}', None]


def _both(spark, texts, column):
    text = spark.createDataFrame([(t, dt.datetime(2026, 1, 1)) for t in texts], f"{column} string, ldts timestamp")
    return text, text.withColumn(column, F.try_parse_json(column))


@pytest.mark.parametrize("chain, texts, column", [(enc, ENCOUNTERS, "worldData"), (gld, GUILDS, "guildData")])
def test_same_rows_as_from_text(spark, chain, texts, column):
    text, parsed = _both(spark, texts, column)
    for step in (lambda d: chain.define(chain.unpack(d)), chain.silver_clean):
        want, got = step(text), step(parsed)
        assert got.schema.simpleString() == want.schema.simpleString()
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert chain.define(chain.unpack(text)).count() > 1


def test_no_text_is_parsed_after_bronze(spark):
    text, parsed = _both(spark, ENCOUNTERS, "worldData")
    place = shared_path(spark, "test", "variant")
    parsed.write.mode("overwrite").parquet(place)
    silver = enc.silver_clean(spark.read.schema(parsed.schema).parquet(place))
    plan = silver._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "from_json" not in plan and "parse_json" not in plan
    assert sorted(map(str, silver.collect())) == sorted(map(str, enc.silver_clean(text).collect()))


def test_a_broken_line_is_null_and_kept_as_text(spark):
    place = shared_path(spark, "test", "variant-lines") + "/pull_20260101_000000"
    lines = ['{"worldData":' + ENCOUNTERS[0] + "}", '{"worldData":{"encounter":{"id":', '{"worldData":null}', "{}"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(place)
    found = read_landing(spark, place, parsed=True, corrupt=True, file_filter="*.txt")
    assert isinstance(found.schema["worldData"].dataType, T.VariantType)
    rows = found.select("_corrupt_record", F.to_json("worldData").alias("kept")).collect()
    assert [r["_corrupt_record"] for r in rows if r["_corrupt_record"] is not None] == [lines[1]]
    assert [r["kept"] is None or r["kept"] == "null" for r in rows] == [False, True, True, True]
    assert enc.unpack(found).count() == 5


def test_values_of_another_type_are_converted_where_they_can(spark):
    kind = T.StructType.fromDDL("i int, s string, b boolean, n struct<x: int>, a array<int>")
    row = spark.sql("""SELECT parse_json('{"i":"7","s":5,"b":"maybe","n":3,"a":[1,2]}') AS v""").select(typed_value(F.col("v"), kind).alias("t"))
    assert row.select("t.*").first().asDict(recursive=True) == {"i": 7, "s": "5", "b": None, "n": {"x": None}, "a": [1, 2]}


def test_broken_documents_are_set_aside_as_from_text(spark):
    place = shared_path(spark, "test", "variant-broken") + "/pull_20260101_000000"
    lines = ['{"worldData":' + ENCOUNTERS[0] + "}", '{"worldData":{"encounter":{"id":', '{"worldData":5}', '{"worldData":[1,2]}',
             '{"worldData":"text"}', '{"worldData":null}', '{"worldData":{}}', "{}"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("overwrite").text(place)
    found = []
    for parsed in (False, True):
        rows = read_landing(spark, place, parsed=parsed, corrupt=True, file_filter="*.txt")
        marked = mark_broken(attach_metadata(rows, "test", F.lit(dt.datetime(2026, 1, 1))))
        found.append((sorted((r["broken"], r["document"]) for r in quarantined(marked).select("document", "broken", "ldts").collect()),
                      enc.silver_clean(readable(marked)).count()))
    # a payload that is a bare string comes without quotes as text, with them as the JSON of a VARIANT
    assert found[0][0] == [("line", lines[1]), ("payload", "5"), ("payload", "[1,2]"), ("payload", "text")]
    assert found[1][0] == [("line", lines[1]), ("payload", '"text"'), ("payload", "5"), ("payload", "[1,2]")]
    assert found[0][1] == found[1][1] > 0


def test_no_documents(spark):
    none = spark.createDataFrame([], T.StructType([T.StructField("worldData", T.VariantType())]))
    assert explode_variant(none, "worldData", "$.encounter.characterRankings.rankings", schemas.RANKING, "r").count() == 0
    assert enc.unpack(none).count() == 0


def test_streamed_variant_tables_give_the_same_rows(spark, sf_small):
    a, b = q.stream_silver_guilds_variant(spark, sf_small), q.stream_silver_guilds(spark, sf_small)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
