"""Encounter and guild chains on the sample documents and the edge rows of FIXTURES.md."""

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from rankforge.plans import encounters as enc
from rankforge.plans import guilds as gld
from rankforge.sources.files import attach_metadata

LDTS = dt.datetime(2026, 1, 1)


def ranking(**over):
    # name, class, times and numbers chosen to hit capitals, word split, rounding and truncation
    rec = {"name": "quill  of\tTHE fen", "spec": "BlueOtter", "amount": 310.125, "aDPS": 299.996,
           "startTime": 1709251199999, "duration": 61999, "lodestoneID": 9007199254,
           "guild": {"id": 70000000001, "name": "the  lamp\nlighters"}, "server": {"id": 3, "name": "north pier"}}
    rec.update(over)
    return rec


def world(rankings, eid=1, name="the SUNKEN hall (hard)"):
    return json.dumps({"encounter": {"id": eid, "name": name, "zone": {"id": 1, "name": "z"},
                                     "characterRankings": {"rankings": rankings}}})


def bronze(spark, texts, column="worldData", ldts=LDTS):
    df = spark.createDataFrame([(t,) for t in texts], f"{column} string")
    return attach_metadata(df, "test", F.lit(ldts).cast("timestamp"))


def test_one_document_end_to_end(spark):
    silver = enc.silver_clean(bronze(spark, [world([ranking()])])).collect()
    assert len(silver) == 1
    r = silver[0]
    assert (r.encounter_id, r.encounter_name, r.player_name, r["class"]) == \
        (1, "The Sunken Hall (hard)", "Quill Of the Fen", "Blue Otter")  # capitals: after blanks only
    assert math.isclose(r.rDPS, 310.13, rel_tol=1e-6) and math.isclose(r.aDPS, 300.0) and r.duration == 61
    assert (r.guild_id, r.guild_name, r.server_name) == (70000000001, "the lamp lighters", "North Pier")
    assert r.ranked_date == dt.datetime(2024, 2, 29, 23, 59, 59) and r.lodestoneID == 9007199254
    pres = enc.presentation(enc.gold(enc.deduplicate(enc.silver_clean(bronze(spark, [world([ranking()])]))))).first()
    assert (pres.ranked_date, pres.duration_fmt) == ("2024-02-29", "01:01")


def test_empty_null_missing_rankings_and_bad_json_give_no_rows(spark):
    texts = [world([]), world(None), json.dumps({"encounter": {"id": 1}}), "{not json", None]
    assert enc.silver_clean(bronze(spark, texts)).count() == 0


def test_edge_rows(spark):
    rows = [
        ranking(name="bad duration", duration="abc"),                 # field NULL -> dropped
        ranking(name="no guild", guild=None, server=None),            # kept, NULL children
        ranking(name=" \n "),                                         # '' kept (not NULL)
        ranking(name="foo\nbar"),                                     # Foo bar
        ranking(name="tiny", amount=0.004),                           # rounds to 0 -> dropped
        ranking(name="short", duration=900),                          # 0 s -> dropped
        ranking(name="long", duration=6_000_000),                     # 10:00 when formatted
        ranking(name="subsecond", startTime=1709251200999),
    ]
    out = {r.player_name: r for r in enc.silver_clean(bronze(spark, [world(rows)])).collect()}
    assert set(out) == {"No Guild", "", "Foo bar", "Long", "Subsecond"}
    assert out["No Guild"].guild_id is None and out["No Guild"].server_name is None
    assert out["Subsecond"].ranked_date == dt.datetime(2024, 3, 1)
    pres = enc.presentation(enc.gold(enc.silver_clean(bronze(spark, [world([ranking(duration=6_000_000)])])))).first()
    assert pres.duration_fmt == "10:00"


def test_nan_amount_passes_by_default(spark):
    # JSON has no NaN literal; NaN arrives from a NaN float in a typed frame
    df = spark.createDataFrame([(float("nan"), 5, "p")], "rDPS float, duration int, player_name string")
    df = df.withColumns({"aDPS": F.lit(1.0), "encounter_id": F.lit(1)})
    assert enc.expect(df).count() == 1


def test_same_key_twice_and_late_older_version(spark):
    newer = bronze(spark, [world([ranking(amount=200.0), ranking(amount=100.0)])], ldts=dt.datetime(2026, 1, 2))
    older = bronze(spark, [world([ranking(amount=999.0)])], ldts=dt.datetime(2026, 1, 1))
    silver = enc.deduplicate(enc.silver_clean(older.unionByName(newer))).collect()
    assert len(silver) == 1 and math.isclose(silver[0].rDPS, 200.0)


def test_null_class_is_its_own_key(spark):
    docs = [world([ranking(spec=None), ranking(spec=None, amount=5.0), ranking()])]
    silver = enc.deduplicate(enc.silver_clean(bronze(spark, docs))).collect()
    assert sorted(str(r["class"]) for r in silver) == ["Blue Otter", "None"]


def guild_doc(data):
    return json.dumps({"guilds": {"total": 2, "has_more_pages": False, "data": data}})


def ranks(progress=None, speed=None):
    """A zone ranking; each side is (world rank, region rank), None where not ranked."""
    def side(pair):
        return None if pair is None else {k: None if n is None else {"number": n}
                                          for k, n in zip(("worldRank", "regionRank"), pair)}
    return {"progress": side(progress), "speed": side(speed)}


GUILDS = [
    {"id": 41, "name": "tin\r\nwhistles", "description": "late \t night\n", "type": 0,
     "server": {"id": 9, "region": {"id": 4}}, "zoneRanking": ranks((7, 2), (31, 12))},
    {"id": 42, "name": "salt road", "description": "x", "type": 0,
     "server": {"id": 9, "region": {"id": 4}}, "zoneRanking": None},
    {"id": 43, "name": "foo\nbar", "description": " ", "type": 0,
     "server": {"id": 2, "region": {"id": 1}}, "zoneRanking": ranks(None, (None, 3))},
    {"id": 44, "name": " \n ", "description": None, "type": 0,
     "server": {"id": 2, "region": {"id": 1}}, "zoneRanking": {"progress": {"worldRank": {"number": 1}}}},
]


def test_guild_document_and_edges(spark):
    silver = {r.guild_id: r for r in gld.silver_clean(bronze(spark, [guild_doc(GUILDS)], "guildData")).collect()}
    assert set(silver) == {41, 43, 44}            # 42 has no ranking at all
    g = silver[41]
    assert (g.guild_name, g.guild_description, g.world_prog_rank, g.region_speed_rank) == \
        ("Tin Whistles", "late night", 7, 12)
    assert silver[43].guild_name == "Foo Bar" and silver[43].guild_description is None
    assert silver[44].guild_name is None
    gold = {r.guild_id for r in gld.gold(gld.deduplicate(gld.silver_clean(
        bronze(spark, [guild_doc(GUILDS)], "guildData")))).collect()}
    assert gold == {41, 43}                       # NULL name dropped at gold


def test_presentation_detail_variant(spark):
    gold = enc.gold(enc.silver_clean(bronze(spark, [world([ranking(duration=6_000_000)])])))
    short = enc.presentation(gold)
    full = enc.presentation(gold, truncate=False, detail=True).first()
    assert "duration" not in short.columns
    assert (full.duration_fmt, full.duration, full.lodestoneID) == ("100:00", 6000, 9007199254)
