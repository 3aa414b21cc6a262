"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame computed from the
whole driver tables (or from files Spark writes from them). Their DuckDB twins live in
:mod:`rankforge.oracle`."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracle, schemas
from .functions import (date_text, epoch_to_timestamp, minutes_seconds, normalize_time_fields,
                        surrogate_key, to_title_case)
from .operators import analytics as an
from .operators.latest import latest_per_key
from .operators.nested import merged_envelopes, merged_positions
from .operators.ordinal import page_slice as _page_slice
from .operators.quality import SILVER_ENCOUNTER_RULES, SILVER_GUILD_RULES, expectation_report
from .plans import encounters as enc
from .plans import guilds as gld
from .plans.quarantine import RULES as QUARANTINE_RULES, document_report, mark_broken, quarantined, readable
from .plans.reports import (document_fights, matching_reports, report_documents, report_envelope, report_fights,
                            select_reports as _select_reports)
from .plans.stages import encounter_spec, guild_spec, stage_counts as _stage_counts
from .session import prepare, shared_path
from .sources import fixtures
from .sources.catalog import ensure_schemas, publish_view, read_table, save_table, use_schema
from .sources.files import (attach_metadata, landing_file_name, preview_sql, raw_preview as _raw_preview, read_landing,
                            stamp_from_file_name, write_landing)
from .streaming.flows import BATCH, Rejected, append_checked, append_to_table, bronze_stream, ledger_totals
from .streaming.tables import read_rows, read_table_stream
from .streaming.upsert import KeyedTable, upsert_stream

SOURCE = "rankforge"


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    """Timestamps leave as wall-clock ``timestamp_ntz`` (zone is UTC), like the tables."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return fixtures.table(spark, sf_dir, name)


# ---------------------------------------------------------------- bronze from the tables
def encounter_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.rank_documents(_t(spark, sf_dir, "events"))
    return attach_metadata(docs.drop("_doc"), SOURCE)


def guild_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = fixtures.guild_documents(_t(spark, sf_dir, "customer"))
    return attach_metadata(docs.drop("_doc"), SOURCE)


def _gold_enc(spark, sf_dir):
    return enc.gold(enc.deduplicate(enc.silver_clean(encounter_bronze(spark, sf_dir))))


# ---------------------------------------------------------------- chains
def silver_encounters(spark, sf_dir):
    return _ntz(enc.silver_clean(encounter_bronze(spark, sf_dir)).drop("ldts", "rsrc"), "ranked_date")


def gold_encounters(spark, sf_dir):
    return _gold_enc(spark, sf_dir)


def presentation(spark, sf_dir):
    """The presentation view (A9): a named temporary view over gold, read back by name."""
    return publish_view(enc.presentation(_gold_enc(spark, sf_dir)), "encounter_ranking_presentation",
                        "Ranked players with their fight time as minutes and seconds.")


def _faulty_bronze(spark, sf_dir):
    docs = fixtures.rank_documents(fixtures.with_faults(_t(spark, sf_dir, "events")), faults=True)
    return attach_metadata(docs.drop("_doc"), SOURCE)


def silver_encounters_faults(spark, sf_dir):
    """Newest per key over documents with repeated keys, players and encounters without a name
    and encounters without an id."""
    silver = enc.deduplicate(enc.silver_clean(_faulty_bronze(spark, sf_dir)))
    return _ntz(silver.drop("ldts", "rsrc"), "ranked_date")


def gold_encounters_faults(spark, sf_dir):
    return enc.gold(enc.deduplicate(enc.silver_clean(_faulty_bronze(spark, sf_dir))))


def _cut_off_bronze(spark, sf_dir):
    docs = fixtures.cut_off(fixtures.rank_documents(_t(spark, sf_dir, "events")))
    return mark_broken(attach_metadata(docs.drop("_doc"), SOURCE))


def quarantine(spark, sf_dir):
    """Documents of which each seventh is cut off: how many are set aside, by reason, with what
    is left of them still readable as text."""
    kept = quarantined(_cut_off_bronze(spark, sf_dir))
    return kept.groupBy("broken", "rsrc").agg(F.count(F.lit(1)).alias("documents"),
                                              F.count_if(F.col("document").startswith('{"encounter":{')).alias("with_text"))


def quarantine_report(spark, sf_dir):
    return document_report(_cut_off_bronze(spark, sf_dir))


def silver_encounters_readable(spark, sf_dir):
    """Silver of the documents that could be read."""
    silver = enc.silver_clean(readable(_cut_off_bronze(spark, sf_dir)))
    return _ntz(silver.drop("ldts", "rsrc"), "ranked_date")


def silver_guilds(spark, sf_dir):
    return gld.silver_clean(guild_bronze(spark, sf_dir)).drop("ldts", "rsrc")


def gold_guilds(spark, sf_dir):
    return gld.gold(gld.deduplicate(gld.silver_clean(guild_bronze(spark, sf_dir))))


# ---------------------------------------------------------------- files, SQL, catalog
PULL_DAY = dt.datetime(2026, 1, 1)


def _land_encounters(spark, sf_dir, events=None, when=PULL_DAY, landing=None, layout="lines"):
    landing = landing or shared_path(spark, "landing", "encounters")
    events = events if events is not None else _t(spark, sf_dir, "events")
    write_landing(fixtures.rank_documents(events, as_text=False).select("worldData"),
                  landing, "encounter_ranking", when, layout)
    return landing


def _scan(spark, sf_dir, layout):
    landing = _land_encounters(spark, sf_dir, layout=layout)
    bronze = attach_metadata(read_landing(spark, landing, "encounters", layout=layout), SOURCE, stamp_from_file_name())
    silver_c = enc.silver_clean(bronze)
    return _ntz(silver_c.drop("rsrc"), "ldts", "ranked_date")


def scan_json_lines(spark, sf_dir):
    """Land the documents as lines, many in a file, scan them back (declared schema, payload
    kept as text), load time from the pull stamp, then silver."""
    return _scan(spark, sf_dir, "lines")


def scan_json_multiline(spark, sf_dir):
    """The same with one multi-line document per file."""
    return _scan(spark, sf_dir, "document")


def scan_variant(spark, sf_dir):
    """Land the documents as lines and parse them once: bronze keeps the payload as a VARIANT, in
    files, and silver extracts the declared fields from it without parsing text."""
    landing = _land_encounters(spark, sf_dir)
    bronze = attach_metadata(read_landing(spark, landing, "encounters", parsed=True), SOURCE, stamp_from_file_name())
    place = shared_path(spark, "bronze", "variant")
    bronze.write.mode("overwrite").parquet(place)
    return _ntz(enc.silver_clean(spark.read.schema(bronze.schema).parquet(place)).drop("rsrc"), "ldts", "ranked_date")


def sql_preview(spark, sf_dir):
    """The SQL preview of landed guild documents: all columns but the one for broken lines,
    the first five documents by their first guild."""
    landing = shared_path(spark, "landing", "guilds")
    write_landing(fixtures.guild_documents(_t(spark, sf_dir, "customer"), as_text=False).select("guildData"),
                  landing, "guilds", PULL_DAY)
    schema = schemas.landing_schema("guilds", as_text=False).add("_corrupt_record", "string")
    found = preview_sql(spark, landing, SOURCE, schema=schema, order=["guildData.guilds.data[0].id"])
    return found.select(F.lit(",".join(found.columns)).alias("preview_columns"), "rsrc",
                        F.col("guildData.guilds.total").alias("total"), F.size("guildData.guilds.data").alias("records"),
                        F.col("guildData.guilds.data")[0]["id"].alias("first_id"))


def schema_setup(spark, sf_dir):
    """Create the three namespaces in the shared warehouse folder, publish gold guilds as a
    table there and read it back through the catalog."""
    names = ensure_schemas(spark, "rankforge_", location=shared_path(spark, "warehouse"))
    gold = gold_guilds(spark, sf_dir)
    table = f"`{names[2]}`.guilds_gold"
    save_table(gold, table, comment="Guild ranks, newest load per guild.")
    previous = spark.catalog.currentDatabase()
    use_schema(spark, names[2])
    try:
        return read_table(spark, "guilds_gold")   # resolved now, in the gold namespace
    finally:
        use_schema(spark, previous)


def raw_preview(spark, sf_dir):
    docs = fixtures.guild_documents(_t(spark, sf_dir, "customer"))
    pre = _raw_preview(docs.select("guildData", F.col("_doc").alias("doc")), "guilds", 3)
    return pre.select("doc", F.col("guildData.guilds.total").alias("total"),
                      F.col("guildData.guilds.has_more_pages").alias("has_more_pages"),
                      F.posexplode("guildData.guilds.data").alias("pos", "s")
                      ).select("doc", "total", "has_more_pages", "pos", F.col("s.id").alias("guild_id"),
                               F.col("s.name").alias("guild_name"))


def stage_counts(spark, sf_dir):
    raw = fixtures.guild_documents(_t(spark, sf_dir, "customer")).drop("_doc")
    return _stage_counts(raw, guild_spec(SOURCE))


def stage_counts_encounters(spark, sf_dir):
    """The encounter chain through the stage runner: raw documents -> bronze -> silver
    (all rules, newest per key) -> gold (projection and gold rules)."""
    raw = fixtures.rank_documents(_t(spark, sf_dir, "events")).drop("_doc")
    return _stage_counts(raw, encounter_spec(SOURCE))


# ---------------------------------------------------------------- page merge / slice / keys
def merge_pages(spark, sf_dir):
    pages = fixtures.event_pages(_t(spark, sf_dir, "events"))
    return merged_positions(pages, ["eid"], "page", "arr", value_name="event_id")


def merge_envelopes(spark, sf_dir):
    pages = fixtures.event_pages(_t(spark, sf_dir, "events"))
    return merged_envelopes(pages, ["eid"], "page", "arr", ["title"])


def page_slice(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return _page_slice(customer, [F.col("c_acctbal").desc(), "c_custkey"], offset=1, limit=5, per_page=100)


def surrogate_keys(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    return c.select("c_custkey", surrogate_key("c_custkey", "c_nationkey", "c_mktsegment").alias("surrogate_key"))


def latest_events(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return latest_per_key(ev, ["user_id", "event_type"], "ts", ["event_id"])


# ---------------------------------------------------------------- scalar functions
def title_case(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        to_title_case(F.concat(F.initcap("event_type"), F.lit("Mage")), "pascal").alias("pascal"),
        to_title_case(F.concat("event_type", F.lit("__dark_knight")), "snake").alias("snake"),
        to_title_case(F.concat("event_type", F.lit("--white-mage")), "kebab").alias("kebab"))


def time_functions(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    ts = F.col("ts").cast("timestamp")
    k = F.get_json_object("props", "$.k").cast("int")
    base = ev.select(
        "event_id",
        epoch_to_timestamp(F.unix_seconds(ts), "s").alias("from_s"),
        epoch_to_timestamp(F.unix_millis(ts), "MS").alias("from_ms"),
        epoch_to_timestamp(F.unix_micros(ts), " us ").alias("from_us"),
        F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias("start_time"),
        (F.col("event_id") * 1000).alias("end_time"),
        date_text(ts).alias("day"),
        minutes_seconds(k * 61).alias("mmss"))
    return _ntz(normalize_time_fields(base), "from_s", "from_ms", "from_us")


# ---------------------------------------------------------------- quality
def expectation_report_encounters(spark, sf_dir):
    cleaned = enc.clean(enc.define(enc.unpack(encounter_bronze(spark, sf_dir))))
    return expectation_report(cleaned, SILVER_ENCOUNTER_RULES)


def expectation_report_guilds(spark, sf_dir):
    cleaned = gld.clean(gld.define(gld.unpack(guild_bronze(spark, sf_dir))))
    return expectation_report(cleaned, SILVER_GUILD_RULES)


# ---------------------------------------------------------------- streaming
LOAD_DAYS = (3, 1, 2)  # arrival order: the newest pull lands first


def _clean_rows(bronze: DataFrame) -> DataFrame:
    return enc.clean(enc.define(enc.unpack(bronze)))


# Comments of the streamed tables.
COMMENTS = {
    "bronze": "Landed encounter documents as text, with load time and source.",
    "silver_clean": "Parsed and cleaned rankings that pass the silver rules.",
    "silver": "Newest ranking of each encounter, player, class and time.",
    "gold": "Rankings for analysis, by name.",
}
PARSED_COMMENT = "Landed encounter documents as VARIANT, parsed once, with load time and source."


def _versioned_encounter_flow(spark, sf_dir, days=LOAD_DAYS, parsed=False):
    """Three pulls of the whole table land one after another; after each, the chained
    stream hops run to completion in order (availableNow), each reading the table of the one
    before by its name: landing -> bronze -> silver-clean (parse, explode, clean, rules with
    their counts) -> silver (upsert) and gold. Silver and gold are bucketed by ranking day, so a
    pull of recent rankings replaces recent days only. With ``parsed`` the scan is the only parse:
    bronze holds the documents as VARIANT."""
    events = _t(spark, sf_dir, "events")
    root = shared_path(spark, "stream", "encounters")
    landing, suffix = f"{root}/landing", f"encounters_{root.rsplit('-', 1)[-1]}"
    name = {layer: f"{layer}_{suffix}" for layer in (*COMMENTS, "ledger")}
    target = KeyedTable(name["silver"], schemas.ENCOUNTER_KEYS, "ldts", enc.TIE_BREAK, F.date_format("ranked_date", "yyyyMMdd"),
                        comment=COMMENTS["silver"], path=f"{root}/silver")
    gold = KeyedTable(name["gold"], ["encounter_name", "player_name", "class", "ranked_date"],
                      comment=COMMENTS["gold"], path=f"{root}/gold")
    for day in days:
        shifted = events.withColumn("value", F.col("value") + F.lit(float(3 - day)))
        _land_encounters(spark, sf_dir, shifted, dt.datetime(2026, 1, day), landing)
        append_to_table(bronze_stream(spark, landing, "encounters", SOURCE, stamp_from_file_name(), parsed=parsed), name["bronze"],
                        f"{root}/_chk/bronze", PARSED_COMMENT if parsed else COMMENTS["bronze"], f"{root}/bronze")
        append_checked(_clean_rows(read_table_stream(spark, name["bronze"])), SILVER_ENCOUNTER_RULES, name["silver_clean"],
                       name["ledger"], f"silver_clean day {day}", f"{root}/_chk/silver_clean", COMMENTS["silver_clean"],
                       f"{root}/silver_clean", f"{root}/ledger")
        upsert_stream(read_table_stream(spark, name["silver_clean"]).drop(BATCH), target, f"{root}/_chk/silver",
                      derived=(gold, enc.gold))
    return {"root": root, "tables": name, "silver": target, "gold": gold}


def stream_bronze(spark, sf_dir):
    bronze = read_rows(spark, _versioned_encounter_flow(spark, sf_dir)["tables"]["bronze"])
    recs = F.size(F.from_json("worldData", "encounter struct<characterRankings: struct<rankings: array<string>>>")
                  ["encounter"]["characterRankings"]["rankings"])
    return _ntz(bronze.groupBy("ldts").agg(F.count(F.lit(1)).alias("documents"),
                                           F.sum(recs).alias("records")), "ldts")


def stream_silver(spark, sf_dir):
    cleaned = read_rows(spark, _versioned_encounter_flow(spark, sf_dir)["tables"]["silver_clean"])
    return _ntz(cleaned.drop("rsrc", BATCH), "ldts", "ranked_date")


def stream_silver_variant(spark, sf_dir):
    """The silver-clean table of a chain whose bronze table holds VARIANT documents."""
    cleaned = read_rows(spark, _versioned_encounter_flow(spark, sf_dir, parsed=True)["tables"]["silver_clean"])
    return _ntz(cleaned.drop("rsrc", BATCH), "ldts", "ranked_date")


def stream_latest_encounters(spark, sf_dir):
    silver = _versioned_encounter_flow(spark, sf_dir)["silver"].read(spark)
    return _ntz(silver.drop("rsrc"), "ldts", "ranked_date")


def stream_gold_encounters(spark, sf_dir):
    """Gold kept by the stream: after each batch the ranking days that it touched."""
    return _versioned_encounter_flow(spark, sf_dir)["gold"].read(spark)


def stream_rule_counts(spark, sf_dir):
    """Rows tested and failed by each rule of the silver hop, of each pull, from the ledger."""
    flow = _versioned_encounter_flow(spark, sf_dir)
    totals = ledger_totals(spark, flow["tables"]["ledger"])
    return totals.select(F.element_at(F.split("query", " "), -1).cast("int").alias("day"), "rule", "rows_tested", "rows_failed")


def stream_bronze_table(spark, sf_dir):
    """The bronze table by its name: its comment and its documents of each load."""
    name = _versioned_encounter_flow(spark, sf_dir)["tables"]["bronze"]
    comment = spark.catalog.getTable(name).description
    return _ntz(read_rows(spark, name).groupBy("ldts").agg(F.count(F.lit(1)).alias("documents"))
                .withColumn("comment", F.lit(comment)), "ldts")


def stream_table_comments(spark, sf_dir):
    """Every table of the encounter chain by its name: comment and rows."""
    tables = _versioned_encounter_flow(spark, sf_dir)["tables"]
    parts = [read_rows(spark, tables[layer]).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(layer).alias("layer"), F.lit(spark.catalog.getTable(tables[layer]).description).alias("comment"), "rows")
             for layer in COMMENTS]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


def _quarantine_flow(spark, sf_dir):
    """Two pulls of which some lines are cut off, landed as text: readable documents go to bronze,
    the others to a quarantine table, counts to the ledger, all in the write of a micro-batch."""
    root = shared_path(spark, "stream", "quarantine")
    suffix = root.rsplit("-", 1)[-1]
    names = {t: f"{t}_{suffix}" for t in ("bronze_read", "quarantine", "ledger_read")}
    docs = fixtures.rank_documents(_t(spark, sf_dir, "events"), as_text=False)
    lines = fixtures.cut_off(docs.select(F.to_json(F.struct("worldData")).alias("worldData"), "_doc")).select("worldData")
    for day in (1, 2):
        lines.write.text(f"{root}/landing/{landing_file_name('encounters', dt.datetime(2026, 1, day))[:-5]}")
        stream = bronze_stream(spark, f"{root}/landing", "encounters", SOURCE, stamp_from_file_name(), file_filter="*.txt", corrupt=True)
        append_checked(mark_broken(stream), QUARANTINE_RULES, names["bronze_read"], names["ledger_read"], "bronze",
                       f"{root}/_chk/bronze", "Landed documents that can be read.", f"{root}/bronze", f"{root}/ledger", readable,
                       Rejected(names["quarantine"], quarantined, "Landed documents that cannot be read.", f"{root}/quarantine"))
    return names


def stream_quarantine(spark, sf_dir):
    """What the quarantine table holds of each load, beside the documents that went on."""
    names = _quarantine_flow(spark, sf_dir)
    parts = [read_rows(spark, names[t]).groupBy("ldts").agg(F.count(F.lit(1)).alias("documents")).withColumn("went_to", F.lit(t))
             for t in ("bronze_read", "quarantine")]
    return _ntz(parts[0].unionByName(parts[1]), "ldts")


def stream_quarantine_counts(spark, sf_dir):
    """The ledger of the same hop: documents tested and failed."""
    return ledger_totals(spark, _quarantine_flow(spark, sf_dir)["ledger_read"])


def _guild_tables(root):
    suffix = f"guilds_{root.rsplit('-', 1)[-1]}"
    silver = KeyedTable(f"silver_{suffix}", ["guild_id"], "ldts", gld.TIE_BREAK, num_buckets=16,
                        comment="Newest load of each guild.", path=f"{root}/silver")
    gold = KeyedTable(f"gold_{suffix}", ["guild_id"], num_buckets=16, comment="Guild ranks.", path=f"{root}/gold")
    return f"bronze_{suffix}", silver, gold


def stream_latest_guilds(spark, sf_dir):
    customer = _t(spark, sf_dir, "customer")
    root = shared_path(spark, "stream", "guilds")
    landing = f"{root}/landing"
    _, target, _ = _guild_tables(root)
    for day in LOAD_DAYS:
        docs = fixtures.guild_documents(customer, as_text=False, tag=str(day)).select("guildData")
        write_landing(docs, landing, "guilds", dt.datetime(2026, 1, day))
        upsert_stream(bronze_stream(spark, landing, "guilds", SOURCE, stamp_from_file_name()),
                      target, f"{root}/_chk/silver", transform=gld.silver_clean)
    return _ntz(target.read(spark).drop("rsrc"), "ldts")


def _chained_guild_flow(spark, sf_dir, parsed=False):
    """The guild chain with its bronze table: each pull lands, the landing -> bronze hop
    appends it (raw text, or a VARIANT when ``parsed``, + load metadata), and the bronze -> silver
    hop parses, cleans, checks and upserts it by guild id."""
    customer = _t(spark, sf_dir, "customer")
    root = shared_path(spark, "stream", "guild-chain")
    landing = f"{root}/landing"
    bronze, target, gold = _guild_tables(root)
    for day in LOAD_DAYS:
        docs = fixtures.guild_documents(customer, as_text=False, tag=str(day)).select("guildData")
        write_landing(docs, landing, "guilds", dt.datetime(2026, 1, day))
        append_to_table(bronze_stream(spark, landing, "guilds", SOURCE, stamp_from_file_name(), parsed=parsed), bronze,
                        f"{root}/_chk/bronze", f"Landed guild documents as {'VARIANT' if parsed else 'text'}, with load time and source.",
                        f"{root}/bronze")
        upsert_stream(read_table_stream(spark, bronze), target, f"{root}/_chk/silver",
                      transform=gld.silver_clean, derived=(gold, gld.gold))
    return bronze, target, gold


def stream_bronze_guilds(spark, sf_dir):
    bronze = read_rows(spark, _chained_guild_flow(spark, sf_dir)[0])
    recs = F.size(F.from_json("guildData", "guilds struct<data: array<string>>")["guilds"]["data"])
    return _ntz(bronze.groupBy("ldts").agg(F.count(F.lit(1)).alias("documents"),
                                           F.sum(recs).alias("records")), "ldts")


def stream_silver_guilds(spark, sf_dir):
    return _ntz(_chained_guild_flow(spark, sf_dir)[1].read(spark).drop("rsrc"), "ldts")


def stream_silver_guilds_variant(spark, sf_dir):
    """The same from a bronze table that holds the documents as VARIANT."""
    return _ntz(_chained_guild_flow(spark, sf_dir, parsed=True)[1].read(spark).drop("rsrc"), "ldts")


def stream_gold_guilds(spark, sf_dir):
    """Gold kept by the stream: after each batch the buckets that it touched."""
    return _chained_guild_flow(spark, sf_dir)[2].read(spark)


# ---------------------------------------------------------------- analytics
def feature_select(spark, sf_dir):
    return an.select_features(_gold_enc(spark, sf_dir), ["class", "rDPS", "aDPS", "duration"],
                              {"encounter_name": "The Fight 103"})


def bootstrap_sample(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    return an.bootstrap_sample(ev, ["event_id"], n=100, seed=42)


def bootstrap_repeated(spark, sf_dir):
    """A sample of rows of which many share a key (five event types)."""
    return an.bootstrap_sample(_t(spark, sf_dir, "events"), ["event_type"], n=250, seed=7, tie=["user_id", "event_id"])


def least_squares(spark, sf_dir):
    fit = an.least_squares(_gold_enc(spark, sf_dir), "rDPS", "aDPS", ["encounter_name", "class"])
    return fit.select("encounter_name", "class", F.round("m", 6).alias("m"), F.round("b", 6).alias("b"), "n")


def r_squared(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    fit = an.least_squares(ev, "user_id", "value", ["event_type"], round_decimal=2)
    r2 = an.r_squared(ev, fit, "user_id", "value", ["event_type"])
    # values have 2 decimals and the rounded line 2 as well, so each squared residual has 4
    # and sse_reg is exact at 4 decimals: rounding it to 3 would land on ties
    return r2.select("event_type", "m", "b", F.round("sse_base", 3).alias("sse_base"),
                     F.round("sse_reg", 4).alias("sse_reg"), "r2")


def fit_report(spark, sf_dir):
    # the sample takes two passes: the chain runs once, its narrow rows are written
    gold = _gold_enc(spark, sf_dir).select("encounter_name", "player_name", "class", "ranked_date", "rDPS", "aDPS", "duration").checkpoint()
    sample = an.bootstrap_sample(gold, ["encounter_name", "player_name", "class", "ranked_date"], 100, 42,
                                 tie=["rDPS", "aDPS", "duration"])
    rep = an.fit_report(sample, "rDPS", "aDPS", [], round_decimal=2)
    return rep.select("m", "b", F.round("sse_base", 3).alias("sse_base"),
                      F.round("sse_reg", 3).alias("sse_reg"), "r2", "n")


def _event_fit(spark, sf_dir):
    ev = _t(spark, sf_dir, "events")
    fit = an.least_squares(ev, "user_id", "value", ["event_type"])
    return an.fit_points(fit, ev, "user_id", ["event_type"], 100)


def fit_points(spark, sf_dir):
    pts = _event_fit(spark, sf_dir)
    return pts.select("event_type", "i", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


def line_from_points(spark, sf_dir):
    line = an.line_from_points(_event_fit(spark, sf_dir), ["event_type"])
    return line.select("event_type", F.round("m", 6).alias("m"), F.round("b", 6).alias("b"))


def damage_probability(spark, sf_dir):
    p = an.damage_probability(_gold_enc(spark, sf_dir), 50.0, "rDPS", ["encounter_name", "class"])
    return p.select("encounter_name", "class", *[F.round(c, 6).alias(c) for c in ("empirical", "mean", "sd")],
                    "n", F.round("normal_tail", 6).alias("normal_tail"))


def joint_probability(spark, sf_dir):
    """rDPS and/or aDPS of one job in one encounter."""
    p = an.joint_probability(_gold_enc(spark, sf_dir), {"rDPS": 50.0, "aDPS": 60.0}, "The Fight 103", "Purchase Mage")
    return p.select("encounter_name", "class", "n", *[F.round(c, 6).alias(c) for c in ("p_all", "p_any", "corr", "normal_all", "normal_any")])


def joint_normal_tail(spark, sf_dir):
    """Value and user id of every event type together: measures that hardly correlate."""
    rows = _t(spark, sf_dir, "events").select("event_type", (F.col("user_id") + 0.0).alias("user"), "value")
    p = an.joint_probability(rows, {"user": 40.0, "value": 60.0}, group=["event_type"])
    return p.select("event_type", "n", *[F.round(c, 6).alias(c) for c in ("p_all", "p_any", "corr", "normal_all", "normal_any")])


# ---------------------------------------------------------------- reports
def select_reports(spark, sf_dir):
    reports = fixtures.report_rows(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    chosen = _select_reports(reports, *_report_window(), zone_id=1, encounter_id=103, page=2, limit=50)
    return report_fights(chosen)


def _report_window():
    start = int(dt.datetime(1995, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    end = int(dt.datetime(1996, 1, 1, tzinfo=dt.timezone.utc).timestamp() * 1000)
    return start, end


def report_envelopes(spark, sf_dir):
    """The envelope of page 2 of 50 of the zone's reports."""
    reports = fixtures.report_rows(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    return report_envelope(matching_reports(reports, *_report_window(), zone_id=1), page=2, limit=50)


def report_document_fights(spark, sf_dir):
    """The zone's reports landed as pages of 50, scanned back and unnested to their fights."""
    reports = fixtures.report_rows(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    landing = shared_path(spark, "landing", "reports")
    write_landing(report_documents(matching_reports(reports, *_report_window(), zone_id=1), 50), landing, "reports", PULL_DAY)
    return document_fights(read_landing(spark, landing, "reports"))


def select_guild_reports(spark, sf_dir):
    """All fights of one guild's reports."""
    reports = fixtures.report_rows(_t(spark, sf_dir, "orders"), _t(spark, sf_dir, "lineitem"))
    return report_fights(_select_reports(reports, 0, 4_102_444_800_000, guild_id=100))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "silver_encounters": silver_encounters,
    "gold_encounters": gold_encounters,
    "presentation": presentation,
    "silver_encounters_faults": silver_encounters_faults,
    "gold_encounters_faults": gold_encounters_faults,
    "quarantine": quarantine,
    "quarantine_report": quarantine_report,
    "silver_encounters_readable": silver_encounters_readable,
    "stream_quarantine": stream_quarantine,
    "stream_quarantine_counts": stream_quarantine_counts,
    "silver_guilds": silver_guilds,
    "gold_guilds": gold_guilds,
    "scan_json_lines": scan_json_lines,
    "scan_json_multiline": scan_json_multiline,
    "scan_variant": scan_variant,
    "sql_preview": sql_preview,
    "schema_setup": schema_setup,
    "raw_preview": raw_preview,
    "stage_counts": stage_counts,
    "stage_counts_encounters": stage_counts_encounters,
    "merge_pages": merge_pages,
    "merge_envelopes": merge_envelopes,
    "page_slice": page_slice,
    "surrogate_key": surrogate_keys,
    "latest_per_key": latest_events,
    "title_case": title_case,
    "time_functions": time_functions,
    "expectation_report": expectation_report_encounters,
    "expectation_report_guilds": expectation_report_guilds,
    "stream_bronze": stream_bronze,
    "stream_silver": stream_silver,
    "stream_silver_variant": stream_silver_variant,
    "stream_latest_encounters": stream_latest_encounters,
    "stream_gold_encounters": stream_gold_encounters,
    "stream_rule_counts": stream_rule_counts,
    "stream_bronze_table": stream_bronze_table,
    "stream_table_comments": stream_table_comments,
    "stream_latest_guilds": stream_latest_guilds,
    "stream_bronze_guilds": stream_bronze_guilds,
    "stream_silver_guilds": stream_silver_guilds,
    "stream_silver_guilds_variant": stream_silver_guilds_variant,
    "stream_gold_guilds": stream_gold_guilds,
    "feature_select": feature_select,
    "bootstrap_sample": bootstrap_sample,
    "bootstrap_repeated": bootstrap_repeated,
    "least_squares": least_squares,
    "r_squared": r_squared,
    "fit_report": fit_report,
    "fit_points": fit_points,
    "line_from_points": line_from_points,
    "damage_probability": damage_probability,
    "joint_probability": joint_probability,
    "joint_normal_tail": joint_normal_tail,
    "report_envelopes": report_envelopes,
    "select_guild_reports": select_guild_reports,
    "report_document_fights": report_document_fights,
    "select_reports": select_reports,
}

ORACLE_SQL: dict[str, str] = {
    "silver_encounters": oracle.SILVER_ENCOUNTERS,
    "gold_encounters": oracle.GOLD_ENCOUNTERS,
    "presentation": oracle.PRESENTATION,
    "silver_encounters_faults": oracle.SILVER_ENCOUNTERS_FAULTS,
    "gold_encounters_faults": oracle.GOLD_ENCOUNTERS_FAULTS,
    "quarantine": oracle.QUARANTINE,
    "quarantine_report": oracle.QUARANTINE_REPORT,
    "silver_encounters_readable": oracle.SILVER_ENCOUNTERS_READABLE,
    "stream_quarantine": oracle.STREAM_QUARANTINE,
    "stream_quarantine_counts": oracle.STREAM_QUARANTINE_COUNTS,
    "silver_guilds": oracle.SILVER_GUILDS,
    "gold_guilds": oracle.GOLD_GUILDS,
    "scan_json_lines": oracle.SCAN_JSON_LINES,
    "scan_json_multiline": oracle.SCAN_JSON_MULTILINE,
    "scan_variant": oracle.SCAN_JSON_LINES,                # same rows, parsed once
    "sql_preview": oracle.SQL_PREVIEW,
    "schema_setup": oracle.SCHEMA_SETUP,
    "raw_preview": oracle.RAW_PREVIEW,
    "stage_counts": oracle.STAGE_COUNTS,
    "stage_counts_encounters": oracle.STAGE_COUNTS_ENCOUNTERS,
    "merge_pages": oracle.MERGE_PAGES,
    "merge_envelopes": oracle.MERGE_ENVELOPES,
    "page_slice": oracle.PAGE_SLICE,
    "surrogate_key": oracle.SURROGATE_KEY,
    "latest_per_key": oracle.LATEST_PER_KEY,
    "title_case": oracle.TITLE_CASE,
    "time_functions": oracle.TIME_FUNCTIONS,
    "expectation_report": oracle.ENC_RULE_SQL,
    "expectation_report_guilds": oracle.GUILD_RULE_SQL,
    "stream_bronze": oracle.STREAM_BRONZE,
    "stream_silver": oracle.STREAM_SILVER,
    "stream_latest_encounters": oracle.STREAM_LATEST_ENCOUNTERS,
    "stream_gold_encounters": oracle.STREAM_GOLD_ENCOUNTERS,
    "stream_rule_counts": oracle.STREAM_RULE_COUNTS,
    "stream_bronze_table": oracle.STREAM_BRONZE_TABLE,
    "stream_table_comments": oracle.STREAM_TABLE_COMMENTS,
    "stream_latest_guilds": oracle.STREAM_LATEST_GUILDS,
    "stream_bronze_guilds": oracle.STREAM_BRONZE_GUILDS,
    "stream_silver_guilds": oracle.STREAM_LATEST_GUILDS,   # same rows through the bronze table
    "stream_silver_variant": oracle.STREAM_SILVER,
    "stream_silver_guilds_variant": oracle.STREAM_LATEST_GUILDS,
    "stream_gold_guilds": oracle.STREAM_GOLD_GUILDS,
    "feature_select": oracle.FEATURE_SELECT,
    "bootstrap_sample": oracle.BOOTSTRAP_SAMPLE,
    "bootstrap_repeated": oracle.BOOTSTRAP_REPEATED,
    "least_squares": oracle.LEAST_SQUARES,
    "r_squared": oracle.R_SQUARED,
    "fit_report": oracle.FIT_REPORT,
    "fit_points": oracle.FIT_POINTS,
    "line_from_points": oracle.LINE_FROM_POINTS,
    "damage_probability": oracle.DAMAGE_PROBABILITY,
    "joint_probability": oracle.JOINT_PROBABILITY,
    "joint_normal_tail": oracle.JOINT_NORMAL_TAIL,
    "report_envelopes": oracle.REPORT_ENVELOPES,
    "select_guild_reports": oracle.SELECT_GUILD_REPORTS,
    "report_document_fights": oracle.REPORT_DOCUMENT_FIGHTS,
    "select_reports": oracle.SELECT_REPORTS,
}
