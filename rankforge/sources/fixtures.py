"""Adapters that shape the driver's tables into the landing documents the engine ingests.

Each adapter is a Spark job over a whole table: rows are grouped into documents of a
bounded size (at most 100 records), serialised to the same JSON text a landing file holds,
and returned as bronze-shaped rows. Nothing is made up outside the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RECORDS_PER_DOC = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Shuffle widths are the session's: adaptive execution coalesces small
    partitions, and a cluster sets ``spark.sql.shuffle.partitions`` for its largest input."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def with_faults(events: DataFrame) -> DataFrame:
    """Events that make every rule matter: each tenth event comes again under the same key
    with a higher value."""
    again = events.where(F.col("event_id") % 10 == 0).withColumn("value", F.col("value") + 1)
    return events.unionByName(again)


def ranking_records(events: DataFrame, faults: bool = False) -> DataFrame:
    """events -> (encounter id, document number, ranking record struct). With ``faults`` each
    thirteenth player has no name."""
    uid = F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("int")
    gid = uid % 50
    record = F.struct(
        F.when((uid % 13 != 0) | F.lit(not faults), F.concat(F.lit(" player\n "), uid.cast("string"))).alias("name"),
        F.concat(F.initcap("event_type"), F.lit("Mage")).alias("spec"),
        (F.col("value") - 5).alias("amount"),
        ((F.col("value") - 2) * 0.95).alias("aDPS"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("startTime"),
        (k * 90000 + 500).alias("duration"),
        (uid + 10000000).alias("lodestoneID"),
        F.when(uid % 7 != 0, F.struct(gid.alias("id"),
                                      F.concat(F.lit(" Guild  "), gid.cast("string")).alias("name"))
               ).alias("guild"),
        F.struct((uid % 8).cast("int").alias("id"),
                 F.concat(F.lit("srv "), (uid % 8).cast("string")).alias("name")).alias("server"),
    )
    return events.select((uid % 5 + 101).cast("int").alias("eid"),
                         F.floor(F.col("event_id") / RECORDS_PER_DOC).alias("doc"),
                         record.alias("rec"))


def rank_documents(events: DataFrame, as_text: bool = True, faults: bool = False) -> DataFrame:
    """One encounter-ranking document per (encounter, block of 100 event ids) in column
    ``worldData``: JSON text (bronze form) or the object itself (landing-file form).
    Records are sorted inside the document, so documents are deterministic. With ``faults``
    encounter 104 has no name and 105 no id."""
    recs = ranking_records(events, faults)
    docs = recs.groupBy("eid", "doc").agg(F.array_sort(F.collect_list("rec")).alias("rankings"))
    payload = F.struct(F.struct(
        F.when((F.col("eid") != 105) | F.lit(not faults), F.col("eid")).alias("id"),
        F.when((F.col("eid") != 104) | F.lit(not faults),
               F.concat(F.lit(" the  fight "), F.col("eid").cast("string"))).alias("name"),
        F.struct(F.lit(1).alias("id"), F.lit("zone").alias("name")).alias("zone"),
        F.struct(F.col("rankings").alias("rankings")).alias("characterRankings"),
    ).alias("encounter"))
    body = F.to_json(payload) if as_text else payload
    return docs.select(body.alias("worldData"), F.col("doc").alias("_doc"))


def guild_documents(customer: DataFrame, as_text: bool = True, tag: str | None = None) -> DataFrame:
    """One guild-list document per block of 100 customer keys in ``guildData`` (JSON text or
    object), records sorted by guild id. ``tag`` is appended to every non-blank description
    (to tell versions of one guild apart)."""
    k = F.col("c_custkey")

    def rank(cond, value):
        return F.when(cond, F.struct(value.cast("int").alias("number")))

    record = F.struct(
        k.cast("int").alias("id"),
        F.when(k % 11 == 0, F.lit(" \n ")).otherwise(F.concat(F.lit(" guild\n of  "), F.col("c_name"))).alias("name"),
        F.when(k % 3 == 0, F.lit("  ")).otherwise(
            F.concat(F.col("c_mktsegment"), F.lit("\r\n guild " + (tag or "")))).alias("description"),
        F.lit(0).alias("type"),
        F.when(k % 13 != 0, F.struct(F.col("c_nationkey").alias("id"),
                                     F.struct((F.col("c_nationkey") % 5).alias("id")).alias("region"))).alias("server"),
        F.when(k % 5 != 0, F.struct(
            F.struct(rank(k % 2 != 0, k % 150).alias("worldRank"),
                     rank(k % 3 == 0, k % 150 + 1).alias("regionRank")).alias("progress"),
            F.struct(rank(k % 3 != 0, k % 200).alias("worldRank"),
                     rank(k % 4 == 0, k % 200 + 1).alias("regionRank")).alias("speed"),
        )).alias("zoneRanking"),
    )
    docs = (customer.select(F.floor(k / RECORDS_PER_DOC).alias("doc"), record.alias("rec"))
            .groupBy("doc").agg(F.array_sort(F.collect_list("rec")).alias("data")))
    payload = F.struct(F.struct(F.lit(1500).alias("total"), F.lit(True).alias("has_more_pages"),
                                F.col("data").alias("data")).alias("guilds"))
    body = F.to_json(payload) if as_text else payload
    return docs.select(body.alias("guildData"), F.col("doc").alias("_doc"))


def cut_off(documents: DataFrame, column: str = "worldData", every: int = 7) -> DataFrame:
    """The same documents with the text of each ``every``-th document number (``_doc``) cut off
    in the middle, as an interrupted transfer leaves it."""
    half = F.expr(f"substring({column}, 1, cast(length({column}) / 2 as int))")
    return documents.withColumn(column, F.when(F.col("_doc") % every == 0, half).otherwise(F.col(column)))


def event_pages(events: DataFrame) -> DataFrame:
    """Paged pulls: (eid, page, arr) with ``arr`` the sorted event ids of one page."""
    return (events.select((F.col("user_id") % 5 + 101).cast("int").alias("eid"),
                          F.floor(F.col("event_id") / RECORDS_PER_DOC).alias("page"), "event_id")
            .groupBy("eid", "page").agg(F.array_sort(F.collect_list("event_id")).alias("arr"))
            .withColumn("title", F.concat(F.lit("pull "), F.col("page").cast("string"))))


def report_rows(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One report per order, its line items as fights.

    zone = order priority number, guild = customer key, report start = order date; a fight
    starts at the ship date and lasts ``quantity`` minutes. Heads are joined to the lines
    first and grouped after, so a selection on report columns (zone, guild, start) is
    pushed through the aggregate and the join to the orders scan, and only the lines of
    selected orders are grouped; a fight list is at most the lines of one order.
    """
    ship_ms = F.unix_millis(F.col("l_shipdate").cast("timestamp"))
    fight = F.struct(
        F.col("l_linenumber").alias("id"),
        (F.col("l_partkey") % 5 + 101).cast("int").alias("encounterID"),
        (F.col("l_returnflag") == "R").alias("kill"),
        ship_ms.alias("startTime"),
        (ship_ms + (F.col("l_quantity") * 60000).cast("bigint")).alias("endTime"),
        (F.col("l_suppkey") % 3 + 100).cast("int").alias("difficulty"),
        F.lit(8).alias("size"),
        (F.col("l_discount") * 100).alias("fightPercentage"),
        (F.col("l_tax") * 100).alias("bossPercentage"),
        (F.col("l_linenumber") % 3).cast("int").alias("lastPhase"),
        (F.col("l_linestatus") == "F").alias("lastPhaseIsIntermission"),
        F.lit(None).cast("bigint").alias("wipeCalledTime"),
        F.array(F.col("l_suppkey").cast("int")).alias("friendlyPlayers"),
    )
    lines = lineitem.select("l_orderkey", fight.alias("fight"))
    heads = orders.select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("R"), F.col("o_orderkey").cast("string")).alias("code"),
        F.concat(F.lit("report "), F.col("o_orderstatus")).alias("title"),
        F.substring_index("o_orderpriority", "-", 1).cast("int").alias("zone_id"),
        F.col("o_custkey").alias("guild_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("start_ms"))
    head_cols = ["code", "title", "zone_id", "guild_id", "start_ms"]
    return (heads.join(lines, "l_orderkey")
            .groupBy("l_orderkey", *head_cols).agg(F.collect_list("fight").alias("fights"))
            .drop("l_orderkey"))
