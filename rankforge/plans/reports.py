"""Report selection: zone, guild, start-time window, optional encounter (applied to the
nested fight list), page and page size -- the remote query's filters as a Spark plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..operators.nested import explode_records
from ..operators.ordinal import page_slice, with_ordinal


def matching_reports(reports: DataFrame, start_ms: float, end_ms: float, zone_id: int | None = None,
                     guild_id: int | None = None) -> DataFrame:
    """Reports whose start lies in ``[start_ms, end_ms)`` (half-open), in the given zone and
    guild when set."""
    cond = (F.col("start_ms") >= F.lit(start_ms)) & (F.col("start_ms") < F.lit(end_ms))
    if zone_id is not None:
        cond = cond & (F.col("zone_id") == F.lit(zone_id))
    if guild_id is not None:
        cond = cond & (F.col("guild_id") == F.lit(guild_id))
    return reports.where(cond)


def select_reports(reports: DataFrame, start_ms: float, end_ms: float, zone_id: int | None = None,
                   guild_id: int | None = None, encounter_id: int | None = None,
                   page: int = 1, limit: int = 100) -> DataFrame:
    """Page ``page`` (1-based) of ``limit`` of the matching reports, ordered by start then code;
    the fights of each kept report are narrowed to ``encounter_id`` when set."""
    if page < 1 or limit < 1:
        raise ValueError("page and limit must be >= 1")
    kept = matching_reports(reports, start_ms, end_ms, zone_id, guild_id)
    if encounter_id is not None:
        kept = kept.withColumn("fights", F.filter("fights", lambda f: f["encounterID"] == F.lit(encounter_id)))
    return page_slice(kept, ["start_ms", "code"], page - 1, 1, limit)


def report_envelope(matching: DataFrame, page: int = 1, limit: int = 100) -> DataFrame:
    """The envelope of one page, one row: ``total`` matching reports, ``per_page``,
    ``current_page``, ``last_page`` (at least 1) and ``has_more_pages``."""
    if page < 1 or limit < 1:
        raise ValueError("page and limit must be >= 1")
    last = F.greatest(F.ceil(F.col("total") / limit), F.lit(1)).cast("bigint")
    return (matching.agg(F.count(F.lit(1)).alias("total"))
            .select("total", F.lit(limit).alias("per_page"), F.lit(page).alias("current_page"),
                    last.alias("last_page"), (F.lit(page) < last).alias("has_more_pages")))


def report_fights(selected: DataFrame) -> DataFrame:
    """One row per kept fight."""
    return (selected.select("code", "title", "zone_id", "guild_id", "start_ms", "page",
                            F.explode("fights").alias("f"))
            .select("code", "title", "zone_id", "guild_id", "start_ms", "page",
                    F.col("f.id").alias("fight_id"), F.col("f.encounterID").alias("encounter_id"),
                    F.col("f.kill").alias("kill"), F.col("f.startTime").alias("fight_start"),
                    F.col("f.endTime").alias("fight_end")))


def report_documents(matching: DataFrame, limit: int = 100) -> DataFrame:
    """The pages of a pull as documents: one row per page of ``limit`` matching reports (ordered
    by start, then code) with its envelope and reports, in ``reportData``."""
    numbered = with_ordinal(matching.select("start_ms", "code", "title", "fights"), [], ["start_ms", "code"], "n")
    last = F.greatest(F.ceil(F.col("total") / limit), F.lit(1)).cast("int")
    pages = numbered.groupBy(F.floor(F.col("n") / limit).cast("bigint").alias("page")).agg(
        F.array_sort(F.collect_list(F.struct("n", F.struct("code", "title", "fights").alias("report")))).alias("rows"))
    total = numbered.agg(F.count(F.lit(1)).cast("int").alias("total"))
    return pages.join(F.broadcast(total)).select(F.struct(F.struct(
        "total", last.alias("last_page"), (F.col("page") + 1 < last).alias("has_more_pages"),
        F.transform("rows", lambda r: r["report"]).alias("data")).alias("reports")).alias("reportData"))


def document_fights(documents: DataFrame) -> DataFrame:
    """Landed report documents (JSON text) -> one row per fight, with the page's envelope."""
    parsed = documents.select(F.from_json("reportData", schemas.REPORTS_DATA).alias("d"))
    envelope = [F.col(f"d.reports.{c}").alias(c) for c in ("total", "last_page", "has_more_pages")]
    reports = explode_records(parsed, "d.reports.data", "r", carry=envelope)
    fights = explode_records(reports, "r.fights", "f", carry=["total", "last_page", "has_more_pages",
                                                              F.col("r.code").alias("code"), F.col("r.title").alias("title")])
    return fights.select("total", "last_page", "has_more_pages", "code", "title", F.col("f.id").alias("fight_id"),
                         F.col("f.encounterID").alias("encounter_id"), F.col("f.kill").alias("kill"))
