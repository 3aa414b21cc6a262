"""Guild chain: bronze text -> silver-clean -> silver (newest per guild) -> gold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import empty_to_null, trim_whitespace
from ..operators.latest import latest_per_key
from ..operators.nested import explode_records, explode_variant, flatten
from ..operators.quality import GOLD_GUILD_RULES, SILVER_GUILD_RULES, expect_or_drop

META = ["ldts", "rsrc"]

# Payload path of each silver field (the data contract).
GUILD_FIELDS = {
    "guild_id": "s.id",
    "guild_name": "s.name",
    "guild_description": "s.description",
    "server_id": "s.server.id",
    "region_id": "s.server.region.id",
    "world_prog_rank": "s.zoneRanking.progress.worldRank.number",
    "region_prog_rank": "s.zoneRanking.progress.regionRank.number",
    "world_speed_rank": "s.zoneRanking.speed.worldRank.number",
    "region_speed_rank": "s.zoneRanking.speed.regionRank.number",
}

RANKS = ["world_prog_rank", "region_prog_rank", "world_speed_rank", "region_speed_rank"]
GOLD_COLUMNS = ["guild_id", "guild_name", "guild_description", "server_id", "region_id", *RANKS]
TIE_BREAK = ["guild_name", "guild_description", "server_id", "region_id", *RANKS]


def _meta(df: DataFrame) -> list[str]:
    return [c for c in META if c in df.columns]


def unpack(bronze: DataFrame, text_col: str = "guildData") -> DataFrame:
    """Explode the guilds of a document, held as text or as a VARIANT."""
    if isinstance(bronze.schema[text_col].dataType, T.VariantType):
        return explode_variant(bronze, text_col, "$.guilds.data", schemas.GUILD, "s", carry=_meta(bronze))
    parsed = bronze.select(*_meta(bronze), F.from_json(F.col(text_col), schemas.GUILD_DATA).alias("g"))
    return explode_records(parsed, "g.guilds.data", "s", carry=_meta(bronze))


def define(unpacked: DataFrame) -> DataFrame:
    return flatten(unpacked, GUILD_FIELDS, keep=_meta(unpacked))


def clean(defined: DataFrame) -> DataFrame:
    """Whitespace is normalised *then* capitalised (``foo\\nbar`` gives ``Foo Bar``);
    empty text becomes NULL."""
    return defined.select(
        *_meta(defined),
        F.col("guild_id").cast("int").alias("guild_id"),
        empty_to_null(F.initcap(trim_whitespace("guild_name"))).alias("guild_name"),
        empty_to_null(trim_whitespace("guild_description")).alias("guild_description"),
        F.col("server_id").cast("int").alias("server_id"),
        F.col("region_id").cast("int").alias("region_id"),
        *[F.col(c).cast("int").alias(c) for c in RANKS],
    )


def expect(cleaned: DataFrame, observation=None, rules=None) -> DataFrame:
    return expect_or_drop(cleaned, rules or SILVER_GUILD_RULES, observation)


def silver_clean(bronze: DataFrame, text_col: str = "guildData", observation=None) -> DataFrame:
    return expect(clean(define(unpack(bronze, text_col))), observation)


def deduplicate(silver_c: DataFrame) -> DataFrame:
    return latest_per_key(silver_c, schemas.GUILD_KEYS, schemas.VERSION_COLUMN, TIE_BREAK)


def gold(silver: DataFrame, observation=None, keep: list[str] = ()) -> DataFrame:
    """Gold projection and rules; ``keep`` names further columns that pass through."""
    return expect_or_drop(silver.select(*GOLD_COLUMNS, *keep), GOLD_GUILD_RULES, observation)
