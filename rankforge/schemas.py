"""Payload schemas (declared, never inferred) and the bronze row layout.

Every field is nullable, as in the source payloads: a ``null`` object or a malformed field
becomes NULL and the rest of the record survives ``from_json``. Field names, types and nesting
are fixed values: the contract of the payloads.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _s(*fields: T.StructField) -> T.StructType:
    return T.StructType(list(fields))


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True)


# ----- encounter ranking document: worldData -> encounter -> characterRankings -> rankings[]
RANKING = _s(
    _f("name", T.StringType()),
    _f("spec", T.StringType()),
    _f("amount", T.FloatType()),
    _f("aDPS", T.FloatType()),
    _f("startTime", T.LongType()),
    _f("duration", T.IntegerType()),
    _f("lodestoneID", T.LongType()),
    _f("guild", _s(_f("id", T.LongType()), _f("name", T.StringType()))),
    _f("server", _s(_f("id", T.IntegerType()), _f("name", T.StringType()))),
)

WORLD_DATA = _s(
    _f("encounter", _s(
        _f("id", T.IntegerType()),
        _f("name", T.StringType()),
        _f("characterRankings", _s(_f("rankings", T.ArrayType(RANKING, True)))),
    ))
)

# ----- guild list document: guildData -> guilds -> data[]
_RANK_NUMBER = _s(_f("number", T.IntegerType()))
_RANK_PAIR = _s(_f("worldRank", _RANK_NUMBER), _f("regionRank", _RANK_NUMBER))

GUILD = _s(
    _f("id", T.IntegerType()),
    _f("name", T.StringType()),
    _f("description", T.StringType()),
    _f("server", _s(_f("id", T.IntegerType()), _f("region", _s(_f("id", T.IntegerType()))))),
    _f("zoneRanking", _s(_f("progress", _RANK_PAIR), _f("speed", _RANK_PAIR))),
)

GUILD_DATA = _s(
    _f("guilds", _s(
        _f("total", T.IntegerType()),
        _f("has_more_pages", T.BooleanType()),
        _f("data", T.ArrayType(GUILD, True)),
    ))
)

# ----- reports document: reportData -> reports -> data[] -> fights[]
FIGHT = _s(
    _f("id", T.IntegerType()),
    _f("encounterID", T.IntegerType()),
    _f("kill", T.BooleanType()),
    _f("startTime", T.LongType()),
    _f("endTime", T.LongType()),
    _f("difficulty", T.IntegerType()),
    _f("size", T.IntegerType()),
    _f("fightPercentage", T.DoubleType()),
    _f("bossPercentage", T.DoubleType()),
    _f("lastPhase", T.IntegerType()),
    _f("lastPhaseIsIntermission", T.BooleanType()),
    _f("wipeCalledTime", T.LongType()),
    _f("friendlyPlayers", T.ArrayType(T.IntegerType(), True)),
)

REPORT = _s(
    _f("code", T.StringType()),
    _f("title", T.StringType()),
    _f("fights", T.ArrayType(FIGHT, True)),
)

REPORTS_DATA = _s(
    _f("reports", _s(
        _f("total", T.IntegerType()),
        _f("last_page", T.IntegerType()),
        _f("has_more_pages", T.BooleanType()),
        _f("data", T.ArrayType(REPORT, True)),
    ))
)

# Top-level column of each landing document and its declared payload schema.
PAYLOADS = {
    "encounters": ("worldData", WORLD_DATA),
    "guilds": ("guildData", GUILD_DATA),
    "reports": ("reportData", REPORTS_DATA),
}


def landing_schema(dataset: str, as_text: bool = True, parsed: bool = False) -> T.StructType:
    """Schema used to *read* a landing file.

    ``as_text=True`` keeps the payload object as raw JSON text (bronze stores text; silver
    parses it with the declared schema). ``as_text=False`` reads the typed struct directly,
    which avoids a second parse when bronze is skipped. ``parsed`` keeps the payload as a VARIANT:
    the scan is the only parse, bronze still holds whole documents, and silver extracts the
    declared fields from the binary form.
    """
    column, payload = PAYLOADS[dataset]
    if parsed:
        return _s(_f(column, T.VariantType()))
    return _s(_f(column, T.StringType() if as_text else payload))


# Silver / gold key columns and the version column of the keyed upsert.
ENCOUNTER_KEYS = ["encounter_id", "player_name", "class", "ranked_date"]
GUILD_KEYS = ["guild_id"]
VERSION_COLUMN = "ldts"
