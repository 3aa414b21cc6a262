"""DuckDB SQL that computes the same results as the registered Spark queries, straight from
the driver tables. Used by the driver's correctness gate and by the local checker."""

from __future__ import annotations


def initcap(s: str) -> str:
    """Spark ``initcap`` on ASCII text: split on single spaces, capitalise each piece."""
    return (f"array_to_string(list_transform(string_split({s}, ' '), "
            f"lambda w: upper(w[1]) || lower(w[2:])), ' ')")


def trimws(s: str) -> str:
    return (f"trim(regexp_replace(regexp_replace({s}, '[\\r\\n]', ' ', 'g'), "
            f"'\\s+', ' ', 'g'))")


# ---------------------------------------------------------------- encounters
ENC_TIE = ('"rDPS" DESC, "aDPS" DESC, duration DESC, "lodestoneID" DESC, encounter_name DESC, '
           'guild_id DESC, guild_name DESC, server_id DESC, server_name DESC')


def encounter_ctes(source: str = "events", carry: str = "", version: str = "", faults: bool = False) -> str:
    """CTEs ``silver_c``, ``silver``, ``gold`` over an events-shaped relation ``source``.
    ``carry`` lists extra columns kept (with a trailing comma); ``version`` is the leading
    ORDER BY term of the newest-per-key choice (e.g. ``ldts DESC,``). ``faults``: the source
    has players and encounters without a name and encounters without an id."""
    unnamed = ("user_id % 13 = 0", "user_id % 5 + 101 = 104", "user_id % 5 + 101 = 105") if faults else ("false",) * 3
    return f"""
p AS (SELECT *, (props->>'$.k')::INT AS k FROM {source}),
silver_c AS (
  SELECT {carry} CASE WHEN NOT {unnamed[2]} THEN (user_id % 5 + 101)::INT END AS encounter_id,
    CASE WHEN NOT {unnamed[1]} THEN {trimws(initcap("' the  fight ' || (user_id % 5 + 101)"))} END AS encounter_name,
    CASE WHEN NOT {unnamed[0]} THEN {trimws(initcap("' player' || chr(10) || ' ' || user_id"))} END AS player_name,
    upper(event_type[1]) || lower(event_type[2:]) || ' Mage' AS class,
    round((value - 5)::FLOAT, 2)::FLOAT AS "rDPS",
    round(((value - 2) * 0.95::DOUBLE)::FLOAT, 2)::FLOAT AS "aDPS",
    date_trunc('second', ts) AS ranked_date,
    ((k * 90000 + 500) // 1000)::INT AS duration,
    user_id + 10000000 AS "lodestoneID",
    CASE WHEN user_id % 7 <> 0 THEN user_id % 50 END AS guild_id,
    CASE WHEN user_id % 7 <> 0 THEN 'Guild ' || (user_id % 50) END AS guild_name,
    (user_id % 8)::INT AS server_id,
    'Srv ' || (user_id % 8) AS server_name
  FROM p
  WHERE round((value - 5)::FLOAT, 2) > 0
    AND round(((value - 2) * 0.95::DOUBLE)::FLOAT, 2) > 0 AND (k * 90000 + 500) // 1000 > 0
    AND NOT {unnamed[0]} AND NOT {unnamed[2]}),
silver AS (
  SELECT * FROM silver_c
  QUALIFY row_number() OVER (PARTITION BY encounter_id, player_name, class, ranked_date
                             ORDER BY {version} {ENC_TIE}) = 1),
gold AS (
  SELECT encounter_name, player_name, class, "rDPS", "aDPS",
    strftime(ranked_date, '%Y-%m-%d') AS ranked_date, duration, "lodestoneID", guild_name, server_name
  FROM silver
  WHERE encounter_name IS NOT NULL AND player_name IS NOT NULL AND ranked_date IS NOT NULL)"""


ENC = encounter_ctes()
SILVER_ENCOUNTERS = f"WITH {ENC} SELECT * FROM silver_c"
GOLD_ENCOUNTERS = f"WITH {ENC} SELECT * FROM gold"
PRESENTATION = f"""WITH {ENC}
SELECT encounter_name, player_name, class, "rDPS", "aDPS", ranked_date,
  lpad(floor(duration / 60)::BIGINT::VARCHAR, 2, '0') || ':' || lpad((duration % 60)::VARCHAR, 2, '0') AS duration_fmt,
  guild_name, server_name
FROM gold"""

_FAULTS = f"""WITH f AS (SELECT * FROM events UNION ALL
  SELECT event_id, ts, user_id, event_type, value + 1, props FROM events WHERE event_id % 10 = 0),
{encounter_ctes('f', faults=True)}"""
SILVER_ENCOUNTERS_FAULTS = f"{_FAULTS} SELECT * FROM silver"
GOLD_ENCOUNTERS_FAULTS = f"{_FAULTS} SELECT * FROM gold"

# Documents are (encounter, block of 100 event ids); those of each seventh block are cut off.
_DOCS = "docs AS (SELECT DISTINCT user_id % 5 AS e, event_id // 100 AS doc FROM events)"
QUARANTINE = f"""WITH {_DOCS} SELECT 'payload' AS broken, 'rankforge' AS rsrc, count(*) AS documents, count(*) AS with_text
FROM docs WHERE doc % 7 = 0 HAVING count(*) > 0"""
_READ = f"""WITH {_DOCS}, n AS (SELECT count(*) AS tested, count(*) FILTER (WHERE doc % 7 = 0) AS failed FROM docs)"""
QUARANTINE_REPORT = f"""{_READ} SELECT rule, tested AS rows_tested, failed AS rows_failed, tested - failed AS rows_passed
FROM n, (VALUES ('readable_document'), ('ALL')) r(rule)"""
SILVER_ENCOUNTERS_READABLE = f"""WITH readable AS (SELECT * FROM events WHERE event_id // 100 % 7 <> 0),
{encounter_ctes('readable')} SELECT * FROM silver_c"""
STREAM_QUARANTINE = f"""{_READ}, l(ldts) AS (VALUES (TIMESTAMP '2026-01-01 00:00:00'), (TIMESTAMP '2026-01-02 00:00:00'))
SELECT ldts, tested - failed AS documents, 'bronze_read' AS went_to FROM n, l
UNION ALL SELECT ldts, failed, 'quarantine' FROM n, l WHERE failed > 0"""
STREAM_QUARANTINE_COUNTS = f"""{_READ}
SELECT 'bronze' AS query, 'readable_document' AS rule, 2 * tested AS rows_tested, 2 * failed AS rows_failed FROM n"""

# The same encounters landed as files with the pull stamp 2026-01-01 00:00:00 as load time.
SCAN_JSON_MULTILINE = f"""WITH src AS (SELECT *, TIMESTAMP '2026-01-01 00:00:00' AS ldts FROM events),
{encounter_ctes('src', 'ldts,')} SELECT * FROM silver_c"""

# ---------------------------------------------------------------- versioned loads
# Three pulls of the whole events table; pull day d shifts value by 3 - d. Written in the
# order day 3, day 1, day 2, so the newest arrives first.
LOADS = """loads AS (
  SELECT TIMESTAMP '2026-01-03 00:00:00' AS ldts, event_id, ts, user_id, event_type, value + 0 AS value, props FROM events
  UNION ALL
  SELECT TIMESTAMP '2026-01-01 00:00:00', event_id, ts, user_id, event_type, value + 2, props FROM events
  UNION ALL
  SELECT TIMESTAMP '2026-01-02 00:00:00', event_id, ts, user_id, event_type, value + 1, props FROM events)"""

LOAD_CTES = f"WITH {LOADS}, {encounter_ctes('loads', 'ldts,', 'ldts DESC,')}"
STREAM_BRONZE = f"""WITH {LOADS}
SELECT ldts, count(DISTINCT (user_id % 5, event_id // 100)) AS documents, count(*) AS records
FROM loads GROUP BY ldts"""
STREAM_BRONZE_TABLE = f"""WITH {LOADS}
SELECT ldts, count(DISTINCT (user_id % 5, event_id // 100)) AS documents,
  'Landed encounter documents as text, with load time and source.' AS comment FROM loads GROUP BY ldts"""
STREAM_TABLE_COMMENTS = f"""{LOAD_CTES}
SELECT 'bronze' AS layer, 'Landed encounter documents as text, with load time and source.' AS comment,
  count(DISTINCT (ldts, user_id % 5, event_id // 100)) AS rows FROM loads
UNION ALL SELECT 'silver_clean', 'Parsed and cleaned rankings that pass the silver rules.', count(*) FROM silver_c
UNION ALL SELECT 'silver', 'Newest ranking of each encounter, player, class and time.', count(*) FROM silver
UNION ALL SELECT 'gold', 'Rankings for analysis, by name.', count(*) FROM gold"""
STREAM_SILVER = f"{LOAD_CTES} SELECT * FROM silver_c"
STREAM_LATEST_ENCOUNTERS = f"{LOAD_CTES} SELECT * FROM silver"
STREAM_GOLD_ENCOUNTERS = f"{LOAD_CTES} SELECT * FROM gold"

# ---------------------------------------------------------------- guilds
SCAN_JSON_LINES = SCAN_JSON_MULTILINE

GLD_TIE = ('guild_name DESC, guild_description DESC, server_id DESC, region_id DESC, '
           'world_prog_rank DESC, region_prog_rank DESC, world_speed_rank DESC, region_speed_rank DESC')


def guild_ctes(source: str = "customer", carry: str = "", version: str = "", tag: str = "''") -> str:
    return f"""
g AS (SELECT {carry} c_custkey::INT AS guild_id,
  CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 'Guild Of ' || upper(c_name[1]) || lower(c_name[2:]) END AS guild_name,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE {trimws("c_mktsegment || ' guild ' || " + tag)} END AS guild_description,
  CASE WHEN c_custkey % 13 <> 0 THEN c_nationkey END AS server_id,
  CASE WHEN c_custkey % 13 <> 0 THEN c_nationkey % 5 END AS region_id,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 2 <> 0 THEN (c_custkey % 150)::INT END AS world_prog_rank,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 = 0 THEN (c_custkey % 150 + 1)::INT END AS region_prog_rank,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 3 <> 0 THEN (c_custkey % 200)::INT END AS world_speed_rank,
  CASE WHEN c_custkey % 5 <> 0 AND c_custkey % 4 = 0 THEN (c_custkey % 200 + 1)::INT END AS region_speed_rank
  FROM {source}),
guild_c AS (
  SELECT * FROM g WHERE guild_id IS NOT NULL AND server_id IS NOT NULL AND region_id IS NOT NULL
    AND coalesce(world_prog_rank, region_prog_rank, world_speed_rank, region_speed_rank) IS NOT NULL),
guild_silver AS (
  SELECT * FROM guild_c
  QUALIFY row_number() OVER (PARTITION BY guild_id ORDER BY {version} {GLD_TIE}) = 1),
guild_gold AS (
  SELECT guild_id, guild_name, guild_description, server_id, region_id,
         world_prog_rank, region_prog_rank, world_speed_rank, region_speed_rank
  FROM guild_silver
  WHERE guild_name IS NOT NULL AND server_id IS NOT NULL AND region_id IS NOT NULL)"""


GLD = guild_ctes()
SQL_PREVIEW = """SELECT 'guildData,ldts,rsrc' AS preview_columns, 'rankforge' AS rsrc, 1500 AS total,
  count(*)::INT AS records, min(c_custkey)::INT AS first_id
FROM customer GROUP BY c_custkey // 100 ORDER BY first_id LIMIT 5"""
SILVER_GUILDS = f"WITH {GLD} SELECT * FROM guild_c"
GOLD_GUILDS = f"WITH {GLD} SELECT * FROM guild_gold"
SCHEMA_SETUP = GOLD_GUILDS

GUILD_LOADS = """gloads AS (
  SELECT TIMESTAMP '2026-01-03 00:00:00' AS ldts, '3' AS tag, * FROM customer
  UNION ALL SELECT TIMESTAMP '2026-01-01 00:00:00', '1', * FROM customer
  UNION ALL SELECT TIMESTAMP '2026-01-02 00:00:00', '2', * FROM customer)"""
STREAM_LATEST_GUILDS = (f"WITH {GUILD_LOADS}, {guild_ctes('gloads', 'ldts,', 'ldts DESC,', 'tag')} "
                        "SELECT * FROM guild_silver")
STREAM_GOLD_GUILDS = (f"WITH {GUILD_LOADS}, {guild_ctes('gloads', 'ldts,', 'ldts DESC,', 'tag')} "
                      "SELECT * FROM guild_gold")
STREAM_BRONZE_GUILDS = f"""WITH {GUILD_LOADS}
SELECT ldts, count(DISTINCT c_custkey // 100) AS documents, count(*) AS records FROM gloads GROUP BY ldts"""

# draft guild chain: rank rule only, then newest per guild, then the gold projection
DRAFT_G = f"""WITH g0 AS (SELECT * FROM customer), {guild_ctes('g0')},
draft_c AS (SELECT * FROM g WHERE coalesce(world_prog_rank, region_prog_rank, world_speed_rank, region_speed_rank) IS NOT NULL)"""
STAGE_COUNTS = f"""{DRAFT_G}
SELECT 0 AS step, 'raw' AS stage, count(DISTINCT c_custkey // 100) AS rows FROM customer
UNION ALL SELECT 1, 'bronze', count(DISTINCT c_custkey // 100) FROM customer
UNION ALL SELECT 2, 'silver', count(DISTINCT guild_id) FROM draft_c
UNION ALL SELECT 3, 'gold', count(DISTINCT guild_id) FROM draft_c"""

STAGE_COUNTS_ENCOUNTERS = f"""WITH {ENC}
SELECT 0 AS step, 'raw' AS stage, count(DISTINCT (user_id % 5, event_id // 100)) AS rows FROM events
UNION ALL SELECT 1, 'bronze', count(DISTINCT (user_id % 5, event_id // 100)) FROM events
UNION ALL SELECT 2, 'silver', count(*) FROM silver
UNION ALL SELECT 3, 'gold', count(*) FROM gold"""

STREAM_RULE_COUNTS = f"""WITH {LOADS}, p AS (SELECT *, (props->>'$.k')::INT AS k, day(ldts)::INT AS day FROM loads),
c AS (SELECT day, count(*) AS n,
   count(*) FILTER (WHERE round((value - 5)::FLOAT, 2)::FLOAT <= 0) AS r,
   count(*) FILTER (WHERE round(((value - 2) * 0.95::DOUBLE)::FLOAT, 2)::FLOAT <= 0) AS a,
   count(*) FILTER (WHERE (k * 90000 + 500) // 1000 <= 0) AS d FROM p GROUP BY day)
SELECT day, rule, n AS rows_tested, failed AS rows_failed FROM (
  SELECT day, 'valid_encounter_id' AS rule, n, 0::BIGINT AS failed FROM c UNION ALL
  SELECT day, 'valid_player_name', n, 0::BIGINT FROM c UNION ALL
  SELECT day, 'positive_rdps', n, r FROM c UNION ALL
  SELECT day, 'positive_adps', n, a FROM c UNION ALL
  SELECT day, 'valid_duration', n, d FROM c)"""

# ---------------------------------------------------------------- quality report
ENC_RULE_SQL = f"""WITH p AS (SELECT *, (props->>'$.k')::INT AS k FROM events),
c AS (SELECT (user_id % 5 + 101)::INT AS encounter_id,
   {trimws(initcap("' player' || chr(10) || ' ' || user_id"))} AS player_name,
   round((value - 5)::FLOAT, 2)::FLOAT AS r, round(((value - 2) * 0.95::DOUBLE)::FLOAT, 2)::FLOAT AS a,
   ((k * 90000 + 500) // 1000)::INT AS d FROM p),
f AS (SELECT count(*) AS n,
   count(*) FILTER (WHERE encounter_id IS NULL) AS f0,
   count(*) FILTER (WHERE player_name IS NULL) AS f1,
   count(*) FILTER (WHERE NOT coalesce(r > 0, false)) AS f2,
   count(*) FILTER (WHERE NOT coalesce(a > 0, false)) AS f3,
   count(*) FILTER (WHERE NOT coalesce(d > 0, false)) AS f4,
   count(*) FILTER (WHERE encounter_id IS NULL OR player_name IS NULL OR NOT coalesce(r > 0, false)
                    OR NOT coalesce(a > 0, false) OR NOT coalesce(d > 0, false)) AS f5 FROM c)
SELECT rule, n AS rows_tested, failed AS rows_failed, n - failed AS rows_passed FROM (
  SELECT 'valid_encounter_id' AS rule, n, f0 AS failed FROM f UNION ALL
  SELECT 'valid_player_name', n, f1 FROM f UNION ALL
  SELECT 'positive_rdps', n, f2 FROM f UNION ALL
  SELECT 'positive_adps', n, f3 FROM f UNION ALL
  SELECT 'valid_duration', n, f4 FROM f UNION ALL
  SELECT 'ALL', n, f5 FROM f)"""

GUILD_RULE_SQL = f"""WITH {GLD},
f AS (SELECT count(*) AS n,
  count(*) FILTER (WHERE guild_id IS NULL) AS f0,
  count(*) FILTER (WHERE server_id IS NULL) AS f1,
  count(*) FILTER (WHERE region_id IS NULL) AS f2,
  count(*) FILTER (WHERE coalesce(world_prog_rank, region_prog_rank, world_speed_rank, region_speed_rank) IS NULL) AS f3,
  count(*) FILTER (WHERE guild_id IS NULL OR server_id IS NULL OR region_id IS NULL OR
    coalesce(world_prog_rank, region_prog_rank, world_speed_rank, region_speed_rank) IS NULL) AS f4 FROM g)
SELECT rule, n AS rows_tested, failed AS rows_failed, n - failed AS rows_passed FROM (
  SELECT 'valid_guild_id' AS rule, n, f0 AS failed FROM f UNION ALL
  SELECT 'valid_server_id', n, f1 FROM f UNION ALL
  SELECT 'valid_region_id', n, f2 FROM f UNION ALL
  SELECT 'has_any_ranking', n, f3 FROM f UNION ALL
  SELECT 'ALL', n, f4 FROM f)"""

# ---------------------------------------------------------------- page merge / slice / preview
MERGE_PAGES = """SELECT (user_id % 5 + 101)::INT AS eid,
  (row_number() OVER (PARTITION BY user_id % 5 ORDER BY event_id // 100, event_id) - 1)::INT AS pos,
  event_id FROM events"""

PAGE_SLICE = """SELECT c_custkey, c_name, c_acctbal, ((rn - 1) // 100 + 1)::INT AS page FROM (
  SELECT *, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS rn FROM customer)
WHERE rn > 100 AND rn <= 600"""

RAW_PREVIEW = """SELECT c_custkey // 100 AS doc, 1500 AS total, true AS has_more_pages,
  (row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1)::INT AS pos,
  c_custkey::INT AS guild_id,
  CASE WHEN c_custkey % 11 = 0 THEN ' ' || chr(10) || ' ' ELSE ' guild' || chr(10) || ' of  ' || c_name END AS guild_name
FROM customer QUALIFY pos < 3"""

def _part(c: str) -> str:
    return f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"


SURROGATE_KEY = f"""SELECT c_custkey,
  sha256({_part('c_custkey')} || {_part('c_nationkey')} || {_part('c_mktsegment')}) AS surrogate_key FROM customer"""

LATEST_PER_KEY = """SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type
  ORDER BY ts DESC, event_id DESC, value DESC, props DESC) = 1"""

# ---------------------------------------------------------------- scalar functions
TITLE_CASE = f"""SELECT event_id,
  {initcap("regexp_replace(upper(event_type[1]) || lower(event_type[2:]) || 'Mage', '([a-z])([A-Z])', '\\1 \\2', 'g')")} AS pascal,
  {initcap("regexp_replace(event_type || '__dark_knight', '_+', ' ', 'g')")} AS snake,
  {initcap("regexp_replace(event_type || '--white-mage', '-+', ' ', 'g')")} AS kebab
FROM events"""

TIME_FUNCTIONS = """SELECT event_id,
  date_trunc('second', ts) AS from_s, date_trunc('second', ts) AS from_ms, date_trunc('second', ts) AS from_us,
  (epoch_ms(date_trunc('second', ts)))::DOUBLE AS start_time,
  (event_id * 1000)::DOUBLE AS end_time,
  strftime(ts, '%Y-%m-%d') AS day,
  lpad(floor(((props->>'$.k')::INT * 61) / 60)::BIGINT::VARCHAR, 2, '0') || ':' ||
    lpad((((props->>'$.k')::INT * 61) % 60)::VARCHAR, 2, '0') AS mmss
FROM events"""

# ---------------------------------------------------------------- analytics
FEATURE_SELECT = f"""WITH {ENC} SELECT class, "rDPS", "aDPS", duration FROM gold WHERE encounter_name = 'The Fight 103'"""

def _sample(table: str, key: list[str], tie: list[str] = (), hashed: list[str] = (), n: int = 100, seed: int = 42) -> str:
    """CTEs ``r`` (rows numbered from 0 in the order of a seeded hash of their key and of the
    ``hashed`` columns) and ``i`` (draws with the position that each takes)."""
    text = " || '|' || ".join([f"'{seed}'", *[f"coalesce({c}::VARCHAR, '')" for c in [*key, *hashed]]])
    order = ", ".join(f"{c} NULLS FIRST" for c in [*key, *tie])
    return f"""r AS (SELECT row_number() OVER (ORDER BY ('0x' || substr(md5({text}), 1, 15))::BIGINT, {order}) - 1 AS j, *
        FROM {table}),
  i AS (SELECT i AS draw, ('0x' || substr(md5('{seed}:' || i), 1, 15))::BIGINT % (SELECT count(*) FROM {table}) AS j
        FROM range({n}) t(i))"""


BOOTSTRAP_SAMPLE = f"""WITH {_sample('events', ['event_id'])}
SELECT draw, event_id, ts, user_id, event_type, value, props FROM i JOIN r USING (j)"""
BOOTSTRAP_REPEATED = f"""WITH {_sample('events', ['event_type'], ['user_id', 'event_id'], ['user_id', 'event_id'], 250, 7)}
SELECT draw, event_id, ts, user_id, event_type, value, props FROM i JOIN r USING (j)"""

LEAST_SQUARES = f"""WITH {ENC} SELECT encounter_name, class,
  round(regr_slope("aDPS"::DOUBLE, "rDPS"::DOUBLE), 6) AS m,
  round(regr_intercept("aDPS"::DOUBLE, "rDPS"::DOUBLE), 6) AS b, regr_count("aDPS"::DOUBLE, "rDPS"::DOUBLE)::BIGINT AS n
FROM gold GROUP BY ALL"""

R_SQUARED = """WITH st AS (SELECT event_type, round_even(regr_slope(value, user_id), 2) AS m,
                   round_even(regr_intercept(value, user_id), 2) AS b, avg(value) AS yb FROM events GROUP BY 1),
     q AS (SELECT event_type, m, b, round(sum(pow(value - yb, 2)), 3) AS sse_base,
                  round(sum(pow(value - (m * user_id + b), 2)), 4) AS sse_reg,
                  round_even(1 - sum(pow(value - (m * user_id + b), 2)) / sum(pow(value - yb, 2)), 2)::DOUBLE + 0.0 AS r2
           FROM events JOIN st USING (event_type) GROUP BY ALL)
SELECT * FROM q"""

FIT_REPORT = f"""WITH {ENC},
  {_sample('gold', ['encounter_name', 'player_name', 'class', 'ranked_date'], ['"rDPS"', '"aDPS"', 'duration'], ['duration'])},
  s AS (SELECT "rDPS"::DOUBLE AS x, "aDPS"::DOUBLE AS y FROM i JOIN r USING (j)),
  st AS (SELECT round_even(regr_slope(y, x), 2) AS m, round_even(regr_intercept(y, x), 2) AS b,
                avg(y) AS yb, count(*) AS n FROM s)
SELECT m, b, round(sum(pow(y - yb, 2)), 3) AS sse_base, round(sum(pow(y - (m * x + b), 2)), 3) AS sse_reg,
  round_even(1 - sum(pow(y - (m * x + b), 2)) / sum(pow(y - yb, 2)), 2)::DOUBLE + 0.0 AS r2, n
FROM s, st GROUP BY m, b, n"""

_FIT = """st AS (SELECT event_type, regr_slope(value, user_id) AS m, regr_intercept(value, user_id) AS b,
                  min(user_id)::DOUBLE AS lo, max(user_id)::DOUBLE AS hi FROM events GROUP BY 1),
  pts AS (SELECT event_type, i::INT AS i, lo + i * ((hi - lo) / 99) AS x, m, b FROM st, range(100) t(i))"""
FIT_POINTS = f"""WITH {_FIT} SELECT event_type, i, round(x, 6) AS x, round(m * x + b, 6) AS y FROM pts"""
LINE_FROM_POINTS = f"""WITH {_FIT},
  e AS (SELECT event_type, min(x) AS x0, max(x) AS x1, arg_min(m * x + b, x) AS y0, arg_max(m * x + b, x) AS y1 FROM pts GROUP BY 1)
SELECT event_type, round((y1 - y0) / (x1 - x0), 6) AS m, round(y0 - (y1 - y0) / (x1 - x0) * x0, 6) AS b FROM e"""

DAMAGE_PROBABILITY = f"""WITH {ENC},
  q AS (SELECT encounter_name, class, avg(("rDPS" >= 50)::INT::DOUBLE) AS empirical, avg("rDPS"::DOUBLE) AS mean,
               stddev_samp("rDPS"::DOUBLE) AS sd, count(*) AS n FROM gold GROUP BY ALL),
  r AS (SELECT *, (50 - mean) / sd AS z FROM q),
  s AS (SELECT *, 1 / (1 + 0.3275911::DOUBLE * abs(z) / sqrt(2)) AS t FROM r),
  u AS (SELECT *, 0.5::DOUBLE * ((((1.061405429::DOUBLE * t - 1.453152027::DOUBLE) * t + 1.421413741::DOUBLE) * t
                  - 0.284496736::DOUBLE) * t + 0.254829592::DOUBLE) * t * exp(-z * z / 2) AS h FROM s)
SELECT encounter_name, class, round(empirical, 6) AS empirical, round(mean, 6) AS mean, round(sd, 6) AS sd, n,
  round(CASE WHEN z >= 0 THEN h ELSE 1 - h END, 6) AS normal_tail FROM u"""

MERGE_ENVELOPES = """WITH p AS (SELECT (user_id % 5 + 101)::INT AS eid, event_id // 100 AS page FROM events)
SELECT eid, 'pull ' || min(page) AS title, count(DISTINCT page) AS pages, count(*) AS records FROM p GROUP BY eid"""



def _upper(z: str) -> str:
    """The upper tail of a standard normal by the same polynomial as the Spark expression."""
    t = f"(1 / (1 + 0.3275911::DOUBLE * abs({z}) / sqrt(2)))"
    half = (f"(0.5::DOUBLE * ((((1.061405429::DOUBLE * {t} - 1.453152027::DOUBLE) * {t} + 1.421413741::DOUBLE) * {t}"
            f" - 0.284496736::DOUBLE) * {t} + 0.254829592::DOUBLE) * {t} * exp(-{z} * {z} / 2))")
    return f"(CASE WHEN {z} >= 0 THEN {half} ELSE 1 - {half} END)"


def _joint(source: str, group: str, x: str, y: str, at_x: float, at_y: float) -> str:
    """CTEs and query of the shares and of the bivariate normal tail of two measures by group:
    22 panels that halve towards 0 with ten Gauss-Legendre points each, in angles from the one
    whose cosine is the correlation to a right angle."""
    return f"""present AS (SELECT {group}, {x}::DOUBLE AS x, {y}::DOUBLE AS y FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL),
  st AS (SELECT {group}, avg((x >= {at_x} AND y >= {at_y})::INT::DOUBLE) AS p_all, avg((x >= {at_x} OR y >= {at_y})::INT::DOUBLE) AS p_any,
    count(*) AS n, ({at_x} - avg(x)) / stddev_samp(x) AS h, ({at_y} - avg(y)) / stddev_samp(y) AS k0, corr(x, y) AS corr
    FROM present GROUP BY ALL),
  tn AS (SELECT *, CASE WHEN corr < 0 THEN -k0 ELSE k0 END AS k, acos(least(abs(corr), 1.0::DOUBLE)) AS low FROM st),
  gl(node, weight) AS (SELECT s * node, weight FROM (VALUES (0.1488743389816312::DOUBLE, 0.2955242247147529::DOUBLE),
    (0.4333953941292472, 0.2692667193099963), (0.6794095682990244, 0.2190863625159821), (0.8650633666889845, 0.1494513491505806),
    (0.9739065285171717, 0.0666713443086881)) v(node, weight), (VALUES (-1), (1)) w(s)),
  panel AS (SELECT CASE WHEN j < 21 THEN pi() / pow(2, j + 2) ELSE 0 END AS bottom, pi() / pow(2, j + 1) AS top FROM range(22) t(j)),
  pt AS (SELECT tn.*, (greatest(bottom, low) + greatest(top, low)) / 2 + (greatest(top, low) - greatest(bottom, low)) / 2 * node AS u,
    (greatest(top, low) - greatest(bottom, low)) / 2 * weight AS w FROM tn, panel, gl),
  area AS (SELECT {group}, sum(CASE WHEN w > 0 THEN w * exp(-((h - k) * (h - k) + 4 * h * k * pow(sin(u / 2), 2)) / (2 * pow(sin(u), 2)))
    ELSE 0 END) / (2 * pi()) AS a FROM pt GROUP BY ALL),
  both_ AS (SELECT tn.*, CASE WHEN corr < 0 THEN {_upper('h')} - ({_upper('h')} * {_upper('k')} + a) ELSE {_upper('h')} * {_upper('k')} + a END AS q
    FROM tn JOIN area USING ({group}))
SELECT {group}, n, round(p_all, 6) AS p_all, round(p_any, 6) AS p_any, round(corr, 6) AS corr, round(q, 6) AS normal_all,
  round({_upper('h')} + {_upper('k0')} - q, 6) AS normal_any FROM both_"""


JOINT_PROBABILITY = f"""WITH {ENC}, one AS (SELECT * FROM gold WHERE encounter_name = 'The Fight 103' AND class = 'Purchase Mage'),
  {_joint('one', 'encounter_name, class', '"rDPS"', '"aDPS"', 50, 60)}"""
JOINT_NORMAL_TAIL = f"WITH {_joint('events', 'event_type', 'user_id', 'value', 40, 60)}"

# ---------------------------------------------------------------- reports
SELECT_REPORTS = """WITH rep AS (
    SELECT 'R' || o_orderkey AS code, 'report ' || o_orderstatus AS title,
      split_part(o_orderpriority, '-', 1)::INT AS zone_id, o_custkey AS guild_id,
      epoch_ms(o_orderdate) AS start_ms, o_orderkey
    FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)),
  kept AS (SELECT *, row_number() OVER (ORDER BY start_ms, code) AS rn FROM rep
           WHERE zone_id = 1 AND start_ms >= epoch_ms(TIMESTAMP '1995-01-01') AND start_ms < epoch_ms(TIMESTAMP '1996-01-01'))
SELECT code, title, zone_id, guild_id, start_ms, 2 AS page, l_linenumber AS fight_id,
  (l_partkey % 5 + 101)::INT AS encounter_id, l_returnflag = 'R' AS kill,
  epoch_ms(l_shipdate) AS fight_start, epoch_ms(l_shipdate) + (l_quantity * 60000)::BIGINT AS fight_end
FROM kept JOIN lineitem ON l_orderkey = o_orderkey
WHERE rn > 50 AND rn <= 100 AND l_partkey % 5 + 101 = 103"""

REPORT_ENVELOPES = """WITH kept AS (SELECT * FROM orders
  WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AND split_part(o_orderpriority, '-', 1)::INT = 1
    AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01')
SELECT count(*) AS total, 50 AS per_page, 2 AS current_page, greatest(ceil(count(*) / 50), 1)::BIGINT AS last_page,
  2 < greatest(ceil(count(*) / 50), 1) AS has_more_pages FROM kept"""

SELECT_GUILD_REPORTS = """WITH kept AS (
    SELECT 'R' || o_orderkey AS code, 'report ' || o_orderstatus AS title,
      split_part(o_orderpriority, '-', 1)::INT AS zone_id, o_custkey AS guild_id, epoch_ms(o_orderdate) AS start_ms,
      o_orderkey, row_number() OVER (ORDER BY epoch_ms(o_orderdate), 'R' || o_orderkey) AS rn
    FROM orders WHERE o_custkey = 100 AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
SELECT code, title, zone_id, guild_id, start_ms, 1 AS page, l_linenumber AS fight_id,
  (l_partkey % 5 + 101)::INT AS encounter_id, l_returnflag = 'R' AS kill,
  epoch_ms(l_shipdate) AS fight_start, epoch_ms(l_shipdate) + (l_quantity * 60000)::BIGINT AS fight_end
FROM kept JOIN lineitem ON l_orderkey = o_orderkey WHERE rn <= 100"""

REPORT_DOCUMENT_FIGHTS = """WITH kept AS (
    SELECT 'R' || o_orderkey AS code, 'report ' || o_orderstatus AS title, o_orderkey,
      row_number() OVER (ORDER BY epoch_ms(o_orderdate), 'R' || o_orderkey) AS rn FROM orders
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) AND split_part(o_orderpriority, '-', 1)::INT = 1
      AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1996-01-01'),
  n AS (SELECT count(*)::INT AS total, greatest(ceil(count(*) / 50), 1)::INT AS last_page FROM kept)
SELECT total, last_page, (rn - 1) // 50 + 1 < last_page AS has_more_pages, code, title, l_linenumber AS fight_id,
  (l_partkey % 5 + 101)::INT AS encounter_id, l_returnflag = 'R' AS kill
FROM kept JOIN lineitem ON l_orderkey = o_orderkey, n"""
