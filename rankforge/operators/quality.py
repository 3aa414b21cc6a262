"""Named data-quality rules: drop failing rows, and count failures per rule in one pass.

A rule is a SQL boolean expression; a row is kept only when every rule is TRUE (a NULL
result drops the row, as in ``WHERE``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

# Rule names and predicates of each stage, in declaration order.
SILVER_ENCOUNTER_RULES = {
    "valid_encounter_id": "encounter_id IS NOT NULL",
    "valid_player_name": "player_name IS NOT NULL",
    "positive_rdps": "rDPS > 0",
    "positive_adps": "aDPS > 0",
    "valid_duration": "duration > 0",
}

SILVER_GUILD_RULES = {
    "valid_guild_id": "guild_id IS NOT NULL",
    "valid_server_id": "server_id IS NOT NULL",
    "valid_region_id": "region_id IS NOT NULL",
    "has_any_ranking": ("world_prog_rank IS NOT NULL OR region_prog_rank IS NOT NULL OR "
                        "world_speed_rank IS NOT NULL OR region_speed_rank IS NOT NULL"),
}

GOLD_ENCOUNTER_RULES = {
    "valid_encounter_name": "encounter_name IS NOT NULL",
    "valid_player_name": "player_name IS NOT NULL",
    "valid_ranked_date": "ranked_date IS NOT NULL",
}

GOLD_GUILD_RULES = {
    "valid_guild_name": "guild_name IS NOT NULL",
    "valid_server_id": "server_id IS NOT NULL",
    "valid_region_id": "region_id IS NOT NULL",
}

# Draft guild stage: the ranking rule alone.
DRAFT_GUILD_RULES = {"has_any_ranking": SILVER_GUILD_RULES["has_any_ranking"]}


def _passes(predicate: str):
    return F.coalesce(F.expr(predicate), F.lit(False))


def expect_or_drop(df: DataFrame, rules: Mapping[str, str],
                   observation: Observation | str | None = None,
                   reject_nan: bool = False) -> DataFrame:
    """Keep the rows that pass every rule.

    ``observation`` (an ``Observation`` or a name) attaches per-rule failure counts to the
    plan with ``observe``; this works on batch and streaming frames and costs no extra pass.
    ``reject_nan`` also drops NaN in float columns (NaN passes ``> 0`` in Spark).
    """
    if not rules:
        return df
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("rows_tested")]
        metrics += [F.count_if(~_passes(p)).alias(f"failed_{n}") for n, p in rules.items()]
        df = df.observe(observation, *metrics)
    keep = None
    for predicate in rules.values():
        cond = _passes(predicate)
        keep = cond if keep is None else keep & cond
    if reject_nan:
        for f in df.schema.fields:
            if f.dataType.typeName() in ("float", "double"):
                keep = keep & ~F.isnan(F.col(f.name))
    return df.where(keep)


def reject(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """The rows that ``expect_or_drop`` drops: those that fail a rule."""
    failed = F.lit(False)
    for predicate in rules.values():
        failed = failed | ~_passes(predicate)
    return df.where(failed)


def expectation_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """One row per rule: rows tested, rows failed, rows passed; plus an ``ALL`` row counting
    rows that fail at least one rule (the rows ``expect_or_drop`` removes). One scan."""
    names = list(rules)
    # each rule once per row; the counts read its outcome
    failed = df.select(*[(~_passes(rules[n])).alias(f"f{i}") for i, n in enumerate(names)])
    any_fail = F.lit(False)
    for i in range(len(names)):
        any_fail = any_fail | F.col(f"f{i}")
    totals = failed.agg(F.count(F.lit(1)).alias("rows_tested"),
                        *[F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(names))],
                        F.count_if(any_fail).alias("f_all"))
    pairs = [F.struct(F.lit(n).alias("rule"), F.col(f"f{i}").alias("rows_failed"))
             for i, n in enumerate(names)]
    pairs.append(F.struct(F.lit("ALL").alias("rule"), F.col("f_all").alias("rows_failed")))
    out = totals.select("rows_tested", F.explode(F.array(*pairs)).alias("r"))
    return out.select(F.col("r.rule").alias("rule"), "rows_tested",
                      F.col("r.rows_failed").alias("rows_failed"),
                      (F.col("rows_tested") - F.col("r.rows_failed")).alias("rows_passed"))
