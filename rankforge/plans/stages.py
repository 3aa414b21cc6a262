"""Stage contract (bronze -> silver -> gold) and the whole-chain runner.

A silver stage is an ordered chain of ``DataFrame -> DataFrame`` steps; ``define`` and
``clean`` are required, the others default to identity. Steps run in the declared order
whatever order the caller lists them in.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.files import attach_metadata

Step = Callable[[DataFrame], DataFrame]

# Step order of each stage and the steps that must be given.
BRONZE_ORDER = ("ingest", "attach_metadata")
SILVER_ORDER = ("unpack", "define", "clean", "hash", "expect", "deduplicate")
SILVER_REQUIRED = ("define", "clean")
GOLD_ORDER = ("define",)
GOLD_REQUIRED = ("define",)


def run_stages(df: DataFrame | None, steps: Mapping[str, Step], order=SILVER_ORDER,
               required=SILVER_REQUIRED, stage: str = "silver") -> DataFrame:
    if df is None:
        raise ValueError(f"{stage}: the upstream stage produced no frame")
    unknown = set(steps) - set(order)
    if unknown:
        raise ValueError(f"{stage}: unknown steps {sorted(unknown)}; allowed {list(order)}")
    missing = [s for s in required if s not in steps]
    if missing:
        raise ValueError(f"{stage}: required steps missing: {missing}")
    return reduce(lambda acc, name: acc.transform(steps[name]) if name in steps else acc, order, df)


@dataclass
class PipelineSpec:
    source: str
    silver: Mapping[str, Step]
    gold: Mapping[str, Step]
    ldts: Column | None = None


def run_pipeline(raw: DataFrame, spec: PipelineSpec, seen: dict[str, Observation] | None = None) -> dict[str, DataFrame]:
    """Raw documents -> bronze -> silver -> gold; returns every stage frame (M5). With ``seen``
    each frame counts its rows into an observation of its own, whenever the chain is run."""
    def watched(name: str, df: DataFrame) -> DataFrame:
        if seen is None or df is None:
            return df
        seen[name] = Observation(name)
        return df.observe(seen[name], F.count(F.lit(1)).alias("rows"))

    frames = {"raw": watched("raw", raw)}
    frames["bronze"] = watched("bronze", run_stages(
        frames["raw"], {"ingest": lambda d: d, "attach_metadata": lambda d: attach_metadata(d, spec.source, spec.ldts)},
        BRONZE_ORDER, ("ingest",), "bronze"))
    frames["silver"] = watched("silver", run_stages(frames["bronze"], spec.silver, SILVER_ORDER, SILVER_REQUIRED, "silver"))
    frames["gold"] = watched("gold", run_stages(frames["silver"], spec.gold, GOLD_ORDER, GOLD_REQUIRED, "gold"))
    return frames


def stage_counts(raw: DataFrame, spec: PipelineSpec) -> DataFrame:
    """One row per stage: its position in the chain and its row count (A13, E1). The chain runs
    once, when this is called: every stage is counted as its rows pass. (The counts are observed
    metrics: an executor lost in the middle can make them count recomputed rows again.)"""
    seen: dict[str, Observation] = {}
    frames = run_pipeline(raw, spec, seen)
    frames["gold"].agg(F.count(F.lit(1))).collect()
    rows = [(i, name, seen[name].get["rows"]) for i, name in enumerate(frames)]
    return raw.sparkSession.createDataFrame(rows, "step int, stage string, rows long")


def guild_spec(source: str, ldts: Column | None = None) -> PipelineSpec:
    from . import guilds as g
    from ..operators.quality import DRAFT_GUILD_RULES

    return PipelineSpec(source, {
        "unpack": g.unpack, "define": g.define, "clean": g.clean,
        "expect": lambda d: g.expect(d, rules=DRAFT_GUILD_RULES),
        "deduplicate": g.deduplicate,
    }, {"define": lambda d: d.select(*g.GOLD_COLUMNS)}, ldts)


def encounter_spec(source: str, ldts: Column | None = None) -> PipelineSpec:
    from . import encounters as e

    return PipelineSpec(source, {
        "unpack": e.unpack, "define": e.define, "clean": e.clean,
        "expect": e.expect, "deduplicate": e.deduplicate,
    }, {"define": e.gold}, ldts)
