"""One load of everything: bronze batch -> silver history -> gold marts -> quality results.

An ordered list of functions and one write per table.  A mart that feeds others is read
back from its written files, so nothing is computed twice.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.operators.changes import TableConfig
from touchline.operators.sides import stack_all
from touchline.plans import gold, silver, suites
from touchline.sources import tables

# mart -> (function, inputs).  players_history and standings_history hold all versions,
# other silver tables current rows only.
MARTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "fct_match_results": (gold.match_results, ("stg_matches", "stg_teams")),
    "fct_matches_with_xg": (gold.matches_with_xg, ("stg_matches", "stg_fbref_matches")),
    "fct_player_performance": (gold.player_performance, ("stg_players",)),
    "dim_teams": (gold.dim_teams, ("stg_teams", "fct_match_results")),
    "dim_players": (gold.dim_players, ("stg_players",)),
    "agg_competition_standings": (gold.competition_standings, ("dim_teams",)),
    "agg_matchday_summary": (gold.matchday_summary, ("fct_match_results",)),
    "agg_team_xg_analysis": (gold.team_xg_analysis, ("fct_matches_with_xg",)),
    "agg_top_scorers": (gold.top_scorers, ("fct_player_performance",)),
    "agg_top_assisters": (gold.top_assisters, ("fct_player_performance",)),
    "agg_player_xg_analysis": (gold.player_xg_analysis, ("fct_player_performance",)),
    "agg_head_to_head": (gold.head_to_head, ("stg_fbref_matches",)),
    "agg_team_form": (gold.team_form, ("stg_fbref_matches",)),
    "agg_player_form": (gold.player_form, ("players_history",)),
    "agg_standing_history": (gold.standing_history, ("standings_history",)),
}

# Marts that are looked up by these columns are written in ranges of them.
CLUSTERED = {
    "fct_match_results": ("competition_code", "match_date"), "agg_competition_standings": ("competition_name", "position"),
    "agg_head_to_head": ("team_a", "team_b"), "agg_team_form": ("competition_name", "team_name"), "agg_standing_history": ("team_name", "competition_name"),
}

# The payload line: matches, teams and standings as the first source sends them, with the second source's matches beside it.
PAYLOAD_CONFIGS = {**silver.PAYLOAD_CONFIGS, "stg_fbref_matches": silver.CONFIGS["stg_fbref_matches"]}
PAYLOAD_MARTS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "fct_match_results": (gold.match_results_basic, ("stg_matches",)),
    "dim_teams": (gold.dim_teams_basic, ("stg_teams", "stg_standings")),
    "head_to_head_basic": (gold.head_to_head_basic, ("fct_match_results",)),
    "agg_head_to_head": MARTS["agg_head_to_head"],
    "agg_team_form": MARTS["agg_team_form"],
}


def load_silver(spark: SparkSession, root: str, bronze: Mapping[str, DataFrame], batch_id: str, ts,
                configs: Mapping[str, TableConfig] = silver.CONFIGS) -> DataFrame:
    """Apply one bronze batch to the history tables; returns one statistics row per table."""
    return stack_all([tables.load_batch(spark, f"{root}/silver/{name}", configs[name], rows, batch_id, ts) for name, rows in bronze.items()])


def silver_inputs(spark: SparkSession, root: str, configs: Mapping[str, TableConfig] = silver.CONFIGS) -> dict[str, DataFrame]:
    """History and current frames of every loaded silver table."""
    out: dict[str, DataFrame] = {}
    for name in configs:
        history = tables.read_history(spark, f"{root}/silver/{name}")
        if history is not None:
            out[name] = tables.read_current(spark, f"{root}/silver/{name}")
            out[f"{name}:history"] = history
    for alias, name in (("players_history", "stg_players"), ("standings_history", "stg_fbref_standings")):
        if f"{name}:history" in out:
            out[alias] = out[f"{name}:history"]
    return out


def build_gold(spark: SparkSession, root: str, batch_id: str, ts, marts: Mapping = MARTS, configs: Mapping[str, TableConfig] = silver.CONFIGS) -> dict[str, DataFrame]:
    """Write every mart whose inputs exist under ``gold/<mart>/batch=<id>``."""
    frames = silver_inputs(spark, root, configs)
    built: dict[str, DataFrame] = {}
    for mart, (make, needs) in marts.items():
        if all(n in frames for n in needs):
            path = f"{root}/gold/{mart}/batch={batch_id}"
            out = make(*[frames[n] for n in needs]).withColumn("transformed_at", F.lit(ts).cast("timestamp"))
            if mart in CLUSTERED:
                tables.write_clustered(out, path, CLUSTERED[mart])
            else:
                tables.write_overwrite(out, path)
            frames[mart] = built[mart] = spark.read.parquet(path)
    return built


def check_quality(spark: SparkSession, root: str, marts: Mapping[str, DataFrame], batch_id: str, now) -> DataFrame:
    """Run every suite and keep the results; a repeated run replaces its own results."""
    inputs = silver_inputs(spark, root)
    histories = {n: silver.with_version_key(n, inputs[f"{n}:history"]) for n in silver.CONFIGS if f"{n}:history" in inputs}
    path = f"{root}/gold/data_quality_history/run_id={batch_id}"
    tables.write_overwrite(suites.run_suites({**histories, **marts}, now), path)
    return spark.read.parquet(path)


def run(spark: SparkSession, root: str, bronze: Mapping[str, DataFrame], batch_id: str, ts) -> dict[str, DataFrame]:
    """The whole load.  Returns statistics, marts and quality results by name."""
    stats = load_silver(spark, root, bronze, batch_id, ts)
    marts = build_gold(spark, root, batch_id, ts)
    return {"statistics": stats, **marts, "data_quality": check_quality(spark, root, marts, batch_id, ts)}


def run_payloads(spark: SparkSession, root: str, bronze: Mapping[str, DataFrame], batch_id: str, ts, *, now=None, max_days: int = 7) -> dict[str, DataFrame]:
    """The whole payload line: history, its marts, and the rules and suites over what was written.  Returns them by name.

    Every table is registered as a temporary view of its name, histories whole, so the rules see what the load produced.
    """
    stats = load_silver(spark, root, bronze, batch_id, ts, PAYLOAD_CONFIGS)
    marts = build_gold(spark, root, batch_id, ts, PAYLOAD_MARTS, PAYLOAD_CONFIGS)
    inputs = silver_inputs(spark, root, PAYLOAD_CONFIGS)
    histories = {n: inputs[f"{n}:history"] for n in PAYLOAD_CONFIGS if n in inputs}
    for name, frame in {**histories, **marts}.items():
        frame.createOrReplaceTempView(name)
    now = ts if now is None else now
    rules = suites.run_sql_rules(spark, suites.sql_rules(str(now), "", "", max_days), now, batch_id, samples=True)
    return {"statistics": stats, **marts, "rules": rules, "data_quality": suites.run_suites(histories, now, suites.PAYLOAD_SUITES)}
