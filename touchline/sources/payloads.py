"""Nested JSON payloads to flat bronze rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.sources import schemas


def read_payloads(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    """One row per document.  A malformed document becomes NULLs, not a failed load;
    several batch folders are one scan."""
    return spark.read.schema(schema).option("multiLine", "true").option("mode", "PERMISSIVE").json(paths)


def parse_payloads(documents: DataFrame, text: str, schema: str) -> DataFrame:
    """The same for documents kept as a text column; other columns are carried along."""
    keep = [c for c in documents.columns if c != text]
    return documents.withColumn("__p", F.from_json(text, schema)).select(*keep, "__p.*")


def _ingested(df: DataFrame) -> Column:
    return F.col("ingest_timestamp") if "ingest_timestamp" in df.columns else F.lit(None).cast("string")


def enforce(df: DataFrame, schema: str | T.StructType) -> DataFrame:
    """Exactly the declared columns, order and types."""
    target = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    return df.to(target)


def flatten_matches(payload: DataFrame) -> DataFrame:
    """One row per match; a missing nested object gives NULLs, an empty list no rows."""
    rows = payload.select("competition", _ingested(payload).alias("ingest_timestamp"), F.explode("matches").alias("m"))

    def side(s: str) -> list[Column]:
        t = F.col("m")[f"{s}Team"]
        return [t["id"].alias(f"{s}_team_id"), t["name"].alias(f"{s}_team_name"), t["shortName"].alias(f"{s}_team_short_name")]

    def goals(part: str, suffix: str) -> list[Column]:
        return [F.col("m.score")[part][s].alias(f"{s}_score_{suffix}") for s in ("home", "away")]

    flat = rows.select(
        F.col("m.id").alias("match_id"), F.col("m.utcDate").alias("utc_date"), "m.status", "m.matchday", "m.stage",
        F.col("m.lastUpdated").alias("last_updated"),
        *[F.col(f"competition.{f}").alias(f"competition_{f}") for f in ("id", "name", "code")],
        *side("home"), *side("away"), *goals("fullTime", "fulltime"), *goals("halfTime", "halftime"),
        F.col("m.score.winner").alias("winner"), "ingest_timestamp",
    )
    return enforce(flat, schemas.MATCHES)


def flatten_teams(payload: DataFrame) -> DataFrame:
    rename = {"id": "team_id", "name": "team_name", "shortName": "short_name", "crest": "crest_url", "clubColors": "club_colors"}
    rows = payload.select("competition", _ingested(payload).alias("ingest_timestamp"), F.explode("teams").alias("t"))
    fields = ["id", "name", "shortName", "tla", "crest", "address", "website", "founded", "clubColors", "venue"]
    flat = rows.select(
        *[F.col("t")[f].alias(rename.get(f, f)) for f in fields],
        *[F.col(f"competition.{f}").alias(f"competition_{f}") for f in ("id", "name")], "ingest_timestamp",
    )
    return enforce(flat, schemas.TEAMS)


def flatten_standings(payload: DataFrame) -> DataFrame:
    """Rows of the first standings block only; no block, no rows."""
    rows = payload.select("competition", _ingested(payload).alias("ingest_timestamp"),
                          F.explode(F.get("standings", F.lit(0))["table"]).alias("r"))
    rename = {"playedGames": "played_games", "goalsFor": "goals_for", "goalsAgainst": "goals_against", "goalDifference": "goal_difference"}
    fields = ["playedGames", "won", "draw", "lost", "points", "goalsFor", "goalsAgainst", "goalDifference"]
    flat = rows.select(
        *[F.col(f"competition.{f}").alias(f"competition_{f}") for f in ("code", "name")],
        "r.position", F.col("r.team.id").alias("team_id"), F.col("r.team.name").alias("team_name"),
        *[F.col("r")[f].alias(rename.get(f, f)) for f in fields], "ingest_timestamp",
    )
    return enforce(flat, schemas.STANDINGS)


def stamp_provenance(df: DataFrame, source: str, batch_ts, **constants) -> DataFrame:
    """Source name, one timestamp for the whole batch, and other constants of the load."""
    return df.withColumns({
        "source": F.lit(source),
        "ingest_timestamp": F.lit(batch_ts),
        **{k: F.lit(v) for k, v in constants.items()},
    })


def union_batches(batches: Sequence[DataFrame | None]) -> DataFrame:
    """All batches that loaded; a failed one is passed as None and skipped.  Missing
    columns are NULL."""
    loaded = [b for b in batches if b is not None]
    if not loaded:
        raise ValueError("no batch loaded")
    out = loaded[0]
    for b in loaded[1:]:
        out = out.unionByName(b, allowMissingColumns=True)
    return out
