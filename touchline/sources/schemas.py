"""Explicit schemas: raw payloads, bronze tables, history columns.  Ids are LONG."""

from __future__ import annotations

# fixed values: field names and types of the payloads and tables
TEAM_REF = "struct<id:long,name:string,shortName:string>"
GOALS = "struct<home:int,away:int>"
SCORE = f"struct<winner:string,fullTime:{GOALS},halfTime:{GOALS}>"
MATCH = (
    "struct<id:long,utcDate:string,status:string,matchday:int,stage:string,lastUpdated:string,season:struct<id:long>,"
    f"homeTeam:{TEAM_REF},awayTeam:{TEAM_REF},score:{SCORE}>"
)
MATCH_PAYLOAD = f"competition struct<id:long,name:string,code:string>, matches array<{MATCH}>"
TEAM = (
    "struct<id:long,name:string,shortName:string,tla:string,crest:string,address:string,website:string,"
    "founded:int,clubColors:string,venue:string>"
)
TEAM_PAYLOAD = f"competition struct<id:long,name:string,code:string>, teams array<{TEAM}>"
STANDING = (
    "struct<position:int,team:struct<id:long,name:string>,playedGames:int,won:int,draw:int,lost:int,points:int,"
    "goalsFor:int,goalsAgainst:int,goalDifference:int>"
)
STANDING_PAYLOAD = (
    f"competition struct<id:long,name:string,code:string>, standings array<struct<table:array<{STANDING}>>>"
)

MATCHES = (
    "match_id long, utc_date string, status string, matchday int, stage string, last_updated string, "
    "competition_id long, competition_name string, competition_code string, "
    "home_team_id long, home_team_name string, home_team_short_name string, "
    "away_team_id long, away_team_name string, away_team_short_name string, "
    "home_score_fulltime int, away_score_fulltime int, home_score_halftime int, away_score_halftime int, "
    "winner string, ingest_timestamp string"
)
TEAMS = (
    "team_id long, team_name string, short_name string, tla string, crest_url string, address string, website string, "
    "founded int, club_colors string, venue string, competition_id long, competition_name string, ingest_timestamp string"
)
STANDINGS = (
    "competition_code string, competition_name string, position int, team_id long, team_name string, played_games int, "
    "won int, draw int, lost int, points int, goals_for int, goals_against int, goal_difference int, ingest_timestamp string"
)
XG_MATCHES = (
    "source string, competition_name string, season string, matchweek string, match_date string, match_time string, "
    "home_team_name string, away_team_name string, home_score string, away_score string, home_xg double, away_xg double, "
    "attendance string, venue string, referee string, ingest_timestamp string"
)
XG_STANDINGS = (
    "source string, competition_name string, season string, position int, team_name string, matches_played int, "
    "wins int, draws int, losses int, goals_for int, goals_against int, goal_difference int, points int, "
    "xg double, xga double, ingest_timestamp string"
)
PLAYER_IDENTITY = (
    "source string, stat_type string, competition_name string, season string, player_name string, nationality string, "
    "position string, team_name string, age string, birth_year int"
)
PLAYER_STATS = (
    f"{PLAYER_IDENTITY}, matches_played int, starts int, minutes int, nineties double, "
    "goals int, assists int, goals_assists int, non_penalty_goals int, penalty_goals int, penalty_attempts int, "
    "yellow_cards int, red_cards int, xg double, npxg double, xa double, xg_xa double, "
    "goals_per90 double, assists_per90 double, xg_per90 double, xa_per90 double, "
    "shots int, shots_on_target int, shot_accuracy double, shots_per90 double, "
    "passes_completed int, passes_attempted int, pass_completion_pct double, key_passes int, "
    "passes_into_final_third int, passes_into_penalty_area int, progressive_passes int, "
    "tackles int, tackles_won int, interceptions int, blocks int, clearances int, "
    "sca int, sca_per90 double, gca int, gca_per90 double, ingest_timestamp string"
)
