"""Values that results must equal exactly.  Everything here is data, not logic."""

from __future__ import annotations

# --- fixed values: competitions -------------------------------------------------
COMPETITION_CODES = {
    "Eredivisie": "DED",
    "Premier League": "PL",
    "La Liga": "PD",
    "Serie A": "SA",
}

# --- fixed values: match states and results --------------------------------------
MATCH_STATUSES = [
    "SCHEDULED", "TIMED", "IN_PLAY", "PAUSED", "FINISHED",
    "SUSPENDED", "POSTPONED", "CANCELLED", "AWARDED",
]
WINNER_TO_RESULT = {"HOME_TEAM": "HOME", "AWAY_TEAM": "AWAY", "DRAW": "DRAW"}

# --- fixed values: position codes, first hit wins --------------------------------
POSITION_TOKENS = [
    ("Goalkeeper", ["GK"]),
    ("Defender", ["DF", "CB", "FB", "WB"]),
    ("Midfielder", ["MF", "DM", "CM", "AM"]),
    ("Forward", ["FW", "ST", "CF", "LW", "RW"]),
]
UNKNOWN = "Unknown"

# --- fixed values: table zones ---------------------------------------------------
ZONE_TOP = [(4, "Champions League"), (6, "Europa League")]
ZONE_BOTTOM = "Relegation Zone"
ZONE_MIDDLE = "Mid-table"
SNAPSHOT_ZONES_TOP = [
    (4, "Champions League Zone"),
    (6, "Europa League Zone"),
    (7, "Conference League Zone"),
]
SNAPSHOT_ZONES_BOTTOM = [(18, "Relegation Zone"), (15, "Relegation Battle")]
PAYLOAD_ZONES_TOP = [(4, "Champions League"), (6, "Europa League"), (7, "Conference League")]
PAYLOAD_ZONES_BOTTOM = [(16, "Relegation")]

# --- fixed values: team form -----------------------------------------------------
FORM_RATINGS = [(13, "🔥 Excellent"), (10, "✅ Good"), (7, "➡️ Average"), (4, "⚠️ Poor")]
FORM_RATING_REST = "❌ Very Poor"

# --- fixed values: rankings (rank up to n, label) ---------------------------------
SCORER_STATUS = [(1, "🥇 Leader"), (3, "🥈 Contender"), (5, "🥉 In Race")]
SCORER_STATUS_REST = "Chasing"
ASSISTER_STATUS = [(1, "🎯 Top Playmaker"), (3, "Elite Creator"), (10, "Key Player")]
ASSISTER_STATUS_REST = "Contributor"

# --- fixed values: expected-goals ladders (difference at least n, label) ----------
FINISHING_CATEGORY = [(5, "Elite Finisher"), (2, "Clinical"), (0, "On Par"), (-2, "Slightly Wasteful")]
CREATIVE_CATEGORY = [(3, "Elite Creator"), (1, "Quality Provider"), (0, "On Par")]
CATEGORY_REST = "Underperforming"

# --- fixed values: key hashing ----------------------------------------------------
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
HASH_SEPARATOR = "|"

# --- fixed values: scores in text use an en dash ---------------------------------
SCORE_DASH = "–"

# --- fixed values: reference year for ages ---------------------------------------
REFERENCE_YEAR = 2025
