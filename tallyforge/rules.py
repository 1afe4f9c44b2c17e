"""The rule catalogue of the landed datasets."""

from __future__ import annotations

# Checks of landed datasets (fixed values).
_ONCE = ("missing_count({0}) = 0", "duplicate_count({0}) = 0")
RULES: dict[str, list[str]] = {
    "castaway_details": [r.format("castaway_id") for r in _ONCE],
    "season_summary": [r.format("version_season") for r in _ONCE],
    **{
        name: [f"missing_count({c}) = 0" for c in columns]
        for name, columns in {
            "episodes": ("version_season", "episode"),
            "advantage_details": ("advantage_id", "version_season"),
            "challenge_description": ("challenge_id", "version_season"),
            "challenge_summary": ("version_season", "challenge_id"),
            "auction_details": ("version_season", "auction_num", "item"),
            "advantage_movement": ("version_season", "advantage_id", "sequence_id"),
            "journeys": ("version_season", "sog_id"),
            "tribe_mapping": ("version_season", "tribe"),
            "vote_history": ("version_season",),
        }.items()
    },
}
