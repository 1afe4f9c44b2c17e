"""The eight silver and two gold models: per-event tables with flags, and one row of features for each person and season.

Each model takes bronze or silver DataFrames and returns one. Column expressions are written in SQL that other engines read
too, so that the same text serves the checks; joins, groups and windows are DataFrame code. No model carries its time of building:
``build_models`` adds ``created_at``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import operators as O

#: Skills with a win and a participation flag (fixed values).
SKILLS = ("balance", "endurance", "knowledge", "memory", "precision", "puzzle", "race", "strength", "water")
#: Flags of people that compositions count (fixed values).
ORIGINS = ("african", "asian", "latin_american", "native_american", "bipoc", "lgbt")

PHASE = "CASE WHEN tribe_status ILIKE '%merge%' THEN 'post_merge' ELSE 'pre_merge' END"
PERSON = ["castaway_id", "version_season"]


def same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


def flag(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"


def truth(condition: str) -> str:
    return f"CASE WHEN {condition} THEN true ELSE false END"


def key(*names: str) -> str:
    return "md5(concat(" + ", '|', ".join(f"coalesce(CAST({n} AS STRING), '')" for n in names) + "))"


def total(value: str) -> str:
    return f"CAST(sum({value}) AS BIGINT)"


def total_if(condition: str, value: str = "1") -> str:
    return total(f"CASE WHEN {condition} THEN {value} ELSE 0 END")


def over(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif({whole}, 0)"


def pick(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*(F.expr(e).alias(n) for n, e in columns.items()))


def per(df: DataFrame, keys: dict[str, str], columns: dict[str, str]) -> DataFrame:
    return df.groupBy(*(F.expr(e).alias(n) for n, e in keys.items())).agg(*(F.expr(e).alias(n) for n, e in columns.items()))


# Silver: votes

VOTE_BASE = {
    "castaway_id": "castaway_id", **same("version_season", "episode", "day", "tribe", "tribe_status"), "merge_phase": PHASE,
    "target_id": "vote_id",
    **same("voted_out_id", "immunity", "vote_event", "vote_event_outcome", "split_vote", "nullified", "tie", "vote_order")
}
VOTE_DYNAMICS = {
    "vote_dynamics_key": key("castaway_id", "version_season", "episode"),
    **same(*VOTE_BASE),
    "vote_correct": flag("voted_out_id = target_id"),
    "vote_incorrect": flag("voted_out_id <> target_id OR voted_out_id IS NULL"),
    "vote_nullified": flag("nullified"),
    **same("total_voters", "aligned_votes", "alignment_ratio"),
    "in_majority_alliance": flag("alignment_ratio >= 0.5"),
    "voting_alone": flag("alignment_ratio < 0.3"),
    "split_vote_scenario": flag("split_vote = 'split'"),
    "tie_vote_scenario": flag("tie"),
    "has_immunity": flag("length(immunity) > 0"),
}


def vote_dynamics(vote_history: DataFrame) -> DataFrame:
    """One row per vote with a target. Alignment joins without the phase, so an episode that holds both phases has a row for each."""
    votes = pick(vote_history.where("vote_id IS NOT NULL"), VOTE_BASE)
    group = ["version_season", "episode"]
    aligned = O.pairwise_alignment(votes, group, "castaway_id", "target_id", ["merge_phase"]).drop("merge_phase")
    aligned = aligned.withColumnsRenamed({"total_others": "total_voters", "aligned_others": "aligned_votes"})
    return pick(votes.join(aligned, [*group, "castaway_id"], "left"), VOTE_DYNAMICS)


# Silver: advantages

PLAYED = "event_type LIKE '%played%'"
ADVANTAGE_BASE = {
    **same("castaway_id", "version_season", "episode", "day", "advantage_id", "sequence_id"), "event_type": "lower(event)",
    "target_castaway_id": "played_for_id", **same("co_castaway_ids", "joint_play", "multi_target_play"),
    "success_outcome": "lower(success)", **same("votes_nullified", "advantage_type", "clue_details", "location_found", "conditions")
}
ADVANTAGE_STRATEGY = {
    "advantage_strategy_key": key("castaway_id", "version_season", "advantage_id", "sequence_id"),
    **same(*ADVANTAGE_BASE),
    "event_category": "CASE WHEN event_type LIKE '%found%' THEN 'found' WHEN event_type LIKE '%played%' THEN 'played' WHEN event_type LIKE '%received%' THEN 'received' WHEN event_type LIKE '%gifted%' OR event_type LIKE '%shared%' THEN 'shared' ELSE 'other' END",
    "advantage_category": "CASE WHEN advantage_type ILIKE '%idol%' THEN 'idol' WHEN advantage_type ILIKE '%immunity%' THEN 'immunity' WHEN advantage_type ILIKE '%vote%' THEN 'vote_modifier' WHEN advantage_type ILIKE '%advantage%' THEN 'advantage' ELSE 'other' END",
    "played_successfully": flag(f"{PLAYED} AND success_outcome = 'yes'"),
    "played_unsuccessfully": flag(f"{PLAYED} AND success_outcome IN ('no', 'not needed')"),
    "played_for_self": flag(f"{PLAYED} AND coalesce(target_castaway_id = castaway_id, target_castaway_id IS NULL)"),
    "played_for_others": flag(f"{PLAYED} AND target_castaway_id <> castaway_id"),
}


def advantage_strategy(advantage_movement: DataFrame, advantage_details: DataFrame) -> DataFrame:
    details = advantage_details.select("version_season", "advantage_id", "advantage_type", "clue_details", "location_found", "conditions")
    return pick(pick(advantage_movement.join(details, ["version_season", "advantage_id"]), ADVANTAGE_BASE), ADVANTAGE_STRATEGY)


# Silver: challenges

CHALLENGE_BASE = {
    **same("castaway_id", "version_season", "episode", "challenge_id", "challenge_type"), "challenge_name": "name",
    "recurring_name": "recurring_name", "result": "lower(result)", "won_flag": flag("result ILIKE '%win%'"),
    **same("chosen_for_reward", "sit_out", "order_of_finish", "team", "tribe_status")
}
CHALLENGE_PERFORMANCE = {
    "challenge_performance_key": key("castaway_id", "version_season", "challenge_id"),
    **same(*CHALLENGE_BASE),
    "merge_phase": PHASE,
    "challenge_format": "CASE WHEN challenge_type ILIKE '%individual%' THEN 'individual' WHEN challenge_type ILIKE '%tribe%' OR challenge_type ILIKE '%team%' THEN 'team' ELSE 'other' END",
    **{f"{s}_win": flag(f"won_flag = 1 AND {s}") for s in SKILLS},
    **{f"{s}_participated": flag(s) for s in SKILLS},
}


def challenge_performance(challenge_results: DataFrame, challenge_description: DataFrame) -> DataFrame:
    described = challenge_description.select("version_season", "challenge_id", "challenge_type", "name", "recurring_name", *SKILLS)
    joined = challenge_results.join(described, ["version_season", "challenge_id"])
    return pick(pick(joined, CHALLENGE_BASE | same(*SKILLS)), CHALLENGE_PERFORMANCE)


# Silver: confessionals

EDIT_FEATURES = {
    "edit_features_key": key("castaway_id", "version_season", "episode"),
    **same("castaway_id", "version_season", "episode", "confessional_count", "confessional_time"),
    "expected_confessional_count": "exp_count",
    "expected_confessional_time": "exp_time",
    "confessional_count_ratio": "CASE WHEN exp_count > 0 THEN confessional_count / CAST(exp_count AS DOUBLE) END",
    "confessional_time_ratio": "CASE WHEN exp_time > 0 THEN confessional_time / CAST(exp_time AS DOUBLE) END",
    "has_confessional": flag("confessional_count > 0"),
    "high_confessional_count": flag("confessional_count >= 3"),
    "high_confessional_time": flag("confessional_time >= 60"),
    **{
        f"{side}_edited_{c}": flag(f"exp_{c} > 0 AND confessional_{c} {sign} exp_{c}") for side,
        sign in (("over", ">"), ("under", "<")) for c in ("count", "time")
    },
}


def edit_features(confessionals: DataFrame) -> DataFrame:
    return pick(confessionals, EDIT_FEATURES)


# Silver: jury

JURY_ANALYSIS = {
    "jury_analysis_key": key("castaway_id", "version_season", "finalist_id"),
    **same("castaway_id", "version_season", "finalist_id", "voted_for_finalist_name", "actual_winner_id"),
    "voted_for_winner": flag("finalist_id = actual_winner_id"),
    "voted_against_winner": flag("finalist_id <> actual_winner_id"),
    **same("juror_original_tribe", "finalist_original_tribe"),
    "same_original_tribe": flag("juror_original_tribe = finalist_original_tribe"),
    "different_original_tribe": flag("juror_original_tribe <> finalist_original_tribe"),
}


def original_tribes(castaways: DataFrame) -> DataFrame:
    """The first tribe known of each person and season."""
    return O.first_per_key(castaways.where("original_tribe IS NOT NULL"), PERSON, "episode").select(*PERSON, "original_tribe")


def jury_analysis(jury_votes: DataFrame, season_summary: DataFrame, castaways: DataFrame) -> DataFrame:
    votes = jury_votes.select("castaway_id", "version_season", "finalist_id", F.col("vote").alias("voted_for_finalist_name"))
    votes = votes.join(F.broadcast(season_summary.select("version_season", F.col("winner_id").alias("actual_winner_id"))), "version_season")
    tribes = original_tribes(castaways)
    votes = votes.join(tribes.withColumnRenamed("original_tribe", "juror_original_tribe"), PERSON, "left")
    votes = votes.join(
        tribes.select(
            F.col("castaway_id").alias("finalist_id"), "version_season", F.col("original_tribe").alias("finalist_original_tribe")
        ),
        ["finalist_id", "version_season"], "left"
    )
    return pick(votes, JURY_ANALYSIS)


# Silver: people

PROFILE = {
    "castaways": ["castaway_id", "full_name", "season", "castaway", "age", "city", "state"],
    "castaway_details": ["personality_type", "occupation", "gender", *ORIGINS, "race", "ethnicity"],
    "season_summary": {
        "season_location": "location", "season_country": "country", "tribe_setup": "tribe_setup", "season_name": "full_name",
        **same("viewers_premiere", "viewers_finale", "viewers_reunion"), "season_avg_viewers": "viewers_mean"
    },
}


def castaway_profile(castaways: DataFrame, castaway_details: DataFrame, season_summary: DataFrame) -> DataFrame:
    """Distinct people with their details. Seasons join by number alone, so equal numbers of two versions both match."""
    seasons = F.broadcast(season_summary.select("season", *(F.col(e).alias(n) for n, e in PROFILE["season_summary"].items())))
    joined = castaways.select(*PROFILE["castaways"]).join(
        castaway_details.select("castaway_id", *PROFILE["castaway_details"]), "castaway_id", "left"
    ).join(seasons, "season", "left")
    return joined.select(*PROFILE["castaways"], *PROFILE["castaway_details"], *PROFILE["season_summary"]).distinct()


# Silver: seasons

HOLDS = {"male": "gender ILIKE 'male'", "female": "gender ILIKE 'female'", **same(*ORIGINS)}
CAST_GROUPS = {**{k: HOLDS[k] for k in ("male", "female", "bipoc", "lgbt")}, "returnee": "is_returning_player"}
DEMOGRAPHICS = {
    "total_cast": "count(*)",
    **{f"{n}_count": f"coalesce({total_if(p)}, 0)" for n, p in CAST_GROUPS.items()},
    **{f"{n}_ratio": over(total_if(p), "count(*)") for n, p in CAST_GROUPS.items()},
    "average_age": "avg(age)", "min_age": "min(age)", "max_age": "max(age)", "age_stddev": "stddev(age)",
}
SEASON_BASE = {
    **same("version", "version_season", "season_name"), "season_number": "season", **same("location", "country", "tribe_setup"),
    "cast_size": "n_cast", "tribe_count": "n_tribes", "finalist_count": "n_finalists", "jury_count": "n_jury",
    **same("premiered", "ended", "filming_started", "filming_ended"), "winner_castaway_id": "winner_id",
    **same("winner", "runner_ups", "final_vote", "timeslot", "viewers_reunion", "viewers_premiere", "viewers_finale", "viewers_mean", "rank"),
}
SEASON_CONTEXT = {
    "season_context_key": key("version_season"),
    **same(*SEASON_BASE),
    "season_era": "CASE WHEN season_number <= 10 THEN 'early' WHEN season_number <= 20 THEN 'middle' WHEN season_number <= 30 THEN 'modern' WHEN season_number <= 40 THEN 'new_school' ELSE 'new_era' END",
    "is_new_era_format": truth("cast_size <= 18"),
    "season_recency_weight": "CASE WHEN max_season > min_season THEN 1 - CAST(max_season - season_number AS DOUBLE) / (max_season - min_season) ELSE 1.0 END",
    "has_edge_of_extinction": truth("tribe_setup ILIKE '%edge%' OR tribe_setup ILIKE '%extinction%'"),
    "has_redemption_island": truth("tribe_setup ILIKE '%redemption%'"),
    "has_tribe_swap": truth("tribe_setup ILIKE '%swap%'"),
    "has_merge_twist": truth("tribe_setup ILIKE '%merge%'"),
    **same(*DEMOGRAPHICS),
    "high_diversity_cast": truth("bipoc_ratio >= 0.4"),
    "mixed_returnee_cast": truth("returnee_ratio > 0 AND returnee_ratio < 1"),
    "all_returnee_cast": truth("returnee_ratio = 1"),
    "all_newbie_cast": truth("returnee_ratio = 0"),
}


def season_context(season_summary: DataFrame, castaways: DataFrame, castaway_details: DataFrame) -> DataFrame:
    """One row per season. A person counts as returning if the details hold several rows for them; a season without a number is of the last era."""
    people = castaway_details.select(
        "castaway_id", "gender", "bipoc", "lgbt",
        (F.count(F.lit(1)).over(Window.partitionBy("castaway_id")) > 1).alias("is_returning_player")
    )
    mix = per(castaways.select("castaway_id", "version_season", "age").join(people, "castaway_id"), same("version_season"), DEMOGRAPHICS)
    seasons = pick(season_summary, SEASON_BASE)
    bounds = seasons.agg(F.min("season_number").alias("min_season"), F.max("season_number").alias("max_season"))
    return pick(seasons.crossJoin(F.broadcast(bounds)).join(mix, "version_season", "left"), SEASON_CONTEXT)


# Silver: tribes

COMPOSITION = {
    "tribe_size": "count(*)", **{f"{n}_count": total_if(p) for n, p in HOLDS.items()},
    **{f"{n}_ratio": over(total_if(p), "count(*)") for n, p in HOLDS.items()}
}
TRIBE_BASE = {**same("castaway_id", "version_season", "episode", "day", "tribe", "tribe_status"), "merge_phase": PHASE}
TRIBE = ["version_season", "episode", "tribe"]
PEOPLE = ["gender", *ORIGINS, "race", "ethnicity"]
SHARE = over("original_tribe_members", "total_tribe_members")


def minority(name: str, label: str) -> str:
    return f"CASE WHEN {name} AND {name}_ratio < 0.5 OR NOT {name} AND {name}_ratio > 0.5 THEN '{label}_minority' ELSE '{label}_majority' END"


SOCIAL_POSITIONING = {
    "social_positioning_key": key("castaway_id", *TRIBE),
    **same(*TRIBE_BASE, *PEOPLE, *COMPOSITION),
    "same_gender_ratio": f"CASE WHEN {HOLDS['male']} THEN male_ratio ELSE female_ratio END",
    **{f"{n}_similarity_ratio": f"CASE WHEN {n} THEN {n}_ratio ELSE 1 - {n}_ratio END" for n in ("lgbt", "bipoc")},
    **same("original_tribe", "original_tribe_members", "total_tribe_members"),
    "original_tribe_proportion": f"CASE WHEN merge_phase = 'post_merge' THEN {SHARE} END",
    "original_tribe_status": f"CASE WHEN merge_phase = 'post_merge' AND original_tribe_members IS NOT NULL THEN CASE WHEN {SHARE} < 0.5 THEN 'minority' ELSE 'majority' END END",
    "gender_status": f"CASE WHEN {HOLDS['male']} AND male_ratio < 0.5 OR {HOLDS['female']} AND female_ratio < 0.5 THEN 'gender_minority' ELSE 'gender_majority' END",
    "racial_status": minority("bipoc", "racial"),
    "lgbt_status": minority("lgbt", "lgbt"),
}


def social_positioning(tribe_mapping: DataFrame, castaway_details: DataFrame, castaways: DataFrame) -> DataFrame:
    """One row per person, episode and tribe, for each phase that the tribe has in the episode.

    The share of an original tribe is that of its members over the number of original tribes present, so it may exceed one.
    """
    stays, people = pick(tribe_mapping, TRIBE_BASE), castaway_details.select("castaway_id", *PEOPLE)
    members, tribes = stays.join(people, "castaway_id"), original_tribes(castaways)
    mix = per(members, same(*TRIBE, "merge_phase"), COMPOSITION).drop("merge_phase")
    merged = stays.where("merge_phase = 'post_merge'").join(tribes, PERSON)
    origins = O.groups_per_partition(merged, TRIBE, "original_tribe").withColumnsRenamed(
        {"n_rows": "original_tribe_members", "n_groups": "total_tribe_members"}
    )
    rows = members.join(mix, TRIBE).join(tribes, PERSON, "left").join(origins, [*TRIBE, "original_tribe"], "left")
    return pick(rows, SOCIAL_POSITIONING)


# Gold: parts with a row per person and season

ALONE, GROUP_FORMAT = "challenge_format = 'individual'", "challenge_format = 'team'"
PRE, POST = "merge_phase = 'pre_merge'", "merge_phase = 'post_merge'"
CHALLENGE_STATS = {
    "total_challenges": "count(*)", "challenges_won": total("won_flag"), "individual_wins": total_if(ALONE, "won_flag"),
    "team_wins": total_if(GROUP_FORMAT, "won_flag"),
    "pre_merge_wins": total_if(PRE, "won_flag"), "post_merge_wins": total_if(POST, "won_flag"),
    "reward_selections": total("CAST(chosen_for_reward AS INT)"), "challenge_sitouts": total("CAST(sit_out AS INT)"),
    "individual_win_rate": over(total_if(ALONE, "won_flag"), total_if(ALONE)),
    "team_win_rate": over(total_if(GROUP_FORMAT, "won_flag"), total_if(GROUP_FORMAT)),
    **{f"{s}_wins": total(f"{s}_win") for s in SKILLS},
    **{f"{s}_participation_rate": over(total(f"{s}_participated"), "count(*)") for s in ("balance", "endurance", "puzzle", "strength")},
}
IDOL, PLAY = "advantage_category = 'idol'", "event_category = 'played'"
ADVANTAGE_STATS = {
    "advantages_found": total_if("event_category = 'found'"), "advantages_played": total_if(PLAY),
    "idols_found": total_if(f"{IDOL} AND event_category = 'found'"), "idols_played": total_if(f"{IDOL} AND {PLAY}"),
    **{f"advantages_{x}": total(x) for x in ("played_successfully", "played_unsuccessfully", "played_for_self", "played_for_others")},
    "advantage_success_rate": over(total("played_successfully"), total_if(PLAY)),
    "idol_success_rate": over(total_if(IDOL, "played_successfully"), total_if(f"{IDOL} AND {PLAY}")),
}
VOTE_STATS = {
    "total_votes_cast": "count(*)", "votes_correct": total("vote_correct"), "votes_incorrect": total("vote_incorrect"),
    "pre_merge_tribals_attended": total_if(PRE), "post_merge_tribals_attended": total_if(POST),
    "pre_merge_correct_votes": total_if(PRE, "vote_correct"), "post_merge_correct_votes": total_if(POST, "vote_correct"),
    "majority_alliance_votes": total("in_majority_alliance"), "lone_wolf_votes": total("voting_alone"), "avg_vote_alignment": "avg(alignment_ratio)",
    "vote_accuracy_rate": over(total("vote_correct"), "count(*)"),
    "pre_merge_accuracy_rate": over(total_if(PRE, "vote_correct"), total_if(PRE)),
    "post_merge_accuracy_rate": over(total_if(POST, "vote_correct"), total_if(POST)),
    "majority_alliance_rate": over(total("in_majority_alliance"), "count(*)"), "lone_wolf_rate": over(total("voting_alone"), "count(*)"),
}
VOTES_RECEIVED_STATS = {"total_votes_received": "count(*)", "pre_merge_votes_received": total_if(PRE), "post_merge_votes_received": total_if(POST)}
SOCIAL_STATS = {
    **{f"avg_{n}": f"avg({n})" for n in ("same_gender_ratio", "lgbt_similarity_ratio", "bipoc_similarity_ratio")},
    "avg_original_tribe_strength": f"avg(CASE WHEN {POST} THEN original_tribe_proportion END)",
    **{f"{n}_minority_rate": over(total_if(f"{n}_status = '{n}_minority'"), "count(*)") for n in ("gender", "racial", "lgbt")},
    "original_tribe_minority_rate": over(total_if("original_tribe_status = 'minority'"), total_if(POST)),
}
JURY_STATS = {
    "jury_votes_received": "count(*)", "jury_votes_from_original_tribe": total("same_original_tribe"),
    "original_tribe_jury_support_rate": over(total("same_original_tribe"), "count(*)")
}
OF_PERSON, OF_TARGET, OF_FINALIST = same(*PERSON), {"castaway_id": "target_id", "version_season": "version_season"}, {
    "castaway_id": "finalist_id", "version_season": "version_season"
}
#: Silver table, keys and measures of each part.
PARTS = [
    ("challenge_performance", OF_PERSON, CHALLENGE_STATS), ("advantage_strategy", OF_PERSON, ADVANTAGE_STATS), ("vote_dynamics", OF_PERSON, VOTE_STATS),
    ("vote_dynamics", OF_TARGET, VOTES_RECEIVED_STATS), ("social_positioning", OF_PERSON, SOCIAL_STATS), ("jury_analysis", OF_FINALIST, JURY_STATS),
]
TARGETS = {
    "ml_features_key": key(*PERSON), **same(*PERSON), "target_winner": flag("winner"), "target_finalist": flag("finalist"),
    "target_jury": flag("jury"), "target_placement": "CAST(round(try_cast(place AS DOUBLE)) AS INT)"
}
OF_PROFILE = {
    **same("gender", "race", "ethnicity", "occupation", "personality_type"), "current_age": "age",
    **{f"is_{o}": f"CAST({o} AS INT)" for o in ORIGINS}
}
OF_SEASON = {
    **same("season_number", "season_era"), "is_new_era_format": "CAST(is_new_era_format AS INT)",
    **same("season_recency_weight", "cast_size", "finalist_count", "jury_count"),
    **{f"season_{n}_ratio": f"{n}_ratio" for n in ("male", "female", "bipoc", "returnee")}, "season_average_age": "average_age",
    **{
        n: f"CAST({n} AS INT)" for n in (
            "has_edge_of_extinction", "has_redemption_island", "has_tribe_swap", "all_newbie_cast", "all_returnee_cast",
            "mixed_returnee_cast"
        )
    },
}


def person_features(castaways: DataFrame, silver: dict[str, DataFrame]) -> DataFrame:
    """The last row with a result of each person and season, with its measures and its season's: one row each, all joined where persons and seasons already meet."""
    base = pick(O.last_per_key(castaways.where("result IS NOT NULL"), PERSON, "episode"), TARGETS)
    parts = [per(silver[table], keys, measures) for table, keys, measures in PARTS]
    rows = O.feature_matrix(base, parts, PERSON, dict.fromkeys((m for _, _, part in PARTS for m in part), 0))
    return rows.join(F.broadcast(pick(silver["season_context"], same("version_season") | OF_SEASON)), "version_season", "left")


def with_profiles(features: DataFrame, castaway_profile: DataFrame) -> DataFrame:
    """``features`` with what is known of the person. Profiles join by person alone, so one with several seasons has a row for each; they come last, so that no step before has to carry these rows."""
    joined = features.join(pick(castaway_profile, same("castaway_id") | OF_PROFILE), "castaway_id", "left")
    more = [c for c in features.columns if c not in TARGETS and c not in OF_SEASON]
    return joined.select(*TARGETS, *OF_PROFILE, *OF_SEASON, *more)


def ml_features_non_edit(castaways: DataFrame, silver: dict[str, DataFrame]) -> DataFrame:
    """The last row with a result of each person and season, with what the silver tables say of them."""
    return with_profiles(person_features(castaways, silver), silver["castaway_profile"])


EDIT_STATS = {
    **{
        f"total_{n}": total(n) if n.endswith("confessional_count") else f"sum({n})" for n in (
            "confessional_count", "confessional_time", "expected_confessional_count", "expected_confessional_time"
        )
    },
    "episodes_with_confessionals": total("has_confessional"), "high_confessional_episodes": total("high_confessional_count"),
    "high_confessional_time_episodes": total("high_confessional_time"),
    **{f"{side}_edited_{c}_episodes": total(f"{side}_edited_{c}") for side in ("over", "under") for c in ("count", "time")},
    "total_episodes_appeared": "count(*)",
    **{f"overall_confessional_{c}_ratio": over(f"sum(confessional_{c})", f"sum(expected_confessional_{c})") for c in ("count", "time")},
    "confessional_presence_rate": over(total("has_confessional"), "count(*)"),
    **{f"{side}_edited_rate": over(total(f"{side}_edited_count"), "count(*)") for side in ("over", "under")},
    **{f"avg_confessional_{c}_per_episode": f"avg(confessional_{c})" for c in ("count", "time")},
}
EDIT_STATS["total_expected_confessional_count"] = "sum(expected_confessional_count)"
EDIT_FLAGS = {
    "has_any_confessionals": "total_confessional_count > 0",
    "high_edit_presence": "confessional_presence_rate >= 0.5",
    "significantly_over_edited": "overall_confessional_count_ratio > 1.2",
    "significantly_under_edited": "overall_confessional_count_ratio < 0.8",
    "edit_and_challenge_success": "total_confessional_count > 0 AND challenges_won > 0",
    "edit_and_advantage_success": "total_confessional_count > 0 AND advantages_found > 0",
    "edit_and_strategic_success": "confessional_presence_rate >= 0.5 AND vote_accuracy_rate >= 0.7",
}


def ml_features_hybrid(non_edit: DataFrame, edit: DataFrame) -> DataFrame:
    """The matrix, with profiles or before them, and confessionals. Flags look at the values before defaults, so people without any have zeros."""
    joined = non_edit.join(per(edit, OF_PERSON, EDIT_STATS), PERSON, "left")
    flagged = joined.select("*", *(F.expr(flag(e)).alias(n) for n, e in EDIT_FLAGS.items()))
    return flagged.fillna(dict.fromkeys(EDIT_STATS, 0)).select(*non_edit.columns, *EDIT_STATS, *EDIT_FLAGS)


def castaway_features(
    castaways: DataFrame, castaway_details: DataFrame, version_season: str | None = None, episode: tuple[str, int] | None = None
) -> DataFrame:
    """People with their details and ``returning_player``, of one season or of the episodes that a comparison (=, < or >) allows."""
    nth = F.row_number().over(Window.partitionBy("castaway_id").orderBy("version_season"))
    rows = castaways.select(*PERSON, "age", "state", "episode", (nth > 1).alias("returning_player"))
    if version_season:
        rows = rows.where(F.col("version_season") == version_season)
    if episode:
        operator, number = episode
        compare = {"=": F.col("episode") == number, "<": F.col("episode") < number, ">": F.col("episode") > number}
        if operator not in compare:
            raise ValueError(f"{operator} isn't one of {', '.join(compare)}")
        rows = rows.where(compare[operator])
    details = castaway_details.select("castaway_id", "gender", *ORIGINS, "personality_type", "occupation")
    return rows.join(details, "castaway_id", "left")


#: Silver models and the bronze tables that each takes, in order.
SILVER = {
    vote_dynamics: ["vote_history"],
    advantage_strategy: ["advantage_movement", "advantage_details"],
    challenge_performance: ["challenge_results", "challenge_description"],
    edit_features: ["confessionals"],
    jury_analysis: ["jury_votes", "season_summary", "castaways"],
    castaway_profile: ["castaways", "castaway_details", "season_summary"],
    season_context: ["season_summary", "castaways", "castaway_details"],
    social_positioning: ["tribe_mapping", "castaway_details", "castaways"],
}


def build_models(bronze: dict[str, DataFrame], at: str | None = None) -> dict[str, DataFrame]:
    """All ten models by name; with ``at``, each has it as ``created_at``. Plans are lazy: write what is used twice."""
    built = {model.__name__: model(*(bronze[n] for n in names)) for model, names in SILVER.items()}
    features = person_features(bronze["castaways"], built)
    built["ml_features_non_edit"] = with_profiles(features, built["castaway_profile"])
    built["ml_features_hybrid"] = with_profiles(ml_features_hybrid(features, built["edit_features"]), built["castaway_profile"])
    return {n: df.withColumn("created_at", F.to_timestamp(F.lit(at))) for n, df in built.items()} if at else built
