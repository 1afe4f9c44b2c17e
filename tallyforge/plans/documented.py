"""Analyst questions over the bronze tables and the models, and SQL written apart that must give the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as T
from .. import operators as O
from . import models as M
from .game import bronze, silver_of, sql_over
from .registry import query

PERSON = M.PERSON


def _gold(t, hybrid: bool = False) -> DataFrame:
    built = M.build_models(bronze(t))
    return built["ml_features_hybrid" if hybrid else "ml_features_non_edit"]


@query(
    sql_over(
        """SELECT version_season, count(episode) AS count_split_vote_tribals FROM vote_history WHERE split_vote IS NOT NULL AND split_vote <> 'No'
    GROUP BY version_season""",
        "vote_history"
    )
)
def split_vote_tribals(t):
    votes = bronze(t, "vote_history")["vote_history"].where("split_vote IS NOT NULL AND split_vote <> 'No'")
    return votes.groupBy("version_season").agg(F.count("episode").alias("count_split_vote_tribals"))


@query(sql_over("""SELECT fc.version_season, fc.castaway, fc.total_confessionals, fc.total_screen_time, coalesce(jv.votes, 0) AS jury_votes,
  CASE WHEN fc.winner THEN 'Winner' ELSE 'Runner-up' END AS result
  FROM (SELECT c.castaway_id, c.version_season, c.castaway, c.winner, sum(e.confessional_count)::BIGINT AS total_confessionals,
    sum(e.confessional_time) AS total_screen_time
        FROM castaways c JOIN confessionals e ON c.castaway_id = e.castaway_id AND c.version_season = e.version_season WHERE c.finalist GROUP BY ALL) fc
  LEFT JOIN (SELECT finalist_id, version_season, count(*) AS votes FROM jury_votes GROUP BY ALL) jv ON fc.castaway_id = jv.finalist_id
    AND fc.version_season = jv.version_season""", "castaways", "confessionals", "jury_votes"))  # fmt: skip
def finalist_edit_and_jury(t):
    """Confessionals of finalists next to the jury votes that they got; both sides are aggregated before they meet."""
    b = bronze(t, "castaways", "confessionals", "jury_votes")
    shown = b["castaways"].where("finalist").join(b["confessionals"].select(*PERSON, "confessional_count", "confessional_time"), PERSON)
    shown = shown.groupBy(*PERSON, "castaway", "winner").agg(
        F.sum("confessional_count").alias("total_confessionals"), F.sum("confessional_time").alias("total_screen_time")
    )
    votes = b["jury_votes"].groupBy(F.col("finalist_id").alias("castaway_id"), "version_season").agg(F.count(F.lit(1)).alias("_votes"))
    result = F.when(F.col("winner"), "Winner").otherwise("Runner-up")
    return shown.join(votes, PERSON, "left").select(
        "version_season", "castaway", "total_confessionals", "total_screen_time", F.coalesce("_votes", F.lit(0)).alias("jury_votes"),
        result.alias("result")
    )


@query(
    sql_over(
        """SELECT castaway_id, version_season, target_winner, challenges_won FROM ml_features_hybrid ORDER BY castaway_id, version_season,
    challenges_won LIMIT 10"""
    )
)
def first_gold_rows(t):
    """The first ten rows of the matrix: a report, so its limit is the point."""
    return _gold(t, hybrid=True).orderBy("castaway_id", "version_season", "challenges_won").limit(10).select(
        "castaway_id", "version_season", "target_winner", "challenges_won"
    )


@query(sql_over("""SELECT coalesce(c.full_name, trim(concat_ws(' ', c.castaway, c.city))) AS castaway_name, c.castaway_id, d.personality_type,
  e.confessional_count, e.confessional_time, x.boot_position, 'ABSOLUTELY' AS is_legendary_first_boot
  FROM castaways c JOIN castaway_details d ON d.castaway_id = c.castaway_id JOIN confessionals e ON e.castaway_id = c.castaway_id AND e.episode = 1
  JOIN (SELECT castaway_id, version_season, row_number() OVER (PARTITION BY version_season ORDER BY episode,
    castaway_id) AS boot_position FROM castaways WHERE result = 'out') x ON x.castaway_id = c.castaway_id AND x.version_season = c.version_season
  WHERE x.boot_position <= 3 AND (c.full_name LIKE '%1%' OR c.full_name LIKE '%7%')""", "castaways", "castaway_details", "confessionals"))  # fmt: skip
def first_boot_legends(t):
    """Of the first three out in a season those with certain names, with their first episode's confessionals."""
    b = bronze(t, "castaways", "castaway_details", "confessionals")
    out = Window.partitionBy("version_season").orderBy("episode", "castaway_id")
    first = b["castaways"].where("result = 'out'").withColumn(
        "boot_position", F.row_number().over(out)
    ).where("boot_position <= 3").select(*PERSON, "boot_position")
    named = b["castaways"].withColumn(
        "castaway_name", F.coalesce("full_name", F.trim(F.concat_ws(" ", "castaway", "city")))
    ).where("full_name LIKE '%1%' OR full_name LIKE '%7%'")
    start = b["confessionals"].where("episode = 1").select("castaway_id", "confessional_count", "confessional_time")
    rows = named.join(first, PERSON).join(b["castaway_details"].select("castaway_id", "personality_type"), "castaway_id").join(start, "castaway_id")
    return rows.select(
        "castaway_name", "castaway_id", "personality_type", "confessional_count", "confessional_time", "boot_position",
        F.lit("ABSOLUTELY").alias("is_legendary_first_boot")
    )


@query(
    sql_over(
        """SELECT gender, round(avg(challenges_won), 9) AS avg_challenge_wins, round(avg(vote_accuracy_rate), 9) AS avg_vote_accuracy,
    count(*) AS winner_count FROM ml_features_non_edit WHERE target_winner = 1 GROUP BY gender"""
    )
)
def winners_by_gender(t):
    mean = lambda c: F.round(F.avg(c), 9)
    return _gold(t).where("target_winner = 1").groupBy("gender").agg(
        mean("challenges_won").alias("avg_challenge_wins"), mean("vote_accuracy_rate").alias("avg_vote_accuracy"),
        F.count(F.lit(1)).alias("winner_count")
    )


@query(
    sql_over(
        """SELECT castaway_id, version_season, individual_win_rate, strength_wins + endurance_wins AS physical_score, advantages_found, vote_accuracy_rate,
    majority_alliance_rate FROM ml_features_non_edit WHERE target_jury = 1 OR target_finalist = 1"""
    )
)
def archetype_scores(t):
    rows = _gold(t).where("target_jury = 1 OR target_finalist = 1")
    return rows.select(
        *PERSON, "individual_win_rate", (F.col("strength_wins") + F.col("endurance_wins")).alias("physical_score"), "advantages_found",
        "vote_accuracy_rate", "majority_alliance_rate"
    )


@query(sql_over("""SELECT s.season_era, s.has_edge_of_extinction, round(avg(m.individual_win_rate), 9) AS avg_challenge_performance,
  round(avg(m.vote_accuracy_rate), 9) AS avg_vote_accuracy, round(avg(m.total_confessional_count), 9) AS avg_screen_time
  FROM season_context s JOIN ml_features_hybrid m ON m.version_season = s.version_season WHERE m.target_placement <= 3 GROUP BY ALL"""))
def season_format_impact(t):
    built = M.build_models(bronze(t))
    seasons = built["season_context"].select("version_season", F.col("season_era").alias("era"), "has_edge_of_extinction")
    top = built["ml_features_hybrid"].where("target_placement <= 3").select(
        "version_season", "individual_win_rate", "vote_accuracy_rate", "total_confessional_count"
    )
    mean = lambda c: F.round(F.avg(c), 9)
    found = top.join(seasons, "version_season").groupBy(F.col("era").alias("season_era"), "has_edge_of_extinction")
    return found.agg(
        mean("individual_win_rate").alias("avg_challenge_performance"), mean("vote_accuracy_rate").alias("avg_vote_accuracy"),
        mean("total_confessional_count").alias("avg_screen_time")
    )


@query(sql_over("""SELECT c.castaway_id, c.full_name, d.gender, d.bipoc, coalesce(ch.n, 0) AS challenges_participated, coalesce(ch.won,
  0) AS challenges_won, coalesce(ad.n, 0) AS advantage_actions, round(e.mean, 9) AS avg_confessionals, round(v.right_rate, 9) AS vote_accuracy
  FROM castaways c LEFT JOIN castaway_details d ON d.castaway_id = c.castaway_id
  LEFT JOIN (SELECT castaway_id, version_season, count(*) AS n, count(CASE WHEN lower(result) LIKE '%win%' THEN 1 END) AS won
    FROM challenge_results JOIN challenge_description USING (challenge_id, version_season) GROUP BY ALL) ch ON ch.castaway_id = c.castaway_id
    AND ch.version_season = c.version_season
  LEFT JOIN (SELECT castaway_id, version_season, count(*) AS n FROM advantage_movement JOIN advantage_details USING (advantage_id,
    version_season) GROUP BY ALL) ad ON ad.castaway_id = c.castaway_id AND ad.version_season = c.version_season
  LEFT JOIN (SELECT castaway_id, version_season, avg(CASE WHEN vote_id = voted_out_id THEN 1 ELSE 0 END) AS right_rate FROM vote_history
    WHERE vote_id IS NOT NULL GROUP BY ALL) v ON v.castaway_id = c.castaway_id AND v.version_season = c.version_season
  LEFT JOIN (SELECT castaway_id, version_season, avg(confessional_count) AS mean FROM confessionals
    GROUP BY ALL) e ON e.castaway_id = c.castaway_id AND e.version_season = c.version_season
  WHERE c.version_season = 'Y1995'""", "castaways", "castaway_details", "challenge_results", "challenge_description", "advantage_movement",
    "advantage_details", "confessionals", "vote_history"))
def castaway_overview(t):
    """All strategic sides of a season's people; each side is aggregated before it is joined, so counts don't multiply."""
    b = bronze(t)
    season = F.col("version_season") == "Y1995"
    challenges = silver_of(b, "challenge_performance").where(season).groupBy(*PERSON).agg(
        F.count(F.lit(1)).alias("challenges_participated"), F.sum("won_flag").alias("challenges_won")
    )
    actions = silver_of(b, "advantage_strategy").where(season).groupBy(*PERSON).agg(F.count(F.lit(1)).alias("advantage_actions"))
    edit = silver_of(b, "edit_features").where(season).groupBy(*PERSON).agg(F.round(F.avg("confessional_count"), 9).alias("avg_confessionals"))
    votes = b["vote_history"].where(season & F.col("vote_id").isNotNull()).groupBy(*PERSON).agg(
        F.round(T.rate(F.col("vote_id") == F.col("voted_out_id")), 9).alias("vote_accuracy")
    )
    base = b["castaways"].where(season).select(*PERSON, "full_name").join(b["castaway_details"].select("castaway_id", "gender", "bipoc"), "castaway_id", "left")
    rows = O.feature_matrix(base, [challenges, actions, edit, votes], PERSON, {"challenges_participated": 0, "challenges_won": 0, "advantage_actions": 0})
    return rows.select(
        "castaway_id", "full_name", "gender", "bipoc", "challenges_participated", "challenges_won", "advantage_actions",
        "avg_confessionals", "vote_accuracy"
    )


@query(sql_over("""SELECT e.castaway_id, e.version_season, e.episode, e.confessional_count, coalesce(sum(c.won) OVER w,
  0)::BIGINT AS challenges_won_cumulative, round(sum(v.good) OVER w / nullif(sum(v.n) OVER w, 0), 9) AS vote_accuracy_to_date
  FROM confessionals e LEFT JOIN (SELECT castaway_id, version_season, episode, count(CASE WHEN result LIKE '%win%' THEN 1 END) AS won
    FROM challenge_results GROUP BY ALL) c
    ON c.castaway_id = e.castaway_id AND c.version_season = e.version_season AND c.episode = e.episode
  LEFT JOIN (SELECT castaway_id, version_season, episode, count(*) AS n, count(CASE WHEN vote_id = voted_out_id THEN 1 END) AS good
    FROM vote_history WHERE vote_id IS NOT NULL GROUP BY ALL) v ON v.castaway_id = e.castaway_id AND v.version_season = e.version_season
    AND v.episode = e.episode
  WINDOW w AS (PARTITION BY e.castaway_id, e.version_season ORDER BY e.episode ROWS UNBOUNDED PRECEDING)""", "confessionals", "challenge_results",
    "vote_history"))
def episode_evolution(t):
    b = bronze(t, "confessionals", "challenge_results", "vote_history")
    keys = [*PERSON, "episode"]
    votes = b["vote_history"].where("vote_id IS NOT NULL").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col("vote_id") == F.col("voted_out_id")).alias("_good")
    )
    won = b["challenge_results"].groupBy(*keys).agg(F.count_if(F.col("result").contains("win")).alias("_won"))
    so_far = Window.partitionBy(*PERSON).orderBy("episode").rowsBetween(Window.unboundedPreceding, 0)
    rows = b["confessionals"].join(won, keys, "left").join(votes, keys, "left")
    accuracy = F.round(T.ratio(F.sum("_good").over(so_far), F.sum("_n").over(so_far)), 9)
    return rows.select(
        *keys, "confessional_count", F.coalesce(F.sum("_won").over(so_far), F.lit(0)).alias("challenges_won_cumulative"),
        accuracy.alias("vote_accuracy_to_date")
    )


@query(
    sql_over(
        """SELECT castaway_id, count(vote_id) AS total_votes_cast, count(CASE WHEN nullified THEN 1 END) AS nullified,
    count(CASE WHEN tie THEN 1 END) AS ties FROM vote_history GROUP BY castaway_id""",
        "vote_history"
    )
)
def voting_patterns(t):
    votes = bronze(t, "vote_history")["vote_history"].groupBy("castaway_id")
    return votes.agg(F.count("vote_id").alias("total_votes_cast"), F.count_if("nullified").alias("nullified"), F.count_if("tie").alias("ties"))


@query(
    sql_over(
        """SELECT castaway_id, d.challenge_type, count(*) AS wins FROM challenge_results r JOIN challenge_description d USING (challenge_id,
    version_season) WHERE r.result = 'Won (win)' GROUP BY ALL""",
        "challenge_results", "challenge_description"
    )
)
def challenge_wins_by_type(t):
    b = bronze(t, "challenge_results", "challenge_description")
    kinds = b["challenge_description"].select("challenge_id", "version_season", "challenge_type")
    return b["challenge_results"].where("result = 'Won (win)'").join(
        kinds, ["challenge_id", "version_season"]
    ).groupBy("castaway_id", "challenge_type").agg(F.count(F.lit(1)).alias("wins"))


@query(
    sql_over(
        "SELECT version_season, count(*) AS n_winners, round(avg(age), 9) AS average_age FROM castaways WHERE winner GROUP BY version_season",
        "castaways"
    )
)
def winner_ages(t):
    return bronze(t, "castaways")["castaways"].where("winner").groupBy("version_season").agg(
        F.count(F.lit(1)).alias("n_winners"), F.round(F.avg("age"), 9).alias("average_age")
    )


@query(
    sql_over(
        """SELECT castaway_id, version_season, target_winner, target_finalist, target_jury, challenges_won, individual_win_rate, advantages_found,
    idol_success_rate, vote_accuracy_rate, majority_alliance_rate, is_bipoc, is_lgbt, current_age FROM ml_features_non_edit
    WHERE target_placement IS NOT NULL"""
    )
)
def winner_training_rows(t):
    return _gold(t).where("target_placement IS NOT NULL").select(
        *PERSON, "target_winner", "target_finalist", "target_jury", "challenges_won", "individual_win_rate", "advantages_found",
        "idol_success_rate", "vote_accuracy_rate", "majority_alliance_rate", "is_bipoc", "is_lgbt", "current_age"
    )


@query(
    sql_over(
        """SELECT version_season, season_name, cast_size, round(male_ratio, 9) AS male_ratio, round(bipoc_ratio, 9) AS bipoc_ratio,
    season_era FROM season_context WHERE season_number >= 10"""
    )
)
def late_seasons(t):
    found = silver_of(bronze(t), "season_context").where("season_number >= 10")
    return found.select(
        "version_season", "season_name", "cast_size", F.round("male_ratio", 9).alias("male_ratio"),
        F.round("bipoc_ratio", 9).alias("bipoc_ratio"), "season_era"
    )


@query(sql_over("""SELECT c.version_season, c.castaway_id, c.age, c.state, d.gender, d.bipoc, d.lgbt, d.personality_type, o.nth > 1 AS returning_player
  FROM castaways c LEFT JOIN castaway_details d ON d.castaway_id = c.castaway_id
  JOIN (SELECT castaway_id, version_season, row_number() OVER (PARTITION BY castaway_id ORDER BY version_season) AS nth
    FROM castaways) o ON o.castaway_id = c.castaway_id AND o.version_season = c.version_season
  WHERE c.episode > 5""", "castaways", "castaway_details"))  # fmt: skip
def castaway_features(t):
    b = bronze(t, "castaways", "castaway_details")
    found = M.castaway_features(b["castaways"], b["castaway_details"], episode=(">", 5))
    return found.select("version_season", "castaway_id", "age", "state", "gender", "bipoc", "lgbt", "personality_type", "returning_player")


@query(sql_over("""SELECT c.castaway_id, c.age, c.state, d.gender, d.occupation, o.nth > 1 AS returning_player FROM castaways c
  LEFT JOIN castaway_details d ON d.castaway_id = c.castaway_id
  JOIN (SELECT castaway_id, version_season, row_number() OVER (PARTITION BY castaway_id ORDER BY version_season) AS nth
    FROM castaways) o ON o.castaway_id = c.castaway_id AND o.version_season = c.version_season
  WHERE c.version_season = 'Y1996' AND c.episode < 9""", "castaways", "castaway_details"))  # fmt: skip
def castaway_features_of_season(t):
    """People of one season who were last seen before an episode."""
    b = bronze(t, "castaways", "castaway_details")
    found = M.castaway_features(b["castaways"], b["castaway_details"], "Y1996", ("<", 9))
    return found.select("castaway_id", "age", "state", "gender", "occupation", "returning_player")
