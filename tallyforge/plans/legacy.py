"""Features of people, episodes and seasons over the star schema: measures, and the same as payloads nested to three levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import functions as T
from .. import operators as O
from .registry import query
from .star import star_sql, star_tables

PERSON = ["castaway_key", "season_key"]
#: Seasons with a twist, and the first of the new era (fixed values).
EDGE_SEASONS, REDEMPTION_SEASONS, NEW_ERA = (35, 36, 37, 38), (22, 23, 26), 41

_n = F.count_if


def challenge_parts(results: DataFrame, challenges: DataFrame) -> DataFrame:
    """Wins in all and by format, rewards and sit-outs of each person and season, and their wins by type of challenge, as a map.

    Results are counted by type once, and everything else is summed from these counts.
    """
    met = results.join(challenges.select("challenge_key", "challenge_type"), "challenge_key")
    kind = F.col("kind")
    by_type = met.groupBy(*PERSON, F.coalesce("challenge_type", F.lit("unknown")).alias("kind")).agg(
        _n(F.lower("result").like("r%")).alias("wins"), _n(F.col("chosen_for_reward")).alias("chosen_for_reward"), _n(F.col("sit_out")).alias("sitouts")
    )
    wins_if = lambda of: F.sum(F.when(of, F.col("wins")).otherwise(0))
    return by_type.groupBy(*PERSON).agg(
        F.sum("wins").alias("wins"), wins_if(kind.ilike("%#1%")).alias("individual_wins"), wins_if(kind.ilike("%#2%") | kind.ilike("%#3%")).alias("team_wins"),
        F.sum("chosen_for_reward").alias("chosen_for_reward"), F.sum("sitouts").alias("sitouts"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("kind", "wins")))).alias("wins_by_type"),  # a member for each type
    )


def vote_parts(votes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Votes cast, right and wrong before and after the merge, and the rate of right ones; and the votes that each person received."""
    right, before = F.col("target_castaway_id") == F.col("voted_out_castaway_id"), F.col("tribe_status") == "F"
    wrong = ~F.col("target_castaway_id").eqNullSafe(F.col("voted_out_castaway_id"))
    cast = votes.groupBy(*PERSON).agg(
        F.count(F.lit(1)).alias("votes_cast"), _n(right).alias("votes_correct"), _n(wrong).alias("votes_incorrect"),
        _n(before).alias("tribals_pre_merge"), _n(~before).alias("tribals_post_merge"),
        _n(before & right).alias("votes_correct_pre_merge"), _n(~before & right).alias("votes_correct_post_merge"), T.rate(right).alias("vote_alignment"),
    )
    received = votes.where(F.col("target_castaway_id").isNotNull()).groupBy(
        F.md5("target_castaway_id").alias("castaway_key"), "season_key"
    ).agg(F.count(F.lit(1)).alias("votes_received"))
    return cast, received


def season_parts(seasons: DataFrame, people: DataFrame) -> DataFrame:
    """Era, twists, weight, and the share of people who take part in several seasons."""
    again = people.groupBy("castaway_key").agg((F.count(F.lit(1)) > 1).alias("is_returning"))
    mix = people.join(again, "castaway_key").groupBy("season_key").agg(T.rate(F.col("is_returning")).alias("returnee_ratio"))
    number = F.col("season_number")
    return seasons.join(mix, "season_key", "left").select(
        "season_key", "version_season", "season_number", "tribe_setup", "cast_size", "finalist_count", "jury_count",
        T.season_weight(F.col("rank")).alias("season_weight"), (number >= NEW_ERA).alias("is_new_era"),
        number.isin(*EDGE_SEASONS).alias("twist_edge_of_extinction"), number.isin(*REDEMPTION_SEASONS).alias("twist_redemption_island"),
        F.coalesce("returnee_ratio", F.lit(0.0)).alias("returnee_ratio"),
    )


def person_features(s: dict[str, DataFrame]) -> DataFrame:
    """A row for each person and season with all measures, 0 where a part has none."""
    people = s["bridge_castaway_season"]
    totals = challenge_parts(s["fact_challenge_results"], s["dim_challenge"])
    cast, received = vote_parts(s["fact_vote_history"].withColumn("tribe_status", F.col("vote_event")))
    edit = s["fact_confessionals"].groupBy(*PERSON).agg(
        F.sum("confessional_count").alias("confessional_count"), F.sum("confessional_time").alias("confessional_time")
    )
    jury = s["fact_jury_votes"].groupBy(F.col("finalist_castaway_key").alias("castaway_key"), "season_key").agg(F.count(F.lit(1)).alias("jury_votes"))
    seasons = season_parts(s["dim_season"], people).select("season_key", "season_weight", "returnee_ratio", "is_new_era")
    base = people.select(*PERSON, "castaway_id", "version_season", "original_tribe").join(
        s["dim_castaway"].select("castaway_key", "full_name", "gender", "occupation"), "castaway_key"
    ).join(seasons, "season_key")
    counts = (
        "wins", "individual_wins", "team_wins", "chosen_for_reward", "sitouts", "votes_cast", "votes_correct", "votes_incorrect",
        "tribals_pre_merge", "tribals_post_merge", "votes_correct_pre_merge", "votes_correct_post_merge", "votes_received",
        "confessional_count", "jury_votes"
    )
    out = O.feature_matrix(
        base, [totals, cast, received, edit, jury], PERSON,
        dict.fromkeys(counts, 0) | {"vote_alignment": 0.0, "confessional_time": 0.0}
    )
    out = out.withColumn("wins_by_type", F.coalesce("wins_by_type", F.create_map().cast("map<string,bigint>")))
    return out.withColumn("strategic_score", T.strategic_score(F.col("votes_cast"), F.col("votes_received"), F.col("votes_incorrect")))


def group(*columns: str | Column) -> Column:
    return F.struct(*columns)


def person_payload(features: DataFrame) -> DataFrame:
    """Keys and the payload of each person and season."""
    payload = group(
        group("full_name", "gender", "occupation").alias("demographics"),
        group(F.col("wins").alias("total_wins"), "individual_wins", "team_wins", "chosen_for_reward", "sitouts", "wins_by_type").alias("challenge_stats"),
        group(
            "votes_cast", "votes_received", "votes_correct", "votes_incorrect",
            group(F.col("tribals_pre_merge").alias("pre_merge"), F.col("tribals_post_merge").alias("post_merge")).alias("tribals"),
            "vote_alignment", "strategic_score"
        ).alias("vote_stats"),
        group("confessional_count", "confessional_time").alias("tv_stats"),
        group("season_weight", "returnee_ratio", "is_new_era").alias("misc"), group("jury_votes").alias("jury"),
    )
    return features.select(*PERSON, "castaway_id", "version_season", F.to_json(payload).alias("payload"))


def episode_features(s: dict[str, DataFrame]) -> DataFrame:
    """A row for each person, season and episode that has a confessional, a result or a vote, with what there was in it and up to it."""
    keys = [*PERSON, "episode_key"]
    edit = s["fact_confessionals"].groupBy(*keys).agg(F.sum("confessional_count").alias("confessionals"))
    wins = s["fact_challenge_results"].groupBy(*keys).agg(_n(F.lower("result").like("r%")).alias("wins"), _n(F.col("sit_out")).alias("sitouts"))
    votes = s["fact_vote_history"].where(F.col("castaway_key").isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("votes_cast"), _n(F.col("target_castaway_id") == F.col("voted_out_castaway_id")).alias("votes_correct")
    )
    measures = ("confessionals", "wins", "sitouts", "votes_cast", "votes_correct")
    rows = [part.select(*keys, *(F.col(m) if m in part.columns else F.lit(0).cast("long").alias(m) for m in measures)) for part in (edit, wins, votes)]
    per = rows[0].unionByName(rows[1]).unionByName(rows[2]).where(F.col("episode_key").isNotNull()).groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))
    upto = Window.partitionBy(*PERSON).orderBy("episode_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per.withColumns({f"{m}_cumulative": F.sum(m).over(upto) for m in measures})


def episode_payload(features: DataFrame) -> DataFrame:
    both = lambda m: group(F.col(m).alias("count"), F.col(f"{m}_cumulative").alias("cumulative"))
    payload = group(
        both("confessionals").alias("confessionals"),
        group(both("wins").alias("wins"), both("sitouts").alias("sitouts")).alias("challenges"),
        group(both("votes_cast").alias("cast"), both("votes_correct").alias("correct")).alias("votes")
    )
    return features.select(*PERSON, "episode_key", F.to_json(payload).alias("payload"))


def latest_state(rows: DataFrame, by: str, at: str) -> DataFrame:
    """The rows of each ``by`` at its greatest ``at``: the greatest one is an aggregate joined back, so no group is sorted."""
    last = rows.groupBy(by).agg(F.max(at).alias("_last"))
    return rows.join(last, by).where(F.col(at) == F.col("_last")).drop("_last")


# Queries, with SQL written from the description of each measure.

_FACTS = ("bridge_castaway_season", "fact_challenge_results", "fact_vote_history", "fact_confessionals", "fact_jury_votes")
_STEPS = f"""WITH {star_sql(*_FACTS)},
  c AS (SELECT f.*, challenge_type, lower(result) LIKE 'r%' AS won FROM fact_challenge_results f JOIN dim_challenge d ON d.challenge_key = f.challenge_key),
  ct AS (SELECT castaway_key, season_key, count(*) FILTER (WHERE won) AS wins, count(*) FILTER (WHERE won
    AND challenge_type LIKE '%#1%') AS individual_wins, count(*) FILTER (WHERE won AND (challenge_type LIKE '%#2%'
    OR challenge_type LIKE '%#3%')) AS team_wins,
    count(*) FILTER (WHERE chosen_for_reward) AS chosen_for_reward, count(*) FILTER (WHERE sit_out) AS sitouts,
      count(DISTINCT challenge_type) AS n_types FROM c GROUP BY ALL),
  v AS (SELECT *, vote_event = 'F' AS pre, coalesce(target_castaway_id = voted_out_castaway_id, false) AS good FROM fact_vote_history),
  vt AS (SELECT castaway_key, season_key, count(*) AS votes_cast, count(*) FILTER (WHERE good) AS votes_correct,
    count(*) FILTER (WHERE target_castaway_id IS DISTINCT FROM voted_out_castaway_id) AS votes_incorrect,
    count(*) FILTER (WHERE pre) AS tribals_pre_merge, count(*) FILTER (WHERE NOT pre) AS tribals_post_merge,
    count(*) FILTER (WHERE pre AND good) AS votes_correct_pre_merge, count(*) FILTER (WHERE NOT pre AND good) AS votes_correct_post_merge,
      avg(good::INT) AS vote_alignment FROM v GROUP BY ALL),
  vr AS (SELECT md5(target_castaway_id) AS castaway_key, season_key, count(*) AS votes_received FROM v WHERE target_castaway_id IS NOT NULL GROUP BY ALL),
  tv AS (SELECT castaway_key, season_key, sum(confessional_count) AS confessional_count, sum(confessional_time) AS confessional_time
    FROM fact_confessionals GROUP BY ALL),
  ju AS (SELECT finalist_castaway_key AS castaway_key, season_key, count(*) AS jury_votes FROM fact_jury_votes GROUP BY ALL),
  mix AS (SELECT season_key, avg((n > 1)::INT) AS returnee_ratio FROM (SELECT season_key, count(*) OVER (PARTITION BY castaway_key) AS n
    FROM bridge_castaway_season) GROUP BY 1),
  people AS (SELECT b.castaway_key, b.season_key, b.castaway_id, b.version_season, b.original_tribe, d.full_name, d.gender, d.occupation,
    1 + s.rank / 100 AS season_weight, coalesce(m.returnee_ratio, 0) AS returnee_ratio, s.season_number >= 41 AS is_new_era, ct.*, vt.*, vr.*, tv.*, ju.*
    FROM bridge_castaway_season b JOIN dim_castaway d ON d.castaway_key = b.castaway_key JOIN dim_season s ON s.season_key = b.season_key
      LEFT JOIN mix m ON m.season_key = b.season_key
    {" ".join(f"LEFT JOIN {x} ON {x}.castaway_key = b.castaway_key AND {x}.season_key = b.season_key" for x in ("ct", "vt", "vr", "tv", "ju"))})"""
_COUNTS = (
    "wins", "individual_wins", "team_wins", "chosen_for_reward", "sitouts", "votes_cast", "votes_correct", "votes_incorrect",
    "tribals_pre_merge", "tribals_post_merge", "votes_correct_pre_merge", "votes_correct_post_merge", "votes_received",
    "confessional_count", "jury_votes"
)
_COUNTED = ", ".join(f"coalesce({m}, 0)::BIGINT AS {m}" for m in _COUNTS)
_SCORE = "round(CASE WHEN coalesce(votes_cast, 0) = 0 THEN 0 ELSE (votes_cast - coalesce(votes_received, 0) + votes_incorrect) / votes_cast END, 9) AS strategic_score"
_RATIOS = "round(season_weight, 9) AS season_weight, round(returnee_ratio, 9) AS returnee_ratio, round(coalesce(vote_alignment, 0), 9) AS vote_alignment"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in ("season_weight", "returnee_ratio", "vote_alignment", "strategic_score") if c in df.columns})


@query(
    f"{_STEPS} SELECT castaway_key, season_key, castaway_id, version_season, original_tribe, full_name, gender, occupation, is_new_era, {_COUNTED}, coalesce(confessional_time, 0) AS confessional_time, {_SCORE}, {_RATIOS} FROM people"
)
def person_season_features(t):
    return _rounded(person_features(star_tables(t, *_FACTS)).drop("wins_by_type"))


@query(
    f"""{_STEPS} SELECT castaway_key, season_key, castaway_id, version_season, full_name, coalesce(wins, 0)::BIGINT AS total_wins,
      coalesce(n_types, 0)::INT AS n_types, coalesce(wins, 0)::BIGINT AS wins_of_types, coalesce(tribals_pre_merge, 0)::BIGINT AS pre_merge,
      round(season_weight, 6) AS season_weight, coalesce(jury_votes, 0)::BIGINT AS jury_votes FROM people"""
)
def person_payload_paths(t):
    """The payload of each person and season, read back along its paths."""
    rows = person_payload(person_features(star_tables(t, *_FACTS)))
    kind = """demographics struct<full_name string>, challenge_stats struct<total_wins bigint, wins_by_type map<string, bigint>>,
      vote_stats struct<tribals struct<pre_merge bigint>>, misc struct<season_weight double>, jury struct<jury_votes bigint>"""
    rows = rows.select(*PERSON, "castaway_id", "version_season", F.from_json("payload", kind).alias("p"))  # a payload is read once for all paths
    types = F.col("p.challenge_stats.wins_by_type")
    return rows.select(
        *PERSON, "castaway_id", "version_season", F.col("p.demographics.full_name").alias("full_name"),
        F.col("p.challenge_stats.total_wins").alias("total_wins"), F.size(types).alias("n_types"),
        F.aggregate(F.map_values(types), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("wins_of_types"),
        F.col("p.vote_stats.tribals.pre_merge").alias("pre_merge"), F.round("p.misc.season_weight", 6).alias("season_weight"),
        F.col("p.jury.jury_votes").alias("jury_votes"),
    )


_MEASURES = ("confessionals", "wins", "sitouts", "votes_cast", "votes_correct")


@query(f"""{_STEPS}, e AS (SELECT castaway_key, season_key, episode_key, confessional_count AS confessionals, 0 AS wins, 0 AS sitouts,
  0 AS votes_cast, 0 AS votes_correct FROM fact_confessionals
    UNION ALL SELECT castaway_key, season_key, episode_key, 0, (lower(result) LIKE 'r%')::INT, sit_out::INT, 0,
      0 FROM fact_challenge_results UNION ALL SELECT castaway_key, season_key, episode_key, 0, 0, 0, 1, good::INT FROM v WHERE castaway_key IS NOT NULL),
  per AS (SELECT castaway_key, season_key, episode_key, {", ".join(f"sum({m}) AS {m}" for m in _MEASURES)} FROM e WHERE episode_key IS NOT NULL GROUP BY ALL)
  SELECT castaway_key, season_key, episode_key, {", ".join(f"{m}::BIGINT AS {m}, (sum({m}) OVER w)::BIGINT AS {m}_cumulative" for m in _MEASURES)} FROM per WINDOW w AS (PARTITION BY castaway_key, season_key ORDER BY episode_key)""")
def episode_payload_paths(t):
    """The payload of each person and episode, read back along its paths."""
    rows = episode_payload(episode_features(star_tables(t, *_FACTS)))
    paths = {
        "confessionals": "confessionals", "wins": "challenges.wins", "sitouts": "challenges.sitouts", "votes_cast": "votes.cast",
        "votes_correct": "votes.correct"
    }
    both = "struct<count bigint, cumulative bigint>"
    kind = f"confessionals {both}, challenges struct<wins {both}, sitouts {both}>, votes struct<cast {both}, correct {both}>"
    rows = rows.select(*PERSON, "episode_key", F.from_json("payload", kind).alias("p"))
    return rows.select(
        *PERSON, "episode_key",
        *(x for m, p in paths.items() for x in (F.col(f"p.{p}.count").alias(m), F.col(f"p.{p}.cumulative").alias(f"{m}_cumulative")))
    )


@query(f"""{_STEPS} SELECT s.season_key, version_season, season_number, tribe_setup, cast_size, finalist_count, jury_count, round(1 + rank / 100,
  9) AS season_weight, season_number >= 41 AS is_new_era, season_number IN (35, 36, 37, 38) AS twist_edge_of_extinction, season_number IN (22, 23,
  26) AS twist_redemption_island, round(coalesce(returnee_ratio, 0), 9) AS returnee_ratio
  FROM dim_season s LEFT JOIN mix m ON m.season_key = s.season_key""")
def season_features(t):
    s = star_tables(t, "bridge_castaway_season")
    return _rounded(season_parts(s["dim_season"], s["bridge_castaway_season"]))


@query(
    f"WITH {star_sql('fact_tribe_membership')} SELECT version_season, castaway_id, episode_in_season, tribe FROM fact_tribe_membership f WHERE episode_in_season = (SELECT max(episode_in_season) FROM fact_tribe_membership x WHERE x.version_season = f.version_season)"
)
def last_episode_state(t):
    """Who stood where in the last episode of each season."""
    return latest_state(
        star_tables(t, "fact_tribe_membership")["fact_tribe_membership"].select(
            "version_season", "castaway_id", "episode_in_season", "tribe"
        ),
        "version_season", "episode_in_season"
    )
