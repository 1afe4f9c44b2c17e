"""The ten models as queries: bronze tables that Spark derives from the given ones, and SQL that must give the same rows.

A year is a season, a month an episode; customers take part and vote, parts are challenges and advantages, order lines their results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import models as M
from .registry import query

SEASON, EPISODE, DAY = "concat('Y', CAST(year({0}) AS STRING))", "CAST(month({0}) AS INT)", "CAST(day({0}) AS INT)"
ORDER, SHIP = [e.format("o_orderdate") for e in (SEASON, EPISODE, DAY)], [e.format("l_shipdate") for e in (SEASON, EPISODE, DAY)]
CUSTOMER = "CAST(o_custkey AS STRING)"
#: Tables: source, columns, and further columns that are aggregates by the first ones.
BRONZE = {
    "castaways": ("orders", {"castaway_id": CUSTOMER, "version_season": ORDER[0], "season": "CAST(year(o_orderdate) - 1985 AS INT)"}, {
        "full_name": "min(concat('Customer ', CAST(o_custkey AS STRING)))", "castaway": f"min({CUSTOMER})",
        "age": "CAST(min(18 + o_custkey % 50) AS INT)", "city": "min(o_orderpriority)", "state": "max(o_orderpriority)",
        "episode": f"max({ORDER[1]})", "result": "max(CASE WHEN o_orderstatus = 'F' THEN 'out' WHEN o_orderstatus = 'O' THEN 'stayed' END)",
        "place": "concat(CAST(count(*) AS STRING), '.4')",
        "jury": "max(o_orderkey % 5 = 0)", "finalist": "max(o_orderkey % 11 = 0)", "winner": "max(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 17 = 0 END)", "original_tribe": "min(CASE WHEN o_orderkey % 4 > 0 THEN o_orderpriority END)"}),
    "castaway_details": ("customer", {
        "castaway_id": "CAST(c_custkey AS STRING)", "gender": "CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END",
        "personality_type": "c_mktsegment", "occupation": "concat('nation ', CAST(c_nationkey AS STRING))",
        "african": "c_custkey % 7 = 0", "asian": "c_custkey % 5 = 0", "latin_american": "c_custkey % 6 = 0",
        "native_american": "c_custkey % 13 = 0", "bipoc": "CASE WHEN c_custkey % 8 > 0 THEN c_custkey % 2 = 0 END",
        "lgbt": "CASE WHEN c_custkey % 9 > 0 THEN c_custkey % 4 = 0 END",
        "race": "c_mktsegment", "ethnicity": "CAST(NULL AS STRING)"}, None),
    "season_summary": ("orders", {"version_season": ORDER[0], "season": "CAST(year(o_orderdate) - 1985 AS INT)"}, {
        "version": "max('Y')", "season_name": "min(o_orderstatus)", "full_name": "max(o_orderstatus)", "location": "min(o_orderpriority)",
        "country": "max(o_orderpriority)",
        "tribe_setup": "max(CASE CAST(year(o_orderdate) AS INT) % 3 WHEN 0 THEN 'Edge swap' WHEN 1 THEN 'Redemption' ELSE 'merged' END)",
        "n_cast": "CAST(count(DISTINCT o_custkey) AS INT)", "n_tribes": "CAST(count(DISTINCT o_orderpriority) AS INT)",
        "n_finalists": "CAST(3 AS INT)", "n_jury": "CAST(count(*) AS INT)", "premiered": "CAST(min(o_orderdate) AS DATE)",
        "ended": "CAST(max(o_orderdate) AS DATE)",
        "filming_started": "CAST(min(o_orderdate) AS DATE)", "filming_ended": "CAST(max(o_orderdate) AS DATE)",
        "winner_id": "CAST(min(o_custkey) AS STRING)", "winner": "CAST(max(o_custkey) AS STRING)", "runner_ups": "max(o_orderstatus)",
        "final_vote": "min(o_orderpriority)", "timeslot": "max('evening')",
        "viewers_reunion": "max(o_totalprice)", "viewers_premiere": "min(o_totalprice)", "viewers_finale": "max(o_totalprice)", "viewers_mean": "min(o_totalprice)", "rank": "CAST(count(*) % 9 AS INT)"}),
    "vote_history": ("orders", {
        "castaway_id": CUSTOMER, "version_season": ORDER[0], "episode": ORDER[1], "day": ORDER[2], "tribe": "o_orderpriority",
        "tribe_status": "CASE WHEN o_orderkey % 40 = 0 OR month(o_orderdate) > 6 THEN 'Merged' ELSE 'Original' END",
        "vote_id": "CASE WHEN o_orderkey % 10 > 0 THEN CAST(o_orderkey % 7 AS STRING) END",
        "voted_out_id": "CASE WHEN o_orderkey % 6 > 0 THEN CAST(month(o_orderdate) % 7 AS STRING) END",
        "immunity": "CASE o_orderkey % 9 WHEN 0 THEN 'Individual' WHEN 1 THEN '' END",
        "vote_event": "o_orderstatus", "vote_event_outcome": "o_orderpriority", "split_vote": "CASE WHEN o_orderkey % 12 = 0 THEN 'split' END", "nullified": "CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey % 3 = 0 END", "tie": "o_orderkey % 21 = 0", "vote_order": "CAST(o_orderkey % 3 AS INT)"}, None),
    "tribe_mapping": ("orders", {
        "castaway_id": CUSTOMER, "version_season": ORDER[0], "episode": ORDER[1], "day": ORDER[2], "tribe": "o_orderpriority", "tribe_status": "CASE WHEN month(o_orderdate) > 6 THEN 'Merged' WHEN o_orderkey % 50 > 0 THEN 'Original' ELSE 'Mergatory' END"}, None),
    "jury_votes": (
        "orders",
        {"castaway_id": CUSTOMER, "version_season": ORDER[0], "finalist_id": "CAST(o_orderkey % 40 AS STRING)", "vote": "o_orderpriority"},
        None
    ),
    "advantage_details": ("part", {
        "advantage_id": "CAST(p_partkey AS STRING)", "version_season": "concat('Y', CAST(1992 + p_partkey % 7 AS STRING))",
        "advantage_type": "CASE p_partkey % 5 WHEN 0 THEN 'Hidden Immunity Idol' WHEN 1 THEN 'Individual Immunity' WHEN 2 THEN 'Extra Vote' WHEN 3 THEN 'Advantage' ELSE p_brand END",
        "clue_details": "p_type", "location_found": "p_brand", "conditions": "p_name"}, None),
    "advantage_movement": ("lineitem", {
        "castaway_id": "CAST(l_suppkey AS STRING)", "version_season": SHIP[0], "episode": SHIP[1], "day": SHIP[2],
        "advantage_id": "CAST(l_partkey AS STRING)", "sequence_id": "l_linenumber",
        "event": "CASE l_orderkey % 6 WHEN 0 THEN 'Found' WHEN 1 THEN 'Played' WHEN 2 THEN 'Received' WHEN 3 THEN 'Gifted' WHEN 4 THEN 'Played (beware)' END",
        "played_for_id": "CASE WHEN l_orderkey % 4 > 0 THEN CAST(l_suppkey + l_linenumber % 2 AS STRING) END", "co_castaway_ids": "l_linestatus", "joint_play": "l_linenumber = 2", "multi_target_play": "l_linenumber = 3", "success": "CASE l_returnflag WHEN 'R' THEN 'Yes' WHEN 'A' THEN 'Not Needed' END", "votes_nullified": "CAST(l_quantity AS INT)"}, None),
    "challenge_description": ("part", {
        "challenge_id": "p_partkey", "version_season": "concat('Y', CAST(1992 + p_partkey % 7 AS STRING))",
        "challenge_type": "CASE p_partkey % 4 WHEN 0 THEN 'Individual Immunity' WHEN 1 THEN 'Tribal' WHEN 2 THEN 'Team / Tribe Reward' END",
        "name": "p_name", "recurring_name": "p_type",
        **{s: f"CASE WHEN p_partkey % 19 > 0 THEN p_partkey % {i + 2} = 0 END" for i, s in enumerate(M.SKILLS)}}, None),
    "challenge_results": ("lineitem", {
        "castaway_id": "CAST(l_suppkey AS STRING)", "version_season": SHIP[0], "episode": SHIP[1], "challenge_id": "l_partkey",
        "result": "CASE l_returnflag WHEN 'R' THEN 'Won (win)' WHEN 'A' THEN 'Lost' END", "chosen_for_reward": "l_linenumber = 1",
        "sit_out": "CASE WHEN l_linenumber > 1 THEN l_linenumber = 4 END",
        "order_of_finish": "l_linenumber", "team": "l_linestatus", "tribe_status": "CASE WHEN month(l_shipdate) > 6 THEN 'Merged' ELSE 'Original' END"}, None),
    "confessionals": ("events", {"castaway_id": "CAST(user_id AS STRING)", "version_season": "concat('Y', CAST(1992 + user_id % 7 AS STRING))", "episode": "CAST(day(ts) % 13 AS INT)"}, {
        "confessional_count": "CAST(count(*) AS INT)", "confessional_time": "CAST(sum(length(event_type)) * 7 AS DOUBLE)", "exp_count": "CAST(count(DISTINCT event_type) AS DOUBLE)", "exp_time": "CAST(min(length(event_type)) * 15 AS DOUBLE)"}),
}


def bronze(t, *names: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        source, keys, more = BRONZE[name]
        df = getattr(t, source)
        return M.per(df, keys, more) if more else M.pick(df, keys)

    return {n: table(n) for n in names or BRONZE}


def listed(columns: dict[str, str] | list[str]) -> str:
    return ", ".join(f"{e} AS {n}" for n, e in (columns.items() if isinstance(columns, dict) else ((c, c) for c in columns)))


def _bronze_sql(name: str) -> str:
    source, keys, more = BRONZE[name]
    return f"SELECT {listed(keys | (more or {}))} FROM {source}" + (f" GROUP BY {', '.join(keys.values())}" if more else "")


def _md5(*names: str) -> str:
    return "md5(" + " || '|' || ".join(f"coalesce({n}::VARCHAR, '')" for n in names) + ")"


ON_PERSON, ON_TRIBE = "(castaway_id, version_season)", "(version_season, episode, tribe)"
TRIBES = "SELECT castaway_id, version_season, arg_min(original_tribe, episode) AS original_tribe FROM castaways WHERE original_tribe IS NOT NULL GROUP BY ALL"
SILVER_SQL = {
    "vote_dynamics": f"""WITH votes AS (SELECT *, CASE WHEN lower(tribe_status) LIKE '%merge%' THEN 'post_merge'
      ELSE 'pre_merge' END AS merge_phase FROM vote_history WHERE vote_id IS NOT NULL),
      met AS (SELECT a.castaway_id, a.version_season, a.episode, a.merge_phase AS p, count(*) AS others,
        count(CASE WHEN a.vote_id = b.vote_id THEN 1 END) AS same
        FROM votes a, votes b WHERE a.version_season = b.version_season AND a.episode = b.episode AND a.castaway_id <> b.castaway_id GROUP BY ALL)
      SELECT {_md5("castaway_id", "version_season", "episode")} AS vote_dynamics_key, castaway_id, version_season, episode, day, tribe, tribe_status, merge_phase, vote_id AS target_id, voted_out_id, immunity,
        vote_event, vote_event_outcome, split_vote, nullified, tie, vote_order,
        CASE WHEN voted_out_id = vote_id THEN 1 ELSE 0 END AS vote_correct, CASE WHEN voted_out_id IS DISTINCT FROM vote_id THEN 1
          ELSE 0 END AS vote_incorrect, CASE WHEN nullified IS TRUE THEN 1 ELSE 0 END AS vote_nullified,
        others AS total_voters, same AS aligned_votes, same / others AS alignment_ratio, CASE WHEN 2 * same >= others THEN 1
          ELSE 0 END AS in_majority_alliance, CASE WHEN 10 * same < 3 * others THEN 1 ELSE 0 END AS voting_alone,
        CASE WHEN split_vote = 'split' THEN 1 ELSE 0 END AS split_vote_scenario, CASE WHEN tie IS TRUE THEN 1 ELSE 0 END AS tie_vote_scenario,
          CASE WHEN immunity <> '' THEN 1 ELSE 0 END AS has_immunity
      FROM votes LEFT JOIN met USING (castaway_id, version_season, episode)""",
    "advantage_strategy": f"""WITH moves AS (SELECT m.*, d.advantage_type, d.clue_details, d.location_found, d.conditions, lower(m.event) AS did,
      lower(m.success) AS ended, lower(d.advantage_type) AS what, lower(m.event) LIKE '%played%' AS played
        FROM advantage_movement m JOIN advantage_details d ON d.advantage_id = m.advantage_id AND d.version_season = m.version_season)
      SELECT {_md5("castaway_id", "version_season", "advantage_id", "sequence_id")} AS advantage_strategy_key, castaway_id, version_season, episode, day, advantage_id, sequence_id, did AS event_type, played_for_id AS target_castaway_id,
        co_castaway_ids, joint_play, multi_target_play, ended AS success_outcome, votes_nullified, advantage_type, clue_details, location_found, conditions,
        CASE WHEN contains(did, 'found') THEN 'found' WHEN contains(did, 'played') THEN 'played' WHEN contains(did,
          'received') THEN 'received' WHEN contains(did, 'gifted') OR contains(did, 'shared') THEN 'shared' ELSE 'other' END AS event_category,
        CASE WHEN contains(what, 'idol') THEN 'idol' WHEN contains(what, 'immunity') THEN 'immunity' WHEN contains(what,
          'vote') THEN 'vote_modifier' WHEN contains(what, 'advantage') THEN 'advantage' ELSE 'other' END AS advantage_category,
        CASE WHEN played AND ended = 'yes' THEN 1 ELSE 0 END AS played_successfully, CASE WHEN played AND (ended = 'no'
          OR ended = 'not needed') THEN 1 ELSE 0 END AS played_unsuccessfully,
        CASE WHEN played AND coalesce(played_for_id = castaway_id, played_for_id IS NULL) THEN 1 ELSE 0 END AS played_for_self,
          CASE WHEN played AND played_for_id <> castaway_id THEN 1 ELSE 0 END AS played_for_others FROM moves""",
    "challenge_performance": f"""WITH runs AS (SELECT r.*, d.* EXCLUDE (challenge_id, version_season),
      CASE WHEN lower(r.result) LIKE '%win%' THEN 1 ELSE 0 END AS won
        FROM challenge_results r JOIN challenge_description d ON d.challenge_id = r.challenge_id AND d.version_season = r.version_season)
      SELECT {_md5("castaway_id", "version_season", "challenge_id")} AS challenge_performance_key, castaway_id, version_season, episode, challenge_id, challenge_type, name AS challenge_name, recurring_name, lower(result) AS result, won AS won_flag,
        chosen_for_reward, sit_out, order_of_finish, team, tribe_status, CASE WHEN lower(tribe_status) LIKE '%merge%' THEN 'post_merge'
          ELSE 'pre_merge' END AS merge_phase,
        CASE WHEN lower(challenge_type) LIKE '%individual%' THEN 'individual' WHEN regexp_matches(lower(challenge_type),
          'tribe|team') THEN 'team' ELSE 'other' END AS challenge_format,
        {", ".join(f"coalesce({x}, false)::INT * won AS {x}_win, coalesce({x}, false)::INT AS {x}_participated" for x in ("balance", "endurance", "knowledge", "memory", "precision", "puzzle", "race", "strength", "water"))} FROM runs""",
    "edit_features": f"""SELECT {_md5("castaway_id", "version_season", "episode")} AS edit_features_key, castaway_id, version_season, episode, confessional_count, confessional_time, exp_count AS expected_confessional_count, exp_time AS expected_confessional_time,
        CASE WHEN exp_count > 0 THEN confessional_count / exp_count END AS confessional_count_ratio,
          CASE WHEN exp_time > 0 THEN confessional_time / exp_time END AS confessional_time_ratio,
        CASE WHEN confessional_count > 0 THEN 1 ELSE 0 END AS has_confessional, CASE WHEN confessional_count >= 3 THEN 1
          ELSE 0 END AS high_confessional_count, CASE WHEN confessional_time >= 60 THEN 1 ELSE 0 END AS high_confessional_time,
        CASE WHEN exp_count > 0 AND confessional_count > exp_count THEN 1 ELSE 0 END AS over_edited_count,
          CASE WHEN exp_time > 0 AND confessional_time > exp_time THEN 1 ELSE 0 END AS over_edited_time,
        CASE WHEN exp_count > 0 AND confessional_count < exp_count THEN 1 ELSE 0 END AS under_edited_count,
          CASE WHEN exp_time > 0 AND confessional_time < exp_time THEN 1 ELSE 0 END AS under_edited_time FROM confessionals""",
    "jury_analysis": f"""WITH tribes AS ({TRIBES}) SELECT {_md5("j.castaway_id", "j.version_season", "j.finalist_id")} AS jury_analysis_key, j.castaway_id, j.version_season, j.finalist_id, j.vote AS voted_for_finalist_name, s.winner_id AS actual_winner_id,
        coalesce((j.finalist_id = s.winner_id)::INT, 0) AS voted_for_winner, coalesce((j.finalist_id <> s.winner_id)::INT,
          0) AS voted_against_winner, x.original_tribe AS juror_original_tribe, y.original_tribe AS finalist_original_tribe,
        coalesce((x.original_tribe = y.original_tribe)::INT, 0) AS same_original_tribe, coalesce((x.original_tribe <> y.original_tribe)::INT,
          0) AS different_original_tribe
      FROM jury_votes j JOIN season_summary s ON s.version_season = j.version_season LEFT JOIN tribes x ON x.castaway_id = j.castaway_id
        AND x.version_season = j.version_season
      LEFT JOIN tribes y ON y.castaway_id = j.finalist_id AND y.version_season = j.version_season""",
    "castaway_profile": """SELECT DISTINCT c.castaway_id, c.full_name, c.season, c.castaway, c.age, c.city, c.state, d.personality_type,
      d.occupation, d.gender, d.african, d.asian, d.latin_american, d.native_american, d.bipoc, d.lgbt, d.race, d.ethnicity,
        s.location AS season_location, s.country AS season_country, s.tribe_setup, s.full_name AS season_name, s.viewers_premiere,
          s.viewers_finale, s.viewers_reunion, s.viewers_mean AS season_avg_viewers
      FROM castaways c LEFT JOIN castaway_details d ON d.castaway_id = c.castaway_id LEFT JOIN season_summary s ON s.season = c.season""",
    "season_context": """WITH rows_of AS (SELECT castaway_id, count(*) AS n FROM castaway_details GROUP BY 1),
      people AS (SELECT c.version_season, c.age, lower(d.gender) AS g, d.bipoc AS b, d.lgbt AS l, r.n > 1 AS again FROM castaways c
        JOIN castaway_details d ON d.castaway_id = c.castaway_id JOIN rows_of r ON r.castaway_id = c.castaway_id),
      mix AS (SELECT version_season, count(*) AS total_cast, count(*) FILTER (WHERE g = 'male') AS male_count,
        count(*) FILTER (WHERE g = 'female') AS female_count, count(*) FILTER (WHERE b) AS bipoc_count, count(*) FILTER (WHERE l) AS lgbt_count,
        count(*) FILTER (WHERE again) AS returnee_count,
        avg(age) AS average_age, min(age) AS min_age, max(age) AS max_age, stddev_samp(age) AS age_stddev FROM people GROUP BY 1),
      rates AS (SELECT *, male_count / total_cast AS male_ratio, female_count / total_cast AS female_ratio,
        bipoc_count / total_cast AS bipoc_ratio, lgbt_count / total_cast AS lgbt_ratio, returnee_count / total_cast AS returnee_ratio FROM mix),
      bounds AS (SELECT min(season) AS low, max(season) AS high FROM season_summary)
      SELECT md5(coalesce(s.version_season, '')) AS season_context_key, s.version, s.version_season, s.season_name, s.season AS season_number,
        s.location, s.country, s.tribe_setup, s.n_cast AS cast_size, s.n_tribes AS tribe_count, s.n_finalists AS finalist_count, s.n_jury AS jury_count,
        s.premiered, s.ended, s.filming_started, s.filming_ended, s.winner_id AS winner_castaway_id, s.winner, s.runner_ups, s.final_vote,
          s.timeslot, s.viewers_reunion, s.viewers_premiere, s.viewers_finale, s.viewers_mean, s.rank,
        CASE WHEN s.season BETWEEN 31 AND 40 THEN 'new_school' WHEN s.season BETWEEN 21 AND 30 THEN 'modern' WHEN s.season BETWEEN 11
          AND 20 THEN 'middle' WHEN s.season < 11 THEN 'early' ELSE 'new_era' END AS season_era,
        coalesce(s.n_cast < 19, false) AS is_new_era_format, CASE WHEN high > low THEN 1 - (high - s.season) / (high - low) ELSE 1 END AS season_recency_weight,
        coalesce(regexp_matches(lower(s.tribe_setup), 'edge|extinction'), false) AS has_edge_of_extinction,
          coalesce(contains(lower(s.tribe_setup), 'redemption'), false) AS has_redemption_island, coalesce(contains(lower(s.tribe_setup), 'swap'),
          false) AS has_tribe_swap, coalesce(contains(lower(s.tribe_setup), 'merge'), false) AS has_merge_twist,
        r.* EXCLUDE (version_season), coalesce(bipoc_ratio >= 0.4, false) AS high_diversity_cast, coalesce(returnee_ratio > 0
          AND returnee_ratio < 1, false) AS mixed_returnee_cast, coalesce(returnee_count = total_cast, false) AS all_returnee_cast,
          coalesce(returnee_count = 0, false) AS all_newbie_cast
      FROM season_summary s CROSS JOIN bounds LEFT JOIN rates r ON r.version_season = s.version_season""",
    "social_positioning": f"""WITH tribes AS ({TRIBES}), stays AS (SELECT *, coalesce(contains(lower(tribe_status), 'merge'),
      false) AS merged FROM tribe_mapping),
      members AS (SELECT y.*, d.gender, lower(d.gender) = 'male' AS m, lower(d.gender) = 'female' AS f, d.african, d.asian, d.latin_american,
        d.native_american, d.bipoc, d.lgbt, d.race, d.ethnicity FROM stays y JOIN castaway_details d ON d.castaway_id = y.castaway_id),
      mix AS (SELECT version_season, episode, tribe, merged AS of_merged, count(*) AS tribe_size, {", ".join(f"count(*) FILTER (WHERE {e}) AS {n}_count, count(*) FILTER (WHERE {e}) / count(*) AS {n}_ratio" for n, e in
        (("male", "m"), ("female", "f"), *((x, x) for x in ("african", "asian", "latin_american", "native_american", "bipoc", "lgbt"))))} FROM members GROUP BY 1, 2, 3, 4),
      origin AS (SELECT y.version_season, y.episode, y.tribe, t.original_tribe, count(*) AS n FROM stays y
        JOIN tribes t ON t.castaway_id = y.castaway_id AND t.version_season = y.version_season WHERE merged GROUP BY ALL),
      present AS (SELECT *, count(*) OVER (PARTITION BY version_season, episode, tribe) AS kinds FROM origin)
      SELECT {_md5("p.castaway_id", "p.version_season", "p.episode", "p.tribe")} AS social_positioning_key, p.castaway_id, p.version_season, p.episode, p.day, p.tribe, p.tribe_status, CASE WHEN merged THEN 'post_merge' ELSE 'pre_merge' END AS merge_phase,
        gender, african, asian, latin_american, native_american, bipoc, lgbt, race, ethnicity, x.* EXCLUDE (version_season, episode, tribe,
          of_merged), CASE WHEN m THEN male_ratio ELSE female_ratio END AS same_gender_ratio,
        CASE WHEN lgbt THEN lgbt_ratio ELSE 1 - lgbt_ratio END AS lgbt_similarity_ratio, CASE WHEN bipoc THEN bipoc_ratio
          ELSE 1 - bipoc_ratio END AS bipoc_similarity_ratio, t.original_tribe, o.n AS original_tribe_members, o.kinds AS total_tribe_members,
        CASE WHEN merged THEN o.n / o.kinds END AS original_tribe_proportion, CASE WHEN merged
          AND o.n IS NOT NULL THEN CASE WHEN 2 * o.n < o.kinds THEN 'minority' ELSE 'majority' END END AS original_tribe_status,
        CASE WHEN (m AND 2 * male_count < tribe_size) OR (f AND 2 * female_count < tribe_size) THEN 'gender_minority'
          ELSE 'gender_majority' END AS gender_status,
        CASE WHEN (bipoc AND 2 * bipoc_count < tribe_size) OR (NOT bipoc AND 2 * bipoc_count > tribe_size) THEN 'racial_minority'
          ELSE 'racial_majority' END AS racial_status,
        CASE WHEN (lgbt AND 2 * lgbt_count < tribe_size) OR (NOT lgbt AND 2 * lgbt_count > tribe_size) THEN 'lgbt_minority'
          ELSE 'lgbt_majority' END AS lgbt_status
      FROM members p JOIN mix x ON x.version_season = p.version_season AND x.episode = p.episode AND x.tribe = p.tribe
        LEFT JOIN tribes t ON t.castaway_id = p.castaway_id AND t.version_season = p.version_season
      LEFT JOIN present o ON o.version_season = p.version_season AND o.episode = p.episode AND o.tribe = p.tribe AND o.original_tribe = t.original_tribe""",
}


def _each(names: str, pattern: str) -> str:
    return ", ".join(pattern.replace("@", n) for n in names.split())


def _parts(*steps: tuple[str, str, str, str]) -> str:
    return ", ".join(f"{name} AS (SELECT {keys}, {measures} FROM {table} GROUP BY 1, 2)" for name, keys, measures, table in steps)


_OWN, _PRE, _POST = "castaway_id, version_season", "merge_phase = 'pre_merge'", "merge_phase = 'post_merge'"
_MEASURES = [m for _, _, part in M.PARTS for m in part]
_ZERO = ", ".join(f"coalesce({m}, 0) AS {m}" for m in _MEASURES)
NON_EDIT_SQL = f"""WITH {_parts(
    ("ch", _OWN, f"""count(*) AS total_challenges, sum(won_flag)::BIGINT AS challenges_won, count(*) FILTER (WHERE won_flag = 1 AND challenge_format = 'individual') AS individual_wins, count(*) FILTER (WHERE won_flag = 1 AND challenge_format = 'team') AS team_wins,
      count(*) FILTER (WHERE won_flag = 1 AND {_PRE}) AS pre_merge_wins, count(*) FILTER (WHERE won_flag = 1 AND {_POST}) AS post_merge_wins,
        sum(chosen_for_reward::INT)::BIGINT AS reward_selections, sum(sit_out::INT)::BIGINT AS challenge_sitouts,
      avg(won_flag) FILTER (WHERE challenge_format = 'individual') AS individual_win_rate,
        avg(won_flag) FILTER (WHERE challenge_format = 'team') AS team_win_rate,
      {_each("balance endurance knowledge memory precision puzzle race strength water", "sum(@_win)::BIGINT AS @_wins")}, {_each("balance endurance puzzle strength", "avg(@_participated) AS @_participation_rate")}""", "challenge_performance"),
    ("ad", _OWN, f"""count(*) FILTER (WHERE event_category = 'found') AS advantages_found, count(*) FILTER (WHERE event_category = 'played') AS advantages_played, count(*) FILTER (WHERE advantage_category = 'idol' AND event_category = 'found') AS idols_found,
      count(*) FILTER (WHERE advantage_category = 'idol' AND event_category = 'played') AS idols_played, {_each("played_successfully played_unsuccessfully played_for_self played_for_others", "sum(@)::BIGINT AS advantages_@")},
      sum(played_successfully) / nullif(count(*) FILTER (WHERE event_category = 'played'), 0) AS advantage_success_rate, sum(CASE WHEN advantage_category = 'idol' THEN played_successfully ELSE 0 END) / nullif(count(*) FILTER (WHERE advantage_category = 'idol' AND event_category = 'played'), 0) AS idol_success_rate""", "advantage_strategy"),
    ("vo", _OWN, f"""count(*) AS total_votes_cast, sum(vote_correct)::BIGINT AS votes_correct, sum(vote_incorrect)::BIGINT AS votes_incorrect, count(*) FILTER (WHERE {_PRE}) AS pre_merge_tribals_attended, count(*) FILTER (WHERE {_POST}) AS post_merge_tribals_attended,
      count(*) FILTER (WHERE {_PRE} AND vote_correct = 1) AS pre_merge_correct_votes, count(*) FILTER (WHERE {_POST}
        AND vote_correct = 1) AS post_merge_correct_votes, sum(in_majority_alliance)::BIGINT AS majority_alliance_votes,
        sum(voting_alone)::BIGINT AS lone_wolf_votes,
      avg(alignment_ratio) AS avg_vote_alignment, avg(vote_correct) AS vote_accuracy_rate, avg(vote_correct) FILTER (WHERE {_PRE}) AS pre_merge_accuracy_rate, avg(vote_correct) FILTER (WHERE {_POST}) AS post_merge_accuracy_rate, avg(in_majority_alliance) AS majority_alliance_rate, avg(voting_alone) AS lone_wolf_rate""", "vote_dynamics"),
    (
        "re", "target_id AS castaway_id, version_season",
        f"count(*) AS total_votes_received, count(*) FILTER (WHERE {_PRE}) AS pre_merge_votes_received, count(*) FILTER (WHERE {_POST}) AS post_merge_votes_received",
        "vote_dynamics"
    ),
    ("so", _OWN, f"""{_each("same_gender_ratio lgbt_similarity_ratio bipoc_similarity_ratio", "avg(@) AS avg_@")}, avg(original_tribe_proportion) FILTER (WHERE {_POST}) AS avg_original_tribe_strength,
      {_each("gender racial lgbt", "count(*) FILTER (WHERE @_status = '@_minority') / count(*) AS @_minority_rate")}, count(*) FILTER (WHERE original_tribe_status = 'minority') / nullif(count(*) FILTER (WHERE {_POST}), 0) AS original_tribe_minority_rate""", "social_positioning"),
    (
        "ju", "finalist_id AS castaway_id, version_season",
        "count(*) AS jury_votes_received, sum(same_original_tribe)::BIGINT AS jury_votes_from_original_tribe, avg(same_original_tribe) AS original_tribe_jury_support_rate",
        "jury_analysis"
    ),
  )}, ends AS (SELECT * FROM castaways WHERE result IS NOT NULL QUALIFY row_number() OVER (PARTITION BY castaway_id, version_season ORDER BY episode DESC NULLS FIRST) = 1)
  SELECT {_md5("e.castaway_id", "e.version_season")} AS ml_features_key, e.castaway_id, e.version_season, coalesce(e.winner, false)::INT AS target_winner, coalesce(e.finalist, false)::INT AS target_finalist, coalesce(e.jury, false)::INT AS target_jury, round(try_cast(e.place AS DOUBLE))::INT AS target_placement,
    p.gender, p.race, p.ethnicity, p.occupation, p.personality_type, p.age AS current_age, {_each("african asian latin_american native_american bipoc lgbt", "p.@::INT AS is_@")},
    s.season_number, s.season_era, s.is_new_era_format::INT AS is_new_era_format, s.season_recency_weight, s.cast_size, s.finalist_count, s.jury_count, {_each("male female bipoc returnee", "s.@_ratio AS season_@_ratio")}, s.average_age AS season_average_age,
    {_each("has_edge_of_extinction has_redemption_island has_tribe_swap all_newbie_cast all_returnee_cast mixed_returnee_cast", "s.@::INT AS @")}, {_ZERO}
  FROM ends e LEFT JOIN castaway_profile p ON p.castaway_id = e.castaway_id LEFT JOIN season_context s ON s.version_season = e.version_season
  {" ".join(f"LEFT JOIN {x} ON {x}.castaway_id = e.castaway_id AND {x}.version_season = e.version_season" for x in ("ch", "ad", "vo", "re", "so", "ju"))}"""
_EDIT_ZERO = ", ".join(f"coalesce({m}, 0) AS {m}" for m in M.EDIT_STATS)
HYBRID_SQL = f"""WITH shown AS (SELECT castaway_id AS who, version_season AS season, sum(confessional_count)::BIGINT AS total_confessional_count,
  sum(confessional_time) AS total_confessional_time, sum(expected_confessional_count) AS total_expected_confessional_count,
  sum(expected_confessional_time) AS total_expected_confessional_time,
    sum(has_confessional)::BIGINT AS episodes_with_confessionals, sum(high_confessional_count)::BIGINT AS high_confessional_episodes,
      sum(high_confessional_time)::BIGINT AS high_confessional_time_episodes,
    {_each("over_edited_count over_edited_time under_edited_count under_edited_time", "sum(@)::BIGINT AS @_episodes")}, count(*) AS total_episodes_appeared, sum(confessional_count) / nullif(sum(expected_confessional_count), 0) AS overall_confessional_count_ratio,
    sum(confessional_time) / nullif(sum(expected_confessional_time), 0) AS overall_confessional_time_ratio,
      avg(has_confessional) AS confessional_presence_rate, avg(over_edited_count) AS over_edited_rate, avg(under_edited_count) AS under_edited_rate,
    avg(confessional_count) AS avg_confessional_count_per_episode, avg(confessional_time) AS avg_confessional_time_per_episode FROM edit_features GROUP BY 1, 2)
  SELECT n.*, {_EDIT_ZERO}, coalesce(total_confessional_count > 0, false)::INT AS has_any_confessionals,
    coalesce(2 * episodes_with_confessionals >= total_episodes_appeared, false)::INT AS high_edit_presence,
    coalesce(overall_confessional_count_ratio > 1.2, false)::INT AS significantly_over_edited, coalesce(overall_confessional_count_ratio < 0.8,
      false)::INT AS significantly_under_edited, coalesce(total_confessional_count > 0 AND challenges_won > 0, false)::INT AS edit_and_challenge_success,
    coalesce(total_confessional_count > 0 AND advantages_found > 0, false)::INT AS edit_and_advantage_success,
      coalesce(2 * episodes_with_confessionals >= total_episodes_appeared AND vote_accuracy_rate >= 0.7, false)::INT AS edit_and_strategic_success
  FROM ml_features_non_edit n LEFT JOIN shown ON who = n.castaway_id AND season = n.version_season"""
#: Averages and deviations, which engines add up in different orders.
ROUNDED = ("average_age", "age_stddev", "season_average_age", *(m for m in (*_MEASURES, *M.EDIT_STATS) if m.startswith("avg_")))


def _oracle(name: str, columns: list[str]) -> str:
    steps = {n: _bronze_sql(n) for n in BRONZE} | SILVER_SQL | {"ml_features_non_edit": NON_EDIT_SQL, "ml_features_hybrid": HYBRID_SQL}
    rounded = ", ".join(f"round({c}, 9) AS {c}" for c in columns if c in ROUNDED)
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in steps.items()) + f" SELECT *{f' REPLACE ({rounded})' if rounded else ''} FROM {name}"


def sql_over(select: str, *names: str) -> str:
    """SQL over the bronze tables ``names``, or over all of them and the models."""
    steps = {n: _bronze_sql(n) for n in names or BRONZE}
    if not names:
        steps |= SILVER_SQL | {"ml_features_non_edit": NON_EDIT_SQL, "ml_features_hybrid": HYBRID_SQL}
    return "WITH " + ", ".join(f"{n} AS ({sql})" for n, sql in steps.items()) + f" {select}"


def silver_of(tables: dict[str, DataFrame], name: str) -> DataFrame:
    """A silver model over bronze ``tables``."""
    model = next(m for m in M.SILVER if m.__name__ == name)
    return model(*(tables[n] for n in M.SILVER[model]))


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in df.columns if c in ROUNDED})


def _register(model, names: list[str], columns: list[str]) -> None:
    def build(t):
        return rounded(model(*bronze(t, *names).values()))

    build.__name__ = f"model_{model.__name__}"
    query(_oracle(model.__name__, columns))(build)


for _model, _names in M.SILVER.items():
    _register(_model, _names, list(M.SEASON_CONTEXT) if _model is M.season_context else [])

_GOLD = [*M.TARGETS, *M.OF_PROFILE, *M.OF_SEASON, *_MEASURES]


def _gold(t, hybrid: bool) -> DataFrame:
    """A gold model, rounded before profiles repeat its rows."""
    tables = bronze(t)
    silver = {name: silver_of(tables, name) for name in SILVER_SQL}
    features = M.person_features(tables["castaways"], silver)
    if hybrid:
        features = M.ml_features_hybrid(features, silver["edit_features"])
    return M.with_profiles(rounded(features), silver["castaway_profile"])


@query(_oracle("ml_features_non_edit", _GOLD))
def model_ml_features_non_edit(t):
    return _gold(t, False)


@query(_oracle("ml_features_hybrid", [*_GOLD, *M.EDIT_STATS]))
def model_ml_features_hybrid(t):
    return _gold(t, True)
