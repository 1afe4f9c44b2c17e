"""The star schema of the game: five dimensions, two bridges and seven facts, over tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as O
from . import models as M
from .game import CUSTOMER, ORDER, SHIP, listed
from .registry import query

SKILLS = ("balance", "endurance", "knowledge", "memory", "precision", "puzzle", "race", "strength", "water")
_EPISODE_KEY = "concat(version_season, '-', lpad(CAST({0} AS STRING), 2, '0'))"
#: Source tables: the given table, columns, and further columns that are aggregates by the first ones. Some people and episodes are missing.
SOURCES = {
    "castaway_details": ("customer", {
        "castaway_id": "CASE WHEN c_custkey % 10 > 0 THEN CAST(c_custkey AS STRING) END", "full_name": "c_name",
        "gender": "CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END", "date_of_birth": "CAST('1970-01-01' AS DATE)",
        "date_of_death": "CAST(NULL AS DATE)", "collar": "c_mktsegment",
        "occupation": "CAST(c_nationkey AS STRING)", "personality_type": "c_mktsegment", "race": "c_mktsegment", "ethnicity": "CAST(NULL AS STRING)", "african": "c_custkey % 7 = 0", "asian": "c_custkey % 5 = 0", "latin_american": "c_custkey % 6 = 0", "native_american": "c_custkey % 13 = 0", "bipoc": "c_custkey % 2 = 0", "lgbt": "CASE WHEN c_custkey % 9 > 0 THEN c_custkey % 4 = 0 END"}, None),
    "season_summary": ("orders", {"version_season": f"CASE WHEN year(o_orderdate) < 1998 THEN {ORDER[0]} END", "season": "CAST(year(o_orderdate) - 1985 AS INT)"}, {
        "version": "max('Y')", "season_name": "min(o_orderstatus)", "location": "min(o_orderpriority)", "country": "max(o_orderpriority)",
        "tribe_setup": "max(o_orderpriority)", "n_cast": "CAST(count(DISTINCT o_custkey) AS INT)",
        "n_tribes": "CAST(count(DISTINCT o_orderpriority) AS INT)", "n_finalists": "CAST(3 AS INT)", "n_jury": "CAST(count(*) AS INT)",
        "premiered": "CAST(min(o_orderdate) AS DATE)", "ended": "CAST(max(o_orderdate) AS DATE)",
        "filming_started": "CAST(min(o_orderdate) AS DATE)", "filming_ended": "CAST(max(o_orderdate) AS DATE)",
        "winner_id": "CAST(min(o_custkey) AS STRING)",
        "viewers_reunion": "max(o_totalprice)", "viewers_premiere": "min(o_totalprice)", "viewers_finale": "max(o_totalprice)", "viewers_mean": "min(o_totalprice)", "rank": "CAST(count(*) % 9 AS INT)"}),
    "episodes": ("orders", {"version_season": ORDER[0], "episode": f"CASE WHEN month(o_orderdate) <> 5 THEN {ORDER[1]} END"}, {
        "episode_title": "min(o_orderpriority)", "episode_date": "CAST(min(o_orderdate) AS DATE)", "episode_summary": "max(o_orderstatus)", "total_episode_count": "CAST(11 + min(year(o_orderdate)) % 2 AS INT)"}),
    "challenge_description": ("part", {
        "version_season": "concat('Y', CAST(1992 + p_partkey % 7 AS STRING))", "challenge_id": "p_partkey", "challenge_name": "p_name",
        "recurring_name": "p_type", "challenge_type": "p_brand", "short_description": "p_type", "long_description": "p_name",
        "location": "p_brand", "episode": "p_size", "reward": "p_size % 2 = 0", "immunity": "p_size % 3 = 0",
        "reward_details": "CAST(NULL AS STRING)", "immunity_details": "p_type", **{s: f"CASE WHEN p_partkey % 19 > 0 THEN p_partkey % {i + 2} = 0 END" for i, s in enumerate(SKILLS)}}, None),
    "advantage_details": ("part", {
        "version_season": "concat('Y', CAST(1992 + p_partkey % 7 AS STRING))", "advantage_id": "CASE WHEN p_partkey % 4 > 0 THEN CAST(p_partkey AS STRING) END", "advantage_name": "p_name", "advantage_type": "p_type", "advantage_subtype": "p_brand", "first_ep": "p_size", "reentry_ep": "CASE WHEN p_size % 3 = 0 THEN p_size END", "notes": "p_brand"}, None),
    "castaways": ("orders", {"castaway_id": CUSTOMER, "version_season": ORDER[0]}, {
        "original_tribe": "min(o_orderpriority)", "result": "max(o_orderstatus)", "place": "CAST(count(*) AS STRING)", "jury_status": "min(o_orderstatus)", "jury": "max(o_orderkey % 5 = 0)", "finalist": "max(o_orderkey % 11 = 0)", "winner": "max(o_orderkey % 17 = 0)"}),
    "confessionals": ("events", {"castaway_id": "CAST(user_id AS STRING)", "version_season": "concat('Y', CAST(1992 + user_id % 7 AS STRING))", "episode": "CAST(day(ts) % 13 AS INT)"}, {
        "confessional_count": "CAST(count(*) AS INT)", "confessional_time": "CAST(sum(length(event_type)) AS DOUBLE)", "exp_count": "CAST(count(DISTINCT event_type) AS DOUBLE)", "exp_time": "CAST(min(length(event_type)) AS DOUBLE)", "confessional_id": "min(event_id)"}),
    "challenge_results": ("lineitem", {
        "castaway_id": "CAST(l_suppkey AS STRING)", "version_season": SHIP[0], "episode": SHIP[1], "challenge_id": "l_partkey", "sog_id": "l_linenumber", "outcome_type": "l_linestatus", "result": "l_returnflag", "result_notes": "l_linestatus", "chosen_for_reward": "l_linenumber = 1", "sit_out": "l_linenumber = 4", "order_of_finish": "l_linenumber", "challenge_results_id": "l_orderkey * 10 + l_linenumber"}, None),
    "vote_history": ("orders", {
        "castaway_id": CUSTOMER, "version_season": ORDER[0], "episode": ORDER[1], "challenge_id": "o_orderkey % 300",
        "vote_id": "CASE WHEN o_orderkey % 10 > 0 THEN CAST(o_orderkey % 7 AS STRING) END",
        "voted_out_id": "CAST(month(o_orderdate) % 7 AS STRING)", "immunity": "o_orderstatus", "vote": "o_orderpriority",
        "vote_event": "o_orderstatus",
        "vote_event_outcome": "o_orderpriority", "split_vote": "CASE WHEN o_orderkey % 12 = 0 THEN 'split' END", "nullified": "o_orderkey % 3 = 0", "tie": "o_orderkey % 21 = 0", "vote_order": "CAST(o_orderkey % 3 AS INT)", "sog_id": "CAST(o_orderkey % 5 AS INT)", "vote_history_id": "o_orderkey"}, None),
    "advantage_movement": ("lineitem", {
        "castaway_id": "CAST(l_suppkey AS STRING)",
        "played_for_id": "CASE WHEN l_orderkey % 4 > 0 THEN CAST(l_suppkey + l_linenumber % 2 AS STRING) END", "version_season": SHIP[0],
        "sequence_id": "l_linenumber", "advantage_id": "CAST(l_partkey AS STRING)", "day": SHIP[2], "episode": SHIP[1],
        "event": "l_linestatus", "success": "l_returnflag",
        "votes_nullified": "CAST(l_quantity AS INT)", "sog_id": "l_linenumber", "advantage_movement_id": "l_orderkey * 10 + l_linenumber"}, None),
    "boot_mapping": ("orders", {
        "castaway_id": CUSTOMER, "version_season": ORDER[0], "episode": ORDER[1], "boot_mapping_order": "o_orderkey", "n_boots": "CAST(o_orderkey % 3 AS INT)", "final_n": "CAST(o_orderkey % 18 AS INT)", "sog_id": "CAST(o_orderkey % 5 AS INT)", "tribe": "o_orderpriority", "tribe_status": "o_orderstatus", "game_status": "o_orderstatus", "boot_mapping_id": "o_orderkey"}, None),
    "tribe_mapping": (
        "orders",
        {
            "castaway_id": CUSTOMER, "version_season": ORDER[0], "episode": ORDER[1], "day": ORDER[2], "tribe": "o_orderpriority",
            "tribe_status": "o_orderstatus", "tribe_map_id": "o_orderkey"
        },
        None
    ),
    "jury_votes": (
        "orders",
        {
            "castaway_id": CUSTOMER, "finalist_id": "CAST(o_orderkey % 40 AS STRING)", "version_season": ORDER[0],
            "vote": "o_orderpriority", "jury_vote_id": "o_orderkey"
        },
        None
    ),
}

# Columns of the dimensions and facts (fixed values): name, and where it comes from if that has another name.
same = M.same
DIMENSIONS = {d.name: d for d in (
    O.Dimension(
        "dim_castaway", "castaway_key", ("castaway_id",),
        same(
            "full_name", "gender", "date_of_birth", "date_of_death", "collar", "occupation", "personality_type", "race", "ethnicity"
        ) | {f"is_{x}": x for x in ("african", "asian", "latin_american", "native_american", "bipoc", "lgbt")}
    ),
    O.Dimension("dim_season", "season_key", ("version_season",), same("version", "season_name") | {"season_number": "season"} | same("location", "country", "tribe_setup") | {"cast_size": "n_cast", "tribe_count": "n_tribes", "finalist_count": "n_finalists", "jury_count": "n_jury"}
                | same("premiered", "ended", "filming_started", "filming_ended") | {"winner_castaway_id": "winner_id"} | same("viewers_reunion", "viewers_premiere", "viewers_finale", "viewers_mean", "rank"), few=True),
    O.Dimension("dim_episode", "episode_key", ("version_season", "episode_in_season"), same("episode_title", "episode_date") | {"episode_description": "episode_summary"} | same("total_episode_count") | {
        "previous_episode_key": f"CASE WHEN episode_in_season > 1 THEN {_EPISODE_KEY.format('episode_in_season - 1')} END", "next_episode_key": f"CASE WHEN episode_in_season < total_episode_count THEN {_EPISODE_KEY.format('episode_in_season + 1')} END"}, _EPISODE_KEY.format("episode_in_season"), few=True),
    O.Dimension("dim_challenge", "challenge_key", ("version_season", "challenge_id"), same("challenge_name", "recurring_name", "challenge_type", "short_description", "long_description", "location") | {"season_episode_key": _EPISODE_KEY.format("episode")}
                | same("reward", "immunity", "reward_details", "immunity_details") | {"source_challenge_id": "challenge_id"}, "concat(version_season, '-', CAST(challenge_id AS STRING))"),
    O.Dimension("dim_advantage", "advantage_key", ("version_season", "advantage_id"), same("advantage_name", "advantage_type", "advantage_subtype") | {"first_appearance_episode_key": _EPISODE_KEY.format("first_ep"), "reentry_episode_key": _EPISODE_KEY.format("reentry_ep")}
                | same("notes") | {"source_advantage_id": "advantage_id"}, "concat(version_season, '-', advantage_id)"),
)}
#: The source of each dimension.
FROM = {
    "dim_castaway": "castaway_details", "dim_season": "season_summary", "dim_episode": "episodes", "dim_challenge": "challenge_description",
    "dim_advantage": "advantage_details"
}

_WHO, _SEASON, _EPISODE, _CHALLENGE = ("castaway_id",), ("version_season",), ("version_season", "episode"), ("version_season", "challenge_id")


def _person(columns: tuple[str, ...] = _WHO, alias: str = "castaway_key", required: bool = False) -> O.Lookup:
    return O.Lookup("dim_castaway", columns, alias, required)


_OF_SEASON, _OF_EPISODE, _OF_CHALLENGE = O.Lookup("dim_season", _SEASON, "season_key", True), O.Lookup("dim_episode", _EPISODE, "episode_key"), O.Lookup(
    "dim_challenge", _CHALLENGE, "challenge_key"
)
#: Facts and the bridge of people and seasons: source, lookups, columns.
FACTS = {
    "bridge_castaway_season": (
        "castaways", [_person(required=True), _OF_SEASON],
        same("castaway_id", "version_season", "original_tribe", "result", "place", "jury_status", "jury", "finalist", "winner")
    ),
    "fact_confessionals": (
        "confessionals", [_person(required=True), _OF_SEASON, _OF_EPISODE],
        same("castaway_id", "version_season") | {"episode_in_season": "episode"} | same("confessional_count", "confessional_time") | {
            "expected_count": "exp_count", "expected_time": "exp_time", "source_confessional_id": "confessional_id"
        }
    ),
    "fact_challenge_results": ("challenge_results", [_person(required=True), _OF_SEASON, _OF_EPISODE, _OF_CHALLENGE],
        {"advantage_key": "CAST(NULL AS STRING)"} | same("castaway_id", "version_season", "challenge_id", "sog_id", "outcome_type", "result", "result_notes", "chosen_for_reward", "sit_out", "order_of_finish") | {"source_challenge_result_id": "challenge_results_id"}),
    "fact_vote_history": ("vote_history", [_person(), _OF_SEASON, _OF_EPISODE, _OF_CHALLENGE], same("castaway_id") | {"target_castaway_id": "vote_id", "voted_out_castaway_id": "voted_out_id"} | same("version_season") | {"episode_in_season": "episode"}
        | same("immunity", "vote", "vote_event", "vote_event_outcome", "split_vote", "nullified", "tie", "vote_order", "sog_id") | {"source_vote_history_id": "vote_history_id"}),
    "fact_advantage_movement": ("advantage_movement", [_person(), _person(("played_for_id",), "target_castaway_key"), _OF_SEASON, _OF_EPISODE, O.Lookup("dim_advantage", ("version_season", "advantage_id"), "advantage_key", True)],
        same("castaway_id") | {"target_castaway_id": "played_for_id"} | same("version_season", "sequence_id", "advantage_id", "day") | {"episode_in_season": "episode"} | same("event", "success", "votes_nullified", "sog_id") | {"source_advantage_movement_id": "advantage_movement_id"}),
    "fact_boot_mapping": (
        "boot_mapping", [_person(), _OF_SEASON, _OF_EPISODE],
        same("castaway_id", "version_season") | {"episode_in_season": "episode"} | same(
            "boot_mapping_order", "n_boots", "final_n", "sog_id", "tribe", "tribe_status", "game_status"
        ) | {"source_boot_mapping_id": "boot_mapping_id"}
    ),
    "fact_tribe_membership": (
        "tribe_mapping", [_person(), _OF_SEASON, _OF_EPISODE],
        same("castaway_id", "version_season") | {"episode_in_season": "episode"} | same("day", "tribe", "tribe_status") | {
            "source_tribe_mapping_id": "tribe_map_id"
        }
    ),
    "fact_jury_votes": ("jury_votes", [_person(alias="juror_castaway_key"), _person(("finalist_id",), "finalist_castaway_key"), _OF_SEASON],
        {"juror_castaway_id": "castaway_id", "finalist_castaway_id": "finalist_id"} | same("version_season", "vote") | {"source_jury_vote_id": "jury_vote_id"}),
}


def sources(t, *names: str) -> dict[str, DataFrame]:
    def table(name: str) -> DataFrame:
        given, keys, more = SOURCES[name]
        return M.per(getattr(t, given), keys, more) if more else M.pick(getattr(t, given), keys)

    return {n: table(n) for n in names}


def build_dimension(name: str, source: DataFrame, held: DataFrame | None = None) -> DataFrame:
    """A dimension after an upsert from its source."""
    renamed = source.withColumnRenamed("episode", "episode_in_season") if name == "dim_episode" else source
    return O.keep_dimension(held, O.dimension_rows(renamed, DIMENSIONS[name]), DIMENSIONS[name])


def build_fact(name: str, source: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    _, lookups, columns = FACTS[name]
    return O.fact_rows(source, lookups, {d: (DIMENSIONS[d], rows) for d, rows in dimensions.items()}, columns)


def build_skill_bridge(challenges: DataFrame) -> DataFrame:
    """A row for each challenge and skill that it needs: the challenge's key, the skill and the skill's key."""
    bridge = O.flag_bridge(challenges, F.expr(DIMENSIONS["dim_challenge"].text_key), "challenge_key", list(SKILLS), "skill_name")
    return bridge.withColumn("skill_key", F.md5("skill_name"))


# Queries. The SQL is written from the schema's description, table by table.


def _source_sql(name: str) -> str:
    given, keys, more = SOURCES[name]
    return f"{name} AS (SELECT {listed(keys | (more or {}))} FROM {given}" + (f" GROUP BY {', '.join(keys.values())}" if more else "") + ")"


_PAD = "lpad(({0})::VARCHAR, 2, '0')"
DIMENSION_SQL = {
    "dim_castaway": "SELECT md5(castaway_id) AS castaway_key, castaway_id, full_name, gender, date_of_birth, date_of_death, collar, occupation, personality_type, race, ethnicity, african AS is_african, asian AS is_asian, latin_american AS is_latin_american, native_american AS is_native_american, bipoc AS is_bipoc, lgbt AS is_lgbt, false AS is_late FROM castaway_details WHERE castaway_id IS NOT NULL",
    "dim_season": "SELECT md5(version_season) AS season_key, version_season, version, season_name, season AS season_number, location, country, tribe_setup, n_cast AS cast_size, n_tribes AS tribe_count, n_finalists AS finalist_count, n_jury AS jury_count, premiered, ended, filming_started, filming_ended, winner_id AS winner_castaway_id, viewers_reunion, viewers_premiere, viewers_finale, viewers_mean, rank, false AS is_late FROM season_summary WHERE version_season IS NOT NULL",
    "dim_episode": f"SELECT version_season || '-' || {_PAD.format('episode')} AS episode_key, version_season, episode AS episode_in_season, episode_title, episode_date, episode_summary AS episode_description, total_episode_count, CASE WHEN episode > 1 THEN version_season || '-' || {_PAD.format('episode - 1')} END AS previous_episode_key, CASE WHEN episode < total_episode_count THEN version_season || '-' || {_PAD.format('episode + 1')} END AS next_episode_key, false AS is_late FROM episodes WHERE episode IS NOT NULL",
    "dim_challenge": f"SELECT version_season || '-' || challenge_id AS challenge_key, version_season, challenge_id, challenge_name, recurring_name, challenge_type, short_description, long_description, location, version_season || '-' || {_PAD.format('episode')} AS season_episode_key, reward, immunity, reward_details, immunity_details, challenge_id AS source_challenge_id, false AS is_late FROM challenge_description",
    "dim_advantage": f"SELECT version_season || '-' || advantage_id AS advantage_key, version_season, advantage_id, advantage_name, advantage_type, advantage_subtype, version_season || '-' || {_PAD.format('first_ep')} AS first_appearance_episode_key, version_season || '-' || {_PAD.format('reentry_ep')} AS reentry_episode_key, notes, advantage_id AS source_advantage_id, false AS is_late FROM advantage_details WHERE advantage_id IS NOT NULL",
}
_IN_SEASON = "JOIN dim_season ds ON ds.version_season = f.version_season"
_AT_EPISODE = "LEFT JOIN dim_episode de ON de.version_season = f.version_season AND de.episode_in_season = f.episode"
_BY = "LEFT JOIN dim_castaway dc ON dc.castaway_id = f.castaway_id"
_AT_CHALLENGE = "LEFT JOIN dim_challenge dh ON dh.version_season = f.version_season AND dh.challenge_id = f.challenge_id"
FACT_SQL = {
    "bridge_castaway_season": f"SELECT castaway_key, season_key, f.* FROM castaways f {_BY[5:]} {_IN_SEASON}",
    "fact_confessionals": f"SELECT castaway_key, season_key, episode_key, f.castaway_id, f.version_season, f.episode AS episode_in_season, confessional_count, confessional_time, exp_count AS expected_count, exp_time AS expected_time, confessional_id AS source_confessional_id FROM confessionals f {_BY[5:]} {_IN_SEASON} {_AT_EPISODE}",
    "fact_challenge_results": f"SELECT castaway_key, season_key, episode_key, challenge_key, NULL::VARCHAR AS advantage_key, f.castaway_id, f.version_season, f.challenge_id, sog_id, outcome_type, result, result_notes, chosen_for_reward, sit_out, order_of_finish, challenge_results_id AS source_challenge_result_id FROM challenge_results f {_BY[5:]} {_IN_SEASON} {_AT_EPISODE} {_AT_CHALLENGE}",
    "fact_vote_history": f"SELECT castaway_key, season_key, episode_key, challenge_key, f.castaway_id, vote_id AS target_castaway_id, voted_out_id AS voted_out_castaway_id, f.version_season, f.episode AS episode_in_season, f.immunity, vote, vote_event, vote_event_outcome, split_vote, nullified, tie, vote_order, sog_id, vote_history_id AS source_vote_history_id FROM vote_history f {_BY} {_IN_SEASON} {_AT_EPISODE} {_AT_CHALLENGE}",
    "fact_advantage_movement": f"SELECT dc.castaway_key, x.castaway_key AS target_castaway_key, season_key, episode_key, advantage_key, f.castaway_id, played_for_id AS target_castaway_id, f.version_season, sequence_id, f.advantage_id, day, f.episode AS episode_in_season, event, success, votes_nullified, sog_id, advantage_movement_id AS source_advantage_movement_id FROM advantage_movement f {_BY} LEFT JOIN dim_castaway x ON x.castaway_id = f.played_for_id {_IN_SEASON} {_AT_EPISODE} JOIN dim_advantage da ON da.version_season = f.version_season AND da.advantage_id = f.advantage_id",
    "fact_boot_mapping": f"SELECT castaway_key, season_key, episode_key, f.castaway_id, f.version_season, f.episode AS episode_in_season, boot_mapping_order, n_boots, final_n, sog_id, tribe, tribe_status, game_status, boot_mapping_id AS source_boot_mapping_id FROM boot_mapping f {_BY} {_IN_SEASON} {_AT_EPISODE}",
    "fact_tribe_membership": f"SELECT castaway_key, season_key, episode_key, f.castaway_id, f.version_season, f.episode AS episode_in_season, day, tribe, tribe_status, tribe_map_id AS source_tribe_mapping_id FROM tribe_mapping f {_BY} {_IN_SEASON} {_AT_EPISODE}",
    "fact_jury_votes": f"SELECT dc.castaway_key AS juror_castaway_key, x.castaway_key AS finalist_castaway_key, season_key, f.castaway_id AS juror_castaway_id, finalist_id AS finalist_castaway_id, f.version_season, vote, jury_vote_id AS source_jury_vote_id FROM jury_votes f {_BY} LEFT JOIN dim_castaway x ON x.castaway_id = f.finalist_id {_IN_SEASON}",
}


def star_tables(t, *facts: str) -> dict[str, DataFrame]:
    """All dimensions and the facts asked for."""
    out = {d: build_dimension(d, sources(t, FROM[d])[FROM[d]]) for d in DIMENSIONS}
    return out | {f: build_fact(f, sources(t, FACTS[f][0])[FACTS[f][0]], {x.dimension: out[x.dimension] for x in FACTS[f][1]}) for f in facts}


def star_sql(*facts: str) -> str:
    """The steps of a WITH clause that has all dimensions and the facts asked for."""
    names = dict.fromkeys([*(FACTS[f][0] for f in facts), *FROM.values()])
    return ", ".join([*map(_source_sql, names), *(f"{d} AS ({DIMENSION_SQL[d]})" for d in DIMENSIONS), *(f"{f} AS ({FACT_SQL[f]})" for f in facts)])


def _register_dimension(name: str) -> None:
    def build(t):
        return build_dimension(name, sources(t, FROM[name])[FROM[name]])

    build.__name__ = f"star_{name}"
    query(f"WITH {_source_sql(FROM[name])} {DIMENSION_SQL[name]}")(build)


def _register_fact(name: str) -> None:
    source, lookups, _ = FACTS[name]
    needed = list(dict.fromkeys(x.dimension for x in lookups))

    def build(t):
        return build_fact(name, sources(t, source)[source], {d: build_dimension(d, sources(t, FROM[d])[FROM[d]]) for d in needed})

    build.__name__ = f"star_{name}"
    steps = [_source_sql(source), *(_source_sql(FROM[d]) for d in needed), *(f"{d} AS ({DIMENSION_SQL[d]})" for d in needed)]
    query(f"WITH {', '.join(steps)} {FACT_SQL[name]}")(build)


for _name in DIMENSIONS:
    _register_dimension(_name)
for _name in FACTS:
    _register_fact(_name)


@query(f"""WITH {_source_sql("challenge_description")}, flags AS (SELECT version_season || '-' || challenge_id AS challenge_key, unnest([{", ".join(f"'{s}'" for s in SKILLS)}]) AS skill_name, unnest([{", ".join(SKILLS)}]) AS held FROM challenge_description)
  SELECT DISTINCT challenge_key, skill_name, md5(skill_name) AS skill_key FROM flags WHERE held""")
def star_challenge_skill_bridge(t):
    return build_skill_bridge(sources(t, "challenge_description")["challenge_description"])


@query(f"""WITH {_source_sql("vote_history")}, {_source_sql("castaway_details")}, known AS (SELECT * FROM castaway_details WHERE castaway_id IS NOT NULL)
  SELECT md5(id) AS castaway_key, id AS castaway_id, full_name, full_name IS NULL AS is_late FROM (SELECT DISTINCT voted_out_id AS id
    FROM vote_history UNION SELECT castaway_id FROM known) LEFT JOIN known ON castaway_id = id""")
def star_late_members(t):
    """People that votes name and no source has described yet, beside those it has."""
    found = sources(t, "vote_history", "castaway_details")
    held = build_dimension("dim_castaway", found["castaway_details"])
    return O.with_late_members(
        held, found["vote_history"], DIMENSIONS["dim_castaway"], ("voted_out_id",)
    ).select("castaway_key", "castaway_id", "full_name", "is_late")
