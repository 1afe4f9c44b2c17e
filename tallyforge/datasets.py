"""The landed datasets of the game, ready to load: keys, repairs, missing parents, and column types by rule."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import functions as T
from . import operators as O
from .medallion import Dataset, Parents, Repair, drop_orphans, note, noted, report_nulls

# Keys of the datasets (fixed values); names after a bar may be null.
KEYS = {
    "advantage_details": "advantage_id version_season",
    "advantage_movement": "version_season castaway_id advantage_id sequence_id played_for_id | played_for_id",
    "auction_details": "version_season auction_num item castaway_id | castaway_id",
    "boot_mapping": "sog_id castaway_id version_season",
    "boot_order": "version_season boot_order_position castaway_id | boot_order_position",
    "castaway_details": "castaway_id",
    "castaways": "castaway_id version_season",
    "challenge_description": "challenge_id version_season",
    "challenge_summary": "",
    "challenge_results": "castaway_id challenge_id sog_id version_season",
    "vote_history": "",
    "episodes": "episode version_season",
    "confessionals": "castaway_id version_season episode",
    "jury_votes": "version_season castaway_id vote finalist_id | castaway_id",
    "survivor_auction": "version_season episode castaway_id",
    "season_summary": "version_season",
    "tribe_mapping": "castaway_id version_season episode tribe day | day",
    "castaway_scores": "version_season castaway_id",
    "journeys": "version_season episode sog_id castaway_id",
}
#: What a reserved column name becomes (fixed values).
RENAMES = {"castaways": "castaways_order", "boot_mapping": "boot_mapping_order", "vote_history": "vote_history_order", "boot_order": "boot_order_position"}
#: Known wrong challenges of votes: season, number, right number (fixed values).
CHALLENGE_FIXES = [("US37", 26, 25), ("AU11", 13, 12)]
#: Columns by which repeated rows of challenge_summary are told (fixed values).
SUMMARY_COLUMNS = ("version_season", "challenge_id", "outcome_type", "tribe", "castaway_id", "category")
#: Names of columns that are true or false, and of dates (fixed values).
BOOLEANS = frozenset("""african asian latin_american native_american bipoc lgbt jury finalist winner acknowledge ack_look ack_speak ack_gesture ack_smile chosen_for_reward sit_out nullified tie
    balance balance_ball balance_beam endurance fire food knowledge memory mud obstacle_blindfolded obstacle_cargo_net obstacle_chopping obstacle_digging obstacle_knots obstacle_padlocks obstacle_combination_lock
    precision precision_catch precision_roll_ball precision_slingshot precision_throw_balls precision_throw_coconuts precision_throw_rings precision_throw_sandbags puzzle puzzle_slide puzzle_word race strength turn_based
    water water_paddling water_swim covered alternative_offered joint_play multi_target_play alternative_accepted lost_vote""".split())
DATES = frozenset(("premiered", "ended", "filming_started", "filming_ended", "episode_date"))
_WHOLE = re.compile(
    r"n_.*|.*_count|.*_number|.*_num|.*_order|.*_position|episode|day|age|season|rank|sog_id|sequence_id|challenge_id|votes_nullified|order_of_finish|final_n"
)
_REAL = re.compile(r".*_time|viewers_.*|exp_.*|score_.*|.*_rating|.*_cost|cost|total")


def column_type(name: str, dataset: str) -> str:
    """The type of a column by its name: dates and booleans as listed, whole and real numbers by their endings, else text. ``race`` is a skill in challenges and text elsewhere."""
    if name in DATES:
        return "date"
    if name in BOOLEANS and not (name == "race" and not dataset.startswith("challenge_")):
        return "boolean"
    return "int" if _WHOLE.fullmatch(name) else "double" if _REAL.fullmatch(name) else "string"


def cleaned(*columns: str) -> Repair:
    """Ids trimmed, with the words for nothing as null; absent columns are passed over."""
    return lambda df, tables: df.withColumns({c: T.clean_id(F.col(c)) for c in columns if c in df.columns})


def split_plays(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """A row for each holder and target of an advantage, with an event for each row that comes from a cell of several; targets that nobody is become null. Comes before other repairs."""
    keys = ["version_season", "advantage_id", "sequence_id"]
    for c in ("castaway", "played_for", "co_castaway_ids"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    df = df.drop("joint_play", "multi_target_play")
    df = O.explode_multi_value(df, "castaway_id", "castaway", flag="joint_play", companions="co_castaway_ids")
    df = O.explode_targets(df, "played_for_id", "played_for", companions="co_castaway_ids", flag="multi_target_play")
    df = noted(
        df, F.col("joint_play") | F.col("multi_target_play"),
        note("cell split", keys, "castaway_id", after=F.concat_ws("/", "castaway_id", "played_for_id"))
    )
    if "castaway_details" not in tables:
        return df
    known = tables["castaway_details"].select(F.col("castaway_id").alias("_known")).dropna().distinct()
    met = df.join(known, F.col("played_for_id") == F.col("_known"), "left")
    bad = F.col("played_for_id").isNotNull() & F.col("_known").isNull()
    return noted(
        met, bad, note("reference nulled", keys, "played_for_id", F.col("played_for_id"))
    ).withColumn("played_for_id", F.when(~bad, F.col("played_for_id"))).drop("_known")


def fill_ids(keys: list[str]) -> Repair:
    """Missing ids found by name among the season's castaways, with an event each."""

    def run(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        if "castaways" not in tables or "castaway" not in df.columns:
            return df
        people = tables["castaways"].select("version_season", "castaway", F.col("castaway_id").alias("_found"))
        met = O.resolve_ids(df, people, ["version_season"], "castaway", "_found")
        lost = F.col("castaway_id").isNull() & F.col("_found").isNotNull()
        event = note(
            "id filled in", keys, "castaway_id", after=F.col("_found"),
            context=F.concat_ws(", ", F.concat(F.lit("castaway="), F.col("castaway")), F.concat(F.lit("by="), F.col("resolved_by")))
        )
        return noted(met, lost, event).withColumn("castaway_id", F.coalesce("castaway_id", "_found")).drop("_found", "resolved_by")

    return run


def fix_challenges(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Challenges of votes: known wrong ones put right, unknown ones replaced by the season's only one if it has one, else null; an event each."""
    if "challenge_description" not in tables or "challenge_id" not in df.columns:
        return df
    number = T.lenient_integer(F.col("challenge_id"))
    valid = tables["challenge_description"].select("version_season", F.col("challenge_id").cast("int").alias("challenge_id"))
    fixes = df.sparkSession.createDataFrame(CHALLENGE_FIXES, "version_season string, challenge_id int, fixed int")
    met = O.repair_reference(
        df.withColumn("_landed", F.col("challenge_id")).withColumn("challenge_id", number), "challenge_id", ["version_season"], valid, fixes
    )
    lost = (F.col("repaired") == "unresolved") & F.col("_landed").isNotNull()
    keys = ["version_season", "castaway_id"]
    met = noted(
        met, F.col("repaired").isin("fixed", "candidate") & F.col("_landed").isNotNull(),
        note("reference fixed", keys, "challenge_id", F.col("_landed"), F.col("challenge_id"))
    )
    met = noted(met, lost, note("reference nulled", keys, "challenge_id", F.col("_landed")))
    return met.withColumn("challenge_id", F.when(~lost & F.col("_landed").isNotNull(), F.col("challenge_id"))).drop("_landed", "repaired")


def report_repeats(columns: tuple[str, ...]) -> Repair:
    """Rows that agree in ``columns`` (those that are there) stay, with an event each."""

    def run(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        known = [c for c in columns if c in df.columns]
        met = df.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*known)))
        return noted(met, F.col("_n") > 1, note("duplicate kept", known)).drop("_n")

    return run


_VOTE = ["version_season", "episode"]
REPAIRS: dict[str, tuple[Repair, ...]] = {
    "castaways": (drop_orphans(["castaway_id", "version_season"], "castaway_id", "castaway_details", "castaway_id"),),
    "vote_history": (cleaned("castaway_id"), report_nulls(_VOTE, "castaway_id"), fix_challenges),
    **{name: (cleaned("castaway_id", "castaway"),) for name in ("boot_order", "auction_details", "castaway_scores", "survivor_auction")},
    "journeys": (cleaned("castaway_id"), fill_ids(["version_season", "episode", "sog_id"])),
    "advantage_movement": (split_plays,),
    "challenge_summary": (report_repeats(SUMMARY_COLUMNS),),
}
PARENTS = {"challenge_results": (Parents("challenge_description", ("version_season", "challenge_id"), "sog_id", (), "challenge_summary"),)}
CONTEXT = {"vote_history": ("episode", "vote_event"), "journeys": ("episode", "sog_id")}
#: Datasets that repairs look things up in, besides references and parents.
LOOKED_UP = {
    "castaways": ("castaway_details",), "vote_history": ("challenge_description",), "journeys": ("castaways",),
    "advantage_movement": ("castaway_details",)
}


def dataset_of(name: str, landed: DataFrame, *, types: dict[str, str] | None = None) -> Dataset:
    """How a landed dataset loads: its columns are those that landed and those its repairs add, typed by rule unless ``types`` has them."""
    keys, _, nullable = KEYS[name].partition("|")
    renames = {"order": RENAMES[name]} if name in RENAMES else {}
    columns = [renames.get(c, c) for c in (x.strip().lower().replace(" ", "_") for x in landed.columns)]
    if name == "advantage_movement":
        columns += [c for c in ("castaway", "played_for", "co_castaway_ids", "joint_play", "multi_target_play") if c not in columns]
    schema = ", ".join(f"{c} {(types or {}).get(c) or column_type(c, name)}" for c in columns)
    context = tuple(c for c in CONTEXT.get(name, ()) if c in columns)
    return Dataset(
        name, schema, tuple(keys.split()), (), tuple(nullable.split()), renames, REPAIRS.get(name, ()), PARENTS.get(name, ()),
        context=context, after=LOOKED_UP.get(name, ())
    )

