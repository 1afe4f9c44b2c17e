from pyspark.sql import functions as F

from tallyforge import functions as T
from tallyforge import operators as O
from tallyforge.operators.quality import run_rules
from tallyforge.sources import Warehouse, close_run, latest_run, open_run


def test_alignment_skips_nulls_and_lone_actors(spark):
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (1, "b", None), (1, None, "x"), (2, "c", "x")], "g int, who string, whom string")
    found = {r.who: (r.total_others, r.aligned_others) for r in O.pairwise_alignment(df, ["g"], "who", "whom").collect()}
    assert found == {"a": (2, 1), "b": (2, 1)}


def test_lenient_casts(spark):
    values = ["Yes", " t ", "1.0", "off", "maybe", "NaN", "2", None, " none ", "", " 3.0 ", "3.7"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.select(T.lenient_boolean(F.col("v")), T.lenient_integer(F.col("v")), T.clean_id(F.col("v"))).collect()
    assert [r[0] for r in found] == [True, True, True, False, None, None, None, None, None, None, None, None]
    assert [r[1] for r in found] == [None, None, 1, None, None, None, 2, None, None, None, 3, None]
    assert found[8][2] is None and found[9][2] is None and found[0][2] == "Yes"


def test_explode_holders_then_targets(spark):
    df = spark.createDataFrame(
        [(1, "a, b,,c", "Ann, Bob", "x, y", "X"), (2, None, None, None, None)],
        "i int, holder string, holder_name string, target string, target_name string"
    )
    held = O.explode_multi_value(df, "holder", "holder_name", flag="joint_play")
    assert sorted(
        (r.i, r.holder, r.holder_name, r.companions) for r in held.where("i = 1").collect()
    ) == [(1, "a", "Ann", "b, c"), (1, "b", "Bob", "a, c"), (1, "c", "Bob", "a, b")]
    both = O.explode_targets(held, "target", "target_name")
    assert both.count() == 7 and both.where("i = 2").first().holder is None


def test_upsert_twice_changes_nothing(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    updates = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    once = O.upsert(target, updates, ["k"])
    assert sorted(map(str, once.collect())) == sorted(map(str, O.upsert(once, updates, ["k"]).collect()))
    assert O.upsert_counts(target, updates, ["k"]).first() == (1, 1)


def test_names_resolve_in_turn(spark):
    people = spark.createDataFrame([(1, "Zoë Ray", "p1"), (1, "Max Orr", "p2"), (1, "Max Lee", "p3")], "block int, name string, id string")
    rows = spark.createDataFrame([(1, n) for n in ("Zoë Ray", "ZOE RAY", "Zoë", "Max", "Max Orrr", "Quentin", None)], "block int, name string")
    found = {r.name: (r.id, r.resolved_by) for r in O.resolve_ids(rows, people, ["block"], "name", "id").collect()}
    assert found == {
        "Zoë Ray": ("p1", "exact"), "ZOE RAY": ("p1", "plain"), "Zoë": ("p1", "first"), "Max": (None, None), "Max Orrr": ("p2", "similar"),
        "Quentin": (None, None), None: (None, None)
    }


def test_similar_names_meet_few_others(spark):
    """The rounds find what comparing all names finds, ties, empty and long names among them; names with a near one never meet their block."""
    import itertools
    import random

    from tallyforge import functions as T
    from tallyforge.operators import repair

    rng = random.Random(7)
    name = lambda: "".join(rng.choice("abé#") for _ in range(rng.randrange(9)))
    names = {(b, name(), b * 1000 + i) for b in (1, 2) for i in range(60)} | {(1, "q" * 45 + "r", 7), (1, None, 8)}
    asked = {(b, name()) for b in (1, 2, 3) for _ in range(60)} | {(1, "q" * 46), (1, "q" * 44), (2, None)}
    known = {}
    for b, n, i in names:
        known[b, n] = max(i, known.get((b, n), i))
    score = lambda a, b: 2 * T.matching_letters(b, a) / (len(a) + len(b)) if a or b else 1.0
    wanted = {}
    for (b, n), ((c, m), i) in itertools.product(asked, known.items()):
        if b == c and n is not None and m is not None and score(n, m) >= 0.7:
            wanted[b, n] = max(wanted.get((b, n), (0.0, "", 0)), (score(n, m), m, i), key=lambda x: (x[0], x[1].encode(), x[2]))
    left = spark.createDataFrame(sorted(asked, key=str), "block int, name string")
    held = spark.createDataFrame([(b, n, i) for (b, n), i in known.items()], "block int, _name string, _id int")
    found = O.most_similar(left, held, ["block"], "name", "_name")
    assert {(r.block, r.name): (r._score, r._name, r._id) for r in found.collect()} == wanted
    assert len(wanted) > 60
    full = repair.T.letters_in_common
    near = spark.createDataFrame([(1, f"xName#{i:05}") for i in range(0, 3000, 3)], "block int, name string")
    people = spark.createDataFrame([(1, f"Name#{i:05}", i) for i in range(3000)], "block int, _name string, _id int")
    seen = spark.sparkContext.accumulator(0)

    def counted(a, b):
        return F.udf(lambda x, y: seen.add(1) or 0, "int")(a, b)

    repair.T.letters_in_common = counted
    try:
        got = O.most_similar(near, people, ["block"], "name", "_name").collect()
    finally:
        repair.T.letters_in_common = full
    assert all(r.name == "x" + r._name for r in got) and len(got) == 1000 and seen.value == 0


def test_rules(spark):
    df = spark.createDataFrame([(1, None), (1, "a")], "a int, b string")
    found = [tuple(r) for r in run_rules(df, ["missing_count(b) = 1", "duplicate_count(a) = 0", "missing_count(zz) = 0"]).collect()]
    assert [(r[1], r[2]) for r in found] == [(1, True), (1, False), (None, False)]


def test_warehouse(spark, tmp_path):
    w = Warehouse(spark)
    w.write(spark.createDataFrame([(1, "a")], "k int, v string"), "silver", "things")
    w.write(spark.createDataFrame([(1, "b"), (2, "c")], "k int, v string"), "silver", "things", "upsert", ["k"])
    assert sorted(map(tuple, w.sql("SELECT * FROM things").collect())) == [(1, "b"), (2, "c")]
    run = open_run(w, "test", "2024-01-01 00:00:00")
    close_run(w, run, "succeeded", "2024-01-01 01:00:00")
    assert latest_run(w).first().status == "succeeded"
    manifest = w.export("silver", f"file://{tmp_path}/out")
    entry = manifest.where("table_name = 'things'").first()
    assert (entry.n_rows, entry.run_id, entry.status) == (2, run, "succeeded")
    w.write(w.load("silver.things").repartition(3), "silver", "things_again")
    again = w.export("silver", f"file://{tmp_path}/again").where("table_name = 'things_again'").first()
    assert again.checksum == entry.checksum != "0"
    assert w.missing_tables(["silver.things", "gold.none", "bronze.ingestion_runs"]) == ["gold.none"]
    assert sorted(r.k for r in w.existing_keys("things", ["k"]).collect()) == [1, 2]
    from tallyforge.sources import load_freshest, save_csv

    save_csv(w.load("silver.things"), f"file://{tmp_path}/csv")
    listed = spark.createDataFrame(
        [("things", "csv", f"file://{tmp_path}/csv", 2), ("things", "json", "nowhere", 1)],
        "dataset string, format string, path string, committed_at int"
    )
    assert sorted(map(tuple, load_freshest(spark, listed, "things").collect())) == [("1", "b"), ("2", "c")]


def test_run_through_the_layers(spark):
    """A run writes every layer, a second one without news does nothing, and a failed check stops the load after its report."""
    from tallyforge import medallion as L
    from tallyforge.plans import game, models
    from tallyforge.plans.registry import Tables

    tables = game.bronze(Tables(spark, "/root/testdata/sf0.001"))
    datasets = [L.Dataset(n, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema), rules=(), references=()) for n, df in tables.items()]
    landed = {n: (df, "v1") for n, df in tables.items()}
    w = Warehouse(spark)
    assert L.run_pipeline(w, landed, datasets, "2024-01-01 00:00:00") == "succeeded"
    assert {t for x, t in w.list_tables() if x == "silver"} >= {m.__name__ for m in models.SILVER}
    assert w.load("gold.ml_features_hybrid").count() == models.build_models(tables)["ml_features_hybrid"].count() > 0
    assert L.run_pipeline(w, landed, datasets, "2024-01-02 00:00:00") == "unchanged"
    bad = L.Dataset("seasons", "version_season string", rules=("duplicate_count(version_season) = 0",))
    rows = spark.createDataFrame([("a", 1), ("a", 2)], "version_season string, more int")
    try:
        L.load_bronze(w, rows, bad, "r1", "2024-01-03 00:00:00")
        raise AssertionError
    except ValueError as e:
        assert "duplicate_count" in str(e)
    assert w.load("bronze.validation_checks").where("run_id = 'r1' AND NOT passed").count() == 1
    assert L.load_bronze(w, rows, bad, "r2", "2024-01-03 00:00:00", strict=False).count() == 2
    newer = {n: (df, "v2" if n == "jury_votes" else "v1") for n, (df, _) in landed.items()}
    before = {n: w.load(f"bronze.{n}").count() for n in tables}
    assert L.run_pipeline(w, newer, datasets, "2024-01-04 00:00:00") == "succeeded"
    assert {n for n in tables if w.load(f"bronze.{n}").count() != before[n]} == {"jury_votes"}  # without keys a load appends


def test_checks_of_references(spark):
    """Nulls are no violations; where a reference allows them they are counted. Orphans and null references go only if there are parents."""
    from tallyforge import medallion as L

    rows = spark.createDataFrame(
        [("1", "a", "s"), ("2", None, "s"), ("3", "x", None), ("4", "x", "s"), ("4", "x", "s")], "id string, person string, season string"
    )
    people, nobody = spark.createDataFrame([("a",)], "person string"), spark.createDataFrame([], "person string")
    strict, lenient = L.Reference(("person",), "people", ("person",)), L.Reference(("person",), "people", ("person",), True)
    data = L.Dataset(
        "d", "id int, person string", references=(strict, lenient, L.Reference(("season",), "seasons", ("season",))),
        rules=("missing_count(person) = 0",)
    )
    for parents, found, n_null in ((people, 3, 1), (nobody, None, None)):
        checks = {(r.check, r.n_null): (r.found, r.passed, r.samples) for r in L.prepared(rows, data, {"people": parents})[1].collect()}
        ok = found is None
        assert checks["person in people", None][:2] == (found, ok) and checks["person in people", n_null] == (found, ok, None if ok else "x")
        assert checks["season in seasons", None] == (None, True, None) and checks["missing_count(person) = 0", None] == (1, False, "2")
    repaired = L.Dataset("d", "id int, person string", ("id",), repairs=(L.drop_orphans(["id"], "person", "people", "person"),), references=(), rules=())
    kept, _, events = L.prepared(rows, repaired, {"people": people})
    assert [tuple(r) for r in kept.collect()] == [(1, "a")]
    assert sorted(
        (r.action, r.row_key, r.before) for r in events.collect() if r.action != "column dropped"
    ) == sorted([("orphan dropped", "2", None), *[("orphan dropped", k, "x") for k in "344"]])
    assert {r.id for r in L.prepared(rows, repaired, {"people": nobody})[0].collect()} == {1, 2, 3, 4}


def test_coercion_audit_and_schema_check(spark):
    """What a cast changes is an event with context; extra columns are noted, missing and unreadable ones are errors; which duplicate stays doesn't depend on how rows are dealt."""
    from tallyforge import medallion as L

    rows = spark.createDataFrame([("1", " yes ", "3.0", 7), ("2", "nope", "x", 8), ("2", "no", "5", 9)], "id string, ok string, n string, more int")
    data = L.Dataset("d", "id int, ok boolean, n int", ("id",), references=(), rules=(), context=("n",))
    wanted = None
    for parts in (1, 2, 3):
        kept, _, events = L.prepared(rows.repartition(parts, "more"), data, {})
        found = sorted(map(tuple, kept.collect())), sorted(
            (r.action, r.row_key, r.column_name, r.before, r.after, r.context) for r in events.collect() if r.row_key
        )
        wanted = wanted or found
        assert found == wanted and [r.before for r in events.where("action = 'column dropped' AND column_name = 'more'").collect()] == ["int"]
    assert wanted[0] == [(1, True, 3), (2, False, 5)]
    assert (
        "value coerced", "1", "ok", " yes ", "true", "n=3.0"
    ) in wanted[1] and ("value coerced", "1", "n", "3.0", "3", "n=3.0") in wanted[1] and ("duplicate dropped", "2", None, None, None, None) in wanted[1]
    for schema, words in (("id int, gone int", "lacks gone"), ("id array<int>", "id is string instead of"), ("more date", "more is int instead of date")):
        try:
            L.prepared(rows, L.Dataset("d", schema), {})
            raise AssertionError
        except ValueError as e:
            assert words in str(e)


def test_load_order_parents_and_refresh(spark):
    """Datasets load after what they refer to; missing parents are added to their table; a refresh replaces rows, but not in prod."""
    from tallyforge import medallion as L

    w = Warehouse(spark)
    held = L.Dataset("o41_items", "item_id string, kind string", ("item_id",), references=(), rules=())
    uses = L.Dataset(
        "o41_uses", "use_id int, item_id string, kind string", ("use_id",),
        parents=(L.Parents("o41_items", ("item_id",), "use_id", ("kind",)),),
        references=(L.Reference(("item_id",), "o41_items", ("item_id",)),), rules=()
    )
    assert [d.name for d in L.load_order([uses, held])] == ["o41_items", "o41_uses"]
    L.load_bronze(w, spark.createDataFrame([("a", "x")], "item_id string, kind string"), held, "r1", "2024-01-01 00:00:00")
    found = L.load_bronze(
        w, spark.createDataFrame([(1, "a", None), (3, "b", "late"), (2, "b", "early")], "use_id int, item_id string, kind string"), uses,
        "r1", "2024-01-01 00:00:00"
    )
    assert found.count() == 3 and sorted((r.item_id, r.kind) for r in w.load("bronze.o41_items").collect()) == [("a", "x"), ("b", "early")]
    assert w.load("bronze.remediation_events").where("action = 'parent added' AND row_key = 'b'").count() == 1
    fewer = spark.createDataFrame([(9, "a", "z")], "use_id int, item_id string, kind string")
    assert L.load_bronze(w, fewer, uses, "r2", "2024-01-02 00:00:00", mode="refresh", environment="prod").count() == 4
    assert L.load_bronze(w, fewer, uses, "r3", "2024-01-03 00:00:00", mode="refresh").count() == 1


def test_streamed_upserts_are_the_same_each_time(spark, tmp_path):
    from tallyforge.streaming import upsert_landed

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"k": 1, "at": 2, "v": "late"}\n{"k": 1, "at": 1, "v": "z"}\n{"k": 1, "at": 1, "v": "b"}\n{"k": 2, "at": 1, "v": "c"}\n'
    )
    schema = spark.createDataFrame([], "k int, at int, v string").schema
    for n in (1, 2):
        upsert_landed(
            spark, f"file://{tmp_path}/in", schema, "silver", f"streamed{n}", ["k"], f"file://{tmp_path}/check{n}", order=["at"]
        ).awaitTermination(120)
        assert sorted((r.k, r.v) for r in Warehouse(spark).load(f"silver.streamed{n}").collect()) == [(1, "b"), (2, "c")]


def test_pairing_rounds_and_bounds(spark):
    """Ties go to the first, nulls are equal, rows beyond the bound and in new blocks have no partner, also null blocks; copies are looked at once."""
    columns = ["a", "b", "c"]
    before = spark.createDataFrame(
        [("x", 1, "p", None, 1), ("x", 2, "p", None, 1), ("x", 3, "q", "r", 2), (None, 1, "p", "p", 3)],
        "blk string, n int, a string, b string, c int"
    )
    after = spark.createDataFrame(
        [("x", 1, "p", None, 1), ("x", 2, "q", None, 2), ("x", 3, "z", "z", 9), ("y", 1, "p", None, 1), (None, 1, "p", "q", 3)],
        "blk string, n int, a string, b string, c int"
    )
    every = {(r.blk, r.after_n): (r.before_n, r.n_changed, r.changed) for r in O.pair_rows(before, after, ["blk"], columns, "n").collect()}
    assert every == {("x", 1): (1, 0, []), ("x", 2): (3, 1, ["b"]), ("x", 3): (1, 3, columns), ("y", 1): (None, None, None), (None, 1): (1, 1, ["b"])}
    near = {(r.blk, r.after_n): r.before_n for r in O.pair_rows(before, after, ["blk"], columns, "n", max_changed=1).collect()}
    assert near == {("x", 1): 1, ("x", 2): 3, ("x", 3): None, ("y", 1): None, (None, 1): 1}
    states = sorted(
        (r.state, r.column_name, r.before, r.after) for r in O.row_changes(
            before, after, ["blk"], columns, "n", max_changed=1
        ).where("blk = 'x'").collect()
    )
    assert [x for x in states if x[0] == "result"] == [("result", "b", "r", None)] and sum(x[0] == "added" for x in states) == 3 and sum(x[0] == "removed" for x in states) == 3


def test_pairing_of_a_large_block_is_linear(spark):
    """100,000 rows of one block, most changed in a cell: every row meets few others."""
    cells = F.expr("named_struct('id', id, 'k', cast(id % 50000 as string), 'v', cast(id * 7 % 100003 as string), 'w', cast(id % 3 as string))")
    before = spark.range(100_000).select(F.lit("one").alias("blk"), cells.alias("s")).select("blk", "s.*")
    after = before.withColumn(
        "v", F.when(F.col("id") % 4 == 0, "new").otherwise(F.col("v"))
    ).withColumn("w", F.when(F.col("id") % 4 == 1, "x").otherwise(F.col("w")))
    found = O.pair_rows(before, after, ["blk"], ["k", "v", "w"], "id", max_changed=1)
    assert found.count() == 100_000 and found.where("before_id = after_id").count() > 99_000 and found.where("n_changed > 1").count() == 0


def test_pairing_of_small_blocks_shuffles_each_side_once(spark, monkeypatch):
    """Blocks of few rows are compared whole, with no round and no table but the list of large blocks; by rounds they give the same, also mixed and with null blocks."""
    from tallyforge.operators import pairing

    block = F.when(F.col("id") % 10 > 0, F.when(F.col("id") < 60, F.lit("big")).otherwise((F.col("id") % 7).cast("string")))
    before = spark.range(120).select(block.alias("blk"), "id", (F.col("id") % 9).alias("a"), F.when(F.col("id") % 4 > 0, F.col("id") % 5).alias("b"), (F.col("id") % 3).cast("string").alias("c"))
    after = before.where("id % 8 <> 3").selectExpr("blk", "id + 1000 AS id", "CASE WHEN id % 3 = 0 THEN 99 ELSE a END AS a", "CASE WHEN id % 5 > 1 THEN b END AS b", "CASE WHEN id % 6 = 0 THEN 'x' ELSE c END AS c")
    after = after.unionByName(spark.createDataFrame([("new", 1, 1, 1, "x"), (None, 2, 77, 77, "y")], after.schema))
    names, write = [], pairing.staged
    monkeypatch.setattr(pairing, "staged", lambda df, name: names.append(name) or write(df, name))
    found = {}
    for few in (64, 15, 0):
        monkeypatch.setattr(pairing, "FEW", few, raising=False)
        for most in (None, 1):
            names.clear()
            found[few, most] = sorted(map(repr, O.pair_rows(before, after, ["blk"], ["a", "b", "c"], "id", max_changed=most).collect()))
            assert names == ["large"] if few == 64 else "paired" in names
            found[few, most] += sorted(map(repr, O.row_changes(before, after, ["blk"], ["a", "b", "c"], "id", max_changed=most).collect()))
    assert all(found[few, most] == found[64, most] for few in (15, 0) for most in (None, 1)) and found[64, None] != found[64, 1]


def test_results_are_counted_by_type_once(spark):
    """Totals are sums of the counts by type: one pass over the results, and a payload is parsed once for all its paths."""
    from tallyforge.plans import QUERIES, legacy

    results = spark.createDataFrame(
        [("a", "s", "k1", "R", True, False), ("a", "s", "k2", "r", True, True), ("a", "s", "k3", "A", False, None), ("a", "s", "k4", "R", None, True), ("b", "s", "k4", "N", False, False), ("b", "s", None, "R", True, True)],
        "castaway_key string, season_key string, challenge_key string, result string, chosen_for_reward boolean, sit_out boolean"
    )
    challenges = spark.createDataFrame([("k1", "B#12"), ("k2", "B#23"), ("k3", "B#23"), ("k4", None)], "challenge_key string, challenge_type string")
    found = {r.castaway_key: r[2:] for r in legacy.challenge_parts(results, challenges).collect()}
    assert found == {"a": (3, 1, 1, 2, 2, {"B#12": 1, "B#23": 1, "unknown": 1}), "b": (0, 0, 0, 0, 0, {"unknown": 0})}
    for name in ("person_payload_paths", "episode_payload_paths"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == 1 and "get_json_object" not in plan


def test_baseline_reads_a_written_matrix(spark):
    """The split, the fit and the held-out rows read one table; none of them makes the matrix again."""
    from tallyforge.plans import QUERIES

    df = QUERIES["train_baseline"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "return_share" in plan and "l_returnflag" not in plan and 0 < sum(r.n for r in df.collect()) < spark.read.parquet("/root/testdata/sf0.001/customer.parquet").count()


def test_profiles_join_the_matrix_last(spark):
    """A person with several profiles has a row for each: no join, sort or shuffle comes after that."""
    from tallyforge.plans import QUERIES

    for name in ("model_ml_features_non_edit", "model_ml_features_hybrid"):
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        last = next(line for line in plan.splitlines() if "Join " in line)
        assert "LeftOuter" in last and "castaway_id" in last and "version_season" not in last


def test_star_keys_are_stable(spark):
    """A second run with changed and late rows keeps every key; late members are filled in, and facts find them."""
    d = O.Dimension("dim", "key", ("id",), {"label": "name"})
    first = O.keep_dimension(None, O.dimension_rows(spark.createDataFrame([("a", "A"), ("b", "B"), ("b", "C"), (None, "N")], "id string, name string"), d), d)
    keys = {r.id: r.key for r in first.collect()}
    assert {r.id: r.label for r in first.collect()} == {"a": "A", "b": "B"}
    facts = spark.createDataFrame([("a", 1), ("z", 2), (None, 3)], "who string, n int")
    late = O.with_late_members(first, facts, d, ("who",))
    assert {(r.id, r.label, r.is_late) for r in late.collect()} == {("a", "A", False), ("b", "B", False), ("z", None, True)}
    second = O.keep_dimension(late, O.dimension_rows(spark.createDataFrame([("a", "A2"), ("z", "Z")], "id string, name string"), d), d)
    assert {r.id: (r.label, r.is_late) for r in second.collect()} == {"a": ("A2", False), "b": ("B", False), "z": ("Z", False)}
    again = {r.id: r.key for r in second.collect()}
    assert all(again[i] == k for i, k in keys.items()) and again["z"] == {r.id: r.key for r in late.collect()}["z"]
    for required, wanted in ((False, {(again["a"], 1), (again["z"], 2), (None, 3)}), (True, {(again["a"], 1), (again["z"], 2)})):
        found = O.fact_rows(facts, [O.Lookup("dim", ("who",), "who_key", required)], {"dim": (d, second)}, {"n": "n"})
        assert set(map(tuple, found.collect())) == wanted


def test_events_are_told_once(spark, tmp_path):
    from tallyforge import snapshots as S

    path = f"file://{tmp_path}/seen"
    event = lambda *keys: spark.createDataFrame([(k, f"about {k}") for k in keys], "event_key string, message string")
    told = lambda df: sorted(r.event_key for r in df.collect())
    assert told(S.record_events(event("a", "b", "b"), path, "r1")) == ["a", "b"]
    for _ in range(2):
        assert told(S.record_events(event("b", "c"), path, "r2")) == ["c"]
    assert told(S.record_events(event("a", "c"), path, "r3")) == [] and spark.read.parquet(path).count() == 3


def test_snapshots_stand_side_by_side(spark, tmp_path):
    from tallyforge import snapshots as S

    path, runs = f"file://{tmp_path}/features", spark.createDataFrame(
        [("r1", "dev", 1), ("r2", "prod", 2)], "run_id string, environment string, run_started_at int"
    )
    one, none = S.snapshot_row(runs), S.snapshot_row(runs.where("false"), environment="local")
    assert one.first().ingest_run_id == "r2" and none.first().environment == "local" and none.first().ingest_run_id is None
    for df, id in ((spark.range(3), "s1"), (spark.range(5), one), (spark.range(4), one)):
        S.write_snapshot(df, path, id)
    taken = spark.createDataFrame(
        [("s1", "2024-01-01"), (one.first().snapshot_id, "2024-02-01")], "snapshot_id string, at string"
    ).select("snapshot_id", F.to_timestamp("at").alias("taken_at"))
    assert S.read_snapshot(spark, path, taken).count() == 4 and S.read_snapshot(spark, path, taken, at="2024-01-15").count() == 3
    assert S.read_snapshot(spark, path, taken, at="2023-01-15").count() == 0


def test_name_similarity_is_by_matching_blocks(spark):
    """The same share as the standard library's matcher gives, on names of a few letters, and never above the bound by letters."""
    import random
    from difflib import SequenceMatcher

    rnd = random.Random(1)
    names = ["".join(rnd.choice("abcé ") for _ in range(rnd.randrange(9))) for _ in range(400)]
    df = spark.createDataFrame(list(zip(names, reversed(names))), "a string, b string")
    for r in df.select("a", "b", T.name_similarity(F.col("a"), F.col("b")).alias("s"), T.letters_in_common(F.col("a"), F.col("b")).alias("n")).collect():
        assert abs(r.s - SequenceMatcher(None, r.b, r.a).ratio()) < 1e-12, (r.a, r.b)
        assert 2 * r.n >= r.s * (len(r.a) + len(r.b)) - 1e-9


def test_ids_of_the_query(spark):
    """Every edited name of the query finds its own supplier, or one with the same plain name."""
    from tallyforge import plans

    found = plans.QUERIES["resolve_ids"](spark, "/root/testdata/sf0.001").collect()
    by = {r.s_suppkey: r for r in found}
    assert all(r.resolved_by == ("plain" if r.s_suppkey % 4 == 0 else "similar" if r.s_suppkey % 4 == 1 else r.resolved_by) for r in found)
    assert sum(r.id == r.s_suppkey for r in found) == len(by)


def test_load_of_all_datasets(spark):
    """Nineteen landed datasets, in a bad order, into bronze: types by rule, repairs, missing parents, duplicates, events and checks."""
    import random
    import uuid

    from tallyforge import datasets as D
    from tallyforge import medallion as L

    mark = uuid.uuid4().hex[:6]
    people = [(f"p{i}", f"Name {i}", "yes" if i % 2 else "0") for i in range(6)]
    person = lambda *more: [(f"p{i}", "US37", *more) for i in range(6)]
    landed = {
        "castaway_details": (people, "castaway_id string, full_name string, bipoc string"),
        "season_summary": ([("US37", "37", "2018-09-26")], "version_season string, season string, premiered string"),
        "castaways": (
            [*[(f"p{i}", "US37", f"Ann{chr(97 + i) * 3}", str(i)) for i in range(6)], ("p9", "US37", "Nobody", "9")],
            "castaway_id string, version_season string, castaway string, `Order` string"
        ),
        "challenge_description": (
            [("US37", "25", "Immunity", "true"), ("US37", "7", "Reward", "no")],
            "version_season string, challenge_id string, challenge_type string, race string"
        ),
        "challenge_summary": ([("US37", "8", "x"), ("US37", "8", "x"), ("US37", "25", "y")], "version_season string, challenge_id string, category string"),
        "challenge_results": (person("8", "1") + person("25", "2"), "castaway_id string, version_season string, challenge_id string, sog_id string"),
        "vote_history": (
            [("p1", "US37", "3", "26", "p2", "p2"), ("none", "US37", "3", "99", None, "p2"), ("p3", "US37", "4", None, "p2", "p2")],
            "castaway_id string, version_season string, episode string, challenge_id string, vote_id string, voted_out_id string"
        ),
        "journeys": (
            [(None, "US37", "2", "1", "Annbbb"), ("p2", "US37", "2", "1", "Annccc")],
            "castaway_id string, version_season string, episode string, sog_id string, castaway string"
        ),
        "advantage_movement": (
            [("p1, p2", "US37", "5", "1", "p3, p77"), ("p4", "US37", "5", "2", None)],
            "castaway_id string, version_season string, advantage_id string, sequence_id string, played_for_id string"
        ),
        "advantage_details": ([("5", "US37")], "advantage_id string, version_season string"),
        "auction_details": (
            [("US37", "1", "pie", " p1 "), ("US37", "1", "pie", "nan")],
            "version_season string, auction_num string, item string, castaway_id string"
        ),
        "boot_mapping": (person("1", "3"), "castaway_id string, version_season string, sog_id string, `order` string"),
        "boot_order": (person("1"), "castaway_id string, version_season string, `order` string"),
        "episodes": ([("US37", "1"), ("US37", "1"), ("US37", "2")], "version_season string, episode string"),
        "confessionals": (person("1", "4"), "castaway_id string, version_season string, episode string, confessional_count string"),
        "jury_votes": (person("Annaaa", "p0"), "castaway_id string, version_season string, vote string, finalist_id string"),
        "survivor_auction": (person("5", "20"), "castaway_id string, version_season string, episode string, total string"),
        "tribe_mapping": (person("1", "red", None), "castaway_id string, version_season string, episode string, tribe string, day string"),
        "castaway_scores": (person("0.5") + person("0.5"), "castaway_id string, version_season string, score_overall string"),
    }
    assert set(landed) == set(D.KEYS)
    frames = {n: spark.createDataFrame(rows, schema) for n, (rows, schema) in landed.items()}
    w = Warehouse(spark)
    for x, t in w.list_tables():
        spark.sql(f"DROP TABLE {x}.{t}")
    names = list(frames)
    random.Random(3).shuffle(names)
    configured = [D.dataset_of(n, frames[n]) for n in names]
    order = [d.name for d in L.load_order(configured)]
    assert order.index("castaway_details") < order.index("castaways") < order.index("journeys") and order.index("challenge_summary") < order.index("challenge_results")
    assert L.run_pipeline(w, {n: (df, mark) for n, df in frames.items()}, configured, "2024-01-01 00:00:00", upto="bronze", strict=False) == "succeeded"
    count = lambda n: w.load(f"bronze.{n}").count()
    wanted = {
        "castaway_details": 6, "castaways": 6, "challenge_description": 3, "challenge_summary": 3, "challenge_results": 12,
        "vote_history": 3, "journeys": 2, "advantage_movement": 5, "episodes": 2, "castaway_scores": 6, "auction_details": 2,
        "tribe_mapping": 6
    }
    assert {n: count(n) for n in wanted} == wanted
    votes = {(r.castaway_id, r.challenge_id) for r in w.load("bronze.vote_history").collect()}
    assert votes == {("p1", 25), (None, None), ("p3", None)}
    assert {r.castaway_id for r in w.load("bronze.journeys").collect()} == {"p1", "p2"}
    plays = {(r.castaway_id, r.played_for_id, r.joint_play, r.multi_target_play) for r in w.load("bronze.advantage_movement").collect()}
    assert plays == {("p1", "p3", True, True), ("p1", None, True, True), ("p2", "p3", True, True), ("p2", None, True, True), ("p4", None, False, False)}
    kinds = dict(w.load("bronze.castaway_details").dtypes) | dict(w.load("bronze.season_summary").dtypes) | dict(w.load("bronze.challenge_description").dtypes)
    assert (kinds["bipoc"], kinds["premiered"], kinds["race"], kinds["challenge_id"]) == ("boolean", "date", "boolean", "int")
    actions = {
        (r.dataset, r.action): r.n for r in w.load("bronze.remediation_events").where("action <> 'value coerced'").groupBy("dataset", "action").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert actions["castaways", "orphan dropped"] == 1 and actions["vote_history", "null kept"] == 1 and actions["vote_history", "reference fixed"] == 1 and actions["vote_history", "reference nulled"] == 1
    assert actions["journeys", "id filled in"] == 1 and actions["challenge_description", "parent added"] == 1 and actions["challenge_summary", "duplicate kept"] == 2 and actions["castaway_scores", "duplicate dropped"] == 6


def _most_in_a_partition(df):
    """Rows of the fullest partition, joins and windows shuffled as planned."""
    spark = df.sparkSession
    names = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        whole = F.max(F.to_json(F.struct(*df.columns)))  # so that no column is pruned, nor a join that only it needs
        return df.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), whole.alias("row")).agg(F.max("n"), F.max("row")).first()[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_rows_without_a_key_are_dealt_to_all_tasks(spark):
    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("who"))
    people = spark.range(0, 4000, 8).select(F.col("id").cast("string").alias("known"), F.lit("x").alias("kind"))
    met = O.left_lookup(rows, people, ["who"], ["known"])
    assert met.columns == ["id", "who", "known", "kind"]
    assert met.where("kind = 'x'").count() == 500 and met.count() == 4000 and met.where("known <> who").isEmpty()
    assert O.left_lookup(rows, people.withColumn("known", F.col("known").cast("int")), ["who"], ["known"]).where("kind = 'x'").count() == 500
    assert _most_in_a_partition(met) < 1000
    assert _most_in_a_partition(O.null_invalid(rows, "who", people, "known")[0]) < 1000


def test_loads_deal_rows_without_a_key_to_all_tasks(spark, monkeypatch):
    from tallyforge import medallion as L

    monkeypatch.setattr(L, "staged", lambda df, name: df)
    rows = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("who"))
    people = spark.range(0, 4000, 4).select(F.col("id").cast("string").alias("who"))
    data = L.Dataset("d", "id long, who string", ("who",), ("id",), ("who",), repairs=(L.null_references(["id"], "who", "people", "who"),))
    found = L.marked(rows, data, {"people": people})
    assert found.where("_gone").isEmpty() and found.count() == 4000
    assert _most_in_a_partition(found) < 1000


def test_facts_do_not_travel_to_dimensions_of_few_rows(spark):
    few, many = O.Dimension("few", "few_key", ("season",), few=True), O.Dimension("many", "many_key", ("who",))
    facts = spark.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.col("id")).alias("who"), (F.col("id") % 3).alias("season"))
    dimensions = {
        "few": (few, O.dimension_rows(spark.range(2).withColumnRenamed("id", "season"), few)),
        "many": (many, O.dimension_rows(spark.range(0, 4000, 8).withColumnRenamed("id", "who"), many))
    }
    lookups = [O.Lookup("many", ("who",), "who_key"), O.Lookup("few", ("season",), "season_key", True)]
    found = O.fact_rows(facts, lookups, dimensions, {"id": "id"})
    assert found.columns == ["who_key", "season_key", "id"]
    assert found.count() == 2667 and found.where("who_key IS NOT NULL").count() == 333 and found.where("season_key IS NULL").isEmpty()
    assert _most_in_a_partition(found) < 700
