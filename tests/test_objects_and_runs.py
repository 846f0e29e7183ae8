import random
from datetime import date, datetime

import pytest
from helpers import as_set
from pyspark.sql import functions as F

from tidemill.operators import checks, keyed, objects, rows, runs
from tidemill.sources import files


def listing(spark, *keys):
    return spark.createDataFrame([("b", k, len(k)) for k in keys], "bucket string, key string, size long")


def test_one_level(spark):
    found = objects.level_listing(listing(spark, "data/a.csv", "data/sub/x", "data/sub/y", "data/b.csv", "else"), "b", "data/")
    assert [tuple(r) for r in found.collect()] == [("data/sub/", None, True), ("data/a.csv", 10, False), ("data/b.csv", 10, False)]


def test_limit_scopes(spark):
    names = listing(spark, "p/x", "q/x", "c", "d")
    assert objects.level_listing(names, "b", limit=1).count() == 3
    assert [r.key for r in objects.level_listing(names, "b", limit=1, limit_scope="all").collect()] == ["p/"]


def test_overlaps(spark):
    moves = [("a/", "a/archive/"), ("a/b.csv", "a/b.csv"), ("a", "ab/c"), ("", "z")]
    for number, (source, target) in enumerate(moves):
        left = listing(spark, source)
        right = spark.createDataFrame([("b", target, number)], "bucket string, key string, id int")
        expected = [] if (source, target) == ("a", "ab/c") else [("b", source, target, number)]
        assert [tuple(r) for r in objects.prefix_overlap(left, right, "id").collect()] == expected


def test_other_bucket_is_no_overlap(spark):
    right = spark.createDataFrame([("other", "a/x", 1)], "bucket string, key string, id int")
    assert objects.prefix_overlap(listing(spark, "a/"), right, "id").isEmpty()


def test_sync_by_size(spark):
    source = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3), ("n", None)], "relative string, size long")
    target = spark.createDataFrame([("base/x", 1), ("base/y", 9), ("base/extra", 1), ("base/n", None)], "key string, size long")
    assert as_set(objects.sync_diff(source, target, "base/").select("relative")) == {("y",), ("z",)}


def test_delete_batches(spark):
    names = spark.range(25).select(F.lit("b").alias("bucket"), F.format_string("%03d", "id").alias("key"))
    sizes = objects.delete_batches(names, size=10).groupBy("batch").count()
    assert as_set(sizes) == {(0, 10), (1, 10), (2, 5)}


def test_copy_and_move(spark, tmp_path):
    (tmp_path / "a.txt").write_text("hello")
    uris = [(f"file://{tmp_path}/a.txt", f"file://{tmp_path}/to/a.txt"), (f"file://{tmp_path}/none", f"file://{tmp_path}/to/b")]
    plan = spark.createDataFrame(uris, "source_uri string, target_uri string")
    for _ in range(2):
        errors = [r.error for r in objects.apply_copy_plan(plan, delete_source=True).orderBy("source_uri").collect()]
        assert errors[0] is None and errors[1]
    assert (tmp_path / "to" / "a.txt").read_text() == "hello" and not (tmp_path / "a.txt").exists()


def test_head(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes("é1\r\n2\n3\n4".encode() + b"\xff")
    text = files.object_head(spark, str(tmp_path), lines=3).first().head
    assert text == "é1\n2\n3"
    content = spark.range(1).select(F.lit(bytearray("aé".encode())).alias("c"))
    assert content.select(files.cat_text(F.col("c"), 2)).first()[0] == "a�"
    assert content.select(files.head_text(F.lit(bytearray(b"a\nb\n")), 5)).first()[0] == "a\nb"


def test_inventory(spark, tmp_path):
    (tmp_path / "p").mkdir()
    (tmp_path / "p" / "1").write_text("12345")
    row = files.file_inventory(spark, f"file://{tmp_path}").first()
    assert (row.key, row.size) == ("p/1", 5)


def history(spark, *entries):
    return spark.createDataFrame(list(entries), "dag_id string, run_id int, logical_date date, state string")


def test_backfill(spark):
    past = history(
        spark, ("d", 1, date(2026, 1, 1), "success"), ("d", 2, date(2026, 1, 2), "success"), ("d", 3, date(2026, 1, 2), "failed"),
        ("d", 4, date(2026, 1, 4), "running"),
    )

    def planned(how, **more):
        rows = runs.backfill_plan(past, date(2026, 1, 1), date(2026, 1, 5), how, max_active=2, **more)
        return [(r.logical_date.day, r.wave) for r in rows.orderBy("wave", "logical_date").collect()]

    assert planned("none") == [(3, 0), (5, 0)]
    assert planned("failed") == [(2, 0), (3, 0), (5, 1)]
    assert planned("completed", backwards=True) == [(3, 0), (5, 0), (1, 1), (2, 1)]
    with pytest.raises(ValueError):
        planned("all")


def graph(spark):
    tasks = spark.createDataFrame(
        [("start", ["left", "right"]), ("left", ["join"]), ("right", ["join", "left"]), ("join", ["end"]), ("end", [])],
        "task_id string, downstream_task_ids array<string>",
    )
    return tasks, runs.edges_of(tasks)


def test_outline(spark):
    tasks, edges = graph(spark)
    nodes = tasks.select(F.col("task_id").alias("node"))
    first = runs.roots(nodes, edges).withColumn("place", F.lit(0))
    lines = runs.tree_expand(edges, first).join(edges.select(F.col("parent").alias("node")).distinct().withColumn("p", F.lit(True)), "node", "left")
    text = lines.orderBy("path").select(
        runs.tree_line(F.col("depth"), F.col("node"), F.col("expanded"), F.coalesce("p", F.lit(False)))
    )
    assert [r[0] for r in text.collect()] == [
        "start", "  left", "    join", "      end", "  right", "    join …", "    left …",
    ]


def test_cycles_end(spark):
    edges = spark.createDataFrame(
        [("a", "u", 1), ("u", "w", 0), ("w", "u", 0), ("u", "v", 1), ("v", "a", 0)], "parent string, child string, place int"
    )
    start = spark.createDataFrame([("a", 0)], "node string, place int")
    assert as_set(runs.closure(edges, start)) == {("a", 0), ("u", 1), ("w", 2), ("v", 2)}
    lines = runs.tree_expand(edges, start).orderBy("path").collect()
    assert [(r.node, r.depth, r.expanded) for r in lines] == [
        ("a", 0, True), ("u", 1, True), ("w", 2, True), ("u", 3, False), ("v", 2, True), ("a", 3, False),
    ]


def test_a_chain_is_followed_to_its_end(spark):
    edges = spark.createDataFrame([(f"n{i}", f"n{i + 1}", 0) for i in range(40)], "parent string, child string, place int")
    start = spark.createDataFrame([("n0", 0)], "node string, place int")
    assert as_set(runs.closure(edges, start)) == {(f"n{i}", i) for i in range(41)}
    assert runs.tree_expand(edges, start).agg({"depth": "max"}).first()[0] == 40


def test_clear(spark):
    _, edges = graph(spark)
    days = [datetime(2026, 1, d) for d in (1, 2)]
    instances = spark.createDataFrame(
        [(t, s, d) for t in ("start", "left", "right", "join", "end") for s, d in zip(("failed", "success"), days)],
        "task_id string, state string, logical_date timestamp",
    )
    seeds = spark.createDataFrame([("join",)], "node string")

    def chosen(**options):
        return as_set(runs.clear_selection(instances, edges, seeds, **options).select("task_id", "state"))

    assert chosen() == {("join", "failed"), ("join", "success")}
    assert chosen(downstream=True, states=["failed"]) == {("join", "failed"), ("end", "failed")}
    assert chosen(upstream=True, start=days[1]) == {(t, "success") for t in ("start", "left", "right", "join")}


def test_run_order_keys(spark):
    past = history(spark, ("d", 1, date(2026, 1, 1), "x"), ("d", 2, date(2026, 1, 2), "x"), ("d", 3, date(2026, 1, 2), "x"))
    assert [r.run_id for r in runs.run_order(past, ["-logical_date", "run_id"], 2).collect()] == [2, 3]


def test_datagen_profile(spark):
    generated = files.datagen(spark, 1, 100, 4)
    profile = keyed.table_profile(generated, "id", "source")
    expected = {"count": 100, "min_key": 1, "max_key": 100, "text": "datagen"}
    verdict = {r.check: r.passed for r in keyed.profile_verdict(profile, expected).collect()}
    assert all(verdict.values()) and len(verdict) == 9
    worse = {r.check: r.passed for r in keyed.profile_verdict(profile, {**expected, "count": 99}).collect()}
    assert not worse["row_count"] and not worse["all"] and worse["min_key"]
    assert generated.filter(F.length("payload") != 4).isEmpty()


def test_empty_profile_fails_quietly(spark):
    profile = keyed.table_profile(files.datagen(spark, 1, 0, 4), "id", "source")
    assert profile.first().row_count == 0
    assert not keyed.profile_verdict(profile, {"count": 0, "min_key": 1, "max_key": 1, "text": "x"}).filter("check = 'all'").first().passed


def test_schema_match_is_positional(spark):
    actual = spark.createDataFrame([], "a int, b string")
    same = keyed.schema_rows(spark.createDataFrame([], "a int, b string")).withColumn("type", F.upper("type"))
    swapped = keyed.schema_rows(spark.createDataFrame([], "b string, a int"))
    assert keyed.schema_match(actual, same).filter("NOT matches").isEmpty()
    assert keyed.schema_match(actual, swapped).filter("NOT matches").count() == 2


def test_rows_as_text(spark):
    df = spark.createDataFrame([(1, None, ["x"], 'a"b')], "n int, m string, l array<string>, t string")
    assert rows.rows_to_csv(df).first()[0] == '1,,"[""x""]","a""b"'
    assert rows.rows_to_json(df).first()[0] == '{"n":1,"m":null,"l":["x"],"t":"a\\"b"}'


def test_id_regex_without_match(spark):
    names = spark.createDataFrame([("load_a",)], "task_id string")
    assert rows.id_regex(names, "task_id", "ad_").count() == 1
    none = rows.id_regex(names, "task_id", "^x")
    with pytest.raises(Exception, match="no task_id matches"):
        none.collect()


def test_checks_never_stop(spark):
    good = spark.createDataFrame([(n,) for n in range(30)], "id int")
    result = checks.run_checks(
        spark,
        {
            "empty": lambda: good.filter("id = 99"), "bad": lambda: good, "broken": lambda: good.select("nope"),
            "failing": lambda: good.select(F.raise_error(F.lit("while it runs")).alias("x")),
        },
    )
    found = {r.check: (r.passed, r.violations, r.error is not None) for r in result.report.collect()}
    assert found == {"empty": (True, 0, False), "bad": (False, 30, False), "broken": (False, 0, True), "failing": (False, 0, True)}
    assert {tuple(r) for r in result.evidence.collect()} == {("bad", f'{{"id":{n}}}') for n in range(30)}
    only = checks.run_checks(spark, {"broken": lambda: good.select("nope")})
    assert only.report.columns == result.report.columns and "nope" in only.report.first().error
    assert checks.run_checks(spark, {}).report.count() == 0


def test_manifest_needs_a_source(spark):
    entries = spark.createDataFrame([("a.sql", "sql", "ok", "x")], "file string, language string, status string, sha256 string")
    files = spark.createDataFrame([("a.sql", "t")], "file string, text string")
    found = checks.manifest_check(entries, files, files.limit(0), 1, "sql")
    assert ("sources", "no source document was kept") in {tuple(r) for r in found.collect()}
    assert "sources" not in {r.subject for r in checks.manifest_check(entries, files, files, 1, "sql").collect()}


def test_cells(spark):
    nested = "struct<flag: boolean, gone: string, list: array<double>, map: map<string, int>>"
    rows_ = [(True, (False, None, [1.5, None], {"k": 1}), 'say "hi"\n'), (None, None, None)]
    frame = spark.createDataFrame(rows_, f"b boolean, n {nested}, t string")
    cells = [tuple(r) for r in frame.select(*[rows.cell_text(frame, c).alias(c) for c in frame.columns]).collect()]
    assert cells[0] == ("True", '{"flag": false, "gone": null, "list": [1.5, null], "map": {"k": 1}}', 'say "hi"\n')
    assert cells[1] == ("", "", "")
    texts = spark.createDataFrame([(['a"b\\', None],)], "l array<string>")
    assert texts.select(rows.cell_text(texts, "l")).first()[0] == '["a\\"b\\\\", null]'


def test_fields(spark):
    frame = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rows.select_fields(frame, " b , a").columns == ["b", "a"]
    for wrong in ("a,c", "", []):
        with pytest.raises(ValueError):
            rows.select_fields(frame, wrong)


def plain_closure(edges, seeds):
    distance, newest, far = {}, set(seeds), 0
    while newest:
        distance.update(dict.fromkeys(newest, far))
        newest, far = {b for a, b in edges if a in newest} - set(distance), far + 1
    return set(distance.items())


@pytest.mark.parametrize("seed", range(4))
def test_contracted_closure_against_a_walk(spark, seed):
    draw = random.Random(seed)
    n = 60
    edges = [(i, draw.randrange(max(1, i - 3), i) if i > 1 else 0) for i in range(1, n)]  # a deep tree, seen from its leaves and from its root
    edges = [(b, a) for a, b in edges] + [(draw.randrange(n), draw.randrange(n)) for _ in range(seed * 6)]
    edges += [(100 + i, 100 + (i + 1) % 7) for i in range(7)] + [(200, 201), (201, 202), (3, 3)]  # a circle that nothing enters, a way of its own
    if seed % 2:
        edges += [(5, 100), (41, 103)]
    frame = spark.createDataFrame(edges, "parent int, child int")
    seeds = [0, 200, 500] if seed else [104, 0]
    for direction, pairs in (("downstream", edges), ("upstream", [(b, a) for a, b in edges])):
        got = runs.closure(frame, spark.createDataFrame([(s,) for s in seeds], "node int"), direction, plain_rounds=seed % 3)
        assert as_set(got) == plain_closure(pairs, seeds) and got.count() == len(as_set(got))


def test_a_long_chain_ends_in_few_rounds(spark, monkeypatch):
    rounds = []
    counted = runs.materialize_counted

    def count(*given):
        rounds.append(1)
        return counted(*given)

    monkeypatch.setattr(runs, "materialize_counted", count)
    chain = spark.range(10_000).select(F.col("id").alias("parent"), (F.col("id") + 1).alias("child"))
    found = runs.closure(chain, spark.createDataFrame([(0,)], "node bigint"))
    assert found.agg(F.count(F.lit(1)), F.sum(F.abs(F.col("node") - F.col("distance"))), F.max("distance")).first() == (10_001, 0, 10_000)
    assert len(rounds) <= runs.PLAIN_ROUNDS + 17
