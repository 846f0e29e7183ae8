"""Boards and charts made for these tests: a weather station's board in every query language that the rules can reach, a shop's charts."""

import json

import pytest

from tidemill.operators import corpus

SOURCES = {"p": "prometheus", "k": "Loki", "t": "grafana-tempo", "i": "influxdb", "g": "graphite", "m": "mysql"}
# (reference, datasource, members, language, text)
TARGETS = [
    ("rain", "m", {"rawSQL": " select mm from rain where site = '${site:csv}' ; "}, "sql", "-- Dashboard=Station;\n-- Panel=Sky, all of it;\n-- RefId=rain;\nselect mm from rain where site = '${site:csv}' ;\n"),
    ("wind", "p", {"expr": "\nwind_speed{site=~\"$site\"}"}, "promql", "wind_speed{site=~\"$site\"}\n"),
    ("fog", "k", {"expr": '{job="fog"} |= "thick"'}, "logql", '{job="fog"} |= "thick"\n'),
    ("trip", "t", {"expr": "{ .span = 1 }"}, "traceql", "{ .span = 1 }\n"),
    ("sun", "i", {"query": "from(bucket: \"sun\")", "queryType": "flux"}, "flux", "from(bucket: \"sun\")\n"),
    ("snow", "i", {"query": "SELECT mean(cm) FROM snow"}, "flux", "SELECT mean(cm) FROM snow\n"),
    ("hail", "g", {"target": "alias(hail.size, 'x')", "query": " "}, "graphite", "alias(hail.size, 'x')\n"),
    ("ice", "g", {"query": "sumSeries(ice.*)", "target": "unused"}, "graphite", "sumSeries(ice.*)\n"),
    ("sum", "p", {"type": "math", "expression": "$wind + 1", "apiKey": "k"}, "grafana-expression", None),
    ("odd", "p", {"model": {"deep": [{"Password": "k", "left": 1}]}}, "unknown", None),
]


def boards(spark, *documents):
    return spark.createDataFrame([(f"b{i}", json.dumps(d)) for i, d in enumerate(documents)], "board string, doc string")


def entries_of(spark, *documents, **settings):
    sources = spark.createDataFrame(list(SOURCES.items()), "uid string, type string")
    targets = corpus.number_targets(corpus.flatten_panels(boards(spark, *documents), **settings))
    return corpus.corpus_entries(corpus.inherit_datasource(targets, sources))


@pytest.fixture(scope="module")
def entries(spark):
    listed = [{"refId": r, "datasource": d if i % 2 else {"uid": d}, **m} for i, (r, d, m, _, _) in enumerate(TARGETS)]
    panel = {"id": 40, "title": "Sky; all of it", "targets": listed}
    return entries_of(spark, {"spec": {"title": "Station", "panels": [panel]}}).cache()


def test_every_language(entries):
    rows = {r.ref_id: r for r in entries.collect()}
    for reference, _, _, language, text in TARGETS:
        assert rows[reference].language == language
        if text is not None:
            assert rows[reference].text == text
    assert json.loads(rows["sum"].text) == {"refId": "sum", "datasource": {"uid": "p"}, "type": "math", "expression": "$wind + 1"}
    assert json.loads(rows["odd"].text) == {"refId": "odd", "datasource": "p", "model": {"deep": [{"left": 1}]}}
    assert rows["rain"].variables == ["site"] and rows["sum"].variables == ["wind"]
    assert rows["snow"].file == "40-sky-all-of-it-snow.flux" and rows["ice"].file == "40-sky-all-of-it-ice.graphite"


def test_export_is_whole_or_refused(spark, entries, tmp_path):
    target = str(tmp_path / "station")
    whole = {"total": len(TARGETS), "succeeded": len(TARGETS), "failed": 0}
    assert corpus.corpus_export(entries, target) == whole
    with pytest.raises(FileExistsError):
        corpus.corpus_export(entries, target)
    assert corpus.corpus_export(entries.limit(2), target, overwrite=True) == {"total": 2, "succeeded": 2, "failed": 0}
    assert spark.read.parquet(f"{target}/queries").count() == spark.read.parquet(f"{target}/manifest").count() == 2
    with pytest.raises(ValueError):
        corpus.corpus_export(entries.filter("false"), target, overwrite=True)
    # nothing but the last whole export is left
    assert [p.name for p in tmp_path.iterdir()] == ["station"]
    assert spark.read.parquet(f"{target}/queries").count() == 2


def nest(depth):
    inner = {"id": depth, "targets": [{"expr": f"level_{depth}"}]}
    return inner if depth == 9 else {**inner, "panels": [nest(depth + 1), "no panel", [{"id": 99}]]}


def test_panels_at_any_depth(spark):
    rows = corpus.flatten_panels(boards(spark, {"panels": [nest(1), 3, {"id": "tail"}]})).orderBy("panel_position").collect()
    assert [r.panel_id for r in rows] == [*map(str, range(1, 10)), "tail"]
    assert [json.loads(r.targets[0])["expr"] for r in rows[:9]] == [f"level_{d}" for d in range(1, 10)]


def test_panels_elsewhere_are_none(spark):
    documents = [{"other": {"panels": [{"id": 1}]}}, {"dashboard": {"panels": [{"id": 2}]}, "panels": [{"id": 3}]}, {"dashboard": "x", "panels": [{"id": 4}]}, [{"id": 5}]]
    assert {(r.board, r.panel_id) for r in corpus.flatten_panels(boards(spark, *documents)).collect()} == {("b1", "2"), ("b2", "4")}


def test_untitled_board_has_its_uid_as_title(spark):
    panel = {"id": 1, "targets": [{"sql": "select 1", "datasource": "m"}]}
    texts = {r.board: r.text for r in entries_of(spark, {"panels": [panel]}, {"title": "", "panels": [panel]}, {"title": "Own", "panels": [panel]}, uid="board").collect()}
    assert {b: t.split(";")[0] for b, t in texts.items()} == {"b0": "-- Dashboard=b0", "b1": "-- Dashboard=b1", "b2": "-- Dashboard=Own"}


def test_shared_panels(spark):
    panels = [
        {"id": 1, "title": "mine", "libraryPanel": {"uid": "full"}}, {"id": 2, "title": "mine", "libraryPanel": {"uid": "bare"}},
        {"id": 3, "title": "", "libraryPanel": {"uid": "bare"}}, {"id": 4, "title": "kept", "libraryPanel": {"uid": "lost"}},
    ]
    library = spark.createDataFrame(
        [("full", json.dumps({"id": 70, "title": "theirs", "hide": True, "targets": [{"expr": "a"}]}), "n"), ("bare", json.dumps({"targets": [{}, {}]}), "named")],
        "uid string, model string, name string",
    )
    rows = corpus.flatten_panels(boards(spark, {"panels": panels}), library=library).orderBy("panel_position").collect()
    assert [(r.panel_id, r.panel_title, r.panel_hidden, len(r.targets or [])) for r in rows] == [
        ("70", "theirs", True, 1), ("2", "mine", False, 2), ("3", "named", False, 2), ("4", "kept", False, 0),
    ]


def test_hidden_queries(spark):
    shown, hidden = {"expr": "a"}, {"expr": "b", "hide": True}
    panels = [{"id": 1, "hide": True, "targets": [shown]}, {"id": 2, "collapsed": True, "targets": [shown, hidden]}, {"id": 3, "collapsed": True, "transparent": True, "targets": [shown]}]
    targets = corpus.number_targets(corpus.flatten_panels(boards(spark, {"panels": panels})))
    assert [(r.panel_id, r.query_index) for r in corpus.hide_filter(targets).collect()] == [("2", 1)]
    assert corpus.hide_filter(targets, include_hidden=True).count() == 4


def test_member_that_is_no_text(spark):
    board = {"panels": [{"id": 1, "datasource": "p", "targets": [{"sql": ["x"], "expr": "one"}, {"rawSql": "\t", "expr": "two"}, {"expr": 3}]}]}
    assert [r.language for r in entries_of(spark, board).orderBy("query_index").collect()] == ["promql", "promql", "unknown"]


def test_charts_keep_their_failures(spark):
    listed = [("shop", "Till", place, chart, f"Chart {chart}" if chart != 6 else None, chart == 9) for place, chart in enumerate([5, 6, 5, 8, 9, 7])]
    charts = spark.createDataFrame(listed, "dashboard_id string, dashboard_title string, position int, chart_id int, chart_title string, hidden boolean")
    documents = {
        5: {"datasource": "3__table", "result": [{"query": "show till where shop = '${shop}'"}, {"Sql": "explain $plan;"}, {"query": "sum of it"}]},
        6: {"result": {"datasource_id": 12, "sql_query": "with a as (select 1) select * from a"}},
        8: {"query": ["select 1"], "note": "select 2"}, 9: {"sql": "select 9"},
    }
    details = spark.createDataFrame([(k, json.dumps(d)) for k, d in documents.items()], "chart_id int, doc string")
    assets = corpus.asset_expand(charts, details).cache()
    rows = {(r.chart_id, r.query_index): r for r in assets.collect()}
    assert set(rows) == {(5, 1), (5, 2), (6, 1), (7, None), (8, None)}
    assert rows[5, 2].text == "-- Dashboard=Till;\n-- Chart=Chart 5;\nexplain $plan;\n" and rows[5, 2].file == "5-chart-5-q2.sql"
    assert rows[5, 1].datasource == "3__table" and rows[5, 1].variables == ["plan", "shop"]
    assert rows[6, 1].datasource == "12" and rows[6, 1].asset_title == "chart-6" and rows[6, 1].variables == []
    assert rows[8, None].error == "no compiled SQL returned" and rows[8, None].datasource is None
    assert rows[7, None].error == "chart not found"
    assert tuple(corpus.manifest_summary(assets).first()) == (5, 3, 2)
