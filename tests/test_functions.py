from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemill.functions import json as j
from tidemill.functions import paths, stats, text, time


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_durations():
    assert time.parse_duration("30s") == timedelta(seconds=30)
    assert time.parse_duration("2h") == timedelta(hours=2)
    for bad in ("", "10", "m", "1w", "1.5h"):
        with pytest.raises(ValueError):
            time.parse_duration(bad)


def test_times():
    now = datetime(2026, 7, 1, 12, tzinfo=timezone.utc)
    assert time.resolve_time("now", now) == now
    assert time.resolve_time("-30m", now) == now - timedelta(minutes=30)
    assert time.resolve_time("2026-07-01T00:00:00", now) == datetime(2026, 7, 1, tzinfo=timezone.utc)
    assert time.resolve_time("2026-07-01T02:00:00+02:00", now) == datetime(2026, 7, 1, tzinfo=timezone.utc)
    for bad in ("yesterday", "-xh", "-5w"):
        with pytest.raises(ValueError):
            time.resolve_time(bad, now)


def test_epoch_text(spark):
    assert one(spark, time.iso_from_epoch_ms(F.lit(1700000000000))) == "2023-11-14T22:13:20+00:00"
    assert one(spark, time.iso_from_epoch_ms(F.lit(1700000000005))) == "2023-11-14T22:13:20.005000+00:00"
    assert one(spark, time.iso_from_epoch_ms(F.lit(None).cast("long"))) == ""


def test_slug(spark):
    assert one(spark, text.slug(F.lit("Revenue Overview!"))) == "revenue-overview"
    assert one(spark, text.slug(F.lit("--- "), "fallback")) == "fallback"
    assert one(spark, F.length(text.slug(F.lit("ab " * 60)))) == 80


def test_variables(spark):
    assert one(spark, text.template_variables(F.lit('{"x": "$region ${tenant:sqlstring} $region"}'))) == ["region", "tenant"]


def test_sql_document(spark):
    got = one(spark, text.sql_document({"Dashboard": F.lit("a;b\nc"), "Panel": F.lit("p")}, F.lit(" select 1 \n")))
    assert got == "-- Dashboard=a,b c;\n-- Panel=p;\nselect 1;\n"


def test_redaction(spark):
    assert one(spark, text.redact_text(F.lit("Bearer abc.def"))) == "Bearer <redacted>"
    assert one(spark, text.redact_text(F.lit("use MODEL_API_KEY now"))) == "use <redacted-env> now"
    assert one(spark, text.redact_text(F.lit("password: hunter2, x"))) == "password: <redacted>, x"
    assert one(spark, text.redact_value(F.lit("api_key"), F.lit("top-secret"))) == "<redacted>"


def test_last_line(spark):
    assert one(spark, text.last_line(F.lit("Traceback\n  at x\r\nKeyError: 1\n\n"))) == "KeyError: 1"
    assert one(spark, text.last_line(F.lit(None).cast("string"))) == ""


def test_bind_prefers_longer_names(spark):
    bound = text.bind_variables(F.lit("$job $job_id"), {"job": "a", "job_id": "b"})
    assert one(spark, bound) == "a b"


def test_json_path(spark):
    doc = F.lit('{"status":{"phase":"Running","list":[{"n":1}]},"with-dash":true}')
    assert one(spark, j.json_path(doc, "{.status.phase}")) == "Running"
    assert one(spark, j.json_path(doc, ".status.list[0]")) == '{"n":1}'
    assert one(spark, j.json_path(doc, ".with-dash")) == "true"
    assert one(spark, j.json_path(doc, ".status.none[3].x")) == ""
    for bad in ("status", ".a[*]", ".a..b", "{.a b}", ".a[?(@.x)]"):
        with pytest.raises(ValueError):
            j.check_path(bad)


def test_pairs_keep_the_last(spark):
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.lit(v).alias("value")) for f, v in (("n", "4"), ("n", "5"))])
    assert one(spark, j.pairs_to_map(pairs)) == {"n": "5"}


def test_secret_keys_go_at_every_depth(spark):
    doc = F.lit('{"a":[{"PassWord":"bad","b":1}],"secureJsonData":{"token":"bad"}}')
    assert one(spark, j.redact_keys(doc, j.METRIC_DASHBOARD_SECRET_KEYS)) == '{"a": [{"b": 1}]}'
    assert one(spark, j.redact_keys(F.lit("no json"), ["x"])) is None


def test_find_sql_reads_in_order(spark):
    doc = '{"query":{"sql":"select 1"},"rows":[{"query":"SELECT 2"},{"sql_query":"select 1"},{"sql":"drop x"}],"text":"select 9"}'
    assert one(spark, j.find_sql(F.lit(doc))) == ["select 1", "SELECT 2"]


def test_paths(spark):
    assert one(spark, paths.bucket_of(F.lit("s3://b/k/x.csv"))) == "b"
    assert one(spark, paths.key_of(F.lit("s3://b/k/x.csv"))) == "k/x.csv"
    assert one(spark, paths.key_of(F.lit("s3://b"))) == ""
    assert one(spark, paths.join_key(F.lit("base//"), F.lit("r/x"))) == "base/r/x"
    assert one(spark, paths.join_key(F.lit(""), F.lit("r/x"))) == "r/x"
    assert one(spark, paths.ancestor_prefixes(F.lit("a/b/c"))) == ["", "a/", "a/b/"]
    assert one(spark, paths.ancestor_prefixes(F.lit("a"))) == [""]


def test_normal_tail(spark):
    assert one(spark, stats.two_sided_p(F.lit(1.959963985))) == pytest.approx(0.05, abs=1e-6)
    assert one(spark, stats.two_sided_p(F.lit(-2.575829304))) == pytest.approx(0.01, abs=1e-6)
    assert stats.critical_z(0.95) == pytest.approx(1.959963985)
    with pytest.raises(ValueError):
        stats.critical_z(1.5)
