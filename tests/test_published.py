"""Versioned loads (S6, S9, S11, S12): all tables of a load change together or not at all."""

import os
import subprocess
import sys
import textwrap

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.sources import published as P
from pitchlens.sources.landing import tagged_records
from pitchlens.sources.league_feeds import land_bootstrap, league_inputs_from_feeds
from pitchlens.sources.tables import full_model, model_path, read_table
from pitchlens.streaming import refresh
from tests.conftest import ROOT


def rows(spark, *ids):
    return spark.createDataFrame([(i, f"n{i}") for i in ids], "id long, name string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_tables_of_a_load_change_together_and_old_versions_stay(spark, tmp_dir):
    assert P.version(spark, tmp_dir).number == 0 and not P.is_published(spark, tmp_dir)
    one = P.publish(spark, tmp_dir, {"a": rows(spark, 1, 2), "b": rows(spark, 3)})
    held = one.read(spark, "a")
    two = P.publish(spark, tmp_dir, {"a": rows(spark, 9)})
    assert (one.number, two.number) == (1, 2) and P.versions(spark, tmp_dir) == [1, 2]
    assert ids(two.read(spark, "a")) == [9] and ids(two.read(spark, "b")) == [3]  # b is of the load before
    assert ids(held) == [1, 2] and ids(P.version(spark, tmp_dir, 1).read(spark, "a")) == [1, 2]
    assert ids(read_table(spark, f"{tmp_dir}/a")) == [9]
    with pytest.raises(KeyError):
        two.read(spark, "c")


def test_a_load_that_fails_leaves_every_table(spark, tmp_dir, monkeypatch):
    P.publish(spark, tmp_dir, {"a": rows(spark, 1), "b": rows(spark, 1)})
    broken = rows(spark, 5).withColumn("name", F.raise_error(F.lit("bad record")).cast("string"))
    with pytest.raises(Exception, match="bad record"):
        P.publish(spark, tmp_dir, {"a": rows(spark, 5), "b": broken})
    monkeypatch.setattr(P, "_created", lambda *_: (_ for _ in ()).throw(OSError("storage is gone")))
    with pytest.raises(OSError):
        P.publish(spark, tmp_dir, {"a": rows(spark, 6), "b": rows(spark, 6)})
    assert P.versions(spark, tmp_dir) == [1]
    assert ids(read_table(spark, f"{tmp_dir}/a")) == ids(read_table(spark, f"{tmp_dir}/b")) == [1]


def test_a_process_killed_between_two_tables_leaves_the_last_load(spark, tmp_dir):
    P.publish(spark, tmp_dir, {"a": rows(spark, 1), "b": rows(spark, 1)})
    script = textwrap.dedent(f"""
        import os, sys
        sys.path.insert(0, {ROOT!r})
        from pitchlens.session import get_session
        from pitchlens.sources.published import Load
        spark = get_session("local[1]", shuffle_partitions=1)
        load = Load(spark, {tmp_dir!r})
        load.write("a", spark.range(3))
        os._exit(9)
    """)
    assert subprocess.run([sys.executable, "-c", script], capture_output=True, timeout=180).returncode == 9
    assert len(os.listdir(f"{tmp_dir}/_loads")) == 2
    assert ids(read_table(spark, f"{tmp_dir}/a")) == ids(read_table(spark, f"{tmp_dir}/b")) == [1]


def test_loads_that_finish_at_once_merge(spark, tmp_dir):
    first, second = P.Load(spark, tmp_dir), P.Load(spark, tmp_dir)
    first.write("a", rows(spark, 1))
    second.write("b", rows(spark, 2))
    last = P.version(spark, tmp_dir)
    assert first.commit().number == 1
    # the second found version 0 as the newest, like the first
    found, calls = P.version, []
    P.version = lambda *a: last if not calls and not calls.append(1) else found(*a)
    try:
        new = second.commit()
    finally:
        P.version = found
    assert calls and new.number == 2
    assert ids(new.read(spark, "a")) == [1] and ids(new.read(spark, "b")) == [2]


def test_a_violated_grain_refuses_the_load_and_is_stored(spark, tmp_dir):
    P.publish(spark, tmp_dir, {"a": rows(spark, 1)}, {"a": ["id"]})
    with pytest.raises(P.GrainViolation) as e:
        P.publish(spark, tmp_dir, {"a": rows(spark, 4, 4, 4, 5), "b": rows(spark, 7, 7)}, {"a": ["id"], "b": ["name"]})
    stored = P.violations(spark, e.value)
    assert [tuple(r) for r in stored["a"].collect()] == [(4, 3)] and [tuple(r) for r in stored["b"].collect()] == [("n7", 2)]
    assert ids(read_table(spark, f"{tmp_dir}/a")) == [1] and P.versions(spark, tmp_dir) == [1]
    # null keys are keys
    with pytest.raises(P.GrainViolation):
        P.publish(spark, tmp_dir, {"a": spark.createDataFrame([(None, "x"), (None, "y")], "id long, name string")}, {"a": ["id"]})


def test_the_grain_check_reads_the_key_columns_only(spark, tmp_dir):
    load = P.Load(spark, tmp_dir)
    stored = load.write("a", rows(spark, 1, 2), ["id"])
    plan = P.check_grain(stored, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_empty_tables_partitions_and_schemas(spark, tmp_dir):
    df = spark.createDataFrame([], "id long, tags array<string>, s struct<x:int>")
    got = P.publish(spark, tmp_dir, {"a": df, "b": rows(spark, 1).limit(0)}, {"a": ["id"]})
    assert got.read(spark, "a").schema == df.schema and got.read(spark, "a").count() == 0
    load = P.Load(spark, tmp_dir)
    load.write("p", rows(spark, 1, 2, 3).withColumn("half", F.col("id") % 2), partition_by=["half"])
    with pytest.raises(ValueError):
        load.write("p", rows(spark, 1))
    p = load.commit().read(spark, "p")
    assert ids(p.where("half = 1")) == [1, 3] and p.columns == ["id", "name", "half"]


def test_a_stream_batch_is_published_once(spark, tmp_dir):
    P.publish(spark, tmp_dir, {"a": rows(spark, 1)}, batch=("s", 0))
    again = P.publish(spark, tmp_dir, {"a": rows(spark, 2)}, batch=("s", 0))
    assert again.number == 1 and ids(again.read(spark, "a")) == [1]
    assert P.publish(spark, tmp_dir, {"a": rows(spark, 3)}, batch=("t", 0)).number == 2
    late = P.Load(spark, tmp_dir, ("s", 0))
    late.write("a", rows(spark, 4))
    assert late.commit().number == 2 and ids(read_table(spark, f"{tmp_dir}/a")) == [3]
    # the refresh's sink, run again for the same batch
    schema = "elements array<struct<id:long>>, __pl_mtime timestamp, __pl_load string"
    for k, number in ((7, 1), (8, 1), (9, 2)):
        doc = spark.createDataFrame([([(k,)], None, "w")], schema)
        refresh.replace_tables_from_payload(doc, {"elements": "e"}, tmp_dir, ("q", number))
    assert ids(read_table(spark, f"{tmp_dir}/e")) == [9] and P.version(spark, tmp_dir).number == 4


def test_vacuum_keeps_what_readers_may_use(spark, tmp_dir):
    for k in range(4):
        P.publish(spark, tmp_dir, {"a": rows(spark, k)} | ({"b": rows(spark, k)} if not k else {}))
    unfinished = P.Load(spark, tmp_dir)
    unfinished.write("a", rows(spark, 9))
    assert P.vacuum(spark, tmp_dir, keep=2) == []  # all loads are young
    assert P.versions(spark, tmp_dir) == [3, 4]
    gone = P.vacuum(spark, tmp_dir, keep=2, older_than=-60)
    assert len(gone) == 2  # version 2's table a, and the load never finished
    assert [ids(P.version(spark, tmp_dir, n).read(spark, t)) for n, t in ((3, "a"), (4, "a"), (4, "b"))] == [[2], [3], [0]]


def test_full_models_are_versions(spark, tmp_dir):
    assert ids(full_model(spark, "m", rows(spark, 1), tmp_dir, ["id"])) == [1]
    with pytest.raises(P.GrainViolation):
        full_model(spark, "m", rows(spark, 2, 2), tmp_dir, ["id"])
    assert ids(read_table(spark, model_path(spark, "m", tmp_dir))) == [1]
    full_model(spark, "other", rows(spark, 5), tmp_dir)
    assert ids(read_table(spark, model_path(spark, "m", tmp_dir))) == [1]


A, B = (T.StructType([T.StructField("id", T.LongType()), T.StructField(c, T.StringType())]) for c in "ab")


def test_tagged_records_are_one_scan_and_one_parse(spark, tmp_dir):
    docs = spark.createDataFrame([
        ('{"as": [{"id": 1, "a": "x", "more": [1]}, {"id": 2}], "bs": [{"id": 3, "b": "y"}], "rest": {"as": [{"id": 99}]}}', "f1"),
        ('{"bs": [], "as": null}', "f2"), ('{}', "f3"), ('{"bs": [{"id": 4}]}', "f4")], "value string, file string")
    docs.write.parquet(f"{tmp_dir}/docs")
    docs = spark.read.parquet(f"{tmp_dir}/docs")
    tagged = tagged_records(docs, {"a": ("as", A), "b": ("bs", B), "c": ("cs", A)})
    plan = tagged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("parseJson(") == 1 and plan.count("from_json(") <= 3
    sc = spark.sparkContext
    sc.setJobGroup("tagged", "one pass")
    load = P.Load(spark, f"{tmp_dir}/root")
    rows = tagged.write.partitionBy(P.TAG).parquet  # the write alone: one job
    rows(f"{tmp_dir}/alone")
    assert len(sc.statusTracker().getJobIdsForGroup("tagged")) == 1
    sc.setJobGroup("other", "")
    got = load.write_tagged(tagged, {"a": ["id"], "b": ["id"]})
    assert got["a"].columns == ["file", "id", "a", "_record"]
    assert sorted((r["file"], r["id"], r["a"]) for r in got["a"].collect()) == [("f1", 1, "x"), ("f1", 2, None)]
    assert sorted((r["file"], r["id"], r["b"]) for r in got["b"].collect()) == [("f1", 3, "y"), ("f4", 4, None)]
    assert '"more":[1]' in {r["id"]: r["_record"] for r in got["a"].collect()}[1]
    new = load.commit()
    assert new.read(spark, "c").count() == 0 and new.read(spark, "c").columns == ["file", "id", "a", "_record"]


@pytest.mark.parametrize("text", ['{"as": [{"id": "x"}]}', '{"as": 5}', '{"as": [{"id": 1}', "", "[1]", "7"])
def test_a_broken_document_fails_the_pass(spark, text):
    docs = spark.createDataFrame([('{"as": [{"id": 1}]}',), (text,)], "value string")
    with pytest.raises(Exception):
        tagged_records(docs, {"a": ("as", A), "b": ("bs", B)}).collect()


def test_a_feed_load_is_refused_whole_when_the_seed_has_a_double_key(spark, tmp_dir):
    files = {"bootstrap": '{"elements": [{"id": 1, "minutes": 9}], "teams": [{"id": 1}], "events": []}',
             "fixtures": "[]", "matches": '{"matches": []}',
             "standings": '{"standings": [{"type": "HOME", "table": [{"position": 1}]}]}', "scorers": '{"scorers": [{"goals": 3}]}'}
    for name, text in files.items():
        with open(f"{tmp_dir}/{name}.json", "w") as f:
            f.write(text)
    os.makedirs(f"{tmp_dir}/h")
    with open(f"{tmp_dir}/h/element-1.json", "w") as f:
        f.write('{"history": [{"element": 1, "fixture": 7, "minutes": 90}]}')
    header = "fpl_team_id,fpl_name,fpl_short_name,football_data_name,football_data_id\n"

    def load(seed):
        with open(f"{tmp_dir}/seed.csv", "w") as f:
            f.write(header + seed)
        return league_inputs_from_feeds(spark, *(f"{tmp_dir}/{n}" for n in ("bootstrap.json", "fixtures.json", "h", "matches.json",
                                        "seed.csv", "raw")), standings=f"{tmp_dir}/standings.json", scorers=f"{tmp_dir}/scorers.json")

    raw = load("1,A,AAA,A FC,57\n")
    assert (raw.players.count(), raw.player_gameweeks.count(), raw.fixtures.count()) == (1, 1, 0)
    assert [r["standing_type"] for r in read_table(spark, f"{tmp_dir}/raw/pl_standings").collect()] == ["HOME"]
    assert [r["goals"] for r in read_table(spark, f"{tmp_dir}/raw/pl_scorers").collect()] == [3]
    with open(f"{tmp_dir}/bootstrap.json", "w") as f:
        f.write('{"elements": [{"id": 2, "minutes": 9}], "teams": [], "events": []}')
    with pytest.raises(P.GrainViolation):
        load("1,A,AAA,A FC,57\n1,B,BBB,B FC,58\n")
    assert ids(read_table(spark, f"{tmp_dir}/raw/players")) == [1]
    assert ids(land_bootstrap(spark, f"{tmp_dir}/bootstrap.json")["players"]) == [2]
