"""Landing (S1-S5, S7), seeds, grain checks and stored models."""

import json
import os

import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.sources import landing as L
from pitchlens.sources import tables as TB

ELEM = T.StructType([T.StructField("id", T.LongType()), T.StructField("minutes", T.LongType())])


def _write_lines(path, docs):
    with open(path, "w") as f:
        for d in docs:
            f.write(json.dumps(d) + "\n")


def test_explode_payload_and_empty_arrays(spark, tmp_dir):
    p = os.path.join(tmp_dir, "boot.jsonl")
    _write_lines(p, [{"elements": [{"id": 1, "minutes": 0}, {"id": 2, "minutes": 90}], "teams": [{"id": 7}]},
                     {"elements": []}, {"elements": None}])
    schema = T.StructType([T.StructField("elements", T.ArrayType(ELEM)),
                           T.StructField("teams", T.ArrayType(T.StructType([T.StructField("id", T.LongType())])))])
    docs = L.read_documents(spark, p, schema).withColumnRenamed("elements", "e")
    docs = docs.select(F.struct("e", "teams").alias("doc"))
    players = L.explode_payload(docs.select(F.struct(F.col("doc.e").alias("elements")).alias("doc")), "elements")
    assert sorted(r.id for r in players.collect()) == [1, 2]
    teams = L.explode_payload(docs, "teams")
    assert [r.id for r in teams.collect()] == [7]


def test_load_array_top_level_and_under_key(spark, tmp_dir):
    a = os.path.join(tmp_dir, "fixtures.json")
    with open(a, "w") as f:
        json.dump([{"id": 1, "minutes": 3}, {"id": 2, "minutes": None}], f)
    assert sorted(r.id for r in L.load_array(spark, a, ELEM).collect()) == [1, 2]
    b = os.path.join(tmp_dir, "matches.json")
    with open(b, "w") as f:
        json.dump({"matches": [{"id": 5, "minutes": 1}], "count": 1}, f)
    assert [r.id for r in L.load_array(spark, b, ELEM, root="matches").collect()] == [5]


def test_flatten_history_active_only(spark):
    hist_schema = T.StructType([T.StructField("round", T.LongType())])
    docs = spark.createDataFrame([(1, '{"history": [{"round": 1}, {"round": 2}]}'), (2, '{"history": [{"round": 1}]}'),
                                  (3, '{"history": []}'), (4, "{}")], "pid long, doc string")
    ents = spark.createDataFrame([(1, 90), (2, 0), (3, 10), (4, 5), (5, 10)], "id long, minutes long")
    active = F.coalesce(F.col("minutes"), F.lit(0)) > 0
    out = L.flatten_history(docs, ents, active, "id", "pid", elem_schema=hist_schema)
    assert sorted(r["round"] for r in out.collect()) == [1, 2]


def test_flatten_carry(spark):
    inner = T.StructType([T.StructField("position", T.LongType())])
    outer = T.StructType([T.StructField("type", T.StringType()), T.StructField("table", T.ArrayType(inner))])
    docs = spark.createDataFrame([('{"standings": [{"type": "TOTAL", "table": [{"position": 1}, {"position": 2}]},'
                                   ' {"type": "HOME", "table": [{"position": 1}]}]}',)], "doc string")
    rows = L.flatten_carry(docs, "standings", "table", {"standing_type": "type"}, outer_schema=outer).collect()
    assert sorted((r.standing_type, r.position) for r in rows) == [("HOME", 1), ("TOTAL", 1), ("TOTAL", 2)]


def test_nested_as_json_and_normalize(spark):
    df = spark.createDataFrame([(1, (2, (3,)), [1, 2])],
                               "homeTeam long, fullTime struct<home:long, extra:struct<x:long>>, tags array<long>")
    d0 = L.nested_as_json(df, depth=0)
    assert dict(d0.dtypes) == {"homeTeam": "bigint", "fullTime": "string", "tags": "string"}
    d1 = L.nested_as_json(df, depth=1)
    assert "fullTime__home" in d1.columns and dict(d1.dtypes)["fullTime__extra"] == "string"
    assert L.normalize_columns(df).columns == ["home_team", "full_time", "tags"]
    assert L.snake_case("utcDate") == "utc_date" and L.snake_case("lastUpdatedAt") == "last_updated_at"


def test_seed_grain_and_stored_models(spark, tmp_dir):
    seed = os.path.join(tmp_dir, "seed.csv")
    with open(seed, "w") as f:
        f.write("fpl_team_id,fpl_name,fpl_short_name,football_data_name,football_data_id\n")
        f.write("1,A,AAA,A FC,57\n2,B,BBB,B FC,58\n2,B2,BB2,B2 FC,59\n")
    s = TB.load_seed(spark, seed)
    assert s.schema == TB.TEAM_MAPPING_SCHEMA and s.count() == 3
    v = TB.check_grain(s, ["fpl_team_id"]).collect()
    assert [(r.fpl_team_id, r.n) for r in v] == [(2, 2)]
    # A second build replaces the first (no append)
    first = TB.full_model(spark, "m", s, root=tmp_dir)
    assert first.count() == 3
    again = TB.full_model(spark, "m", s.limit(1), root=tmp_dir)
    assert again.count() == 1
    TB.register_view("seed_view", s)
    assert TB.read_table(spark, "seed_view").count() == 3
    assert TB.read_table(spark, TB.model_path(spark, "m", tmp_dir)).count() == 1


@pytest.mark.parametrize("text", ['{"elements": [{"id": 1, "minutes": 2}', '{"elements": [{"id": "x"}]}', "", "[1]"])
def test_a_broken_document_fails_the_load(spark, text):
    docs = spark.createDataFrame([('{"elements": [{"id": 1, "minutes": 2}]}',), (text,)], "doc string")
    with pytest.raises(Exception):
        L.explode_payload(docs, "elements", ELEM).collect()
