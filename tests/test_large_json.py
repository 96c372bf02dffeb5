"""Record arrays of one file read by several tasks."""

import gzip
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from pitchlens.sources import large_json as J
from pitchlens.sources.published import TAG

WANTED = {"players": "elements", "teams": "teams"}


def hard_text(rng):
    return "".join(rng.choice(['}', '{', '"', "\\", "[", "]", ",", ":", "a", "é", "\n", '"elements":[{', " "]) for _ in range(rng.randint(0, 12)))


def some_value(rng, depth=0):
    k = rng.random()
    if depth > 2 or k < 0.5:
        return rng.choice([None, True, 3, -2.5e7, hard_text(rng)])
    if k < 0.75:
        return {hard_text(rng): some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return [some_value(rng, depth + 1) for _ in range(rng.randint(0, 3))]


def some_record(rng):
    return {"id": rng.randrange(1000)} | {hard_text(rng): some_value(rng) for _ in range(rng.randint(0, 4))}


def some_document(rng):
    many = lambda: [some_record(rng) for _ in range(rng.randint(0, 12))]
    parts = {"elements": many(), "events": many(), "x": some_value(rng), "teams": rng.choice([None, [], many()]), "n": 5,
             "y": {"elements": [{"id": -1}], "z": [[{"id": -2}]]}}
    keys = rng.sample(list(parts), rng.randint(0, len(parts)))
    return {k: parts[k] for k in keys}


def by_pieces(text, tables, cuts):
    """The records read with the pieces cut after the given closing braces, as the jobs do."""
    fragments = text.split("}")
    edges = [0, *sorted(cuts), len(fragments)]
    stack, string, began, out, parts = [], None, None, [], {}
    for block, (a, b) in enumerate(zip(edges, edges[1:])):
        pieces = J.Pieces(tables, stack, string, began)
        scan = J.Scan(string=None if string is None else J.UNKNOWN)
        for k in range(a, b):
            last = k == len(fragments) - 1
            own = fragments[k] + ("" if last else "}")
            for table, start, record in pieces.records(own):
                if start is None:
                    out.append((table, record))
                else:
                    out.append((table, "".join(parts.pop(start)) + record))
            for _ in scan.tokens(own):
                pass
        if pieces.open:
            parts.setdefault(block if pieces.began is None else pieces.began, []).append("".join(pieces.parts))
        # the effect, folded, is the state the pieces found
        effect = {"closed": scan.closed, "open": scan.stack, "string": scan.string}
        stack, string, began = J.after(stack, string, began, block, effect, tables)
        assert [tuple(x) for x in stack] == pieces.scan.stack and string == pieces.scan.string
    assert not stack and not parts
    return out


@pytest.mark.parametrize("seed", range(3))
def test_records_of_random_documents_whatever_the_cuts(seed):
    rng = random.Random(seed)
    tables = {field: table for table, field in WANTED.items()}
    for _ in range(150):
        doc = some_document(rng)
        text = json.dumps(doc, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        n = text.count("}")
        got = by_pieces(text, tables, rng.sample(range(1, n), min(n - 1, rng.randint(0, 8))) if n > 1 else [])
        want = [(t, r) for t, f in WANTED.items() for r in doc.get(f) or []]
        assert sorted((t, json.dumps(json.loads(r))) for t, r in got) == sorted((t, json.dumps(r)) for t, r in want)
        rows = [some_record(rng) for _ in range(5)]
        got = by_pieces(json.dumps(rows), {"": "rows"}, rng.sample(range(1, 5), 3))
        assert [json.loads(r) for _, r in got] == rows


@pytest.fixture()
def small_pieces(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_file_is_read_by_several_tasks(spark, small_pieces, tmp_dir):
    rng = random.Random(7)
    docs = {"a.json": {"elements": [some_record(rng) for _ in range(400)], "teams": [{"id": 1, "long": "}" * 9000}, {"id": 2}]},
            "b.json": {"x": "}" * 5000, "teams": [some_record(rng) for _ in range(30)]}, "c.json": {}}
    for name, doc in docs.items():
        with open(os.path.join(tmp_dir, name), "w", encoding="utf-8") as f:
            json.dump(doc, f, ensure_ascii=False)
    fragments = J._fragments(spark, tmp_dir)
    assert fragments.rdd.getNumPartitions() > 5 and fragments.where("file like '%a.json'").select("block").distinct().count() > 5
    got = J.read_records(spark, tmp_dir, WANTED).collect()
    want = [(name, t, json.dumps(r)) for name, doc in docs.items() for t, f in WANTED.items() for r in doc.get(f, [])]
    assert sorted((os.path.basename(r["file"]), r[TAG], json.dumps(json.loads(r["text"]))) for r in got) == sorted(want)
    with open(os.path.join(tmp_dir, "nothing.json"), "w"):
        assert J.read_records(spark, tmp_dir, WANTED).count() == len(want)
    with gzip.open(os.path.join(tmp_dir, "z.json.gz"), "wt") as f:
        f.write('{"teams": [{"id": 5}]}')
    assert J.read_records(spark, tmp_dir, WANTED).where("file like '%gz'").select("text").collect()[0]["text"] == '{"id": 5}'
    top = os.path.join(tmp_dir, "top")
    os.makedirs(top)
    rows = [some_record(rng) for _ in range(300)]
    with open(os.path.join(top, "d.json"), "w") as f:
        json.dump(rows, f)
    got = J.read_records(spark, top, {"rows": ""}).collect()
    assert sorted(json.dumps(json.loads(r["text"])) for r in got) == sorted(map(json.dumps, rows))


@pytest.mark.parametrize("text", [
    '{"elements": [{"id": 1}, {"id": 2', '{"elements": [{"id": 1}]', '{"elements": [{"id": 1}}', '{"elements": [1]}', '{"elements": [[{}]]}',
    '{"elements": [{}, "x"]}', '{"elements": {"id": 1}}', '{"elements": "x"}', '{"elements": 5}', '[{"id": 1}]', '{} {}', '{}]', '7', '"x"', " ",
    'nonsense{}', '{"elements": [{"id": 1} {"id": 2}] x}', '{"teams": [{"id": "}'])
def test_a_broken_document_fails_the_load(spark, tmp_dir, text):
    with open(os.path.join(tmp_dir, "x.json"), "w") as f:
        f.write(text)
    with pytest.raises(Exception):
        J.read_records(spark, tmp_dir, WANTED).collect()
