"""The registered queries on the smallest tables: contracts, the SQL and the pipeline."""

import hashlib
import random
import zlib

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from pitchlens.llm import decontam, encode, neardup, quality, queries

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_virtual_slots": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
    "op2_decision_list": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op3_near_duplicates": ["doc_id", "class_id", "links"],
    "op4_token_counts": ["doc_id", "n_tokens"],
    "op5_contextual_pii": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    "op6_toxic_segments": ["doc_id", "held_out", "score", "predicted"],
    "op8_repeated_substrings": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op9_shared_prefix_encoding": ["doc_id", "ids", "n_tokens", "round_trip"],
    "op11_covering_simhash": ["doc_id", "fingerprint", "component_id"],
    "op12_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
    "op13_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
    "op10_fm_index_decontamination": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
}


@pytest.mark.parametrize("name", CONTRACT)
def test_one_row_per_document_with_the_contracts_columns(spark, name):
    assert name in __spark_entry__.queries()
    out = queries.queries()[name](spark, SF)
    assert out.columns[:len(CONTRACT[name])] == CONTRACT[name] or set(CONTRACT[name]) <= set(out.columns)
    ids = sorted(r["doc_id"] for r in out.select("doc_id").collect())
    assert ids == sorted(r["doc_id"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect())


def test_chat_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    want = con.execute(queries.oracle_sql()["op7_chat_round_trip"])
    columns = [c[0] for c in want.description]
    out = queries.op7_chat_round_trip(spark, SF)
    assert sorted(map(tuple, out.select(*columns).collect())) == sorted(want.fetchall())
    assert sorted(out.columns) == sorted(columns)


def test_sharding_law(spark):
    rows = queries.op1_virtual_slots(spark, SF).collect()
    text = {r["doc_id"]: (r["text"] or "").encode() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert all((r["size"], r["text_crc32"]) == (len(text[r["doc_id"]]) + 1, zlib.crc32(text[r["doc_id"]])) for r in rows)
    loads = [sum(r["size"] for r in rows if r["shard"] == k) for k in range(8)]
    assert max(loads) - min(loads) <= 0.1 * max(loads)


def test_passages_repeated_across_documents_are_told_from_clean_ones(spark, tmp_path):
    rng = random.Random(5)
    text = lambda n: " ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(n))
    passages = [text(60) for _ in range(3)]  # 539 bytes each
    # a digit of its own on both sides, so that no neighbouring byte repeats by chance
    rows = [(i, f"{text(20 * (i % 9))} {i // 3}{passages[i % 3]}{i // 3} {text(30)}") for i in range(30)]
    rows += [(100 + i, text(1 + 9 * i)) for i in range(30)] + [(200, None), (201, "")]
    short = " ".join("abcdef"[i % 6] for i in range(60))  # 119 bytes: the unit is 400
    rows += [(300 + i, f"{text(40)} {short} {text(40)}") for i in range(2)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op8_repeated_substrings(spark, str(tmp_path)).collect()
    assert {r["doc_id"]: r["repeated"] for r in out} == {i: i < 30 for i, _ in rows}
    for r, (i, t) in zip(sorted(out), sorted(rows), strict=True):
        left = (t or "").replace(passages[i % 3], "").encode()
        assert (r["n_removed"], r["kept_sha256"]) == (len((t or "").encode()) - len(left), hashlib.sha256(left).hexdigest())


def test_pipeline_equals_its_stages_done_plainly(spark):
    got = {r["doc_id"]: r for r in corpus_pipeline.run(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    rules = quality.learn_from(docs, labels)
    kept = {r["doc_id"]: r["text"] for r in quality.judged(docs, rules).where("kept").select("row.*").collect()}
    # one of each class, by all pairs
    idf = neardup.inverse_frequencies(docs.join(spark.createDataFrame([(i,) for i in kept], "doc_id long"), "doc_id"))
    sets = {i: neardup.weights(t, idf) for i, t in kept.items()}
    root = {i: i for i in kept}
    for a in sorted(kept):
        for b in sorted(kept):
            if a < b and neardup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((root[a], root[b]))
                root = {i: x if r == y else r for i, r in root.items()}
    chosen = {i: t for i, t in kept.items() if root[i] == i}
    # no passage, no base span, and the ids decode to the text
    items = [(str(r["item_id"]), r["text"]) for r in bench.collect()]
    phrases = decontam.phrases_of(items)
    assert got.keys() <= chosen.keys()
    for i, t in chosen.items():
        spans = decontam.shard_hits([t.encode()], phrases)[1][0]
        if i not in got:
            assert spans
            continue
        text = encode.decode_ids(got[i]["ids"])
        assert hashlib.sha256(text.encode()).hexdigest() == got[i]["text_sha256"] and got[i]["round_trip"]
        assert not decontam.shard_hits([text.encode()], phrases)[1][0]
        if not spans and "@" not in t and not any(c.isdigit() for c in t):
            assert text == t


def test_every_query_is_registered():
    assert {*queries.queries(), "pipeline"} <= set(__spark_entry__.queries())
