"""Merkle manifest, covering SimHash and periodic runs against brute force, with nulls,
empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pitchlens.llm import covering, merkle, periodic, queries

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("tree", "n", "rank", "hash", "own", "at", "kids", "path", "top", "leaf", "fp", "first", "t", "key", "runs", "words", "g", "a", "p",
            "collapsed", "altered")


def table(spark, rows):
    return spark.createDataFrame(rows, DOC).repartition(3).withColumns({c: F.lit(1) for c in CLASHING})


def on_documents(spark, query, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    return query(spark, str(tmp_path))


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


# Merkle manifest

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(r, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def brute_climb(nodes):
    """(root, per node the siblings (left, right) of every level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[k:k + 8] for k in range(0, len(level), 8)]
        for i, x in enumerate(at):
            run = runs[x // 8]
            paths[i].append(("".join(run[:x % 8]), "".join(run[x % 8 + 1:])))
            at[i] = x // 8
        level = [sha("".join(run)) for run in runs]
    return level[0], paths


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], brute_leaf(r, r["text"]), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is None, x[0] or 0, x[1]))
        trees[g] = brute_climb([leaf for _, leaf, _ in groups[g]])
    root, above = brute_climb([trees[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for (doc_id, leaf, r), path in zip(groups[g], trees[g][1], strict=True):
            path = path + above[k]
            text = r["text"]
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = brute_leaf(r, text)
            for left, right in path:
                h = sha(left + h + right)
            out.append((doc_id, leaf, trees[g][0], root, sha("".join(a + b for a, b in path)), h, h == root))
    return out


MANIFEST = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def same_rows(got, want):
    key = lambda r: tuple(map(repr, r))
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, want), key=key)


@pytest.mark.parametrize("n", [1, 8, 9, 700])
def test_manifest_equals_brute_force(spark, tmp_path, n):
    rng = random.Random(n)
    langs = ["en"] * 9 + ["de", None, "É", "z"]
    rows = [(i, rng.choice([None, "", "Aé b", f"Text {i}"]), rng.choice(langs), rng.choice([None, "s|1"]), rng.choice([None, i])) for i in range(n)]
    if n == 700:  # more than a block of one group, repeated rows and ids, rows without an id
        rows += [rows[5], rows[5], (5, "other", "en", "s", 1), (None, "x", "en", "s", 1), (None, "X", None, "s", 1)]
    got = on_documents(spark, queries.op12_merkle_manifest, table(spark, rows), tmp_path)
    assert got.columns == MANIFEST
    want = brute_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows])
    same_rows(got.collect(), want)


def test_manifest_of_many_groups_and_more_rounds(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(merkle, "DIGITS", 1)  # blocks of 8 rows: four rounds of leaves, three of groups
    monkeypatch.setattr(merkle, "BLOCK", 8)
    rng = random.Random(3)
    rows = [(i, f"T{i}", "big" if rng.random() < 0.8 else f"g{rng.randrange(90)}", "s", i) for i in range(800)]
    got = on_documents(spark, queries.op12_merkle_manifest, table(spark, rows), tmp_path)
    same_rows(got.collect(), brute_manifest([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r, strict=True)) for r in rows]))


def test_manifest_of_an_empty_table_and_of_other_columns(spark, tmp_path):
    assert on_documents(spark, queries.op12_merkle_manifest, table(spark, [(1, "x", "en", "s", 1)]).limit(0), tmp_path).count() == 0
    df = spark.createDataFrame([("k1", 2.5, "x"), ("k2", None, "x")], "id string, v double, grp string")
    found = merkle.manifest(df, ["id", "v"], "grp", "id").collect()
    leaves = [sha("2:k13:2.5"), sha("2:k2-")]
    assert sorted((r["id"], r["leaf"], r["root"]) for r in found) == [(f"k{k + 1}", leaves[k], sha("".join(leaves))) for k in range(2)]


def test_manifest_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = con.execute(queries.oracle_sql()["op12_merkle_manifest"])
    columns = [c[0] for c in want.description]
    got = queries.op12_merkle_manifest(spark, SF)
    same_rows(got.select(*columns).collect(), want.fetchall())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan and "MapInArrow" not in plan


# covering SimHash

def brute_print(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = words_of(low)
    shingles = [" ".join(w[i:i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """The smallest id reachable, per id, of {id: fingerprint}."""
    root = {i: i for i in prints}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in ids}


def test_fingerprints_match_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        text = "".join(rng.choice(["A", "bé ", "c", "İ ", "\n", "  ", "\x1c", "Éa ", "\xa0"]) for _ in range(rng.randint(0, 60)))
        assert covering.fingerprint(text) % (1 << 64) == brute_print(text), text


def test_every_close_pair_agrees_under_some_mask():
    rng = random.Random(5)
    for family in range(3):
        masks = [m % (1 << 64) for m in covering.masks(4, family)]
        assert len(masks) == 31 and all(28 <= m.bit_count() <= 36 for m in masks)
        for _ in range(5000):
            unlike = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(unlike & m == 0 for m in masks)


def test_trees_join_the_parts_of_every_bucket():
    rng = random.Random(6)
    for _ in range(100):
        n, base = rng.randint(1, 60), rng.getrandbits(64)
        prints = [(base if rng.random() < 0.8 else rng.getrandbits(64)) ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 6))) for _ in range(n)]
        bucket = np.sort(np.array([rng.randrange(4) for _ in range(n)]))
        a, b = covering.trees(np.array(prints, np.uint64), bucket, 4)
        want = [brute_components({i: prints[i] for i in range(n) if bucket[i] == k}) for k in range(4)]
        parent = list(range(n))
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            assert x < y and parent[y] == y
            parent[y] = x

        def top(i):
            return i if parent[i] == i else top(parent[i])
        assert [top(i) for i in range(n)] == [want[bucket[i]][i] for i in range(n)]


@pytest.mark.parametrize("radius, limit", [(2, 16), (4, 1024)])
def test_components_of_fingerprints_equal_all_pairs(spark, radius, limit):
    """Families with chains, hot ones among them; a small limit deals buckets again and again."""
    rng = random.Random(7)
    prints = []
    for _ in range(12):
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 5, 150])):
            prints.append(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, radius + 1))))
            if rng.random() < 0.1:
                x = prints[-1]
    prints = dict(enumerate(dict.fromkeys(prints)))
    nodes = spark.createDataFrame([(p - (1 << 64) * (p >> 63), i) for i, p in prints.items()], "fp long, first long")
    links = covering.links(nodes, radius, limit).collect()
    parent = {i: i for i in prints}

    def top(i):
        return i if parent[i] == i else top(parent[i])
    for a, b in links:
        x, y = sorted((top(a), top(b)))
        parent[y] = x
    assert {i: top(i) for i in prints} == brute_components(prints, radius)
    with pytest.raises(ValueError):
        covering.links(nodes, radius, 4)


def test_similar_documents(spark, tmp_path):
    rng = random.Random(8)
    text = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    base = [text(400) for _ in range(6)]
    texts = base + [" ".join([*b.split()[:-1], "changed"]) for b in base[:4]] + [None, "", " \n", "one", "one", "ONE", base[0], "a " * 300_000, "é" * 900_000]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)]
    rows += [rows[2], (None, base[1], "en", "s", 1), (None, "nobody else's words at all", "en", "s", 1)]
    got = on_documents(spark, queries.op11_covering_simhash, table(spark, rows), tmp_path)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = {i: brute_print(t) for i, t in enumerate(texts) if i < len(texts) - 2}
    prints |= {i: int(r["fingerprint"], 16) for r in got.collect() if (i := r["doc_id"]) is not None and i >= len(texts) - 2}
    want = brute_components(prints)
    assert want[10] == want[11] == want[12] == 10 and want[15] == want[13] and want[16] == 0
    same_rows(got.where("doc_id is not null").collect(), [(i, f"{prints[i]:016x}", want[i]) for i in [*prints, 2]])
    assert sorted((r["component_id"] is None, r["component_id"]) for r in got.where("doc_id is null").collect()) == [(False, 1), (True, None)]
    assert covering.similar(table(spark, rows).limit(0)).count() == 0


# periodic runs

def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i < len(w) - q:
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i < len(w) - q and w[i] == w[i + q]:
                i += 1
            if i - s + q >= max(12, 2 * q):
                found.setdefault((s, i - s + q), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def some_words(rng):
    n, k = rng.choice([0, 1, 12, 13, 30, 60, 150, 300]), rng.choice([1, 2, 3, 5, 20, 200])
    w = []
    while len(w) < n:
        if rng.random() < 0.4:
            w += [rng.randrange(k) for _ in range(rng.randint(1, 30))]
        else:
            p = [rng.randrange(k) for _ in range(rng.randint(1, rng.choice([3, 10, 40, 70])))]
            w += p * rng.randint(1, 6) + p[:rng.randint(0, len(p))]
    return [f"w{x}" for x in w[:n]]


def test_runs_match_brute_force():
    rng = random.Random(9)
    for _ in range(40):
        many = [some_words(rng) for _ in range(20)]  # several texts at once: no run crosses a border
        for w, (n, runs, collapsed) in zip(many, periodic.text_runs([" ".join(w) for w in many]), strict=True):
            want = brute_runs(w)
            assert n == len(w) and [tuple(r) for r in runs.tolist()] == want
            gone = {i for s, length, q in want for i in range(s + q, s + length)}
            assert collapsed == " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_hard_texts():
    x, y = "a", "ab"
    while len(y) < 3000:
        x, y = y, y + x
    for w in (list(y), ["a"] * 3000, [c for k in range(40) for c in "a" * (40 + k) + "b"],
              [f"u{k + j}" for k in range(200) for j in range(2)] * 2,
              [c for k in range(300) for c in (f"u{k}", f"u{k + 1}", *"abcdefghij")]):
        (_, runs, _), = periodic.text_runs([" ".join(w)])
        assert [tuple(r) for r in runs.tolist()] == brute_runs(w)


def test_splitting_is_stable():
    """What is left holds every word twice in its segment, and cuts no run."""
    rng = random.Random(10)
    for _ in range(200):
        w = some_words(rng)
        a, _, _ = periodic.numbered([" ".join(w)])
        left = periodic.survivors(a)
        segments = re.findall("1+", "".join("01"[int(x)] for x in left))
        assert all(len(s) >= 12 for s in segments)
        at = np.flatnonzero(left)
        for part in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1):
            assert all((a[part] == a[i]).sum() >= 2 for i in part)
        assert all(left[s:s + length].all() for s, length, _ in brute_runs(w))


def test_runs_of_very_long_texts():
    rng = random.Random(11)
    part = [f"p{rng.randrange(50)}" for _ in range(5000)]
    w = [f"x{k}" for k in range(200_000)] + part * 3 + ["ab"] * 300_000
    text = " ".join(w)
    assert len(text) > 2 * periodic.CHUNK and len(list(periodic.chunks(text))) > 1
    (n, runs, collapsed), = periodic.text_runs([text])
    assert n == len(w) and (200_000, 15_000, 5000) in map(tuple, runs.tolist()) and (215_000, 300_000, 1) in map(tuple, runs.tolist())
    assert len(collapsed.split()) == n - 10_000 - 299_999
    unspaced = "é" * (3 * periodic.CHUNK)
    assert list(periodic.chunks(unspaced)) == [unspaced]
    (n, runs, collapsed), = periodic.text_runs([unspaced])
    assert (n, len(runs), collapsed) == (1, 0, unspaced)


def test_runs_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(12)
    texts = [" ".join(some_words(rng)) for _ in range(80)] + [None, "", " \t\n", "one", "É  é x\nÉ"]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 1), (None, "a " * 20, "en", "s", 1)]
    got = on_documents(spark, queries.op13_periodic_runs, table(spark, rows), tmp_path)
    want, planted = [], 0
    for doc_id, text, *_ in rows:
        w = words_of(text)
        n, h = len(w), zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            planted += 1
        runs = brute_runs(w)
        best = min(((-length, s, q) for s, length, q in runs), default=None)
        first = (best[1], -best[0], best[2], -1000 * best[0] // best[2]) if best else (None,) * 4
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((doc_id, len(runs), *first, sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
                     sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    assert planted >= 3 and got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    same_rows(got.collect(), want)
    assert periodic.periodic_runs(table(spark, rows).limit(0)).count() == 0
