"""Each operator against a brute-force version, an exact round trip or held-out
labels, with nulls, empty and long texts, ties, repeated rows, empty tables and
clashing column names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pitchlens.llm import (
    chat, decontam, encode, neardup, pii, pieces, quality, sharding, substrings, tokencount, toxicity,
)

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n, alphabet="abcdefghij"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def docs(spark, texts, **more):
    rows = [(i, t, "en", "s", len(t) if t is not None else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + more.get("extra", []), DOC).repartition(3)


def clashing(df):
    """More columns, named like what the operators add."""
    return df.withColumns({c: F.lit(1) for c in ("row", "key", "node", "kept", "spans", "items", "n_words", "class_id", "found", "class")})


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(5)
    texts = [words(rng, rng.choice([1, 3, 40, 120])) for _ in range(40)]
    texts += [None, "", " ", "\n\n", texts[3], texts[3], words(rng, 4000), "é" * 300]
    return docs(spark, texts, extra=[(3, texts[3], "en", "s", 1), (None, texts[4], None, None, None)])


# sharding

def test_sharding_places_every_record_and_evens_bytes(spark, mixed):
    got = sharding.shard_records(clashing(mixed), 4, n_slots=64).collect()
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in mixed.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


def test_sharding_near_equal_on_many_records(spark):
    rng = random.Random(1)
    df = docs(spark, ["x" * rng.randint(1, 400) for _ in range(3000)])
    loads = Counter()
    for r in sharding.shard_records(df, 8).collect():
        loads[r["shard"]] += r["size"]
    assert len(loads) == 8 and max(loads.values()) <= 1.01 * min(loads.values())


def test_sharding_spreads_a_record_that_repeats(spark):
    """A third of all rows are one record: bytes stay near equal, and every copy is placed."""
    rng = random.Random(4)
    one = (7, "x" * 50, "en", "s", 50)
    df = docs(spark, ["y" * rng.randint(20, 80) for _ in range(20_000)], extra=[one] * 10_000)
    loads, slots = Counter(), defaultdict(list)
    for r in sharding.shard_records(df, 8).collect():
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert max(loads.values()) <= 1.01 * min(loads.values())
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and sum(map(len, slots.values())) == 30_000


def test_rebalancing_moves_whole_slots_and_keeps_most(spark, mixed, tmp_path):
    path, last = sharding.stored_map(sharding.sized_records(mixed, 64), 4, 64, str(tmp_path / "map"))
    first, second = (spark.read.parquet(f"{path}/v{k}").collect() for k in (0, last))
    assert {r["virtual_slot"] for r in first} == {r["virtual_slot"] for r in second} == set(range(64))
    assert {r["version"] for r in second} == {1}
    assert sum(r["bytes"] for r in first) == sum(r["bytes"] for r in second)


def test_sharding_of_an_empty_table(spark, mixed):
    assert sharding.shard_records(mixed.limit(0), 4, 16).count() == 0


# quality

def brute_stats(text):
    w = re.findall("[^\x20\x09-\x0d]+", text)
    tri = Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for k in range(len(w) - 2):
        if tri[tuple(w[k:k + 3])] > 1:
            hit |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in text), dup, len(hit)


def test_quality_statistics_match_brute_force():
    rng = random.Random(2)
    for _ in range(400):
        text = "".join(rng.choice(["a", "b ", "a b ", "\n", "\t", "#", " |", "a b a\n", "\x1c", "É"]) for _ in range(rng.randint(0, 60)))
        assert quality.text_stats(text)[:5] == brute_stats(text), text


def test_decision_list_learns_thresholds_and_equals_its_expression(spark):
    rng = random.Random(3)
    good = [words(rng, 80, "abcdefghijklmnop") for _ in range(60)]
    bad = [words(rng, 80, "abcdefgh#$%*&<") for _ in range(60)]
    df = docs(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)], "doc_id long, quality int, toxic int")
    rules = quality.learn_from(df, labels)
    assert rules.rules and "symbol_share" in str(rules)
    out = quality.judged(df, rules)
    rows = out.select(F.col("row.doc_id").alias("doc_id"), "kept", *[quality.feature(n).alias(n) for n in quality.FEATURES]).collect()
    assert all(r["kept"] == (r["doc_id"] < 60) for r in rows)
    x = np.array([[r[n] if n != "n_words" else r["n_words"] for n in quality.FEATURES] for r in rows], float)
    assert [bool(v) for v in rules.keeps(x)] == [r["kept"] for r in rows]


def test_quality_edge_cases(spark, mixed):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.learn_from(mixed, none).rules == []
    many = clashing(mixed)
    kept = quality.keep_good(many, none)
    assert kept.columns == many.columns
    # without labels only the base rule rejects
    want = sum(brute_stats(r["text"] or "")[0] >= 50 and 2 * brute_stats(r["text"] or "")[4] <= brute_stats(r["text"] or "")[0]
               for r in mixed.collect())
    assert kept.count() == want
    assert quality.keep_good(many.limit(0), none).count() == 0


# near duplicates

def brute_classes(rows, idf):
    sets = {i: neardup.weights(t, idf) if t else ([], []) for i, t in rows}
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = [i for i, _ in rows if len(sets[i][0])]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if neardup.weighted_jaccard(sets[a], sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i, _ in rows}


def near_copies(rng, n_groups, copies, size=150):
    out = []
    for _ in range(n_groups):
        w = words(rng, size).split()
        for _ in range(copies):
            v = list(w)
            for _ in range(rng.randint(0, 2)):
                v[rng.randrange(len(v))] = "x" + str(rng.random())[2:6]
            out.append(" ".join(v))
    return out


@pytest.mark.parametrize("bucket", [neardup.BUCKET, 3])  # 3: every larger bucket is split by second bands
def test_near_duplicates_match_all_pairs(spark, bucket):
    rng = random.Random(7)
    passage = words(rng, 60)
    texts = near_copies(rng, 6, 5) + [f"{words(rng, 60)} {passage} {words(rng, 60)}" for _ in range(15)]
    texts += ["one two", "one two", "one", None, "", " ", texts[0]]
    df = docs(spark, texts)
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(clashing(df), bucket=bucket).collect()}
    idf = neardup.inverse_frequencies(df)
    assert got == brute_classes(list(enumerate(texts)), idf)


def test_a_chain_of_near_copies_is_one_class(spark):
    """Neighbours are similar, the ends are not: links between members must not be lost."""
    rng = random.Random(21)
    w = words(rng, 150).split()
    texts = []
    for k in range(24):
        texts.append(" ".join(w))
        w[(k * 6) % 150] = f"y{k}"
    df = docs(spark, rng.sample(texts, len(texts)))
    got = {r["class_id"] for r in neardup.near_duplicates(df).collect()}
    assert got == {0}


def hidden_link(seed, fits):
    """Two similar texts whose samples and bands fit, each among 60 texts that are just
    below 0.8 of it and less of all others."""
    rng = random.Random(seed)
    base = words(rng, 300).split()
    assert len(base) == 300

    def edited(edits, of=base):
        v = list(of)
        for k in rng.sample(range(1, 49), edits):
            v[6 * k] = "q" + str(rng.random())[2:8]
        return " ".join(v)

    def sampled(texts):
        doc, s, n = neardup.shingle_counts(texts)
        return neardup.samples(doc, s, n.astype(np.float32))

    first = sampled([" ".join(base)])
    for _ in range(40):
        some = [edited(6) for _ in range(200)]
        drawn = sampled(some)
        agree = ((drawn & np.uint64(255)) == (first & np.uint64(255))).sum(1)
        shared = (neardup.bands(drawn) == neardup.bands(first)).sum(1)
        at = [i for i in range(200) if fits(agree[i], shared[i])]
        if at:
            family = [[edited(7, of) for _ in range(60)] for of in (base, some[at[0]].split())]
            return [*family[0], " ".join(base), some[at[0]], *family[1]]
    raise AssertionError("none found")


def check_hidden_link(spark, monkeypatch, texts, **more):
    idf = np.ones(neardup.FEATURES, np.float32)
    monkeypatch.setattr(neardup, "inverse_frequencies", lambda _: idf)
    want = brute_classes(list(enumerate(texts)), idf)
    assert len(set(want.values())) == len(texts) - 1
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs(spark, texts), **more).collect()}
    assert got == want


def test_a_link_ranked_behind_many_failing_pairs_is_found(spark, monkeypatch):
    texts = hidden_link(41, lambda agree, shared: neardup.LEAST_AGREEING <= agree <= 24 and shared)
    check_hidden_link(spark, monkeypatch, texts)


def test_a_link_within_one_large_bucket_is_found(spark, monkeypatch):
    texts = hidden_link(43, lambda agree, shared: agree >= neardup.LEAST_AGREEING and shared == 1)
    check_hidden_link(spark, monkeypatch, texts, bucket=8)


def family(seed, n, edits, size=300):
    """Texts that are each a base with some words replaced: all about equally alike."""
    rng = random.Random(seed)
    base = words(rng, size).split()
    out = []
    for _ in range(n):
        v = list(base)
        for k in rng.sample(range(1, size // 6), edits):
            v[6 * k] = "q" + str(rng.random())[2:8]
        out.append(" ".join(v))
    return out


@pytest.fixture()
def stored_rows(monkeypatch):
    """Rows of the largest table stored under each name; all shingles weigh the same."""
    rows, stored = {}, neardup.stored

    def counted(df, tag):
        out = stored(df, tag)
        rows[tag] = max(rows.get(tag, 0), out.count())
        return out

    monkeypatch.setattr(neardup, "stored", counted)
    monkeypatch.setattr(neardup, "inverse_frequencies", lambda _: np.ones(neardup.FEATURES, np.float32))
    return rows


def test_stored_rows_stay_in_proportion_to_a_family_just_below_the_limit(spark, stored_rows):
    """Its agreeing pairs grow with the square of its size, 19,900 here; none may leave its task."""
    n = 200
    texts = family(51, n, 8)
    sets = [set(neardup.shingle_counts([t])[1].tolist()) for t in texts]
    alike = [len(a & b) / len(a | b) for i, a in enumerate(sets) for b in sets[:i]]
    assert sum(x >= 0.5 for x in alike) == len(alike) == 19_900
    assert len({r["class_id"] for r in neardup.near_duplicates(docs(spark, texts)).collect()}) > n / 2
    assert max(stored_rows.values()) <= n * neardup.BANDS, stored_rows


def test_the_pipelines_near_dedup_keeps_stored_rows_in_proportion(spark, stored_rows):
    n = 150
    texts = family(57, n, 8)
    kept = corpus_pipeline.near_dedup(spark, docs(spark, texts), "").collect()
    want = brute_classes(list(enumerate(texts)), np.ones(neardup.FEATURES, np.float32))
    assert {r["doc_id"] for r in kept} == set(want.values())
    assert max(stored_rows.values()) <= n * neardup.BANDS, stored_rows


def test_links_and_classes_are_the_same_however_blocks_are_dealt(spark):
    texts = family(52, 60, 6) + family(53, 40, 5) + near_copies(random.Random(54), 3, 4)
    rows = []
    for more in ({}, {"bucket": 5}, {"block_bytes": 10_000}):
        found = neardup.classes(docs(spark, texts), **more)
        rows.append(sorted(map(tuple, found.select("class_id", "copies", "links", "class_size").collect())))
    assert rows[0] == rows[1] == rows[2]
    assert any(r[2] for r in rows[0])


def test_one_text_against_all_its_partners_equals_pair_by_pair():
    rng = random.Random(55)
    texts = family(56, 12, 6) + ["a b a b a b a b a b a b", "a b a b a b a b a b", "one two", "one two three"]
    texts += [words(rng, 30, "ab") for _ in range(10)]
    idf = (0.75 + 0.25 * np.random.default_rng(3).random(neardup.FEATURES)).astype(np.float32)
    sets = [neardup.weights(t, idf) for t in texts]
    x, y = (np.array(c) for c in zip(*[(i, j) for i in range(len(texts)) for j in range(len(texts)) if i != j], strict=True))
    whole = [neardup.weighted_jaccard(sets[i], sets[j]) for i, j in zip(x, y, strict=True)]
    for limit in (0.8, 0.5, *whole[::40]):  # each value itself is reached, too
        assert neardup.similar(texts, x, y, idf, limit).tolist() == [w >= limit for w in whole]


def test_a_forest_joins_what_the_links_join():
    rng = np.random.default_rng(4)
    a, b = rng.integers(0, 60, (2, 50))
    a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]

    def parts(links):
        label = list(range(60))
        for _ in range(60):
            for i, j in links:
                label[i] = label[j] = min(label[i], label[j])
        return label

    some = neardup.forest(a, b)
    whole = parts(list(zip(a.tolist(), b.tolist(), strict=True)))
    assert parts(some) == whole and len(some) == 60 - len(set(whole))


def test_few_links_are_rejected_by_their_sketches():
    n, p = neardup.ROWS * neardup.BANDS, neardup.SIMILARITY
    assert sum(math.comb(n, k) * p**k * (1 - p)**(n - k) for k in range(neardup.LEAST_AGREEING)) < 1e-5


def test_one_per_class_keeps_the_smallest_id(spark, mixed):
    many = clashing(mixed)
    kept = neardup.one_per_class(many)
    assert kept.columns == many.columns
    rows = kept.collect()
    texts = Counter(r["text"] for r in rows if r["text"] and r["text"].split())
    assert max(texts.values()) == 1
    assert sum(r["text"] is None for r in rows) == 1 and "" in {r["text"] for r in rows}
    assert neardup.one_per_class(many.limit(0)).count() == 0


def test_consistent_samples_agree_as_often_as_the_similarity():
    rng = np.random.default_rng(0)
    agree = []
    s = rng.integers(0, 2**63, 400).astype(np.uint64)
    s.sort()
    w = rng.gamma(2, 1, 400).astype(np.float32)
    for _ in range(60):
        v = w.copy()
        change = rng.random(400) < 0.2
        v[change] *= rng.uniform(0.1, 3, change.sum()).astype(np.float32)
        j = neardup.weighted_jaccard((s, w), (s, v))
        a = neardup.samples(np.zeros(400, int), s, w, 300)
        b = neardup.samples(np.zeros(400, int), s, v, 300)
        agree.append((a == b).mean() - j)
    assert abs(np.mean(agree)) < 0.03


# token counts and encoding

@pytest.fixture(scope="module")
def library_unigram():
    """The SentencePiece library's own unigram encoder over the same pieces and scores."""
    import sentencepiece
    model_pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = model_pb2.ModelProto()
    with open(pieces.DEFAULT_MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    lowest = min(p.score for p in proto.pieces if p.type == 1 and p.score > pieces.PLACEHOLDER)
    for p in proto.pieces:
        if p.type == 1 and p.score < pieces.PLACEHOLDER:
            p.score = lowest - 1
    proto.trainer_spec.model_type = 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())


def sample_texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").limit(80).collect()
    return [r["text"][:800] for r in rows] + ["", " ", "a  b   c", "\n\nx\ty", "日本語 ❶ 😀", "zzzz" * 30, "  both ends  "]


def test_tokens_equal_the_librarys_unigram_encoder(spark, library_unigram):
    for t in sample_texts(spark):
        want = library_unigram.encode(t)
        assert encode.encode_text(t) == want
        assert tokencount.count_tokens(t) == len(want)
        assert encode.decode_ids(want) == t


def test_encoding_and_counting_of_a_table(spark, mixed):
    got = encode.encoded(clashing(mixed)).collect()
    counted = tokencount.with_token_counts(clashing(mixed)).collect()
    assert len(got) == len(counted) == mixed.count()
    assert all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in got)
    assert Counter((r["doc_id"], r["n_tokens"]) for r in got) == Counter((r["doc_id"], r["n_tokens"]) for r in counted)
    want = Counter(hashlib.sha256((r["text"] or "").encode()).hexdigest() for r in mixed.collect())
    assert Counter(r["text_sha256"] for r in got) == want
    assert encode.encoded(mixed.limit(0)).count() == tokencount.with_token_counts(mixed.limit(0)).count() == 0


# personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute_base(t):
    only = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 12 <= len(only(m.group())) <= 19 and pii.luhn(only(m.group()))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(only(m.group())) <= 15]
    return sorted(out)


def test_base_spans_match_the_plain_patterns():
    rng = random.Random(9)
    for _ in range(8000):
        t = "".join(rng.choice(rng.choice(["0123456789. ", "a@.b-", "+ 12()-", "a@.-+ 0123456789()"])) for _ in range(rng.randint(0, 45)))
        assert pii.base_spans(t) == brute_base(t), t


def test_base_spans_of_long_runs_take_linear_time():
    for t in ("1" * 200_000, "a" * 200_000, "1." * 100_000, "a@" * 50_000, "+1(" * 60_000, "a1" * 100_000):
        pii.candidates(t, pii.base_spans(t))


def test_patterns_find_unseen_identifiers(spark):
    rng = random.Random(4)
    key = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts = [f"{words(rng, 20)} api token = {key(40)} {words(rng, 5)}" for _ in range(20)]
    texts += [f"{words(rng, 20)} api token = ZX{rng.randint(10**9, 10**10)}q {words(rng, 5)}" for _ in range(3)]
    texts += [f"{words(rng, 20)} version build{rng.randint(1000, 9999)}x {words(rng, 5)}" for _ in range(20)]
    texts += [None, "", "write to a.b@c.de or 10.0.0.1"]
    texts += [f"+1 (234) 555-{k:04d} {words(rng, 5)}" for k in range(20)] + [f"12345678{k}2345678 x" for k in range(3)]
    got = {r["doc_id"]: r for r in pii.report(clashing(docs(spark, texts))).collect()}
    for i, t in enumerate(texts):
        base = pii.rendered(brute_base(t or ""))
        assert got[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
    for i in range(23):
        at = texts[i].index("token = ") + 8
        assert f"secret:{at}:{texts[i].index(' ', at)}" in got[i]["spans"].split(",")
    assert all(got[i]["spans"] == "" for i in range(23, 45))
    assert all(got[i]["spans"] == pii.rendered(brute_base(t)) for i, t in enumerate(texts) if i > 45)  # a text's start teaches nothing
    assert got[45]["spans"] == "email:9:17,ip:21:29"


def test_patterns_are_learned_many_steps_from_a_seed(spark):
    """Five patterns, each of which shares its instances with the next only."""
    rng = random.Random(21)
    token = lambda: f"ZX{rng.randint(10**9, 10**10)}q"
    texts = [f"{words(rng, 3)} hop zero {''.join(rng.choice('abcdef77') for _ in range(40))} {words(rng, 3)}" for _ in range(120)]
    known, fresh = [], [token() for _ in range(8)]
    texts += [f"{words(rng, 3)} hop zero {x} {words(rng, 3)}" for x in fresh]
    for name in ("one", "two", "three", "four"):
        known, fresh = fresh, [token() for _ in range(8)]
        texts += [f"{words(rng, 3)} hop {name} {x} {words(rng, 3)}" for x in known for _ in range(15)]
        texts += [f"{words(rng, 3)} hop {name} {x} {words(rng, 3)}" for x in fresh]
    learnt = len(texts)
    texts += [f"{words(rng, 3)} serial number {token()} {words(rng, 3)}" for _ in range(30)]
    got = {r["doc_id"]: r["spans"] for r in pii.report(docs(spark, texts)).collect()}
    for i, t in enumerate(texts):
        at = t.find("hop ")
        start = t.index(" ", at + 4) + 1
        assert got[i] == (f"secret:{start}:{t.index(' ', start)}" if i < learnt else ""), t
    # a long token before doesn't change the pattern of a place
    assert pii.context("x " + "y" * 500 + " a b=Z", 507, pii.token_places("x " + "y" * 500 + " a b=Z")) == "y" * 80 + "\x1fa\x1fb="
    assert pii.context("Z", 0, [(0, 1)]) == "\x1f\x1f" and pii.context("a Z", 2, [(0, 1), (2, 3)]) == "\x1fa\x1f"


def test_redaction(spark, mixed):
    many = clashing(mixed.unionByName(docs(spark, ["mail a@b.cd now +1 (234) 555-0123 x", "x"])))
    out = pii.redacted(many)
    assert out.columns == many.columns
    rows = out.collect()
    assert "mail <email> now <phone> x" in {r["text"] for r in rows} and len(rows) == many.count()
    assert pii.redacted(many.limit(0)).count() == 0 and pii.report(many.limit(0)).count() == 0


# toxicity

def brute_segments(scores):
    def split(lo, hi):
        best = None
        for i in range(lo, hi):
            t = 0.0
            for j in range(i, hi):
                t += scores[j]
                if t > 1e-12 and (best is None or t > best[0] + 1e-12):
                    best = (t, i, j + 1)
        return [] if best is None else [*split(lo, best[1]), best, *split(best[2], hi)]

    return split(0, len(scores))


def test_segments_match_the_recursive_definition():
    rng = random.Random(6)
    for _ in range(1500):
        n = rng.randint(0, 14)
        places = sorted(rng.sample(range(n), rng.randint(0, n)))
        values = [rng.uniform(-1, 3) for _ in places]
        scores = [-0.5] * n
        for p, v in zip(places, values):
            scores[p] = v
        rounded = lambda a: [(round(s, 6), x, y) for s, x, y in a]
        assert rounded(toxicity.segments(places, values, n, -0.5)) == rounded(brute_segments(scores))


def test_toxicity_on_held_out_rows(spark):
    base = "/root/testdata/sf0.1"
    df, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(df, labels)
    rows = toxicity.scored(df, model).join(labels, "doc_id").where("held_out").select("toxic", "predicted").collect()
    by = Counter((r["toxic"], r["predicted"]) for r in rows)
    assert by[1, 1] / (by[1, 1] + by[1, 0]) > 0.85 and by[1, 1] / (by[1, 1] + by[0, 1]) > 0.85


@pytest.mark.parametrize("edited", [False, True])
def test_copies_of_a_toxic_text_neither_take_nor_make_terms(spark, edited):
    rng = random.Random(31)
    plain = [words(rng, 1) for _ in range(400)]
    text = lambda *more: " ".join(rng.sample([*rng.sample(plain, 40), *more], 40 + len(more)))
    copied = "you utter zzidiot and zzmoron with your zzlamp"
    texts = [text("zzidiot", "zzmoron") for _ in range(60)] + [text() for _ in range(600)]
    texts += [f"{copied} {plain[i % 400]} {i}" if edited else copied for i in range(3000)]
    toxic = [1] * 60 + [0] * 600 + [1] * 3000
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int")
    known = toxicity.learn(docs(spark, texts), labels).scores
    assert {"zzidiot", "zzmoron"} <= set(known) and not {"zzlamp", "utter"} & set(known)


def test_a_lexicon_is_never_cut(spark):
    base = "/root/testdata/sf0.01"
    df, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    n = len(toxicity.learn(df, labels).scores)
    assert len(toxicity.learn(df, labels, max_terms=n).scores) == n > 10
    with pytest.raises(ValueError):
        toxicity.learn(df, labels, max_terms=n - 1)


def test_toxicity_edge_cases(spark, mixed):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.scored(clashing(mixed), toxicity.learn(clashing(mixed), none)).collect()
    assert len(rows) == mixed.count() and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in rows)
    held = {r["doc_id"]: r["held_out"] for r in rows}
    assert all(h == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, h in held.items())
    assert toxicity.scored(mixed.limit(0), toxicity.Model({})).count() == 0


# chat formatting

def test_any_conversation_comes_back():
    rng = random.Random(1)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", " ", "\\", "<|end|>", "<|user|>", "a", "\n", "</s\\>", "[INST\\\\]", "<|", "|>", "é", ""]
    for _ in range(5000):
        conv = [(rng.choice(["user", "assistant", "system", "", "end", "a|b", "%55", "x\\"]),
                 "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for _ in range(rng.randint(0, 4))]
        turns = [chat.render_turn(*c) for c in conv]
        assert chat.parse("".join(t for t, _, _ in turns)) == conv
        for (role, text), (t, a, b) in zip(conv, turns):
            assert chat.unescape(t[a:b]) == (text if role == "assistant" else "")


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s> x"), (2, 0, None, None), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"),
            (None, None, "user", ""), (3, 1, "assistant", "b"), (3, 0, "user", "c")] + [(4, k, "assistant", "z" * k) for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("rendered", F.lit(0)).repartition(4)
    by = defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((t is not None, t, r or "", x or ""))
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(df)).collect()}
    assert got.keys() == by.keys()
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{x}\n" for _, _, r, x in turns)
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(turns), len(loss))
        assert got[c]["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c]["formatted_chars"] == sum(len(chat.render_turn(r, x)[0]) for _, _, r, x in turns)
    assert chat.digests(chat.formatted(df.limit(0))).count() == 0


# repeated substrings

def brute_removal(rows, length, keep):
    places = defaultdict(list)
    for d, t in rows:
        raw = (t or "").encode()
        for k in range(len(raw) - length + 1):
            places[raw[k:k + length]].append((d, k))
    out = {}
    for d, t in rows:
        raw = (t or "").encode()
        hit = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            found = places[raw[k:k + length]]
            if (len(found) > 1) if keep == "none" else (min(found) < (d, k)):
                hit[k:k + length] = b"\1" * length
        runs = sum(1 for i, h in enumerate(hit) if h and (i == 0 or not hit[i - 1]))
        left = bytes(b for b, h in zip(raw, hit) if not h)
        out[d] = (len(raw), sum(hit), runs, hashlib.sha256(left).hexdigest())
    return out


@pytest.mark.parametrize("length,gram,group,keep", [(40, 20, 512, "none"), (40, 20, 2, "none"), (64, 10, 3, "first")])
def test_removed_bytes_match_brute_force(spark, length, gram, group, keep):
    rng = random.Random(3)
    vocabulary = words(rng, 300, "abcdé").split()
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    passages = [text(40) for _ in range(4)]
    rows = [(i, " ".join(rng.choice(passages)[rng.randint(0, 40):] if rng.random() < 0.4 else text(rng.randint(0, 30))
                         for _ in range(rng.randint(0, 5)))) for i in range(80)]
    rows += [(500, None), (501, ""), (502, "ab" * 300), (503, rows[9][1]), (504, "é" * 100)]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.removal_report(df, length, keep, gram, group).collect()}
    assert got == brute_removal(rows, length, keep)


def test_repeated_rows_and_empty_tables(spark):
    text = "".join(random.Random(8).choice("abc") for _ in range(200))
    df = spark.createDataFrame([(1, text, 5), (1, text, 5), (None, text, 5), (2, "x" * 39, 5)], "doc_id long, text string, raw int")
    assert sorted(r["n_removed"] for r in substrings.removal_report(df, 40).collect()) == [0, 200, 200, 200]
    assert substrings.removal_report(df.limit(0), 40).count() == 0
    left = substrings.deduplicated(df, 40)
    assert left.columns == df.columns and left.count() == 4


# decontamination

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_hits(texts, items):
    find = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+").findall
    windows = defaultdict(set)
    for i, t in items:
        w = find((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k:k + 10])].add(i)
    out = []
    for t in texts:
        w = find((t or "").translate(LOWER))
        hit, found = [False] * len(w), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if s := windows.get(tuple(w[k:k + size])):
                    found |= s
                    hit[k:k + size] = [True] * size
        out.append((len(w), sum(hit), sorted(found)))
    return out


def shard(texts, items):
    counts, spans, found = decontam.shard_hits([(t or "").encode() for t in texts], decontam.phrases_of(items))
    return [(int(n), sum(s[1] - s[0] for s in a), sorted(f)) for n, a, f in zip(counts, spans, found)]


def test_index_finds_what_brute_force_finds(monkeypatch):
    rng = random.Random(0)
    for trial in range(150):
        monkeypatch.setattr(decontam, "PIECE_BYTES", rng.choice([20, 4 << 20]))
        texts = [" ".join(rng.choice(["a", "b", "Aé", "c-d", "1"]) for _ in range(rng.choice([0, 1, 5, 30, 200]))) for _ in range(rng.randint(1, 6))]
        items = [(str(k), rng.choice(["", "a", "a b", " ".join(rng.choice("ab") for _ in range(12)), texts[0][3:60]]))
                 for k in range(rng.randint(0, 4))]
        assert shard(texts, items) == brute_hits(texts, items), (texts, items)


def test_report_and_clean(spark, mixed):
    rng = random.Random(12)
    item = words(rng, 14)
    texts = [f"{words(rng, 20)} {item.upper()} {words(rng, 10)}", item, words(rng, 30)]
    df = clashing(mixed.unionByName(docs(spark, texts).withColumn("doc_id", F.col("doc_id") + 100)))
    bench = spark.createDataFrame([("q1", item), ("q0", item), ("q2", None), (None, "")], "item_id string, text string")
    for block_bytes in (1 << 20, 40):  # one block of items, or several
        found = decontam.find_contamination(df, bench, block_bytes=block_bytes)
        assert {r["row"]["doc_id"]: r["items"] for r in found.collect() if r["items"]} == {100: ["q0", "q1"], 101: ["q0", "q1"]}
    rows = {r["doc_id"]: r for r in decontam.report(df, bench).where("doc_id >= 100").collect()}
    assert (rows[100]["n_hit"], rows[100]["n_items"], rows[100]["contaminated"]) == (14, 2, True)
    assert rows[100]["items_sha256"] == hashlib.sha256(b"q0,q1").hexdigest()
    assert rows[102]["items_sha256"] == hashlib.sha256(b"").hexdigest()
    out = decontam.clean(df, bench)
    assert out.columns == df.columns and out.count() == df.count() - 1
    assert decontam.report(out, bench).where("contaminated").count() == 0
    changed = out.where("doc_id = 100").first()
    assert changed["n_chars"] == len(changed["text"]) and changed["text"].split() == texts[0].lower().split()[:20] + texts[0].split()[-10:]
    assert decontam.report(df.limit(0), bench).count() == 0
    assert decontam.report(df, bench.limit(0)).where("contaminated").count() == 0
