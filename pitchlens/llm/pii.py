"""Personal data: shapes as seeds, and patterns learned from their contexts.

Base kinds are found by their shape (e-mail, IP, card and phone numbers).  In
addition unseen identifiers are found by bootstrapping:

1. Every identifier-like token outside the base spans is a *candidate*; its
   lexical pattern is the two tokens before it and what is glued to it, of each the
   last ``TAIL`` characters.  Base entities count as instances of their patterns
   too.  Seed instances are the base entities and long hexadecimal keys.
2. (pattern, instance) edges with their counts are aggregated over the corpus.
   Spark scores the graph iteratively: a pattern's confidence is the share of
   its occurrences whose instances are trusted, shrunk by ``SHRINK``; an
   instance is trusted as much as its best pattern, and takes its kind from it.
   Seeds stay at 1.  A pattern's kind is that of most of its seeds, or else of most
   of its trusted instances.
3. Patterns of at least ``LEAST_SUPPORT`` different instances and
   ``LEAST_CONFIDENCE`` are kept.  After ``ROUNDS`` rounds only kept patterns lend
   trust (a pattern's doubtful instances don't raise it any further), and rounds go
   on until none is added, so patterns are learned however many steps from a seed;
   every step loses some confidence.  Every candidate in a kept context is reported
   under the pattern's kind.

A pattern never gathers its instances in one place: edges, scores and finds are
aggregations and joins (a pattern with a third of all edges is a skewed join
side that splits).

Defined cases: null and empty texts have no spans; equal rows have equal spans;
rows without a doc_id are handled by their text; an empty table gives no rows;
further columns are carried by ``redacted`` whatever their names.  Spans are in
code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitchlens.llm.common import doc_key, map_batches, stored

#: kinds in the order ties are listed in; the last one is only found by patterns
KINDS = ("email", "ip", "card", "phone", "secret")
#: fixed shapes.  A digit run is only tried from its start: later starts fail alike.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile("[^\x20\x09-\x0d]+")
# identifier-like: at least 8 word characters, two digits or more among them
CANDIDATE = re.compile(r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/=-]*+[0-9][A-Za-z_+/=-]*+[0-9])[A-Za-z0-9_+/=-]{8,}+")
HEX_KEY = re.compile(r"[0-9a-f]{32,}")
SHRINK = 3.0
LEAST_SUPPORT, LEAST_CONFIDENCE, ROUNDS = 5, 0.6, 3
TAIL = 80  # characters of a token in a pattern


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches, found from each @ backward."""
    after = 0
    at = text.find("@")
    while at >= 0:
        first = at
        while first > after and text[first - 1] in LOCAL:
            first -= 1
        if first < at and (m := DOMAIN.match(text, at + 1)):
            yield first, m.end()
            after = m.end()
        at = text.find("@", max(at + 1, after))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, kind's place, end) of all base entities, in the order of the digest."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if not any(d in text for d in "0123456789"):
        return out
    out.extend((m.start(), 1, m.end()) for m in IP.finditer(text)
               if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split(".")))
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m.group()) if m.end() - m.start() <= 40 else ""
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out.extend((m.start(), 3, m.end()) for m in PHONE.finditer(text)
                   if 9 <= sum(map(str.isdigit, m.group())) <= 15)
    return sorted(out)


def context(text: str, start: int, tokens: list[tuple[int, int]]) -> str:
    """The lexical pattern before a place: the two tokens before, lower case, and
    what stands between the last white space and the place; ``tokens`` are the text's."""
    k = bisect_left(tokens, (start, start)) - 1  # the last token that begins before
    glued = ""
    if k >= 0 and tokens[k][1] >= start:
        glued, k = text[max(tokens[k][0], start - TAIL):start], k - 1
    before = [text[max(a, b - TAIL):b] for a, b in tokens[max(0, k - 1):k + 1]]
    return "\x1f".join([*([""] * (2 - len(before))), *before, glued]).lower()


def token_places(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text)]


def candidates(text: str, base: list[tuple[int, int, int]], tokens: list[tuple[int, int]] | None = None) -> list[tuple[int, int, str, str]]:
    """(start, end, pattern, instance) of identifier-like tokens outside the base spans."""
    out = []
    at = 0
    if tokens is None:
        tokens = token_places(text)
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][2] <= m.start():
            at += 1
        if not any(s < m.end() and m.start() < e for s, _, e in base[at:at + 8]):
            out.append((m.start(), m.end(), context(text, m.start(), tokens), m.group()))
    return out


def rendered(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _occurrences(docs: DataFrame) -> DataFrame:
    """key, pattern, kind (null: a candidate), instance, start, end."""
    keyed = docs.where("text is not null").select(doc_key().alias("key"), "text")
    kind = keyed.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for i, text in enumerate(b.column(1).to_pylist()):
                base = base_spans(text)
                if not base and not CANDIDATE.search(text):
                    continue
                tokens = token_places(text)
                out.extend((i, context(text, a, tokens), KINDS[k], text[a:e], a, e) for a, k, e in base)
                out.extend((i, p, "secret" if HEX_KEY.fullmatch(x) else None, x, a, e)
                           for a, e, p, x in candidates(text, base, tokens))
            row, pattern, known, instance, start, end = zip(*out, strict=True) if out else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(row, pa.int64())), pa.array(pattern, pa.string()), pa.array(known, pa.string()),
                 pa.array(instance, pa.string()), pa.array(start, pa.int64()), pa.array(end, pa.int64())],
                names=["key", "pattern", "kind", "instance", "start", "end"])

    return map_batches(keyed, run, f"key {kind}, pattern string, kind string, instance string, start long, end long")


def learned_patterns(occurrences: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """pattern, kind, support, confidence of the trusted patterns."""
    edges = stored(occurrences.groupBy("pattern", "instance").agg(F.count("*").alias("n"), F.max("kind").alias("kind")),
                   "pii-edges")
    # a pattern needs LEAST_SUPPORT instances, whatever their scores: others can't become trusted
    # (nor can the start of a text, which has no tokens to tell contexts apart)
    able = (edges.where(F.translate("pattern", "\x1f", "") != "").groupBy("pattern")
            .agg(F.count("*").alias("support")).where(F.col("support") >= LEAST_SUPPORT))
    edges = stored(edges.join(able, "pattern"), "pii-edges")
    seeds = edges.where("kind is not null").groupBy("instance").agg(F.max("kind").alias("own"))

    def trusted(patterns: DataFrame | None) -> DataFrame:
        """instance, trust, own (its kind): seeds, and what occurs in the patterns."""
        if patterns is None:
            return seeds.withColumn("trust", F.lit(1.0))
        best = edges.join(patterns.select("pattern", "confidence", F.col("kind").alias("learned")), "pattern").groupBy("instance").agg(
            F.max("confidence").alias("trust"), F.max_by("learned", "confidence").alias("learned"))
        return best.join(seeds, "instance", "full").select(
            "instance", F.when(F.col("own").isNotNull(), 1.0).otherwise(F.col("trust")).alias("trust"), F.coalesce("own", "learned").alias("own"))

    def scored(trust: DataFrame) -> DataFrame:
        """pattern, kind, support, confidence."""
        weight = F.col("n") * F.coalesce("trust", F.lit(0.0))
        sums = edges.join(trust, "instance", "left").groupBy("pattern").agg(
            (F.sum(weight) / (F.sum("n") + SHRINK)).alias("confidence"), F.max("support").alias("support"),
            *[F.sum(F.when(F.col("kind") == k, F.col("n"))).alias(f"n_{k}") for k in KINDS],
            *[F.sum(F.when(F.col("own") == k, weight)).alias(f"w_{k}") for k in KINDS])
        best = F.array_max(F.array(*[F.struct(F.coalesce(f"n_{k}", F.lit(0)).alias("n"), F.coalesce(f"w_{k}", F.lit(0.0)).alias("w"),
                                              F.lit(k).alias("kind")) for k in KINDS]))
        return sums.withColumn("best", best).select(
            "pattern", F.when((F.col("best.n") > 0) | (F.col("best.w") > 0), F.col("best.kind")).alias("kind"), "support", "confidence")

    patterns = None
    for _ in range(rounds):
        patterns = stored(scored(trusted(patterns)), "pii-patterns")
    able = (F.col("confidence") >= LEAST_CONFIDENCE) & F.col("kind").isNotNull()
    kept = stored(patterns.where(able), "pii-kept")
    while True:
        more = stored(scored(trusted(kept)).where(able).join(kept.select("pattern"), "pattern", "left_anti"), "pii-more")
        if more.isEmpty():
            return kept
        kept = stored(kept.unionByName(more), "pii-kept")


def discovered(docs: DataFrame) -> DataFrame:
    """key, found (array of start, kind's place, end): candidates in trusted contexts,
    and the seed keys."""
    occurrences = stored(_occurrences(docs), "pii-occurrences")
    patterns = learned_patterns(occurrences).select("pattern", F.col("kind").alias("learned"))
    places = F.create_map(*[F.lit(x) for k, name in enumerate(KINDS) for x in (name, k)])
    new = (occurrences.where("kind is null or kind = 'secret'").join(patterns, "pattern", "left")
           .withColumn("kind", F.coalesce("kind", "learned")).where("kind is not null"))
    return new.groupBy("key").agg(F.collect_set(
        F.struct("start", F.element_at(places, F.col("kind")).cast("long").alias("kind"), "end")).alias("found"))


def _with_found(docs: DataFrame, *columns) -> DataFrame:
    found = discovered(docs)
    keyed = docs.select(*columns, doc_key().alias("own"))
    return keyed.join(found, keyed["own"].eqNullSafe(found["key"]), "left").drop("own", "key")


def report(docs: DataFrame) -> DataFrame:
    """Per document: counts per base kind, the digest of the base spans, all spans and their number."""
    id_kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", "text", doc_key().alias("own"))
    own = keyed.schema["own"].dataType.simpleString()

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans = [base_spans(t or "") for t in b.column(1).to_pylist()]
            counts = [[sum(s[1] == k for s in a) for a in spans] for k in range(4)]
            lines = [rendered(a) for a in spans]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), *(pa.array(c, pa.int64()) for c in counts), pa.array(lines, pa.string()),
                 pa.array([hashlib.sha256(x.encode()).hexdigest() for x in lines], pa.string())],
                names=["doc_id", "own", "n_email", "n_ip", "n_card", "n_phone", "base", "base_sha256"])

    counts = "n_email long, n_ip long, n_card long, n_phone long"
    every = map_batches(keyed, base, f"doc_id {id_kind}, own {own}, {counts}, base string, base_sha256 string")
    found = discovered(docs)
    # all spans by start, then kind as listed
    parsed = F.transform(F.filter(F.split("base", ","), lambda x: x != ""), lambda x: F.struct(
        F.split(x, ":")[1].cast("long").alias("start"),
        (F.array_position(F.array(*map(F.lit, KINDS)), F.split(x, ":")[0]) - 1).alias("kind"),
        F.split(x, ":")[2].cast("long").alias("end")))
    spans = F.array_sort(F.array_union(parsed, F.coalesce("found", F.array().cast("array<struct<start:bigint,kind:bigint,end:bigint>>"))))
    text = F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), (s["kind"] + 1).cast("int")), s["start"].cast("string"), s["end"].cast("string"))), ",")
    return every.join(found, every["own"].eqNullSafe(found["key"]), "left").select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", text.alias("spans"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_learned"), F.size(spans).cast("long").alias("n_spans"))


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets, with the
    columns of ``docs`` (``n_chars``, where there is one, is that of the new text)."""
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row")
    joined = _with_found(docs, row).select("row", "found")
    kind = joined.schema["row"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.column(0)
            t = rows.type
            at, n_at = t.get_field_index("text"), t.get_field_index("n_chars")
            texts, changed = rows.field(at).to_pylist(), {}
            for i, (text, found) in enumerate(zip(texts, b.column(1).to_pylist(), strict=True)):
                if text:
                    spans = sorted([*base_spans(text), *((s["start"], s["kind"], s["end"]) for s in found or ())])
                    if spans:
                        texts[i] = changed[i] = masked(text, spans)
            fields = [rows.field(k) for k in range(t.num_fields)]
            fields[at] = pa.array(texts, t[at].type)
            if n_at >= 0 and pa.types.is_integer(t[n_at].type):
                fields[n_at] = pa.array([len(changed[i]) if i in changed else n for i, n in enumerate(fields[n_at].to_pylist())], t[n_at].type)
            yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(fields, fields=[t[k] for k in range(t.num_fields)])], names=["row"])

    return map_batches(joined, run, f"row {kind}").select("row.*")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (sorted; those that overlap as one) replaced by its kind."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"<{KINDS[kind]}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
