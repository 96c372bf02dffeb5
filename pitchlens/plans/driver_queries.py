"""The generic operators applied directly to driver tables.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame.  They
show that the league operators are not league-specific: any keyed, ordered
table works (orders per customer, events per user).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitchlens.functions import columns as C
from pitchlens.operators.latest import first_by_tiebreak, latest_per_key, latest_values, next_per_key
from pitchlens.operators.rolling import (
    Agg,
    ahead,
    cumulative,
    first_n_with_ahead,
    rolling,
    rolling_by_subgroup,
    sequence_number,
    trailing,
)
from pitchlens.plans.league_views import driver_tables, team_mapping
from pitchlens.session import checkpoint_root
from pitchlens.sources import landing as L
from pitchlens.sources.large_json import read_records
from pitchlens.sources.published import GrainViolation, Load, publish, version, versions, violations
from pitchlens.sources.tables import check_grain, full_model, load_seed, model_path, read_table, register_view

ORDER_KEYS = ["o_custkey"]
ORDER_ORDER = ["o_orderdate", "o_orderkey"]
EVENT_KEYS = ["user_id"]
EVENT_ORDER = ["ts", "event_id"]
# Fixed value: the horizon of the next-N query.
NEXT_N = 8


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")


# Money is summed as DECIMAL: exact, so a running total does not depend on the
# order in which an engine happens to add the rows.
MONEY = "decimal(15,2)"
MONEY_TOTAL = "decimal(18,2)"


def _money_sum(df: DataFrame, aggs: dict[str, Agg]) -> DataFrame:
    df = df.withColumn("_money", F.col("o_totalprice").cast(MONEY))
    out = rolling(df, ORDER_KEYS, ORDER_ORDER, aggs, spread=True)
    return out.withColumns({n: F.col(n).cast(MONEY_TOTAL) for n in aggs}).drop("_money")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_tables(spark, sf_dir).events.select("event_id", "user_id", "ts", "event_type", "value")


def rolling_mean(spark, sf_dir):
    """Mean order value over the customer's last 3 orders."""
    return rolling(_orders(spark, sf_dir), ORDER_KEYS, ORDER_ORDER,
                   {"avg_price_3": Agg("avg", "o_totalprice", trailing(3))}, spread=True)


def rolling_mean_lagged(spark, sf_dir):
    """Same, over the 3 orders before the current one."""
    return rolling(_orders(spark, sf_dir), ORDER_KEYS, ORDER_ORDER,
                   {"avg_price_prev_3": Agg("avg", "o_totalprice", trailing(3, lag=1))}, spread=True)


def rolling_sum(spark, sf_dir):
    """Trailing sums, current and lagged (5 orders)."""
    return _money_sum(_orders(spark, sf_dir), {
        "sum_price_5": Agg("sum", "_money", trailing(5)),
        "sum_price_prev_5": Agg("sum", "_money", trailing(5, lag=1)),
    })


def cumulative_sum(spark, sf_dir):
    """Running total per customer."""
    return _money_sum(_orders(spark, sf_dir), {"cum_price": Agg("sum", "_money", cumulative())})


def cumulative_lagged(spark, sf_dir):
    """Running total before the current order (first order: NULL)."""
    return _money_sum(_orders(spark, sf_dir), {"cum_price_before": Agg("sum", "_money", cumulative(lag=1))})


def cumulative_count(spark, sf_dir):
    """Orders so far / before (first order: 1 / 0, never NULL)."""
    return rolling(_orders(spark, sf_dir), ORDER_KEYS, ORDER_ORDER, {
        "orders_so_far": Agg("count", None, cumulative()),
        "orders_before": Agg("count", None, cumulative(lag=1)),
    }, spread=True)


def rolling_rate(spark, sf_dir):
    """W8 + P18: share of error events among the user's last 5 (and the 5 before)."""
    ev = _events(spark, sf_dir).withColumn("is_error", C.indicator(F.col("event_type") == F.lit("error")))
    return rolling(ev, EVENT_KEYS, EVENT_ORDER, {
        "error_rate_5": Agg("avg", "is_error", trailing(5)),
        "error_rate_prev_5": Agg("avg", "is_error", trailing(5, lag=1)),
    }, spread=True).drop("is_error")


def rolling_by_subgroup_q(spark, sf_dir):
    """W7 + F9: per user, mean value of the last 3 purchases (on purchase rows)
    and of the last 3 views (on view rows), current and lagged."""
    return rolling_by_subgroup(_events(spark, sf_dir), EVENT_KEYS, "event_type", EVENT_ORDER, {
        "purchase_value_3": ("purchase", Agg("avg", "value", trailing(3))),
        "purchase_value_prev_3": ("purchase", Agg("avg", "value", trailing(3, lag=1))),
        "view_value_3": ("view", Agg("avg", "value", trailing(3))),
        "view_value_prev_3": ("view", Agg("avg", "value", trailing(3, lag=1))),
    }, spread=True)


def _with_lookahead(ev: DataFrame) -> DataFrame:
    return sequence_number(ev, EVENT_KEYS, EVENT_ORDER, "seq", {
        "next_value_3": Agg("avg", "value", ahead(3)),
        "next_value_5": Agg("avg", "value", ahead(5)),
    }, spread=True)


def lookahead_mean(spark, sf_dir):
    """W9 + W10: sequence number and mean value of this and the next 2 / 4 events."""
    return _with_lookahead(_events(spark, sf_dir))


def next_n_per_key(spark, sf_dir):
    """F7 after W10: each user's first 8 events with look-ahead means.

    Cut at 8 + 4 rows first (row 8 needs rows 9..12): a group limit before the
    shuffle bounds what moves per user, also for a user with most events."""
    return first_n_with_ahead(_events(spark, sf_dir), EVENT_KEYS, EVENT_ORDER, NEXT_N, "seq", {
        "next_value_3": Agg("avg", "value", ahead(3)),
        "next_value_5": Agg("avg", "value", ahead(5)),
    })


def latest_per_key_q(spark, sf_dir):
    """D1 (whole rows): each user's latest event."""
    return latest_per_key(_events(spark, sf_dir), EVENT_KEYS, EVENT_ORDER)


def latest_non_null(spark, sf_dir):
    """D1 + D2 in one aggregation: latest value, and latest purchase value/time."""
    ev = _events(spark, sf_dir).withColumn(
        "purchase_value", F.when(F.col("event_type") == F.lit("purchase"), F.col("value")))
    return latest_values(ev, EVENT_KEYS, EVENT_ORDER, {
        "latest_value": "value",
        "latest_type": "event_type",
        "latest_purchase_value": ("purchase_value", "purchase_value"),
        "latest_purchase_ts": ("ts", "purchase_value"),
    })


def first_by_tiebreak_q(spark, sf_dir):
    """D3: first order per (customer, status) by priority, then order key."""
    od = driver_tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return first_by_tiebreak(od, ["o_custkey", "o_orderstatus"], ["o_orderpriority", "o_orderkey"])


def next_event(spark, sf_dir):
    """Each customer's first open order (status 'O') by date, then key."""
    od = driver_tables(spark, sf_dir).orders.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_totalprice")
    return next_per_key(od, ORDER_KEYS, ORDER_ORDER, where=F.col("o_orderstatus") == F.lit("O"))


def json_fields(spark, sf_dir):
    """P8 + P9: a JSON path as text and as INT."""
    ev = driver_tables(spark, sf_dir).events.select("event_id", "props")
    return ev.select("event_id", C.json_text("props", "$.k").alias("k_text"),
                     C.json_int("props", "$.k").alias("k"))


def landed_columns(spark, sf_dir):
    """S7 + S5: feed-shaped rows (camelCase names, a nested object) landed as
    snake_case columns with the nested object kept as JSON text."""
    ev = driver_tables(spark, sf_dir).events
    feed = ev.select(
        F.col("event_id").alias("eventId"),
        F.struct(F.col("user_id").alias("userId"), F.col("event_type").alias("eventType")).alias("eventInfo"),
        F.col("ts").alias("createdAt"),
    )
    return L.nested_as_json(L.normalize_columns(feed), depth=0)


CUSTOMER_COLUMNS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
CUSTOMER_SCHEMA = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])
SUPPLIER_SCHEMA = T.StructType([T.StructField("s_suppkey", T.LongType()), T.StructField("s_nationkey", T.IntegerType())])
ORDER_SCHEMA = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])
# Records of one array file of the large-array query.
ARRAY_RECORDS = 10_000
# Documents hold at most this many records, whatever the key distribution.
DOC_RECORDS = 64


def customer_payloads(spark, sf_dir) -> DataFrame:
    """Landed-shape fixture: JSON documents ``{"elements": [customer, ...]}``,
    ``DOC_RECORDS`` customers each, built by Spark from the customer table."""
    cu = driver_tables(spark, sf_dir).customer.select(*CUSTOMER_COLUMNS)
    bucket = F.floor(F.col("c_custkey") / F.lit(DOC_RECORDS)).alias("doc_id")
    return (cu.groupBy(bucket)
              .agg(F.to_json(F.struct(F.collect_list(F.struct(*CUSTOMER_COLUMNS)).alias("elements")))
                   .alias("doc")))


def flatten_payload(spark, sf_dir):
    """Payload documents -> the customer table again."""
    return L.explode_payload(customer_payloads(spark, sf_dir), "elements", CUSTOMER_SCHEMA)


def order_histories(spark, sf_dir) -> DataFrame:
    """Per-customer documents ``{"history": [order, ...]}`` (a hot customer's
    history is split over several documents of at most DOC_RECORDS orders)."""
    od = driver_tables(spark, sf_dir).orders.select(*ORDER_SCHEMA.fieldNames())
    part = F.floor(F.col("o_orderkey") / F.lit(DOC_RECORDS))
    return (od.groupBy(F.col("o_custkey").alias("customer_id"), part.alias("part"))
              .agg(F.to_json(F.struct(F.collect_list(F.struct(*ORDER_SCHEMA.fieldNames())).alias("history")))
                   .alias("doc")))


def flatten_history_q(spark, sf_dir):
    """S3: histories of active customers (positive balance, missing -> 0) only."""
    cu = driver_tables(spark, sf_dir).customer
    active = F.coalesce(F.col("c_acctbal"), F.lit(0.0)) > F.lit(0.0)
    return L.flatten_history(order_histories(spark, sf_dir), cu, active, "c_custkey", "customer_id",
                             elem_schema=ORDER_SCHEMA)


STANDINGS_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("table", T.ArrayType(CUSTOMER_SCHEMA)),
])


def standing_payloads(spark, sf_dir) -> DataFrame:
    """Two-level documents ``{"standings": [{"type": segment, "table": [...]}]}``."""
    cu = driver_tables(spark, sf_dir).customer.select(*CUSTOMER_COLUMNS)
    bucket = F.floor(F.col("c_custkey") / F.lit(DOC_RECORDS))
    inner = (cu.groupBy(bucket.alias("doc_id"), F.col("c_mktsegment").alias("type"))
               .agg(F.collect_list(F.struct(*CUSTOMER_COLUMNS)).alias("table")))
    return (inner.groupBy("doc_id")
                 .agg(F.to_json(F.struct(F.collect_list(F.struct("type", "table")).alias("standings")))
                      .alias("doc")))


def flatten_carry_q(spark, sf_dir):
    """Inner records with the outer ``type`` carried as ``standing_type``."""
    return L.flatten_carry(standing_payloads(spark, sf_dir), "standings", "table",
                           {"standing_type": "type"}, outer_schema=STANDINGS_SCHEMA)


def _shared_folder(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_root(spark)}/pitchlens-{tag}-{uuid.uuid4().hex[:12]}"


def loaded_array(spark, sf_dir):
    """Customers written as top-level JSON arrays (a document per line, at most
    DOC_RECORDS records each) and loaded again."""
    cu = driver_tables(spark, sf_dir).customer.select(*CUSTOMER_COLUMNS)
    arrays = (cu.groupBy(F.floor(F.col("c_custkey") / F.lit(DOC_RECORDS)).alias("doc_id"))
              .agg(F.to_json(F.collect_list(F.struct(*CUSTOMER_COLUMNS))).alias("value")).select("value"))
    path = _shared_folder(spark, "arrays")
    arrays.write.text(path)
    return L.load_array(spark, path, CUSTOMER_SCHEMA, multi_line=False)


def large_array(spark, sf_dir):
    """S2 on files read in pieces: customers written as files that are one JSON array each, over
    many lines, and landed again."""
    cu = driver_tables(spark, sf_dir).customer.select(F.floor(F.col("c_custkey") / F.lit(ARRAY_RECORDS)).alias("part"), *CUSTOMER_COLUMNS)
    own = Window.partitionBy("part")
    rows = cu.select("part", F.to_json(F.struct(*CUSTOMER_COLUMNS)).alias("text"),
                     F.row_number().over(own.orderBy("c_custkey")).alias("k"), F.count("*").over(own).alias("n"))
    path = _shared_folder(spark, "large-arrays")
    line = F.concat(F.when(F.col("k") == 1, "[").otherwise(""), "text", F.when(F.col("k") == F.col("n"), "]").otherwise(","))
    rows.sortWithinPartitions("part", "k").select("part", line.alias("value")).write.partitionBy("part").text(path)
    records = read_records(spark, path, {"customers": ""}).withColumnRenamed("text", "_record").drop("file")
    return L.typed_records(records, {"customers": CUSTOMER_SCHEMA}).select("customers.*").drop("_record")


def loaded_seed(spark, sf_dir):
    """The team mapping written as CSV with a header and loaded as a seed."""
    path = _shared_folder(spark, "seed")
    team_mapping(driver_tables(spark, sf_dir)).write.option("header", True).csv(path)
    return load_seed(spark, path)


def replaced_model(spark, sf_dir):
    """S6 + S11 + S12: a model stored twice and read back; the second build replaces the first."""
    cu = driver_tables(spark, sf_dir).customer.select(*CUSTOMER_COLUMNS)
    root = _shared_folder(spark, "stored")
    full_model(spark, "customers", cu, root)
    full_model(spark, "customers", cu.where(F.col("c_acctbal") > F.lit(0)), root)
    return read_table(spark, model_path(spark, "customers", root))


def _nation_loads(spark, sf_dir) -> tuple[str, GrainViolation]:
    """Two loads of customers and suppliers; a third, with a nation's rows twice, is refused.
    Returns the root and the refusal."""
    t = driver_tables(spark, sf_dir)
    root = _shared_folder(spark, "loads")
    grains = {"customers": ["c_custkey"], "suppliers": ["s_suppkey"]}
    cu, su = t.customer.select("c_custkey", "c_nationkey", "c_acctbal"), t.supplier.select("s_suppkey", "s_nationkey", "s_acctbal")
    publish(spark, root, {"customers": cu, "suppliers": su}, grains)
    publish(spark, root, {"customers": cu.where("c_acctbal > 0"), "suppliers": su.where("s_acctbal > 0")}, grains)
    try:
        publish(spark, root, {"customers": cu.unionAll(cu.where("c_nationkey = 7")), "suppliers": su.limit(0)}, grains)
    except GrainViolation as refused:
        return root, refused
    raise AssertionError("customers of nation 7 occur twice")


def published_loads(spark, sf_dir):
    """S6 + S12: rows by nation in every version of two tables that are replaced together."""
    root, _ = _nation_loads(spark, sf_dir)
    out = None
    for number in versions(spark, root):
        v = version(spark, root, number)
        customers = v.read(spark, "customers").groupBy(F.col("c_nationkey").alias("nationkey")).agg(F.count("*").alias("customers"))
        suppliers = v.read(spark, "suppliers").groupBy(F.col("s_nationkey").alias("nationkey")).agg(F.count("*").alias("suppliers"))
        both = customers.join(suppliers, "nationkey", "full").select(
            F.lit(number).cast("long").alias("version"), "nationkey", F.coalesce("customers", F.lit(0)).alias("customers"),
            F.coalesce("suppliers", F.lit(0)).alias("suppliers"))
        out = both if out is None else out.unionByName(both)
    return out


def refused_load(spark, sf_dir):
    """The stored violations of a load that its grain refused."""
    return violations(spark, _nation_loads(spark, sf_dir)[1])["customers"]


def feed_tables(spark, sf_dir):
    """S1 + S6: documents with two record arrays, landed in one pass and published as two
    tables, read back joined."""
    t = driver_tables(spark, sf_dir)
    key = F.floor(F.col("c_custkey") / F.lit(DOC_RECORDS))
    cu = t.customer.groupBy(key.alias("doc")).agg(F.collect_list(F.struct(*CUSTOMER_COLUMNS)).alias("elements"))
    su = t.supplier.groupBy(F.floor(F.col("s_suppkey") / F.lit(DOC_RECORDS)).alias("doc")).agg(
        F.collect_list(F.struct("s_suppkey", "s_nationkey")).alias("teams"))
    docs = cu.join(su, "doc", "full").select(F.to_json(F.struct("elements", "teams")).alias("value"))
    load = Load(spark, _shared_folder(spark, "feeds"))
    load.write_tagged(L.tagged_records(docs, {"customers": ("elements", CUSTOMER_SCHEMA), "suppliers": ("teams", SUPPLIER_SCHEMA)}),
                      {"customers": ["c_custkey"], "suppliers": ["s_suppkey"]})
    landed = load.commit()
    suppliers = landed.read(spark, "suppliers").groupBy(F.col("s_nationkey").alias("c_nationkey")).agg(F.count("*").alias("suppliers"))
    return landed.read(spark, "customers").drop("_record").join(suppliers, "c_nationkey", "left")


def named_view(spark, sf_dir):
    """S10 + S12: a named view over a table, read by name."""
    register_view("customers_by_nation", driver_tables(spark, sf_dir).customer.groupBy("c_nationkey")
                  .agg(F.count(F.lit(1)).alias("customers")))
    return read_table(spark, "customers_by_nation")


def grain_violations(spark, sf_dir):
    """S9 on a key that is not unique in the driver data."""
    li = driver_tables(spark, sf_dir).lineitem
    return check_grain(li, ["l_orderkey", "l_linenumber"])


def grain_ok(spark, sf_dir):
    """S9 on a unique key: no rows."""
    return check_grain(driver_tables(spark, sf_dir).orders, ["o_orderkey"])
