"""Warehouse inputs derived from generic order, part and event tables.

Each function maps the tables found in a folder to one record type of the
warehouse.  They only project and join; they add no rows of their own, so the
work grows with the tables.  Records with a ``create_time`` text carry the same
time typed as ``create_at``.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import codes
from ..functions.numbers import money
from ..functions.timefns import stamp
from .changes import row_map
from .tables import read_table, stream_table

# Settings for these tables, whose events lie hours and whose orders lie days apart.
BOUNCE_WITHIN = timedelta(hours=2)
ORDER_LOWER, ORDER_UPPER = timedelta(days=-5), timedelta(days=5)
PAY_LOWER, PAY_UPPER = timedelta(days=-15), timedelta(days=5)
AS_OF = "2021-12-31 00:00:00"
EVENT_SHIFT_YEARS = 27  # moves the 2024 events onto the time axis of the orders


def _pick(subject: Column, cases: dict[str, Column | str | None], default: str | None = None) -> Column:
    chain = None
    for key, value in cases.items():
        out = value if isinstance(value, Column) else F.lit(value)
        chain = F.when(subject == key, out) if chain is None else chain.when(subject == key, out)
    return chain.otherwise(F.lit(default))


def number_of_skus(spark: SparkSession, sf_dir: str) -> int:
    """How many parts there are, one for an empty table: events name SKUs by their id modulo this."""
    return max(1, read_table(spark, sf_dir, "part").count())


def log_of_events(events: DataFrame, skus: int) -> DataFrame:
    """App log records that name SKUs 0 to ``skus`` - 1; ``event_id`` identifies a record and orders ties."""
    kind, eid, uid = F.col("event_type"), F.col("event_id"), F.col("user_id")
    page_id = _pick(kind, {
        "view": "good_detail", "click": "home", "purchase": "trade", "signup": "login", "error": "good_list",
    })
    last_page = _pick(kind, {"signup": None, "view": None, "error": "search"}, "home")
    item = _pick(kind, {
        "view": (eid % skus).cast("string"),
        "error": F.concat(F.lit("red phone case "), (eid % 9).cast("string")),
    })
    item_type = _pick(kind, {"view": "sku_id", "error": "keyword"})
    shown = (F.get_json_object("props", "$.k").try_cast("int") % 4)
    displays = F.when(shown > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(shown, F.lit(1)) - 1),
        lambda i: F.struct(
            ((eid + i) % skus).cast("string").alias("item"),
            F.when(i % 2 == 0, "sku_id").otherwise("activity_id").alias("item_type"),
        ),
    ))
    return events.select(
        F.struct(
            uid.cast("string").alias("mid"),
            F.concat(F.lit("v"), (uid % 3).cast("string")).alias("vc"),
            F.concat(F.lit("ch"), (uid % 5).cast("string")).alias("ch"),
            (uid % 7).cast("string").alias("ar"),
            F.when(eid % 2 == 0, "1").otherwise("0").alias("is_new"),
        ).alias("common"),
        F.struct(
            page_id.alias("page_id"), last_page.alias("last_page_id"), item.alias("item"),
            item_type.alias("item_type"), F.round(F.col("value") * 1000).cast("bigint").alias("during_time"),
        ).alias("page"),
        displays.alias("displays"),
        F.when(eid % 17 == 0, "icon").alias("start"),
        F.unix_millis("ts").alias("ts"),
        eid.alias("event_id"),
    )


def app_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of_events(read_table(spark, sf_dir, "events"), number_of_skus(spark, sf_dir))


def app_log_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_of_events(stream_table(spark, sf_dir, "events"), number_of_skus(spark, sf_dir))


# A time after all data.  Records of this time move the watermark past everything, so that all windows and timers close.
END = "2100-01-01 00:00:00"


def log_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last records of a log stream: two entries and a search of a visitor of their own, with negative event ids."""
    like = app_log(spark, sf_dir)
    end = F.unix_millis(F.lit(END).cast("timestamp"))
    text, none = like.schema, F.lit(None)
    rows = spark.range(3).select(
        F.struct(F.lit("end").alias("mid"), *[F.lit("end").alias(c) for c in ("vc", "ch", "ar")], F.lit("0").alias("is_new")).alias("common"),
        F.struct(F.lit("end").alias("page_id"), F.when(F.col("id") == 2, "search").alias("last_page_id"), F.lit("end").alias("item"),
                 none.cast("string").alias("item_type"), F.lit(0).cast("bigint").alias("during_time")).alias("page"),
        none.cast(text["displays"].dataType).alias("displays"), none.cast("string").alias("start"), (end + F.col("id")).alias("ts"),
        (F.col("id") - 3).alias("event_id"))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in text.fields])


def order_end(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The last order, detail and payment of their streams: copies of the first ones with a negative id."""
    def last(df: DataFrame, *ids: str) -> DataFrame:
        end = F.lit(END).cast("timestamp")
        first = df.orderBy("id").limit(1).withColumns({c: F.lit(-1).cast(df.schema[c].dataType) for c in ids})
        return first.withColumns({"create_at": end, "create_time": stamp(end)})

    return (last(order_info(spark, sf_dir), "id"), last(order_detail(spark, sf_dir), "id", "order_id"),
            last(payment_info(spark, sf_dir), "id", "order_id"))


def log_lines(log: DataFrame) -> DataFrame:
    """Log records as JSON lines, two in fifty spoiled: one cut short, one left empty."""
    text = F.to_json(F.struct("common", "page", "displays", "start", "ts"))
    broken = F.pmod("event_id", F.lit(50))
    value = F.when(broken == 0, F.substring(text, 1, F.length(text) - 5)).when(broken == 1, "").otherwise(text)
    return log.select("event_id", value.alias("value"))


def open_log_lines(log: DataFrame) -> DataFrame:
    """Log records as apps send them: fields beyond the schema, numbers quoted or with decimals, a few lines spoiled."""
    eid = F.col("event_id")
    during = F.col("page.during_time").cast("string")
    during = F.when(eid % 3 == 0, F.concat(F.lit('"'), during, F.lit('"'))).when(eid % 3 == 1, F.concat(during, F.lit(".5"))).otherwise(during)
    ts = F.when(eid % 4 == 0, F.concat(F.lit('"'), F.col("ts").cast("string"), F.lit('"'))).otherwise(F.col("ts").cast("string"))
    common = F.struct("common.*", F.concat(F.lit("model "), eid % 6).alias("md"))
    page = F.to_json(F.struct(*[F.col(f"page.{c}") for c in ("page_id", "last_page_id", "item", "item_type")], F.lit("promotion").alias("source_type")))
    page = F.concat(F.substring(page, F.lit(1), F.length(page) - 1), F.lit(',"during_time":'), during, F.lit("}"))
    shown = F.to_json(F.transform("displays", lambda d, i: F.struct(d["item"].alias("item"), d["item_type"].alias("item_type"), i.alias("pos_id"))))
    parts = F.concat_ws(
        ",", F.concat(F.lit('"common":'), F.to_json(common)), F.concat(F.lit('"page":'), page), F.concat(F.lit('"displays":'), shown),
        F.when(F.col("start").isNotNull(), F.concat(F.lit('"start":{"entry":"'), F.col("start"), F.lit('","loading_time":7}'))),
        F.when(eid % 5 == 0, F.concat(F.lit('"err":{"code":'), eid % 9, F.lit("}"))), F.concat(F.lit('"ts":'), ts))
    text = F.concat(F.lit("{"), parts, F.lit("}"))
    spoiled = F.pmod("event_id", F.lit(50))
    value = F.when(spoiled == 0, F.substring(text, F.lit(1), F.length(text) - 5)).when(spoiled == 1, F.lit("[1, 2]")).when(
        spoiled == 2, F.replace(text, F.lit('"mid"'), F.lit('"mud"'))).otherwise(text)
    return log.select("event_id", value.alias("value"))


def orders_of(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Order records; the customer's nation is the province ordered from."""
    total, none = money("o_totalprice"), F.lit(None)
    placed = orders.join(customers.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    return placed.select(
        F.col("o_orderkey").alias("id"),
        F.col("c_nationkey").cast("bigint").alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        total.alias("total_amount"),
        money(F.lit(0)).alias("activity_reduce_amount"),
        money(F.lit(0)).alias("coupon_reduce_amount"),
        total.alias("original_total_amount"),
        money(F.lit(0)).alias("feight_fee"),
        none.cast("string").alias("expire_time"),
        stamp("o_orderdate").alias("create_time"),
        F.col("o_orderdate").alias("create_at"),
        none.cast("string").alias("operate_time"),
    )


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(read_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


def order_info_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_of(stream_table(spark, sf_dir, "orders"), read_table(spark, sf_dir, "customer"))


def details_of(lines: DataFrame) -> DataFrame:
    """Order lines; line numbers repeat within an order, so ``id`` is no key."""
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money("l_extendedprice").alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        stamp("l_shipdate").alias("create_time"),
        F.col("l_shipdate").alias("create_at"),
        money("l_extendedprice").alias("split_total_amount"),
        money("l_discount").alias("split_activity_amount"),
        money("l_tax").alias("split_coupon_amount"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return details_of(read_table(spark, sf_dir, "lineitem"))


def order_detail_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return details_of(stream_table(spark, sf_dir, "lineitem"))


def payments_of(orders: DataFrame) -> DataFrame:
    """A payment for each order that is not open, up to 19 days after it."""
    lag = F.make_dt_interval(days=(F.col("o_orderkey") % 20).cast("int"))
    paid_at = F.col("o_orderdate") + lag
    paid = stamp(paid_at)
    return orders.filter(F.col("o_orderstatus") != "O").select(
        (F.col("o_orderkey") + 1_000_000_000).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        money("o_totalprice").alias("total_amount"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("subject"),
        F.col("o_orderpriority").alias("payment_type"),
        paid.alias("create_time"),
        paid_at.alias("create_at"),
        paid.alias("callback_time"),
    )


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(read_table(spark, sf_dir, "orders"))


def payment_info_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_of(stream_table(spark, sf_dir, "orders"))


def refund_info(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    return read(spark, sf_dir, "lineitem").filter(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        money("l_extendedprice").alias("refund_amount"),
        stamp("l_shipdate").alias("create_time"),
        F.col("l_shipdate").alias("create_at"),
    )


def coded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(kind, code, decoded): each order line carries a code of every kind, now and then one that is not listed."""
    def carried(kind: str, names: dict[str, str]) -> Column:
        code = (F.lit(int(min(names))) + F.col("l_orderkey") % (len(names) + 1)).cast("string")
        return F.struct(F.lit(kind).alias("kind"), code.alias("code"), codes.decode(kind, code).alias("decoded"))

    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey")
    return lines.select(F.inline(F.array(*[carried(kind, names) for kind, names in codes.CODES.items()])))


def _sku_events(spark: SparkSession, sf_dir: str, kind: str, read) -> DataFrame:
    moved = F.date_trunc("second", F.col("ts") - F.make_ym_interval(F.lit(EVENT_SHIFT_YEARS)))
    return read(spark, sf_dir, "events").filter(F.col("event_type") == kind).select(
        (F.col("event_id") % number_of_skus(spark, sf_dir)).alias("sku_id"), stamp(moved).alias("create_time"), moved.alias("create_at"), "value")


def favor_info(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    return _sku_events(spark, sf_dir, "click", read).drop("value")


def cart_info(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    return _sku_events(spark, sf_dir, "purchase", read).drop("value")


def comment_info(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    return _sku_events(spark, sf_dir, "error", read).select(
        "sku_id", F.when(F.col("value") > 50, "1201").otherwise("1202").alias("appraise"), "create_time", "create_at")


def dim_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    born = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 14000).cast("int"))
    return read_table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("id"),
        F.date_format(born, "yyyy-MM-dd").alias("birthday"),
        (F.col("c_custkey") % 2).cast("string").alias("gender"),
    )


def dim_province(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations, regions = read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        F.col("n_nationkey").cast("string").alias("area_code"),
        F.col("n_name").alias("iso_code"),
        F.col("r_name").alias("iso_3166_2"),
    )


def part_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_type, type_id): the part types found, numbered in order; a row per type."""
    found = read_table(spark, sf_dir, "part").select("p_type").distinct()
    return found.select("p_type", F.row_number().over(Window.orderBy("p_type")).cast("string").alias("type_id"))


def _brand_id(brand: str) -> Column:
    return F.regexp_extract(F.col(brand), r"(\d+)", 1)


def dim_sku(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").join(part_types(spark, sf_dir), "p_type", "left").select(
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("sku_name"),
        money("p_retailprice").cast("string").alias("price"),
        F.col("type_id").alias("category3_id"),
        F.col("p_size").cast("string").alias("spu_id"),
        _brand_id("p_brand").alias("tm_id"),
    )


def dim_spu(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("string")
    return read_table(spark, sf_dir, "part").select(
        size.alias("id"), F.concat(F.lit("SPU "), size).alias("spu_name")).distinct()


def dim_brand(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        _brand_id("p_brand").alias("id"), F.col("p_brand").alias("tm_name")).distinct()


def dim_category3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return part_types(spark, sf_dir).select(F.col("type_id").alias("id"), F.col("p_type").alias("name"))


def change_records(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """Raw change records (topic, op, before, after, seq) of four tables, as a stream with ``read=stream_table``.

    Customers are read, every third is then updated and every seventh deleted;
    orders and parts are created; suppliers are read.
    """
    customer = read(spark, sf_dir, "customer")
    moved = customer.filter(F.col("c_custkey") % 3 == 0)
    was = row_map(customer)
    now = F.transform_values(was, lambda k, v: F.when(k == "c_mktsegment", "UPDATED").otherwise(v))
    gone = customer.filter(F.col("c_custkey") % 7 == 0)
    none = F.lit(None).cast("map<string,string>")

    def records(df: DataFrame, table: str, op: str, seq: int, before: Column, after: Column) -> DataFrame:
        return df.select(F.lit(f"binlog.shop.{table}").alias("topic"), F.lit(op).alias("op"),
                         before.alias("before"), after.alias("after"), F.lit(seq).alias("seq"))

    orders, part, supplier = (read(spark, sf_dir, t) for t in ("orders", "part", "supplier"))
    orders = orders.withColumn("o_orderdate", stamp("o_orderdate")).withColumn("o_totalprice", money("o_totalprice"))
    parts = [
        records(customer, "customer", "READ", 1, none, was),
        records(moved, "customer", "UPDATE", 2, was, now),
        records(gone, "customer", "DELETE", 3, was, none),
        records(orders, "orders", "CREATE", 1, none, row_map(orders)),
        records(part, "part", "CREATE", 1, none, row_map(part)),
        records(supplier, "supplier", "READ", 1, none, row_map(supplier)),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def partial_change_records(spark: SparkSession, sf_dir: str, read=read_table) -> DataFrame:
    """Change records whose updates hold only the key, the segment and, for even keys, the balance."""
    records = change_records(spark, sf_dir, read).filter(F.col("topic") == "binlog.shop.customer")
    sent = F.map_filter("after", lambda k, _: k.isin("c_custkey", "c_mktsegment") | (
        (k == "c_acctbal") & (F.col("after")["c_custkey"].cast("bigint") % 2 == 0)))
    return records.withColumn("after", F.when(F.col("op") == "UPDATE", sent).otherwise(F.col("after")))


# Where each kind of change goes, for these tables.
ROUTING_ROWS = [
    ("customer", "insert", "hbase", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey", None),
    ("customer", "update", "hbase", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey", None),
    ("orders", "insert", "kafka", "dwd_orders", "o_orderkey,o_custkey,o_totalprice,o_orderdate", None, None),
    ("part", "insert", "clickhouse", "part_stats", "p_partkey", None, None),
]


#: Inserts and updates of one table with columns of their own.
PARTIAL_ROWS = [
    ("customer", "insert", "hbase", "dim_customer", "c_custkey,c_name,c_mktsegment", "c_custkey", None),
    ("customer", "update", "hbase", "dim_customer", "c_custkey,c_mktsegment,c_acctbal", "c_custkey", None),
]


def routing(spark: SparkSession, rows: list[tuple] | None = None) -> DataFrame:
    from ..schemas import ROUTING

    return spark.createDataFrame(rows or ROUTING_ROWS, ROUTING)


#: Versions of the rule for orders, with the time each became valid and the change that made it.
CONFIG_VERSIONS = [
    ("orders", "insert", "kafka", "dwd_orders", "o_orderkey,o_custkey", None, None, "1900-01-01 00:00:00", "insert"),
    ("orders", "insert", "kafka", "dwd_orders_priced", "o_orderkey,o_totalprice,o_orderdate", None, None, "1997-01-01 00:00:00", "update"),
    ("orders", "insert", None, None, None, None, None, "1999-06-01 00:00:00", "delete"),
    ("orders", "insert", "hbase", "dim_orders", "o_orderkey,o_orderdate", "o_orderkey", None, "2000-01-01 00:00:00", "insert"),
]
#: Where the parts of a stream that meets these versions, and those of users, are cut.
VERSION_CUT = "1998-01-01 00:00:00"


def config_versions(spark: SparkSession, after_cut: bool) -> DataFrame:
    """The rules that change before or after ``VERSION_CUT``."""
    from ..schemas import ROUTING

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ROUTING.fields)
    rows = [r for r in CONFIG_VERSIONS if (r[7] >= VERSION_CUT) == after_cut]
    return spark.createDataFrame(rows, f"{fields}, since string, change string").withColumn("since", F.col("since").cast("timestamp"))


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inserted orders as raw change records with their time ``made_at``."""
    orders = read_table(spark, sf_dir, "orders")
    made = F.col("o_orderdate")
    text = orders.withColumns({"made_at": made, "o_orderdate": stamp("o_orderdate"), "o_totalprice": money("o_totalprice")})
    return text.select(F.lit("binlog.shop.orders").alias("topic"), F.lit("CREATE").alias("op"), F.lit(None).cast("map<string,string>").alias("before"),
                       row_map(text.drop("made_at")).alias("after"), F.lit(1).alias("seq"), "made_at")


#: From when on which users are of the other gender, each third after the cut and each sixth back again.
USER_CHANGES = [(3, "1999-01-01 00:00:00"), (6, "2000-07-01 00:00:00")]


def user_versions(spark: SparkSession, sf_dir: str, after_cut: bool) -> DataFrame:
    """Versions (id, birthday, gender, since) of the users: as they began, or their changes after ``VERSION_CUT``."""
    users = dim_user(spark, sf_dir)
    first = users.withColumn("since", F.lit("1900-01-01 00:00:00").cast("timestamp"))
    if not after_cut:
        return first
    out, other = first.limit(0), F.when(F.col("gender") == "1", "0").otherwise("1")
    for n, (every, since) in enumerate(USER_CHANGES):
        changed = users.filter(F.col("id").cast("bigint") % every == 0)
        changed = changed.withColumns({"gender": F.col("gender") if n % 2 else other, "since": F.lit(since).cast("timestamp")})
        out = out.unionByName(changed)
    return out


def named_searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search texts (keywords, rt) that name a part before and after the searched item, where there is a part of the visitor's number."""
    searched = read_table(spark, sf_dir, "events").filter("event_type = 'error'").select("event_id", "user_id", F.col("ts").alias("rt"))
    names = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("user_id"), "p_name")
    item = F.concat(F.lit("Red phone case "), (F.col("event_id") % 9).cast("string"))
    return searched.join(names, "user_id", "left").select(
        F.when(F.col("p_name").isNull(), item).otherwise(F.concat("p_name", F.lit(" "), item, F.lit(", "), F.upper("p_name"))).alias("keywords"), "rt")


def word_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary: part names and their last words, those of a name and what is searched for, and some pairs of these."""
    name = F.lower("p_name")
    names = read_table(spark, sf_dir, "part").filter("p_name is not null")
    entries = F.array(name, F.element_at(F.split(name, " "), -1), F.concat(F.element_at(F.split(name, " "), -1), F.lit(" red")),
                      F.lit("red phone"), F.lit("phone case"), F.lit("phone  Case 3"))
    return names.select(F.explode(entries).alias("word"))
