"""Column functions, reshaping, generators, catalog lookups."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import functions as fn
from tributary import operators as op
from tributary.functions.keys import NULL_TEXT
from tributary.sources import read_seed, relations_by_pattern, relations_by_prefix, scratch_path
from workloads.registry import query, table


@query(
    "dedupe_latest",
    """SELECT user_id, event_type, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1""",
)
def dedupe_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_type", "event_id", "value", "ts"
    )
    return op.deduplicate(events, "user_id, event_type", "ts desc, event_id").drop("ts")


@query(
    "pivot_status",
    """SELECT o_orderpriority,
      CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_O,
      CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_F,
      CAST(sum(CASE WHEN o_orderstatus = 'X' THEN 1 ELSE 0 END) AS BIGINT) AS n_X
    FROM orders GROUP BY o_orderpriority""",
)
def pivot_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy("o_orderpriority").agg(
        *op.pivot("o_orderstatus", ["O", "F", "X"], prefix="n_")
    )


@query(
    "pivot_customers",
    """SELECT o_orderstatus,
      count(DISTINCT CASE WHEN o_totalprice >= 100000 THEN o_custkey END) AS from_100000,
      count(DISTINCT CASE WHEN o_totalprice >= 300000 THEN o_custkey END) AS from_300000
    FROM orders GROUP BY o_orderstatus""",
)
def pivot_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = op.pivot(
        "o_totalprice", [100000, 300000], agg="count", cmp=">=", prefix="from_",
        then_value="o_custkey", else_value="null", distinct=True,
    )
    return table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(*columns)


@query(
    "pivot_top_values",
    """SELECT o_orderstatus,
      CAST(sum(CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS BIGINT) AS _1_urgent,
      CAST(sum(CASE WHEN o_orderpriority = '2-HIGH' THEN 1 ELSE 0 END) AS BIGINT) AS _2_high,
      CAST(sum(CASE WHEN o_orderpriority = '3-MEDIUM' THEN 1 ELSE 0 END) AS BIGINT) AS _3_medium
    FROM orders GROUP BY o_orderstatus""",
)
def pivot_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    values = op.column_values(
        orders, "o_orderpriority", max_rows=3, order_by="o_orderpriority", max_records=3
    )
    columns = op.pivot("o_orderpriority", values, quote_identifiers=False)
    return orders.groupBy("o_orderstatus").agg(*columns)


@query(
    "column_values_top",
    """SELECT o_custkey AS value FROM orders WHERE o_orderstatus = 'F'
    GROUP BY o_custkey ORDER BY count(*) DESC, o_custkey LIMIT 20""",
)
def column_values_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.column_value_counts(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        order_by="count(*) desc, o_custkey",
        max_records=20,
        where="o_orderstatus = 'F'",
    )


@query(
    "pivot_days",
    """PIVOT (SELECT o_orderpriority, strftime(o_orderdate, '%Y%m%d') AS day FROM orders)
    ON day USING count(*) GROUP BY o_orderpriority""",
)
def pivot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by priority, a column for each day of some years."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderpriority", F.date_format("o_orderdate", "yyyyMMdd").alias("day")
    )
    days = op.column_values(orders, "day", 10_000)
    return op.wide_pivot(orders, ["o_orderpriority"], "day", days)


@query(
    "unpivot_part",
    """SELECT p_partkey, 'p_name' AS attribute, p_name AS value FROM part
    UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part
    UNION ALL SELECT p_partkey, 'p_type', p_type FROM part
    UNION ALL SELECT p_partkey, 'p_size', CAST(p_size AS VARCHAR) FROM part""",
)
def unpivot_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.unpivot(
        table(spark, sf_dir, "part"),
        exclude=["p_partkey"],
        remove=["P_RETAILPRICE"],
        field_name="attribute",
    )


@query(
    "unpivot_bool",
    """SELECT l_orderkey, l_linenumber, 'is_returned' AS prop,
      CAST(l_returnflag = 'R' AS VARCHAR) AS val FROM lineitem
    UNION ALL SELECT l_orderkey, l_linenumber, 'is_open', CAST(l_linestatus = 'O' AS VARCHAR)
    FROM lineitem""",
)
def unpivot_bool(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_returnflag") == "R").alias("is_returned"),
        (F.col("l_linestatus") == "O").alias("is_open"),
    )
    return op.unpivot(
        flags, exclude=["l_orderkey", "l_linenumber"], field_name="prop", value_name="val"
    )


@query(
    "union_parties",
    """SELECT 'customers' AS source, c_custkey AS key, c_name AS name, c_acctbal AS balance,
      c_mktsegment AS segment, NULL AS nation FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 'suppliers', s_suppkey, s_name, s_acctbal, NULL,
      CAST(s_nationkey AS VARCHAR) FROM supplier WHERE s_acctbal > 0""",
)
def union_parties(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as key", "c_name as name", "c_acctbal as balance", "c_mktsegment as segment"
    )
    suppliers = table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey as key", "s_name as name", "s_acctbal as balance", "s_nationkey as nation"
    )
    return op.union_relations(
        {"customers": customers, "suppliers": suppliers},
        column_override={"nation": "string"},
        source_column_name="source",
        where="balance > 0",
    )


@query(
    "union_included",
    """SELECT c_nationkey AS nation FROM customer
    UNION ALL SELECT s_nationkey FROM supplier""",
)
def union_included(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    suppliers = table(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation")
    return op.union_relations(
        {"customers": customers, "suppliers": suppliers},
        include=["NATION"],
        source_column_name=None,
    )


@query(
    "star_prefix",
    """SELECT o_orderkey AS ord_o_orderkey_x, o_custkey AS ord_o_custkey_x,
      o_orderstatus AS ord_o_orderstatus_x, o_totalprice AS ord_o_totalprice_x
    FROM orders""",
)
def star_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").alias("o")
    unwanted = ["O_ORDERDATE", "o_orderpriority"]
    return orders.select(op.star(orders, "o", exclude=unwanted, prefix="ord_", suffix="_x"))


@query(
    "filtered_columns",
    """SELECT max(c_custkey) AS c_custkey, max(c_name) AS c_name, max(c_acctbal) AS c_acctbal
    FROM customer""",
)
def filtered_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    names = op.filtered_columns(customers, ["C_NATIONKEY", "c_mktsegment"])
    return customers.agg(*[F.max(name).alias(name) for name in names])


@query(
    "nullcheck_docs",
    """SELECT doc_id, n_chars, nullif(line, '') AS line FROM (
      SELECT doc_id, n_chars, unnest(string_split(text, chr(10))) AS line FROM documents)""",
)
def nullcheck_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        "doc_id", "n_chars", F.explode(F.split("text", "\n")).alias("line")
    )
    return op.nullcheck_table(lines)


@query(
    "group_by_n",
    """SELECT lang, source, count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars
    FROM documents GROUP BY lang, source""",
)
def group_by_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("lang", "source", "n_chars")
    return op.group_by_first(documents, 2).agg(
        F.count(F.lit(1)).alias("docs"), F.sum("n_chars").alias("chars")
    )


@query(
    "surrogate_keys",
    f"""SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '-' || coalesce(
        CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '{NULL_TEXT}'
      ) || '-' || o_orderpriority) AS order_sk,
      md5(coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END, '')) AS status_sk
    FROM orders""",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = "case when o_orderstatus <> 'P' then o_orderstatus end"
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        fn.surrogate_key(["o_orderkey", status, "o_orderpriority"]).alias("order_sk"),
        fn.surrogate_key([status], nulls_as_empty=True).alias("status_sk"),
    )


@query(
    "safe_math",
    """SELECT l_orderkey, l_linenumber,
      round(l_extendedprice / nullif(l_tax, 0), 6) AS price_per_tax,
      round(l_quantity * l_discount / nullif(l_tax * l_discount, 0), 6) AS ratio,
      coalesce(nullif(l_linenumber, 1), 0) + coalesce(l_suppkey, 0)
        + coalesce(nullif(l_partkey, 2), 0)
        AS added,
      coalesce(nullif(l_linenumber, 1), 0) - coalesce(l_suppkey, 0)
        - coalesce(nullif(l_partkey, 2), 0)
        AS subtracted
    FROM lineitem""",
)
def safe_math(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = ["nullif(l_linenumber, 1)", "l_suppkey", "nullif(l_partkey, 2)"]
    ratio = fn.safe_divide("l_quantity * l_discount", "l_tax * l_discount")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.round(fn.safe_divide("l_extendedprice", "l_tax"), 6).alias("price_per_tax"),
        F.round(ratio, 6).alias("ratio"),
        fn.safe_add(terms).alias("added"),
        fn.safe_subtract(terms).alias("subtracted"),
    )


@query(
    "width_bucket_acctbal",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 0 WHEN c_acctbal >= 8000 THEN 17
      ELSE CAST(floor(c_acctbal / 500) AS BIGINT) + 1 END AS bucket
    FROM customer""",
)
def width_bucket_acctbal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.width_bucket("c_acctbal", 0, 8000, 16).alias("bucket")
    )


_PLACES = """c_custkey, c_custkey % 120 - 60.5 AS lat1, c_custkey % 340 - 170.25 AS lon1,
      c_nationkey * 4 - 50.0 AS lat2, c_nationkey * 13 - 160.0 AS lon2"""


@query(
    "haversine_customers",
    f"""WITH places AS (SELECT {_PLACES} FROM customer), chords AS (
      SELECT c_custkey, power(sin(radians(lat2 - lat1) / 2), 2)
        + cos(radians(lat1)) * cos(radians(lat2)) * power(sin(radians(lon2 - lon1) / 2), 2) AS h
      FROM places)
    SELECT c_custkey, round(2 * 3961 * asin(sqrt(h)), 3) AS miles,
      round(2 * 3961 * asin(sqrt(h)) * 1.60934, 3) AS km FROM chords""",
)
def haversine_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    doubles = [f"cast({name} as double) as {name}" for name in ("lat1", "lon1", "lat2", "lon2")]
    places = (
        table(spark, sf_dir, "customer")
        .selectExpr(*[part.strip() for part in _PLACES.split(",")])
        .selectExpr("c_custkey", *doubles)
    )
    ends = ("lat1", "lon1", "lat2", "lon2")
    return places.select(
        "c_custkey",
        F.round(fn.haversine_distance(*ends), 3).alias("miles"),
        F.round(fn.haversine_distance(*ends, unit="km"), 3).alias("km"),
    )


@query(
    "url_parts",
    """WITH p AS (SELECT page_id, url,
      replace(replace(url, 'http://', ''), 'https://', '') AS bare FROM pages)
    SELECT page_id,
      split_part(split_part(replace(bare, 'android-app://', ''), '/', 1), '?', 1) AS host,
      split_part(CASE WHEN position('/' IN bare) > 0
        THEN substr(bare, position('/' IN bare) + 1)
        WHEN position('?' IN bare) > 0 THEN '' ELSE bare END, '?', 1) AS path,
      nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_no,
      nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref
    FROM p""",
)
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(
        "page_id",
        fn.url_host("url").alias("host"),
        fn.url_path("url").alias("path"),
        fn.url_parameter("url", "page").alias("page_no"),
        fn.url_parameter("url", "ref").alias("ref"),
    )


@query(
    "slug_names",
    """SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(
        lower(p_size || ' ' || p_name || '! -' || p_brand), '[ -]+', '_', 'g'),
        '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug
    FROM part""",
)
def slug_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.concat(
        F.col("p_size").cast("string"), F.lit(" "), "p_name", F.lit("! -"), "p_brand"
    )
    return table(spark, sf_dir, "part").select("p_partkey", fn.slug(label).alias("slug"))


@query(
    "number_series",
    """WITH n AS (SELECT unnest(range(1, (SELECT max(o_orderkey) + 1 FROM orders)))
      AS generated_number)
    SELECT generated_number FROM n
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = generated_number)""",
)
def number_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = op.single_value(table(spark, sf_dir, "orders").agg(F.max("o_orderkey")))
    lines = table(spark, sf_dir, "lineitem")
    shipped = lines.select(F.col("l_orderkey").alias("generated_number")).distinct()
    return op.generate_series(spark, last).join(shipped, "generated_number", "left_anti")


def _order_dates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, object, object]:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    ends = op.results_as_dict(
        orders.agg(F.min("day").alias("first"), F.date_add(F.max("day"), 1).alias("after")),
        max_rows=1,
    )
    return orders, ends["first"][0], ends["after"][0]


@query(
    "day_spine",
    """WITH ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b
      FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM ends)
    SELECT CAST(d AS VARCHAR) AS date_day, count(o_orderkey) AS orders
    FROM days LEFT JOIN orders ON CAST(o_orderdate AS DATE) = d GROUP BY d""",
)
def day_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, first, after = _order_dates(spark, sf_dir)
    daily = orders.groupBy(F.col("day").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    days = op.date_spine(spark, "day", first, after).join(daily, "date_day", "left")
    return days.select("date_day", F.coalesce("n", F.lit(0).cast("bigint")).alias("orders"))


@query(
    "month_spine",
    """WITH ends AS (SELECT CAST(min(o_orderdate) AS DATE) AS a,
      CAST(max(o_orderdate) AS DATE) + 1 AS b FROM orders),
    months AS (SELECT CAST(a + to_months(CAST(unnest(range(date_diff('month', a, b))) AS INT))
      AS DATE) AS d FROM ends),
    monthly AS (SELECT date_trunc('month', o_orderdate) AS m, count(*) AS n FROM orders GROUP BY 1)
    SELECT CAST(d AS VARCHAR) AS date_month, coalesce(n, 0) AS orders
    FROM months LEFT JOIN monthly ON date_trunc('month', d) = m""",
)
def month_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, first, after = _order_dates(spark, sf_dir)
    monthly = orders.groupBy(F.trunc("day", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n")
    )
    months = op.date_spine(spark, "month", first, after).withColumn(
        "month", F.trunc("date_month", "month")
    )
    joined = months.join(monthly, "month", "left")
    return joined.select("date_month", F.coalesce("n", F.lit(0).cast("bigint")).alias("orders"))


_PARTS = ("second", "minute", "hour", "day", "month", "quarter", "year")


@query(
    "interval_counts",
    f"""WITH d AS (SELECT l_orderkey, l_linenumber, o_orderdate AS a,
      l_shipdate + to_seconds(l_linenumber * 5000) AS b
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
    SELECT l_orderkey, l_linenumber,
      {", ".join(f"date_diff('{part}', a, b) AS {part}s" for part in _PARTS)},
      date_diff('day', date_trunc('week', a + INTERVAL 1 DAY),
                date_trunc('week', b + INTERVAL 1 DAY)) // 7 AS weeks
    FROM d""",
)
def interval_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    shipped = lines.withColumn("b", fn.add_parts("second", "l_linenumber * 5000", "l_shipdate"))
    joined = shipped.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    counts = [
        fn.intervals_between("o_orderdate", "b", part).alias(f"{part}s")
        for part in (*_PARTS, "week")
    ]
    return joined.select("l_orderkey", "l_linenumber", *counts)


@query(
    "single_value",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)""",
)
def single_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    highest = op.single_value(orders.agg(F.max("o_totalprice")), default=0.0)
    return orders.where(F.col("o_totalprice") == highest)


@query(
    "results_dict",
    """SELECT c_custkey, c_name, r_name AS region FROM customer
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def results_dict(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("r_regionkey") == F.col("n_regionkey")
    )
    names = op.results_as_dict(nations.select("n_nationkey", "r_name"), max_rows=1000)
    pairs = zip(names["n_nationkey"], names["r_name"], strict=True)
    lookup = F.create_map(*[F.lit(value) for pair in pairs for value in pair])
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", lookup[F.col("c_nationkey")].alias("region")
    )


@query(
    "catalog_union",
    """SELECT 'orders_by_status_' || lower(o_orderstatus) AS source, count(*) AS orders,
      round(sum(o_totalprice), 2) AS total
    FROM orders WHERE o_orderstatus IN ('F', 'O') GROUP BY 1""",
)
def catalog_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    for status in ("F", "O", "P"):
        rows = orders.where(F.col("o_orderstatus") == status)
        rows.createOrReplaceTempView(f"orders_by_status_{status.lower()}")
    found = relations_by_prefix(spark, "", "orders_by_status_", exclude="%_p")
    unioned = op.union_relations(
        {relation.path: relation.read(spark) for relation in found}, source_column_name="source"
    )
    return unioned.groupBy("source").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "catalog_pattern",
    """SELECT count(*) AS parties, count(DISTINCT nation) AS nations FROM (
      SELECT c_nationkey AS nation FROM customer UNION ALL SELECT s_nationkey FROM supplier)""",
)
def catalog_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name, key in (("customer", "c_nationkey"), ("supplier", "s_nationkey")):
        parties = table(spark, sf_dir, name).select(F.col(key).alias("nation"))
        parties.createOrReplaceTempView(f"{name}_party_rows")
    found = relations_by_pattern(spark, "", "%_PARTY_ROWS")
    parties = op.union_relations({relation.path: relation.read(spark) for relation in found})
    return parties.agg(
        F.count(F.lit(1)).alias("parties"), F.countDistinct("nation").alias("nations")
    )


@query(
    "seed_load",
    """SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang,
      CAST(n_chars AS VARCHAR) AS n_chars FROM documents""",
)
def seed_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks."""
    path = scratch_path(spark, "seed")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "n_chars")
    renamed = documents.toDF(*[name.upper() for name in documents.columns])
    quotes = {"header": True, "quoteAll": True, "escape": '"'}
    renamed.write.options(**quotes).csv(path)
    types = {"doc_id": "bigint", "text": "string", "lang": "string", "n_chars": "string"}
    return read_seed(spark, path, types)


@query(
    "catalog_tables",
    """SELECT o_orderstatus AS status, count(*) AS orders FROM orders
    WHERE o_orderstatus <> 'P' GROUP BY 1""",
)
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables of the catalog, found by schema and name patterns."""
    schema = f"by_status_{uuid4().hex}"
    spark.sql(f"create database {schema} location '{scratch_path(spark, schema)}'")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"))
    for status in ("F", "O", "P"):
        rows = orders.where(F.col("status") == status)
        rows.write.saveAsTable(f"{schema}.orders_{status}")
    found = relations_by_pattern(spark, f"{schema[:-1]}_", "ORDERS%", exclude="%_p")
    unioned = op.union_relations({relation.path: relation.read(spark) for relation in found})
    return unioned.groupBy("status").agg(F.count(F.lit(1)).alias("orders"))
