"""Data-quality checks; each query returns the rows that break a rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary import checks
from tributary.checks import run_checks
from tributary.plans import funnel_steps, funnel_summary, model_checks
from tributary.sources import read_footers, stored
from workloads import models
from workloads.models import EVENTS_SQL, FACTS_SQL, SESSIONS_SQL, SUMMARY_SQL
from workloads.registry import query, table


@query(
    "chk_accepted_range",
    """SELECT o_orderkey, o_totalprice FROM orders
    WHERE NOT o_totalprice >= 2000 OR NOT o_totalprice <= 450000""",
)
def chk_accepted_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return checks.accepted_range(orders, "o_totalprice", 2000, 450000).rows


@query(
    "chk_at_least_one",
    f"""{EVENTS_SQL}
    SELECT session_id, count(campaign_name) AS n_values FROM ev
    GROUP BY session_id HAVING count(campaign_name) = 0""",
)
def chk_at_least_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.at_least_one(models.events(spark, sf_dir), "campaign_name", ["session_id"]).rows


@query(
    "chk_at_least_one_table",
    f"""{EVENTS_SQL}
    SELECT count(session_engaged) AS n_values FROM ev
    WHERE event_name = 'refund' HAVING count(session_engaged) = 0""",
)
def chk_at_least_one_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = models.events(spark, sf_dir)
    return checks.at_least_one(events, "session_engaged", where="event_name = 'refund'").rows


@query(
    "chk_cardinality_equality",
    """WITH a AS (SELECT o_custkey, count(*) AS num_rows FROM orders GROUP BY 1),
    b AS (SELECT c_custkey, count(*) AS num_rows FROM customer GROUP BY 1)
    (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""",
)
def chk_cardinality_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.cardinality_equality(
        table(spark, sf_dir, "orders"), "o_custkey", table(spark, sf_dir, "customer"), "c_custkey"
    ).rows


_NATION_COUNTS = """WITH
    a AS (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1),
    b AS (SELECT s_nationkey AS nation, count(*) AS n FROM supplier GROUP BY 1)"""


def _by_nation(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    customers = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"))
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return customers, suppliers


@query(
    "chk_equal_rowcount",
    f"""{_NATION_COUNTS}
    SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_a, b.n AS count_b,
      abs(a.n - b.n) AS diff_count
    FROM a FULL JOIN b ON a.nation = b.nation""",
)
def chk_equal_rowcount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.equal_rowcount(*_by_nation(spark, sf_dir), ["nation"]).rows


@query(
    "chk_fewer_rows_than",
    f"""{_NATION_COUNTS}
    SELECT a.nation AS nation_a, b.nation AS nation_b, a.n AS count_our_model,
      b.n AS count_comparison_model,
      CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS row_count_delta
    FROM a FULL JOIN b ON a.nation = b.nation""",
)
def chk_fewer_rows_than(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.fewer_rows_than(*_by_nation(spark, sf_dir), ["nation"]).rows


@query(
    "chk_equal_rowcount_table",
    """SELECT a AS count_a, b AS count_b, abs(a - b) AS diff_count FROM
    (SELECT count(*) AS a FROM orders), (SELECT count(*) AS b FROM lineitem)""",
)
def chk_equal_rowcount_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = (table(spark, sf_dir, name) for name in ("orders", "lineitem"))
    return checks.equal_rowcount(orders, lines).rows


@query(
    "chk_fewer_rows_than_table",
    """SELECT a AS count_our_model, b AS count_comparison_model,
      CASE WHEN a > b THEN a - b WHEN a = b THEN 1 ELSE 0 END AS row_count_delta
    FROM (SELECT count(*) AS a FROM lineitem), (SELECT count(*) AS b FROM orders)""",
)
def chk_fewer_rows_than_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = (table(spark, sf_dir, name) for name in ("orders", "lineitem"))
    return checks.fewer_rows_than(lines, orders).rows


def _equality_sql(left: str, right: str) -> str:
    return f"""SELECT 'a_minus_b' AS which_diff, * FROM ({left} EXCEPT {right})
    UNION ALL SELECT 'b_minus_a', * FROM ({right} EXCEPT {left})"""


def _ordered_and_shipped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("state"), "o_custkey"
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("orderkey"), F.col("l_linestatus").alias("state"), "l_suppkey"
    )
    return orders, lines


@query(
    "chk_equality",
    _equality_sql(
        "SELECT o_orderkey AS orderkey, o_orderstatus AS state FROM orders",
        "SELECT l_orderkey AS orderkey, l_linestatus AS state FROM lineitem",
    ),
)
def chk_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _ordered_and_shipped(spark, sf_dir)
    return checks.equality(orders, lines, compare_columns=["orderkey", "state"]).rows


@query(
    "chk_equality_where",
    _equality_sql(
        "SELECT o_orderkey AS orderkey FROM orders WHERE o_orderstatus = 'F'",
        "SELECT l_orderkey AS orderkey FROM lineitem",
    ),
)
def chk_equality_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lines = _ordered_and_shipped(spark, sf_dir)
    return checks.equality(
        orders, lines, compare_columns=["orderkey"], where="state = 'F'"
    ).rows


@query(
    "chk_equality_precision",
    _equality_sql(
        "SELECT l_partkey AS partkey, round(l_discount, 1) AS rate FROM lineitem",
        "SELECT l_partkey AS partkey, round(l_tax, 1) AS rate FROM lineitem",
    ),
)
def chk_equality_precision(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    key = F.col("l_partkey").alias("partkey")
    return checks.equality(
        lines.select(key, F.col("l_discount").alias("rate"), "l_orderkey"),
        lines.select(key, F.col("l_tax").alias("rate"), "l_orderkey"),
        exclude_columns=["L_ORDERKEY"],
        precision=1,
    ).rows


@query(
    "chk_equality_precision_prices",
    _equality_sql(
        "SELECT l_orderkey, l_linenumber, round(l_extendedprice, 0) AS price FROM lineitem",
        "SELECT l_orderkey, l_linenumber, round(l_extendedprice * CAST(1.00001 AS DOUBLE), 0)"
        " AS price FROM lineitem",
    ),
)
def chk_equality_precision_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices and slightly higher ones: equal where both round to the same whole number."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price")
    )
    higher = lines.withColumn("price", F.col("price") * F.lit(1.00001))
    return checks.equality(lines, higher, precision=0).rows


_LINES_SQL = "SELECT l_orderkey, l_linenumber, l_shipdate, l_tax FROM lineitem"


@query(
    "chk_equality_digests",
    _equality_sql(
        f"SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate)"
        f" FROM ({_LINES_SQL})",
        f"""SELECT * REPLACE (strftime(l_shipdate, '%Y-%m-%d %H:%M:%S.%f') AS l_shipdate,
              CASE WHEN l_orderkey % 1000 = 0 THEN NULL ELSE l_tax END AS l_tax)
            FROM ({_LINES_SQL}) WHERE l_orderkey % 1000 <> 1""",
    ),
)
def chk_equality_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two tables that differ in few rows; most of both are compared by digests alone."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_tax"
    )
    other = lines.where("l_orderkey % 1000 <> 1").withColumn(
        "l_tax", F.expr("if(l_orderkey % 1000 = 0, null, l_tax)")
    )
    return checks.equality(lines, other, by_digests=True).rows


@query(
    "chk_counts_from_footers",
    """SELECT 'rows' AS rule, a AS ours, b AS theirs FROM
      (SELECT count(*) AS a FROM orders), (SELECT count(*) AS b FROM lineitem)
    UNION ALL
    SELECT 'newest key', max(o_orderkey), (SELECT max(l_orderkey) FROM lineitem) FROM orders""",
)
def chk_counts_from_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and greatest keys of whole tables, of which only the footers are read."""
    orders, lines = (
        read_footers(spark, f"{sf_dir}/{name}.parquet") for name in ("orders", "lineitem")
    )
    rows = checks.equal_rowcount(orders, lines).rows.select(
        F.lit("rows").alias("rule"), F.col("count_a").alias("ours"), F.col("count_b").alias("theirs")
    )
    newest = orders.agg(F.max("o_orderkey").alias("ours"), F.lit(None).cast("bigint").alias("theirs"))
    newest = newest.union(
        lines.agg(F.max("l_orderkey").alias("theirs")).select(F.lit(None).cast("bigint"), "theirs")
    )
    newest = newest.agg(F.max("ours").alias("ours"), F.max("theirs").alias("theirs"))
    return rows.union(newest.select(F.lit("newest key"), "ours", "theirs"))


@query(
    "chk_expression_is_true",
    """SELECT l_orderkey, l_linenumber, l_quantity, l_discount FROM lineitem
    WHERE NOT (l_quantity * (1 - l_discount) > 5)""",
)
def chk_expression_is_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount"
    )
    return checks.expression_is_true(lines, "* (1 - l_discount) > 5", column="l_quantity").rows


def _ranges_sql(
    source: str, lower: str, upper: str, partition: str | None, gap: str, zero: bool = False
) -> str:
    operator, words = {
        "allowed": ("<=", "less_than_or_equal_to"),
        "not_allowed": ("=", "equal_to"),
        "required": ("<", "less_than"),
    }[gap]
    length, length_words = ("<=", "less_than_or_equal_to") if zero else ("<", "less_than")
    part = f"PARTITION BY {partition}" if partition else ""
    shown = f"{partition} AS partition_by_col," if partition else ""
    return f"""w AS (
      SELECT {shown} {lower} AS lower_bound, {upper} AS upper_bound,
        lead({lower}) OVER ({part} ORDER BY {lower}, {upper}) AS next_lower_bound,
        lead(1) OVER ({part} ORDER BY {lower}, {upper}) IS NULL AS is_last_record
      FROM {source}
    ), c AS (
      SELECT *,
        coalesce(lower_bound {length} upper_bound, false)
          AS lower_bound_{length_words}_upper_bound,
        coalesce(upper_bound {operator} next_lower_bound, is_last_record, false)
          AS upper_bound_{words}_next_lower_bound
      FROM w
    )
    SELECT * FROM c WHERE NOT (lower_bound_{length_words}_upper_bound
      AND upper_bound_{words}_next_lower_bound)"""


@query(
    "chk_mutually_exclusive_ranges",
    f"""{SESSIONS_SQL}, s AS (
      SELECT user_pseudo_id, epoch_us(session_start_at) AS lo, epoch_us(session_end_at) AS hi
      FROM sess
    ), {_ranges_sql("s", "lo", "hi", "user_pseudo_id", "allowed")}""",
)
def chk_mutually_exclusive_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mutually_exclusive_ranges(
        models.sessions(spark, sf_dir),
        "unix_micros(session_start_at)",
        "unix_micros(session_end_at)",
        partition_by="user_pseudo_id",
    ).rows


@query(
    "chk_ranges_no_gaps",
    "WITH " + _ranges_sql("part", "p_partkey", "p_partkey + p_size % 3", None, "not_allowed"),
)
def chk_ranges_no_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mutually_exclusive_ranges(
        table(spark, sf_dir, "part"), "p_partkey", "p_partkey + p_size % 3", gaps="not_allowed"
    ).rows


@query(
    "chk_ranges_gaps_required",
    "WITH "
    + _ranges_sql("lineitem", "l_linenumber", "l_linenumber + l_suppkey % 2", "l_orderkey",
                  "required", True),
)
def chk_ranges_gaps_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mutually_exclusive_ranges(
        table(spark, sf_dir, "lineitem"),
        "l_linenumber",
        "l_linenumber + l_suppkey % 2",
        partition_by="l_orderkey",
        gaps="required",
        zero_length_range_allowed=True,
    ).rows


@query(
    "chk_ranges_repeated",
    "WITH "
    + _ranges_sql(
        "lineitem", "l_linenumber", "l_linenumber + l_suppkey % 4", "l_orderkey", "allowed"
    ),
)
def chk_ranges_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.mutually_exclusive_ranges(
        table(spark, sf_dir, "lineitem"),
        "l_linenumber",
        "l_linenumber + l_suppkey % 4",
        partition_by="l_orderkey",
    ).rows


@query(
    "chk_not_accepted_values",
    """SELECT DISTINCT c_mktsegment AS value_field FROM customer
    WHERE c_mktsegment IN ('MACHINERY', 'HOUSEHOLD', 'SPACE')""",
)
def chk_not_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    forbidden = ["MACHINERY", "HOUSEHOLD", "SPACE"]
    return checks.not_accepted_values(
        table(spark, sf_dir, "customer"), "c_mktsegment", forbidden
    ).rows


@query(
    "chk_not_constant",
    """SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_distinct FROM lineitem
    GROUP BY l_orderkey HAVING count(DISTINCT l_returnflag) = 1""",
)
def chk_not_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return checks.not_constant(lines, "l_returnflag", ["l_orderkey"]).rows


@query(
    "chk_not_empty_string",
    """SELECT trim(line) AS line FROM (
      SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
    WHERE trim(line) = ''""",
)
def chk_not_empty_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "documents").select(
        F.explode(F.split("text", "\n")).alias("line")
    )
    return checks.not_empty_string(lines, "line").rows


@query(
    "chk_not_empty_string_tags",
    """SELECT page_id, trim(piece) AS piece FROM (
      SELECT page_id, unnest(string_split(html, '>')) AS piece FROM pages)
    WHERE trim(piece) = ''""",
)
def chk_not_empty_string_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What follows each tag of a page, the last of them included, after which nothing comes."""
    pieces = table(spark, sf_dir, "pages").select(
        "page_id", F.explode(F.split("html", ">")).alias("piece")
    )
    found = checks.not_empty_string(pieces, "piece")
    return found.table.where(found.broken).select("page_id", F.trim("piece").alias("piece"))


@query(
    "chk_not_null",
    f"""{EVENTS_SQL}
    SELECT event_id, user_pseudo_id, ga_session_id FROM ev WHERE ga_session_id IS NULL""",
)
def chk_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = models.events(spark, sf_dir).select("event_id", "user_pseudo_id", "ga_session_id")
    return checks.not_null(events, "ga_session_id").rows


@query(
    "chk_not_null_proportion",
    f"""{EVENTS_SQL}
    SELECT country, count(campaign_name) / count(*) AS not_null_proportion FROM ev
    GROUP BY country HAVING count(campaign_name) / count(*) < CAST(0.75 AS DOUBLE)""",
)
def chk_not_null_proportion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.not_null_proportion(
        models.events(spark, sf_dir), "campaign_name", 0.75, group_by_columns=["country"]
    ).rows


@query(
    "chk_recency",
    """SELECT user_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS most_recent,
      '2024-01-30 12:00:00.000000' AS threshold
    FROM events GROUP BY user_id HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""",
)
def chk_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.recency(
        table(spark, sf_dir, "events"),
        "ts",
        "hour",
        12,
        group_by_columns=["user_id"],
        as_of=F.lit("2024-01-31 00:00:00").cast("timestamp"),
    ).rows


@query(
    "chk_recency_by_date",
    """SELECT user_id, CAST(CAST(max(ts) AS DATE) AS VARCHAR) AS most_recent,
      '2024-01-30' AS threshold
    FROM events GROUP BY user_id HAVING CAST(max(ts) AS DATE) < DATE '2024-01-30'""",
)
def chk_recency_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.recency(
        table(spark, sf_dir, "events"),
        "ts",
        "day",
        1,
        ignore_time_component=True,
        group_by_columns=["user_id"],
        as_of=F.lit("2024-01-31 18:00:00").cast("timestamp"),
    ).rows


@query(
    "chk_relationships_where",
    """SELECT o.o_custkey AS id, CAST(NULL AS BIGINT) AS right_id
    FROM (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'P') o
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) c ON o_custkey = c_custkey
    WHERE c_custkey IS NULL""",
)
def chk_relationships_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.relationships_where(
        table(spark, sf_dir, "orders"),
        "o_custkey",
        table(spark, sf_dir, "customer"),
        "c_custkey",
        from_condition="o_orderstatus <> 'P'",
        to_condition="c_acctbal > 0",
    ).rows


@query(
    "chk_sequential_values",
    """SELECT * FROM (
      SELECT o_orderkey, lag(o_orderkey) OVER (ORDER BY o_orderkey) AS previous_o_orderkey
      FROM orders WHERE o_orderstatus <> 'P')
    WHERE NOT (o_orderkey = previous_o_orderkey + 1)""",
)
def chk_sequential_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return checks.sequential_values(orders, "o_orderkey", where="o_orderstatus <> 'P'").rows


@query(
    "chk_sequential_values_grouped",
    """SELECT * FROM (
      SELECT l_orderkey, l_linenumber,
        lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber)
          AS previous_l_linenumber
      FROM lineitem)
    WHERE NOT (l_linenumber = previous_l_linenumber + 1)""",
)
def chk_sequential_values_grouped(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return checks.sequential_values(lines, "l_linenumber", group_by_columns=["l_orderkey"]).rows


@query(
    "chk_sequential_dates",
    """SELECT strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate,
      strftime(previous_o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS previous_o_orderdate
    FROM (SELECT o_orderdate, lag(o_orderdate) OVER (ORDER BY o_orderdate) AS previous_o_orderdate
          FROM orders WHERE o_orderpriority = '1-URGENT') d
    WHERE NOT (d.o_orderdate = d.previous_o_orderdate + INTERVAL 1 DAY)""",
)
def chk_sequential_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return checks.sequential_values(
        orders, "o_orderdate", datepart="day", where="o_orderpriority = '1-URGENT'"
    ).rows


@query(
    "chk_unique",
    """SELECT l_orderkey AS unique_field, count(*) AS n_records FROM lineitem
    WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1""",
)
def chk_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique(table(spark, sf_dir, "lineitem"), "l_orderkey").rows


@query(
    "chk_unique_combination",
    """SELECT l_orderkey, l_linenumber FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def chk_unique_combination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.unique_combination_of_columns(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"]
    ).rows


@query(
    "chk_accepted_values",
    """SELECT o_orderpriority AS value_field, count(*) AS n_records FROM orders
    GROUP BY 1 HAVING o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM')""",
)
def chk_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.accepted_values(
        table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]
    ).rows


@query(
    "chk_assert_equal",
    f"""{FACTS_SQL}
    SELECT session_id, had_add_to_cart, progressed_to_add_to_cart FROM facts
    WHERE had_add_to_cart <> progressed_to_add_to_cart""",
)
def chk_assert_equal(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = models.facts(spark, sf_dir).select(
        "session_id", "had_add_to_cart", "progressed_to_add_to_cart"
    )
    return checks.assert_equal(facts, "had_add_to_cart", "progressed_to_add_to_cart").rows


@query(
    "chk_columns_match_set",
    """SELECT name AS relation_column, listed AS input_column
    FROM (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars', 'n_words']) AS name)
    FULL JOIN (SELECT unnest(['doc_id', 'text', 'lang', 'source', 'n_chars', 'url']) AS listed)
      ON name = listed
    WHERE name IS NULL OR listed IS NULL""",
)
def chk_columns_match_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").withColumn("N_Words", F.lit(1))
    expected = ["DOC_ID", "text", "lang", "source", "n_chars", "URL"]
    return checks.columns_match_set(documents, expected).rows


_REPORT_SQL = f"""{SUMMARY_SQL},
    counts("check", failures) AS (
      SELECT 'not_null_events_event_id', count(*) FROM ev WHERE event_id IS NULL
      UNION ALL SELECT 'not_null_events_session_id', count(*) FROM ev WHERE session_id IS NULL
      UNION ALL SELECT 'not_null_events_event_name', count(*) FROM ev WHERE event_name IS NULL
      UNION ALL SELECT 'not_null_events_event_timestamp', count(*) FROM ev WHERE ts IS NULL
      UNION ALL SELECT 'not_null_events_user_pseudo_id', count(*) FROM ev
        WHERE user_pseudo_id IS NULL
      UNION ALL SELECT 'not_null_sessions_session_id', count(*) FROM sess WHERE session_id IS NULL
      UNION ALL SELECT 'not_null_sessions_user_pseudo_id', count(*) FROM sess
        WHERE user_pseudo_id IS NULL
      UNION ALL SELECT 'not_null_sessions_session_date', count(*) FROM sess
        WHERE session_date IS NULL
      UNION ALL SELECT 'not_null_sessions_had_purchase', count(*) FROM sess
        WHERE had_purchase IS NULL
      UNION ALL SELECT 'not_null_sessions_session_revenue', count(*) FROM sess
        WHERE session_revenue IS NULL
      UNION ALL SELECT 'not_null_steps_session_id', count(*) FROM facts WHERE session_id IS NULL
      UNION ALL SELECT 'not_null_steps_max_funnel_stage', count(*) FROM facts
        WHERE max_funnel_stage IS NULL
      UNION ALL SELECT 'not_null_steps_deepest_stage_name', count(*) FROM facts
        WHERE deepest_stage_name IS NULL
      UNION ALL SELECT 'not_null_steps_channel_group', count(*) FROM facts
        WHERE channel_group IS NULL
      UNION ALL SELECT 'not_null_steps_is_converted', count(*) FROM facts
        WHERE is_converted IS NULL
      UNION ALL SELECT 'not_null_steps_session_revenue', count(*) FROM facts
        WHERE session_revenue IS NULL
      UNION ALL SELECT 'not_null_summary_session_date', count(*) FROM summary
        WHERE session_date IS NULL
      UNION ALL SELECT 'not_null_summary_channel_group', count(*) FROM summary
        WHERE channel_group IS NULL
      UNION ALL SELECT 'not_null_summary_total_sessions', count(*) FROM summary
        WHERE total_sessions IS NULL
      UNION ALL SELECT 'unique_sessions_session_id', count(*) FROM (
        SELECT session_id FROM sess GROUP BY 1 HAVING count(session_id) > 1)
      UNION ALL SELECT 'unique_steps_session_id', count(*) FROM (
        SELECT session_id FROM facts GROUP BY 1 HAVING count(session_id) > 1)
      UNION ALL SELECT 'accepted_values_steps_max_funnel_stage', count(*) FROM (
        SELECT DISTINCT max_funnel_stage FROM facts
        WHERE max_funnel_stage NOT IN (1, 2, 3, 4, 5, 6, 7))
      UNION ALL SELECT 'accepted_values_steps_deepest_stage_name', count(*) FROM (
        SELECT DISTINCT deepest_stage_name FROM facts WHERE deepest_stage_name NOT IN (
          'session_start', 'page_view', 'view_item', 'add_to_cart', 'begin_checkout',
          'add_payment_info', 'purchase'))
      UNION ALL SELECT 'accepted_values_steps_channel_group', count(*) FROM (
        SELECT DISTINCT channel_group FROM facts WHERE channel_group NOT IN (
          'Paid Search', 'Paid Social', 'Email', 'Organic Search', 'Referral', 'Direct',
          'Organic Social', 'Other'))
      UNION ALL SELECT 'funnel_order',
        count(*) FILTER (WHERE had_begin_checkout AND NOT had_add_to_cart)
        + count(*) FILTER (WHERE had_add_payment_info AND NOT had_begin_checkout)
        + count(*) FILTER (WHERE had_purchase AND NOT had_add_payment_info)
        + count(*) FILTER (WHERE had_purchase AND session_revenue < 0) FROM facts
      UNION ALL SELECT 'columns_match_set_summary', (
        SELECT count(*) FROM (DESCRIBE SELECT * FROM summary)) - 26)
    SELECT "check", failures, CASE WHEN failures <> 0 THEN 'fail' ELSE 'pass' END AS status
    FROM counts"""


@query("check_report", _REPORT_SQL)
def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = models.events(spark, sf_dir)
    sessions = stored(models.sessions(spark, sf_dir), "sessions")
    steps = funnel_steps(sessions)
    summary = stored(funnel_summary(steps, models.MONEY), "summary")
    return run_checks(model_checks(events, sessions, steps, summary))
