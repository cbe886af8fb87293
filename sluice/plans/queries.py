"""The registered queries: every operator on the driver's tables, each beside its SQL.

The tables are sales tables, so customers stand for users, orders for enrollments and change rows,
parts for courses, documents and pages for nested records. All queries read whole tables.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import functions as X
from .. import operators as O
from ..functions.nested import NOT_REGISTERED
from ..schemas import CHANGE_FILES
from ..session import new_path
from ..sources import (
    RunMetrics,
    Table,
    advance_watermark,
    check_pages,
    control_table,
    get_watermark,
    page_nodes,
    read_changes,
    read_columns,
    read_pages,
    read_snapshot,
    set_watermark,
    snapshot_records,
    watermarks_or_default,
    write_changes,
    write_snapshot,
)
from ..sources.change_files import ARRIVAL
from ..streaming import drop_reread, stream_changes, stream_checked, stream_texts, stream_upsert
from .jobs import Jobs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    def register(run: Query) -> Query:
        key = name or run.__name__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return run

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def day(ts: Column) -> Column:
    """A time as date text, which any engine writes alike."""
    return ts.cast("date").cast("string")


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


SQL_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S.%f')"
SQL_DAY = "CAST(CAST({0} AS DATE) AS VARCHAR)"


# -- upsert ---------------------------------------------------------------------------------------

ORDER_CHANGES_SQL = """
    SELECT o_custkey + 750 AS user_id, o_orderpriority AS name, o_totalprice AS balance, o_orderdate AS seen_at,
           row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
    FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'"""

UPSERT_SQL = f"""
    WITH last AS (SELECT * FROM ({ORDER_CHANGES_SQL}) WHERE rn = 1)
    SELECT coalesce(l.user_id, c.c_custkey) AS user_id,
           CASE WHEN l.user_id IS NOT NULL THEN l.name ELSE c.c_name END AS name,
           CASE WHEN l.user_id IS NOT NULL THEN l.balance ELSE c.c_acctbal END AS balance,
           {SQL_DAY.format("l.seen_at")} AS seen_on
    FROM customer c FULL JOIN last l ON l.user_id = c.c_custkey"""


def _users(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.lit(None).cast("timestamp_ntz").alias("seen_at"),
    )


def _order_changes(spark: SparkSession, sf: str) -> DataFrame:
    new = O.since(table(spark, sf, "orders"), "o_orderdate", "2001-01-01")
    return new.select(
        (F.col("o_custkey") + 750).alias("user_id"), F.col("o_orderpriority").alias("name"),
        F.col("o_totalprice").alias("balance"), F.col("o_orderdate").alias("seen_at"), "o_orderkey",
    )


def _seen_on(df: DataFrame) -> DataFrame:
    return df.select("user_id", "name", "balance", day(F.col("seen_at")).alias("seen_on"))


@query(UPSERT_SQL)
def upsert_last_wins(spark, sf):
    """Last change of each key replaces or adds the row (K02 on a batch, F01)."""
    return _seen_on(O.upsert(_users(spark, sf), _order_changes(spark, sf), ["user_id"], ["seen_at", "o_orderkey"]))


@query(UPSERT_SQL)
def table_upsert(spark, sf):
    """The same merge into a stored table (K02, K05): full load, then the batch, then its replay."""
    users = _users(spark, sf)
    target = Table(spark, new_path(spark, "table_upsert"), users.schema, ["user_id"], buckets=8)
    target.reload(users)
    changes = _order_changes(spark, sf)
    target.upsert(changes, ["seen_at", "o_orderkey"], batch=("orders", 1))
    target.upsert(changes, ["seen_at", "o_orderkey"], batch=("orders", 1))
    return _seen_on(target.read())


PARTIAL_SQL = f"""
    WITH last AS (SELECT * FROM ({ORDER_CHANGES_SQL}) WHERE rn = 1)
    SELECT coalesce(l.user_id, c.c_custkey) AS user_id, c.c_name AS name,
           CASE WHEN l.user_id IS NOT NULL THEN l.balance ELSE c.c_acctbal END AS balance
    FROM customer c FULL JOIN last l ON l.user_id = c.c_custkey"""


@query(PARTIAL_SQL)
def upsert_partial_columns(spark, sf):
    """Changes without some columns: kept on a match, NULL on insert."""
    base = _users(spark, sf).drop("seen_at")
    return O.upsert(base, _order_changes(spark, sf).drop("name"), ["user_id"], ["seen_at", "o_orderkey"])


@query(PARTIAL_SQL)
def upsert_sparse_batch(spark, sf):
    """The same merge of a sparse batch: a Bloom filter keeps rows it cannot hit out of the shuffle."""
    base = _users(spark, sf).drop("seen_at")
    return O.upsert(base, _order_changes(spark, sf).drop("name"), ["user_id"], ["seen_at", "o_orderkey"], batch="sparse")


@query(UPSERT_SQL)
def upsert_wide_batch(spark, sf):
    """Whole rows of a wide batch: one union and one aggregation for both sides."""
    return _seen_on(O.upsert(_users(spark, sf), _order_changes(spark, sf), ["user_id"], ["seen_at", "o_orderkey"], batch="wide"))


@query("""
    WITH ch AS (SELECT CASE WHEN o_orderstatus <> 'O' THEN o_custkey + 750 END AS user_id, o_orderpriority AS name,
                       o_totalprice AS balance, o_orderdate, o_orderkey
                FROM orders WHERE o_orderdate > TIMESTAMP '2001-01-01'),
         last AS (SELECT user_id, name, balance FROM (
             SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
             FROM ch WHERE user_id IS NOT NULL) WHERE rn = 1)
    SELECT c_custkey AS user_id, c_name AS name, c_acctbal AS balance FROM customer
    WHERE NOT EXISTS (SELECT 1 FROM last WHERE last.user_id = c_custkey)
    UNION ALL SELECT * FROM last
    UNION ALL SELECT user_id, name, balance FROM ch WHERE user_id IS NULL""")
def upsert_null_key(spark, sf):
    """Rows with a NULL key match nothing and are always inserted."""
    orders = O.since(table(spark, sf, "orders"), "o_orderdate", "2001-01-01")
    changes = orders.select(
        F.when(F.col("o_orderstatus") != "O", F.col("o_custkey") + 750).alias("user_id"),
        F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("balance"), "o_orderdate", "o_orderkey",
    )
    return O.upsert(_users(spark, sf).drop("seen_at"), changes, ["user_id"], ["o_orderdate", "o_orderkey"])


LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                "l_tax", "l_returnflag", "l_linestatus"]
LINE_ORDER = ["l_shipdate", *LINE_COLUMNS[2:]]
LINE_LAST_SQL = f"""
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                          ORDER BY {", ".join(c + " DESC" for c in LINE_ORDER)}) AS rn
                   FROM lineitem WHERE l_shipdate > TIMESTAMP '1999-01-01') WHERE rn = 1"""


@query(f"""
    WITH last AS ({LINE_LAST_SQL})
    SELECT {", ".join(LINE_COLUMNS)} FROM lineitem b
    WHERE l_shipdate <= TIMESTAMP '1999-01-01' AND NOT EXISTS (
        SELECT 1 FROM last WHERE last.l_orderkey = b.l_orderkey AND last.l_linenumber = b.l_linenumber)
    UNION ALL SELECT {", ".join(LINE_COLUMNS)} FROM last""")
def upsert_composite(spark, sf):
    """A key of two columns."""
    lines = table(spark, sf, "lineitem")
    split = dt.datetime(1999, 1, 1)
    old = lines.filter(F.col("l_shipdate") <= X.like_column(lines, "l_shipdate", split)).drop("l_shipdate")
    return O.upsert(old, O.since(lines, "l_shipdate", split), ["l_orderkey", "l_linenumber"],
                    LINE_ORDER).select(*LINE_COLUMNS)


ENTITY_VALUES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@query(f"""
    SELECT CAST(l_orderkey AS VARCHAR) AS partition_key, CAST(l_linenumber AS VARCHAR) AS row_key,
           {", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ENTITY_VALUES)}, {SQL_STAMP.format("l_shipdate")} AS l_shipdate
    FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                ORDER BY l_shipdate DESC, {", ".join(f"{c} DESC" for c in ENTITY_VALUES)}) AS rn
          FROM lineitem) WHERE rn = 1""")
def replace_entities(spark, sf):
    """All-text rows replaced by (partition key, row key) in a stored table."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("partition_key"), F.col("l_linenumber").alias("row_key"), *ENTITY_VALUES,
        stamp(F.col("l_shipdate")).alias("l_shipdate"))
    # keys are compared in their own types; the table's schema turns what is left into text
    schema = ", ".join(f"{c} string" for c in rows.columns)
    target = Table(spark, new_path(spark, "entities"), schema, ["partition_key", "row_key"], buckets=8)
    target.upsert(rows, ["l_shipdate", *ENTITY_VALUES])
    return target.read()


# -- slices, filters, terms -----------------------------------------------------------------------


@query(f"""
    SELECT event_id, user_id, event_type, value, {SQL_STAMP.format("ts")} AS ts FROM events
    WHERE ts > TIMESTAMP '2024-01-10 12:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00'""")
def since_slice(spark, sf):
    """Slice after the noon before the reference date, up to its end."""
    events = table(spark, sf, "events")
    low = X.yesterday_noon(dt.datetime(2024, 1, 11, 8))
    return O.since(events, "ts", low, dt.datetime(2024, 1, 20)).select(
        "event_id", "user_id", "event_type", "value", stamp(F.col("ts")).alias("ts"))


@query("""
    SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part
    WHERE NOT (contains(lower(CAST(p_partkey AS VARCHAR)), 'ring') OR contains(lower(p_name), 'ring')
               OR contains(lower(p_brand), 'ring') OR contains(lower(p_type), 'ring'))""")
def any_column_exclude(spark, sf):
    """Rows in which no column mentions a text."""
    return O.exclude_text(table(spark, sf, "part"), "RING")


PROPS_TEXT_SQL = """CASE event_type WHEN 'error' THEN k || '.5' WHEN 'signup' THEN k || 'x'
    WHEN 'click' THEN '9223372036854775808' WHEN 'view' THEN k END"""


@query(f"""
    SELECT event_id, CASE WHEN regexp_full_match(t, '[+-]?[0-9]+') THEN TRY_CAST(t AS BIGINT) END AS value,
           CASE WHEN t IS NOT NULL AND (NOT regexp_full_match(t, '[+-]?[0-9]+') OR TRY_CAST(t AS BIGINT) IS NULL)
                THEN t END AS quarantined
    FROM (SELECT event_id, {PROPS_TEXT_SQL} AS t
          FROM (SELECT event_id, event_type, json_extract_string(props, '$.k') AS k FROM events))""")
def quarantine_bigint(spark, sf):
    """Numbers in texts, and the texts that hold none, told apart in one pass."""
    kind, k = F.col("event_type"), F.get_json_object("props", "$.k")
    text = (
        F.when(kind == "error", F.concat(k, F.lit(".5"))).when(kind == "signup", F.concat(k, F.lit("x")))
        .when(kind == "click", F.lit("9223372036854775808")).when(kind == "view", k)
    )
    rows = O.checked(table(spark, sf, "events").select("event_id", text.alias("value")), {"value": "bigint"})
    return rows.select("event_id", "value", F.when(F.size("bad_columns") > 0, F.col("raw.value")).alias("quarantined"))


@query(f"""
    SELECT event_id, CASE WHEN event_type <> 'error' THEN {SQL_STAMP.format("ts")} END AS parsed,
           CASE WHEN event_type = 'view' THEN 0 ELSE CAST(trunc(value) AS BIGINT) END AS whole
    FROM events""")
def safe_parse(spark, sf):
    """Time texts (some of them ``None``) and numbers with gaps."""
    kind = F.col("event_type")
    text = F.when(kind == "error", F.lit("None")).otherwise(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    return table(spark, sf, "events").select(
        "event_id", stamp(X.parse_time(text)).alias("parsed"),
        X.whole_number(F.when(kind != "view", F.col("value"))).alias("whole"),
    )


TERM_SQL = """CASE o_orderstatus
    WHEN 'F' THEN year(o_orderdate) || CASE WHEN month(o_orderdate) <= 7 THEN ' VÅR' ELSE ' HØST' END
    WHEN 'O' THEN year(o_orderdate) || CASE WHEN month(o_orderdate) <= 7 THEN ' VÅR-' ELSE ' HØST-' END
                  || (year(o_orderdate) + 1) || CASE WHEN day(o_orderdate) <= 15 THEN ' VÅR' ELSE ' HØST' END
    ELSE CASE WHEN day(o_orderdate) <= 15 THEN 'Standardsemester' ELSE year(o_orderdate) || 'HØST' END END"""


TERM_ID_SQL = """CAST(year(o_orderdate) * 12 + CASE WHEN month(o_orderdate) <= 7 THEN 0 ELSE 6 END
    + CASE WHEN day(o_orderdate) <= 15 THEN 0 ELSE 3 END
    + CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER)"""
TERMS_SQL = f"SELECT {TERM_ID_SQL} AS term_id, min({TERM_SQL}) AS name FROM orders GROUP BY 1"


def _term_parts() -> list[Column]:
    date, status = F.col("o_orderdate"), F.col("o_orderstatus")
    return [
        F.year(date).alias("year"),
        F.when(F.month(date) <= 7, 0).otherwise(6).alias("autumn"),
        F.when(F.dayofmonth(date) <= 15, 0).otherwise(3).alias("late"),
        F.when(status == "F", 0).when(status == "O", 1).otherwise(2).alias("kind"),
    ]


def _term_id() -> Column:
    year, autumn, late, kind = _term_parts()
    return year * 12 + autumn + late + kind


def _terms(spark: SparkSession, sf: str) -> DataFrame:
    """A term table (term_id, name) as the orders give it.

    The parts of a name are aggregated as numbers (so by hash, without a sort), and the name is made
    and parsed once per term.
    """
    parts = table(spark, sf, "orders").select(_term_id().alias("term_id"), *_term_parts())
    terms = parts.groupBy("term_id").agg(*[F.min(c).alias(c) for c in ("year", "autumn", "late", "kind")])
    year, following = F.col("year").cast("string"), (F.col("year") + 1).cast("string")
    word = F.when(F.col("autumn") == 0, F.lit("VÅR")).otherwise(F.lit("HØST"))
    end = F.when(F.col("late") == 0, F.lit("VÅR")).otherwise(F.lit("HØST"))
    name = (
        F.when(F.col("kind") == 0, F.concat_ws(" ", year, word))
        .when(F.col("kind") == 1, F.concat(year, F.lit(" "), word, F.lit("-"), following, F.lit(" "), end))
        .when(F.col("late") == 0, F.lit("Standardsemester"))
        .otherwise(F.concat(year, F.lit("HØST")))
    )
    return terms.select("term_id", name.alias("name"))


SPAN_SQL = """
    SELECT term_id, name, y1 + CASE WHEN s1 = 'HØST' THEN 0.5 ELSE 0 END AS first_half,
           y2 + CASE WHEN s2 = 'HØST' THEN 0.5 ELSE 0 END AS last_half
    FROM (SELECT term_id, name, CAST(left(name, 4) AS DOUBLE) AS y1,
                 split_part(split_part(name, '-', 1), ' ', 2) AS s1,
                 CAST(left(right(name, length(name) - coalesce(nullif(strpos(name, '-'), 0), 0)), 4) AS DOUBLE) AS y2,
                 split_part(CASE WHEN contains(name, '-') THEN split_part(name, '-', 2) ELSE name END, ' ', 2) AS s2
          FROM terms WHERE regexp_matches(name, '^[0-9]{4} '))"""


@query(f"""
    WITH terms AS ({TERMS_SQL}), spans AS ({SPAN_SQL})
    SELECT * FROM spans WHERE first_half <= 1998.5 AND 1998.5 <= last_half""", name="active_terms")
def active_terms_query(spark, sf):
    """Terms that run in autumn 1998, single and spanning."""
    span = X.term_span(F.col("name"))
    return O.active_terms(_terms(spark, sf), dt.date(1998, 10, 1)).select(
        "term_id", "name", span["start"].alias("first_half"), span["end"].alias("last_half"))


@query(f"""
    WITH terms AS ({TERMS_SQL}), spans AS ({SPAN_SQL})
    SELECT o_orderkey, o_custkey, {TERM_ID_SQL} AS term_id FROM orders
    WHERE {TERM_ID_SQL} IN (SELECT term_id FROM spans WHERE first_half <= 1998.5 AND 1998.5 <= last_half)""")
def courses_in_active_terms(spark, sf):
    """Courses of the running terms, and what hangs on them."""
    courses = table(spark, sf, "orders").select("o_orderkey", "o_custkey", _term_id().alias("term_id"))
    running = O.active_terms(_terms(spark, sf), dt.date(1998, 10, 1))
    return O.in_active_terms(courses, running, "term_id")


CODE_SQL = """CASE o_orderpriority WHEN '5-LOW' THEN 'XX_999_K' || o_custkey || '_1'
    WHEN '1-URGENT' THEN 'UE_203_K' || o_custkey WHEN '2-HIGH' THEN NULL
    ELSE 'UE_203_K' || o_custkey || '_2_' || year(o_orderdate) || '_'
         || CASE WHEN month(o_orderdate) <= 7 THEN 'VÅR' ELSE 'HØST' END END"""


def _course_code() -> Column:
    date, name = F.col("o_orderdate"), F.col("o_custkey").cast("string")
    priority = F.col("o_orderpriority")
    full = F.concat(F.lit("UE_203_K"), name, F.lit("_2_"), F.year(date).cast("string"), F.lit("_"),
                    X.semester_name(date))
    return (
        F.when(priority == "5-LOW", F.concat(F.lit("XX_999_K"), name, F.lit("_1")))
        .when(priority == "1-URGENT", F.concat(F.lit("UE_203_K"), name))
        .when(priority != "2-HIGH", full)
    )


@query(f"""
    SELECT o_orderkey, 'K' || o_custkey AS emnekode, '2' AS versjonskode, code FROM (
        SELECT *, {CODE_SQL} AS code FROM orders)
    WHERE o_orderstatus <> 'P' AND split_part(code, '_', 5) = '1998' AND split_part(code, '_', 6) = 'VÅR'""")
def code_term_filter(spark, sf):
    """Courses whose code names the current term, with the parts of the code."""
    courses = table(spark, sf, "orders").select(
        "o_orderkey", _course_code().alias("code"),
        F.when(F.col("o_orderstatus") == "P", F.lit(1)).otherwise(F.lit(2)).alias("term_id"),
    )
    code = F.col("code")
    return O.active_by_code(courses, dt.date(1998, 3, 1), "code", "term_id").select(
        "o_orderkey", X.code_part(code, 2, "203").alias("emnekode"), X.code_part(code, 3, "203").alias("versjonskode"), "code")


@query(f"""
    SELECT o_orderkey, CASE WHEN contains(code, '_203_') THEN nullif(split_part(code, '_', 3), '') ELSE ' ' END AS
               emnekode,
           CASE WHEN contains(code, '_203_') THEN nullif(split_part(code, '_', 4), '') ELSE ' ' END AS versjonskode,
           o_custkey || '_' || code AS joined
    FROM (SELECT *, {CODE_SQL} AS code FROM orders)""")
def code_parts(spark, sf):
    """Course code, version and a joined key of every order, marked or not."""
    code = F.col("code")
    return table(spark, sf, "orders").withColumn("code", _course_code()).select(
        "o_orderkey", X.code_part(code, 2, "203").alias("emnekode"), X.code_part(code, 3, "203").alias("versjonskode"),
        X.joined_key(F.col("o_custkey"), code).alias("joined"))


@query("""
    SELECT o_orderkey, year(o_orderdate) + CASE WHEN month(o_orderdate) <= 7 THEN 0.0::DOUBLE ELSE 0.5::DOUBLE END AS
               half_year,
           CASE WHEN month(o_orderdate) <= 7 THEN 'VÅR' ELSE 'HØST' END AS semester,
           CASE WHEN month(o_orderdate) < 7 THEN 'VAR' ELSE 'HOST' END AS term_code,
           CASE WHEN month(o_orderdate) < 5 THEN year(o_orderdate) - 1 ELSE year(o_orderdate) END::INTEGER AS
               description_year
    FROM orders""")
def catalogue_term(spark, sf):
    """Both calendar rules side by side: July is spring in one and autumn in the other."""
    date = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey", X.half_year(date).alias("half_year"), X.semester_name(date).alias("semester"),
        X.catalogue_term(date).alias("term_code"), X.description_year(date).alias("description_year"))


# -- joins and counts -----------------------------------------------------------------------------

RECENT_SQL = """
    SELECT DISTINCT c_custkey AS user_id FROM customer LEFT JOIN orders ON o_custkey = c_custkey
    WHERE o_custkey IS NOT NULL AND (c_acctbal > 9000 OR o_orderdate > TIMESTAMP '2001-07-01')"""


def _recent(spark: SparkSession, sf: str) -> DataFrame:
    return O.recent_users(
        table(spark, sf, "customer"), table(spark, sf, "orders"), 9000.0, dt.datetime(2001, 7, 1),
        user_id="c_custkey", last_login="c_acctbal", activity_user="o_custkey", last_activity="o_orderdate")


@query(RECENT_SQL, name="recent_users")
def recent_users_query(spark, sf):
    """Users seen lately by either of two signs."""
    return _recent(spark, sf)


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS user_id, c_name AS name
    FROM orders LEFT JOIN customer
        ON c_custkey = CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AND c_acctbal > 0""")
def id_lookup(spark, sf):
    """Each row with the id known for its user; rows without stay."""
    rows = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_custkey")).alias("user_id"))
    ids = table(spark, sf, "customer").filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    return O.lookup(rows, ids, "user_id")


@query("""
    WITH ids AS (SELECT o_custkey AS user_id, max(o_orderkey) AS last_order FROM orders GROUP BY o_custkey)
    SELECT c_custkey AS user_id, c_name AS name, last_order FROM customer LEFT JOIN ids ON user_id = c_custkey""")
def id_lookup_repeated(spark, sf):
    """Several ids for a key do not multiply the row; the greatest counts."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    ids = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("last_order"))
    return O.lookup(rows, ids, "user_id")


@query(f"""
    WITH c AS (SELECT o_orderkey, {TERM_ID_SQL} AS term_id, {CODE_SQL} AS code,
                      CASE WHEN o_totalprice > 400000 THEN 'Unpublished' ELSE 'available' END AS state FROM orders),
         t AS (SELECT term_id, CASE
                   WHEN name NOT LIKE '%-%' AND regexp_matches(left(name, 4), '[0-9]') THEN
                       TRY_CAST(left(name, 4) AS INTEGER)
                   WHEN name NOT LIKE '%-%' AND regexp_matches(right(name, 4), '[0-9]') THEN
                       TRY_CAST(right(name, 4) AS INTEGER)
                   WHEN lower(name) LIKE '%standard%' OR lower(name) LIKE '%eveg vår%' THEN 2000
                   WHEN name LIKE '%-%' AND regexp_matches(name, '[0-9]') THEN
                       TRY_CAST(substr(name, strpos(name, '-') + 1, 4) AS INTEGER) END AS end_year,
               CASE WHEN lower(right(name, 3)) = 'vår' THEN 7 WHEN lower(right(name, 4)) = 'høst' THEN 12
                    WHEN lower(name) LIKE '%vår%' THEN 7 WHEN lower(name) LIKE '%høst%' THEN 12
                    ELSE 12 END AS end_month FROM ({TERMS_SQL}))
    SELECT DISTINCT o_orderkey AS course_id FROM c LEFT JOIN t ON t.term_id = c.term_id
    WHERE lower(state) NOT LIKE '%unpub%' AND end_year >= 2000 AND end_month >= 9
      AND (upper(code) LIKE '%UE_203%' OR upper(code) LIKE '%UA_203%')""")
def legacy_term_calendar(spark, sf):
    """Courses by the older term calendar."""
    courses = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("course_id"), _term_id().alias("enrollment_term_id"),
        _course_code().alias("sis_course_id"),
        F.when(F.col("o_totalprice") > 400000, F.lit("Unpublished")).otherwise(F.lit("available")).alias(
            "workflow_state"),
    )
    return O.legacy_calendar(courses, _terms(spark, sf), dt.date(2000, 9, 1))


@query("""
    SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey""")
def count_per_course(spark, sf):
    """Rows per course, courses without any included."""
    lines = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return O.rows_per_course(table(spark, sf, "orders"), lines, "o_orderkey")


@query("""
    SELECT 'customer' AS source, c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance
    FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, s_acctbal FROM supplier
    UNION ALL SELECT 'part', p_partkey, p_name, NULL, NULL FROM part""")
def union_frames(spark, sf):
    """Frames with different columns under one another."""
    return O.union_frames([
        table(spark, sf, "customer").select(F.lit("customer").alias("source"), F.col("c_custkey").alias("id"),
                                            F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"),
                                            F.col("c_acctbal").alias("balance")),
        table(spark, sf, "supplier").select(F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"),
                                            F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")),
        table(spark, sf, "part").select(F.lit("part").alias("source"), F.col("p_partkey").alias("id"),
                                        F.col("p_name").alias("name")),
    ])


@query("""
    SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 10""")
def top_rows(spark, sf):
    """The first rows of a listing, by an order that leaves no choice."""
    return O.top_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                      [F.desc("o_totalprice"), F.desc("o_orderkey")], 10)


@query(f"""
    SELECT o_orderkey, coalesce(code, '') AS code, CAST(NULL AS BIGINT) AS account_id, '' AS sis_user_id
    FROM (SELECT *, {CODE_SQL} AS code FROM orders)""", name="fill_text")
def fill_text_query(spark, sf):
    """Constant columns, and NULL texts made blank."""
    return O.fill_text(table(spark, sf, "orders").select(
        "o_orderkey", _course_code().alias("code"), F.lit(None).cast("bigint").alias("account_id"),
        F.lit(None).cast("string").alias("sis_user_id")))


# -- nested records -------------------------------------------------------------------------------

LINES_SQL = "string_split(text, chr(10))"


def _lines() -> Column:
    return F.split("text", "\n")


def _last_word(line: Column) -> Column:
    return F.try_element_at(F.split(line, " "), F.lit(-1))


@query(f"""
    SELECT doc_id, CASE WHEN len(list_filter(ls, lambda x: x = '')) > 0 THEN '"{NOT_REGISTERED}"'
        ELSE '[' || array_to_string(list_transform(ls, lambda x: '[' || to_json(string_split(x, ' ')[-1]) || ', '
             || to_json(split_part(x, ' ', 1)) || ', '
             || CASE WHEN length(x) > 60 THEN to_json(lang) ELSE 'null' END || ']'), ', ') || ']' END AS people
    FROM (SELECT doc_id, lang, {LINES_SQL} AS ls FROM documents)""", name="people_json")
def people_json_query(spark, sf):
    """Nested people as one JSON text; one broken record spoils the list."""
    people = F.transform(_lines(), lambda x: F.struct(
        F.when(x != "", F.struct(F.get(F.split(x, " "), 0).alias("last"), _last_word(x).alias("first"))).alias("name"),
        F.when(F.length(x) > 60, F.col("lang")).alias("id"),
    ))
    listed = X.people_json(F.col("people"), lambda p: [p["name"]["first"], p["name"]["last"], p["id"]],
                           lambda p: p["name"].isNotNull())
    return table(spark, sf, "documents").withColumn("people", people).select("doc_id", listed.alias("people"))


@query(f"""
    SELECT doc_id, array_to_string(list_transform(ps, lambda x: split_part(x, ' ', 1) || '|' || length(x) || '|'
               || n_chars || '_' || lang), ';') AS programmes
    FROM (SELECT doc_id, lang, n_chars, list_filter({LINES_SQL}, lambda x: contains(x, 'the')) AS ps FROM documents)
    WHERE len(ps) > 0""")
def programmes_per_student(spark, sf):
    """Nested programme records reshaped in place, students without any left out."""
    docs = table(spark, sf, "documents").withColumn(
        "entries", F.filter(_lines(), lambda x: F.contains(x, F.lit("the"))))
    listed = X.programme_list(
        F.col("entries"), lambda x: F.get(F.split(x, " "), 0), lambda x: F.length(x),
        lambda x: X.semester_label(F.col("n_chars"), F.col("lang")))
    rows = docs.select("doc_id", listed.alias("programmes")).filter(F.size("programmes") > 0)
    text = F.transform("programmes", lambda p: F.concat_ws("|", p["code"], p["weight"].cast("string"), p["semester"]))
    return rows.select("doc_id", F.array_join(text, ";").alias("programmes"))


@query(f"""
    SELECT conv_id, coalesce(max(CASE WHEN role = 'user' THEN last END), '{NOT_REGISTERED}') AS "user",
           coalesce(max(CASE WHEN role = 'assistant' THEN last END), '{NOT_REGISTERED}') AS assistant,
           coalesce(max(CASE WHEN role = 'system' THEN last END), '{NOT_REGISTERED}') AS system
    FROM (SELECT conv_id, role, max_by(text, turn) AS last FROM conversations GROUP BY conv_id, role)
    GROUP BY conv_id""")
def descriptions_wide(spark, sf):
    """Last text of each category as a column of its own, from long rows."""
    return O.pivot_last(table(spark, sf, "conversations"), ["conv_id"], F.col("role"), F.col("text"), [F.col("turn")],
                        ["user", "assistant", "system"])


def _sql_description(key: str) -> str:
    category, language = key.split("_")
    long = "length(x) % 2 = 0" if category == "LUB" else "length(x) % 2 = 1"
    lang = {"NNO": "contains(x, 'ou')", "NOB": "NOT contains(x, 'ou') AND contains(x, 'th')",
            "ENG": "NOT contains(x, 'ou') AND NOT contains(x, 'th')"}[language]
    hits = f"list_filter(ls, lambda x: {long} AND {lang})"
    return f"CASE WHEN len({hits}) > 0 THEN {hits}[-1] ELSE '{NOT_REGISTERED}' END AS {key}"


@query(f"""
    SELECT doc_id, {", ".join(_sql_description(k) for k in ("LUB_NNO", "LUB_NOB", "LUB_ENG", "ARB_NNO", "ARB_NOB",
                                                            "ARB_ENG"))}
    FROM (SELECT doc_id, {LINES_SQL} AS ls FROM documents)""")
def descriptions_array(spark, sf):
    """The same from the array inside the record, by category and language."""
    entries = F.transform(_lines(), lambda x: F.struct(
        F.when(F.length(x) % 2 == 0, F.lit("EBLUB")).otherwise(F.lit("EBARB")).alias("category"),
        F.when(F.contains(x, F.lit("ou")), F.lit("NNO")).when(F.contains(x, F.lit("th")), F.lit("NOB"))
        .otherwise(F.lit("ENG")).alias("language"),
        x.alias("content"),
    ))
    columns = X.descriptions(F.col("entries"), lambda e: e["category"], lambda e: e["language"],
                             lambda e: e["content"])
    return table(spark, sf, "documents").withColumn("entries", entries).select(
        "doc_id", *[c.alias(k) for k, c in columns.items()])


@query("""
    SELECT len(chunks) - 1 AS items_count, url AS items_url, page_id AS module_id, page_id AS course_id,
           'Page' AS type, CAST(i - 1 AS BIGINT) AS module_item_id,
           regexp_extract(chunks[i], '>([^<]*)</a>', 1) AS title, page_id AS parent_module_id,
           regexp_extract(chunks[i], 'href="([^"]*)"', 1) AS external_url, contains(chunks[i], 'the') AS item_published,
           url AS name, contains(html, '<article>') AS published
    FROM (SELECT *, string_split(html, '<li>') AS chunks FROM pages), unnest(range(2, len(chunks) + 1)) AS t(i)""")
def explode_items(spark, sf):
    """Modules to items."""
    chunks = F.split("html", "<li>")
    page = F.col("page_id")
    items = F.transform(F.slice(chunks, 2, F.size(chunks)), lambda x, i: F.struct(
        (i + 1).cast("bigint").alias("id"), F.regexp_extract(x, ">([^<]*)</a>", 1).alias("title"),
        F.lit("Page").alias("type"), page.alias("module_id"), F.contains(x, F.lit("the")).alias("published"),
        F.regexp_extract(x, 'href="([^"]*)"', 1).alias("external_url"),
    ))
    node = F.struct(
        page.alias("id"), F.col("url").alias("name"), F.contains("html", F.lit("<article>")).alias("published"),
        (F.size(chunks) - 1).cast("bigint").alias("items_count"), F.col("url").alias("items_url"),
        items.alias("items"),
    )
    return O.module_items(table(spark, sf, "pages").select(node.alias("node"), page.alias("course_id")))


@query(f"""
    SELECT doc_id, nullif(line, '') AS item
    FROM (SELECT doc_id, unnest({LINES_SQL}) AS line FROM documents WHERE lang <> 'en')""")
def explode_nulls(spark, sf):
    """NULL elements give a row, empty arrays none."""
    items = F.when(F.col("lang") != "en", F.transform(_lines(), lambda x: F.nullif(x, F.lit("")))).otherwise(
        F.array().cast("array<string>"))
    return O.flatten(table(spark, sf, "documents"), items, ["doc_id"])


def _enrollment_sql(number: int, where: str) -> str:
    return f"""
    SELECT o_orderkey * 10 + {number} AS enrollment_id, o_custkey AS user_id, 'P' || o_custkey AS sis_user_id,
           o_orderkey AS course_id, o_orderpriority AS type, {SQL_DAY.format("o_orderdate")} AS created_on,
           CASE WHEN o_orderstatus <> 'O' THEN {SQL_DAY.format("o_orderdate")} END AS updated_on,
           o_orderstatus AS enrollment_state, CAST(trunc(o_totalprice) AS BIGINT) AS total_activity_time,
           CAST(NULL AS VARCHAR) AS active_on
    FROM orders WHERE {where}"""


@query(_enrollment_sql(1, "TRUE") + " UNION ALL " + _enrollment_sql(2, "o_orderstatus = 'F'"))
def explode_nested(spark, sf):
    """Courses to enrollments with their nested user."""
    date = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")

    def node(number: int) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 10 + number).cast("string").alias("_id"), F.col("o_orderpriority").alias("type"),
            F.col("o_orderstatus").alias("state"), F.col("o_totalprice").alias("totalActivityTime"),
            F.lit("None").alias("lastActivityAt"),
            F.struct(
                F.col("o_custkey").cast("string").alias("_id"),
                F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("sisId"), date.alias("createdAt"),
                F.when(F.col("o_orderstatus") == "O", F.lit("None")).otherwise(date).alias("updatedAt"),
                F.lit("A. Name").alias("name"),
            ).alias("user"),
        )

    pages = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("course_id"),
        F.array(node(1), F.when(F.col("o_orderstatus") == "F", node(2))).alias("nodes"),
    )
    rows = O.course_enrollments(page_nodes(pages, "nodes", ["course_id"]))

    def utc_day(name: str) -> Column:
        return day(F.to_utc_timestamp(F.col(name), F.current_timezone()))

    return rows.select(
        "enrollment_id", "user_id", "sis_user_id", "course_id", "type", utc_day("created_at").alias("created_on"),
        utc_day("updated_at").alias("updated_on"), "enrollment_state", "total_activity_time",
        utc_day("last_activity_at").alias("active_on"))


@query("""
    SELECT l_partkey AS page_views, l_orderkey AS id, l_suppkey AS max_page_views, l_linenumber AS page_views_level,
           l_suppkey AS participations, l_partkey AS max_participations, l_linenumber AS participations_level,
           l_partkey AS course_id, l_linenumber AS missing, l_linenumber AS late, l_linenumber AS on_time,
           l_linenumber * 3 AS total
    FROM lineitem WHERE l_returnflag <> 'N'""")
def explode_summaries(spark, sf):
    """Students with analytics; those without are left out."""
    part, supplier, line = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_linenumber")
    analytics = F.struct(
        F.struct(part.alias("total"), line.alias("level"), supplier.alias("max")).alias("pageViews"),
        F.struct(line.alias("level"), part.alias("max"), supplier.alias("total")).alias("participations"),
        F.struct(line.alias("late"), line.alias("missing"), line.alias("onTime"),
                 (line * 3).alias("total")).alias("tardinessBreakdown"),
    )
    node = F.struct(F.col("l_orderkey").cast("string").alias("_id"),
                    F.when(F.col("l_returnflag") != "N", analytics).alias("summaryAnalytics"))
    return O.summaries_nested(table(spark, sf, "lineitem").select(node.alias("node"), part.alias("course_id")))


LINKS_SQL = """
    SELECT 'K' || l_partkey AS code, CAST(l_linenumber AS VARCHAR) AS version, 'S' || l_suppkey AS programme,
           year(l_shipdate) AS y, CASE WHEN month(l_shipdate) < 7 THEN 'VAR' ELSE 'HOST' END AS t,
           l_returnflag AS flag, l_linestatus AS status FROM lineitem"""


@query(f"""
    SELECT code AS "Emnekode", version AS "Versjonskode", programme AS "Studieprogramkode",
           CAST(y + CASE WHEN flag = 'N' THEN 0 ELSE 1 END AS INTEGER) AS "Undervises_forste_ar",
           CASE WHEN flag = 'N' THEN t ELSE 'HOST' END AS "Undervises_forste_termin",
           CAST(CASE WHEN status = 'O' THEN y + 2 WHEN flag <> 'R' THEN y + 1 END AS INTEGER) AS "Undervises_siste_ar",
           CASE WHEN status = 'O' THEN 'VAR' WHEN flag <> 'R' THEN t END AS "Undervises_siste_termin",
           code || '_' || version AS "Emnekode2", programme || '_' || code || '_' || version AS "programEmneKode"
    FROM ({LINKS_SQL}) WHERE flag = 'R' OR y + 1 > 1997
    UNION ALL
    SELECT code, version, NULL, CAST(y AS INTEGER), t, CAST(CASE WHEN flag <> 'R' THEN y + 1 END AS INTEGER),
           CASE WHEN flag <> 'R' THEN t END,
           code || '_' || version, NULL
    FROM ({LINKS_SQL}) WHERE flag = 'A' AND y + 1 > 1997""")
def period_fallback(spark, sf):
    """Course-programme links: own period or else the course's, decided as a whole."""
    year = F.year("l_shipdate")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")

    def term(y: Column, code: Column) -> Column:
        return F.struct(y.alias("arstall"), F.struct(code.alias("kode")).alias("betegnelse"))

    code = X.catalogue_term(F.col("l_shipdate"))
    link = F.struct(
        F.struct(
            F.when(flag != "N", term(year + 1, F.lit("HOST"))).alias("fraTermin"),
            F.when(status == "O", term(year + 2, F.lit("VAR"))).alias("tilTermin"),
        ).alias("periode"),
        F.struct(F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("kode")).alias("studieprogram"),
    )
    no_link = F.when(F.lit(False), link)
    node = F.struct(
        F.concat(F.lit("K"), F.col("l_partkey").cast("string")).alias("kode"),
        F.col("l_linenumber").cast("string").alias("versjonskode"),
        F.when(flag == "A", F.array(link, no_link)).otherwise(F.array(link)).alias("studieprogramkoblinger"),
        F.struct(term(year, code).alias("forsteTermin"),
                 F.when(flag != "R", term(year + 1, code)).alias("sisteTermin")).alias("undervisesIPeriode"),
    )
    return O.course_programmes(table(spark, sf, "lineitem").select(node.alias("node")), cutoff=1997)


@query("""
    SELECT page_id, split_part(html, '<br', 1) AS teacher,
           nullif(regexp_extract(html, '<title> ?([^<]*)<', 1), '') AS title,
           nullif(regexp_extract(html, 'ID: ?([^<]*)<', 1), '') AS timeedit_id,
           CASE WHEN contains(title_line, '<') THEN rtrim(split_part(title_line, '<', 1)) ELSE title_line END AS room
    FROM (SELECT page_id, html, substr(html, strpos(html, '<h1>') + 4) AS title_line FROM pages)""")
def text_cuts(spark, sf):
    """Stretches of markup text."""
    html = F.col("html")
    heading = F.substr(html, F.instr(html, "<h1>") + 4)
    return table(spark, sf, "pages").select(
        "page_id", X.teacher(html).alias("teacher"), X.between(html, "<title>").alias("title"),
        X.timeedit_id(html).alias("timeedit_id"), X.room_name(heading).alias("room"))


@query("""
    SELECT page_id, url AS current, url || '/last' AS next, CAST(NULL AS VARCHAR) AS last,
           'current,first,next' AS relations FROM pages""")
def link_header(spark, sf):
    """Relations of a Link header; the last of a repeated one counts."""
    url = F.col("url")
    header = F.concat(
        F.lit("<"), url, F.lit('>; rel="current",<'), url, F.lit('/2>; rel="next", <'), url,
        F.lit('/1>; rel="first",<'), url, F.lit('/last>; rel="next"'))
    links = F.col("links")
    return table(spark, sf, "pages").withColumn("links", X.link_relations(header)).select(
        "page_id", *[F.try_element_at(links, F.lit(r)).alias(r) for r in ("current", "next", "last")],
        F.array_join(F.array_sort(F.map_keys(links)), ",").alias("relations"))


DEMO_KEY = b"demonstration key, not a secret"


def _sql_blob(data: bytes) -> str:
    return "'" + "".join(f"\\x{b:02X}" for b in data) + "'::BLOB"


def _sql_hmac(text: str) -> str:
    padded = DEMO_KEY.ljust(64, b"\0")
    inner, outer = (_sql_blob(bytes(b ^ pad for b in padded)) for pad in (0x36, 0x5C))
    return f"to_base64(unhex(sha256({outer} || unhex(sha256({inner} || encode({text}))))))"


@query(f"SELECT c_custkey, {_sql_hmac('c_name')} AS pseudonym FROM customer", name="pseudonym")
def pseudonym_query(spark, sf):
    """Keyed pseudonyms of a name column."""
    return table(spark, sf, "customer").select("c_custkey", X.pseudonym(F.col("c_name"), DEMO_KEY).alias("pseudonym"))


# -- files, pages, control ------------------------------------------------------------------------


@query(f"""
    SELECT o_orderkey AS id, o_custkey AS user_id, o_orderstatus AS workflow_state, o_totalprice AS total,
           {SQL_DAY.format("o_orderdate")} AS created_on FROM orders""")
def change_file_roundtrip(spark, sf):
    """Rows through gzip change files with dotted headers."""
    path = new_path(spark, "change_files")
    write_changes(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key.id"), F.col("o_custkey").alias("value.user_id"),
        F.col("o_orderstatus").alias("value.workflow_state"), F.col("o_totalprice").alias("value.total"),
        F.col("o_orderdate").alias("value.created_at"), F.col("o_orderpriority").alias("value.unread"),
    ), path)
    schema = ("`key.id` bigint, `value.user_id` bigint, `value.workflow_state` string, `value.total` double, "
              "`value.created_at` timestamp_ntz")
    rows = O.plain(read_changes(spark, path, schema), [
        "key.id", "value.user_id", "value.workflow_state", "value.total", "value.created_at"])
    return rows.select("id", "user_id", "workflow_state", "total", day(F.col("created_at")).alias("created_on"))


PAGE_SCHEMA = ("source string, page bigint, data struct<docs:struct<pageInfo:struct<hasNextPage:boolean>,"
               "nodes:array<struct<number:bigint,line:string>>>>, errors array<struct<message:string>>")


def _landed_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Documents landed as JSON pages, one per line: a document is a page, its lines the records."""
    path = new_path(spark, "pages")
    nodes = F.transform(_lines(), lambda x, i: F.struct(i.cast("bigint").alias("number"), x.alias("line")))
    failed = F.array(F.struct(F.lit("no answer").alias("message")))
    page = F.struct(
        "source", F.col("doc_id").alias("page"),
        F.struct(F.struct(F.struct((F.col("n_chars") > 100).alias("hasNextPage")).alias("pageInfo"),
                          nodes.alias("nodes")).alias("docs")).alias("data"),
        F.when(F.col("n_chars") > 20000, failed).alias("errors"),
    )
    table(spark, sf, "documents").select(F.to_json(page).alias("value")).write.text(path)
    return read_pages(spark, path, PAGE_SCHEMA, lines=True)


@query(f"""
    SELECT source, doc_id AS page, i - 1 AS number, ls[i] AS line
    FROM (SELECT source, doc_id, {LINES_SQL} AS ls FROM documents), unnest(range(1, len(ls) + 1)) AS t(i)""")
def paged_json(spark, sf):
    """Records of landed JSON pages."""
    nodes = page_nodes(_landed_pages(spark, sf), "data.docs.nodes", ["source", "page"])
    return nodes.select("source", "page", "node.number", "node.line")


@query("""
    SELECT *, end_page IS NOT NULL AND gaps = 0 AND (failed_page IS NULL OR failed_page > end_page) AS complete
    FROM (SELECT source AS page_set, count(DISTINCT doc_id) AS pages_seen, min(doc_id) AS first_page,
                 max(doc_id) AS last_page, min(CASE WHEN n_chars <= 100 THEN doc_id END) AS end_page,
                 min(CASE WHEN n_chars > 20000 THEN doc_id END) AS failed_page,
                 max(doc_id) - min(doc_id) + 1 - count(DISTINCT doc_id) AS gaps
          FROM documents GROUP BY source)""")
def page_set_check(spark, sf):
    """What landed of each page set, and whether it is whole."""
    return check_pages(
        _landed_pages(spark, sf), F.col("page"), page_set=F.col("source"),
        has_next=F.col("data.docs.pageInfo.hasNextPage"), size=F.size("data.docs.nodes"),
        failed=F.col("errors").isNotNull())


@query(f"""
    SELECT name AS tabell, {SQL_STAMP.format("coalesce(last, TIMESTAMP '2024-01-30')")} AS sist_oppdatert
    FROM (SELECT event_type AS name, max(CASE WHEN event_type NOT IN ('error', 'signup') THEN ts END) AS last
          FROM events GROUP BY event_type)""")
def watermark_default(spark, sf):
    """Saved watermarks, and the day before for what was never read."""
    events = table(spark, sf, "events")
    saved = events.filter(~F.col("event_type").isin("error", "signup")).groupBy(
        F.col("event_type").alias("tabell")).agg(F.max("ts").alias("sist_oppdatert"))
    names = events.select(F.col("event_type").alias("tabell")).distinct()
    found = watermarks_or_default(names, saved, dt.datetime(2024, 1, 31, 9))
    return found.select("tabell", stamp(F.col("sist_oppdatert")).alias("sist_oppdatert"))


@query(f"""
    SELECT event_id, user_id, {SQL_STAMP.format("ts")} AS ts FROM events WHERE ts > TIMESTAMP '2024-01-15 06:00:00'""")
def watermark_saved(spark, sf):
    """Two runs over a control table: the second reads on from what the first saved."""
    events = table(spark, sf, "events")
    control = control_table(spark, new_path(spark, "control"))
    after = get_watermark(control, "events", dt.datetime(2024, 1, 10))  # never read: the day before
    until = dt.datetime(2024, 1, 15, 6)
    O.since(events, "ts", after, until).write.format("noop").mode("overwrite").save()
    set_watermark(control, "events", until)
    rows = O.since(events, "ts", get_watermark(control, "events", dt.datetime(2024, 2, 1)))
    return rows.select("event_id", "user_id", stamp(F.col("ts")).alias("ts"))


@query(f"""
    SELECT event_id, user_id, {SQL_STAMP.format("ts")} AS ts FROM events WHERE ts > TIMESTAMP '2024-01-15 06:00:00'""")
def watermark_rerun(spark, sf):
    """A run again over an older slice does not take the next one back."""
    events = table(spark, sf, "events")
    control = control_table(spark, new_path(spark, "control"))
    for until in (dt.datetime(2024, 1, 12), dt.datetime(2024, 1, 15, 6), dt.datetime(2024, 1, 12)):
        O.since(events, "ts", dt.datetime(2024, 1, 10), until).write.format("noop").mode("overwrite").save()
        advance_watermark(control, "events", until)
    rows = O.since(events, "ts", get_watermark(control, "events", dt.datetime(2024, 2, 1)))
    return rows.select("event_id", "user_id", stamp(F.col("ts")).alias("ts"))


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def snapshot_roundtrip(spark, sf):
    """A dated CSV snapshot, read back."""
    customers = table(spark, sf, "customer")
    path = write_snapshot(customers, new_path(spark, "snapshots"), "2024-10-30T08:18:48Z")
    return read_snapshot(spark, path, customers.schema)


@query("SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN 5 ELSE 17 END AS hour FROM customer")
def snapshot_two_slices(spark, sf):
    """Two slices of one date, each still there afterwards."""
    base = new_path(spark, "slices")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name")
    slices = []
    for rest, hour in ((0, 5), (1, 17)):
        path = write_snapshot(customers.filter(F.col("c_custkey") % 2 == rest), base, dt.datetime(2024, 10, 30, hour))
        slices.append((path, hour))
    return O.union_frames([read_snapshot(spark, p, customers.schema).withColumn("hour", F.lit(h)) for p, h in slices])


@query("SELECT s_suppkey, s_acctbal FROM supplier")
def csv_columns(spark, sf):
    """Some columns of a flat CSV."""
    path = new_path(spark, "flat")
    suppliers = table(spark, sf, "supplier")
    write_changes(suppliers, path)
    return read_columns(spark, path, suppliers.schema, ["s_suppkey", "s_acctbal"])


@query("""
    SELECT 'orders' AS stage, count(*) AS rows FROM orders
    UNION ALL SELECT 'after 2000', count(*) FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01'""")
def run_metrics(spark, sf):
    """Rows of each stage of a run, counted while they pass."""
    metrics = RunMetrics(spark)
    orders = table(spark, sf, "orders")
    for name, rows in (("orders", orders), ("after 2000", O.since(orders, "o_orderdate", "2000-01-01"))):
        with metrics.stage(name) as stage:
            stage.watch(rows).write.format("noop").mode("overwrite").save()
    return metrics.frame().select("stage", "rows")


@query(f"""
    SELECT event_id, user_id, event_type, {SQL_STAMP.format("ts")} AS visited_at FROM events
    WHERE user_id IN ({RECENT_SQL})""")
def history_reload(spark, sf):
    """Page views of recent users replace the stored history."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.col("ts").alias("visited_at"))
    target = Table(spark, new_path(spark, "history"), events.schema)
    target.append(events)  # the state before: views of everybody
    target.reload(events.join(_recent(spark, sf), "user_id", "left_semi"))
    return target.read().withColumn("visited_at", stamp(F.col("visited_at")))


# -- streams --------------------------------------------------------------------------------------

LAST_EVENT_SQL = f"""
    SELECT user_id, event_id, event_type, value, {SQL_STAMP.format("ts")} AS ts
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1"""
EVENT_COLUMNS = ["user_id", "event_id", "event_type", "value", "ts"]


def _event_stream(spark: SparkSession, path: str, files_per_batch: int) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _event_files(spark: SparkSession, sf: str, files: int, rows: Column | None = None, mode: str = "overwrite",
                 path: str | None = None) -> str:
    """Events, or some of them, as so many landed files."""
    path = path or new_path(spark, "events")
    events = table(spark, sf, "events").select(*EVENT_COLUMNS)
    (events if rows is None else events.filter(rows)).repartition(files).write.mode(mode).parquet(path)
    return path


def _event_table(spark: SparkSession, sf: str) -> Table:
    schema = table(spark, sf, "events").select(*EVENT_COLUMNS).schema
    return Table(spark, new_path(spark, "last_events"), schema, ["user_id"], buckets=8)


@query(LAST_EVENT_SQL, name="stream_upsert")
def stream_upsert_query(spark, sf):
    """A file stream merged into a stored table in eight batches, the newest version counting."""
    target = _event_table(spark, sf)
    stream_upsert(_event_stream(spark, _event_files(spark, sf, 8), 1), target, ["ts", "event_id"],
                  new_path(spark, "checkpoint"), newest=True).awaitTermination()
    return target.read().withColumn("ts", stamp(F.col("ts")))


@query(LAST_EVENT_SQL)
def stream_late_rows(spark, sf):
    """Late, older versions do not replace what a newer batch brought."""
    target = _event_table(spark, sf)
    events = table(spark, sf, "events").select(*EVENT_COLUMNS)
    target.upsert(O.since(events, "ts", "2024-01-20"), ["ts", "event_id"], newest=True)
    stream_upsert(_event_stream(spark, _event_files(spark, sf, 4), 2), target, ["ts", "event_id"],
                  new_path(spark, "checkpoint"), newest=True).awaitTermination()
    return target.read().withColumn("ts", stamp(F.col("ts")))


@query(LAST_EVENT_SQL)
def stream_two_sources(spark, sf):
    """Two streams, each with its own checkpoint, into one table: no batch is taken for another's."""
    target = _event_table(spark, sf)
    for rest in (0, 1):
        path = _event_files(spark, sf, 2, F.col("event_id") % 2 == rest)
        stream_upsert(_event_stream(spark, path, 1), target, ["ts", "event_id"], new_path(spark, "checkpoint"),
                      newest=True).awaitTermination()
    return target.read().withColumn("ts", stamp(F.col("ts")))


@query(f"""
    SELECT user_id, priority, {SQL_DAY.format("o_orderdate")} AS seen_on FROM (
        SELECT o_custkey AS user_id, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority, o_orderdate,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1""")
def stream_change_files(spark, sf):
    """A folder of gzip change files, streamed into a table four at a time."""
    base = new_path(spark, "stream_changes")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key.id"), F.col("o_custkey").alias("value.user_id"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("value.priority"),
        F.col("o_orderdate").alias("meta.ts"))
    write_changes(rows.repartition(8), f"{base}/landed")
    target = Table(spark, f"{base}/table", "user_id bigint, priority string, ts timestamp_ntz, id bigint", ["user_id"],
                   buckets=8)
    stream_upsert(
        stream_changes(spark, f"{base}/landed", rows.schema, files_per_batch=4), target, ["ts", "id"], f"{base}/checkpoint", newest=True,
        prepare=lambda batch: O.plain(batch, ["value.user_id", "value.priority", "meta.ts", "key.id"]),
    ).awaitTermination()
    return target.read().select("user_id", "priority", day(F.col("ts")).alias("seen_on"))


@query(f"SELECT event_id, user_id, event_type, value, {SQL_STAMP.format('ts')} AS ts FROM events")
def stream_reread(spark, sf):
    """Slices that overlap by a day and a half, read one after the other, each row once.

    The state holds two days, less than the data spans: keys expire on the way.
    """
    ts, first, second = F.col("ts"), "timestamp_ntz'2024-01-12 00:00:00'", "timestamp_ntz'2024-01-22 00:00:00'"
    landed = _event_files(spark, sf, 2, ts < F.expr(first))
    overlap = F.expr("interval 36 hours")
    _event_files(spark, sf, 2, (ts >= F.expr(first) - overlap) & (ts < F.expr(second)), "append", landed)
    _event_files(spark, sf, 2, ts >= F.expr(second) - overlap, "append", landed)
    once = drop_reread(_event_stream(spark, landed, 2), "ts", ["event_id"], "2 days")
    path = new_path(spark, "reread")
    once.writeStream.format("parquet").option("path", path).option(
        "checkpointLocation", new_path(spark, "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).select(
        "event_id", "user_id", "event_type", "value", stamp(F.col("ts")).alias("ts"))


# -- table jobs -----------------------------------------------------------------------------------


@query("""
    SELECT user_id, sis_user_id FROM (
        SELECT o_custkey AS user_id, 'S' || o_orderkey AS sis_user_id,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders WHERE o_orderdate > TIMESTAMP '2000-01-01' AND o_orderstatus <> 'P') WHERE rn = 1""")
def job_user_id_link(spark, sf):
    """Change files of a slice to the id link table, with its watermark."""
    base = new_path(spark, "job_links")
    date = F.col("o_orderdate")
    write_changes(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key.id"), F.col("o_custkey").alias("value.user_id"), date.alias("value.created_at"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("S"), F.col("o_orderkey").cast("string"))).alias(
            "value.sis_user_id"),
        F.timestamp_add("MICROSECOND", F.col("o_orderkey"), date).alias("meta.ts"),
    ), f"{base}/landed")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(2000, 1, 2, 6), buckets=8)
    return jobs.user_id_link(f"{base}/landed", dt.datetime(2001, 8, 1)).read()


@query(f"""
    SELECT o_orderkey AS course_id, o_orderpriority AS name, code AS sis_course_id, {TERM_ID_SQL}::BIGINT AS
               enrollment_term_id,
           CASE WHEN contains(code, '_203_') THEN nullif(split_part(code, '_', 3), '') ELSE ' ' END AS emnekode,
           CASE WHEN contains(code, '_203_') THEN nullif(split_part(code, '_', 4), '') ELSE ' ' END AS versjonskode
    FROM (SELECT *, {CODE_SQL} AS code FROM orders)""")
def job_courses(spark, sf):
    """Landed listing pages to the course table."""
    base = new_path(spark, "job_courses")
    item = F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name"),
        _course_code().alias("sis_course_id"), _term_id().alias("enrollment_term_id"),
    )
    page = F.struct(F.lit(1).alias("page"), F.array(item).alias("items"))
    table(spark, sf, "orders").select(F.to_json(page).alias("value")).write.text(f"{base}/landed")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(2000, 1, 2), buckets=8, lines=True)
    return jobs.courses(f"{base}/landed").read().select(
        "course_id", "name", "sis_course_id", "enrollment_term_id", "emnekode", "versjonskode")


@query(f"""
    WITH terms AS ({TERMS_SQL}), spans AS ({SPAN_SQL}), running AS (
        SELECT * FROM orders
        WHERE {TERM_ID_SQL} IN (SELECT term_id FROM spans WHERE first_half <= 1998.5 AND 1998.5 <= last_half))
    SELECT o_orderkey * 10 + 1 AS enrollment_id, o_custkey AS user_id, o_orderkey AS course_id,
           o_orderstatus AS enrollment_state, CAST(trunc(o_totalprice) AS BIGINT) AS total_activity_time FROM running
    UNION ALL
    SELECT o_orderkey * 10 + 2, o_custkey + 1, o_orderkey, o_orderstatus, NULL FROM running WHERE o_orderstatus = 'F'""")
def job_enrollments(spark, sf):
    """Pages of the running courses to the enrollment table (D04: F05, J01, J05, G03, K02)."""
    base = new_path(spark, "job_enrollments")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(1998, 10, 1), buckets=8, lines=True)
    jobs.table("term").reload(_terms(spark, sf))
    orders = table(spark, sf, "orders")
    jobs.table("course").reload(orders.select(
        F.col("o_orderkey").alias("course_id"), _term_id().alias("enrollment_term_id")))

    def node(number: int, user: Column, seconds: Column) -> Column:
        return F.struct(
            (F.col("o_orderkey") * 10 + number).cast("string").alias("_id"), F.col("o_orderstatus").alias("state"),
            seconds.cast("double").alias("totalActivityTime"), F.struct(user.cast("string").alias("_id")).alias("user"))

    first = node(1, F.col("o_custkey"), F.col("o_totalprice"))
    second = F.when(F.col("o_orderstatus") == "F", node(2, F.col("o_custkey") + 1, F.lit(None)))
    page = F.struct(F.col("o_orderkey").alias("course_id"), F.struct(F.struct(F.struct(
        F.array(first, second).alias("nodes")).alias("enrollmentsConnection")).alias("course")).alias("data"))
    orders.select(F.to_json(page).alias("value")).write.text(f"{base}/landed")
    return jobs.enrollments(f"{base}/landed").read().select(
        "enrollment_id", "user_id", "course_id", "enrollment_state", "total_activity_time")


@query("""
    SELECT page_id AS id, url AS title, split_part(html, '<br', 1) AS teacher, html AS description,
           nullif(regexp_extract(html, 'ID: ?([^<]*)<', 1), '') AS timeedit_id,
           CASE WHEN contains(place, '<') THEN rtrim(split_part(place, '<', 1)) ELSE place END AS location_name
    FROM (SELECT *, substr(html, strpos(html, '<h1>') + 4) AS place FROM pages)
    WHERE NOT contains(url, '/de/') AND NOT contains(url, '/fr/')""")
def job_timetable(spark, sf):
    """Calendar change files with markup and line breaks to the timetable."""
    base = new_path(spark, "job_timetable")
    html = F.col("html")
    write_changes(table(spark, sf, "pages").select(
        F.col("page_id").alias("key.id"), F.col("url").alias("value.title"),
        F.when(F.contains("url", F.lit("/fr/")), F.lit("2022-12-31T23:59:59Z")).otherwise(
            F.lit("2024-01-01T08:00:00Z")).alias("value.start_at"), html.alias("value.description"),
        F.substr(html, F.instr(html, "<h1>") + 4).alias("value.location_name"),
        F.when(F.contains("url", F.lit("/de/")), F.lit("deleted")).otherwise(F.lit("active")).alias(
            "value.workflow_state"),
    ), f"{base}/landed")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(2024, 1, 2), buckets=8)
    return jobs.timetable(f"{base}/landed").read().select(
        "id", "title", "teacher", "description", "timeedit_id", "location_name")


def _jobs(spark: SparkSession, base: str, as_of: dt.datetime) -> Jobs:
    return Jobs(spark, f"{base}/tables", as_of, buckets=8, lines=True)


def _land(rows: DataFrame, page: Column, path: str, per_file: int | None = None) -> None:
    """One JSON page per row; with ``per_file`` in gzip files of so many pages at most, as these cannot be split."""
    landed = rows.select(F.to_json(page).alias("value")).write
    if per_file:
        landed = landed.options(compression="gzip", maxRecordsPerFile=per_file, **{"zlib.compress.level": "BEST_SPEED"})
    landed.text(path)


def _connection(root: str, node: Column) -> Column:
    """A page of a cursor listing with one record."""
    return F.struct(F.struct(F.struct(F.array(node).alias("nodes")).alias(root)).alias("data"))


def _items(*leading: Column, items: Column) -> Column:
    """A page of a numbered listing."""
    return F.struct(*leading, F.lit(1).alias("page"), items.alias("items"))


@query("""
    SELECT c_custkey AS user_id, CASE WHEN c_acctbal > 0 THEN 'S' || c_custkey END AS sis_user_id FROM customer
    WHERE c_mktsegment <> 'MACHINERY' AND c_nationkey >= 5""")
def job_new_users(spark, sf):
    """New users whose record does not mention a text, with their registry id (D02: F01, F03, J03)."""
    base = new_path(spark, "job_users")
    customers = table(spark, sf, "customer")
    created = F.when(F.col("c_nationkey") >= 5, F.lit("2024-01-01T00:00:00")).otherwise(F.lit("2023-12-31T00:00:00"))
    write_changes(customers.select(
        F.col("c_custkey").alias("key.id"), created.alias("value.created_at"), F.col("c_name").alias("value.name"),
        F.col("c_mktsegment").alias("value.school_name"), created.alias("meta.ts")), f"{base}/landed")
    links = customers.filter(F.col("c_acctbal") > 0).select(
        F.col("c_custkey").alias("user_id"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("sis_user_id"))
    jobs = _jobs(spark, base, dt.datetime(2024, 1, 2, 6))
    return jobs.new_users(f"{base}/landed", links, dt.datetime(2024, 1, 2, 5), exclude="machinery").read()


@query(f"""
    SELECT o_orderkey AS enrollment_id, o_custkey AS user_id, o_orderstatus AS enrollment_state,
           CASE WHEN o_orderstatus = 'O' THEN 0 ELSE CAST(trunc(o_totalprice) AS BIGINT) END AS total_activity_time,
           {SQL_DAY.format("o_orderdate")} AS updated_on, CAST(NULL AS VARCHAR) AS sis_user_id
    FROM orders""")
def job_changed_enrollments(spark, sf):
    """Change files to the enrollment table (D03: P01, P02, X09, K02)."""
    base = new_path(spark, "job_changes")
    write_changes(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("key.id"), F.col("o_custkey").alias("value.user_id"),
        F.col("o_orderstatus").alias("value.workflow_state"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_totalprice")).alias("value.total_activity_time"),
        F.col("o_orderdate").alias("value.updated_at")), f"{base}/landed")
    rows = _jobs(spark, base, dt.datetime(2001, 8, 2)).changed_enrollments(f"{base}/landed", dt.datetime(2001, 8, 2)).read()
    return rows.select("enrollment_id", "user_id", "enrollment_state", "total_activity_time",
                       day(F.col("updated_at")).alias("updated_on"), "sis_user_id")


def _running_jobs(spark: SparkSession, sf: str, base: str) -> Jobs:
    """Jobs with term and course tables in place: every order is a course of its term."""
    jobs = _jobs(spark, base, dt.datetime(1998, 10, 1))
    jobs.table("term").reload(_terms(spark, sf))
    jobs.table("course").reload(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("course_id"), _term_id().alias("enrollment_term_id")))
    return jobs


RUNNING_SQL = f"""terms AS ({TERMS_SQL}), spans AS ({SPAN_SQL}), running AS (
    SELECT * FROM orders
    WHERE {TERM_ID_SQL} IN (SELECT term_id FROM spans WHERE first_half <= 1998.5 AND 1998.5 <= last_half))"""


@query(f"""
    WITH {RUNNING_SQL}
    SELECT o_custkey AS id, o_orderkey AS course_id,
           CAST(CASE WHEN o_orderstatus = 'F' THEN 70 ELSE 7 END AS INTEGER) AS page_views, 3 AS floating,
           CASE WHEN o_orderstatus = 'F' THEN 20 ELSE 2 END AS late FROM running
    UNION ALL
    SELECT o_custkey + 1, o_orderkey, 70, NULL, 20 FROM running WHERE o_orderstatus = 'F'""")
def job_summaries(spark, sf):
    """Student summaries from flat pages, then from nested ones that lack a column."""
    base = new_path(spark, "job_summaries")
    jobs = _running_jobs(spark, sf, base)
    orders = table(spark, sf, "orders")
    course, student = F.col("o_orderkey").alias("course_id"), F.col("o_custkey")
    flat = F.struct(student.alias("id"), F.lit(7).alias("page_views"), F.struct(
        F.lit(2).alias("late"), F.lit(3).alias("floating")).alias("tardiness_breakdown"))
    _land(orders, _items(course, items=F.array(flat)), f"{base}/flat")
    jobs.student_summaries(f"{base}/flat")

    def node(user: Column, known: bool) -> Column:
        analytics = F.struct(F.struct(F.lit(70).alias("total")).alias("pageViews"),
                             F.struct(F.lit(20).alias("late")).alias("tardinessBreakdown"))
        return F.struct(user.cast("string").alias("_id"),
                        F.when(F.lit(known), analytics).alias("summaryAnalytics"))

    nodes = F.array(node(student, True), node(student + 1, True), node(student + 2, False))
    page = F.struct(course, F.struct(F.struct(F.struct(nodes.alias("nodes")).alias("usersConnection")).alias(
        "course")).alias("data"))
    _land(orders.filter(F.col("o_orderstatus") == "F"), page, f"{base}/nested")
    return jobs.student_summaries(f"{base}/nested", nested=True).read().select(
        "id", "course_id", "page_views", "floating", "late")


@query(f"""
    WITH {RUNNING_SQL}
    SELECT o_orderkey AS module_id, i AS module_item_id, o_orderkey AS course_id, 'm' || o_custkey AS name,
           CASE WHEN i = 2 THEN o_orderpriority END AS external_url, i = 1 AS item_published, o_orderstatus = 'F' AS
               published, 2 AS items_count
    FROM running, (SELECT unnest([1::BIGINT, 2::BIGINT]) AS i)""")
def job_modules(spark, sf):
    """Modules of the running courses to the item table."""
    base = new_path(spark, "job_modules")
    jobs = _running_jobs(spark, sf, base)

    def item(number: int) -> Column:
        url = F.when(F.lit(number == 2), F.col("o_orderpriority"))
        return F.struct(F.lit(number).alias("id"), F.lit(number == 1).alias("published"), url.alias("external_url"))

    module = F.struct(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("m"), F.col("o_custkey").cast("string")).alias("name"),
        (F.col("o_orderstatus") == "F").alias("published"), F.lit(2).alias("items_count"),
        F.array(item(1), item(2)).alias("items"))
    _land(table(spark, sf, "orders"), _items(F.col("o_orderkey").alias("course_id"), items=F.array(module)),
          f"{base}/landed")
    return jobs.module_items(f"{base}/landed").read().select(
        "module_id", "module_item_id", "course_id", "name", "external_url", "item_published", "published", "items_count")


@query(f"""
    SELECT user_id, event_type AS visited_url, CAST(NULL AS VARCHAR) AS asset_readable_category,
           {SQL_STAMP.format("ts")} AS visited_at
    FROM events WHERE user_id IN (
        SELECT c_custkey FROM customer JOIN orders ON o_custkey = c_custkey
        WHERE c_acctbal > 9000 OR o_orderdate > TIMESTAMP '2001-07-30 06:00:00')""")
def job_history(spark, sf):
    """Landed page views of recently active users replace the history."""
    base = new_path(spark, "job_history")
    jobs = _jobs(spark, base, dt.datetime(2001, 8, 1, 6))
    login = F.when(F.col("c_acctbal") > 9000, F.lit("2001-07-31")).otherwise(F.lit("2001-07-01"))
    jobs.table("user").reload(table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), login.cast("timestamp").alias("last_login")))
    jobs.table("enrollment").reload(table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("enrollment_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("last_activity_at")))
    view = F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("visited_at"),
                    F.col("event_type").alias("visited_url"))
    _land(table(spark, sf, "events"), _items(F.col("user_id"), items=F.array(view)), f"{base}/landed")
    return jobs.history(f"{base}/landed").read().withColumn("visited_at", stamp(F.col("visited_at")))


@query(f"""
    SELECT 'K' || o_orderkey AS "Emnekode", 'S' || o_custkey AS "Studieprogramkode", y AS "Undervises_forste_ar",
           CASE WHEN o_orderstatus = 'O' THEN y + 3 END AS "Undervises_siste_ar",
           CASE WHEN o_orderstatus = 'O' THEN 'HOST' END AS "Undervises_siste_termin",
           'S' || o_custkey || '_K' || o_orderkey || '_1' AS "programEmneKode"
    FROM (SELECT *, CAST(year(o_orderdate) AS INTEGER) AS y FROM orders)
    UNION ALL
    SELECT 'K' || o_orderkey, NULL, CAST(year(o_orderdate) AS INTEGER), NULL, NULL, NULL FROM orders
    WHERE o_orderstatus = 'F'""")
def job_course_programmes(spark, sf):
    """Course-programme links to their table, rows without programme kept apart."""
    base = new_path(spark, "job_links")
    year, status = F.year("o_orderdate"), F.col("o_orderstatus")

    def term(y: Column) -> Column:
        return F.struct(y.alias("arstall"), F.struct(F.lit("HOST").alias("kode")).alias("betegnelse"))

    link = F.struct(
        F.struct(F.when(status == "O", term(year + 3)).alias("tilTermin")).alias("periode"),
        F.struct(F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("kode")).alias("studieprogram"))
    node = F.struct(
        F.concat(F.lit("K"), F.col("o_orderkey").cast("string")).alias("kode"), F.lit("1").alias("versjonskode"),
        F.when(status == "F", F.array(link, F.when(F.lit(False), link))).otherwise(F.array(link)).alias(
            "studieprogramkoblinger"),
        F.struct(term(year).alias("forsteTermin")).alias("undervisesIPeriode"))
    _land(table(spark, sf, "orders"), _connection("emner", node), f"{base}/landed")
    rows = _jobs(spark, base, dt.datetime(2001, 8, 1)).course_programmes(f"{base}/landed", blank_keys=False).read()
    return rows.select("Emnekode", "Studieprogramkode", "Undervises_forste_ar", "Undervises_siste_ar",
                       "Undervises_siste_termin", "programEmneKode")


@query(f"""
    SELECT 'D' || doc_id || '_1' AS unik_kode, lang AS emnenavn_nob, CAST(n_chars AS DOUBLE) AS vekting,
           coalesce([x FOR x IN ls IF length(x) % 2 = 0][-1], '{NOT_REGISTERED}') AS "LUB_NNO",
           coalesce([x FOR x IN ls IF length(x) % 2 = 1][-1], '{NOT_REGISTERED}') AS "ARB_ENG",
           CASE WHEN len([x FOR x IN ls IF x = '']) > 0 THEN '"{NOT_REGISTERED}"'
               ELSE '[' || array_to_string(['[' || to_json(x) || ', ' || to_json(lang) || ', null]' FOR x IN ls], ', ')
                    || ']' END AS emneansvarlege
    FROM (SELECT doc_id, lang, n_chars, source, {LINES_SQL} AS ls FROM documents) WHERE n_chars > 50""")
def job_course_catalogue(spark, sf):
    """Catalogue pages to the course table and the table of people."""
    base = new_path(spark, "job_catalogue")

    def nb(value: Column) -> Column:
        return F.struct(value.alias("nb"))

    texts = F.transform(_lines(), lambda x: F.struct(
        x.alias("innhold"),
        F.struct(F.when(F.length(x) % 2 == 0, F.lit("NNO")).otherwise(F.lit("ENG")).alias("iso6392Kode")).alias("sprak"),
        F.struct(F.when(F.length(x) % 2 == 0, F.lit("EBLUB")).otherwise(F.lit("EBARB")).alias("kode")).alias(
            "tekstkategori")))
    people = F.transform(_lines(), lambda x: F.struct(
        F.struct(F.when(x != "", F.struct(F.col("lang").alias("etternavn"), x.alias("fornavn"))).alias("navn")).alias(
            "personProfil"),
        F.struct(F.lit(None).cast("string").alias("feideBruker"), F.lit("").alias("_")).alias("fagperson")))
    unit = F.struct(F.struct(F.lit("1").alias("fakultetsnummer")).alias("fakultet"), nb(F.lit("i")).alias("navnAlleSprak"))
    subject = F.when(F.col("n_chars") > 50, F.struct(F.struct(F.lit("f").alias("nob")).alias("navnAlleSprak")))
    node = F.struct(
        F.concat(F.lit("D"), F.col("doc_id").cast("string")).alias("kode"), F.lit("1").alias("versjonskode"),
        nb(F.col("lang")).alias("navnAlleSprak"), F.struct(unit.alias("administrativtAnsvarlig")).alias("organisasjonsenhet"),
        F.struct(subject.alias("viktigsteFag")).alias("fagkoblinger"),
        F.struct(F.struct(F.struct(F.lit("SP").alias("kode")).alias("vektingstype"),
                          F.col("n_chars").alias("verdi")).alias("emnevekting")).alias("vekting"),
        texts.alias("beskrivelser"), people.alias("personroller"))
    _land(table(spark, sf, "documents"), _connection("emner", node), f"{base}/landed", per_file=2000)
    courses, responsible = _jobs(spark, base, dt.datetime(2024, 1, 1)).course_catalogue(f"{base}/landed")
    return courses.read().join(responsible.read(), "unik_kode").select(
        "unik_kode", "emnenavn_nob", "vekting", "LUB_NNO", "ARB_ENG", "emneansvarlege")


@query("""
    SELECT 'P' || p_partkey AS studieprogramkode, p_name AS studieprogramnavn, p_size AS "prosentAvHeltid",
           CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS studieniva,
           CASE WHEN p_size > 10 THEN p_retailprice END AS vekting, '' AS nuskode
    FROM part""")
def job_study_programmes(spark, sf):
    """Study programmes with absent parts."""
    base = new_path(spark, "job_programmes")
    size = F.col("p_size")
    node = F.struct(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("kode"),
        F.struct(F.col("p_name").alias("nb")).alias("navnAlleSprak"), size.cast("double").alias("prosentHeltid"),
        F.when(size > 25, F.struct(F.struct(F.col("p_brand").alias("nb")).alias("navnAlleSprak"))).alias("studieniva"),
        F.struct(F.when(size > 10, F.col("p_retailprice").cast("string")).otherwise(F.lit("")).alias("verdi")).alias(
            "vekting"))
    _land(table(spark, sf, "part"), _connection("studieprogram", node), f"{base}/landed")
    return _jobs(spark, base, dt.datetime(2024, 1, 1)).study_programmes(f"{base}/landed").read().select(
        "studieprogramkode", "studieprogramnavn", "prosentAvHeltid", "studieniva", "vekting", "nuskode")


@query("""
    SELECT CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) ELSE '' END AS plnr,
           'S' || o_orderkey AS studieprogram, '' AS campus, CAST(year(o_orderdate) AS INTEGER) AS "år", '' AS termin
    FROM orders""")
def job_programme_rights(spark, sf):
    """Programme rights by person and programme, missing persons blank."""
    base = new_path(spark, "job_rights")
    person = F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_custkey").cast("string").alias("personlopenummer")))
    node = F.struct(
        person.alias("personProfil"),
        F.struct(F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("kode")).alias("studieprogram"),
        F.struct(F.struct(F.year("o_orderdate").alias("arstall")).alias("termin")).alias("kull"))
    _land(table(spark, sf, "orders"), _connection("programStudieretter", node), f"{base}/landed")
    return _jobs(spark, base, dt.datetime(2024, 1, 1)).programme_rights(
        f"{base}/landed", keys=("plnr", "studieprogram")).read()


@query(f"""
    SELECT CAST(doc_id AS VARCHAR) AS plnr, '[' || array_to_string([
               '{{"code":' || to_json(split_part(x, ' ', 1)) || ',"weight":' || length(x) || '.0,"semester":"'
               || n_chars || '_' || lang || '"}}' FOR x IN ls], ',') || ']' AS programmes
    FROM (SELECT doc_id, lang, n_chars, [x FOR x IN {LINES_SQL} IF contains(x, 'the')] AS ls FROM documents)
    WHERE len(ls) > 0""")
def job_study_rights(spark, sf):
    """Study programmes per student to a dated CSV, read back."""
    base = new_path(spark, "job_study_rights")
    semester = F.struct(F.col("n_chars").alias("arstall"), F.struct(F.col("lang").alias("kode")).alias("betegnelse"))
    entries = F.transform(F.filter(_lines(), lambda x: F.contains(x, F.lit("the"))), lambda x: F.struct(
        F.struct(F.get(F.split(x, " "), 0).alias("kode"), F.struct(F.length(x).alias("verdi")).alias("vekting")).alias(
            "studieprogram"), semester.alias("termin")))
    node = F.struct(entries.alias("studieprogramISemester"),
                    F.struct(F.col("doc_id").cast("string").alias("personlopenummer")).alias("personProfil"))
    _land(table(spark, sf, "documents"), _connection("studenter", node), f"{base}/landed")
    path = _jobs(spark, base, dt.datetime(2024, 1, 1)).study_rights(f"{base}/landed", f"{base}/snapshots")
    return read_snapshot(spark, path, "plnr string, programmes string")


@query("SELECT s_suppkey AS id, s_name AS name FROM supplier")
def job_snapshot(spark, sf):
    """A slice of one change-file table to a dated CSV, with its watermark."""
    base = new_path(spark, "job_snapshot")
    write_changes(table(spark, sf, "supplier").select(
        F.col("s_name").alias("value.name"), F.col("s_acctbal").alias("value.unread"),
        F.col("s_suppkey").alias("key.id")), f"{base}/landed")
    path = _jobs(spark, base, dt.datetime(2024, 1, 1)).snapshot("roles", f"{base}/landed", dt.datetime(2024, 1, 1),
                                                                 f"{base}/snapshots")
    return O.plain(read_snapshot(spark, path, CHANGE_FILES["roles"]), ["key.id", "value.name"])


@query("""
    SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS record FROM supplier WHERE s_nationkey % 3 = 0
    UNION ALL SELECT NULL, NULL, '" ' || s_name || '"' || CASE WHEN s_nationkey % 3 = 1 THEN ',' || s_suppkey || ',surplus' ELSE '' END
    FROM supplier WHERE s_nationkey % 3 <> 0""")
def job_snapshot_records(spark, sf):
    """A slice with records that have a field too many or are cut off: all of it is kept and proved."""
    base = new_path(spark, "job_snapshot_records")
    name, key, part = F.col("s_name"), F.col("s_suppkey").cast("string"), F.col("s_nationkey") % 3
    odd = F.concat(F.lit('" '), name, F.lit('"'))
    record = F.when(part == 0, F.concat(name, F.lit(","), key)).when(part == 1, F.concat(odd, F.lit(","), key, F.lit(",surplus"))).otherwise(odd)
    files = table(spark, sf, "supplier").groupBy("s_nationkey").agg(F.concat_ws("\n", F.collect_list(record)).alias("lines"))
    files.select(F.concat(F.lit("value.name,key.id\n"), F.col("lines"))).write.option("maxRecordsPerFile", 1).text(f"{base}/landed")
    path = _jobs(spark, base, dt.datetime(2024, 1, 1)).snapshot("roles", f"{base}/landed", dt.datetime(2024, 1, 1), f"{base}/snapshots")
    rows = O.plain(read_snapshot(spark, path, CHANGE_FILES["roles"]), ["key.id", "value.name"])
    return rows.withColumn("record", F.lit(None).cast("string")).unionByName(
        snapshot_records(spark, path).select(F.lit(None).cast("bigint").alias("id"), F.lit(None).cast("string").alias("name"), "record"))


QUARANTINE_SQL = """
    SELECT o_orderkey || CASE o_orderstatus WHEN 'P' THEN '.0' ELSE '' END AS id,
           CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '1-URGENT' THEN 'put aside' ELSE 'loaded' END AS outcome,
           CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END + CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS faults
    FROM orders"""


@query(QUARANTINE_SQL)
def stream_quarantine(spark, sf):
    """A stream whose unreadable rows are put aside batch by batch, and then run again."""
    base, schema = new_path(spark, "stream_quarantine"), "`key.id` bigint, `value.user_id` bigint, `value.updated_at` timestamp"
    key = F.col("o_orderkey").cast("string")
    rows = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat(key, F.lit(".0"))).otherwise(key).alias("key.id"),
        F.col("o_custkey").alias("value.user_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("no time")).otherwise(F.lit("2024-01-01T08:00:00Z")).alias("value.updated_at"))
    write_changes(rows.repartition(6, "`key.id`"), f"{base}/landed")
    target = Table(spark, f"{base}/table", "id bigint, user_id bigint, updated_at timestamp", ["id"], buckets=8)
    for _ in range(2):  # the second run finds nothing new
        stream_checked(
            stream_texts(spark, f"{base}/landed", schema, files_per_batch=2), schema, target, ["updated_at", ARRIVAL],
            f"{base}/checkpoint", f"{base}/quarantine", null_keys="reject",
            prepare=lambda good: O.plain(good, {"key.id": "id", "value.user_id": "user_id", "value.updated_at": "updated_at", ARRIVAL: ARRIVAL, "_row": "_row"}),
        ).awaitTermination()
    aside = spark.read.schema("raw struct<`key.id`: string>, bad_columns array<string>").json(f"{base}/quarantine")
    return target.read().select(F.col("id").cast("string").alias("id"), F.lit("loaded").alias("outcome"), F.lit(0).alias("faults")).union(
        aside.select(F.col("raw")["key.id"], F.lit("put aside"), F.size("bad_columns")))


@query("""
    WITH pages AS (
        SELECT o_custkey AS s, o_orderkey AS k, o_orderpriority <> '1-URGENT' AS landed,
               lag(o_orderkey) OVER w IS NULL AS is_first, lead(o_orderkey) OVER w IS NULL AS is_last,
               lead(o_orderpriority <> '1-URGENT') OVER w AS next_landed,
               min(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) OVER (PARTITION BY o_custkey) AS first_gap
        FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)),
    sets AS (
        SELECT s, bool_or(NOT is_first) AS linked, bool_or(is_first) AS begun, bool_or(is_last) AS ended, count(*) AS seen,
               count(*) FILTER (WHERE first_gap IS NULL OR k < first_gap) AS steps
        FROM pages WHERE landed GROUP BY s)
    SELECT CAST(s AS VARCHAR) AS page_set, 'missing page' AS reason, CAST(k AS VARCHAR) AS at
    FROM pages JOIN sets USING (s) WHERE landed AND linked AND next_landed = false
    UNION ALL SELECT CAST(s AS VARCHAR), 'missing page', NULL FROM sets WHERE linked AND NOT begun
    UNION ALL SELECT CAST(s AS VARCHAR), 'missing end', NULL FROM sets WHERE NOT ended
    UNION ALL SELECT CAST(s AS VARCHAR), 'unreached', CAST(seen - steps AS VARCHAR) FROM sets WHERE linked AND begun AND steps < seen""")
def job_page_gap(spark, sf):
    """Pages of cursor listings of which some never landed: what is missing of each set is recorded."""
    base = new_path(spark, "job_page_gap")
    order = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    info = F.struct(F.col("o_orderkey").cast("string").alias("endCursor"), F.lead("o_orderkey").over(order).isNotNull().alias("hasNextPage"))
    node = F.struct(F.col("o_orderkey").cast("string").alias("_id"), F.struct(F.col("o_custkey").cast("string").alias("_id")).alias("user"))
    page = F.struct(
        F.col("o_custkey").alias("course_id"), F.lag("o_orderkey").over(order).cast("string").alias("after"),
        F.struct(F.struct(F.struct(info.alias("pageInfo"), F.array(node).alias("nodes")).alias("enrollmentsConnection")).alias("course")).alias("data"))
    pages = table(spark, sf, "orders").select("o_orderpriority", F.to_json(page).alias("value"))
    pages.filter(F.col("o_orderpriority") != "1-URGENT").select("value").write.text(f"{base}/landed")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(1998, 10, 1), buckets=8, lines=True, failed_pages="skip")
    jobs.enrollments(f"{base}/landed")
    return spark.read.schema("page_set string, reason string, at string").json(f"{base}/tables/quarantine/enrollments").select(
        "page_set", "reason", "at")


@query(QUARANTINE_SQL)
def job_quarantine(spark, sf):
    """Change rows with values that cannot be read are put aside with their faults, the others loaded."""
    base = new_path(spark, "job_quarantine")
    key = F.col("o_orderkey").cast("string")
    write_changes(table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "P", F.concat(key, F.lit(".0"))).otherwise(key).alias("key.id"),
        F.col("o_custkey").alias("value.user_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("no time")).otherwise(F.lit("2024-01-01T08:00:00Z")).alias(
            "value.updated_at")), f"{base}/landed")
    jobs = _jobs(spark, base, dt.datetime(2024, 1, 2))
    loaded = jobs.changed_enrollments(f"{base}/landed", dt.datetime(2024, 1, 2)).read()
    aside = spark.read.schema("raw struct<`key.id`: string>, bad_columns array<string>").json(f"{base}/tables/quarantine/enrollments")
    return loaded.select(F.col("enrollment_id").cast("string").alias("id"), F.lit("loaded").alias("outcome"), F.lit(0).alias("faults")).union(
        aside.select(F.col("raw")["key.id"], F.lit("put aside"), F.size("bad_columns")))


@query("""
    SELECT o_orderkey AS term_id, 'loaded' AS outcome FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT NULL, CASE o_orderstatus WHEN 'P' THEN 'unreadable' ELSE 'no list' END FROM orders WHERE o_orderstatus <> 'F'""")
def job_incomplete_pages(spark, sf):
    """Listing pages of which some are cut off and some hold an error: put aside by request, never dropped."""
    base = new_path(spark, "job_incomplete")
    page = F.to_json(_items(items=F.array(F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("name")))))
    text = F.when(F.col("o_orderstatus") == "F", page).when(F.col("o_orderstatus") == "P", F.substring(page, 1, 30)).otherwise(
        F.lit('{"errors": [{"message": "no"}]}'))
    table(spark, sf, "orders").select(text.alias("value")).write.text(f"{base}/landed")
    jobs = Jobs(spark, f"{base}/tables", dt.datetime(2024, 1, 2), buckets=8, lines=True, failed_pages="skip")
    loaded = jobs.terms(f"{base}/landed").read().select("term_id", F.lit("loaded").alias("outcome"))
    aside = spark.read.schema("reason string").json(f"{base}/tables/quarantine/terms")
    return loaded.union(aside.select(F.lit(None).cast("bigint"), "reason"))


@query(f"""
    SELECT c_custkey AS user_id, 'S' || c_custkey AS sis_user_id, c_mktsegment AS root_account,
           CASE WHEN c_acctbal > 0 THEN '2024-01-01 08:00:00.000000' END AS last_login FROM customer""")
def job_users(spark, sf):
    """Landed listing pages to the user table."""
    base = new_path(spark, "job_user_pages")
    item = F.struct(
        F.col("c_custkey").alias("id"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("sis_user_id"),
        F.col("c_mktsegment").alias("root_account"),
        F.when(F.col("c_acctbal") > 0, F.lit("2024-01-01T08:00:00Z")).alias("last_login"))
    _land(table(spark, sf, "customer"), _items(items=F.array(item)), f"{base}/landed")
    return _jobs(spark, base, dt.datetime(2024, 1, 2)).users(f"{base}/landed").read().select(
        "user_id", "sis_user_id", "root_account", stamp(F.col("last_login")).alias("last_login"))


@query(f"""
    SELECT CAST(o_custkey AS VARCHAR) AS plnr, 'S' || max(o_orderkey) AS studieprogram FROM orders GROUP BY o_custkey""")
def job_programme_rights_by_person(spark, sf):
    """One programme right for a person, the last of the page (D11 by its default key)."""
    base = new_path(spark, "job_person_rights")
    right = F.struct(F.col("o_orderkey"), F.struct(
        F.struct(F.col("o_custkey").cast("string").alias("personlopenummer")).alias("personProfil"),
        F.struct(F.concat(F.lit("S"), F.col("o_orderkey").cast("string")).alias("kode")).alias("studieprogram")).alias("node"))
    pages = table(spark, sf, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(right)).alias("rights"))
    nodes = F.transform("rights", lambda r: r["node"])
    _land(pages, F.struct(F.struct(F.struct(nodes.alias("nodes")).alias("programStudieretter")).alias("data")), f"{base}/landed")
    return _jobs(spark, base, dt.datetime(2024, 1, 1)).programme_rights(f"{base}/landed").read().select("plnr", "studieprogram")


@query(f"""
    WITH {RUNNING_SQL}
    SELECT o_orderkey AS enrollment_id, o_custkey AS user_id, o_orderstatus AS enrollment_state,
           {SQL_STAMP.format("o_orderdate")} AS start_at FROM running
    UNION ALL
    SELECT o_orderkey, NULL, 'old', {SQL_STAMP.format("o_orderdate")} FROM orders
    WHERE o_orderkey NOT IN (SELECT o_orderkey FROM running)""")
def job_enrollments_filled(spark, sf):
    """Pages that lack some columns, into a filled table: what they do not bring stays."""
    base = new_path(spark, "job_filled")
    jobs = _running_jobs(spark, sf, base)
    orders = table(spark, sf, "orders")
    jobs.table("enrollment").reload(orders.select(
        F.col("o_orderkey").alias("enrollment_id"), F.lit("old").alias("enrollment_state"),
        F.col("o_orderdate").alias("start_at")))
    node = F.struct(
        F.col("o_orderkey").cast("string").alias("_id"), F.col("o_orderstatus").alias("state"),
        F.struct(F.col("o_custkey").cast("string").alias("_id")).alias("user"))
    page = F.struct(F.col("o_orderkey").alias("course_id"), F.struct(F.struct(F.struct(
        F.array(node).alias("nodes")).alias("enrollmentsConnection")).alias("course")).alias("data"))
    _land(orders, page, f"{base}/landed")
    return jobs.enrollments(f"{base}/landed").read().select(
        "enrollment_id", "user_id", "enrollment_state", stamp(F.col("start_at")).alias("start_at"))
