"""

Queries are jobs as a user writes them: a spec goes through ``build`` or ``run``. Sink queries write
to a fresh folder under the session's shared scratch folder and return what they read back.
"""

from __future__ import annotations

import dataclasses
import os
import sys
import uuid
from collections.abc import Callable, Sequence

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tableflow import PipelineSpec, build, register, run
from tableflow.functions import (
    cell_text,
    decode_value,
    diff_seconds,
    encode_value,
    now_text,
    parse_long,
    suffix_values,
    text_bytes,
)
from tableflow.operators import region_of, row_to_cells, split_keys
from tableflow.session import scratch_folder

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function's name, with the SQL that gives the same rows."""

    def add(function: Query) -> Query:
        _queries[function.__name__] = function
        _oracles[function.__name__] = sql
        return function

    return add


def add_training_data_queries() -> None:
    """Register the training-data operators and their pipeline, where they are installed."""
    try:
        import corpus_pipeline
        from tableflow.llm import registry
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "tableflow.llm"):
            raise
        return
    _queries.update(registry.QUERIES, pipeline=corpus_pipeline.run)
    _oracles.update(registry.ORACLES)
    if corpus_pipeline.ORACLE_SQL:
        _oracles["pipeline"] = corpus_pipeline.ORACLE_SQL


def entry(spark: SparkSession) -> DataFrame:
    return flagship_conform(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracles)


# ---------------------------------------------------------------------------------------------
# Helpers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def files(sf_dir: str, name: str, columns: str = "", join: str = "", **more) -> dict:
    """A file source over one of the given tables, called by the table's name."""
    source = {"id": name, "source": "hdfs", "format": "parquet", "join": join}
    source["location"] = f"{sf_dir}/{name}.parquet"
    if columns:
        source["columns"] = columns.split()
    return source | more


def job(*sources: dict, **shape) -> PipelineSpec:
    """A spec over the sources; they join in the order given."""
    indexed = [{"index": at} | source for at, source in enumerate(sources, 1)]
    target, metrics = shape.pop("target", None), shape.pop("metrics", None)
    keys = {"where": "where.clause", "add": "add.columns", "select": "select"}
    body = {"mapping": indexed} | {keys[name]: value for name, value in shape.items()}
    more = {"target": target, "metrics": {"location": metrics}}
    return PipelineSpec.from_dict({"source": body} | more)


def write_files_and_read(
    spark: SparkSession, sf_dir: str, kind: str, compression: str, columns: str, **read
) -> DataFrame:
    """Orders written in a format, then read back from it."""
    folder = scratch_folder(spark, kind)
    options = {"location": folder, "format": kind, "compression": compression, "mode": "overwrite"}
    target = {"place": "hdfs", "options": options}
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    back = {"id": "back", "source": "hdfs", "format": kind, "location": folder, "join": "back"}
    return build(spark, job(back | ({"columns": columns.split()} if columns else {}) | read))


ORDERS = "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority"
CUSTOMER = "c_custkey c_name c_nationkey c_acctbal c_mktsegment"
CUSTOMER_TYPES = {
    "c_custkey": "bigint",
    "c_name": "string",
    "c_nationkey": "int",
    "c_acctbal": "double",
    "c_mktsegment": "string",
}


def typed_columns(types: dict[str, str]) -> list:
    return [decode_value(F.col(name), kind).alias(name) for name, kind in types.items()]


def customer_target(folder: str, **options) -> dict:
    return {"place": "hbase", "options": {"tablename": f"{folder}/cells", "cf": "data"} | options}


def bulk(folder: str, regions: int = 8, **options) -> dict:
    more = {"bulkload": True, "num-regions": regions, "bulk-stg": f"{folder}/staging"}
    return customer_target(folder, **more, **options)


def bucketed(folder: str, table: str, key: str) -> dict:
    """A bulk load into a new table bucketed by row key."""
    options = {"tablename": table, "cf": "data", "key-columns": [key], "bulkload": True, "buckets": 8}
    options |= {"bulk-stg": f"{folder}/staging", "location": f"{folder}/{table}"}
    return {"place": "hbase", "options": options}


def cell_source(location: str, columns: Sequence[str], cf: str = "data", **custom) -> dict:
    mapping = {name: name for name in columns}
    return {
        "id": "wide",
        "source": "hbase",
        "location": location,
        "column.family": cf,
        "custom": {"mapping": mapping} | custom,
        "join": "wide",
    }


def read_customer_cells(spark: SparkSession, folder: str) -> DataFrame:
    wide = build(spark, job(cell_source(f"{folder}/cells", list(CUSTOMER_TYPES))))
    return wide.select(*typed_columns(CUSTOMER_TYPES))


@register("events_as_cells")
def events_as_cells(spark: SparkSession, source) -> DataFrame:
    """A user-written source: each event is a cell of its user, its time the version."""
    events = spark.read.parquet(source.location)
    return events.select(
        F.col("user_id").cast("string").alias("rowkey"),
        F.lit("raw").alias("cf"),
        F.col("event_type").alias("qualifier"),
        F.col("ts").alias("version"),
        F.col("value").cast("string").alias("value"),
    )


@register("open_orders")
def open_orders(spark: SparkSession, source) -> DataFrame:
    """A user-written source that takes its parameter from ``custom``."""
    orders = spark.read.parquet(source.location)
    return orders.where(F.col("o_orderstatus") == source.custom["status"])


@register("sorted_copy")
class SortedCopy:
    """A user-written sink."""

    def save(self, df: DataFrame, spark: SparkSession, target) -> None:
        df.sortWithinPartitions(target.option("by")).write.parquet(target.option("folder"))


# ---------------------------------------------------------------------------------------------
# Sources, projection, filters


@query("""
    select o.o_orderkey, o.o_totalprice, o.o_orderpriority, c.c_name, n.n_name, 'N' as src_ind
    from orders o join customer c on o.o_custkey = c.c_custkey
    left join nation n on c.c_nationkey = n.n_nationkey
    where o.o_totalprice > 1000 and o.o_orderpriority not like '%URGENT%'
""")
def flagship_conform(spark, sf_dir):
    return build(
        spark,
        job(
            files(
                sf_dir,
                "orders",
                "o_orderkey o_custkey o_totalprice o_orderpriority",
                "orders",
                where="o_totalprice > 1000",
            ),
            files(
                sf_dir,
                "customer",
                "c_custkey c_name c_nationkey",
                "inner join customer on orders.o_custkey = customer.c_custkey",
            ),
            files(
                sf_dir,
                "nation",
                "n_nationkey n_name",
                "left outer join nation on customer.c_nationkey = nation.n_nationkey",
            ),
            where="o_orderpriority not like '%URGENT%'",
            add=[["src_ind", "'N'"]],
            select=["o_orderkey", "o_totalprice", "o_orderpriority", "c_name", "n_name"],
        ),
    )


@query("select o_custkey from orders where o_orderstatus <> 'P'")
def source_where_unselected(spark, sf_dir):
    source = files(sf_dir, "orders", "o_custkey", "orders", where="o_orderstatus <> 'P'")
    return build(spark, job(source))


@query("select o_orderkey, o_totalprice from orders where o_orderstatus = 'F'")
def table_source(spark, sf_dir):
    name = f"tableflow_{uuid.uuid4().hex}"
    options = {"tablename": name, "format": "orc", "location": scratch_folder(spark, "table")}
    target = {"place": "hive", "options": options}
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    source = {"id": "t", "source": "ext_hive", "location": name, "join": "t"}
    more = {"columns": ["o_orderkey", "o_totalprice"], "where": "o_orderstatus = 'F'"}
    return build(spark, job(source | more))


@query("select c_custkey, c_name, c_acctbal from customer where c_mktsegment = 'BUILDING'")
def managed_table_source(spark, sf_dir):
    name = f"default.tableflow_{uuid.uuid4().hex}"
    options = {"table": name, "format": "parquet", "location": scratch_folder(spark, "table")}
    target = {"place": "hive", "options": options}
    run(spark, job(files(sf_dir, "customer", CUSTOMER, "customer"), target=target))
    source = {"id": "t", "source": "mng_hive", "location": name, "join": "t"}
    columns = ["c_custkey", "c_name", "c_acctbal"]
    return build(spark, job(source | {"columns": columns, "where": "c_mktsegment = 'BUILDING'"}))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def table_append(spark, sf_dir):
    name = f"tableflow_{uuid.uuid4().hex}"
    options = {"tablename": name, "format": "parquet", "location": scratch_folder(spark, "table")}
    first = files(sf_dir, "customer", CUSTOMER, "customer", where="c_mktsegment = 'BUILDING'")
    run(spark, job(first, target={"place": "hive", "options": options}))
    # columns in another order: an append goes by name
    turned = " ".join(reversed(CUSTOMER.split()))
    rest = files(sf_dir, "customer", turned, "customer", where="c_mktsegment <> 'BUILDING'")
    run(spark, job(rest, target={"place": "hive", "options": options | {"mode": "append"}}))
    source = {"id": "t", "source": "ext_hive", "location": name, "join": "t"}
    return build(spark, job(source))


@query("""
    select c_mktsegment, count(*) as customers from customer where c_acctbal > 0 group by c_mktsegment
""")
def subquery_source(spark, sf_dir):
    inner = "(select c_mktsegment, count(*) as customers from customer group by c_mktsegment)"
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_mktsegment c_acctbal", where="c_acctbal > 0"),
            {"id": "segments", "source": "hive-ext", "location": inner, "join": "segments"},
        ),
    )


@query("select o_orderkey, o_totalprice, 'P' as kind from orders where o_orderstatus = 'P'")
def custom_source(spark, sf_dir):
    source = files(sf_dir, "orders", "", "orders", transform="open_orders", custom={"status": "P"})
    select = ["o_orderkey", "o_totalprice"]
    return build(spark, job(source, select=select, add=[["kind", "'P'"]]))


@query("select o_orderkey, o_custkey from orders")
def custom_sink(spark, sf_dir):
    folder = scratch_folder(spark, "custom")
    options = {"folder": folder, "by": "o_orderkey"}
    target = {"place": "hdfs", "class": "sorted_copy", "options": options}
    run(spark, job(files(sf_dir, "orders", "o_orderkey o_custkey", "orders"), target=target))
    return spark.read.parquet(folder)


# ---------------------------------------------------------------------------------------------
# Joins and the rest of the query text


LINE = "l_orderkey l_quantity l_shipdate"


@query("select o_orderkey, o_totalprice from orders where o_orderkey >= 1000 and o_orderkey < 9000")
def python_data_source(spark, sf_dir):
    """Written and read by a data source in Python; the key range is pushed, so few files are read."""
    folder = scratch_folder(spark, "arrow")
    plugin = "tableflow.sources.arrow_files.ArrowFiles"
    by_key = "(select * from orders distribute by o_orderkey div 2000)"
    run(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_totalprice"),
            {"id": "dealt", "source": "ext_hive", "location": by_key, "join": "dealt"},
            target={"place": "hdfs", "class": plugin, "options": {"location": folder}},
        ),
    )
    source = {"id": "back", "source": "hdfs", "transform": plugin, "location": folder, "join": "back"}
    spec = job(source | {"where": "o_orderkey >= 1000 and o_orderkey < 9000"})
    return build(spark, dataclasses.replace(spec, settings={"spark.sql.python.filterPushdown.enabled": "true"}))


@query("""
    select o_orderkey, l_quantity from orders join lineitem on o_orderkey = l_orderkey
    where l_quantity > 25 and o_totalprice > 50000
""")
def join_inner(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_totalprice", "orders"),
            files(sf_dir, "lineitem", LINE, "inner join lineitem on o_orderkey = l_orderkey"),
            where="l_quantity > 25 and o_totalprice > 50000",
            select=["o_orderkey", "l_quantity"],
        ),
    )


@query("select o_orderkey, l_quantity from orders left join lineitem on o_orderkey = l_orderkey")
def join_left(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey", "orders"),
            files(sf_dir, "lineitem", LINE, "left outer join lineitem on o_orderkey = l_orderkey"),
            select=["o_orderkey", "l_quantity"],
        ),
    )


@query("select o_orderkey, l_quantity from lineitem right join orders on o_orderkey = l_orderkey")
def join_right(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "lineitem", LINE, "lineitem"),
            files(sf_dir, "orders", "o_orderkey", "right outer join orders on o_orderkey = l_orderkey"),
            select=["o_orderkey", "l_quantity"],
        ),
    )


@query("""
    select d.doc_id as doc_id, l.doc_id as label_id, d.lang, l.quality
    from (select * from documents where n_chars > 500) d
    full join labels l on d.doc_id = l.doc_id
""")
def join_full(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "documents", "doc_id lang n_chars", "documents", where="n_chars > 500"),
            files(
                sf_dir,
                "labels",
                "doc_id quality",
                "full outer join labels on documents.doc_id = labels.doc_id",
            ),
            select=["documents.doc_id", "labels.doc_id as label_id", "lang", "quality"],
        ),
    )


@query("""
    select o_orderkey, o_totalprice from orders
    semi join (select * from lineitem where l_quantity > 45) l on o_orderkey = l.l_orderkey
""")
def join_semi(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_totalprice", "orders"),
            files(
                sf_dir,
                "lineitem",
                "l_orderkey",
                "left semi join lineitem on o_orderkey = l_orderkey",
                where="l_quantity > 45",
            ),
        ),
    )


@query("""
    select o_orderkey, o_totalprice from orders anti join lineitem on o_orderkey = l_orderkey
""")
def join_anti(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_totalprice", "orders"),
            files(sf_dir, "lineitem", "l_orderkey", "left anti join lineitem on o_orderkey = l_orderkey"),
        ),
    )


@query("select doc_id, lang, quality, toxic from documents join labels using (doc_id)")
def join_using(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "documents", "doc_id lang", "documents"),
            files(sf_dir, "labels", "doc_id quality toxic", "join labels using (doc_id)"),
        ),
    )


@query("select doc_id, lang, quality, toxic from documents natural join labels")
def join_natural(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "documents", "doc_id lang", "documents"),
            files(sf_dir, "labels", "doc_id quality toxic", "natural join labels"),
        ),
    )


@query("""
    select o_orderkey, o_orderstatus, l_linestatus from orders left join lineitem
    on o_orderkey = l_orderkey
    and nullif(o_orderstatus, 'O') is not distinct from nullif(l_linestatus, 'O')
""")
def join_null_safe(spark, sf_dir):
    match = "o_orderkey = l_orderkey and nullif(o_orderstatus, 'O') <=> nullif(l_linestatus, 'O')"
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_orderstatus", "orders"),
            files(sf_dir, "lineitem", "l_orderkey l_linestatus", f"left join lineitem on {match}"),
            select=["o_orderkey", "o_orderstatus", "l_linestatus"],
        ),
    )


@query("""
    select o_orderkey, l_quantity, l_shipdate from orders join lineitem on o_orderkey = l_orderkey
    and l_shipdate between o_orderdate and o_orderdate + interval 90 day
""")
def join_range(spark, sf_dir):
    match = "o_orderkey = l_orderkey and l_shipdate between o_orderdate and o_orderdate + interval 90 days"
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_orderdate", "orders"),
            files(sf_dir, "lineitem", LINE, f"join lineitem on {match}"),
            select=["o_orderkey", "l_quantity", "l_shipdate"],
        ),
    )


@query("""
    select c_custkey, n from customer,
    lateral (select count(*) as n from orders where o_custkey = c_custkey)
""")
def join_lateral(spark, sf_dir):
    each = ", lateral (select count(*) as n from orders where o_custkey = c_custkey)"
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_custkey", "customer"),
            files(sf_dir, "orders", "o_custkey", each),
        ),
    )


def join_source(kind: str, left: str, right: str, **custom) -> dict:
    """A join of two earlier sources that join text has no fast form for."""
    custom = {name.replace("_", "-"): value for name, value in custom.items()}
    return {"id": "joined", "source": "join", "join": "joined", "custom": {"kind": kind, "left": left, "right": right} | custom}


def subquery(name: str, text: str) -> dict:
    return {"id": name, "source": "ext_hive", "location": f"({text})"}


@query("""
    with lines as (select case when l_orderkey % 3 = 0 then 1 else l_suppkey end as k, l_orderkey, l_partkey, l_quantity
        from lineitem)
    select coalesce(lines.k, s.s_suppkey) as k, l_orderkey, l_partkey, l_quantity, s_name
    from lines full outer join (select * from supplier where s_suppkey % 7 < 3) s on lines.k = s.s_suppkey
""")
def join_full_hot_key(spark, sf_dir):
    """A full outer join in which one supplier has a third of all lines."""
    key = "if(l_orderkey % 3 = 0, 1, l_suppkey) as k"
    return build(
        spark,
        job(
            files(sf_dir, "lineitem", "l_orderkey l_partkey l_suppkey l_quantity"),
            files(sf_dir, "supplier", "s_suppkey s_name"),
            subquery("lines", f"select {key}, l_orderkey, l_partkey, l_quantity from lineitem"),
            subquery("some", "select s_suppkey as k, s_name from supplier where s_suppkey % 7 < 3"),
            join_source("full", "lines", "some", on=["k"], hot_rows=1000),
        ),
    )


@query("""
    select p.event_id as purchase, s.event_id as signup, p.user_id
    from events p join events s on p.user_id = s.user_id
        and p.ts <= s.ts + to_hours(cast(floor(s.value) as int)) and s.ts <= p.ts + to_hours(cast(floor(p.value) as int))
    where p.event_type = 'purchase' and s.event_type = 'signup'
""")
def join_intervals(spark, sf_dir):
    """Overlapping spans of a user's events, of very different lengths: no equality but the user."""
    span = "ts + make_interval(0, 0, 0, 0, cast(floor(value) as int))"
    events = "select user_id, event_id as {0}, ts as {0}_from, " + span + " as {0}_to from events where event_type = '{0}'"
    return build(
        spark,
        job(
            files(sf_dir, "events", "event_id ts user_id event_type value"),
            subquery("p", events.format("purchase")),
            subquery("s", events.format("signup")),
            join_source(
                "range", "p", "s", by=["user_id"],
                left_span=["purchase_from", "purchase_to"], right_span=["signup_from", "signup_to"],
            ),
            select=["purchase", "signup", "user_id"],
        ),
    )


@query("""
    select event_id, n_name from events join nation
        on ts >= timestamp '2024-01-01' + to_days(n_nationkey)
        and ts <= timestamp '2024-01-02 12:00:00' + to_days(n_nationkey)
""")
def join_points_in_intervals(spark, sf_dir):
    """Events in the span of a day and a half that each nation has: a range join without any equality."""
    days = "make_interval(0, 0, 0, n_nationkey)"
    start, end = (f"timestamp_ntz'{at}' + {days}" for at in ("2024-01-01 00:00:00", "2024-01-02 12:00:00"))
    return build(
        spark,
        job(
            files(sf_dir, "events", "event_id ts"),
            files(sf_dir, "nation", "n_nationkey n_name"),
            subquery("spans", f"select n_name, {start} as first, {end} as last from nation"),
            join_source("range", "events", "spans", left_span=["ts", "ts"], right_span=["first", "last"]),
            select=["event_id", "n_name"],
        ),
    )


ASOF = """
    with keyed as (select *, case when user_id % 3 = 0 then 0 else user_id end as k from events)
    select p.k as k, p.event_id as purchase, p.ts as bought, c.event_id as click, c.ts as clicked
    from (select * from keyed where event_type = 'purchase') p
        asof {} join (select * from keyed where event_type = 'click') c on p.k = c.k and p.ts >= c.ts
"""


def latest_clicks(spark: SparkSession, sf_dir: str, how: str) -> DataFrame:
    """Each purchase with the last click of its key before it; one key has a third of all events."""
    events = "select if(user_id % 3 = 0, 0, user_id) as k, event_id as {}, ts as {} from events where event_type = '{}'"
    return build(
        spark,
        job(
            files(sf_dir, "events", "event_id ts user_id event_type"),
            subquery("p", events.format("purchase", "bought", "purchase")),
            subquery("c", events.format("click", "clicked", "click")),
            join_source("asof", "p", "c", by=["k"], left_time="bought", right_time="clicked", how=how, hot_rows=200),
        ),
    )


@query(ASOF.format("left"))
def join_asof_left(spark, sf_dir):
    return latest_clicks(spark, sf_dir, "left")


@query(ASOF.format(""))
def join_asof_inner(spark, sf_dir):
    return latest_clicks(spark, sf_dir, "inner")


@query("""
    select word, count(*) as parts from (select unnest(string_split(p_name, ' ')) as word from part)
    group by word
""")
def lateral_view(spark, sf_dir):
    words = "(select word, count(*) as parts from part lateral view explode(split(p_name, ' ')) w as word group by word)"
    return build(
        spark,
        job(
            files(sf_dir, "part", "p_name"),
            {"id": "words", "source": "ext_hive", "location": words, "join": "words"},
        ),
    )


@query("""
    select o_orderkey, o_custkey from orders
    where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)
""")
def where_exists(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_custkey", "orders"),
            files(sf_dir, "lineitem", LINE),
            where="exists (select 1 from lineitem where l_orderkey = o_orderkey and l_quantity > 45)",
        ),
    )


@query("""
    select o_orderkey from orders
    where o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')
""")
def where_in_subquery(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_custkey c_mktsegment"),
            files(sf_dir, "orders", "o_orderkey o_custkey", "orders"),
            where="o_custkey in (select c_custkey from customer where c_mktsegment = 'MACHINERY')",
            select=["o_orderkey", "o_custkey"],
        ),
    ).select("o_orderkey")


@query("""
    select c_custkey, c_name, n from customer
    join (select o_custkey, count(*) as n from orders group by o_custkey) g on c_custkey = o_custkey
""")
def inline_aggregate(spark, sf_dir):
    grouped = "join (select o_custkey, count(*) as n from orders group by o_custkey) g on c_custkey = o_custkey"
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_custkey c_name", "customer"),
            files(sf_dir, "orders", "o_custkey", grouped),
            select=["c_custkey", "c_name", "n"],
        ),
    )


@query("""
    select l_returnflag, l_linestatus, count(*) as lines, cast(sum(l_quantity) as double) as quantity
    from lineitem group by rollup (l_returnflag, l_linestatus)
""")
def inline_rollup(spark, sf_dir):
    grouped = """(select l_returnflag, l_linestatus, count(*) as lines, sum(l_quantity) as quantity
                  from lineitem group by rollup (l_returnflag, l_linestatus)) g"""
    return build(
        spark, job(files(sf_dir, "lineitem", "l_returnflag l_linestatus l_quantity", grouped))
    )


@query("""
    select user_id, count(*) filter (event_type = 'view') as views,
           count(*) filter (event_type = 'click') as clicks
    from events where event_type in ('view', 'click') group by user_id
""")
def inline_pivot(spark, sf_dir):
    pivoted = """(select user_id, coalesce(views, 0) as views, coalesce(clicks, 0) as clicks
                  from events pivot (count(*) for event_type in ('view' as views, 'click' as clicks))
                 ) p"""
    kept = "event_type in ('view', 'click')"
    return build(spark, job(files(sf_dir, "events", "user_id event_type", pivoted, where=kept)))


@query("""
    select o_orderkey, o_orderstatus, status_name from orders
    join (values ('F', 'finished'), ('O', 'open')) t(code, status_name) on o_orderstatus = code
""")
def inline_values(spark, sf_dir):
    names = "join values ('F', 'finished'), ('O', 'open') as t(code, status_name) on o_orderstatus = code"
    return build(
        spark,
        job(
            files(sf_dir, "orders", "o_orderkey o_orderstatus", f"orders {names}"),
            select=["o_orderkey", "o_orderstatus", "status_name"],
        ),
    )


@query("""
    select c_custkey as id, c_name as name, c_acctbal as balance from customer where c_acctbal > 0
    union all select s_suppkey, s_name, s_acctbal from supplier where s_acctbal > 0
""")
def tail_union(spark, sf_dir):
    suppliers = "union all select * from supplier"
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_custkey c_name c_acctbal", "customer"),
            files(sf_dir, "supplier", "s_suppkey s_name s_acctbal", suppliers),
            select=["c_custkey as id", "c_name as name", "c_acctbal as balance"],
            where="balance > 0",
        ),
    )


@query("select c_custkey from customer except select o_custkey from orders where o_totalprice > 400000")
def tail_except(spark, sf_dir):
    return build(
        spark,
        job(
            files(sf_dir, "customer", "c_custkey", "customer"),
            files(
                sf_dir, "orders", "o_custkey", "except select * from orders", where="o_totalprice > 400000"
            ),
        ),
    )


@query("select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit 20")
def tail_top_k(spark, sf_dir):
    top = "orders order by o_totalprice desc, o_orderkey limit 20"
    return build(spark, job(files(sf_dir, "orders", "o_orderkey o_totalprice", top)))


# ---------------------------------------------------------------------------------------------
# Derived columns


@query("""
    select o_custkey, month, orders, cast(sum(orders) over (
        partition by o_custkey order by month) as bigint) as orders_so_far
    from (select o_custkey, cast(date_trunc('month', o_orderdate) as date) as month, count(*) as orders
          from orders group by all)
""")
def add_window_column(spark, sf_dir):
    # counted per month first: a customer's window holds months, however many orders there are
    monthly = """(select o_custkey, trunc(o_orderdate, 'month') as month, count(*) as orders
                  from orders group by 1, 2) m"""
    so_far = "sum(orders) over (partition by o_custkey order by month)"
    source = files(sf_dir, "orders", "o_custkey o_orderdate", monthly)
    return build(spark, job(source, add=[["orders_so_far", so_far]]))


@query("""
    select o_orderkey, o_custkey, (o_orderkey + o_custkey) * 3 + 1 as a,
           (o_orderkey + o_custkey) * 3 as b
    from orders
""")
def add_chained_columns(spark, sf_dir):
    add = [["a", "o_orderkey + o_custkey"], ["b", "a * 3"], ["a", "b + 1"]]
    return build(spark, job(files(sf_dir, "orders", "o_orderkey o_custkey", "orders"), add=add))


@query("select c_custkey, 'N' as src_ind, true as stamped from customer")
def add_update_ts(spark, sf_dir):
    add = [["src_ind", "'N'"], ["update_ts", "current_timestamp"]]
    stamped = build(spark, job(files(sf_dir, "customer", "c_custkey", "customer"), add=add))
    return stamped.select("c_custkey", "src_ind", F.col("update_ts").isNotNull().alias("stamped"))


@query("""
    select o_orderkey, c_name, o_totalprice * 2 as twice, o_totalprice * 2 + c_acctbal as more
    from orders join customer on o_custkey = c_custkey where o_orderstatus = 'F' and c_acctbal > 0
""")
def add_from_unselected(spark, sf_dir):
    # neither the filter nor the derived columns use a column of the output
    return build(
        spark,
        job(
            files(sf_dir, "orders", ORDERS, "orders"),
            files(sf_dir, "customer", CUSTOMER, "join customer on orders.o_custkey = customer.c_custkey"),
            select=["orders.o_orderkey", "c_name"],
            where="o_orderstatus = 'F' and customer.c_acctbal > 0",
            add=[["twice", "o_totalprice * 2"], ["more", "twice + c_acctbal"]],
        ),
    )


@query("select o_orderkey, cast(epoch(o_orderdate) as bigint) - 5 * 3600 as seconds from orders")
def spec_settings(spark, sf_dir):
    # the zone holds for this run only
    folder = scratch_folder(spark, "zone")
    options = {"location": folder, "format": "parquet", "compression": "snappy", "mode": "overwrite"}
    seconds = ["seconds", "unix_timestamp(cast(o_orderdate as timestamp))"]
    spec = job(
        files(sf_dir, "orders", "o_orderkey o_orderdate", "orders"),
        select=["o_orderkey"],
        add=[seconds],
        target={"place": "hdfs", "options": options},
    )
    run(spark, dataclasses.replace(spec, settings={"spark.sql.session.timeZone": "+05:00"}))
    return spark.read.parquet(folder)


# ---------------------------------------------------------------------------------------------
# Files


@query("select * from orders")
def file_round_trip_orc(spark, sf_dir):
    return write_files_and_read(spark, sf_dir, "orc", "snappy", ORDERS)


@query("select * from orders")
def file_round_trip_parquet(spark, sf_dir):
    return write_files_and_read(spark, sf_dir, "parquet", "zstd", ORDERS)


ORDER_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)


@query("""
    select o_orderkey, o_custkey, c_name, o_totalprice * 2 as twice
    from orders left join customer on o_custkey = c_custkey and c_nationkey < 20 where o_orderstatus <> 'P'
""")
def stream_files_twice(spark, sf_dir):
    """Files that came before a run and files that came after it, each written once, joined to a table."""
    folder = scratch_folder(spark, "stream")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    source = {
        "id": "orders", "source": "hdfs", "format": "parquet", "location": f"{folder}/in", "join": "orders",
        "schema": ", ".join(f"{name} {kind}" for name, kind in orders.dtypes), "custom": {"stream": True},
        "where": "o_orderstatus <> 'P'",
    }
    customer = files(sf_dir, "customer", "c_custkey c_name c_nationkey", where="c_nationkey < 20")
    options = {"location": f"{folder}/out", "format": "parquet", "compression": "snappy", "checkpoint": f"{folder}/state"}
    spec = job(
        source,
        customer | {"join": "left join customer on o_custkey = c_custkey"},
        select=["o_orderkey", "o_custkey", "c_name", "o_totalprice"],
        add=[["twice", "o_totalprice * 2"]],
        target={"place": "hdfs", "options": options},
    )
    for part in (0, 1):
        orders.where(F.col("o_orderkey") % 2 == part).write.mode("append").parquet(f"{folder}/in")
        run(spark, spec)
    return spark.read.parquet(f"{folder}/out").drop("o_totalprice")


@query("select * from orders")
def file_round_trip_json(spark, sf_dir):
    return write_files_and_read(spark, sf_dir, "json", "gzip", ORDERS, schema=ORDER_SCHEMA)


@query("select * from orders")
def file_round_trip_csv(spark, sf_dir):
    return write_files_and_read(spark, sf_dir, "csv", "gzip", ORDERS, schema=ORDER_SCHEMA)


# ---------------------------------------------------------------------------------------------
# Cells


_WIDE_EVENTS = """
    select cast(user_id as varchar) as rowkey,
           {click} as last_click,
           {buy} as last_purchase,
           cast(null as varchar) as refund
    from events {where} group by user_id
"""
_NEWEST = {
    name: f"cast(arg_max_null(value, ts) filter (event_type = '{kind}') as varchar)"
    for name, kind in (("click", "click"), ("buy", "purchase"))
}
EVENT_MAPPING = {"last_click": "click", "last_purchase": "purchase", "refund": "refund"}


def wide_events(spark: SparkSession, sf_dir: str, **custom) -> DataFrame:
    """Events as cells through a user-written source, read as wide rows by the cell source."""
    raw = files(sf_dir, "events", transform="events_as_cells")
    wide = cell_source("events", [], cf="raw") | {"custom": {"mapping": EVENT_MAPPING} | custom}
    return build(spark, job(raw, wide))


@query(_WIDE_EVENTS.format(**_NEWEST, where=""))
def cells_to_wide_rows(spark, sf_dir):
    return wide_events(spark, sf_dir)


@query(_WIDE_EVENTS.format(**_NEWEST, where="where event_type in ('click', 'purchase')"))
def cells_to_wide_mapped_only(spark, sf_dir):
    return wide_events(spark, sf_dir, keep_empty_rows=False)


@query("""
    select 'data' as cf, qualifier, cast(c_custkey as varchar) as rowkey, value, 7 as version
    from (select c_custkey, cast(c_name as varchar) as c_name,
                 cast(c_nationkey as varchar) as c_nationkey, cast(c_acctbal as varchar) as c_acctbal
          from customer)
    unpivot include nulls (value for qualifier in (c_name, c_nationkey, c_acctbal))
""")
def wide_to_cells(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    columns = ["c_name", "c_nationkey", "c_acctbal"]
    return row_to_cells(table(spark, sf_dir, "customer"), key, "data", F.lit(7), columns)


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def cells_round_trip(spark, sf_dir):
    folder = scratch_folder(spark, "puts")
    source = files(sf_dir, "customer", CUSTOMER, "customer")
    run(spark, job(source, target=customer_target(folder)))
    return read_customer_cells(spark, folder)


@query("""
    select c_custkey, c_name, c_nationkey,
           case when c_mktsegment = 'BUILDING' then null else c_acctbal end as c_acctbal, c_mktsegment
    from customer
""")
def put_newer_version(spark, sf_dir):
    folder = scratch_folder(spark, "puts")
    keyed = {"key-columns": ["c_custkey"]}
    first = customer_target(folder, version=1, **keyed)
    run(spark, job(files(sf_dir, "customer", CUSTOMER, "customer"), target=first))
    # a newer null hides the older value; cells not put again keep theirs
    source = files(sf_dir, "customer", "c_custkey", "customer", where="c_mktsegment = 'BUILDING'")
    second = customer_target(folder, version=2, **keyed)
    run(spark, job(source, add=[["c_acctbal", "cast(null as double)"]], target=second))
    return read_customer_cells(spark, folder)


def _rank_sql(keys: str, regions: int) -> str:
    """Split keys by rank, as a query."""
    return f"""
        select distinct k as split from (
            select k, row_number() over (order by k) - 1 as pos, count(*) over () as total from ({keys})
        ) where pos in (select cast(floor(i * total / {regions - 1} + 0.5) as bigint)
                       from range({regions - 1}) r(i))
    """


_ORDER_KEYS = "select cast(o_orderkey as varchar) as k from orders"
_PART_KEYS = "select cast(l_partkey as varchar) as k from lineitem"


def _splits_frame(spark: SparkSession, splits: list[str]) -> DataFrame:
    return spark.createDataFrame([(split,) for split in splits], "split string")


@query(_rank_sql(_ORDER_KEYS, 8))
def split_keys_unique(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("rowkey"))
    return _splits_frame(spark, split_keys(keys, 8))


@query(_rank_sql(_PART_KEYS, 100))
def split_keys_repeated(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").cast("string").alias("rowkey"))
    # narrowed from samples in several passes, as for a table too large to sort
    return _splits_frame(spark, split_keys(keys, 100, gap_rows=20_000, sample_keys=2_000))


@query(f"""
    with s as ({_rank_sql(_ORDER_KEYS, 8)})
    select region, count(*) as rows_in_region, min(k) as first_key, max(k) as last_key
    from (select k, len(list_filter((select list(split) from s), lambda x: x <= k)) as region
          from ({_ORDER_KEYS})) group by region
""")
def region_histogram(spark, sf_dir):
    keys = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("rowkey"))
    region = region_of("rowkey", split_keys(keys, 8)).cast("bigint")
    return keys.groupBy(region.alias("region")).agg(
        F.count("*").alias("rows_in_region"),
        F.min("rowkey").alias("first_key"),
        F.max("rowkey").alias("last_key"),
    )


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def bulk_round_trip(spark, sf_dir):
    folder = scratch_folder(spark, "bulk")
    run(spark, job(files(sf_dir, "customer", CUSTOMER, "customer"), target=bulk(folder)))
    return read_customer_cells(spark, folder)


@query("""
    select c_custkey, c_name, c_nationkey,
           case when c_mktsegment = 'BUILDING' then 0.5 else c_acctbal end as c_acctbal, c_mktsegment
    from customer
""")
def bulk_existing_target(spark, sf_dir):
    folder = scratch_folder(spark, "bulk")
    keyed = {"key-columns": ["c_custkey"]}
    source = files(sf_dir, "customer", CUSTOMER, "customer")
    run(spark, job(source, target=bulk(folder, version=1, **keyed)))
    changed = source | {"where": "c_mktsegment = 'BUILDING'"}
    second = bulk(folder, version=2, **keyed)
    run(spark, job(changed, add=[["c_acctbal", "cast(0.5 as double)"]], target=second))
    return read_customer_cells(spark, folder)


@query(f"""
    with s as ({_rank_sql(_ORDER_KEYS, 8)})
    select region, count(*) * 6 as cells, min(k) as first_key, max(k) as last_key
    from (select k, len(list_filter((select list(split) from s), lambda x: x <= k)) as region
          from ({_ORDER_KEYS})) group by region
""")
def bulk_region_layout(spark, sf_dir):
    folder = scratch_folder(spark, "bulk")
    target = bulk(folder, **{"key-columns": ["o_orderkey"]})
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    stored = spark.read.parquet(f"{folder}/cells")
    return stored.groupBy(F.col("region").cast("bigint").alias("region")).agg(
        F.count("*").alias("cells"),
        F.min("rowkey").alias("first_key"),
        F.max("rowkey").alias("last_key"),
    )


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def bulk_catalog_table(spark, sf_dir):
    folder, name = scratch_folder(spark, "bulk"), f"default:tableflow_{uuid.uuid4().hex}"
    target = bulk(folder, location=f"{folder}/table")
    target["options"]["tablename"] = name
    run(spark, job(files(sf_dir, "customer", CUSTOMER, "customer"), target=target))
    wide = build(spark, job(cell_source(name, list(CUSTOMER_TYPES))))
    return wide.select(*typed_columns(CUSTOMER_TYPES))


@query("select cast(0 as bigint) as out_of_order, count(*) * 6 as cells from orders")
def bulk_sorted_files(spark, sf_dir):
    folder = scratch_folder(spark, "bulk")
    target = bulk(folder, **{"key-columns": ["o_custkey"]})
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    key = F.struct("region", "rowkey", "qualifier")
    # a file is what one task wrote, so its window is no larger than a task
    in_file = Window.partitionBy("_metadata.file_path").orderBy("_metadata.row_index")
    pairs = spark.read.parquet(f"{folder}/cells").select(key.alias("key"), F.lag(key).over(in_file).alias("last"))
    out_of_order = F.count_if(F.col("last") > F.col("key"))
    return pairs.agg(out_of_order.alias("out_of_order"), F.count("*").alias("cells"))


@query("""
    select o_orderpriority as rowkey, max(cast(o_orderkey as varchar)) as o_orderkey,
           max(cast(o_totalprice as varchar)) as o_totalprice
    from orders group by o_orderpriority
""")
def bulk_shared_keys(spark, sf_dir):
    # a handful of row keys hold all rows; at equal versions the greater value is read
    folder = scratch_folder(spark, "bulk")
    target = bulk(folder, regions=4, **{"key-columns": ["o_orderpriority"]})
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    return build(spark, job(cell_source(f"{folder}/cells", ["o_orderkey", "o_totalprice"])))


@query("select o_orderpriority as rowkey, count(*) * 6 as cells from orders group by o_orderpriority")
def bulk_shared_keys_cells(spark, sf_dir):
    # no cell of rows that share a key is lost
    folder = scratch_folder(spark, "bulk")
    target = bulk(folder, regions=4, **{"key-columns": ["o_orderpriority"]})
    run(spark, job(files(sf_dir, "orders", ORDERS, "orders"), target=target))
    return spark.read.parquet(f"{folder}/cells").groupBy("rowkey").agg(F.count("*").alias("cells"))


_HALVES = ("o_orderkey % 2 = 0", "o_orderkey % 2 = 1")


@query(f"""
    with s as ({_rank_sql(f"{_ORDER_KEYS} where {_HALVES[0]}", 8)})
    select region, count(*) * 6 as cells, min(k) as first_key, max(k) as last_key
    from (select k, len(list_filter((select list(split) from s), lambda x: x <= k)) as region
          from ({_ORDER_KEYS} where {_HALVES[1]})) group by region
""")
def bulk_reused_splits(spark, sf_dir):
    # the second load asks for other regions, and is laid out by the first one's split keys
    folder = scratch_folder(spark, "bulk")
    for version, half in enumerate(_HALVES, 1):
        source = files(sf_dir, "orders", ORDERS, "orders", where=half)
        target = bulk(folder, regions=5 + 3 * (version == 1), version=version, **{"key-columns": ["o_orderkey"]})
        run(spark, job(source, target=target))
    cells = spark.read.parquet(f"{folder}/cells").where("version = 2")
    return cells.groupBy(F.col("region").cast("bigint").alias("region")).agg(
        F.count("*").alias("cells"), F.min("rowkey").alias("first_key"), F.max("rowkey").alias("last_key")
    )


@query("""
    select cast(o_orderkey as varchar) as rowkey, cast(o_custkey as varchar) as o_custkey, o_orderpriority
    from orders where cast(o_orderkey as varchar) >= '2' and cast(o_orderkey as varchar) < '35'
""")
def cells_key_range(spark, sf_dir):
    # two loads by region, and puts; of the loads only the regions of the range are read
    folder = scratch_folder(spark, "bulk")
    keyed = {"key-columns": ["o_orderkey"]}
    thirds = [files(sf_dir, "orders", ORDERS, "orders", where=f"o_orderkey % 3 = {n}") for n in range(3)]
    for third in thirds[:2]:
        run(spark, job(third, target=bulk(folder, **keyed)))
    run(spark, job(thirds[2], target=customer_target(folder, **keyed)))
    names = ["o_custkey", "o_orderpriority"]
    return build(spark, job(cell_source(f"{folder}/cells", names, rows={"from": "2", "to": "35"})))


@query("select c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment from customer")
def cells_orc_twice(spark, sf_dir):
    # the second load does not name the format
    folder = scratch_folder(spark, "bulk")
    for half, named in (("c_custkey % 2 = 0", {"format": "orc"}), ("c_custkey % 2 = 1", {})):
        source = files(sf_dir, "customer", CUSTOMER, "customer", where=half)
        run(spark, job(source, target=bulk(folder, **named)))
    return read_customer_cells(spark, folder)


# ---------------------------------------------------------------------------------------------
# All source kinds in one job


@query("""
    select cast(o_orderkey as varchar) as rowkey, cast(o_totalprice as varchar) as o_totalprice, o_orderstatus
    from orders where o_orderstatus <> 'F'
""")
def cells_incremental(spark, sf_dir):
    """The second of two runs of a job reads only the loads that came after the first."""
    folder = scratch_folder(spark, "increment")
    keyed = {"key-columns": ["o_orderkey"]}
    increment = {"job": "copy", "marks": f"{folder}/marks"}
    source = cell_source(f"{folder}/cells", ["o_totalprice", "o_orderstatus"], increment=increment)
    wheres = ["o_orderstatus = 'F'", "o_orderstatus = 'O'", "o_orderstatus = 'P'"]

    def load(where: str, target: dict) -> None:
        run(spark, job(files(sf_dir, "orders", ORDERS, "orders", where=where), target=target))

    def copy(number: int) -> str:
        out = f"{folder}/copy{number}"
        options = {"location": out, "format": "parquet", "compression": "snappy", "mode": "overwrite"}
        run(spark, job(source, target={"place": "hdfs", "options": options}))
        return out

    load(wheres[0], bulk(folder, **keyed))
    copy(1)
    load(wheres[1], bulk(folder, **keyed))
    load(wheres[2], customer_target(folder, **keyed))
    return spark.read.parquet(copy(2))


@query("""
    select cast(o_orderkey as varchar) as rowkey, cast(o_totalprice as varchar) as o_totalprice, lines
    from orders join (select l_orderkey, cast(count(*) as varchar) as lines from lineitem group by l_orderkey) l
        on o_orderkey = l_orderkey
""")
def cells_bucketed_join(spark, sf_dir):
    """Two bucketed cell tables, read and joined by row key without a shuffle."""
    folder, name = scratch_folder(spark, "bucketed"), f"tableflow_{uuid.uuid4().hex}"
    counts = "(select l_orderkey, count(*) as lines from lineitem group by l_orderkey)"
    orders = job(files(sf_dir, "orders", "o_orderkey o_totalprice", "orders"), target=bucketed(folder, f"{name}_a", "o_orderkey"))
    lines = [files(sf_dir, "lineitem", "l_orderkey"), {"id": "n", "source": "ext_hive", "location": counts, "join": "n"}]
    run(spark, orders)
    run(spark, job(*lines, target=bucketed(folder, f"{name}_b", "l_orderkey")))
    left = cell_source(f"{name}_a", ["o_totalprice"]) | {"id": "a", "join": "a"}
    right = cell_source(f"{name}_b", ["lines"]) | {"id": "b", "join": "join b on a.rowkey = b.rowkey"}
    return build(spark, job(left, right, select=["a.rowkey as rowkey", "o_totalprice", "lines"]))


@query("""
    with latest as (
        select user_id, arg_max_null(value, ts) filter (event_type = 'purchase') as amount
        from events group by user_id)
    select o.o_orderkey, o.o_orderpriority, latest.amount as last_purchase, c.c_name, n.n_name,
           'N' as src_ind, true as stamped
    from orders o join latest on o.o_custkey = latest.user_id
    left join (select * from customer where c_acctbal > 100) c on c.c_custkey = o.o_custkey
    left join nation n on n.n_nationkey = c.c_nationkey
    where o.o_orderstatus = 'O' and o.o_orderpriority not like '%URGENT%'
""")
def conform_all_sources(spark, sf_dir):
    lookup_name = f"tableflow_{uuid.uuid4().hex}"
    stored = {"tablename": lookup_name, "location": scratch_folder(spark, "lookup")}
    target = {"place": "hive", "options": stored}
    run(spark, job(files(sf_dir, "nation", "n_nationkey n_name", "nation"), target=target))
    orders = files(sf_dir, "orders", "", "orders", transform="open_orders", custom={"status": "O"})
    raw = files(sf_dir, "events", transform="events_as_cells")
    wide = cell_source("events", [], cf="raw") | {
        "custom": '{"mapping": {"amount": "purchase"}}',
        "join": "inner join wide on cast(orders.o_custkey as string) = wide.rowkey",
    }
    customer = files(
        sf_dir,
        "customer",
        "c_custkey c_name c_nationkey",
        "left outer join customer on customer.c_custkey = orders.o_custkey",
        where="c_acctbal > 100",
    )
    nation = {
        "id": "nation",
        "source": "hive-mng",
        "location": lookup_name,
        "join": "left outer join nation on nation.n_nationkey = customer.c_nationkey",
    }
    select = ["o_orderkey", "o_orderpriority", "try_cast(amount as double) as last_purchase"]
    folder = scratch_folder(spark, "conform")
    options = {"location": folder, "format": "orc", "compression": "snappy", "mode": "overwrite"}
    run(
        spark,
        job(
            orders,
            raw,
            wide,
            customer,
            nation,
            select=[*select, "c_name", "n_name"],
            where="o_orderpriority not like '%URGENT%'",
            add=[["src_ind", "'N'"], ["update_ts", "current_timestamp"]],
            target={"place": "hdfs", "class": "default", "options": options},
        ),
    )
    written = spark.read.orc(folder)
    return written.withColumn("stamped", F.col("update_ts").isNotNull()).drop("update_ts")


# ---------------------------------------------------------------------------------------------
# Column functions


@query("""
    with o as (select * from orders where o_orderstatus = 'F'), r as (
        select o_orderkey from o join customer on o_custkey = c_custkey where c_mktsegment = 'BUILDING'
    )
    select 'source' as part, 'customer' as id, count(*) as n from customer
    union all select 'source', 'orders', count(*) from o
    union all select 'source', 'region', cast(null as bigint)
    union all select 'result', 'hdfs', count(*) from r
""")
def run_metrics(spark, sf_dir):
    """Rows of each source and of the result, counted while the run wrote it; null for an unused source."""
    folder = scratch_folder(spark, "metrics")
    options = {"location": f"{folder}/out", "format": "parquet", "compression": "snappy", "mode": "overwrite"}
    spec = job(
        files(sf_dir, "orders", "o_orderkey o_custkey", "orders", where="o_orderstatus = 'F'"),
        files(sf_dir, "customer", "c_custkey c_mktsegment", "join customer on o_custkey = c_custkey"),
        files(sf_dir, "region"),
        where="c_mktsegment = 'BUILDING'",
        target={"place": "hdfs", "options": options},
        metrics=f"{folder}/runs",
    )
    run(spark, spec)
    return spark.read.parquet(f"{folder}/runs").select("part", "id", F.col("rows").alias("n"))


@query("""
    select event_id, coalesce(try_cast(json_extract_string(props, '$.k') as bigint), -99) as k,
           cast(-99 as bigint) as kind
    from events
""")
def parse_long_values(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        parse_long(F.get_json_object("props", "$.k")).alias("k"),
        parse_long("event_type").alias("kind"),
    )


@query("""
    select l_orderkey, l_linenumber, date_diff('second', o_orderdate, l_shipdate) as seconds
    from orders join lineitem on o_orderkey = l_orderkey
""")
def diff_seconds_values(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    both = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    seconds = diff_seconds(
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"),
    )
    return both.select("l_orderkey", "l_linenumber", seconds.alias("seconds"))


@query("select doc_id, source as found, lang as last_found, null::varchar as missing from documents")
def suffix_lookup(spark, sf_dir):
    def pair(name: str, value: str):
        return F.struct(F.lit(name).alias("name"), F.col(value).alias("value"))

    pairs = F.array(pair("raw:lang_id", "source"), pair("raw:src", "source"), pair("x:lang_id", "lang"))
    values = suffix_values(pairs, [":src", "_id", "nothing"])
    found = table(spark, sf_dir, "documents").select("doc_id", values.alias("v"))
    return found.select(
        "doc_id",
        F.col("v")[0].alias("found"),
        F.col("v")[1].alias("last_found"),
        F.col("v")[2].alias("missing"),
    )


@query("select o_orderkey, 19 as characters from orders")
def time_string(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", F.length(now_text()).alias("characters"))


@query("""
    select c_custkey, c_name, c_name as again, cast(octet_length(encode(c_name)) as int) as size
    from customer
""")
def bytes_round_trip(spark, sf_dir):
    data = text_bytes("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", cell_text(data).alias("again"), F.octet_length(data).alias("size")
    )


@query("select event_id, ts, value, user_id, event_type, true as nested_same from events")
def value_codec(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    events = events.withColumn("nested", F.struct("ts", F.array("value").alias("values"), "event_type"))
    types = {field.name: field.dataType for field in events.schema}
    text = events.select(
        F.col("nested").alias("before"),
        *[encode_value(F.col(name), kind).alias(name) for name, kind in types.items()],
    )
    names = ["event_id", "ts", "value", "user_id", "event_type"]
    same = decode_value(F.col("nested"), types["nested"]) == F.col("before")
    return text.select(
        *[decode_value(F.col(name), types[name]).alias(name) for name in names],
        same.alias("nested_same"),
    )


add_training_data_queries()
