"""The registered queries over Ion data, and DuckDB SQL with the same results.

Each query writes a table as Ion and reads it back, so its rows pass the codec both ways.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .cluster import shared_folder
from .functions.sql import list_extract, register
from .functions.to_ion import to_ion
from .sources.reader import IonFrame, count_ion, ion_view, list_files, read_ion
from .sources.writer import write_ion
from .streaming.lines import read_ion_stream, write_ion_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its DuckDB SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all machines share."""
    return f"{shared_folder(spark)}/ion-{uuid.uuid4().hex}"


def stored(spark: SparkSession, df: DataFrame, **options) -> str:
    path = scratch(spark)
    write_ion(df, path, **options)
    return path


LINES = {"format": "newline_delimited"}
NATION = {"n_nationkey": "INTEGER", "n_name": "VARCHAR", "n_regionkey": "INTEGER"}
PART = {"p_partkey": "BIGINT", "p_name": "VARCHAR", "p_brand": "VARCHAR", "p_type": "VARCHAR", "p_size": "INTEGER", "p_retailprice": "DOUBLE"}
ORDERS = {"o_orderkey": "BIGINT", "o_custkey": "BIGINT", "o_orderstatus": "VARCHAR", "o_totalprice": "DOUBLE", "o_orderdate": "TIMESTAMP", "o_orderpriority": "VARCHAR"}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stored(spark, table(spark, sf_dir, "orders"))
    return IonFrame(spark, path, **LINES).select("o_orderpriority").groupBy("o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT * FROM nation")
def ion_text_roundtrip_nation(spark, sf_dir):
    return read_ion(spark, stored(spark, table(spark, sf_dir, "nation")), columns=NATION)


@query("SELECT * FROM part")
def ion_text_roundtrip_part(spark, sf_dir):
    return read_ion(spark, stored(spark, table(spark, sf_dir, "part")), columns=PART, **LINES)


@query("SELECT r_regionkey::BIGINT AS r_regionkey, r_name FROM region")
def ion_text_inferred_region(spark, sf_dir):
    return read_ion(spark, stored(spark, table(spark, sf_dir, "region")))


@query("SELECT * FROM orders")
def ion_binary_roundtrip_orders(spark, sf_dir):
    return read_ion(spark, stored(spark, table(spark, sf_dir, "orders"), binary=True), columns=ORDERS)


@query("SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal::DECIMAL(18,3)::DOUBLE AS c_acctbal, c_mktsegment FROM customer")
def ion_text_double_as_decimal(spark, sf_dir):
    df = read_ion(spark, stored(spark, table(spark, sf_dir, "customer")))
    assert dict(df.dtypes)["c_acctbal"] == "decimal(18,3)"
    return df.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ion_exponent_floats_roundtrip_events(spark, sf_dir):
    df = read_ion(spark, stored(spark, table(spark, sf_dir, "events"), floats="exponent"), **LINES)
    return df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT s_suppkey, s_name FROM supplier")
def ion_array_roundtrip(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "supplier").coalesce(1), array=True)
    return read_ion(spark, path, format="array", select=["s_suppkey", "s_name"])


@query("SELECT s_suppkey, s_nationkey, s_acctbal FROM supplier")
def ion_binary_array_roundtrip(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "supplier").coalesce(1), array=True, binary=True)
    return read_ion(spark, path, format="array", columns={"s_suppkey": "BIGINT", "s_nationkey": "INTEGER", "s_acctbal": "DOUBLE"})


@query("SELECT r_name AS ion FROM region")
def ion_scalar_mode(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "region").select(F.concat(F.lit('"'), "r_name", F.lit('"')).alias("value")).write.text(path)
    return read_ion(spark, path, records=False)


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey::BIGINT, n_name FROM nation")
def ion_multi_file_glob(spark, sf_dir):
    base = scratch(spark)
    for i in range(2):
        write_ion(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), f"{base}/{i}")
    return read_ion(spark, f"{base}/*/*.ion")


@query("SELECT r_regionkey::BIGINT AS a, NULL::VARCHAR AS b FROM region UNION ALL SELECT NULL, n_name FROM nation")
def ion_union_by_name(spark, sf_dir):
    one = stored(spark, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("a")))
    two = stored(spark, table(spark, sf_dir, "nation").select(F.col("n_name").alias("b")))
    return read_ion(spark, [one, two], union_by_name=True)


@query("SELECT r_regionkey::BIGINT AS a FROM region UNION ALL SELECT NULL FROM nation")
def ion_missing_fields_null(spark, sf_dir):
    one = stored(spark, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("a")))
    two = stored(spark, table(spark, sf_dir, "nation").select(F.col("n_name").alias("b")))
    return read_ion(spark, [one, two])


def _mixed(spark, sf_dir) -> str:
    """Fields whose type differs from row to row."""
    path = scratch(spark)
    key = F.col("c_custkey")
    odd = F.when(key % 3 == 0, key.cast("string")).when(key % 3 == 1, F.concat(F.lit('"n'), key, F.lit('"'))).otherwise(F.concat(F.lit("{k: "), key, F.lit("}")))
    table(spark, sf_dir, "customer").select(F.concat(F.lit("{id: "), key, F.lit(", v: "), odd, F.lit("}")).alias("value")).write.text(path)
    return path


@query("SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN 'n' || c_custkey ELSE '{''k'': ' || c_custkey || '}' END AS v FROM customer")
def ion_conflict_varchar(spark, sf_dir):
    return read_ion(spark, _mixed(spark, sf_dir))


@query("SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN c_custkey::VARCHAR WHEN 1 THEN '\"n' || c_custkey || '\"' ELSE '{\"k\": ' || c_custkey || '}' END AS v FROM customer")
def ion_conflict_json(spark, sf_dir):
    return read_ion(spark, _mixed(spark, sf_dir), conflict_mode="json")


@query("SELECT o_orderkey, 'o_custkey' AS k, o_custkey AS v FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, 'o_orderkey', o_orderkey FROM orders WHERE o_orderkey % 2 = 1")
def ion_map_sparse(spark, sf_dir):
    path = scratch(spark)
    even = F.col("o_orderkey") % 2 == 0
    body = F.concat(F.lit("{o_orderkey: "), "o_orderkey", F.lit(", obj: {"), F.when(even, F.lit("o_custkey: ")).otherwise(F.lit("o_orderkey: ")), F.when(even, F.col("o_custkey")).otherwise(F.col("o_orderkey")), F.lit("}}"))
    table(spark, sf_dir, "orders").select(body.alias("value")).write.text(path)
    df = read_ion(spark, path, field_appearance_threshold=0.8)
    return df.select("o_orderkey", F.explode("obj").alias("k", "v"))


@query("SELECT n_nationkey::BIGINT AS n_nationkey, 'a' AS k, n_nationkey::BIGINT AS v FROM nation UNION ALL SELECT n_nationkey, 'b', n_regionkey FROM nation")
def ion_map_wide(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select("n_nationkey", F.struct(F.col("n_nationkey").alias("a"), F.col("n_regionkey").alias("b")).alias("obj"))
    return read_ion(spark, stored(spark, df), map_inference_threshold=2).select("n_nationkey", F.explode("obj").alias("k", "v"))


@query("SELECT c_custkey, c_name AS name, c_nationkey::VARCHAR AS nation FROM customer")
def ion_max_depth(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", F.struct(F.col("c_name").alias("n"), F.col("c_nationkey").alias("k")).alias("s"))
    got = read_ion(spark, stored(spark, df), maximum_depth=1)
    return got.select("c_custkey", F.col("s.n").alias("name"), F.col("s.k").alias("nation"))


_BASKET = "SELECT o_orderkey, o_orderpriority, list(l_partkey ORDER BY l_linenumber, l_partkey) AS parts FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL"


def _baskets(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("l"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return orders.select(F.struct("o_orderkey", "o_orderpriority").alias("o"), F.transform("l", lambda x: x["l_partkey"]).alias("parts"))


@query(f"SELECT o_orderkey, o_orderpriority, len(parts)::INTEGER AS n FROM ({_BASKET})")
def ion_nested_struct_access(spark, sf_dir):
    df = IonFrame(spark, stored(spark, _baskets(spark, sf_dir)), **LINES).select("o", "parts")
    return df.select("o.o_orderkey", "o.o_orderpriority", F.size("parts").alias("n"))


@query(f"SELECT o_orderkey, parts[1] AS one, parts[2] AS two, parts[100] AS beyond FROM ({_BASKET})")
def ion_list_extract(spark, sf_dir):
    df = read_ion(spark, stored(spark, _baskets(spark, sf_dir), binary=True))
    return df.select("o.o_orderkey", list_extract("parts", 1).alias("one"), list_extract("parts", 2).alias("two"), list_extract("parts", 100).alias("beyond"))


@query("SELECT '{s_suppkey: ' || s_suppkey || ', s_name: \"' || s_name || '\", s_nationkey: ' || s_nationkey || ', s_acctbal: ' || s_acctbal || '}' AS ion FROM supplier")
def to_ion_struct(spark, sf_dir):
    df = table(spark, sf_dir, "supplier")
    return df.select(to_ion(df).alias("ion"))


@query("SELECT n_nationkey, '[' || n_nationkey || ', null, ' || n_regionkey || ']' AS ion FROM nation")
def to_ion_list(spark, sf_dir):
    df = table(spark, sf_dir, "nation").withColumn("l", F.array("n_nationkey", F.lit(None).cast("int"), "n_regionkey"))
    return df.select("n_nationkey", to_ion(df, "l").alias("ion"))


@query("SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN 'null' ELSE '\"' || n_name || '\"' END AS ion FROM nation")
def to_ion_null(spark, sf_dir):
    df = table(spark, sf_dir, "nation").withColumn("v", F.when(F.col("n_regionkey") != 1, F.col("n_name")))
    return df.select("n_nationkey", to_ion(df, "v").alias("ion"))


@query("SELECT doc_id, '\"' || replace(replace(replace(replace(replace(text, '\\', '\\\\'), '\"', '\\\"'), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '\"' AS ion FROM documents")
def to_ion_escape(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return df.select("doc_id", to_ion(df, "text").alias("ion"))


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS ion FROM orders")
def to_ion_timestamp(spark, sf_dir):
    df = table(spark, sf_dir, "orders")
    return df.select("o_orderkey", to_ion(df, "o_orderdate").alias("ion"))


@query("SELECT doc_id, '{{' || base64(encode(text)) || '}}' AS ion FROM documents")
def to_ion_blob(spark, sf_dir):
    df = table(spark, sf_dir, "documents").withColumn("b", F.col("text").cast("binary"))
    return df.select("doc_id", to_ion(df, "b").alias("ion"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice::VARCHAR AS price, (l_extendedprice * 1e12)::VARCHAR AS large, (l_tax / 1e6)::VARCHAR AS small FROM lineitem")
def to_ion_double(spark, sf_dir):
    df = table(spark, sf_dir, "lineitem").withColumns({"large": F.col("l_extendedprice") * 1e12, "small": F.col("l_tax") / 1e6})
    return df.select("l_orderkey", "l_linenumber", to_ion(df, "l_extendedprice").alias("price"), to_ion(df, "large").alias("large"), to_ion(df, "small").alias("small"))


@query("SELECT n_nationkey, '{a: ' || n_nationkey || ', b: [\"' || n_name || '\"]}' AS ion FROM nation")
def to_ion_sql(spark, sf_dir):
    register(spark)
    table(spark, sf_dir, "nation").createOrReplaceTempView("ion_nation")
    return spark.sql("SELECT n_nationkey, to_ion(named_struct('a', n_nationkey, 'b', array(n_name))) AS ion FROM ion_nation")


@query("SELECT strftime(o_orderdate, '%d/%m/%Y %H:%M') AS o_orderdate, o_orderkey FROM orders")
def ion_write_timestamp_format(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate")), timestampformat="%d/%m/%Y %H:%M")
    return read_ion(spark, path, **LINES)


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation WHERE n_regionkey = 2")
def ion_write_partitioned(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "nation"), partition_by=["n_regionkey"], compression="gzip")
    return read_ion(spark, f"{path}/n_regionkey=2", **LINES)


@query("SELECT count(*) AS n FROM lineitem")
def ion_count(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "lineitem"))
    return read_ion(spark, path, select=[], **LINES).agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM lineitem")
def ion_count_binary(spark, sf_dir):
    return spark.createDataFrame([(count_ion(spark, stored(spark, table(spark, sf_dir, "lineitem"), binary=True)),)], "n long")


@query("SELECT event_id, event_type, value FROM events")
def ion_project3(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "events"))
    return read_ion(spark, path, columns={"event_id": "BIGINT", "event_type": "VARCHAR", "value": "DOUBLE"}, **LINES)


@query("SELECT event_type, count(*) AS n FROM events WHERE value > 5 GROUP BY event_type")
def ion_filter_group(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "events"))
    return read_ion(spark, path, columns={"event_type": "VARCHAR", "value": "DOUBLE"}, **LINES).where("value > 5").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT l_orderkey, l_partkey, l_quantity, l_returnflag FROM lineitem")
def ion_wide_project(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "lineitem"), binary=True)
    columns = {"l_orderkey": "BIGINT", "l_partkey": "BIGINT", "l_quantity": "DOUBLE", "l_returnflag": "VARCHAR"}
    return read_ion(spark, path, columns=columns)


@query("SELECT 0::BIGINT AS n")
def ion_except_all_parity(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    text, binary = (read_ion(spark, stored(spark, orders, binary=b), columns=ORDERS) for b in (False, True))
    return text.exceptAll(binary).unionAll(binary.exceptAll(text)).agg(F.count("*").alias("n"))


@query("SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name")
def ion_join(spark, sf_dir):
    customer = read_ion(spark, stored(spark, table(spark, sf_dir, "customer"), binary=True), select=["c_nationkey"])
    nation = read_ion(spark, stored(spark, table(spark, sf_dir, "nation")))
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def ion_anti_join(spark, sf_dir):
    customer = read_ion(spark, stored(spark, table(spark, sf_dir, "customer")), select=["c_custkey"], **LINES)
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders"), binary=True), select=["o_custkey"])
    return customer.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").agg(F.count("*").alias("n"))


@query("SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)::INTEGER AS nth FROM orders")
def ion_window(spark, sf_dir):
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders")), select=["o_custkey", "o_orderkey", "o_orderdate"], **LINES)
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return orders.select("o_custkey", "o_orderkey", F.row_number().over(w).alias("nth"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)")
def ion_rollup(spark, sf_dir):
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders")), select=["o_orderstatus", "o_orderpriority"], **LINES)
    return orders.rollup("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ion_top_k(spark, sf_dir):
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders")), columns={"o_orderkey": "BIGINT", "o_totalprice": "DOUBLE"}, **LINES)
    return orders.orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT vec_id, [x::DOUBLE FOR x IN embedding] AS embedding, label FROM embeddings")
def ion_binary_float_lists(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "embeddings"), binary=True)
    return read_ion(spark, path, columns={"vec_id": "BIGINT", "embedding": "DOUBLE[]", "label": "INTEGER"})


# -- options of reading -------------------------------------------------------------------


@query("SELECT n_nationkey::BIGINT AS id, CASE WHEN n_nationkey >= 20 THEN n_name END AS late, 1::BIGINT AS columns_of_five FROM nation")
def ion_sample_size(spark, sf_dir):
    key = F.col("n_nationkey")
    line = F.concat(F.lit("{id: "), key, F.when(key >= 20, F.concat(F.lit(', late: "'), "n_name", F.lit('"'))).otherwise(""), F.lit("}"))
    path = scratch(spark)
    table(spark, sf_dir, "nation").select(line.alias("value"), key).coalesce(1).sortWithinPartitions("n_nationkey").select("value").write.text(path)
    five = len(read_ion(spark, path, sample_size=5).columns)
    return read_ion(spark, path, sample_size=-1).withColumn("columns_of_five", F.lit(five).cast("long"))


@query("SELECT r_regionkey::BIGINT AS a FROM region UNION ALL SELECT NULL FROM nation")
def ion_sample_files(spark, sf_dir):
    one = stored(spark, table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("a")).coalesce(1))
    two = stored(spark, table(spark, sf_dir, "nation").select(F.col("n_name").alias("b")).coalesce(1))
    return read_ion(spark, [one, two], union_by_name=True, maximum_sample_files=1)


@query("SELECT count(*) AS n FROM customer")
def ion_profile(spark, sf_dir):
    df = read_ion(spark, stored(spark, table(spark, sf_dir, "customer")), profile=True, **LINES)
    df.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(df.ion_rows_read.value,)], "n long")


@query("SELECT c_custkey, c_name FROM customer")
def ion_use_extractor(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "customer"), binary=True)
    return read_ion(spark, path, select=["c_custkey", "c_name"], use_extractor=True)


def _refusals(spark: SparkSession, attempts: dict) -> DataFrame:
    """What each attempt is refused with; an attempt that goes through says so."""

    def said(attempt) -> str:
        try:
            attempt()
        except Exception as e:
            return str(e).splitlines()[0]
        return "went through"

    return spark.createDataFrame([(name, said(f)) for name, f in attempts.items()], "attempt string, message string")


@query("""SELECT * FROM (VALUES
  ('unknown', 'Invalid named parameter "formt" for function read_ion'),
  ('null', 'option format of read_ion can''t be NULL'),
  ('no path', 'read_ion takes a path or a list of paths'),
  ('scalars with columns', 'with records=false there are no fields, so read_ion takes no columns')) AS v(attempt, message)""")
def ion_read_refusals(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "region"))
    return _refusals(spark, {
        "unknown": lambda: read_ion(spark, path, formt="auto"),
        "null": lambda: read_ion(spark, path, format=None),
        "no path": lambda: read_ion(spark, None),
        "scalars with columns": lambda: read_ion(spark, path, records=False, columns={"a": "BIGINT"}),
    })


@query("""SELECT * FROM (VALUES
  ('unknown', 'write_ion has no option ''formt'''),
  ('arity', 'array takes one value'),
  ('binary format', 'date and timestamp formats can''t be used with binary Ion')) AS v(attempt, message)""")
def ion_write_refusals(spark, sf_dir):
    df, path = table(spark, sf_dir, "region"), scratch(spark)
    return _refusals(spark, {
        "unknown": lambda: write_ion(df, path, formt=1),
        "arity": lambda: write_ion(df, path, array=[True, False]),
        "binary format": lambda: write_ion(df, path, binary=True, dateformat="%Y"),
    })


@query("SELECT CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_nationkey::BIGINT END AS id, CASE WHEN n_nationkey % 3 = 0 THEN NULL ELSE n_name END AS name FROM nation")
def ion_null_rows(spark, sf_dir):
    key = F.col("n_nationkey")
    line = F.when(key % 6 == 0, F.lit("null")).when(key % 6 == 3, F.lit("null.struct")).otherwise(F.concat(F.lit("{id: "), key, F.lit(', name: "'), "n_name", F.lit('"}')))
    path = scratch(spark)
    table(spark, sf_dir, "nation").select(line.alias("value")).write.text(path)
    return read_ion(spark, path)


@query("SELECT 'list among records' AS attempt, true AS refused")
def ion_records_must_be_structs(spark, sf_dir):
    path = scratch(spark)
    table(spark, sf_dir, "nation").select(F.concat(F.lit("["), "n_nationkey", F.lit("]")).alias("value")).write.text(path)
    found = _refusals(spark, {"list among records": lambda: read_ion(spark, path, columns={"id": "BIGINT"}).collect()})
    return found.select("attempt", (F.col("message") != "went through").alias("refused"))


@query("SELECT c_mktsegment, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")
def ion_view_sql(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "customer"), binary=True)
    ion_view(spark, "ion_customer", path, columns={"c_mktsegment": "VARCHAR", "c_acctbal": "DOUBLE"})
    return spark.sql("SELECT c_mktsegment, count(*) AS n FROM ion_customer WHERE c_acctbal > 0 GROUP BY c_mktsegment")


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_name FROM nation UNION ALL SELECT n_nationkey::BIGINT, n_name FROM nation")
def ion_mixed_encodings(spark, sf_dir):
    """Twelve text files and then a binary one, read as lines."""
    df = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = scratch(spark)
    for i in range(12):
        write_ion(df.where(F.col("n_nationkey") % 12 == i), f"{base}/{i:02d}")
    write_ion(df, f"{base}/zz", binary=True)
    return read_ion(spark, f"{base}/*/part*", columns={"n_nationkey": "BIGINT", "n_name": "VARCHAR"}, **LINES)


@query("SELECT c_custkey, c_acctbal FROM customer")
def ion_gzip_both_encodings(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    even = F.col("c_custkey") % 2 == 0
    one = stored(spark, df.where(even), compression="gzip")
    two = stored(spark, df.where(~even), compression="gzip", binary=True)
    columns = {"c_custkey": "BIGINT", "c_acctbal": "DOUBLE"}
    return read_ion(spark, one, columns=columns, **LINES).unionAll(read_ion(spark, two, columns=columns))


# -- types --------------------------------------------------------------------------------


@query("SELECT o_orderkey, o_orderstatus = 'F' AS done, o_orderpriority LIKE '1%' AS urgent FROM orders")
def ion_boolean(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderstatus") == "F").alias("done"), F.col("o_orderpriority").startswith("1").cast("string").alias("urgent"))
    return read_ion(spark, stored(spark, df, binary=True), columns={"o_orderkey": "BIGINT", "done": "BOOLEAN", "urgent": "BOOLEAN"})


_BLOBS = "SELECT doc_id, hex(encode(text)) AS data FROM documents"


@query(f"{_BLOBS} UNION ALL {_BLOBS}")
def ion_blob(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.col("text").cast("binary").alias("data"))
    columns = {"doc_id": "BIGINT", "data": "BLOB"}
    both = read_ion(spark, stored(spark, df), columns=columns, **LINES).unionAll(read_ion(spark, stored(spark, df, binary=True), columns=columns))
    return both.select("doc_id", F.hex("data").alias("data"))


@query("SELECT c_custkey AS id, c_custkey * 2 AS v, 'x' AS w FROM customer")
def ion_duplicate_fields(spark, sf_dir):
    """Of a repeated field the last that isn't null counts, and names are told by case."""
    key = F.col("c_custkey")
    line = F.concat(F.lit("{id: "), key, F.lit(", v: 1, v: "), key * 2, F.lit(", w: \"x\", v: null, W: \"y\", ID: 0}"))
    path = scratch(spark)
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return read_ion(spark, path, columns={"id": "BIGINT", "v": "BIGINT", "w": "VARCHAR"}, **LINES)


@query("SELECT o_orderkey, strftime(o_orderdate, '%d.%m.%Y') AS day FROM orders")
def ion_write_date_format(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return read_ion(spark, stored(spark, df, dateformat="%d.%m.%Y"), **LINES)


@query("SELECT '{''null'': ' || n_nationkey || ', ''a b'': \"' || n_name || '\", ''it\\''s'': ' || n_regionkey || ', _ok9: true, ''9x'': null}' AS ion FROM nation")
def to_ion_symbols(spark, sf_dir):
    df = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("null"), F.col("n_name").alias("a b"), F.col("n_regionkey").alias("it's"), F.lit(True).alias("_ok9"), F.lit(None).cast("int").alias("9x")
    )
    return df.select(to_ion(df).alias("ion"))


# -- relational algebra over Ion ----------------------------------------------------------


@query("SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) > 0 AS some FROM orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders) GROUP BY o_orderpriority")
def ion_subquery(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "orders"))
    ion_view(spark, "ion_orders", path, columns={"o_orderpriority": "VARCHAR", "o_totalprice": "DOUBLE"}, **LINES)
    return spark.sql("WITH big AS (SELECT * FROM ion_orders WHERE o_totalprice > (SELECT avg(o_totalprice) FROM ion_orders)) SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) > 0 AS some FROM big GROUP BY o_orderpriority")


@query("SELECT i AS id, CASE WHEN i % 15 = 0 THEN 'both' WHEN i % 5 = 0 THEN 'five' ELSE 'none' END AS kind, '2020-01-01'::TIMESTAMP + to_seconds(i) AS ts FROM range(10000) AS r(i)")
def ion_range(spark, sf_dir):
    i = F.col("id")
    df = spark.range(10000).select(i, F.when(i % 15 == 0, "both").when(i % 5 == 0, "five").otherwise("none").alias("kind"), F.expr("timestamp_ntz'2020-01-01' + make_interval(0, 0, 0, 0, 0, 0, id)").alias("ts"))
    got = read_ion(spark, stored(spark, df, binary=True), columns={"id": "BIGINT", "kind": "VARCHAR", "ts": "TIMESTAMP"})
    return got.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@query("SELECT c_nationkey::BIGINT AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def ion_intersect(spark, sf_dir):
    customer = read_ion(spark, stored(spark, table(spark, sf_dir, "customer"), binary=True), columns={"c_nationkey": "BIGINT"})
    supplier = read_ion(spark, stored(spark, table(spark, sf_dir, "supplier")), columns={"s_nationkey": "BIGINT"}, **LINES)
    return customer.toDF("k").intersect(supplier.toDF("k"))


@query("SELECT c_nationkey::BIGINT AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def ion_union_distinct(spark, sf_dir):
    customer = read_ion(spark, stored(spark, table(spark, sf_dir, "customer"), binary=True), columns={"c_nationkey": "BIGINT"})
    supplier = read_ion(spark, stored(spark, table(spark, sf_dir, "supplier")), columns={"s_nationkey": "BIGINT"}, **LINES)
    return customer.toDF("k").unionAll(supplier.toDF("k")).distinct()


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)")
def ion_cube_distinct(spark, sf_dir):
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders"), binary=True), columns=ORDERS, select=["o_orderstatus", "o_orderpriority", "o_custkey"])
    return orders.cube("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def ion_semi_join(spark, sf_dir):
    customer = read_ion(spark, stored(spark, table(spark, sf_dir, "customer")), columns={"c_custkey": "BIGINT"}, **LINES)
    orders = read_ion(spark, stored(spark, table(spark, sf_dir, "orders"), binary=True), columns={"o_custkey": "BIGINT", "o_orderstatus": "VARCHAR"})
    return customer.join(orders.where("o_orderstatus = 'F'"), F.col("o_custkey") == F.col("c_custkey"), "left_semi")


@query("SELECT c_custkey, upper(c_mktsegment) AS u, substr(c_name, 1, 8) AS s, length(c_name) AS l, abs(c_acctbal) AS a, hex(c_custkey) AS h, replace(c_name, '#', '-') AS r FROM customer")
def ion_scalar_functions(spark, sf_dir):
    columns = {"c_custkey": "BIGINT", "c_name": "VARCHAR", "c_mktsegment": "VARCHAR", "c_acctbal": "DOUBLE"}
    df = read_ion(spark, stored(spark, table(spark, sf_dir, "customer")), columns=columns, **LINES)
    return df.select(
        "c_custkey", F.upper("c_mktsegment").alias("u"), F.substring("c_name", 1, 8).alias("s"), F.length("c_name").cast("long").alias("l"), F.abs("c_acctbal").alias("a"), F.hex("c_custkey").alias("h"), F.replace("c_name", F.lit("#"), F.lit("-")).alias("r")
    )


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def ion_streaming(spark, sf_dir):
    """Files of Ion as a stream, written as Ion by a stream, and counted."""
    path, out = stored(spark, table(spark, sf_dir, "events").select("event_id", "event_type")), scratch(spark)
    rows = read_ion_stream(spark, path, columns={"event_id": "BIGINT", "event_type": "VARCHAR"})
    write_ion_stream(rows, out, scratch(spark), availableNow=True).awaitTermination()
    return read_ion(spark, out, columns={"event_type": "VARCHAR"}, **LINES).groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT p_partkey, reverse(p_brand) AS brand FROM part")
def ion_user_function(spark, sf_dir):
    df = read_ion(spark, stored(spark, table(spark, sf_dir, "part"), binary=True), columns={"p_partkey": "BIGINT", "p_brand": "VARCHAR"})
    backwards = F.arrow_udf(lambda x: pc.utf8_reverse(x), "string")
    return df.select("p_partkey", backwards("p_brand").alias("brand"))


# -- options of writing -------------------------------------------------------------------


@query("SELECT c_custkey FROM customer UNION ALL SELECT c_custkey FROM customer")
def ion_write_append(spark, sf_dir):
    df = table(spark, sf_dir, "customer").select("c_custkey")
    path = stored(spark, df)
    write_ion(df, path, mode="append")
    return read_ion(spark, path, columns={"c_custkey": "BIGINT"}, **LINES)


@query("SELECT n_nationkey::BIGINT AS n_nationkey, n_regionkey::BIGINT AS n_regionkey, 5::BIGINT AS files FROM nation")
def ion_write_options(spark, sf_dir):
    df, path = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey").coalesce(1), scratch(spark)
    files = write_ion(df, path, partition_by=["n_regionkey"], write_partition_columns=True, file_extension="ioz", return_files=True, overwrite_or_ignore=True, per_thread_output=True)
    return read_ion(spark, f"{path}/*/*.ioz").withColumn("files", F.lit(len(files)).cast("long"))


@query("SELECT 3::BIGINT AS files, count(*) AS n FROM nation")
def ion_write_records_per_file(spark, sf_dir):
    path = stored(spark, table(spark, sf_dir, "nation").coalesce(1), binary=True, max_records_per_file=10, mode="overwrite")
    df = read_ion(spark, path, columns={"n_nationkey": "BIGINT"})
    return df.agg(F.lit(len(list_files(spark, path))).cast("long").alias("files"), F.count("*").alias("n"))
