"""Registered queries over the test tables, each paired with an
independent SQL oracle (DuckDB dialect) that computes the same relation.

Every query reads whole tables (or data Spark derives from them); none caps,
samples or filters rows to stay cheap.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import stable_bucket
from tessera.operators import graph, groups, numeric, quality, text
from tessera.plans.inputs import (
    PART_LINK_EDGES_SQL, kv_lines, lineitem_tsv, order_line_tsv, order_lines,
    part_link_edges, product_tsv, table,
)
from tessera.sources.text import parse_edges, parse_tsv

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared by queries and oracles.
WS = r"[ \t\n\x0B\f\r]"                 # ASCII whitespace, as Java's \s
TOKEN = r"[^ \t\n\x0B\f\r]+"
LINE_BREAK = r"\r\n|\r|\n"
DENSE, SUPER_DENSE = 5, 6               # characters per word, for documents
BUCKET_SALT, BUCKET_N = "abc1234", 10


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return table(spark, sf, name)


def _tokens_sql(col: str) -> str:
    return f"CAST(coalesce(len(regexp_extract_all({col}, '{TOKEN}')), 0) AS BIGINT)"


# ---------------------------------------------------------------- text

def q_word_count(spark, sf):
    return text.word_count(_t(spark, sf, "documents"), "text")


def q_line_length_sum(spark, sf):
    return text.line_length_sum(_t(spark, sf, "documents"), "text", split_lines=True)


def q_token_count(spark, sf):
    return text.token_counts(_t(spark, sf, "documents"), "text", keep=["doc_id"])


def q_char_pair_counts(spark, sf):
    return text.char_pair_counts(_t(spark, sf, "documents"), "text", "adjacent", split_lines=True)


def q_char_pair_counts_word_ends(spark, sf):
    return text.char_pair_counts(_t(spark, sf, "documents"), "text", "word_ends", split_lines=True)


def q_flatten_fields(spark, sf):
    return text.flatten_fields(_t(spark, sf, "part"), ["p_partkey", "p_brand"], explode=True)


# ---------------------------------------------------------------- groups

def q_keyed_product_sum(spark, sf):
    return groups.keyed_product_sum(_t(spark, sf, "lineitem"), qty="l_quantity", code="l_returnflag",
                                    group="l_linestatus", factor="l_linenumber")


def q_keyed_product_sum_tsv(spark, sf):
    """The same sums read the job's way: from four-field text lines."""
    parsed = parse_tsv(product_tsv(_t(spark, sf, "lineitem")),
                       "qty long, l_returnflag string, l_linestatus string, factor long")
    return groups.keyed_product_sum(parsed, qty="qty", code="l_returnflag", group="l_linestatus",
                                    factor="factor")


def _order_lines(spark, sf, extra=()):
    return order_lines(_t(spark, sf, "lineitem"), _t(spark, sf, "orders"), extra)


def q_order_totals(spark, sf):
    return groups.order_totals(_order_lines(spark, sf))


def q_avg_order_quantity(spark, sf):
    return groups.avg_order_quantity(_order_lines(spark, sf))


def q_avg_order_quantity_tsv(spark, sf):
    """The same averages read the job's way: five-field order lines, header
    rule and exact field count, a customer per line."""
    schema = "order_key bigint, item string, quantity bigint, date string, customer bigint"
    lines = parse_tsv(order_line_tsv(_t(spark, sf, "lineitem"), _t(spark, sf, "orders")), schema,
                      header_prefix="InvoiceNo")
    return groups.avg_order_quantity(lines)


def q_density_by_group(spark, sf):
    return groups.density_by_group(_t(spark, sf, "documents"), group="source", population="n_chars",
                                   unit_text="text", dense=DENSE, super_dense=SUPER_DENSE)


def q_mean_and_max_by_group(spark, sf):
    return groups.mean_and_max_by_group(_t(spark, sf, "documents"), group="lang",
                                        population="n_chars", unit_text="text")


def q_retail_key_sum(spark, sf):
    return groups.retail_key_sum(_t(spark, sf, "lineitem"), key="l_partkey", qty="l_quantity")


def q_retail_key_two_sums(spark, sf):
    return groups.retail_key_two_sums(_t(spark, sf, "lineitem"), key="l_partkey", qty="l_quantity",
                                      order="l_orderkey")


def q_ratio_by_pair(spark, sf):
    lines = _order_lines(spark, sf, ("o_orderpriority",))
    cust = _t(spark, sf, "customer").select(F.col("c_custkey").alias("customer"), "c_mktsegment")
    rows = lines.join(cust, "customer")
    return groups.ratio_by_pair(rows, "c_mktsegment", "o_orderpriority", "quantity")


def q_customer_order_item_rollup(spark, sf):
    customers, orders = _t(spark, sf, "customer"), _t(spark, sf, "orders")
    return groups.customer_order_item_rollup(
        customers, orders, _t(spark, sf, "lineitem"),
        c_key="c_custkey", c_group="c_mktsegment", o_key="o_orderkey", o_cust="o_custkey",
        i_order="l_orderkey")


def q_group_size_histogram(spark, sf):
    return groups.group_size_histogram(_t(spark, sf, "documents"), unit_text="text")


# ---------------------------------------------------------------- graph

def _edges(spark, sf):
    return part_link_edges(_t(spark, sf, "lineitem"))


def q_parse_edges(spark, sf):
    e = _edges(spark, sf)
    lines = e.select(F.concat_ws(" ", F.col("src").cast("string"), F.col("dst").cast("string")).alias("value"))
    return parse_edges(lines)


def q_drop_self_edges(spark, sf):
    return graph.drop_self_edges(_edges(spark, sf))


def q_symmetric_edges(spark, sf):
    return graph.symmetric_edges(_edges(spark, sf))


def q_two_paths(spark, sf):
    o = graph.oriented_edges(_edges(spark, sf), checkpoint=True)
    return graph.two_paths(o).select(
        "middle", F.col("start").alias("start_node"), F.col("end").alias("end_node"))


def q_closing_edges(spark, sf):
    return graph.triangle_paths(_edges(spark, sf)).select(
        F.col("start").alias("start_node"), F.col("end").alias("end_node"), "middle")


def q_triangle_count(spark, sf):
    return graph.triangle_count(_edges(spark, sf))


# ---------------------------------------------------------------- other

def q_parse_tsv(spark, sf):
    schema = "order_id string, item_id string, quantity int, date string, customer_id string"
    return parse_tsv(lineitem_tsv(_t(spark, sf, "lineitem")), schema, header_prefix="InvoiceNo")


def q_compensated_sum(spark, sf):
    return numeric.compensated_sum(_t(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"])


def q_stable_bucket(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id")
    return d.select("doc_id", stable_bucket(F.col("doc_id"), T.LongType(), BUCKET_SALT, BUCKET_N)
                    .alias("bucket"))


def q_stable_bucket_typed(spark, sf):
    """Buckets of text, list and mixed keys of the same rows."""
    d = _t(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars")
    both = F.array("lang", "source")
    mixed = F.struct("lang", "n_chars")
    mixed_type = T.StructType([T.StructField("lang", T.StringType()), T.StructField("n_chars", T.LongType())])
    return d.select(
        "doc_id", stable_bucket(F.col("source"), T.StringType(), BUCKET_SALT, BUCKET_N).alias("by_text"),
        stable_bucket(both, T.ArrayType(T.StringType()), BUCKET_SALT, BUCKET_N).alias("by_list"),
        stable_bucket(mixed, mixed_type, BUCKET_SALT, BUCKET_N).alias("by_mixed"))


def q_compensated_sum_by_part(spark, sf):
    return numeric.compensated_sum(_t(spark, sf, "lineitem"), "l_extendedprice", ["l_partkey"])


def q_check_kv_lines(spark, sf):
    lines = kv_lines(_t(spark, sf, "conversations"), _t(spark, sf, "events"))
    return quality.check_kv_lines(lines, "value", keep=["origin", "line_id"], keep_valid=True)


QUERIES: dict[str, Query] = {
    "word_count": q_word_count,
    "line_length_sum": q_line_length_sum,
    "keyed_product_sum": q_keyed_product_sum,
    "order_totals": q_order_totals,
    "avg_order_quantity": q_avg_order_quantity,
    "keyed_product_sum_tsv": q_keyed_product_sum_tsv,
    "avg_order_quantity_tsv": q_avg_order_quantity_tsv,
    "density_by_group": q_density_by_group,
    "token_count": q_token_count,
    "drop_self_edges": q_drop_self_edges,
    "symmetric_edges": q_symmetric_edges,
    "two_paths": q_two_paths,
    "closing_edges": q_closing_edges,
    "triangle_count": q_triangle_count,
    "parse_edges": q_parse_edges,
    "parse_tsv": q_parse_tsv,
    "flatten_fields": q_flatten_fields,
    "mean_and_max_by_group": q_mean_and_max_by_group,
    "compensated_sum": q_compensated_sum,
    "compensated_sum_by_part": q_compensated_sum_by_part,
    "stable_bucket": q_stable_bucket,
    "stable_bucket_typed": q_stable_bucket_typed,
    "check_kv_lines": q_check_kv_lines,
    "char_pair_counts": q_char_pair_counts,
    "char_pair_counts_word_ends": q_char_pair_counts_word_ends,
    "retail_key_sum": q_retail_key_sum,
    "retail_key_two_sums": q_retail_key_two_sums,
    "ratio_by_pair": q_ratio_by_pair,
    "customer_order_item_rollup": q_customer_order_item_rollup,
    "group_size_histogram": q_group_size_histogram,
}


# ---------------------------------------------------------------- oracles

_E = f"edges AS ({PART_LINK_EDGES_SQL})"
_UND = ("und AS (SELECT DISTINCT least(src, dst) AS u, greatest(src, dst) AS v "
        "FROM edges WHERE src <> dst)")
_DEG = ("deg AS (SELECT node, count(*) AS d FROM "
        "(SELECT u AS node FROM und UNION ALL SELECT v FROM und) GROUP BY node)")
_ORIENT = """o AS (
    SELECT CASE WHEN fwd THEN u ELSE v END AS src, CASE WHEN fwd THEN v ELSE u END AS dst,
           CASE WHEN fwd THEN dv ELSE du END AS dst_deg
    FROM (SELECT u, v, a.d AS du, b.d AS dv, (a.d < b.d OR (a.d = b.d AND u < v)) AS fwd
          FROM und JOIN deg a ON a.node = u JOIN deg b ON b.node = v))"""
_SYM = ("sym AS (SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges WHERE src <> dst "
        "UNION ALL SELECT dst, src FROM edges WHERE src <> dst))")
# The reference's route: all two-paths of the symmetric graph, closed by an edge.
_CLOSED = """closed AS (
    SELECT p.start_node, p.end_node, p.middle
    FROM (SELECT a.src AS middle, a.dst AS start_node, b.dst AS end_node
          FROM sym a JOIN sym b ON a.src = b.src) p
    JOIN sym s ON s.src = p.start_node AND s.dst = p.end_node)"""
_ORDER_TOTALS = """t AS (
    SELECT o_custkey AS customer, o_orderkey AS order_key,
           sum(l_quantity) AS total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2)"""
_DOC_LINES = f"lines AS (SELECT unnest(string_split_regex(text, '{LINE_BREAK}')) AS line FROM documents)"


def _bucket_sql(n: int, h: str = "h") -> str:
    acc = "0"
    for i in range(5):
        acc = f"(({acc}) * 4294967296 + ('0x' || substr({h}, {8 * i + 1}, 8))::BIGINT) % {n}"
    return acc


def _sha_sql(kind: str, text: str) -> str:
    return f"sha1('{BUCKET_SALT}|<class ''{kind}''>|' || {text})"


def _quoted_sql(col: str) -> str:
    return f"coalesce(chr(39) || {col} || chr(39), 'None')"


# JSON as the key/value check reads it: DuckDB's validity, plus the three
# literals it does not know. (test_queries holds that no line of the tables
# falls where the two differ otherwise.)
def _json_sql(col: str) -> str:
    return f"(json_valid({col}) OR trim({col}, ' ' || chr(9) || chr(10) || chr(13)) IN ('NaN', 'Infinity', '-Infinity'))"


_KEYED_PRODUCT_SUM_SQL = """
        SELECT l_linestatus, l_returnflag, sum(l_quantity * l_linenumber) AS total, count(*) AS n
        FROM lineitem GROUP BY 1, 2"""
_AVG_ORDER_SQL = f"""
        WITH {_ORDER_TOTALS}
        SELECT customer, CAST(sum(total) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS avg_quantity
        FROM t GROUP BY customer HAVING count(*) > 1"""

ORACLE_SQL: dict[str, str] = {
    "word_count": f"""
        SELECT word, count(*) AS count
        FROM (SELECT unnest(string_split_regex(text, '{WS}+')) AS word FROM documents)
        WHERE word <> '' GROUP BY word""",
    "line_length_sum": f"""
        WITH {_DOC_LINES},
        toks AS (SELECT list_filter(string_split_regex(line, '{WS}+'), lambda x: x <> '') AS t FROM lines),
        w AS (SELECT unnest(t) AS word, len(t) AS n FROM toks)
        SELECT word, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS total
        FROM w GROUP BY word""",
    "keyed_product_sum": _KEYED_PRODUCT_SUM_SQL,
    "keyed_product_sum_tsv": _KEYED_PRODUCT_SUM_SQL,
    "order_totals": f"WITH {_ORDER_TOTALS} SELECT customer, order_key, total FROM t",
    "avg_order_quantity": _AVG_ORDER_SQL,
    "avg_order_quantity_tsv": _AVG_ORDER_SQL,
    "density_by_group": f"""
        WITH r AS (SELECT source, n_chars AS pop, {_tokens_sql('text')} AS n FROM documents
                   WHERE source IS NOT NULL AND trim(source) <> '' AND n_chars IS NOT NULL)
        SELECT source,
               CAST(coalesce(round(CAST(sum(pop) AS DOUBLE) / nullif(CAST(sum(n) AS DOUBLE), 0)), 0) AS BIGINT)
                 AS avg_per_unit,
               count(*) FILTER (WHERE n > 0 AND pop >= n * {DENSE}) AS dense,
               count(*) FILTER (WHERE n > 0 AND pop >= n * {SUPER_DENSE}) AS super_dense
        FROM r GROUP BY source""",
    "token_count": f"SELECT doc_id, {_tokens_sql('text')} AS tokens FROM documents",
    "drop_self_edges": f"WITH {_E} SELECT src, dst FROM edges WHERE src <> dst",
    "symmetric_edges": f"""
        WITH {_E}
        SELECT DISTINCT src, dst FROM (SELECT src, dst FROM edges UNION ALL SELECT dst, src FROM edges)""",
    "two_paths": f"""
        WITH {_E}, {_UND}, {_DEG}, {_ORIENT}
        SELECT a.src AS middle, a.dst AS start_node, b.dst AS end_node
        FROM o a JOIN o b ON a.src = b.src
        WHERE a.dst_deg < b.dst_deg OR (a.dst_deg = b.dst_deg AND a.dst < b.dst)""",
    "closing_edges": f"WITH {_E}, {_SYM}, {_CLOSED} SELECT start_node, end_node, middle FROM closed",
    "triangle_count": f"""
        WITH {_E}, {_SYM}, {_CLOSED}
        SELECT CAST(count(*) // 6 AS BIGINT) AS triangles FROM closed""",
    "parse_edges": f"""
        WITH {_E} SELECT CAST(src AS VARCHAR) AS src, CAST(dst AS VARCHAR) AS dst FROM edges""",
    "parse_tsv": """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS item_id,
               CAST(CAST(l_quantity AS BIGINT) AS INTEGER) AS quantity,
               CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date,
               CAST(l_suppkey AS VARCHAR) AS customer_id
        FROM lineitem""",
    "flatten_fields": "SELECT unnest([CAST(p_partkey AS VARCHAR), p_brand]) AS field FROM part",
    "mean_and_max_by_group": f"""
        SELECT lang, CAST(sum(n_chars) AS DOUBLE) / CAST(count(n_chars) AS DOUBLE) AS mean_population,
               max({_tokens_sql('text')}) AS max_units
        FROM documents GROUP BY lang""",
    "compensated_sum_by_part": "SELECT l_partkey, fsum(l_extendedprice) AS total FROM lineitem GROUP BY 1",
    "stable_bucket_typed": f"""
        SELECT doc_id, CAST({_bucket_sql(BUCKET_N, _sha_sql('str', 'source'))} AS BIGINT) AS by_text,
               CAST({_bucket_sql(BUCKET_N, _sha_sql('list', f"'[' || {_quoted_sql('lang')} || ', ' || {_quoted_sql('source')} || ']'"))}
                    AS BIGINT) AS by_list,
               CAST({_bucket_sql(BUCKET_N, _sha_sql('list', f"'[' || {_quoted_sql('lang')} || ', ' || coalesce(CAST(n_chars AS VARCHAR), 'None') || ']'"))}
                    AS BIGINT) AS by_mixed
        FROM documents""",
    "check_kv_lines": f"""
        WITH turns AS (SELECT '[' || conv_id || ',' || turn || ']' AS line_id,
                              unnest(string_split_regex(text, '{LINE_BREAK}')) AS t FROM conversations),
        l AS (SELECT 'turn' AS origin, line_id, line_id || chr(9) || t AS line FROM turns
              UNION ALL SELECT 'event', event_id::VARCHAR, event_id || chr(9) || props FROM events
              UNION ALL SELECT 'no_tab', event_id::VARCHAR, event_id || ' ' || event_type FROM events
              UNION ALL SELECT 'extra_tab', event_id::VARCHAR, event_id || chr(9) || props || chr(9) FROM events
              UNION ALL SELECT 'text_key', event_id::VARCHAR, event_type || chr(9) || props FROM events),
        p AS (SELECT *, string_split(line, chr(9)) AS f FROM l)
        SELECT origin, line_id, line,
               CASE WHEN line IS NULL OR NOT regexp_matches(line, '[^ \\t\\n\\r\\f\\v]') THEN NULL
                    WHEN len(f) = 1 THEN 'no_tab' WHEN len(f) > 2 THEN 'extra_tab'
                    WHEN NOT {_json_sql('f[1]')} THEN 'bad_key'
                    WHEN NOT {_json_sql('f[2]')} THEN 'bad_value' END AS reason
        FROM p""",
    "compensated_sum": "SELECT l_returnflag, fsum(l_extendedprice) AS total FROM lineitem GROUP BY 1",
    "stable_bucket": f"""
        WITH x AS (SELECT doc_id, sha1('{BUCKET_SALT}|<class ''int''>|' || CAST(doc_id AS VARCHAR)) AS h
                   FROM documents)
        SELECT doc_id, CAST({_bucket_sql(BUCKET_N)} AS BIGINT) AS bucket FROM x""",
    "char_pair_counts": f"""
        WITH {_DOC_LINES},
        c AS (SELECT string_split(line, '') AS ch FROM lines),
        p AS (SELECT unnest(list_zip(ch[1:len(ch) - 1], ch[2:len(ch)])) AS pr FROM c WHERE len(ch) >= 2)
        SELECT pr[1] AS first, pr[2] AS second, count(*) AS count FROM p GROUP BY 1, 2""",
    "char_pair_counts_word_ends": f"""
        WITH {_DOC_LINES},
        w AS (SELECT unnest(string_split_regex(line, '{WS}+')) AS word FROM lines)
        SELECT left(word, 1) AS first, right(word, 1) AS second, count(*) AS count
        FROM w WHERE word <> '' GROUP BY 1, 2""",
    "retail_key_sum": """
        SELECT l_partkey, sum(l_quantity) AS total
        FROM lineitem GROUP BY 1""",
    "retail_key_two_sums": """
        SELECT l_partkey, sum(l_quantity) AS total,
               count(DISTINCT l_orderkey) AS orders
        FROM lineitem GROUP BY 1""",
    "ratio_by_pair": """
        WITH q AS (SELECT l_orderkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1)
        SELECT c_mktsegment, o_orderpriority,
               CAST(sum(qty) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS ratio
        FROM q JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
        GROUP BY 1, 2""",
    "customer_order_item_rollup": """
        SELECT c_mktsegment, count(DISTINCT c_custkey) AS customers,
               count(DISTINCT o_orderkey) AS orders, count(l_orderkey) AS lines
        FROM customer LEFT JOIN orders ON o_custkey = c_custkey
                      LEFT JOIN lineitem ON l_orderkey = o_orderkey
        GROUP BY 1""",
    "group_size_histogram": f"""
        SELECT {_tokens_sql('text')} AS units, count(*) AS rows FROM documents GROUP BY 1""",
}
