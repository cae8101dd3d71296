"""Inputs derived from the test tables by Spark itself, so that each
query's work grows with the tables.

Only the columns a query needs are read; filters and projections reach the
Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.tokens import line_array
from tessera.operators.joins import skew_safe_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def part_link_edges(lineitem: DataFrame) -> DataFrame:
    """(src, dst) part ids: every order line links its part to the smallest
    part on the next line number of the same order.

    Lines are grouped by (order, line number) once, and each line meets the
    group after its own by a one-row-per-key join, so the edge count never
    exceeds the line count even when line numbers repeat, and a group
    holding a third of all lines can be split. Two scans of the line table.
    Self-edges and repeated edges occur, as in a raw edge list.
    """
    after = lineitem.groupBy(F.col("l_orderkey").alias("ok"), (F.col("l_linenumber") - 1).alias("ln")).agg(
        F.min("l_partkey").alias("dst"))
    lines = lineitem.select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
                            F.col("l_partkey").alias("src"))
    return skew_safe_join(lines, after, ["ok", "ln"]).select("src", "dst")


PART_LINK_EDGES_SQL = """
    SELECT l.l_partkey AS src, n.dst AS dst
    FROM lineitem l
    JOIN (SELECT l_orderkey AS ok, l_linenumber - 1 AS ln, min(l_partkey) AS dst
          FROM lineitem GROUP BY 1, 2) n
      ON n.ok = l.l_orderkey AND n.ln = l.l_linenumber"""


def order_lines(lineitem: DataFrame, orders: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(customer, order_key, quantity, extra...) order lines, one per order;
    ``extra`` names further ``orders`` columns to carry (one scan).

    Quantities are summed per order key on the line table first, so the
    join with ``orders`` moves one row per order instead of one per line
    (equal: summing line sums per (customer, order) is summing lines). An
    order key that repeats in ``orders`` can be split.
    """
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("order_key")).agg(
        F.sum("l_quantity").alias("quantity"))
    rows = orders.select(F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer"), *extra)
    return skew_safe_join(rows, per_order, ["order_key"]).select("customer", "order_key", "quantity", *extra)


def kv_lines(conversations: DataFrame, events: DataFrame) -> DataFrame:
    """(origin, line_id, value): trace-style key/value lines of all kinds.

    - ``turn``: key is the JSON list ``[conv_id, turn]``, value a line of the
      turn's text as written (prose is not JSON, numbers are);
    - ``event``: key is the event's id, value its ``props`` (JSON);
    - ``no_tab`` / ``extra_tab``: the event's id and type without a tab, and
      with a second one;
    - ``text_key``: the event's type as a bare key.
    """
    lines = conversations.select("conv_id", "turn", F.explode(line_array("text")).alias("t"))
    key = F.to_json(F.array(F.col("conv_id"), F.col("turn")))
    turns = lines.select(F.lit("turn").alias("origin"), key.alias("line_id"),
                         F.concat(key, F.lit("\t"), F.col("t")).alias("value"))
    i, kind, props = F.col("event_id").cast("string"), F.col("event_type"), F.col("props")
    made = {"event": F.concat(i, F.lit("\t"), props), "no_tab": F.concat(i, F.lit(" "), kind),
            "extra_tab": F.concat(i, F.lit("\t"), props, F.lit("\t")), "text_key": F.concat(kind, F.lit("\t"), props)}
    rows = F.inline(F.array(*[F.struct(F.lit(k).alias("origin"), i.alias("line_id"), v.alias("value"))
                              for k, v in made.items()]))
    return turns.unionByName(events.select(rows))


def lineitem_tsv(lineitem: DataFrame) -> DataFrame:
    """Tab-separated order lines ``order, item, quantity, date, supplier``
    as text (``value``), for the line parser."""
    return lineitem.select(F.concat_ws(
        "\t", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("long").cast("string"), F.col("l_shipdate").cast("date").cast("string"),
        F.col("l_suppkey").cast("string")).alias("value"))


def product_tsv(lineitem: DataFrame) -> DataFrame:
    """Four-field lines ``quantity, flag, status, line number`` (``value``),
    the layout the product-sum job reads."""
    return lineitem.select(F.concat_ws(
        "\t", F.col("l_quantity").cast("long").cast("string"), F.col("l_returnflag"),
        F.col("l_linestatus"), F.col("l_linenumber").cast("string")).alias("value"))


def order_line_tsv(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Five-field order lines ``order, item, quantity, date, customer``
    (``value``), one per line item, the layout the order-average job reads.
    Building them needs each line's customer: a line-level join, whose hot
    order keys AQE can split (both inputs are fresh shuffles)."""
    lines = lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    cust = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    return lines.join(cust, "l_orderkey").select(F.concat_ws(
        "\t", F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string"),
        F.col("l_quantity").cast("long").cast("string"), F.col("l_shipdate").cast("date").cast("string"),
        F.col("o_custkey").cast("string")).alias("value"))
