from conftest import rows
from tessera.operators import groups
from tessera.sources.text import parse_tsv

CITY_SCHEMA = ("city string, state string, state_full string, county string, "
               "population bigint, zipcodes string, id string")
# The city rows of the density fixture (FIXTURES.md F1).
F1 = [
    ("City1", "CA", "California", "County1", 10000, "90001 90002", "ID1"),
    ("City2", "CA", "California", "County2", 5000, "90003", "ID2"),
    ("City3", "NY", "New York", "County3", 100000, "10001 10002 10003 10004", "ID3"),
    ("City4", "NY", "New York", "County4", 50000, "10005", "ID4"),
]


def cities(spark, extra=()):
    return spark.createDataFrame(list(F1) + list(extra), CITY_SCHEMA).repartition(2)


def density(df):
    return groups.density_by_group(df, group="state", population="population", unit_text="zipcodes")


def test_density_golden(spark):
    # The reference's stored golden (0,0 / 1,0) contradicts its own rule; all
    # four cities are dense and super dense.
    assert rows(density(cities(spark))) == [("CA", 5000, 2, 2), ("NY", 30000, 2, 2)]


def test_density_edge_rows(spark):
    extra = [
        ("Z1", "ZZ", "", "", 7, None, "x"),        # no zips: not dense, avg 0
        ("N1", None, "", "", 10, "1", "x"),        # null state: dropped
        ("B1", " ", "", "", 10, "1", "x"),         # blank state: dropped
        ("P1", "CA", "", "", None, "1 2", "x"),    # no population: dropped
        ("Q1", "QQ", "", "", 1499, " 1  2 ", "x"),  # leading blanks: 2 zips
    ]
    got = rows(density(cities(spark, extra)))
    assert got == [("CA", 5000, 2, 2), ("NY", 30000, 2, 2), ("QQ", 750, 1, 0), ("ZZ", 0, 0, 0)]


def test_density_rounds_half_up(spark):
    df = spark.createDataFrame([("a", "S", "", "", 5, "1 2", "")], CITY_SCHEMA)  # 2.5 -> 3
    assert rows(density(df))[0][1] == 3


def test_mean_and_max_golden(spark):
    got = rows(groups.mean_and_max_by_group(cities(spark), "state", "population", unit_text="zipcodes"))
    assert got == [("CA", 7500.0, 2), ("NY", 75000.0, 4)]


# Order lines of the order-average fixture (FIXTURES.md F2).
F2 = ["InvoiceNo\tStockCode\tQuantity\tInvoiceDate\tCustomerID",
      "1\ta\t3\td\tc1", "1\tb\t2\td\tc1", "2\ta\t4\td\tc1", "3\ta\t9\td\tc2",
      "4\ta\t1\td\t", "5\ta\t2\td\t", "bad\t1"]
ORDER_SCHEMA = "order_key string, item string, quantity int, date string, customer string"


def order_lines(spark, values):
    lines = spark.createDataFrame([(v,) for v in values], "value string").repartition(3)
    return parse_tsv(lines, ORDER_SCHEMA, header_prefix="InvoiceNo")


def test_avg_order_quantity_golden(spark):
    got = rows(groups.avg_order_quantity(order_lines(spark, F2)))
    assert got == [("", 1.5), ("c1", 4.5)]


def test_avg_order_counts_orders_not_lines(spark):
    # c3 has two lines of one order: one order, so it drops out.
    got = rows(groups.avg_order_quantity(order_lines(spark, F2 + ["9\ta\t1\td\tc3", "9\tb\t1\td\tc3"])))
    assert got == [("", 1.5), ("c1", 4.5)]


def test_order_totals(spark):
    got = rows(groups.order_totals(order_lines(spark, F2)))
    assert got == [("", "4", 1), ("", "5", 2), ("c1", "1", 5), ("c1", "2", 4), ("c2", "3", 9)]


def test_bad_quantity_dropped_or_fails(spark):
    import pytest
    vals = F2 + ["7\ta\tx\td\tc9", "8\ta\t-2\td\tc1"]
    got = rows(groups.order_totals(order_lines(spark, vals)))
    assert ("c9", "7", None) not in got and ("c1", "8", -2) in got
    lines = spark.createDataFrame([(v,) for v in vals], "value string")
    with pytest.raises(Exception):
        parse_tsv(lines, ORDER_SCHEMA, header_prefix="InvoiceNo", on_error="fail").collect()


# The four-field input lines of the product-sum fixture (FIXTURES.md F6).
F6 = ["1\tb\ta\t3", "2\ta\tc\t2", "3\ta\tc\t4", "3\tb\tc\t8", "1\td\td\t2", "0\td\te\t1",
      "0\td\te\t2", "5\tblank\tk\t3", "1\tb\ta\t3", "9\tj\tc\t2", "3\ta\tc\t4", ""]


def test_keyed_product_sum_golden(spark):
    lines = spark.createDataFrame([(v,) for v in F6], "value string")
    parsed = parse_tsv(lines, "qty long, code string, grp string, factor long")
    got = rows(groups.keyed_product_sum(parsed, "qty", "code", "grp", "factor"))
    assert got == [("a", "b", 6, 2), ("c", "a", 28, 3), ("c", "b", 24, 1), ("c", "j", 18, 1),
                   ("d", "d", 2, 1), ("e", "d", 0, 2), ("k", "blank", 15, 1)]


def items(spark):
    return spark.createDataFrame(
        [("p1", 3, 1), ("p1", 2, 1), ("p1", 5, 2), ("p2", 1, 3), ("p2", 4, 3)],
        "item string, qty int, ord int")


def test_retail_sums(spark):
    assert rows(groups.retail_key_sum(items(spark), "item", "qty")) == [("p1", 10), ("p2", 5)]
    assert rows(groups.retail_key_two_sums(items(spark), "item", "qty", "ord")) == [
        ("p1", 10, 2), ("p2", 5, 1)]


def test_ratio_by_pair(spark):
    df = spark.createDataFrame([("A", "1", 3), ("A", "1", 4), ("B", "2", 5)], "s string, p string, q int")
    assert rows(groups.ratio_by_pair(df, "s", "p", "q")) == [("A", "1", 3.5), ("B", "2", 5.0)]


def test_rollup_matches_naive_left_joins(spark):
    c = spark.createDataFrame([(1, "X"), (2, "X"), (3, "Y"), (4, "Z")], "ck int, seg string")
    o = spark.createDataFrame([(10, 1), (11, 1), (12, 3), (13, 9)], "ok int, oc int")
    i = spark.createDataFrame([(10,), (10,), (12,), (99,)], "io int")
    got = rows(groups.customer_order_item_rollup(c, o, i, "ck", "seg", "ok", "oc", "io"))
    c.createOrReplaceTempView("c"); o.createOrReplaceTempView("o"); i.createOrReplaceTempView("i")
    naive = rows(spark.sql("""SELECT seg, count(DISTINCT ck) AS customers, count(DISTINCT ok) AS orders,
                              count(io) AS lines FROM c LEFT JOIN o ON oc = ck LEFT JOIN i ON io = ok
                              GROUP BY seg"""))
    assert got == naive == [("X", 2, 2, 2), ("Y", 1, 1, 1), ("Z", 1, 0, 0)]


def test_group_size_histogram(spark):
    got = rows(groups.group_size_histogram(cities(spark), unit_text="zipcodes"))
    assert got == [(1, 2), (2, 1), (4, 1)]


def test_density_version_options(spark):
    df = spark.createDataFrame([("a", "S", "", "", 5, "1 2", ""),      # 5 / 2 = 2.5
                                ("z", "T", "", "", 7, None, "")],      # no zips
                               CITY_SCHEMA)
    canon = dict((r[0], r[1:]) for r in rows(density(df)))
    assert canon == {"S": (3, 0, 0), "T": (0, 0, 0)}
    even = dict((r[0], r[1:]) for r in rows(groups.density_by_group(
        df, group="state", population="population", unit_text="zipcodes", rounding="half_even")))
    assert even["S"][0] == 2
    dfv = dict((r[0], r[1:]) for r in rows(groups.density_by_group(
        df, group="state", population="population", unit_text="zipcodes", zero_units_dense=True)))
    assert dfv["T"] == (0, 1, 1)


def test_fractions_are_not_cut(spark):
    df = spark.createDataFrame([("g", "a", 2.7, 1), ("g", "a", 1.6, 1)], "g string, c string, q double, o int")
    near = lambda a, b: abs(a - b) < 1e-12
    assert near(groups.retail_key_sum(df, "g", "q").first()["total"], 4.3)
    assert near(groups.retail_key_two_sums(df, "g", "q", "o").first()["total"], 4.3)
    assert near(groups.ratio_by_pair(df, "g", "c", "q").first()["ratio"], 2.15)
    assert near(groups.keyed_product_sum(df, "q", "c", "g", "q").first()["total"], 2.7 ** 2 + 1.6 ** 2)
    assert near(groups.order_totals(df, "g", "c", "q").first()["total"], 4.3)
    assert near(groups.mean_and_max_by_group(df, "g", "q", units="q").first()["mean_population"], 2.15)
    assert near(groups.mean_and_max_by_group(df, "g", "q", units="q").first()["max_units"], 2.7)
    row = groups.density_by_group(df, "g", "q", units="q", dense=1, super_dense=2).first()
    assert (row["avg_per_unit"], row["dense"], row["super_dense"]) == (1, 2, 0)
    two = spark.createDataFrame([("g", 1, 2.7), ("g", 2, 1.6)], "customer string, order_key int, quantity double")
    assert near(groups.avg_order_quantity(two).first()["avg_quantity"], 2.15)
