"""Whole jobs as the reference runs them: text in, result files out."""

import os
import random
import re
import tempfile
from collections import Counter

from conftest import rows
from tessera.operators import graph, groups, text
from tessera.sources import parse_edges, read_lines, read_tsv, write_csv, write_tuple_text
from test_graph import TOY


def scratch():
    return tempfile.mkdtemp(prefix="tessera-e2e-")


def test_triangle_job_from_text_file(spark):
    d = scratch()
    with open(os.path.join(d, "edges.txt"), "w") as f:
        f.write("\n".join(f"{a} {b}" for a, b in TOY) + "\n")
    count = graph.triangle_count(parse_edges(read_lines(spark, os.path.join(d, "edges.txt"))))
    out = os.path.join(d, "triangles")
    write_csv(count, out)
    assert [r.value for r in read_lines(spark, out).collect()] == ["2"]


def test_word_count_job_to_tuple_text(spark):
    d = scratch()
    src = os.path.join(d, "in")
    os.makedirs(src)
    for i, body in enumerate(["This is a test input\nThis is line 2\n", "The end\n"]):
        with open(os.path.join(src, f"part-{i}"), "w") as f:
            f.write(body)
    out = os.path.join(d, "result")
    write_tuple_text(text.word_count(read_lines(spark, src)), out, ["word", "count"])
    got = sorted(r.value for r in read_lines(spark, out).collect())
    assert got == sorted(["(This,2)", "(is,2)", "(a,1)", "(test,1)", "(input,1)", "(line,1)",
                          "(2,1)", "(The,1)", "(end,1)"])


CITY_SCHEMA = ("city string, state string, state_full string, county string, "
               "population bigint, zipcodes string, id string")


def test_csv_reader_edge_rows(spark):
    d = scratch()
    lines = ["city\tstate\tstate_full\tcounty\tpopulation\tzipcodes\tid",
             "A\tCA\tC\tX\t1000\t1 2\tI1",
             'B\tCA\tC\tX\t3000\t"1\t2"\tI2',        # quoted field holding a tab: one field
             "C\tCA\tC\tX\t10\t1",                   # six fields: padded with null id
             "D\tCA\tC\tX\t10\t1\tI4\textra",        # eight fields: cut
             "E\tCA\tC\tX\tbad\t1\tI5",              # bad population: null, dropped by density
             "F\tCA\tC\tX\t 10\t1\tI6",              # " 10": the CSV reader gives null
             "G\t\tC\tX\t10\t1\tI7",                 # blank state: null, dropped
             "H\tNY\tN\tX\t700\t \tI8"]         # no-break space is not whitespace: 1 zip
    with open(os.path.join(d, "cities.tsv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    df = read_tsv(spark, os.path.join(d, "cities.tsv"), CITY_SCHEMA)
    got = {r.city: (r.population, r.zipcodes, r.id) for r in df.collect()}
    assert got["B"] == (3000, "1\t2", "I2")
    assert got["C"] == (10, "1", None) and got["D"] == (10, "1", "I4")
    assert got["E"][0] is None and got["F"][0] is None
    dens = rows(groups.density_by_group(df, group="state", population="population", unit_text="zipcodes"))
    # CA: A (1000, 2 zips), B (3000, 2 zips: "1<TAB>2"), C (10, 1), D (10, 1)
    assert dens == [("CA", 670, 2, 1), ("NY", 700, 1, 0)]


def test_tokens_match_python_on_random_text(spark):
    rng = random.Random(9)
    alphabet = ["a", "b", "é", "!", " ", "  ", "\t", "\n", "\x0b", "\x0c", "\r", "\xa0", " ", "\x1c"]
    vals = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 15))) for _ in range(1500)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, value string").repartition(4)
    split = re.compile(r"[ \t\n\x0b\f\r]+")
    exp_tokens = [len([t for t in split.split(v) if t]) for v in vals]
    got = dict(rows(text.token_counts(df, "value", keep=["i"]), "i", "tokens"))
    assert [got[i] for i in range(len(vals))] == exp_tokens
    exp_words = Counter(t for v in vals for t in split.split(v) if t)
    assert dict(rows(text.word_count(df))) == dict(exp_words)


def test_csv_reader_dropmalformed(spark):
    d = scratch()
    lines = ["city\tstate\tstate_full\tcounty\tpopulation\tzipcodes\tid",
             "A\tCA\tC\tX\t1000\t1 2\tI1",
             "C\tCA\tC\tX\t10\t1",                   # short
             "D\tCA\tC\tX\t10\t1\tI4\textra",        # long
             "E\tCA\tC\tX\tbad\t1\tI5",              # unparsable population
             "F\tNY\tN\tX\t700\t3\tI6"]
    with open(os.path.join(d, "c.tsv"), "w") as f:
        f.write("\n".join(lines) + "\n")
    df = read_tsv(spark, os.path.join(d, "c.tsv"), CITY_SCHEMA, mode="DROPMALFORMED")
    assert sorted(r.city for r in df.collect()) == ["A", "F"]
