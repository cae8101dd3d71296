from conftest import rows
from tessera.operators.quality import check_kv_lines

# key/value lines and their expected reasons (FIXTURES.md F11,
# extended with our own cases).
F11 = [('"a"\t1', None), ("a\t1", "bad_key"), ('"a"', "no_tab"), ('"a"\t1\t2', "extra_tab"),
       ("", None), ("   \t ", None), ('"a"\tNaN', None), ('"k"\t1 2', "bad_value"),
       ('["a", 7]\t[1, {"x": null}]', None), ('{"a":1,"a":2}\t"v"', None), ("1\t", "bad_value"),
       ('"x"\t"unterminated', "bad_value"), (" ", None), (' "a" \t 2 ', None)]


def test_kv_line_reasons(spark):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(F11)], "i int, value string")
    got = rows(check_kv_lines(df, keep=["i"], keep_valid=True), "i", "reason")
    assert [r for _, r in got] == [r for _, r in F11]
    bad = rows(check_kv_lines(df, keep=["i"]), "i")
    assert [i for (i,) in bad] == [i for i, (_, r) in enumerate(F11) if r]


def test_fast_path_agrees_with_json_loads(spark):
    import json
    import random
    from tessera.functions.json_check import fast_json_valid, json_valid
    from pyspark.sql import functions as F

    atoms = ['1', '-0', '01', '1.', '1.5e3', '-1E-2', '"a"', '"a\\"b"', '"\\u00e9"', '"x', 'true',
             'True', 'nul', 'null', 'NaN', '-Infinity', 'Infinity', 'inf', '[', ']', '{', '}', ',', ':',
             ' ', '\t', '\n', '\r', '\x0b', '\xa0', ' ', '﻿', 'a', '"\x01"', '[]', '{"k": 1}',
             '[1, 2]', '[1,, 2]', '[1 2]', '0x1', '+1', '.5', '٣', 'é', '{"a": 1, "b": [2]}',
             '{"k":"v","k":NaN}', '{"a" 1}', '{"a":}', '{,}', '{}', '{ }', '{"a":1,}', '"k":', '{"\\n":1}',
             '{1: 2}', "{'a': 1}"]
    rng = random.Random(11)
    texts = list(atoms) + ["".join(rng.choice(atoms) for _ in range(rng.randrange(1, 5)))
                           for _ in range(3000)]

    def py(t):
        try:
            json.loads(t)
            return True
        except ValueError:
            return False

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = df.select("i", fast_json_valid(F.col("t")).alias("fast"), json_valid(F.col("t")).alias("v")).collect()
    for r in got:
        exp = py(texts[r.i])
        assert r.v == exp, (texts[r.i], r.v, exp)
        assert r.fast is None or r.fast == exp, (texts[r.i], r.fast, exp)
    decided = sum(r.fast is not None for r in got)
    assert decided > len(got) // 3


def test_texts_that_start_like_a_literal_need_no_python(spark):
    from tessera.functions.json_check import fast_json_valid
    from pyspark.sql import functions as F
    want = {"the": False, "nothing": False, "true x": False, "true": True, " null\n": True, "NaN": True, "Infinity": True,
            "Info": False, "falsey": False, "f": False, "true,": False, "nan": False, "\x0b1": False, "\x0ctrue": False}
    df = spark.createDataFrame(list(want.items()), "t string, exp boolean")
    got = {r.t: r.fast for r in df.select("t", fast_json_valid(F.col("t")).alias("fast")).collect()}
    assert got == want


def test_long_json_texts_do_not_overflow_the_regex(spark):
    from pyspark.sql import functions as F
    from tessera.functions.json_check import json_valid
    long_list = "[" + ", ".join(str(i % 10) for i in range(50000)) + "]"
    long_obj = "{" + ", ".join(f'"k{i}": {i}' for i in range(20000)) + "}"
    bad_list = long_list[:-1]
    df = spark.createDataFrame([(1, long_list), (2, long_obj), (3, bad_list)], "i int, t string")
    got = {r.i: r.v for r in df.select("i", json_valid(F.col("t")).alias("v")).collect()}
    assert got == {1: True, 2: True, 3: False}
    lines = spark.createDataFrame([('"k"\t' + long_list,), ('"k"\t' + bad_list,)], "value string")
    assert [r.reason for r in check_kv_lines(lines).collect()] == ["bad_value"]
