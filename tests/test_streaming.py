import os
import tempfile

from conftest import rows
from tessera.operators import text
from tessera.streaming import read_text_stream


def test_word_count_on_a_file_stream(spark):
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(d, "in")
    os.makedirs(src)
    for i, body in enumerate([" a  bbb \t  bbb cc   ddd\n", "cc bbb ddd\nddd\n"]):
        with open(os.path.join(src, f"part{i}.txt"), "w") as f:
            f.write(body)
    q = (text.word_count(read_text_stream(spark, src, max_files_per_trigger=1))
         .writeStream.outputMode("complete").format("memory").queryName("wc_stream")
         .option("checkpointLocation", os.path.join(d, "ckpt")).start())
    try:
        q.processAllAvailable()
        assert rows(spark.sql("SELECT * FROM wc_stream")) == [("a", 1), ("bbb", 3), ("cc", 2), ("ddd", 3)]
    finally:
        q.stop()


def test_kv_check_on_arriving_trace_files(spark):
    from tessera.operators.quality import check_kv_lines
    d = tempfile.mkdtemp(prefix="tessera-stream-")
    src = os.path.join(d, "in")
    os.makedirs(src)
    with open(os.path.join(src, "mapper0_out.txt"), "w") as f:
        f.write('"a"\t1\nbad line\n"b"\t[1, 2]\n')
    q = (check_kv_lines(read_text_stream(spark, src, with_path=True), keep=["file_path"])
         .writeStream.outputMode("append").format("memory").queryName("kv_stream")
         .option("checkpointLocation", os.path.join(d, "ckpt")).start())
    try:
        q.processAllAvailable()
        with open(os.path.join(src, "reducer0_in.txt"), "w") as f:
            f.write('"c"\t{"x": 1}\n"d"\t1\t2\n')
        q.processAllAvailable()
        got = sorted((os.path.basename(r.file_path), r.line, r.reason)
                     for r in spark.sql("SELECT * FROM kv_stream").collect())
        assert got == [("mapper0_out.txt", "bad line", "no_tab"),
                       ("reducer0_in.txt", '"d"\t1\t2', "extra_tab")]
    finally:
        q.stop()
