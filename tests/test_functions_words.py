"""Scalar functions, word splitting, literal rows, top-1 golden, sinks."""

import glob
import os

from pyspark.sql import functions as F

from shopflow.functions import dates as fd
from shopflow.functions import strings as fs
from shopflow.plans import words
from shopflow.sources.store import read_csv, replace_table, write_csv


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).collect()[0].x


def test_java_split_rules(spark):
    df = spark.createDataFrame([("a  b  ",), ("",), ("   ",)], "line string")
    got = [r.t for r in df.select(fs.java_split_space("line").alias("t")).collect()]
    assert got == [["a", "", "b"], [""], []]
    batch = {r.word: r["count"] for r in words.word_count(df).collect()}
    assert batch == {"a": 1, "b": 1, "": 2}
    stream_form = {r.word: r["count"] for r in words.word_count(df, keep_empty=False).collect()}
    assert stream_form == {"a": 1, "b": 1}


def test_text_file_lines(spark, tmp_dir):
    p = os.path.join(tmp_dir, "hello.txt")
    with open(p, "w") as f:
        f.write("to be or\nnot to be\n")
    got = {r.word: r["count"] for r in words.word_count(words.text_file_lines(spark, p)).collect()}
    assert got == {"to": 2, "be": 2, "or": 1, "not": 1}


def test_row_number_golden(spark):
    # The seven literal rows of the reference's row-number demo.
    items = ["1,hadoop,12", "5,spark,16", "8,storm,18", "8,flume,20", "8,hive,10", "8,sparkstream,26",
             "10,tensorflow,26"]
    rows = words.delimited_rows(spark.createDataFrame([(x,) for x in items], "value string"),
                                "id STRING, name STRING, age INT")
    assert dict(rows.dtypes) == {"id": "string", "name": "string", "age": "int"}
    got = sorted(tuple(r) for r in words.top1_per_key(rows).collect())
    assert got == [("1", "hadoop", 12), ("10", "tensorflow", 26), ("5", "spark", 16), ("8", "sparkstream", 26)]


def test_date_functions(spark):
    assert one(spark, fd.seconds_between(F.lit("2024-01-05 10:00:03"), F.lit("2024-01-05 9:59:58"))) == 5
    assert one(spark, fd.time_before(F.lit("2024-01-05 9:00:00"), F.lit("2024-01-05 10:00:00"))) is True
    assert one(spark, fd.time_after(F.lit("2024-01-05 9:00:00"), F.lit("2024-01-05 10:00:00"))) is False
    assert one(spark, fd.date_hour(F.lit("2024-01-05 5:03:04"))) == "2024-01-05_05"
    assert one(spark, fd.parse_time(F.lit("not a time"))) is None
    ts = fd.epoch_millis_to_ts(F.lit(1704412800000 + 3_723_000))
    assert one(spark, fd.format_time_minute(ts)) == "202401050102"
    assert one(spark, fd.format_date_key(ts)) == "20240105"
    assert str(one(spark, fd.parse_date_key(F.lit("20240105")))) == "2024-01-05"
    assert one(spark, fd.today()) == one(spark, F.date_format(F.current_date(), "yyyy-MM-dd"))
    assert one(spark, fd.yesterday()) < one(spark, fd.today())


def test_string_functions(spark):
    assert one(spark, fs.trim_comma(F.lit(",a,b,"))) == "a,b"
    assert one(spark, fs.trim_comma(F.lit("a,b"))) == "a,b"
    assert one(spark, fs.pad_two(F.lit("7"))) == "07"
    assert one(spark, fs.is_empty(F.lit(None).cast("string"))) is True
    assert one(spark, fs.kv_get(F.lit("a=1|b=|c=3"), "b")) is None
    assert one(spark, fs.kv_get(F.lit("a=1|b=|c=3"), "c")) == "3"
    assert one(spark, fs.kv_get(F.lit("a=1"), "z")) is None
    assert one(spark, fs.kv_set(F.lit("b=2|a=1"), "b", "9")) == "a=1|b=9"
    # longer text is not cut, repeated keys do not fail, NULL text is NULL
    assert one(spark, fs.pad_two(F.lit("123"))) == "123" and one(spark, fs.pad_two(F.lit("12"))) == "12"
    assert one(spark, fs.kv_get(F.lit("a=1|a=2"), "a")) == "1"
    assert one(spark, fs.kv_get(F.lit("a=|a=2=|b.=3"), "a")) == "2" and one(spark, fs.kv_get(F.lit("bx=3"), "b.")) is None
    assert one(spark, fs.kv_get(F.lit(None).cast("string"), "a")) is None
    assert one(spark, fs.kv_set(F.lit("b=1|b=2|a=1|a=5"), "a", "9")) == "a=9|b=2"
    assert one(spark, fs.concat_long_string(F.lit(3), F.lit(None).cast("string"), ";")) is None
    assert one(spark, fs.concat_long_string(F.lit(3), F.lit("广州"), ";")) == "3;广州"
    assert one(spark, F.round(F.lit(0.285), 2)) == 0.29 and one(spark, F.round(F.lit(1.005), 2)) == 1.01


def test_csv_keeps_text_and_replace_table(spark, tmp_dir):
    texts = ["\tb", "b", "", None, " x ", 'q"uo"te', "a,b", "back\\slash\\", "cr\rx", "'", "#c", "NULL", '""', "\\"]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "word string, count long").repartition(3)
    out = os.path.join(tmp_dir, "wc")
    for single in (True, False):
        write_csv(df, out, single_file=single)
        assert (len(glob.glob(os.path.join(out, "part-*.csv"))) == 1) == single
        assert sorted(read_csv(spark, out, df.schema).collect(), key=lambda r: r[1]) == sorted(df.collect(), key=lambda r: r[1])
    replace_table(df, "wc_table")
    replace_table(df.where("count = 1"), "wc_table")
    assert spark.table("wc_table").count() == 1
