"""Delimited files: faults, options, charsets, numbering over many splits, and what the sinks write."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from martloom import schemas
from martloom.sinks.delimited import write_delimited, write_delimited_by_key, write_single_file
from martloom.sources.delimited import DelimitedFormat, scan_delimited, scan_with_rejects, schema_from_file

HEADED = DelimitedFormat(header=True)


@pytest.fixture
def small():
    from pyspark.sql.types import IntegerType, StringType, StructField

    return StructType(
        [StructField("id", IntegerType(), False), StructField("name", StringType(), False), StructField("age", IntegerType())]
    )


def put(path, data):
    mode = "wb" if isinstance(data, bytes) else "w"
    with open(path, mode) as f:
        f.write(data)
    return str(path)


LINES = '1,"a, ""b""",5\nx,"c",6\n3,"d"\n4,"e",7,8\n,"f",9\n6,,\n7,"g",y\n'


def test_rows_that_do_not_fit_are_dropped_whatever_is_selected(spark, tmp_path, small):
    path = put(tmp_path / "a.csv", LINES)
    df = scan_delimited(spark, path, small)
    assert sorted(map(tuple, df.collect())) == [(1, 'a, "b"', 5), (6, "", None)]
    assert df.count() == 2
    assert df.select("name").count() == 2
    assert len(df.select("name").collect()) == 2


def test_fail_mode_stops(spark, tmp_path, small):
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        scan_delimited(spark, put(tmp_path / "a.csv", LINES), small, rejects="fail").collect()
    with pytest.raises(Exception, match="required column"):
        scan_delimited(spark, put(tmp_path / "b.csv", ',"a",1\n'), small, rejects="fail").collect()
    good = scan_delimited(spark, put(tmp_path / "c.csv", '1,"a",1\n'), small, rejects="fail")
    assert [tuple(r) for r in good.collect()] == [(1, "a", 1)]


def test_rejects_carry_the_record_and_the_reason(spark, tmp_path, small):
    good, bad = scan_with_rejects(spark, put(tmp_path / "a.csv", LINES), small, reason="why")
    assert good.count() == 2
    assert {(r["raw_record"], r["why"]) for r in bad.collect()} == {
        ('x,"c",6', "column id is not int"),
        ('3,"d"', "record does not have 3 columns"),
        ('4,"e",7,8', "record does not have 3 columns"),
        (',"f",9', "column id is empty"),
        ('7,"g",y', "column age is not int"),
    }
    assert good.count() + bad.count() == 7


def test_header_read_without_the_flag_is_one_rejected_row(spark, tmp_path, small):
    path = put(tmp_path / "a.csv", 'id,name,age\n1,"a",5\n')
    assert scan_delimited(spark, path, small).count() == 1
    _, bad = scan_with_rejects(spark, path, small)
    assert bad.count() == 1
    assert scan_delimited(spark, path, small, HEADED).count() == 1


def test_empty_and_missing_files(spark, tmp_path, small):
    there = put(tmp_path / "a.csv", '1,"a",5\n')
    empty = put(tmp_path / "empty.csv", "")
    absent = str(tmp_path / "absent.csv")
    assert scan_delimited(spark, empty, small).count() == 0
    assert scan_delimited(spark, [there, absent], small, missing="skip").count() == 1
    assert scan_delimited(spark, [absent], small, missing="skip", record_number="n").count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        scan_delimited(spark, [there, absent], small).count()


@pytest.mark.parametrize("charset", ["utf-8-sig", "utf-16"])
def test_byte_order_mark_is_stripped(spark, tmp_path, small, charset):
    path = put(tmp_path / "a.csv", '1,"é",5\n2,"b",6\n'.encode(charset))
    layout = DelimitedFormat(charset="UTF-16" if charset == "utf-16" else "UTF-8")
    assert sorted(map(tuple, scan_delimited(spark, path, small, layout).collect())) == [(1, "é", 5), (2, "b", 6)]


def test_code_page_bytes_both_ways(spark, tmp_path, small):
    layout = DelimitedFormat(charset="windows-1252")
    text = "€ Š é ÿ “x”"
    read = scan_delimited(spark, put(tmp_path / "a.csv", f'1,"{text}",5\n'.encode("cp1252")), small, layout)
    assert read.first()["name"] == text
    write_delimited(read, str(tmp_path / "out"), layout)
    written = b"".join(open(p, "rb").read() for p in glob.glob(str(tmp_path / "out/part-*")))
    assert written.decode("cp1252") == f'1,"{text}",5\n'


def test_record_numbers_over_many_splits(spark, tmp_path):
    schema = StructType.fromDDL("n INT, pad STRING")
    for name, rows in (("a", 40_000), ("b", 7), ("c", 15_000)):
        put(tmp_path / f"{name}.csv", "n,pad\n" + "".join(f'{i},"{"p" * (i % 50)}"\n' for i in range(1, rows + 1)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = scan_delimited(
            spark, str(tmp_path / "*.csv"), schema, HEADED, source_name="source", record_number="record"
        )
        assert df.rdd.getNumPartitions() > 10
        assert df.filter("record <> n").count() == 0 and df.count() == 55_007
        first = scan_delimited(spark, str(tmp_path / "*.csv"), schema, HEADED, source_name="source", first_rows=9)
        assert sorted(r["count"] for r in first.groupBy("source").count().collect()) == [7, 9, 9]
        assert first.agg(F.max("n")).first()[0] == 9
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_schema_file_in_both_forms(spark, tmp_path):
    json_form = put(tmp_path / "s.json", schemas.PRODUCT_DIM.json())
    ddl_form = put(tmp_path / "s.ddl", "a INT, b STRING")
    assert schema_from_file(spark, json_form) == schemas.PRODUCT_DIM
    assert schema_from_file(spark, ddl_form).names == ["a", "b"]


def test_written_text_is_quoted_and_numbers_are_not(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c', None), (2, "", 5), (3, None, 6)], "id INT, name STRING, age INT")
    write_delimited(df.coalesce(1), str(tmp_path / "out"), HEADED)
    (part,) = glob.glob(str(tmp_path / "out/part-*"))
    assert open(part).read() == 'id,name,age\n1,"a ""b"", c",\n2,"",5\n3,,6\n'


def test_write_modes(spark, tmp_path, small):
    df = spark.createDataFrame([(1, "a", 1)], "id INT, name STRING, age INT")
    path = str(tmp_path / "out")
    write_delimited(df, path, HEADED, mode="create")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS|already exists"):
        write_delimited(df, path, HEADED, mode="create")
    write_delimited(df, path, HEADED, mode="append")
    assert scan_delimited(spark, path, small, HEADED).count() == 2
    write_delimited(df, path, HEADED)
    assert scan_delimited(spark, path, small, HEADED).count() == 1


def test_file_size_limit_holds_for_every_file(spark, tmp_path, small):
    df = spark.range(0, 20_000, 1, 2).select(
        F.col("id").cast("int"), F.repeat(F.lit("x"), (F.col("id") % 40).cast("int")).alias("name"), F.lit(1).alias("age")
    )
    write_delimited(df, str(tmp_path / "out"), DelimitedFormat(), max_file_mb=0.05)
    sizes = [os.path.getsize(p) for p in glob.glob(str(tmp_path / "out/part-*"))]
    assert len(sizes) > 4 and max(sizes) <= 0.05 * 1024 * 1024
    assert scan_delimited(spark, str(tmp_path / "out"), small).count() == 20_000


def test_single_file(spark, tmp_path):
    df = spark.range(0, 1000, 1, 8)
    write_single_file(df, str(tmp_path / "one"))
    assert len(glob.glob(str(tmp_path / "one/part-*"))) == 1
    assert spark.read.csv(str(tmp_path / "one"), header=True).count() == 1000


ODD_TEXTS = [
    "plain", "line\nbreak", "carriage\r\nreturn", 'quote " and ""', "comma, semicolon;", "\u0001\u0002\u0000\u001a", "\u001an", "", None,
    "\\n \\", " blanks ", "\t", "#comment", "€ é 😀", '"', '",', "x\u001a",
]


@pytest.mark.parametrize("charset", ["utf8", "UTF-16LE", "utf_16_be"])
@pytest.mark.parametrize("separator", [",", "|", "\t"])
def test_any_text_survives_a_round_trip(spark, tmp_path, charset, separator):
    schema = StructType.fromDDL("id INT NOT NULL, name STRING, age INT, note STRING")
    rows = [(k, t, None if k % 2 else k, ODD_TEXTS[-1 - k]) for k, t in enumerate(ODD_TEXTS)]
    layout = DelimitedFormat(header=True, charset=charset, separator=separator, line_breaks="escape")
    write_delimited(spark.createDataFrame(rows, schema), str(tmp_path / "out"), layout)
    assert sorted(map(tuple, scan_delimited(spark, str(tmp_path / "out"), schema, layout).collect())) == sorted(rows)


def test_wide_characters_in_a_named_byte_order_are_read_in_splits(spark, tmp_path):
    schema = StructType.fromDDL("n INT, pad STRING")
    path = put(tmp_path / "a.csv", "".join(f'{i},"é{"p" * (i % 50)}"\n' for i in range(20_000)).encode("utf-16-le"))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    try:
        df = scan_delimited(spark, path, schema, DelimitedFormat(charset="utf-16le"))
        assert df.rdd.getNumPartitions() > 5
        assert df.count() == 20_000 and df.agg(F.sum("n")).first()[0] == 19_999 * 10_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("alias", ["utf8", "U8", "latin1", "ISO_8859-1", "windows-1252", "CP1252", "koi8_r", "ascii"])
def test_charset_aliases(spark, tmp_path, small, alias):
    text = "plain" if alias == "ascii" else "Ж" if alias == "koi8_r" else "é"
    path = put(tmp_path / "a.csv", f'1,"{text}",5\n'.encode(alias))
    assert scan_delimited(spark, path, small, DelimitedFormat(charset=alias)).first()["name"] == text


@pytest.mark.parametrize("name", ["shift_jis", "utf-32le", "gb2312", "no-such-set", "ebcdic-cp-us"])
def test_other_charsets_are_refused(spark, tmp_path, small, name):
    with pytest.raises(ValueError, match="character set"):
        scan_delimited(spark, put(tmp_path / "a.csv", '1,"a",5\n'), small, DelimitedFormat(charset=name))


def test_schema_file_must_be_one(spark, tmp_path):
    put(tmp_path / "a.ddl", "a INT")
    put(tmp_path / "empty.ddl", " ")
    assert schema_from_file(spark, str(tmp_path / "*.ddl")).names == ["a"]
    put(tmp_path / "b.ddl", "b INT")
    with pytest.raises(ValueError, match="several"):
        schema_from_file(spark, str(tmp_path / "*.ddl"))
    with pytest.raises(ValueError, match="none"):
        schema_from_file(spark, str(tmp_path / "empty.ddl"))


def test_hot_key_is_cut_into_several_sorted_files(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 20)).alias("k"),
        F.col("id").cast("int").alias("v"),
    )
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "32k")
    try:
        write_delimited_by_key(df, str(tmp_path / "out"), ["k"], HEADED, key_in_data=False, order_by=[F.col("v")])
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    hot = glob.glob(str(tmp_path / "out/by_k=hot/part-*"))
    assert len(hot) > 1
    total = 0
    for part in hot:
        values = [int(line) for line in open(part).read().split()[1:]]
        assert values == sorted(values)
        total += len(values)
    assert total == 20_000


def test_line_breaks_are_refused_unless_the_layout_has_a_way(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "line\nbreak")], "id INT, name STRING")
    with pytest.raises(Exception, match="line break"):
        write_delimited(rows, str(tmp_path / "out"))
    with pytest.raises(ValueError, match="line_breaks"):
        DelimitedFormat(line_breaks="drop")


@pytest.mark.parametrize("separator", [",", "|"])
def test_line_breaks_in_standard_quotes(spark, tmp_path, separator):
    schema = StructType.fromDDL("id INT NOT NULL, name STRING, age INT, note STRING")
    texts = [t for t in ODD_TEXTS if t is None or not set(t) & {"\u0000", "\u0001"}]
    texts = [t and t.replace("\r\n", "\n") for t in texts]
    rows = [(k, t, None if k % 2 else k, texts[-1 - k]) for k, t in enumerate(texts)]
    layout = DelimitedFormat(header=True, separator=separator, line_breaks="quote")
    write_delimited(spark.createDataFrame(rows, schema).coalesce(1), str(tmp_path / "out"), layout)
    assert sorted(map(tuple, scan_delimited(spark, str(tmp_path / "out"), schema, layout).collect())) == sorted(rows)
    (part,) = glob.glob(str(tmp_path / "out/part-*"))
    import csv

    with open(part, newline="") as f:
        read = list(csv.reader(f, delimiter=separator))
    assert [r[1] for r in read[1:]] == [t or "" for _, t, _, _ in rows]


def test_foreign_control_characters_are_read_as_they_are(spark, tmp_path, small):
    texts = ["a\u001an b", "\u001a0", "\u0002", "end\u001a", "a\u0001b"]
    path = put(tmp_path / "a.csv", "".join(f'{k},"{t}",5\n' for k, t in enumerate(texts)))
    for df in (scan_delimited(spark, path, small), scan_with_rejects(spark, path, small)[0]):
        assert [r["name"] for r in sorted(df.collect())] == texts


def test_rejected_lines_are_the_files_own(spark, tmp_path):
    schema = StructType.fromDDL("id INT NOT NULL, name STRING, day DATE")
    layout = DelimitedFormat(header=True, date_format="dd/MM/yyyy")
    bad = [' 1 ,"a ""x"" b",31/12/2020', ',"f", ', '2,"g",2020-12-31', '3,"h",31/12/2020,', '4', '"5"x,"y\\",01/01/2021', ',"a\u0001b",01/01/2021']
    good = ['6,"i",31/12/2020', '7,"",', '8,plain \\ text,01/02/2021']
    path = put(tmp_path / "a.csv", "id,name,day\n" + "\n".join(x for pair in zip(bad, [*good, *good[:1] * 4]) for x in pair) + "\n")
    kept, rejected = scan_with_rejects(spark, path, schema, layout, reason="why")
    assert sorted(r["raw_record"] for r in rejected.collect()) == sorted(bad)
    plain = sorted(map(tuple, scan_delimited(spark, path, schema, layout).collect()), key=repr)
    assert sorted(map(tuple, kept.collect()), key=repr) == plain and len(plain) == 7
    why = {r["raw_record"]: r["why"] for r in rejected.collect()}
    assert why['2,"g",2020-12-31'] == "column day is not date"
    assert why[',"f", '] in ("column id is empty", "column day is not date")
    assert why['4'] == "record does not have 3 columns"
