"""Source records that do not fit their schema, and large JSON arrays read in splits."""

import json
import random

import pytest
from pyspark.sql import types as T

from siltstone.sources.files import read_json
from siltstone.sources.json_arrays import read_json_array, read_json_objects, scan_json_array
from siltstone.sources.rejects import check_rejects, reject_counts, scan_delimited, scan_json

SCHEMA = T.StructType(
    [
        T.StructField("Item ID", T.IntegerType()),
        T.StructField("Name.of it", T.StringType()),
        T.StructField("Price", T.DoubleType()),
    ]
)


def _folder(tmp_path, **files):
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    return str(tmp_path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_delimited_records_are_good_or_have_a_reason(spark, tmp_path):
    text = (
        'Item ID,Name.of it,Price\n1,"a ""b"", c",2.5\n2,x\n3,y,abc\n,z,1\n5,a,b,1\n6,,\n\n   \n"7","q",1e3\n8,"un,1\n'
        "9,,NaN\n10,x,\n1.5,x,1\n"
    )
    scan = scan_delimited(spark, _folder(tmp_path, a=text, b='"Item ID","Name.of it","Price"\n11,é,-1\n'), SCHEMA, escape='"', required=["Item ID"])
    good = [(1, 'a "b", c', 2.5), (6, None, None), (7, "q", 1000.0), (10, "x", None), (11, "é", -1.0)]
    found = [r for r in _rows(scan.good) if r[0] != 9]
    assert found == sorted(good, key=str) and scan.good.columns == SCHEMA.names
    assert _rows(scan.rejects) == sorted(
        [
            ("2,x", "short line"), ("3,y,abc", "bad Price"), (",z,1", "missing Item ID"), ("5,a,b,1", "long line"),
            ('8,"un,1', "short line"), ("1.5,x,1", "bad Item ID"),
        ],
        key=str,
    )


@pytest.mark.parametrize("line, good", [(r'1,"a \"b\", c",2', True), ('1,"a ""b"", c",2', False), ('1,a "b c,2', True)])
def test_escapes_decide_where_a_quoted_field_ends(spark, tmp_path, line, good):
    scan = scan_delimited(spark, _folder(tmp_path, a=f"Item ID,Name.of it,Price\n{line}\n"), SCHEMA)
    assert (scan.good.count(), scan.rejects.count()) == ((1, 0) if good else (0, 1))


def test_other_delimiters(spark, tmp_path):
    scan = scan_delimited(spark, _folder(tmp_path, a='Item ID|Name.of it|Price\n1|"a|b"|2\n2|a|b|2\n'), SCHEMA, delimiter="|")
    assert _rows(scan.good) == [(1, "a|b", 2.0)] and _rows(scan.rejects) == [("2|a|b|2", "long line")]


def test_files_without_records(spark, tmp_path):
    scan = scan_delimited(spark, _folder(tmp_path, a="Item ID,Name.of it,Price\n", b=""), SCHEMA)
    assert scan.good.collect() == [] and scan.rejects.collect() == []
    check_rejects(scan.rejects, {})


def test_json_records_are_good_or_have_a_reason(spark, tmp_path):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType())])
    text = '{"id":1,"t":"x"}\n{"id":"q"}\nnope\n{"t":"y"}\n{"id":2\n{"id":3,"t":4}\n[1]\n{"id":1.5}\n{"id":null}\n\n{"ID":5}\n'
    scan = scan_json(spark, _folder(tmp_path, a=text), schema, required=["id"])
    assert _rows(scan.good) == [(1, "x"), (3, "4")]
    assert _rows(scan.rejects) == sorted(
        [
            ('{"id":"q"}', "bad id"), ("nope", "no object"), ('{"t":"y"}', "missing id"), ('{"id":2', "no object"),
            ("[1]", "no object"), ('{"id":1.5}', "bad id"), ('{"id":null}', "missing id"), ('{"ID":5}', "missing id"),
        ],
        key=str,
    )


def test_rejects_are_held_against_limits(spark):
    rejects = spark.createDataFrame([("a", "short line"), ("b", "short line"), ("c", "bad Price")], "raw string, reason string")
    counts = reject_counts(rejects, {"short line": 2})
    assert _rows(counts) == [("bad Price", 1, 0, False), ("short line", 2, 2, True)]
    check_rejects(rejects, {"short line": 2, "bad Price": 1})
    with pytest.raises(ValueError, match="^1 records of 'Product' rejected: bad Price \\(limit 0\\)$"):
        check_rejects(rejects, {"short line": 2}, "Product")


# --- arrays ---------------------------------------------------------------------------

ARRAY = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.StringType()), T.StructField("x", T.DoubleType())])


def _objects(count):
    chosen = random.Random(count)
    text = lambda: "".join(chosen.choice('ab{}[]"\\,: \né日\t') for _ in range(chosen.randint(0, 12)))
    return [{"id": i, "t": text(), "x": i / 2, "n": {text(): text(), "l": [{"q": text()}, []]}} for i in range(count)]


@pytest.mark.parametrize("indent", [None, 1])
def test_one_array_in_many_splits_reads_like_one_document(spark, conf, tmp_path, indent):
    objects = _objects(1500)
    folder = _folder(
        tmp_path,
        a=json.dumps(objects, indent=indent, ensure_ascii=False), b=json.dumps(objects[:7]), c="[]", d='{"id":5000,"t":"}{"}', e="",
    )
    expected = _rows(read_json(spark, folder, ARRAY))
    conf(**{"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "0"})
    raw = spark.read.option("lineSep", "}").text(folder)
    assert raw.selectExpr("_metadata.file_block_start AS b").distinct().count() > 20
    assert _rows(read_json_array(spark, folder, ARRAY)) == expected
    whole = sorted(json.dumps(json.loads(r.record), sort_keys=True) for r in read_json_objects(spark, folder).collect())
    assert whole == sorted(json.dumps(o, sort_keys=True) for o in [*objects, *objects[:7], {"id": 5000, "t": "}{"}])


def test_ill_typed_and_unfinished_objects_of_an_array(spark, tmp_path):
    folder = _folder(tmp_path, a='[{"id": 1, "x": "many"},\n {"id": 2, "x": 2},\n {"t": "z"}, {"id": 3, "t": "cut')
    scan = scan_json_array(spark, folder, ARRAY, required=["id"])
    assert _rows(scan.good) == [(2, None, 2.0)]
    assert _rows(scan.rejects) == [('{"id": 1, "x": "many"}', "bad x"), ('{"t": "z"}', "missing id")]
