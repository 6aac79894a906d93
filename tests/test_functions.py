import base64

import pytest
from pyspark.sql import functions as F

from pageloom.functions.ids import edge_id, sink_key, split_key, title_from_id, title_key, vertex_id
from pageloom.functions.strings import (
    base64_utf8,
    iso_timestamp,
    java_trim,
    strip_fragment,
    unescape_newlines,
)


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(column.alias("r")).first().r


def test_strings(spark):
    x = F.col("x")
    assert one(spark, java_trim(x), x=" \t\x01a b\n ") == "a b"
    assert one(spark, java_trim(x), x=" a ") == " a "
    assert one(spark, strip_fragment(x), x="Gamma#Sec#2") == "Gamma"
    assert one(spark, strip_fragment(x), x="#local") == "#local"
    assert one(spark, unescape_newlines(x), x="a\\nb") == "a\nb"
    long = "é" * 200
    assert one(spark, base64_utf8(x), x=long) == base64.b64encode(long.encode()).decode()
    assert str(one(spark, iso_timestamp(x), x="2014-01-02T03:04:05Z")) == "2014-01-02 03:04:05"
    assert one(spark, iso_timestamp(x), x="2014-13-02T03:04:05Z") is None
    assert one(spark, iso_timestamp(x), x="bad") is None


def test_ids(spark):
    t = F.col("t")
    assert one(spark, vertex_id(t), t=" Foo bar\n") == "PAGE_Foo bar"
    assert one(spark, title_from_id(vertex_id(t)), t=" Foo ") == "Foo"
    assert one(spark, edge_id(F.lit("PAGE_A_B"), F.lit("PAGE_C")), t="") == "PAGE_LINK_A_B_C"
    expected = base64.b64encode("äb".encode()).decode()
    assert one(spark, title_key(t), t=" ÄB ") == "pageloom.import#" + expected
    key = sink_key(F.lit("edges"), t)
    assert one(spark, key, t="k") == "edges\u001f" + base64.b64encode(b"k").decode()
    assert one(spark, split_key(key), t="k") == "edges"
    with pytest.raises(Exception, match="invalid sink key"):
        one(spark, split_key(t), t="no separator")
