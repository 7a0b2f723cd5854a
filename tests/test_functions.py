import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.functions import arrays, dates, jsons, numbers, text


def one(spark, column, **values):
    fields = T.StructType([T.StructField(n, t) for n, (t, _) in values.items()])
    return spark.createDataFrame([tuple(v for _, v in values.values())], fields).select(column).first()[0]


def s(value):
    return T.StringType(), value


def i(value):
    return T.IntegerType(), value


def a(value):
    return T.ArrayType(T.StringType()), value


@pytest.mark.parametrize("value,width,want", [(7, 3, "007"), (1234, 3, "1234"), (-7, 4, "-007"), (0, 2, "00")])
def test_zero_pad(spark, value, width, want):
    assert one(spark, text.zero_pad("n", width), n=i(value)) == want


@pytest.mark.parametrize("value,want", [("ab", "abxx"), ("abcdef", "abcdef"), ("", ""), (None, None)])
def test_fill_right(spark, value, want):
    assert one(spark, text.fill_right("t", 4, "x"), t=s(value)) == want


@pytest.mark.parametrize("value,want", [("12", True), ("1a", False), ("", False), (None, False), ("1\n", False)])
def test_is_number(spark, value, want):
    assert one(spark, text.is_number("t"), t=s(value)) is want


def test_text(spark):
    assert one(spark, text.without_spaces("t"), t=s(" a\t b\n")) == "ab"
    assert one(spark, text.without_spaces("t"), t=s(None)) == ""
    assert one(spark, text.split_text("t", ","), t=s("a,b,,")) == ["a", "b"]
    assert one(spark, text.split_text("t", ","), t=s("")) is None
    assert one(spark, text.join_text("t", "-"), t=a(["a", "b"])) == "a-b"
    assert one(spark, text.has_part("t", "BC", ignore_case=True), t=s("abcd")) is True
    assert one(spark, text.has_part("t", "BC"), t=s("abcd")) is False
    assert one(spark, text.is_one_of("t", ["a", "b"]), t=s(None)) is False
    assert one(spark, text.underscored("t"), t=s("a.b.c")) == "a_b_c"
    assert one(spark, text.url_encoded("t"), t=s("a b&ü")) == "a+b%26%C3%BC"
    assert one(spark, text.recharset("t", "UTF-8", "ISO-8859-1"), t=s("é")) == "Ã©"
    found = one(spark, text.ip_addresses("t"), t=s("a 10.0.3.34 b 255.1.1.256 c 192.168.0.1"))
    assert found == ["10.0.3.34", "192.168.0.1"]


def test_digests(spark):
    import hashlib

    for name, short in (("MD5", "md5"), ("SHA-1", "sha1"), ("SHA-256", "sha256"), ("SHA-512", "sha512")):
        want = hashlib.new(short, b"abc").hexdigest()
        assert one(spark, text.digest_hex("t", name), t=s("abc")) == want.upper()
        assert one(spark, text.digest_hex("t", name, upper=False), t=s("abc")) == want


def test_arrays(spark):
    assert one(spark, arrays.is_empty("t"), t=a([])) is True
    assert one(spark, arrays.is_empty("t"), t=a(None)) is True
    assert one(spark, arrays.is_empty("t"), t=a(["x"])) is False
    assert one(spark, arrays.index_of("t", "y"), t=a(["x", "y"])) == 1
    assert one(spark, arrays.index_of("t", "z"), t=a(["x", "y"])) == -1
    assert one(spark, arrays.contains("t", "z"), t=a(None)) is False
    assert one(spark, arrays.same_elements("t", "u"), t=a(["x", "y"]), u=a(["y", "x"])) is True
    assert one(spark, arrays.same_elements("t", "u"), t=a(["x"]), u=a(["y", "x"])) is False
    assert one(spark, arrays.same_elements("t", "u"), t=a([]), u=a([])) is False


@pytest.mark.parametrize("value,want", [(2.25, "2.2"), (2.35, "2.4"), (1234567.0, "1234567.0")])
def test_formatted(spark, value, want):
    assert one(spark, numbers.formatted("x"), x=(T.DoubleType(), value)) == want


def test_hex(spark):
    assert one(spark, numbers.hex_text("n"), n=i(255)) == "FF"
    assert one(spark, numbers.hex_text("n"), n=i(-1)) == "FFFFFFFF"
    assert one(spark, numbers.hex_text("n"), n=i(None)) == ""
    assert one(spark, numbers.hex_text("b", "binary"), b=(T.BinaryType(), bytearray(b"\x01\xab"))) == "01AB"


def test_dates(spark):
    assert one(spark, dates.epoch_text("ct", dates.SECOND), ct=(T.LongType(), 1577808000999)) == "20191231160000"
    assert one(spark, dates.epoch_text("ct", positive_only=True), ct=(T.LongType(), 0)) is None
    assert one(spark, dates.shift_text("t", 1, "MONTH", "yyyyMMdd"), t=s("20240131")) == "20240229"
    assert one(spark, dates.shift_text("t", -1, "YEAR", "yyyyMMdd", "yyyy"), t=s("20240131")) == "2023"
    assert one(spark, dates.text_date("t"), t=s("no date")) is None
    stamp = "cast('{}' as timestamp)"
    def over(x, y, n, unit):
        return spark.range(1).select(F.expr(stamp.format(x)).alias("x"), F.expr(stamp.format(y)).alias("y")).select(
            dates.over_time("x", "y", n, unit)).first()[0]
    assert over("2024-01-31", "2024-03-01", 30, "DAY") is True
    assert over("2024-01-01 10:00", "2024-01-01 09:00", 1, "HOUR") is False
    assert over("2024-01-01 10:00", "2024-01-01 09:00", 0, "HOUR") is True


@pytest.mark.parametrize("card,age", [
    ("110101199006150017", 33), ("110101199006140017", 34), ("110101900614001", 34), ("11010120300101001X", 0), (None, 0), ("12", 0),
])
def test_age(spark, card, age):
    assert one(spark, dates.age_from_card("c", F.lit("2024-06-14").cast("date")), c=s(card)) == age


def test_flat_json(spark):
    schema = T.StructType([
        T.StructField("a", T.StructType([T.StructField("b", T.IntegerType()), T.StructField("c", T.StructType([T.StructField("d", T.StringType())]))])),
        T.StructField("l", T.ArrayType(T.IntegerType())),
        T.StructField("o", T.ArrayType(T.StructType([T.StructField("x", T.StringType())]))),
        T.StructField("z", T.StringType()),
    ])
    value = '{"a":{"b":1,"c":{"d":"q"}},"l":[5,6],"o":[{"x":"y"}],"z":null}'
    got = one(spark, jsons.flat_json("t", schema), t=s(value))
    assert got == {"a_b": "1", "c_d": "q", "l_0": "5", "l_1": "6", "o_0_x": "y"}
    assert one(spark, jsons.flat_json("t", schema), t=s('{"z":"only"}')) == {"z": "only"}
    assert one(spark, jsons.text_map("t"), t=s('{"a":1,"b":{"c":2}}')) == {"a": "1", "b": '{"c":2}'}
    assert one(spark, jsons.text_list("t"), t=s('["P1","P2"]')) == ["P1", "P2"]


def test_flattened_keys_that_repeat_keep_the_last(spark):
    from orderflow.functions import jsons

    schema = "a_b string, a struct<b: string>, c array<string>, c_1 string"
    kind = spark.createDataFrame([], schema).schema
    assert jsons.keys_may_repeat(kind)
    assert not jsons.keys_may_repeat(spark.createDataFrame([], "a struct<b: string>, c array<struct<d: int>>").schema)
    df = spark.createDataFrame([('{"a_b":"1","a":{"b":"2"},"c":["x","y"],"c_1":"z"}',)], "v string")
    assert df.select(jsons.flat_json("v", kind)).first()[0] == {"a_b": "2", "c_0": "x", "c_1": "z"}
