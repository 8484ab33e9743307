import datetime

import pytest
from pyspark.sql import functions as F

from samplecraft.functions import dialect, maps
from samplecraft.functions import scalars as S
from samplecraft.operators import filters, keys, values


def one(spark, *cols):
    return list(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def sample(spark, **attrs):
    return spark.createDataFrame([(1, {k: str(v) for k, v in attrs.items()})], "id int, attrs map<string,string>")


def attrs(df):
    return [dict(r["attrs"]) for r in df.collect()]


def test_dialect(spark):
    assert dialect.java_regex(r"(?P<a>x)[[:alpha:]]") == r"(?<a>x)[\p{Alpha}]"
    assert dialect.java_regex("[[:^alpha:][:^space:]]") == r"[\P{Alpha}\S]"
    found = one(spark, F.regexp_substr(F.lit("ab12"), F.lit(dialect.java_regex("[[:^alpha:]]+"))), F.regexp_substr(F.lit("k=abc\r"), F.lit(dialect.java_regex("k=.*"))))
    assert found == ["12", "k=abc\r"]
    with pytest.raises(ValueError):
        dialect.java_regex("(?U)a+")
    assert dialect.count_groups(r"(a)(?:b)(?P<c>d)\([)(]") == 2
    assert dialect.java_replacement("${1}0-$$-$name-$7", 1) == r"$1\0-\$-${name}-"


def test_shortest(spark):
    numbers = [0.0, 1.0, 100000.0, 1e6, 12345678.0, 2026112.0, 0.0001, 0.00025, 1.234e-05, 1.5, -3.25, 1e21, 1e-7, -0.0005, 1e100]
    texts = "0 1 100000 1e+06 1.2345678e+07 2.026112e+06 0.0001 0.00025 1.234e-05 1.5 -3.25 1e+21 1e-07 -0.0005 1e+100".split()
    assert one(spark, *[S.shortest(F.lit(x)) for x in numbers]) == texts
    assert one(spark, S.fixed6(F.lit(2026112.0)), S.integral(F.lit(2.5)), S.fixed6(F.lit(None).cast("double"))) == ["2026112.000000", "2", None]


def test_as_number_is_strict(spark):
    texts = ["5", " 5", "5d", "1e3", "1e999", ".5", "5.", "-1.5", "0x1", "", "NaN", "1_0"]
    got = one(spark, *[S.as_number(F.lit(t)) for t in texts])
    assert got == [5.0, None, None, 1000.0, None, 0.5, 5.0, -1.5, None, None, None, None]
    got = one(spark, *[S.metric_value(F.lit(t)) for t in ["inf", "-inf", "NaN", "Infinity", "3"]])
    assert got == [None, float("-inf"), None, None, 3.0]
    got = one(spark, *[S.metric_value(F.lit(t), True) for t in ["+Inf", "infinity"]])
    assert got[0] == float("inf")


@pytest.mark.parametrize(
    "text,rule,expected",
    [
        ("2031-02-03T04:05:06Z", "TIMESTAMP::RFC3339", "1927857906"),
        ("2031-02-03T04:05:06.750+02:00", "TIMESTAMP::RFC3339", "1927850706"),
        ("2031-02-03", "TIMESTAMP::2006-01-02", "1927843200"),
        ("1927857906", "DATE::2006-01-02", "2031-02-03"),
        ("1927857906", "DATE::COOKIE", "Monday, 03-Feb-31 04:05:06 UTC"),
        ("Mon Feb  3 04:05:06 2031", "TIMESTAMP::ANSIC", "1927857906"),
        ("Mon, 02 Jan 78 15:04:05 Z", "TIMESTAMP::RFC822", "252601445"),
        ("soon", "TIMESTAMP::RFC3339", "soon"),
        ("1.5", "DATE::RFC3339", "1.5"),
    ],
)
def test_convert_time(spark, text, rule, expected):
    assert one(spark, S.convert_time(F.lit(text), rule)) == [expected]


def test_relative_time(spark):
    base = F.lit(datetime.datetime(2024, 3, 1, 0, 0, 30, 500000)).cast("timestamp")
    got = one(
        spark,
        S.relative_time("ms", base=base),
        S.relative_time("ns", -10, "s", base),
        S.relative_time("datetime", -1, "m", base),
        S.relative_time("day", -1, "hour", base),
        S.relative_time("nonsense", base=base),
        S.fill_relative_times("from=${timestamp:s-10s}&to=${timestamp:dateutc}", base),
    )
    assert got == ["1709251230500", "1709251220500000000", "2024-02-29T23:59:30", "29", "1709251230500", "from=1709251220&to=2024-03-01"]


def test_formula(spark):
    df = sample(spark, **{"net.a": 4, "net.b": 3, "s": "x"})
    out = values.compute(df, {"d": "${net.a} - ${net.b}", "bad": "${s} + 1", "t": "${d} >= 1 || ${net.b} < 0", "z": "1 / 0"})
    assert attrs(out) == [{"net.a": "4", "net.b": "3", "s": "x", "d": "1", "t": "true"}]
    for text in ("__import__('os')", "${a} if 1 else 2", "1 < 2 < 3", "${a} +"):
        with pytest.raises(ValueError):
            values.compute(df, {"x": text})


def test_value_functions(spark):
    df = sample(spark, bed0="rows=4411,weeds=72,snails=0,a=b=c", load="0.7, 12.25, 8", p="77%", t="12.5µs")
    out = values.sub_parse(df, [{"type": "prefix", "key": "bed", "split_by": [",", "="]}])
    out = values.map_values(out, {f"load=>load{i}": [f"(.+), (.+), (.+)=>${i}"] for i in (1, 2, 3)})
    out = values.micros_to_millis(values.strip_percent(out))
    got = attrs(out)[0]
    assert got["bed0.rows"] == "4411" and got["bed0.snails"] == "0" and "bed0.a" not in got
    assert [got["load1"], got["load2"], got["load3"]] == ["0.7", "12.25", "8"]
    assert got["p"] == "77" and got["t.ms"] == "0.0125" and "t" not in got


def test_camel_key(spark):
    df = sample(spark, garden_gate_left=1, **{"rain_Barrel.fill_mark": 2, "Xy": 3})
    assert sorted(attrs(keys.snake_to_camel(df))[0]) == ["gardenGateLeft", "rainBarrel.fillMark", "xy"]
    for name in ("garden_gate_left", "rain_Barrel.fill_mark", "Xy"):
        assert keys.camel_name(name) in attrs(keys.snake_to_camel(df))[0]


def test_filters(spark):
    df = spark.createDataFrame(
        [(1, {"boat": "ketch", "berth": "x"}), (2, {"boat": "yawl", "berth": "y", "crew": None})],
        "id int, attrs map<string,string>",
    )
    ids = lambda out: sorted(r["id"] for r in out.collect())
    both = [{"boat": "ketch"}, {"berth": "y"}]
    assert ids(filters.filter_samples(df, exclude=[{"boat": "ketch"}])) == [2]
    assert ids(filters.filter_samples(df, include=[{"bo.*": "k.t"}])) == [1]
    assert ids(filters.filter_samples(df, match_all=both)) == []
    assert ids(filters.filter_samples(df, match_all=both, compat="last")) == [2]
    # a null value matches nothing, and removes nothing
    assert ids(filters.filter_samples(df, exclude=[{".*": "none such"}])) == [1, 2]
    assert ids(filters.drop_events(df, [{"key": "crew", "value": "a"}])) == [1, 2]


def test_planes_agree(spark):
    df = spark.createDataFrame([(1, "a", "8.5"), (2, "b", "9")], "id int, some_key string, Val string")
    mapped = maps.to_map(df, ["some_key", "Val"])
    mapped = filters.filter_samples(keys.snake_to_camel(mapped), exclude=[{"val": "^9"}])
    wide = keys.rekey_columns(df, keys.camel_name, only=["some_key", "Val"])
    wide = filters.filter_columns(wide, exclude=[{"val": "^9"}], only=["someKey", "val"])
    again = maps.to_wide(mapped, ["someKey", "val"])
    assert again.collect() == wide.collect()
    assert wide.count() == 1


def test_add_attribute_needs_a_filled_key(spark):
    out = keys.add_attributes(sample(spark, a=1), {"x": "v${a}-${b}", "y": "${b}", "z": "plain"})
    assert attrs(out) == [{"a": "1", "x": "v1-${b}"}]
