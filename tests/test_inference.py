"""Type inference and casts on the small cases that pin the rules down."""

from decimal import Decimal

import pytest

from quarrymill.functions import types
from quarrymill.functions.inference import (
    infer_csv_types,
    infer_json_types,
    stringify_nested,
    type_csv,
    type_json,
)


@pytest.mark.parametrize(
    "values, expected",
    [
        (["1", "2", "-3"], "bigint"),
        (["1", "2.5", "3"], "numeric"),
        (["99999999999999999999"], "numeric"),
        (["9223372036854775807", "-9223372036854775808"], "bigint"),
        (["9223372036854775808"], "numeric"),
        (["true", "False", "TRUE"], "boolean"),
        (["2024-01-01", "2024-12-31"], "date"),
        (["2024-01-01T12:00:00Z", "2024-06-01 00:00:00"], "timestamptz"),
        (["2024-01-01", "2024-01-02T00:00:00Z"], "timestamptz"),
        (["1", "abc"], "text"),
        (["true", "1"], "text"),
        (["2024-01-01", "1"], "text"),
        ([None, None], "text"),
        ([None, "7"], "bigint"),
        (["1e5"], "text"),
        (["+1"], "text"),
        ([" 1"], "text"),
        (["1\n"], "text"),
        (["5.", ".5"], "numeric"),
        (["."], "text"),
        (["2024-99-99"], "date"),
    ],
)
def test_csv_classes(frame, values, expected):
    found = infer_csv_types(frame("v string", *[(v,) for v in values]))
    assert found["v"].partition("(")[0] == expected


def test_csv_values(frame):
    text = frame(
        "b string, d string, t string, n string",
        ("TRUE", "2024-02-29", "2024-01-01T12:00+0530", "-.5"),
        ("false", None, "2024-01-01", "12345678901234567890"),
    )
    found = [tuple(r) for r in type_csv(text).selectExpr("b", "cast(d as string)", "cast(t as string)", "n").collect()]
    assert found == [
        (True, "2024-02-29", "2024-01-01 06:30:00", Decimal("-0.5")),
        (False, None, "2024-01-01 00:00:00", Decimal("12345678901234567890.0")),
    ]


def test_csv_shape_decides_and_bad_dates_fail(frame):
    with pytest.raises(Exception, match="2024-99-99"):
        type_csv(frame("v string", ("2024-99-99",))).collect()


def test_too_many_digits_is_an_error(frame):
    with pytest.raises(ValueError, match="digits"):
        infer_csv_types(frame("v string", ("9" * 30 + ".5",), ("0." + "1" * 20,)))


def test_json_widening(frame):
    docs = frame(
        "doc string",
        ('{"amount": 1000, "livemode": true, "metadata": {"k": "v"}, "n": null, "x": 1.0}',),
        ('{"amount": 99.5, "livemode": false, "metadata": {"z": [1, 2], "a": 1}, "n": null, "x": 2}',),
    )
    found = infer_json_types(docs, "doc")
    assert found == {
        "amount": "double precision",
        "livemode": "boolean",
        "metadata": "jsonb",
        "n": "text",
        "x": "bigint",
    }
    typed = type_json(docs, "doc", found)
    assert [r["amount"] for r in typed.collect()] == [1000.0, 99.5]
    assert [r["x"] for r in typed.collect()] == [1, 2]
    assert [r["metadata"] for r in typed.collect()] == ['{"k":"v"}', '{"z":[1,2],"a":1}']
    assert stringify_nested(docs, "doc", found).columns == ["metadata"]


@pytest.mark.parametrize(
    "values, expected",
    [
        (["true", "1"], "bigint"),
        (['"a"', '{"b": 1}'], "jsonb"),
        (["[1]"], "jsonb"),
        (["1e20"], "bigint"),
        (["null", "null"], "text"),
        (["1", '"a"'], "text"),
        (["0.5", "null"], "double precision"),
    ],
)
def test_json_classes(frame, values, expected):
    docs = frame("doc string", *[(f'{{"v": {v}}}',) for v in values])
    assert infer_json_types(docs, "doc") == {"v": expected}


def test_json_value_that_does_not_fit_fails(frame):
    docs = frame("doc string", ('{"v": true}',), ('{"v": 1}',))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        type_json(docs, "doc", infer_json_types(docs, "doc")).collect()


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("integer", "integer"),
        ("NUMERIC", "numeric"),
        ("timestamp without time zone", "timestamp"),
        ("timestamp with time zone", "timestamptz"),
        ("character varying", "text"),
        ("USER-DEFINED", "text"),
        ("ARRAY", "text"),
        ("interval", "text"),
        ("bytea", "text"),
        ("jsonb", "jsonb"),
        ("uuid", "uuid"),
    ],
)
def test_postgres_types(declared, expected):
    assert types.postgres_type(declared) == expected


@pytest.mark.parametrize(
    "declared, expected",
    [
        ("UInt64", "bigint"),
        ("UInt32", "bigint"),
        ("UInt16", "integer"),
        ("Int64", "bigint"),
        ("Int128", "text"),
        ("Nullable(Int8)", "integer"),
        ("LowCardinality(Nullable(String))", "text"),
        ("SimpleAggregateFunction(sum, UInt64)", "text"),
        ("Decimal(10, 2)", "numeric(10,2)"),
        ("Decimal64(3)", "numeric(18,3)"),
        ("DateTime", "timestamptz"),
        ("DateTime64(3, 'UTC')", "timestamptz"),
        ("Date32", "date"),
        ("FixedString(4)", "text"),
        ("Enum8('a' = 1)", "text"),
        ("UUID", "uuid"),
        ("Array(UInt8)", "text"),
        ("Map(String, UInt8)", "text"),
        ("Float32", "real"),
    ],
)
def test_clickhouse_types(declared, expected):
    assert types.clickhouse_type(declared) == expected


def test_wide_uint64_is_opt_in(frame):
    text = frame("v string", ("18446744073709551615",))
    with pytest.raises(Exception, match="CAST"):
        types.apply_clickhouse_types(text, {"v": "UInt64"}).collect()
    kept = types.apply_clickhouse_types(text, {"v": "Nullable(UInt64)"}, wide_uint64=True)
    assert kept.first()["v"] == Decimal("18446744073709551615")


def test_uuid_is_lower_case_and_undeclared_is_text(frame):
    df = types.apply_pg_types(frame("u string, n int", ("ABC-1", 5)), {"u": "uuid"})
    assert df.first() == ("abc-1", "5")


def test_a_scale_is_never_rounded_away(frame):
    from quarrymill.operators.upsert import align

    target = frame("n decimal(20,2)")
    assert align(frame("n decimal(10,4)", (Decimal("1.2500"),)), target, "t").first()["n"] == Decimal("1.25")
    with pytest.raises(Exception, match="cannot keep all decimals"):
        align(frame("n decimal(10,4)", (Decimal("1.2525"),)), target, "t").collect()
    with pytest.raises(Exception, match="cannot keep all decimals"):
        align(frame("n string", ("1.255",)), target, "t").collect()


def test_nested_values_and_times_as_text(spark):
    row = spark.sql("select array(1, 2) a, named_struct('k', 1) s, timestamp'2024-01-01 00:00:00' t, "
                    "timestamp'2024-01-01 00:00:00.000001' u")  # fmt: skip
    assert types.apply_types(row, {"a": "jsonb"}).first() == (
        "[1,2]", '{"k":1}', "2024-01-01T00:00:00.000Z", "2024-01-01T00:00:00.000001Z",
    )


def test_odd_names(frame):
    text = frame("`a.b` string, `c``d` string", ("1", "x"))
    assert type_csv(text).dtypes == [("a.b", "bigint"), ("c`d", "string")]
    docs = frame("doc string", ('{"a.b": 1, "c`d": "x", "e f": [1]}',))
    assert type_json(docs, "doc", infer_json_types(docs, "doc")).collect() == [(1, "x", "[1]")]


def test_the_last_of_two_equal_json_keys_counts(frame):
    docs = frame("doc string", ('{"a": 1, "a": "x"}',))
    found = infer_json_types(docs, "doc")
    assert found == {"a": "text"} and type_json(docs, "doc", found).collect() == [("x",)]


def test_objects_keyed_by_data_keep_the_named_keys(spark):
    docs = spark.range(6000).selectExpr("concat('{\"k', id, '\": 1, \"name\": \"x\"}') as doc")
    assert infer_json_types(docs, "doc", keep=["name"]) == {"name": "text"}
    assert len(infer_json_types(docs, "doc")) == 6001


def _class_in_python(value):
    import re

    if value.lower() in ("true", "false"):
        return "boolean"
    if re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", value):
        return "date"
    clock = r"[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]+)?)?"
    if re.fullmatch(rf"[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}[T ]{clock}(Z|[+-][0-9]{{2}}:?[0-9]{{2}})?", value):
        return "timestamptz"
    if re.fullmatch(r"-?[0-9]+", value):
        return "bigint" if -(2**63) <= int(value) < 2**63 else "numeric"
    return "numeric" if re.fullmatch(r"-?([0-9]+\.[0-9]*|\.[0-9]+)", value) else "text"


def test_csv_classes_agree_with_brute_force(spark):
    """Many columns of odd values at once; also shows that wide tables are one pass."""
    import random

    draw = random.Random(3)
    pieces = [
        "true", "FALSE", "tru", "t", "2024-01-31", "2024-1-31", "2024-01-31T10:00", "2024-01-31 10:00:00.5+01:00",
        "2024-01-31T10:00Z", "2024-01-31T10", "0", "-1", "007", "-0", "--1", "1-1", "12-45", "1234-", "-", ".", "-.", "5.",
        ".5", "-1.50", "1.2.3", "1e5", "9223372036854775807", "9223372036854775808", "-9223372036854775808",
        "-9223372036854775809", "00009223372036854775807", "12345678901234567890", " 1", "1 ", "1\n", "é", "１", "abc",
        "2024-01-31\n", "NaN", "+1", "1,5", "0x1", "-2024-01-31",
    ]
    columns = {}
    for i in range(250):
        chosen = draw.sample(pieces, draw.choice([1, 1, 2, 2, 3]))
        columns[f"c{i}"] = [draw.choice([*chosen, None]) for _ in range(4)]
    for i, value in enumerate(pieces):
        columns[f"only{i}"] = [value] * 4

    def settled(values):
        seen = {_class_in_python(v) for v in values if v is not None}
        if len(seen) == 1:
            return seen.pop()
        return {frozenset({"bigint", "numeric"}): "numeric", frozenset({"date", "timestamptz"}): "timestamptz"}.get(
            frozenset(seen), "text"
        )

    schema = ", ".join(f"{name} string" for name in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema)
    found = {name: kind.partition("(")[0] for name, kind in infer_csv_types(df).items()}
    assert found == {name: settled(values) for name, values in columns.items()}


def test_sizes_of_decimals_do_not_depend_on_the_batch(store, frame, rows):
    """A second load may have more decimals than the first; none is rounded."""
    from decimal import Decimal

    from quarrymill.sinks.store import typed_create, write_append

    for name, declared, kind in [("a", "numeric", "decimal(38,18)"), ("b", "Decimal(18, 2)", "decimal(18,2)")]:
        apply = types.apply_pg_types if name == "a" else types.apply_clickhouse_types
        for text in ("10", "10.25"):
            write_append(store, name, apply(frame("n string", (text,)), {"n": declared}))
        assert store.table(name).dtypes == [("n", kind)]
        assert rows(store.table(name)) == [(Decimal(10),), (Decimal("10.25"),)]
    with pytest.raises(Exception, match="cannot keep all decimals"):
        types.apply_clickhouse_types(frame("n string", ("1.005",)), {"n": "Decimal(18, 2)"}).collect()
    typed_create(store, "t", {"n": "numeric"})
    assert store.table("t").dtypes == [("n", "decimal(38,18)")]
