"""CSV seeds, JSON lines, API pages, database tables and cursor scans."""

import datetime as dt
import functools
import json
from decimal import Decimal

import pytest
from pyspark.sql import DataFrame

from quarrymill.sources import api_pages, csv_seed, records


def test_csv_fields(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text(
        'id,amount,note\n1,10.50,hello\n\n2,20,\n3\n4,5,x,extra\n5,.5,"q ""z"", \nnl"\n6,7,""', newline=""
    )
    df = csv_seed.scan_csv_seed(spark, str(path))
    assert df.dtypes == [("id", "bigint"), ("amount", "decimal(21,2)"), ("note", "string")]
    assert rows(df) == [
        (1, Decimal("10.50"), "hello"),
        (2, Decimal("20.00"), None),
        (3, None, None),
        (4, Decimal("5.00"), "x"),
        (5, Decimal("0.50"), 'q "z", \nnl'),
        (6, Decimal("7.00"), None),
    ]


def test_csv_with_carriage_returns(spark, tmp_path, rows):
    path = tmp_path / "a.csv"
    path.write_text("id,name\r\n1,a\r\n2,b\r\n", newline="")
    assert rows(csv_seed.scan_csv_seed(spark, str(path))) == [(1, "a"), (2, "b")]


def test_csv_header_only_is_an_empty_table_of_text(spark, store, tmp_path):
    (tmp_path / "empty.csv").write_text("id,name\n")
    results = csv_seed.load_seeds(store, str(tmp_path))
    assert [r.rows for r in results] == [0]
    assert store.table("seed_empty").dtypes == [("id", "string"), ("name", "string")]


def test_csv_keeps_spaces(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,name\n1,  a b \n")
    assert csv_seed.scan_csv_seed(spark, str(path)).first()["name"] == "  a b "


def test_seed_tree(spark, store, tmp_path, rows):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "top.csv").write_text("id\n1\n")
    (tmp_path / "a" / "b" / "deep.csv").write_text("id\n2\n")
    (tmp_path / "a" / "notes.txt").write_text("no seed")
    parts = tmp_path / "a" / "many.csv"
    parts.mkdir()
    (parts / "part-0.csv").write_text("id\n3\n")
    (parts / "part-1.csv").write_text("id\n4\n")
    found = csv_seed.scan_seed_tree(spark, str(tmp_path))
    assert rows(found, "name") == [("seed_a_b_deep",), ("seed_a_many",), ("seed_top",)]
    results = csv_seed.load_seeds(store, str(tmp_path))
    assert [(r.target.rpartition(".")[2], r.rows) for r in results] == [
        ("seed_a_b_deep", 1), ("seed_a_many", 2), ("seed_top", 1),
    ]
    assert rows(store.table("seed_a_many")) == [(3,), (4,)]


def test_seeds_that_share_a_name_are_refused(store, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "b.csv").write_text("id\n1\n")
    (tmp_path / "a_b.csv").write_text("id\n2\n")
    with pytest.raises(ValueError, match="seed_a_b"):
        csv_seed.load_seeds(store, str(tmp_path))


def test_json_lines(spark, tmp_path, rows):
    path = tmp_path / "events.jsonl"
    path.write_text('{"id":"1","at":"2026-04-21 09:00:00"}\n\n{"id":"9223372036854775807"}')
    df = records.scan_jsonl(spark, str(path), {"id": "UInt64", "at": "DateTime"})
    assert df.dtypes == [("id", "bigint"), ("at", "timestamp")]
    assert rows(df.selectExpr("id", "cast(at as string)")) == [
        (1, "2026-04-21 09:00:00"), (9223372036854775807, None),
    ]


def test_json_lines_that_are_not_json_fail(spark, tmp_path):
    path = tmp_path / "events.jsonl"
    path.write_text('{"id":"1"}\n{"id"\n')
    with pytest.raises(Exception, match="MALFORMED"):
        records.scan_jsonl(spark, str(path), {"id": "UInt64"}).collect()


def _page(has_more, *items):
    return json.dumps({"object": "list", "url": "/v1/customers", "has_more": has_more, "data": list(items)})


PAGES = [
    _page(True, {"id": "a", "object": "customer", "email": "a@x", "created": 100},
          {"id": "b", "object": "customer", "email": None, "created": 200}),
    _page(False, {"id": "c", "object": "customer", "email": "c@x", "created": 300}),
]


@pytest.mark.parametrize("one_per_file", [True, False])
def test_api_pages(spark, tmp_path, one_per_file):
    for number, text in enumerate(PAGES, start=1):
        pretty = json.dumps(json.loads(text), indent=1) if one_per_file else text
        (tmp_path / f"customers_{number}.json").write_text(pretty)
    pages = api_pages.read_pages(spark, str(tmp_path), one_per_file)
    numbered = pages.withColumn("page", api_pages.page_number_in_name("file")).drop("file")
    items = api_pages.typed_records(api_pages.scan_api_pages(numbered)).orderBy("page", "position")
    assert dict(items.dtypes) == {
        "page": "bigint", "position": "int", "id": "string", "object": "string",
        "email": "string", "created": "bigint",
    }
    assert [(r["id"], r["created"]) for r in items.collect()] == [("a", 100), ("b", 200), ("c", 300)]


def test_first_page_types_fail_on_later_values(frame):
    pages = frame("page int, value string", (1, _page(True, {"v": 1})), (2, _page(False, {"v": 1.5})))
    items = api_pages.scan_api_pages(pages)
    assert dict(api_pages.typed_records(items).dtypes)["v"] == "double"
    early = api_pages.typed_records(items, first_page_only=items["page"] == 1)
    assert dict(early.dtypes)["v"] == "bigint"


def test_page_chain(frame, rows):
    pages = frame(
        "s string, page int, more boolean, n int, last string, after string",
        ("ok", 1, True, 2, "b", None), ("ok", 2, False, 1, "c", "b"),
        ("gap", 1, True, 2, "b", None), ("gap", 3, False, 1, "c", "b"),
        ("cut", 1, True, 2, "b", None),
        ("late", 1, False, 2, "b", None), ("late", 2, False, 1, "c", "b"),
        ("wrong", 5, True, 2, "b", None), ("wrong", 6, False, 1, "c", "x"),
        ("noid", 1, True, 2, None, None), ("noid", 2, False, 1, "c", None),
        ("hole", 1, True, 0, "a", None), ("hole", 2, False, 1, "c", "a"),
        ("twice", 1, False, 1, "a", None), ("twice", 1, False, 1, "a", None),
        ("ends", 1, True, 1, "a", None), ("ends", 2, True, 0, None, "a"),
    )
    found = api_pages.page_chain_audit(pages, "s", "page", "more", "n", "last", "after")
    assert rows(found) == [
        ("cut", 1, "cut off"), ("gap", 3, "gap before"), ("hole", 1, "empty"), ("late", 2, "after the end"),
        ("noid", 1, "no id"), ("twice", 1, "copied"), ("wrong", 6, "wrong cursor"),
    ]


@pytest.mark.parametrize(
    "stream, identifier, schema, expected",
    [
        ("orders", None, None, "public.orders"),
        ("sales.orders", None, None, "sales.orders"),
        ("x", "sales.orders", None, "sales.orders"),
        ("x", "orders", "sales", "sales.orders"),
        ("a.orders", None, "sales", "sales.orders"),
    ],
)
def test_table_identifier(stream, identifier, schema, expected):
    assert records.table_identifier(stream, identifier, schema) == expected


def test_partition_options():
    found = records.partition_options("id", 1, 900, 16)
    assert found == {"partitionColumn": "id", "lowerBound": "1", "upperBound": "900", "numPartitions": "16"}


class FakeReader:
    """Stands in for a JDBC reader, as there is no database here: keeps options, answers with rows."""

    def __init__(self, answer):
        self.answer, self.asked, self.opts = answer, [], {}

    def option(self, key, value):
        copy = FakeReader(self.answer)
        copy.asked, copy.opts = self.asked, self.opts | {key: value}
        return copy

    def options(self, **opts):
        copy = self
        for key, value in opts.items():
            copy = copy.option(key, value)
        return copy

    def load(self):
        self.asked.append(self.opts)
        return self.answer(self.opts)

    def jdbc(self, url, table, predicates, properties):
        self.asked.append({"table": table, "predicates": predicates})
        return self.answer({})


def test_database_scan_covers_the_whole_range(monkeypatch, spark, frame):
    orders = spark.range(1, 901).withColumnRenamed("id", "order_id")
    reader = FakeReader(lambda opts: orders.selectExpr("min(order_id)", "max(order_id)") if "query" in opts else orders)
    monkeypatch.setattr(records, "jdbc_reader", lambda *args: reader)
    assert records.scan_jdbc_full(spark, "jdbc:x", "sales.orders", "order_id", 16).count() == 900
    bounds, scan = reader.asked
    assert bounds["query"] == "select min(order_id) lo, max(order_id) hi from sales.orders"
    assert scan == {
        "dbtable": "sales.orders", "partitionColumn": "order_id", "lowerBound": "1", "upperBound": "900",
        "numPartitions": "16",
    }
    with pytest.raises(ValueError, match="partition_column"):
        records.scan_jdbc_full(spark, "jdbc:x", "orders")
    past = ("updated_at", "timestamp '2026-01-01'")
    records.scan_jdbc_full(spark, "jdbc:x", "orders", "order_id", 16, past=past)
    bounds, scan = reader.asked[-2:]
    assert bounds["query"].endswith("from public.orders where updated_at > timestamp '2026-01-01'")
    assert scan["dbtable"] == "(select * from public.orders where updated_at > timestamp '2026-01-01') past_mark"
    records.scan_jdbc_full(spark, "jdbc:x", "orders", num_partitions=1)
    assert reader.asked[-1] == {"dbtable": "public.orders"}
    halves = ["a < 5 or a is null", "a >= 5"]
    records.scan_jdbc_full(spark, "jdbc:x", "orders", predicates=halves)
    assert reader.asked[-1] == {"table": "public.orders", "predicates": halves}


def test_database_scan_of_an_empty_table(monkeypatch, spark, frame):
    empty = frame("order_id bigint")
    reader = FakeReader(lambda opts: empty.selectExpr("min(order_id)", "max(order_id)") if "query" in opts else empty)
    monkeypatch.setattr(records, "jdbc_reader", lambda *args: reader)
    assert records.scan_jdbc_full(spark, "jdbc:x", "orders", "order_id", 16).isEmpty()
    assert "numPartitions" not in reader.asked[-1]


def test_cursor_is_compared_by_type(frame, rows):
    df = frame("c bigint", (8,), (9,), (10,), (None,))
    assert rows(records.scan_cursor(df, "c", "9")) == [(10,)]
    assert rows(records.scan_cursor(df, "c", None, initial="8")) == [(10,), (9,)]
    assert records.scan_cursor(df, "c", None).count() == 4


def test_cursor_at_the_mark_and_overlap_of_numbers(frame, rows):
    df = frame("c bigint", (8,), (9,), (10,), (None,))
    assert rows(records.scan_cursor(df, "c", "9", inclusive=True)) == [(10,), (9,)]
    assert rows(records.scan_cursor(df, "c", "10", overlap=2)) == [(10,), (8,), (9,)]


def test_cursor_ties_and_late_rows(frame, rows):
    at = [dt.datetime(2026, 4, 20, hour) for hour in (9, 10, 10, 11)]
    df = frame("id int, at timestamp_ntz", *enumerate(at))
    assert rows(records.scan_cursor(df, "at", "2026-04-20 10:00:00"), "id") == [(3,)]
    assert rows(records.scan_cursor(df, "at", "2026-04-20 10:00:00", overlap="1 hour"), "id") == [(0,), (1,), (2,), (3,)]


def test_cursor_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = records.scan_cursor(events, "ts", "2024-01-15 12:00:00")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,2024-01-15T12:00" in plan


def test_rows_past_a_target(frame, rows):
    df = frame("id int, d date", *[(day, dt.date(2024, 1, day)) for day in (1, 2, 3)], (9, None))
    target = frame("d date", (dt.date(2024, 1, 2),), (None,))
    assert rows(records.scan_past_target(df, "d", target), "id") == [(3,)]
    assert rows(records.scan_past_target(df, "d", target.limit(0)), "id") == [(1,), (2,), (3,)]


def test_csv_round_trip_of_odd_text(spark, tmp_path):
    """What a CSV writer quotes comes back as it was, empty text as NULL."""
    import csv
    import random

    draw = random.Random(9)
    alphabet = ['"', ",", "\n", " ", "a", "é", "'", ";", "\\", "0", "\t"]
    written = [
        [str(i), *("".join(draw.choices(alphabet, k=draw.randrange(6))) for _ in range(2)), "end"] for i in range(400)
    ]
    path = tmp_path / "odd.csv"
    with path.open("w", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows([["id", "a", "b", "z"], *written])
    found = sorted(csv_seed.scan_csv_text(spark, str(path)).collect(), key=lambda r: int(r["id"]))
    assert [tuple(r) for r in found] == [tuple(v or None for v in row) for row in written]


def test_further_spellings_of_times(frame):
    from quarrymill.functions.scalars import epoch_or_iso_seconds

    df = frame("t string", ("Mon, 01 Jan 2024 00:00:00 GMT",), ("2024/01/01",), ("2024/01/01 00:00:01",), ("01/02/2024",), ("Mon, soon",), ("2024/13/45",), (None,))
    found = [r[0] for r in df.select(epoch_or_iso_seconds("t")).collect()]
    assert found == [1704067200, 1704067200, 1704067201, 1704153600, None, None, None]


def test_long_chains_are_ranked_in_few_rounds(spark, frame, monkeypatch):
    from quarrymill.operators import lineage

    rounds = []
    counting = lineage.Scratch.write_counting
    monkeypatch.setattr(lineage.Scratch, "write_counting", lambda self, df, mark: rounds.append(1) or counting(self, df, mark))
    chain = spark.range(3000).selectExpr("'s' AS stream", "id AS page", "if(id > 0, id - 1, NULL) AS after", "id AS last_id")
    found = api_pages.rank_pages(chain, "stream", "page", "after", "last_id")
    assert found.filter("rank = page AND head = 0 AND problem IS NULL").count() == 3000 and len(rounds) <= 13


def test_problems_of_chains_without_numbers(frame):
    pages = frame(
        "stream string, page string, after string, last_id string",
        ("a", "h", None, "1"), ("a", "x", "1", "2"), ("a", "y", "1", "3"), ("a", "z", "3", None),
        ("b", "l", "gone", "1"), ("b", "m", "1", "2"),
        ("c", "r", "2", "1"), ("c", "s", "1", "2"), ("c", "t", "2", "9"), ("c", "o", "7", "7"),
        ("d", "p", None, "1"), ("d", "q", None, "1"), ("d", "w", "1", "5"),
    )
    found = api_pages.rank_pages(pages, "stream", "page", "after", "last_id")
    assert {(r["stream"], r["page"]): (r["head"], r["rank"], r["problem"]) for r in found.collect()} == {
        ("a", "h"): ("h", 0, None), ("a", "x"): ("h", 1, "fork"), ("a", "y"): ("h", 1, "fork"), ("a", "z"): ("h", 2, None),
        ("b", "l"): ("l", 0, "lost head"), ("b", "m"): ("l", 1, None),
        ("c", "r"): (None, None, "fork"), ("c", "s"): (None, None, "cycle"), ("c", "t"): (None, None, "fork"), ("c", "o"): (None, None, "cycle"),
        ("d", "p"): ("p", 0, "shared id"), ("d", "q"): ("q", 0, "shared id"), ("d", "w"): ("p", 1, None),
    }
    assert api_pages.rank_pages(pages.limit(0), "stream", "page", "after", "last_id").count() == 0


def test_even_ranges_of_uneven_keys():
    import random

    rng = random.Random(8)
    for values in (
        [rng.randrange(100) for _ in range(5000)] + [10**12, -(10**9)],
        [int(rng.paretovariate(0.3)) for _ in range(4000)],
        [7] * 3000 + list(range(2000)),
        [5],
    ):
        queries = []

        def count(ranges, values=values, queries=queries):
            queries.append(len(ranges))
            return [sum(a <= v < b for v in values) for a, b in ranges]

        ranges = records.equi_depth_ranges(count, min(values), max(values), 16)
        assert ranges[0][0] == min(values) and ranges[-1][1] == max(values) + 1
        assert all(b == c for (_, b), (c, _) in zip(ranges, ranges[1:]))
        target = -(-len(values) // 16)
        held = [(sum(a <= v < b for v in values), b - a) for a, b in ranges]
        assert all(n <= target or width == 1 for n, width in held)
        assert len(ranges) <= 40 and max(queries) <= 64 and len(queries) < 60


def test_even_database_scan_reads_every_row_once(monkeypatch, spark, frame):
    orders = frame("id long, note string", *[(i % 50, "x") for i in range(600)], *[(10**9 + i, "y") for i in range(20)], (None, "z"))
    orders.createOrReplaceTempView("even_orders")

    class Database(FakeReader):
        """Answers count queries from a view, and reads one partition per predicate."""

        def option(self, key, value):
            copy = Database(self.answer)
            copy.opts = self.opts | {key: value}
            return copy

        def load(self):
            return spark.sql(self.opts["query"].replace("public.even_orders", "even_orders"))

        def jdbc(self, url, table, predicates, properties):
            parts = [spark.table("even_orders").filter(p).coalesce(1) for p in predicates]
            sizes.extend(part.count() for part in parts)
            return parts[0] if len(parts) == 1 else functools.reduce(DataFrame.unionByName, parts)

    sizes = []
    monkeypatch.setattr(records, "jdbc_reader", lambda *args: Database(None))
    found = records.scan_jdbc_full(spark, "jdbc:x", "even_orders", "id", 10, even=True)
    assert sorted(found.collect(), key=repr) == sorted(orders.collect(), key=repr)
    assert len(sizes) >= 8 and max(sizes) <= 2 * 621 // 10


def test_a_file_with_breaks_is_of_bounded_size(spark, monkeypatch):
    from quarrymill.plans import source_queries

    written = []
    write = source_queries._write_csv
    monkeypatch.setattr(source_queries, "_write_csv", lambda df, path: written.append(write(df, path)) or written[-1])
    monkeypatch.setattr(source_queries, "_FILE_BYTES", 4 << 20)
    sf_dir = "/root/testdata/sf0.1"
    found = source_queries.scan_csv_breaks(spark, sf_dir)
    assert found.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert spark.read.format("binaryFile").load(written[0]).count() > 1
