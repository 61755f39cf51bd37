"""CSV files with line breaks inside fields: what many tasks read equals what one reads."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarrymill.sources.csv_seed import scan_csv_seed, scan_csv_text
from quarrymill.sources.csv_splits import _lines, inside_after, line_maps, scan_records, split_states


@pytest.fixture
def small_splits(conf):
    conf(spark__sql__files__maxPartitionBytes="300", spark__sql__files__openCostInBytes="1")


def _cell(rng):
    text = "".join(rng.choice('ab ,"\n\r"é') for _ in range(rng.randint(0, 12)))
    if rng.random() < 0.5:
        return '"' + text.replace('"', '""') + '"'
    return re.sub(r"[,\n\r]", "", text).lstrip('"')


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode())
    return str(path)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_splits_read_what_one_task_reads(spark, small_splits, tmp_path, seed):
    rng = random.Random(seed)
    body = "\n".join(",".join(_cell(rng) for _ in range(rng.randint(1, 4))) for _ in range(400))
    path = _write(tmp_path / "x.csv", "a,b,c\n" + body + rng.choice(["", "\n"]))
    split = scan_csv_text(spark, path, split=True)
    assert split.columns == ["a", "b", "c"]
    assert len(split_states(_lines(spark, path))) > 10
    assert _rows(split) == _rows(scan_csv_text(spark, path, split=False))


def test_a_field_over_many_splits(spark, small_splits, tmp_path):
    long = "\n".join(f"line {i}, of one field" for i in range(200))
    path = _write(tmp_path / "x.csv", f'a,"b\nc"\n1,"{long}"\n2,"x\n\ny"\n"open,\n' + "rest\n" * 100 + "end")
    split = scan_csv_text(spark, path, split=True)
    assert split.columns == ["a", "b\nc"]
    assert _rows(split) == _rows(scan_csv_text(spark, path, split=False))
    assert ("1", long) in _rows(split)
    states = split_states(_lines(spark, path))
    assert sum(inside for inside, _ in states.values()) > 10


def test_carriage_returns_and_several_files(spark, small_splits, tmp_path):
    for k in range(3):
        lines = [f'{k},"first\r\nsecond {i}"\r\n' for i in range(60)]
        _write(tmp_path / "seed.csv" / f"part-{k}.csv", "id,note\r\n" + "".join(lines) + "\r\n")
    path = str(tmp_path / "seed.csv")
    split = scan_csv_text(spark, path, split=True)
    assert _rows(split) == _rows(scan_csv_text(spark, path, split=False))
    assert split.count() == 180 and split.filter(F.col("note").contains("first\nsecond")).count() == 180
    mixed = _write(tmp_path / "mixed.csv", 'id,note\n1,"a\r\nb"\n2,c\r\n3,d\n' * 30)
    assert _rows(scan_csv_text(spark, mixed, split=True)) == _rows(scan_csv_text(spark, mixed, split=False))


def test_header_only_and_no_records(spark, tmp_path):
    for text in ("a,b\n", "a,b"):
        path = _write(tmp_path / f"{len(text)}.csv", text)
        assert scan_csv_text(spark, path, split=True).collect() == []
        assert scan_records(spark, path).collect() == [(True, "a,b")]


def test_size_decides_by_default(spark, conf, tmp_path):
    path = _write(tmp_path / "x.csv", "a,b\n" + '1,"x\ny"\n' * 100)
    plan = lambda: scan_csv_text(spark, path)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan()
    conf(spark__sql__files__maxPartitionBytes="300b")
    assert "MapInArrow" in plan()
    assert [str(f.dataType) for f in scan_csv_seed(spark, path).schema] == ["LongType()", "StringType()"]


def test_line_maps_equal_a_state_machine():
    def ends_inside(line, inside):
        at, field = 0, not inside
        while True:
            if not inside:
                if line[at : at + 1] != '"':  # an unquoted field, up to a comma
                    comma = line.find(",", at)
                    if comma < 0:
                        return False
                    at = comma + 1
                    continue
                at, inside = at + 1, True
            quote = line.find('"', at)
            if quote < 0:
                return True
            if line[quote + 1 : quote + 2] == '"':
                at = quote + 2
                continue
            comma = line.find(",", quote + 1)
            if comma < 0:
                return False
            at, inside = comma + 1, False

    rng = random.Random(7)
    lines = ["".join(rng.choice('a,"" ') for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    opens, stays = line_maps(pa.array(lines))
    for line, one, other in zip(lines, opens, stays):
        assert (one, other) == (ends_inside(line, False), ends_inside(line, True)), line
    for begin in (False, True):
        inside, expected = begin, []
        for one, other in zip(opens, stays):
            inside = bool(other if inside else one)
            expected.append(inside)
        assert inside_after(opens, stays, begin).tolist() == expected
    assert inside_after(np.zeros(0, bool), np.zeros(0, bool), True).tolist() == []
