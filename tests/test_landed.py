"""The data source for landed pages, in batch and as a stream."""

import pytest
from pyspark.errors import StreamingQueryException

from quarrymill.sinks import store as sinks
from quarrymill.sources.landed import PagesStreamReader, page_of, read_landed
from quarrymill.streaming.file_load import land_stream


def _land(folder, *pages):
    folder.mkdir(exist_ok=True)
    for page in pages:
        (folder / f"page-{page:04d}.json").write_text(f'{{"data": ["{page}"]}}\n')


def test_numbers_in_names():
    assert page_of("/a/page=12/part-00000-77.c000.txt") == 12
    assert page_of("/a/customers-0007.json") == 7 and page_of("page3.json") == 3
    assert page_of("/a/_SUCCESS") is None and page_of("/a/.page-1.crc") is None and page_of("/a/readme.txt") is None


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_batch_reads_every_page_in_partitions(spark, tmp_path, scheme):
    _land(tmp_path / "p", *range(10))
    (tmp_path / "p" / "_SUCCESS").write_text("")
    found = read_landed(spark, f"{scheme}{tmp_path}/p", pagesPerPartition=3)
    assert found.columns == ["page", "file", "value"] and found.rdd.getNumPartitions() == 4
    assert sorted((r.page, r.value) for r in found.collect()) == [(n, f'{{"data": ["{n}"]}}') for n in range(10)]
    assert read_landed(spark, str(tmp_path / "none")).collect() == []


def test_offsets_wait_for_missing_pages(tmp_path):
    reader = PagesStreamReader({"path": str(tmp_path / "p"), "firstPage": "1"})
    assert reader.latestOffset() == reader.initialOffset() == {"next": 1}
    _land(tmp_path / "p", 1, 2, 4)
    assert reader.latestOffset() == {"next": 3}
    _land(tmp_path / "p", 3)
    assert reader.latestOffset() == {"next": 5}
    dealt = reader.partitions({"next": 2}, {"next": 5})
    assert [page for part in dealt for page, _ in part.files] == [2, 3, 4]
    assert reader.partitions({"next": 5}, {"next": 5}) == []
    with pytest.raises(ValueError, match="page 0"):
        reader.partitions({"next": 0}, {"next": 5})


def test_a_stream_goes_on_from_its_checkpoint(spark, store, tmp_path):
    def run():
        pages = read_landed(spark, str(tmp_path / "p"), stream=True)
        land_stream(store, "pages", pages, str(tmp_path / "checkpoint")).awaitTermination()
        return sorted(r.page for r in store.table("pages").collect())

    _land(tmp_path / "p", 0, 1, 3)
    assert run() == [0, 1]
    assert run() == [0, 1]
    _land(tmp_path / "p", 2)
    assert run() == [0, 1, 2, 3]
    (tmp_path / "p" / "page-0000.json").unlink()  # what has landed is not read again
    _land(tmp_path / "p", 4)
    assert run() == [0, 1, 2, 3, 4]
    assert len(store.versions("pages")) <= sinks.FOLDED_PARTS
    _land(tmp_path / "p", 6)
    for page in range(1, 5):
        (tmp_path / "p" / f"page-{page:04d}.json").unlink()
    with pytest.raises(StreamingQueryException, match="page 5"):
        run()
