"""Archives bounded in bytes."""

import glob
import os

from oddsframe.llm import warc
from oddsframe.llm.common import ship_package


def test_files_keep_to_their_bytes_and_a_larger_page_stands_alone(spark, tmp_path):
    ship_package(spark)
    rows = [(i, f"http://h/{i}", "x" * (i * 37 % 3000)) for i in range(300)] + [(1000, "http://h/big", "é" * 90_000 + "WARC/1.1\r\n" * 5),
                                                                                (1001, None, None), (None, "http://h/n", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path, records_per_file=64, file_bytes=40_000)
    sizes = sorted(os.path.getsize(f) for f in glob.glob(f"{path}/**/part-*", recursive=True))
    assert len(sizes) > 8 and sizes[-2] <= 40_000 < 180_000 < sizes[-1]   # the big page's file holds nothing else
    got = warc.read_archives(spark, path).collect()
    assert len(got) == len(rows) and all(r.intact for r in got if r.record_type == "response")
    assert {r.page_id: r.payload_bytes for r in got} == {i: len((h or "").encode()) for i, _, h in rows}
    big = [r for r in got if r.page_id == 1000]
    assert sum(r.file == big[0].file for r in got) == 1


def test_empty_table_writes_and_reads(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(none, str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
