"""A file for each page: few folders, one attempt's files, scans of some folders at a time."""
import os

import pytest

from tidemark.plans import catalog_more
from tidemark.session import dataset_tag, local_path, work_path
from tidemark.sources import ingest

PAGES = [(i, "é" * i) for i in range(100)] + [(7, "a\nb"), (200, None), (-5, ""), (None, "abc")]
LENGTHS = {**{i: 2 * i + 1 for i in range(100)}, 7: 2 * 7 + 1 + 4, 200: 1, -5: 1, None: 4}


@pytest.fixture
def groups(monkeypatch):
    """Small folders; the lists of folders that are scanned."""
    seen = []

    def files(spark, path, *a, of=ingest.binary_files, **b):
        seen.append(path)
        return of(spark, path, *a, **b)

    monkeypatch.setattr(ingest, "FOLDER_FILES", 8)
    monkeypatch.setattr(ingest, "SCANNED_FOLDERS", 3)
    monkeypatch.setattr(ingest, "binary_files", files)
    return seen


def scanned(spark, path):
    rows = catalog_more.binary_file_scan(spark, path).collect()
    assert len(rows) == len(LENGTHS)
    return {r.page_id: r.length for r in rows}


def test_pages_share_folders_which_are_scanned_in_groups(spark, fresh, groups):
    spark.createDataFrame(PAGES, "page_id long, html string").write.parquet(f"{fresh}/pages.parquet")
    assert scanned(spark, fresh) == LENGTHS
    parts = len(PAGES) // 8 + 1
    at = local_path(spark, work_path(spark, "landing", dataset_tag(spark, fresh), "pages"))
    assert {d for d in os.listdir(at) if not d.startswith((".", "_"))} == {f"part={i}" for i in range(parts)}
    names = [f for d, _, fs in os.walk(at) for f in fs if d != at]
    assert len(names) == len(LENGTHS) and all(f.startswith("page_id=") and f.endswith(".txt") for f in names)
    assert sum(map(len, groups)) == parts and {len(x) for x in groups} <= {1, 2, 3}  # the driver knows the files of three folders at most
    assert scanned(spark, fresh) == LENGTHS and sum(map(len, groups)) == 2 * parts  # scanned anew, not read from the last run


def test_pages_in_a_store_that_is_not_local(spark, fresh, groups, monkeypatch):
    spark.createDataFrame(PAGES, "page_id long, html string").write.parquet(f"{fresh}/pages.parquet")
    monkeypatch.setattr(ingest, "local_path", lambda spark, path: None)
    assert scanned(spark, fresh) == LENGTHS
    assert len(groups) > 1


def test_no_pages(spark, fresh):
    spark.createDataFrame([], "page_id long, html string").write.parquet(f"{fresh}/pages.parquet")
    assert catalog_more.binary_file_scan(spark, fresh).collect() == []


def test_the_first_attempt_that_ends_counts(spark, tmp_path):
    write = ingest.file_writer(str(tmp_path))

    def broken():
        yield "k=1", b"x"
        raise ValueError("lost")

    with pytest.raises(ValueError, match="lost"):
        write(broken(), 0, 1)
    assert not (tmp_path / "part=0").exists()
    write([("k=1", b"a"), ("k=1", None), ("k=2", b"b")], 0, 2)
    write([("k=1", b"other")], 0, 3)
    assert {f.name: f.read_bytes() for f in (tmp_path / "part=0").iterdir()} == {"k=1.txt": b"a\n\n", "k=2.txt": b"b\n"}
    files = ingest.binary_files(spark, str(tmp_path), "*.txt").select("path", "length").collect()
    assert sorted((r.path.rsplit("/", 1)[1], r.length) for r in files) == [("k=1.txt", 3), ("k=2.txt", 2)]  # a lost attempt's files are not seen
