"""Line numbers that are the file's own, however it is split."""

import gzip
import os
import random

import pytest

from keyfold.sources.text import FILE, read_numbered_lines


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("lines")
    r = random.Random(4)
    want = {}
    for name, n, width in (("a.txt", 3000, 40), ("b.txt", 1, 5), ("c.txt", 0, 0), ("d.txt", 700, 900)):
        lines = [r.choice(["same", "", "é" * r.randint(0, width), "x" * r.randint(0, width)]) for _ in range(n)]
        # A last line without an end counts, as it does for the reader.
        (folder / name).write_text("\n".join(lines) + ("\n" if name == "a.txt" and lines else ""), encoding="utf-8")
        want[name] = [x for x in lines] if not (name != "a.txt" and lines and lines[-1] == "") else lines[:-1]
    lines = [f"line {i}" for i in range(500)]
    with gzip.open(folder / "e.txt.gz", "wt") as f:
        f.write("\n".join(lines) + "\n")
    want["e.txt.gz"] = lines
    return str(folder), want


@pytest.mark.parametrize("split", [1000, 20_000, 1 << 27])
def test_numbers_are_the_files(spark, files, split):
    folder, want = files
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    try:
        got = {}
        for x in read_numbered_lines(spark, folder).collect():
            got.setdefault(os.path.basename(x[FILE]), []).append((x.line, x.value))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {n: sorted(x) for n, x in got.items()} == {n: list(enumerate(x, 1)) for n, x in want.items() if x}


def test_no_lines(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    assert read_numbered_lines(spark, str(tmp_path)).collect() == []
