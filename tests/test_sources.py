"""Readers on small files."""

from __future__ import annotations

import struct
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from millrace.functions.parsing import fields
from millrace.operators.images import as_matrix, flatten, grayscale, pixel_rows, resize
from millrace.sources.dimensions import read_counts, read_genres, read_occupations
from millrace.sources.images import read_images
from millrace.sources.lines import read_lines, read_whole_files
from millrace.sources.messages import read_messages, split_messages
from millrace.sources.ratings import numbered_lines, read_bad_ratings, read_ratings


def write(path: Path, text: str | bytes) -> str:
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(path)


def test_lines_and_whole_files(spark, tmp_path):
    write(tmp_path / "a" / "1", "x\ny\n")
    assert read_lines(spark, f"{tmp_path}/a").count() == 2
    row = read_whole_files(spark, str(tmp_path)).first()
    assert row["path"].endswith("/a/1") and row["content"] == "x\ny\n"


def test_whole_files_in_another_charset(spark, tmp_path):
    write(tmp_path / "1", "déjà vu".encode("latin-1"))
    assert read_whole_files(spark, str(tmp_path), "ISO-8859-1").first()["content"] == "déjà vu"


def test_messages(spark, tmp_path):
    write(tmp_path / "train/a/1", "From: x\nSubject: hi\n more\nLines: 1\n\nbody\n\nmore")
    write(tmp_path / "test/b/1", "From: y\nSubject: s\n\nb")
    found = {
        (r["split"], r["newsgroup"], r["msg_id"]): (r["headers"], r["body"])
        for r in read_messages(spark, str(tmp_path)).collect()
    }
    assert found == {
        ("train", "a", "1"): ({"from": "x", "subject": "hi more", "lines": "1"}, "body\n\nmore"),
        ("test", "b", "1"): ({"from": "y", "subject": "s"}, "b"),
    }


@pytest.mark.parametrize(
    "content, headers, body",
    [
        ("A: 1\nA: 2\n\nb", {"a": "1"}, "b"),
        ("A: 1\n <id@x> <y@z>\nB: 2\n\n", {"a": "1", "b": "2"}, ""),
        ("A: 1\n\t<id@x>\n more\n\nb", {"a": "1 more"}, "b"),
        ("A: x: y\n\nb: c", {"a": "x: y"}, "b: c"),
        ("A:\r\nB: 2\r\n\r\nb", {"a": "", "b": "2"}, "b"),
        ("A: 1", {"a": "1"}, ""),
    ],
)
def test_headers(spark, content, headers, body):
    row = split_messages(spark.createDataFrame([(content,)], "content string")).first()
    assert (row["headers"], row["body"]) == (headers, body)


def test_ratings(spark, tmp_path):
    path = write(tmp_path / "r", "1\t5\t3\t99\n2\t1\t4\t99\n\nbad\n1\t2\t5\t99\n")
    found = [tuple(r) for r in read_ratings(spark, path).orderBy("pos").collect()]
    assert found == [(1, 5, 3.0, 0), (2, 1, 4.0, 1), (1, 2, 5.0, 4)]
    bad = [tuple(r) for r in read_bad_ratings(spark, path).orderBy("pos").collect()]
    assert bad == [(2, "", "bad user"), (3, "bad", "bad user")]


def test_positions_over_blocks_and_files(spark, tmp_path):
    """Small blocks, so that lines of one file come from many of them."""
    expected = []
    for name, count in (("a", 700), ("b", 3), ("c", 900)):
        texts = [f"{name}{i:05}-{'x' * (i % 40)}" for i in range(count)]
        write(tmp_path / name, "\n".join(texts) + "\n")
        expected += texts
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = numbered_lines(spark, str(tmp_path))
        assert lines.rdd.getNumPartitions() > 3
        found = [tuple(r) for r in lines.orderBy("pos").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == [(text, pos) for pos, text in enumerate(expected)]


@pytest.mark.parametrize("separator", [",", "\t", "|", ".", "\\", "$"])
def test_any_separator_is_literal(spark, separator):
    frame = spark.createDataFrame([(separator.join(["a", "b", ""]),)], "value string")
    assert frame.select(fields(F.col("value"), separator)).first()[0] == ["a", "b", ""]


def test_dimension_files(spark, tmp_path):
    genres = read_genres(spark, write(tmp_path / "g", "unknown|0\nSci-Fi|1\n\n"))
    assert [tuple(r) for r in genres.collect()] == [("unknown", 0), ("Sci-Fi", 1)]
    occupations = read_occupations(spark, write(tmp_path / "o", "artist\nwriter\n"))
    assert [r[0] for r in occupations.collect()] == ["artist", "writer"]
    counts = read_counts(spark, write(tmp_path / "i", "943 users\n1682 items\n"))
    assert [tuple(r) for r in counts.collect()] == [(943, "users"), (1682, "items")]


def png(width: int, height: int, pixels: bytes) -> bytes:
    def chunk(kind: bytes, data: bytes) -> bytes:
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body))

    rows = b"".join(
        b"\0" + pixels[y * width * 3 : (y + 1) * width * 3] for y in range(height)
    )
    header = struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)
    return (
        b"\x89PNG\r\n\x1a\n"
        + chunk(b"IHDR", header)
        + chunk(b"IDAT", zlib.compress(rows))
        + chunk(b"IEND", b"")
    )


def test_image_file(spark, tmp_path):
    write(tmp_path / "faces" / "a.png", png(2, 1, bytes([10, 20, 30, 40, 50, 60])))
    write(tmp_path / "faces" / "broken.png", b"no image")
    images = read_images(spark, str(tmp_path))
    row = images.first()
    assert images.count() == 1
    assert (row["height"], row["width"], row["channels"]) == (1, 2, 3)
    assert row["pixels"] == [10, 20, 30, 40, 50, 60]
    gray = grayscale(images).first()
    assert gray["pixels"] == pytest.approx([18.15, 48.15]) and gray["channels"] == 1


def image(spark, height, width, channels, pixels):
    return spark.createDataFrame(
        [("i", height, width, channels, [float(p) for p in pixels])],
        "image_id string, height int, width int, channels int, pixels array<double>",
    )


def test_resize(spark):
    small = resize(image(spark, 4, 4, 1, range(16)), 2, 2).first()
    assert small["pixels"] == [2.5, 4.5, 10.5, 12.5]
    assert (small["height"], small["width"]) == (2, 2)


def test_resize_to_uneven_blocks(spark):
    small = resize(image(spark, 3, 5, 1, range(15)), 2, 2).first()
    assert small["pixels"] == [0.5, 3.0, 8.0, 10.5]


def test_gray_stays_gray(spark):
    assert grayscale(image(spark, 1, 2, 1, [7, 9])).first()["pixels"] == [7, 9]


def test_matrix_flatten_and_rows(spark):
    picture = image(spark, 2, 1, 3, range(6))
    row = flatten(as_matrix(picture)).first()
    assert row["matrix"] == [[[0, 1, 2]], [[3, 4, 5]]]
    assert row["features"] == [0, 1, 2, 3, 4, 5]
    found = [tuple(r) for r in pixel_rows(picture).filter(F.col("y") == 1).collect()]
    assert found == [("i", 1, 0, 0, 3.0), ("i", 1, 0, 1, 4.0), ("i", 1, 0, 2, 5.0)]
