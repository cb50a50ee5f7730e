import hashlib

import pytest
from pyspark.sql import functions as F

from vellum.errors import InputParseError
from vellum.functions import paths
from vellum.sources import files


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v"))).first()[0]


@pytest.mark.parametrize(("name", "suffix", "stem"), [("a.tar.pdf", ".pdf", "a.tar"), (".pdf", "", ".pdf"), (".d.pdf", ".pdf", ".d"), ("A.PDF", ".PDF", "A"), ("a.pdf.txt", ".txt", "a.pdf"), ("a", "", "a")])
def test_suffix_and_stem(spark, name, suffix, stem):
    assert one(spark, f"/x.y/{name}", paths.suffix) == suffix
    assert one(spark, f"/x.y/{name}", paths.stem) == stem


@pytest.mark.parametrize(("value", "safe"), [("  a b  ", "a_b"), ("é", "unknown"), ("..", "unknown"), ("a//b", "a_b"), ("_x_", "x"), ("\ta　b\n", "a_b"), ("a." * 100, ("a." * 100)[:180])])
def test_sanitized(spark, value, safe):
    assert one(spark, value, paths.sanitized) == safe


def test_key(spark):
    p = "/data/pdfs/paper.pdf"
    assert one(spark, p, paths.paper_key) == "ocr__paper__ac6d45490541e1c5" == f"ocr__paper__{hashlib.sha1(p.encode()).hexdigest()[:16]}"


def test_long_stems_collide(spark):
    a, b = (one(spark, one(spark, f"/{d}/{'s' * 175}.pdf", paths.paper_key), paths.sanitized) for d in "ab")
    assert a == b


def test_folder(tmp_path, spark):
    for n in ("B.PDF", "a.pdf", "_c.pdf", ".d.pdf", "e.txt"):
        (tmp_path / n).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub/f.pdf").write_bytes(b"x")
    (tmp_path / "dir.pdf").mkdir()
    found = files.resolve_inputs(tmp_path)
    assert [p.rpartition("/")[2] for p in found] == [".d.pdf", "B.PDF", "_c.pdf", "a.pdf"]
    assert [r.label for r in files.jobs(spark, found).orderBy("ord").collect()] == [".d", "B", "_c", "a"]
    assert files.resolve_inputs(tmp_path / "a.pdf") == [str(tmp_path / "a.pdf")]
    for bad in (tmp_path / "none", tmp_path / "e.txt", tmp_path / "dir.pdf"):
        with pytest.raises(InputParseError):
            files.resolve_inputs(bad)


def test_markdown_files(tmp_path, spark):
    (tmp_path / "good.md").write_bytes(b"\xef\xbb\xbfa\r\nb")
    (tmp_path / "bad.md").write_bytes(b"\xff\xfe")
    rows = {r.path.rpartition("/")[2]: r for r in files.read_markdown(spark, str(tmp_path)).collect()}
    assert rows["good.md"].md == "﻿a\nb"
    assert rows["good.md"].error is None
    assert rows["bad.md"].md is None
    assert rows["bad.md"].error


def test_images(tmp_path, spark):
    (tmp_path / "x.webp").write_bytes(bytes(range(200)))
    r = files.read_images(spark, str(tmp_path)).first()
    import base64

    assert r.data_url == "data:image/webp;base64," + base64.b64encode(bytes(range(200))).decode()
