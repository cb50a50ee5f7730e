import pandas as pd
from pyspark.sql import functions as F

from vellum.operators import extract
from vellum.plans import catalog

from .conftest import SF


class Pending:
    """Stands for a DataFrame of pending jobs; gives back what its rows would be mapped with."""

    def select(self, *columns):
        return self

    def mapInPandas(self, run, schema):  # noqa: N802
        return run


def frames(extractor, n):
    jobs = pd.DataFrame({"paper_key": [str(k) for k in range(n)], "pdf_path": [f"/in/{k}.pdf" for k in range(n)], "raw_dir": ["/raw"] * n})
    return list(extract.extracted(Pending(), extractor)(iter([jobs])))


def test_results_travel_in_frames_of_many_rows():
    made = frames(lambda pdf, raw: {"markdown": pdf, "pages": 1}, 2000)
    assert len(made) == 1
    assert made[0].paper_key.tolist() == [str(k) for k in range(2000)]
    assert set(made[0].details.map(str)) == {"{'pages': '1'}"}
    large = frames(lambda pdf, raw: "x" * (extract.HELD // 3), 10)  # what is held has a bound
    assert [len(f) for f in large] == [4, 4, 2]
    assert frames(lambda pdf, raw: "", 0) == []


def test_reused_results_leave_the_rest_dealt_out(spark):
    """The few bytes that an anti-join leaves of each job aren't merged into one task that extracts them all."""
    rest = catalog.QUERIES["reuse_outputs"](spark, SF).where("not reused")
    assert rest.count() == 133
    assert rest.select(F.spark_partition_id()).distinct().count() == spark.sparkContext.defaultParallelism


def test_failures_stay_with_their_row_of_a_frame(spark):
    """Documents that fail share a frame with others, and so must not fail or empty them: results of no text type included."""
    (made,) = frames(catalog._extractor, 500)
    for k, (md, error) in enumerate(zip(made.md, made.error, strict=True)):
        bad = f"no text in {k}" if k % 11 == 0 else None if k % 13 == 0 else "an extractor returns text, a dict or None" if k % 17 == 0 else None
        assert (md, error) == (None if k % 11 == 0 or k % 13 == 0 or k % 17 == 0 else f"# {k}", bad)
    odd = {"nan": float("nan"), "number": 5, "list": ["a"], "text": "a", "none": None}
    jobs = spark.createDataFrame([(n, n, "/raw") for n in odd], "paper_key string, pdf_path string, raw_dir string").coalesce(1)
    rows = {r.paper_key: (r.md, r.error) for r in extract.extracted(jobs, lambda pdf, raw: {"markdown": odd[pdf]}).collect()}
    wrong = (None, "an extractor's markdown is text")
    assert rows == {"nan": wrong, "number": wrong, "list": wrong, "text": ("a", None), "none": (None, None)}
