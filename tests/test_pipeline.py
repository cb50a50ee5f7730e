from dataclasses import replace

import pytest

from vellum import cli
from vellum.config import Config, Output, load, resolve, validate
from vellum.errors import ConfigurationError
from vellum.operators import caption as captioning
from vellum.operators import extract
from vellum.plans import pipeline
from vellum.sources import files
from vellum.streaming import intake


@pytest.fixture
def pdfs(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for n in ("a", "b", "c"):
        (folder / f"{n}.pdf").write_bytes(b"%PDF")
    return folder


def extractor(calls):
    def extract(pdf, raw):
        from pathlib import Path

        with open(calls, "a") as f:
            f.write(pdf + "\n")
        if pdf.endswith("b.pdf"):
            raise RuntimeError("no text here")
        (Path(raw) / "images").mkdir(parents=True, exist_ok=True)
        (Path(raw) / "images/1.png").write_bytes(b"png")
        return {"markdown": "# T\n\n![x](images/1.png) ![y](images/none.png)\n", "pages": 3}

    return extract


def captioned(config):
    return replace(config, captioning=replace(config.captioning, enabled=True), apis=replace(config.apis, api_key="k", base_url="u"))


def test_run_resume_and_captions(spark, tmp_path, pdfs):
    calls = tmp_path / "calls"
    config = Config(output=Output(root_dir=str(tmp_path / "out")))
    run = lambda c, cap=None: pipeline.ocr(pdfs, config=c, spark=spark, extractor=extractor(str(calls)), captioner=cap)
    first = run(config)
    assert [(r.label, r.success, r.status) for r in first] == [("a", True, "completed"), ("b", False, "failed_extraction"), ("c", True, "completed")]
    assert first[1].error == "no text here"
    assert first[1].markdown_path is None
    assert open(first[0].effective_markdown).read().startswith("# T")
    assert len(calls.read_text().split()) == 3
    run(config)
    assert [x.rpartition("/")[2] for x in calls.read_text().split()[3:]] == ["b.pdf"]  # only what failed runs again

    second = run(captioned(config), lambda path: f"seen {path.rpartition('/')[2]}")
    assert open(second[0].captioned_path).read() == "# T\n\n![seen 1.png](images/1.png) ![y](images/none.png)\n"
    assert second[0].effective_markdown == second[0].captioned_path
    third = run(config)  # without captions: no captioned path
    assert third[0].captioned_path is None
    p = pipeline.Pipeline(spark, captioned(config), extractor(str(calls)), lambda path: 1 / 0)
    rows = p.run(files.jobs(spark, files.resolve_inputs(pdfs))).collect()  # used again, so no captioner is called
    assert rows[0].captioned_path
    assert rows[0].captioning_stats == {"images_found": 0, "images_captioned": 0, "images_skipped": 0}
    m = {r.paper_key: r for r in p.manifests(files.jobs(spark, files.resolve_inputs(pdfs)).select("paper_key", "pdf_path")).collect()}
    assert sorted(r.batch_status for r in m.values()) == ["failed", "succeeded", "succeeded"]
    assert pipeline.summary(p.run(files.jobs(spark, files.resolve_inputs(pdfs)))).first()["exit_code"] == 1


def test_failing_captioner_skips(spark, tmp_path, pdfs):
    config = captioned(Config(output=Output(root_dir=str(tmp_path / "out"))))
    p = pipeline.Pipeline(spark, config, extractor(str(tmp_path / "calls")), lambda path: 1 / 0)
    rows = p.run(files.jobs(spark, files.resolve_inputs(pdfs / "a.pdf"))).collect()
    assert rows[0].success
    assert rows[0].captioning_stats == {"images_found": 2, "images_captioned": 0, "images_skipped": 2}


def test_files_that_cannot_be_written_fail_their_document(spark, tmp_path, pdfs):
    """A folder in a file's place: that document's extraction fails, or its manifest's pipeline; the rest is written and logged."""
    out = tmp_path / "out"
    config = captioned(Config(output=Output(root_dir=str(out))))
    p = pipeline.Pipeline(spark, config, lambda pdf, raw: "text", lambda path: "x")
    jobs = files.jobs(spark, files.resolve_inputs(pdfs))
    key = {r.label: r.paper_key for r in jobs.collect()}
    (out / "markdown" / f"{key['a']}.md").mkdir(parents=True)
    (out / "manifests" / f"{key['b']}.json").mkdir(parents=True)
    rows = {r.label: r for r in p.run(jobs).collect()}
    assert {k: r.status for k, r in rows.items()} == {"a": "failed_extraction", "b": "failed_pipeline_error", "c": "completed"}
    assert rows["a"].error
    assert rows["a"].markdown_path is None
    assert rows["b"].manifest_path is None
    assert open(rows["c"].markdown_path).read() == "text"
    assert '"failed_stage":"extract_markdown"' in open(rows["a"].manifest_path).read()  # the failed document's manifest is kept
    (out / "markdown" / f"{key['a']}.md").rmdir()
    again = pipeline.Pipeline(spark, config, lambda pdf, raw: 1 / 0, lambda path: "x")  # no extractor is called
    assert {r.label: r.status for r in again.run(jobs).collect()}["a"] == "completed"


def test_captioning_by_document(spark, tmp_path, pdfs):
    """A captioner of whole documents that raises fails that document's captioning and keeps its Markdown."""
    config = captioned(Config(output=Output(root_dir=str(tmp_path / "out"))))

    def caption(paper, manifest):
        text = open(manifest["output_paths"]["markdown"]).read()
        if "b.pdf" in text:
            raise RuntimeError("no answer")
        return {"markdown": text + " seen", "images_found": 3, "images_captioned": 2, "images_skipped": 1} if "a.pdf" in text else None

    p = pipeline.Pipeline(spark, config, extract.of_paper(lambda paper, manifest: {"markdown": paper["pdf_path"], "pages": 1}), captioning.of_paper(caption))
    jobs = files.jobs(spark, files.resolve_inputs(pdfs))
    rows = {r.label: r for r in p.run(jobs).collect()}
    assert {k: (r.status, r.success) for k, r in rows.items()} == {"a": ("completed", True), "b": ("failed_captioning", False), "c": ("completed", True)}
    assert rows["b"].error == "no answer"
    assert open(rows["b"].markdown_path).read().endswith("b.pdf")
    assert rows["b"].captioned_path is None
    assert open(rows["a"].captioned_path).read().endswith("a.pdf seen")
    assert rows["a"].captioning_stats == {"images_found": 3, "images_captioned": 2, "images_skipped": 1}
    m = {r.paper_key: r for r in p.manifests(jobs.select("paper_key", "pdf_path")).collect()}
    assert sorted((r.batch_status, r.failed_stage) for r in m.values()) == [("failed", "caption_markdown"), ("succeeded", None), ("succeeded", None)]


def test_outputs_on_disk_are_used_again(spark, tmp_path, pdfs):
    """Markdown and captioned files that lie in the output folder count as results, unless forced."""
    config = captioned(Config(output=Output(root_dir=str(tmp_path / "out"))))
    jobs = files.jobs(spark, files.resolve_inputs(pdfs / "a.pdf"))
    key = jobs.first().paper_key
    for folder, text in (("markdown", "mine\r\n"), ("captioned_markdown", "mine, captioned")):
        (tmp_path / "out" / folder).mkdir(parents=True)
        (tmp_path / "out" / folder / f"{key}.md").write_bytes(text.encode())
    row = pipeline.Pipeline(spark, config, lambda pdf, raw: 1 / 0, lambda path: 1 / 0).run(jobs).first()
    assert (row.status, open(row.markdown_path).read()) == ("completed", "mine\n")
    forced = replace(config, resume=replace(config.resume, force=True))
    assert pipeline.Pipeline(spark, forced, lambda pdf, raw: "new", lambda path: "y").run(jobs).first().status == "completed"
    assert open(row.markdown_path).read() == "new"


def test_places_and_store_are_injected(spark, tmp_path, pdfs):
    from types import SimpleNamespace

    from vellum.functions import paths

    names = {n: getattr(paths, n) for n in ("raw_dir", "captioned_path", "manifest_path")}
    places = SimpleNamespace(**names, markdown_path=lambda root, key, name: paths.markdown_path(root, key, "elsewhere"))
    store = pipeline.TableStore(spark, str(tmp_path / "state"))
    p = pipeline.Pipeline(spark, Config(output=Output(root_dir=str(tmp_path / "out"))), lambda pdf, raw: "text", places=places, store=store)
    row = p.run(files.jobs(spark, files.resolve_inputs(pdfs / "a.pdf"))).first()
    assert "/elsewhere/" in row.markdown_path
    assert (tmp_path / "state/tables/stage_events").is_dir()
    assert not (tmp_path / "out/tables").exists()


def test_force(spark, tmp_path, pdfs):
    calls = tmp_path / "calls"
    config = Config(output=Output(root_dir=str(tmp_path / "out")))
    config = replace(config, resume=replace(config.resume, force=True))
    for _ in range(2):
        pipeline.ocr(pdfs / "a.pdf", config=config, spark=spark, extractor=extractor(str(calls)))
    assert len(calls.read_text().split()) == 2


def test_cli_and_stream(spark, tmp_path, pdfs, monkeypatch, capsys):
    monkeypatch.chdir(tmp_path)
    assert cli.main(["--input", str(pdfs / "a.pdf")], spark=spark, extractor=lambda p, r: "text") == 0
    assert cli.main(["--input", str(pdfs)], spark=spark, extractor=extractor(str(tmp_path / "calls"))) == 1
    assert "FAILED b" in capsys.readouterr().out
    table = tmp_path / "arrivals"
    spark.createDataFrame(list(enumerate(files.resolve_inputs(pdfs))), files.JOBS_SCHEMA).write.parquet(str(table))
    p = pipeline.Pipeline(spark, Config(output=Output(root_dir=str(tmp_path / "streamed"))), lambda pdf, raw: "text")
    intake.start(spark.readStream.schema(files.JOBS_SCHEMA).parquet(str(table)), p, str(tmp_path / "ck")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "streamed/tables/results")).count() == 3


def test_configuration(tmp_path, monkeypatch):
    for name in ("OPENAI_API_KEY", "AZURE_OPENAI_API_KEY", "OPENAI_BASE_URL", "AZURE_OPENAI_ENDPOINT"):
        monkeypatch.delenv(name, raising=False)
    f = tmp_path / "c.json"
    f.write_text('{"captioning": {"max_retries": 5}, "other": 1}')
    assert load(f).captioning.max_retries == 5
    for bad in ('{"captioning": {"nonsense": 1}}', "[]", "{"):
        f.write_text(bad)
        with pytest.raises(ConfigurationError):
            load(f)
    with pytest.raises(ConfigurationError):
        load(tmp_path / "c.toml")
    c = Config()
    assert resolve(c, caption=True).captioning.enabled
    assert not c.captioning.enabled
    for wrong in (resolve(c, caption=True), replace(c, ocr=replace(c.ocr, command=" ")), replace(c, captioning=replace(c.captioning, timeout_seconds=0))):
        with pytest.raises(ConfigurationError):
            validate(wrong)
    monkeypatch.setenv("AZURE_OPENAI_API_KEY", "secret")
    assert Config().apis.api_key == "secret"


def test_command(tmp_path):
    from vellum.errors import ExtractionError
    from vellum.operators import extract

    tool = tmp_path / "tool"
    tool.write_text('#!/bin/sh\nmkdir -p "$4/$(basename "$2" .pdf)/auto"\nprintf "# x\\r\\n" > "$4/$(basename "$2" .pdf)/auto/output.md"\n')
    tool.chmod(0o755)
    c = Config()
    run = extract.command(replace(c, ocr=replace(c.ocr, command=str(tool))))
    got = run("/in/d.pdf", str(tmp_path / "raw"))
    assert (got["markdown"], got["reused_existing"]) == ("# x\n", False)
    assert run("/in/d.pdf", str(tmp_path / "raw"))["reused_existing"]
    with pytest.raises(ExtractionError, match="no command"):
        extract.command(replace(c, ocr=replace(c.ocr, command=str(tmp_path / "none"))))("/in/d.pdf", str(tmp_path / "raw2"))
    tool.write_text("#!/bin/sh\necho broken >&2\nexit 3\n")
    with pytest.raises(ExtractionError, match="broken"):
        run("/in/e.pdf", str(tmp_path / "raw3"))
