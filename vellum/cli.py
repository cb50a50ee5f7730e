"""Command line: ``python -m vellum.cli --input PATH [--config FILE] [--caption]``; 0 if every document succeeded."""

from __future__ import annotations

import argparse

from vellum import config as configuration
from vellum.plans import pipeline


def main(args: list[str] | None = None, **injected) -> int:
    parser = argparse.ArgumentParser(description="Turn PDFs into Markdown with structural counts and figure captions.")
    flags = {"input": dict(required=True, help="a PDF or a folder of PDFs"), "config": dict(help="a JSON or YAML configuration"), "caption": dict(action="store_true", help="describe figures")}
    for name, how in flags.items():
        parser.add_argument(f"--{name}", **how)
    given = parser.parse_args(args)
    configuration.load_env()
    config = configuration.resolve(None, given.config, None, given.caption)
    pipeline.enable_logging(config.logging.level, config.logging.log_file)
    results = pipeline.ocr(given.input, config=config, **injected)
    good = sum(r.success for r in results)
    for r in results:
        if not r.success:
            print(f"FAILED {r.label}: {r.error}")
    print(f"{good} of {len(results)} documents succeeded")
    return int(good != len(results))


if __name__ == "__main__":
    raise SystemExit(main())
