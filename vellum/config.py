"""Configuration: frozen sections with defaults, from objects, JSON or YAML files, and the environment."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields, make_dataclass, replace
from pathlib import Path

from vellum.errors import ConfigurationError

CAPTION_PROMPT = "Describe this figure in at most 300 characters: its kind, what it shows, and the main trend or parts, so that a reader does without the image."


def _section(name: str, **defaults: object) -> type:
    return make_dataclass(name, [(k, type(v) if v is not None else "str | None", field(default=v)) for k, v in defaults.items()], frozen=True, module=__name__)


#: The external OCR command.
Ocr = _section("Ocr", backend="pipeline", command="ocr", extra_args=())
Captioning = _section("Captioning", caption_prompt=CAPTION_PROMPT, timeout_seconds=180, max_retries=2, enabled=False)
#: ``force``: run again what has succeeded or left files behind.
Resume = _section("Resume", skip_completed_stages=True, force=False, enabled=True)
Logging = _section("Logging", log_file=None, level="INFO")
Output = _section("Output", captioned_markdown_dir_name="captioned_markdown", markdown_dir_name="markdown", raw_dir_name="ocr_raw", manifests_dir_name="manifests", input_dir_name="input", root_dir="data_ocr")

_ENVIRONMENT = {"api_key": ("OPENAI_API_KEY", "AZURE_OPENAI_API_KEY"), "base_url": ("OPENAI_BASE_URL", "AZURE_OPENAI_ENDPOINT")}


@dataclass(frozen=True)
class Apis:
    """The captioning service; a key or URL that is not given comes from the environment."""

    model: str = "vision"
    api_version: str = "2023-05-15"
    base_url: str | None = None
    api_key: str | None = None

    def __post_init__(self) -> None:
        for name, variables in _ENVIRONMENT.items():
            found = next((v for x in variables if (v := os.getenv(x))), None)
            if found and not getattr(self, name):
                object.__setattr__(self, name, found)


@dataclass(frozen=True)
class Config:
    ocr: Ocr = field(default_factory=Ocr)
    captioning: Captioning = field(default_factory=Captioning)
    apis: Apis = field(default_factory=Apis)
    resume: Resume = field(default_factory=Resume)
    output: Output = field(default_factory=Output)
    logging: Logging = field(default_factory=Logging)

    @classmethod
    def from_dict(cls, data: dict) -> Config:
        """Sections that are absent or null get their defaults; unknown keys of a section are errors, unknown sections are not read."""
        kinds = {f.name: f.default_factory for f in fields(cls)}
        sections = {name: dict(data.get(name) or {}) for name in kinds}
        if "extra_args" in sections["ocr"]:
            sections["ocr"]["extra_args"] = tuple(sections["ocr"]["extra_args"])
        return cls(**{name: kind(**sections[name]) for name, kind in kinds.items()})


def load(path: str | Path) -> Config:
    """A JSON file, or YAML where PyYAML is installed."""
    path = Path(path)
    try:
        text = path.read_text(encoding="utf-8")
        if path.suffix.lower() == ".json":
            data = json.loads(text)
        elif path.suffix.lower() in (".yaml", ".yml"):
            import yaml

            data = yaml.safe_load(text)
        else:
            raise ConfigurationError(f"a configuration is .json, .yaml or .yml, not {path.suffix or path.name}")
        if not isinstance(data, dict):
            raise ConfigurationError(f"{path} holds no object")
        return Config.from_dict(data)
    except ConfigurationError:
        raise
    except Exception as e:
        raise ConfigurationError(f"{path} can't be used: {e}") from e


def validate(config: Config) -> None:
    cap, blank = config.captioning, lambda x: not (x or "").strip()
    wrong = {
        "ocr.command is blank": blank(config.ocr.command),
        "ocr.backend is blank": blank(config.ocr.backend),
        "captioning can't be retried less than never": cap.max_retries < 0,
        "captioning needs a time limit above 0": cap.timeout_seconds <= 0,
        "captioning needs apis.api_key": cap.enabled and blank(config.apis.api_key),
        "captioning needs apis.base_url": cap.enabled and blank(config.apis.base_url),
        "output.root_dir is blank": blank(config.output.root_dir),
    }
    for what, so in wrong.items():
        if so:
            raise ConfigurationError(what)


def load_env(path: str | Path | None = None) -> None:
    """Variables of a ``.env`` file in the working folder, where python-dotenv is installed; set ones win."""
    try:
        from dotenv import load_dotenv
    except ImportError:
        return
    load_dotenv(path or Path.cwd() / ".env", override=False)


def resolve(config=None, config_path=None, output_dir=None, caption=False) -> Config:
    """An object goes before a path, a path before ``config.json`` in the working folder, that before the defaults.

    Overrides give a new object; the caller's stays as it is.
    """
    if config is None:
        here = Path.cwd() / "config.json"
        config = load(config_path) if config_path else load(here) if here.is_file() else Config()
    if output_dir is not None:
        config = replace(config, output=replace(config.output, root_dir=str(Path(output_dir).resolve())))
    if caption:
        config = replace(config, captioning=replace(config.captioning, enabled=True))
    return config
