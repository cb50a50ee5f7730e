"""Errors raised on the driver; errors of single documents are data in ``error`` columns."""


class EngineError(Exception):
    """Base of all errors of the engine."""


class ConfigurationError(EngineError):
    """A configuration file or value that can't be used."""


class InputParseError(EngineError):
    """An input path that names no document; fails the whole call."""


class MetadataError(EngineError):
    """Bibliographic metadata that can't be used."""


class IdentifierRecoveryError(EngineError):
    """Identifiers that can't be recovered."""


class ResolutionError(EngineError):
    """A source that can't be resolved."""


class DownloadError(EngineError):
    """A download that failed."""


class PDFValidationError(EngineError):
    """A file that is no usable PDF."""


class ExtractionError(EngineError):
    """Text extraction of one document failed."""


class CaptioningError(EngineError):
    """Captioning of one document failed."""


class ResumeError(EngineError):
    """State that can't be resumed from."""


class StateStoreError(EngineError):
    """Stored state that can't be read or written."""
