"""Errors a load can end with. The class names are stored in the run audit as ``error_type``."""


class SourceDataError(ValueError):
    """The history breaks its source contract."""


class ConflictingSourceVersionError(ValueError):
    """The history holds two payloads for one key and version."""


class TargetVersionConflictError(ValueError):
    """History and target hold different payloads for the same key and version."""


class PublishConflictError(RuntimeError):
    """Another writer published this snapshot number first."""


# Texts of errors that callers match on.
BLANK_PIPELINE_NAME = "pipeline_name must not be blank"
NAIVE_START = "initial_start_at must be timezone-aware"
NEGATIVE_OVERLAP = "overlap must be non-negative"
NEGATIVE_SKEW = "allowed_future_skew must be non-negative"
NO_HEADER = "source file must contain a header row"
MISSING_COLUMNS = "missing required columns: "
