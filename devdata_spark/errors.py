"""The three ways a dataset can fail: it cannot be read, shaped, or trusted."""


class DataExtractionError(Exception):
    """The landed files are missing or cannot be read."""


class DataFormattingError(Exception):
    """The files were read but do not have the expected shape."""


class DataValidationError(Exception):
    """The shaped table breaks one of its quality rules."""
