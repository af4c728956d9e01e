"""What can go wrong; a fault of one file is a row of the outcome table, not an exception."""


class IsohyetError(Exception):
    """Base of all."""


class DatasetNotFound(IsohyetError):
    def __init__(self, path: str) -> None:
        super().__init__(f"no dataset at {path}")
        self.path = path


class ConfigurationError(IsohyetError):
    pass


class SchemaVarianceExceeded(IsohyetError):
    def __init__(self, path: str, differing: int, limit: int) -> None:
        super().__init__(f"{path}: {differing} columns differ, {limit} may")


#: status of a file in the outcome table
OK, NO_DATA_MARKER, HEADER_FAILED, NOT_UTF8 = "ok", "NoDataMarker", "HeaderParsingFailed", "InvalidEncoding"
