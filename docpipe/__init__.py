"""docpipe: DataFrame operators that turn raw legal pages into validated, chunked, indexed records."""

__version__ = "0.1.0"
