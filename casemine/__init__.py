"""casemine: mining text case records with Spark DataFrames, SQL, MLlib and
Structured Streaming."""

__version__ = "0.1.0"
