"""CSV hand-over files (header, UTF-8, comma) read onto a declared schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def write_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Append with a header line per file (never a second header inside a file)."""
    (df.write.mode(mode).option("header", True).option("encoding", "UTF-8")
     .option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """S5 + P5: header CSV onto a declared schema; empty field = null; bad values = null.

    Quotes inside a field are doubled and a quoted field may hold line ends, so a
    file is read by one task: keep hand-over files moderate in size.
    """
    return (spark.read.schema(schema)
            .option("header", True).option("nullValue", "").option("mode", "PERMISSIVE")
            .option("encoding", "UTF-8").option("quote", '"').option("escape", '"').option("multiLine", True)
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
