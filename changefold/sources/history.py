"""Reading and growing an accumulated change history.

CSV is read by Spark's own reader, which streams files of any size: quotes inside a quoted cell are doubled,
cells beyond the header are ignored, rows without any character are passed over. The caller says whether
cells may hold line breaks (``multiline``, one task a file) or every line is a row (files are split).

An empty cell is the empty text; cells that a short row lacks are null. The reader gives null for both and
marks rows of an odd number of cells, so that in such a row empty cells are null as well.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

#: Column that names the file a CSV row came from; error reports use it.
SOURCE_FILE = "source_file"

# Every cell is kept as it is; by default both the reader and the writer would change some.
_CSV = {"header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def csv_header(spark: SparkSession, path: str, multiline: bool = True) -> list[str]:
    """Column names of the history, as the reader takes them from its first file; none if that is empty."""
    return spark.read.options(**_CSV, multiLine=multiline).csv(path).columns


def read_csv_history(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """All CSV files below ``path`` as text columns named by their header, which all must share.

    With ``multiline`` cells may hold line breaks, and a file is read by one task. Without it a line is a row,
    whatever quotes it holds, and files are split among tasks. For files without line breaks in
    cells both give the same rows.
    """
    names = csv_header(spark, path, multiline)
    if not names:
        return spark.createDataFrame([], T.StructType())
    odd = "_odd"
    while odd in names:
        odd += "_"
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, odd]])
    # Checked against the schema, every file's header has to be the first one's.
    reader = spark.read.schema(schema).options(**_CSV, multiLine=multiline, enforceSchema=False, columnNameOfCorruptRecord=odd)
    rows = reader.csv(path)
    cells = (F.when(F.col(odd).isNull(), F.coalesce(f"`{name}`", F.lit(""))).otherwise(F.col(f"`{name}`")).alias(name) for name in names)
    return rows.select(*cells, F.col("_metadata.file_path").alias(SOURCE_FILE))


def append_csv_history(fragment: DataFrame, path: str) -> None:
    """Add a change fragment to the CSV history below ``path``, matching columns by name.

    Cells must be text. The first fragment decides the column order.
    """
    try:
        names = csv_header(fragment.sparkSession, path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        names = []
    fragment.select(*(names or fragment.columns)).write.mode("append").options(**_CSV, quoteAll=True).csv(path)


def with_fragment(history: DataFrame, fragment: DataFrame) -> DataFrame:
    """History plus a change fragment, columns matched by name."""
    return history.unionByName(fragment)
