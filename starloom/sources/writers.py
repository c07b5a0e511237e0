"""Text sinks matching the source formats the readers accept.

* :func:`write_delimited` - header text with any separator, values written
  verbatim (no whitespace trimming), null as an empty field and empty
  string as a quoted ``""``, so :func:`starloom.sources.readers.read_delimited`
  reads back exactly what was written.
* :func:`write_json_array` - the multi-line "JSON dump" layout (one
  top-level array per file), which Spark's JSON writer does not produce.

Both go through Spark's own text writers, so any file system serves and the
committer keeps retries and speculative attempts from showing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.session import ship_package


def write_delimited(df: DataFrame, path: str, sep: str) -> None:
    """Header text with ``sep``; values written verbatim (no whitespace
    trimming), null as an empty field, empty string as a quoted ``""``."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep)
       .option("quote", '"').option("escape", '"')
       .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
       .csv(path))


#: Lines of one NDJSON file.
NDJSON_LINES = 500_000
#: Documents of one array: a task reads a file of it whole.
ARRAY_DOCUMENTS = 50_000


def write_ndjson(df: DataFrame, path: str) -> None:
    """Newline-delimited JSON, compressed: field names and fixed words make up
    most of its bytes.  Files are bounded, as a compressed one can't be split."""
    df.write.mode("overwrite").option("compression", "gzip").option("maxRecordsPerFile", NDJSON_LINES).json(path)


def _array_lines(batches: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """The lines of JSON arrays of ``size`` documents (the last one's: the
    rest) over a partition, a line a document and one that closes the array."""
    n = 0
    for pdf in batches:
        lines = []
        for doc in pdf["j"]:
            lines.append(("," if n else "[") + doc)
            n += 1
            if n == size:
                lines.append("]")
                n = 0
        if lines:
            yield pd.DataFrame({"line": lines})
    if n:
        yield pd.DataFrame({"line": ["]"]})


def write_json_array(df: DataFrame, path: str, size: int = ARRAY_DOCUMENTS) -> None:
    """Files of a single top-level JSON array each (the multi-line JSON dump
    layout), of at most ``size`` documents: such a file can't be split, so a
    larger partition is written as several."""
    ship_package(df.sparkSession)
    js = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    lines = js.mapInPandas(lambda batches: _array_lines(batches, size), "line string")
    # One line more than documents: where the writer begins a file, an array begins.
    lines.write.mode("overwrite").option("maxRecordsPerFile", size + 1).text(path)
