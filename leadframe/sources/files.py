"""Readers and writers for the exchanged file layouts.

Schemas are always given, never inferred: inference would read the data twice.
"""

from __future__ import annotations

import csv
import json
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.payload import strict_json
from ..functions.text import _c, is_blank, py_strip


def _strings(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def _layouts(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Header line -> its files.  One narrow scan of the text; what comes back is a path and a line for each file."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value",
                                         F.monotonically_increasing_id().alias("row"))
    # a file's first block is read by one task, in order
    heads = lines.where("at = 0").groupBy("file").agg(F.min_by("value", "row").alias("head"))
    found: dict[str, list[str]] = {}
    for row in heads.orderBy("file").collect():
        found.setdefault(row.head.removeprefix("\ufeff").rstrip("\r"), []).append(unquote(row.file))
    return found


def _named_rows(reader, header: str, files, sep: str) -> DataFrame:
    """Rows of files with this header line; of columns with the same name the last counts."""
    names = next(csv.reader([header], delimiter=sep))
    places = {name: i for i, name in enumerate(names)}
    rows = reader.schema(_strings(f"_c{i}" for i in range(len(names)))).option("header", True).option("enforceSchema", True).csv(files)
    return rows.select(*[F.col(f"_c{i}").alias(name) for name, i in places.items()])


def read_delimited(spark: SparkSession, path: str, columns=None, sep: str = ",", header: bool = True,
                   multi_line: bool = False, one_layout: bool = False) -> DataFrame:
    """All-string rows of a delimited file or folder; a byte-order mark is skipped.

    With ``header`` columns go by the names in each file's first line, wherever
    they stand: the named ``columns`` come first (NULL where a file has none of
    that name), further ones are kept after them, sorted by name if files differ.
    Files with the same header line are read together, one union branch for each
    layout.  Finding the layouts reads the text once more; ``one_layout``
    promises that all files share the header of the first and saves that.
    Without ``header`` the columns go by position.  ``multi_line`` reads quoted
    line breaks inside cells; such files cannot be split between tasks.  Empty cells are NULL.
    """
    reader = spark.read.option("sep", sep).option("escape", '"').option("encoding", "UTF-8") \
        .option("multiLine", multi_line).option("nullValue", "")
    if not header:
        return reader.schema(_strings(columns)).option("header", False).csv(path)
    if one_layout:
        rows = reader.option("header", True).csv(path)  # reads the first line only, types stay strings
        parts = [rows.toDF(*[name.removeprefix("\ufeff") for name in rows.columns])]
    else:
        parts = [_named_rows(reader, head, files, sep) for head, files in sorted(_layouts(spark, path).items())]
    if not parts:
        return spark.createDataFrame([], _strings(columns or ()))
    names = [list(part.columns) for part in parts]
    rest = names[0] if len(parts) == 1 else sorted({n for own in names for n in own})
    wanted = [*(columns or ()), *[n for n in rest if n not in (columns or ())]]
    return reduce(DataFrame.unionAll, [part.select(*[F.col(f"`{n}`") if n in own else F.lit(None).cast("string").alias(n) for n in wanted])
                                       for part, own in zip(parts, names)])


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """First column of a URL list; blank rows and header lines are dropped."""
    rows = spark.read.schema("url string").option("header", False).option("escape", '"').csv(path)
    return rows.where(is_url_row("url"))


def is_url_row(col) -> Column:
    """Neither blank nor the header word ``URL`` in any case."""
    return ~is_blank(col) & (F.lower(py_strip(col)) != "url")


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """VARIANT per readable line; blank and broken lines are skipped."""
    return parse_json_lines(spark.read.text(path), "value")


def parse_json_lines(lines: DataFrame, line: str, out: str = "item") -> DataFrame:
    parsed = lines.withColumn(out, strict_json(py_strip(line)))
    return parsed.where(F.col(out).isNotNull())


def scan_rows(df: DataFrame, start: int = 1, end: int | None = None, value: str = "value",
              row: str = "row_idx") -> DataFrame:
    """Non-blank cells of a row range, stripped, with their own row numbers.

    The range is a plain comparison on a stored column and reaches the scan.
    """
    bounds = F.col(row) >= start
    if end is not None:
        bounds = bounds & (F.col(row) <= end)
    return df.where(bounds).where(~is_blank(value)).withColumn(value, py_strip(value))


def page_urls(spark: SparkSession, base: str, first: int, last: int) -> DataFrame:
    """Listing URLs ``base + number``."""
    return spark.range(first, last + 1).select(
        F.concat(F.lit(base), F.col("id").cast("string")).alias("url"))


def page_urls_of(sites: DataFrame, base: str, last: str, first: int = 1) -> DataFrame:
    """Listing URLs per site, from its base URL and its announced page count."""
    return sites.select(
        "*", F.explode(F.sequence(F.lit(first), F.col(last))).alias("page_no")
    ).withColumn("url", F.concat(_c(base), F.col("page_no").cast("string")))


def write_delimited(df: DataFrame, path: str, columns, sep: str = ",", mode: str = "overwrite") -> None:
    """Files with the fixed column order and a header line."""
    df.select(*[F.col(f"`{c}`") for c in columns]).write.mode(mode).option("header", True) \
        .option("sep", sep).option("escape", '"').option("encoding", "UTF-8").csv(path)


def write_jsonl(df: DataFrame, path: str, mode: str = "append") -> None:
    """One JSON object per line, other alphabets kept as they are."""
    df.write.mode(mode).option("ignoreNullFields", False).json(path)


def _dictionary_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).head().value


def load_dictionary(spark: SparkSession, path: str) -> dict[str, dict[str, str]]:
    """Keyword dictionary ``group -> name -> pattern`` from one JSON or YAML file, for rules that become literals of a plan.

    Read by Spark, from whatever storage it reads.  For dictionaries beyond some
    hundred entries see :func:`read_dictionary`.
    """
    text = _dictionary_text(spark, path)
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("reading YAML needs the yaml package; use JSON") from exc
        return yaml.safe_load(text)
    return json.loads(text)


def read_dictionary(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """The same as a table ``group, name, pattern``, from JSON: an object in each file, or with ``lines`` in each line."""
    groups = spark.read.text(path, wholetext=not lines) \
        .select(F.explode(F.from_json("value", "map<string,map<string,string>>")).alias("group", "_names"))
    return groups.select("group", F.explode("_names").alias("name", "pattern"))
