"""Short rates: pipe-separated text files, one per country, with comment and header lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.normalize import html_unescape
from ..schemas import SHORT_RATES_RENAMES


def read_short_rate_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the files with ``Source``, the file name without ``.txt``."""
    name = F.regexp_replace(F.col("_metadata.file_name"), r"\.txt$", "")
    lines = spark.read.text(path, pathGlobFilter="*.txt")
    return lines.select(name.alias("Source"), F.col("value"))


def parse_short_rates(lines: DataFrame, types: Mapping[str, str] | None = None) -> DataFrame:
    """Short rates table from ``(Source, value)`` lines.

    Lines starting ``#BOF`` or ``#EOF`` are dropped and the other ``#`` line is the header, which
    must be the same in all files. Text is HTML-unescaped and a trailing ``|`` ignored. Column types
    are inferred from the values in one aggregate, unless given by file column name.
    """
    lines = lines.filter(~F.col("value").rlike("^#[BE]OF"))
    text = F.regexp_replace(html_unescape(F.col("value")), r"\|$", "")
    headers = lines.filter(F.col("value").startswith("#")).select(text.alias("h")).distinct().take(2)
    if not headers:
        raise ValueError("Short rates: no header line")
    if len(headers) > 1:
        raise ValueError(f"Mismatched headers: {headers[0].h} {headers[1].h}")
    names = headers[0].h[1:].split("|")
    fields = F.split(text, r"\|")
    data = lines.filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    table = data.select("Source", fields.alias("f")).select(
        "Source", *[F.nullif(F.try_element_at("f", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)]
    )
    types = dict(types) if types is not None else infer_types(table, names)
    typed = {n: F.col(n).try_cast(t) for n, t in types.items() if n in names}
    return (table.withColumns(typed) if typed else table).withColumnsRenamed(SHORT_RATES_RENAMES)


def infer_types(df: DataFrame, columns) -> dict[str, str]:
    """``bigint`` or ``double`` for columns whose every value is one, else ``string``."""
    fits = [
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull()).alias(f"{i}_{t}")
        for i, c in enumerate(columns)
        for t in ("bigint", "double")
    ]
    bad = df.agg(*fits).first()
    return {
        c: next((t for t in ("bigint", "double") if not bad[f"{i}_{t}"]), "string")
        for i, c in enumerate(columns)
    }


def read_short_rates(spark: SparkSession, path: str, types: Mapping[str, str] | None = None) -> DataFrame:
    return parse_short_rates(read_short_rate_lines(spark, path), types)
