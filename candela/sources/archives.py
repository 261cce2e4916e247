"""Monthly candle archives: CSV files in a ``symbol=/year=/month=MM.csv`` layout, and zipped archives."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from candela import schemas as S

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"  # folder name of a NULL
CSV_OPTIONS = {"columnPruning": "false", "header": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": S.RESCUE_COLUMN}


def symbol_of_path(path: Column) -> Column:
    """The value of the ``symbol=`` folder: escapes of the file path and of the folder name decoded; NULL for none or the NULL folder."""
    value = F.nullif(F.regexp_extract(path, S.SYMBOL_FROM_PATH, 1), F.lit(""))
    for _ in range(2):
        value = F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)
    return F.nullif(value, F.lit(NO_VALUE))


def _finish(df: DataFrame, path_col: Column, ingestion: Column | None, source_system: str) -> DataFrame:
    """Archive audit columns. Symbol comes from the path; a path without ``symbol=`` gives NULL
    (not ``''``) so the symbol rule catches it."""
    return (df.withColumns({
                "source_file": path_col,
                "symbol": symbol_of_path(path_col),
                "ingestion_timestamp": ingestion if ingestion is not None else F.current_timestamp(),
                "source_system": F.lit(source_system),
                "is_final": F.lit(True),
                "raw_payload": F.lit(None).cast("string"),
            })
            .drop("ignore"))


def read_csv_archives(spark: SparkSession, path: str, streaming: bool = False,
                      max_files_per_trigger: int | None = None,
                      source_system: str = S.SOURCE_ARCHIVE) -> DataFrame:
    """Read landed archive CSVs (fixed schema, no header) as a batch or as a file stream.

    Lines that do not fit the twelve columns (extra or missing fields) keep the whole line in
    ``_rescued_data``. The stream discovers new files per micro-batch; ``maxFilesPerTrigger``
    bounds each batch. ``symbol``/``year`` path segments are not used as partition columns:
    the symbol is taken from the file path so a malformed path yields NULL.
    """
    # Field-count checks need every field parsed: CSV_OPTIONS turn column pruning off for this read.
    reader = spark.readStream if streaming else spark.read
    reader = reader.format("csv").schema(S.CSV_SCHEMA).options(**CSV_OPTIONS)
    if streaming and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.option("recursiveFileLookup", "true").load(path)
    return _finish(df.select(*[c for c in df.columns], F.col("_metadata.file_path").alias("_path")),
                   F.col("_path"), None, source_system).drop("_path")


def parse_csv_lines(df: DataFrame, line: str = "line", path: str = "path", ingestion: Column | None = None,
                    source_system: str = S.SOURCE_ARCHIVE) -> DataFrame:
    """Same result as :func:`read_csv_archives` for lines already in a column (with their file path)."""
    parsed = df.select(F.from_csv(F.col(line), S.CSV_SCHEMA_DDL, CSV_OPTIONS).alias("_r"),
                       F.col(path).alias("_path"),
                       *([ingestion.alias("_ing")] if ingestion is not None else []))
    flat = parsed.select("_r.*", "_path", *(["_ing"] if ingestion is not None else []))
    out = _finish(flat, F.col("_path"), F.col("_ing") if ingestion is not None else None, source_system)
    return out.drop("_path", *(["_ing"] if ingestion is not None else []))


def archive_path(symbol: Column, year: Column, month: Column, root: str = "raw_klines") -> Column:
    """``<root>/symbol=<s>/year=<yyyy>/month=<MM>.csv`` (month zero-padded)."""
    return F.format_string(f"{root}/symbol=%s/year=%d/month=%02d.csv", F.coalesce(symbol, F.lit("")), year, month)


def write_landing(rows: DataFrame, root: str) -> None:
    """Land archive rows as headerless CSV in ``symbol=/year=/month=`` folders (Spark names the
    files inside each month folder; the readers above take the symbol from the path either way).
    One shuffle puts neighbouring symbol-months into one task's output."""
    cols = [n for n, _ in S.CSV_COLUMNS]
    out = rows.select(*[F.col(c) if c in rows.columns else F.lit(None).cast("string").alias(c) for c in cols],
                      "symbol", "year", F.lpad(F.col("month").cast("string"), 2, "0").alias("month"))
    # open time among the range keys: rows without symbol share a folder, not a task
    (out.repartitionByRange("symbol", "year", "month", "open_time").write.mode("append").option("header", "false")
        .partitionBy("symbol", "year", "month").csv(root))


def write_landing_lines(lines: DataFrame, root: str) -> None:
    """Land CSV text as it is (``symbol``, ``year``, ``month``, ``line``): lines with too many or too few fields too."""
    out = lines.select("symbol", "year", F.lpad(F.col("month").cast("string"), 2, "0").alias("month"), "line")
    out.repartitionByRange("symbol", "year", "month", "line").write.mode("append").partitionBy("symbol", "year", "month").text(root)


def landed_month(path: Column) -> Column:
    """``YYYY-MM`` of a landed file's folders or name; NULL where there is none."""
    found = lambda i: F.nullif(F.regexp_extract(path, r"year=(\d+)/month=(\d+)", i), F.lit(""))
    return F.concat_ws("-", found(1), found(2))


# -- zipped archives ----------------------------------------------------------------------------

UNZIP_SCHEMA = "path string, status string, line string"


LINES_PER_FRAME = 20_000


def _unzip_batches(batches):
    """First member of each archive as lines, LINES_PER_FRAME at a time. An archive that can't be read (bad zip, truncated, encrypted,
    not UTF-8) becomes one status row instead of failing the task; its lines before the fault are not kept. An archive
    without lines is one row without a line, so every archive has its outcome."""
    frame = lambda path, status, lines: pd.DataFrame({"path": path, "status": status, "line": lines}, dtype=object)
    for pdf in batches:
        for path, content in zip(pdf["path"], pdf["content"]):
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    names = z.namelist()
                    if not names:
                        raise zipfile.BadZipFile("empty archive")
                    text = z.read(names[0]).decode("utf-8")
            except Exception as e:  # noqa: BLE001 - whatever the reason, it is this archive's outcome
                why = "bad ZIP" if isinstance(e, zipfile.BadZipFile) else type(e).__name__
                yield frame([path], f"{S.STATUS_FAILED} ({why})", [None])
                continue
            block, empty = [], True
            for line in io.StringIO(text):
                if line := line.rstrip("\r\n"):
                    block.append(line)
                    empty = False
                if len(block) == LINES_PER_FRAME:
                    yield frame(path, S.STATUS_SUCCESS, block)
                    block = []
            if block or empty:
                yield frame(path, S.STATUS_SUCCESS, block or [None])


ZIP_SCHEMA = "path string, content binary"


def _zip_group(pdf: pd.DataFrame) -> pd.DataFrame:
    """One archive per group (one symbol-month: at most 44,640 one-minute lines, bounded by the
    calendar, not by data volume). Lines are ordered by open time inside the archive."""
    pdf = pdf.sort_values("open_time")
    buf = io.BytesIO()
    name = pdf["path"].iloc[0]
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(name.rsplit("/", 1)[-1].replace(".zip", ".csv"), "\n".join(pdf["line"]) + "\n")
    return pd.DataFrame({"path": [name], "content": [buf.getvalue()]})


def zip_monthly(lines: DataFrame) -> DataFrame:
    """(path, line, open_time) rows -> one zipped archive per path (grouped map over Arrow)."""
    return lines.groupBy("path").applyInPandas(_zip_group, ZIP_SCHEMA)


def unzip_archives(binary: DataFrame) -> DataFrame:
    """(path, content) rows -> (path, status, line). Runs in Arrow batches; with the
    ``binaryFile`` source each task reads its own group of files, so archives never pass
    through the driver. Arrow batches are bounded in bytes, and lines leave in blocks, so a task holds
    one archive decompressed."""
    return binary.select("path", "content").mapInPandas(_unzip_batches, UNZIP_SCHEMA)


def write_archives(zips: DataFrame, root: str) -> None:
    """Land (symbol, year, month, content) rows, one archive a row, as one file each in ``symbol=/year=/month=`` folders. Spark has no
    sink for bytes, but its text sink writes a value's bytes as they are, through Spark's committer and to any store; the line
    end after them is behind the archive's directory, where zip readers allow it."""
    out = zips.select("symbol", "year", F.lpad(F.col("month").cast("string"), 2, "0").alias("month"), F.col("content").cast("string").alias("value"))
    out.write.mode("append").partitionBy("symbol", "year", "month").text(root)


def read_zip_archives(spark: SparkSession, path: str, pattern: str = "*.zip") -> DataFrame:
    """Zipped archives on storage -> (path, status, line)."""
    return unzip_archives(spark.read.format("binaryFile").option("pathGlobFilter", pattern)
                          .option("recursiveFileLookup", "true").load(path))


def archive_outcomes(unzipped: DataFrame) -> DataFrame:
    """(symbol, year, month, path, status) of every archive read."""
    part = lambda name: F.regexp_extract("path", rf"{name}=(\d+)", 1).try_cast("int").alias(name)
    return unzipped.select("path", "status").distinct().select(symbol_of_path(F.col("path")).alias("symbol"), part("year"), part("month"), "path", "status")


def archive_rows(unzipped: DataFrame, ingestion: Column | None = None) -> DataFrame:
    """Lines of good archives parsed to bronze rows (the CSV path is the archive path with .csv)."""
    ok = unzipped.filter((F.col("status") == S.STATUS_SUCCESS) & F.col("line").isNotNull()).withColumn(
        "path", F.regexp_replace("path", r"\.zip$", ".csv"))
    return parse_csv_lines(ok, "line", "path", ingestion)
