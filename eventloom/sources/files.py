"""Reading and writing delimited text and columnar caches."""

from __future__ import annotations

import datetime
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.session import one_machine

CLICK_SCHEMA = T.StructType(
    [
        T.StructField("click_id", T.LongType()),
        T.StructField("ip", T.LongType()),
        T.StructField("app", T.IntegerType()),
        T.StructField("device", T.IntegerType()),
        T.StructField("os", T.IntegerType()),
        T.StructField("channel", T.IntegerType()),
        T.StructField("click_time", T.TimestampNTZType()),
        T.StructField("is_attributed", T.IntegerType()),
    ]
)


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below the shared checkpoint folder; a local session may use a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not one_machine(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        return tempfile.mkdtemp(prefix="eventloom-files-")
    return f"{shared.rstrip('/')}/eventloom-files-{uuid.uuid4().hex}"


def read_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType = CLICK_SCHEMA, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV with a header, declared types and a column subset. Columns are matched by name."""
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
    return df.select(*columns) if columns else df


def read_csv_columns(
    spark: SparkSession, path: str, select: Sequence[str] | None = None, drop: Sequence[str] = (), **options
) -> DataFrame:
    """CSV with a header, all text, keeping or leaving out named columns."""
    df = spark.read.options(header=True, **options).csv(path)
    return df.select(*select) if select else df.drop(*drop)


def read_inferred_csv(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """CSV whose types are inferred (costs an extra pass; prefer :func:`read_typed_csv`)."""
    return spark.read.options(header=True, inferSchema=True, encoding=encoding).csv(path)


def _drop_heads(skip: int):
    """Batches of (value, file, start) without the first ``skip`` lines of each file.

    The head of a file lies in its first split, whose lines arrive in file order within one task.
    """

    def strip(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            place = batch.groupby("file").cumcount() + batch["file"].map(seen).fillna(0)
            for name, count in batch["file"].value_counts().items():
                seen[name] = seen.get(name, 0) + int(count)
            yield batch.loc[(batch["start"] > 0) | (place >= skip), ["value"]]

    return strip


def read_tsv_after_preamble(spark: SparkSession, path: str, schema: T.StructType, skip: int) -> DataFrame:
    """Tab-separated text whose files start with ``skip`` preamble lines and a header line.

    Spark's readers cannot leave out more than one line per file, so the lines pass through one
    Arrow step that drops the heads; parsing is left to ``from_csv``. No shuffle, one pass.
    """
    lines = spark.read.text(path).select(
        "value", F.input_file_name().alias("file"), F.input_file_block_start().alias("start")
    )
    data = lines.mapInPandas(_drop_heads(skip + 1), "value string")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return data.select(F.from_csv("value", fields, {"sep": "\t"}).alias("row")).select("row.*")


def write_tsv_with_preamble(df: DataFrame, path: str, preamble: Sequence[str]) -> None:
    """The layout that :func:`read_tsv_after_preamble` reads: every file starts with the preamble."""
    line = F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns])
    head = [F.lit(text) for text in (*preamble, "\t".join(df.columns))]
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    lines = df.select(F.explode(F.when(first, F.array(*head, line)).otherwise(F.array(line))).alias("value"))
    lines.write.mode("overwrite").text(path)


def read_in_file_order(
    spark: SparkSession, path: str, file_order: Sequence[str], columns: Sequence[str], schema: T.StructType
) -> DataFrame:
    """Headed CSV whose columns come in ``file_order``, whatever the header calls them."""
    ordered = T.StructType([schema[c] for c in file_order])
    return spark.read.schema(ordered).options(header=True, enforceSchema=True).csv(path).select(*columns)


def like(df: DataFrame) -> DataFrame:
    """An empty table with the columns of ``df``."""
    return df.limit(0)


def cached_parquet(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` once and go on from the written table."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def reuse_or_build(spark: SparkSession, path: str, build) -> DataFrame:
    """The table at ``path`` if it was completely written before, else ``build()`` written there."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/_SUCCESS")
    done = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.parquet(path) if done else cached_parquet(build(), path)


def fixed_digits(value: str | Column, digits: int = 9) -> Column:
    return F.format_string(f"%.{digits}f", F.col(value) if isinstance(value, str) else value)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_submission(df: DataFrame, path: str, key: str, value: str, digits: int = 9) -> None:
    """Two columns, the prediction with a fixed number of digits."""
    write_csv(df.select(key, fixed_digits(value, digits).alias(value)), path)


def dated_name(stem: str, day: datetime.date | None = None) -> str:
    return f"{stem}{(day or datetime.date.today()).isoformat()}.csv"


def insert_select(source: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Append the named columns of ``source`` to the table at ``path``."""
    source.select(*columns).write.mode("append").parquet(path)
