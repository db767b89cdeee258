"""Small helpers of the document operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoscore.session import fresh_path


def written(df: DataFrame, kind: str, by: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back; ``by``
    names a column whose values get folders of their own.

    Cuts the lineage: a lost executor costs a re-read only."""
    path = fresh_path(df.sparkSession, f"llm-{kind}")
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def forget(df: DataFrame) -> None:
    """Delete a written table that no later step reads."""
    jvm = df.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written_path)
    path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def lookup(table: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A written narrow table (a few numbers a row) as the side of a join:
    broadcast when it has ``most`` rows at most, joined by shuffle beyond."""
    return F.broadcast(table) if table.count() <= most else table


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` doesn't have (case-insensitive)."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(doc_id: Column) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")))


def spread(*cols: Column) -> Column:
    """Non-negative 31-bit hash of the columns, for dealing rows out evenly."""
    return F.xxhash64(*cols).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
