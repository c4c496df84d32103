"""Parquet table access: column-pruned scans of one table of a data directory."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Schemas of tables that were read before, so that a query that scans a table several times looks at its footers once.
_schemas: dict[str, StructType] = {}


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns (all, if none are named) of ``{sf_dir}/{name}.parquet``; Catalyst pushes the projection into the scan.

    Tables are read-only: one whose schema changes in a session must be read under another path.
    """
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    df = spark.read.schema(_schemas[path]).parquet(path)
    return df.select(*columns) if columns else df


def spread(scan: DataFrame) -> DataFrame:
    """A scan in about as many partitions as there are cores, for work that is costly a row.

    A table of so few files that half the cores would stand idle is dealt out anew; one of more, as any large table is, stays
    as it is and nothing is shuffled.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if 2 * scan.rdd.getNumPartitions() < cores else scan
