"""Steps of a long job, kept in scratch tables so that the shuffles of one step are gone before the next.

Spark keeps all shuffles of a plan on disk until the plan has ended, and after that until the driver collects its
garbage. A fact of many joins thus needs the sum of its shuffles. Split into steps it needs the largest
step and the tables between, which are columnar and several times smaller than a shuffle of the same rows.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame

from mailfacts.session import FREE_SHUFFLES, during, scratch_dir, size_shuffles

# How a result between two steps is handed on: given its name and itself.
Keep = Callable[[str, DataFrame], DataFrame]


def as_planned(name: str, df: DataFrame) -> DataFrame:
    """No step: the result stays a part of the plan."""
    return df


class Steps:
    """Scratch tables of one job, below the shared scratch folder.

    Calling it runs a step: it writes a result and gives the table it wrote. Steps that later ones
    have used up can be deleted; the others stay, as the plan that is returned reads them.
    """

    def __init__(self, job: str):
        self.job = job
        self.paths: dict[str, str] = {}

    def __call__(self, name: str, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        path = self.paths[name] = f"{scratch_dir(spark)}/{self.job}-{name}-{uuid4().hex}"
        with during(spark, FREE_SHUFFLES):
            size_shuffles(df).write.option("compression", "zstd").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    def only(self, df: DataFrame, *names: str) -> DataFrame:
        """Delete all tables but ``names``, which are those that ``df`` still reads, and return ``df``."""
        spark = df.sparkSession
        for name in self.paths.keys() - set(names):
            folder = spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        return df
