"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakewash.session import scratch_path

#: A word is a run of characters other than space, tab, \n, \v, \f and \r.
WORD_RE = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: the
    rows are decided once, the lineage is cut, and a lost executor only costs
    a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unstaged(*tables: DataFrame) -> None:
    """Delete the files of ``staged`` tables that nothing reads any more, so that
    a job of many steps holds the tables of a few."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        for folder in {x.rsplit("/", 1)[0] for x in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def only(df: DataFrame, *columns: str) -> DataFrame:
    """The named input columns and nothing else, so that extra columns of the
    caller's table can never clash with an operator's own. A column that the
    caller's table lacks is an error; a name in another case is accepted."""
    return df.select(*[F.col(f"`{c}`").alias(c) for c in columns])


class Apart:
    """The caller's rows under names that no operator uses, so that extra
    columns of any name pass through a join or an aggregation unharmed."""

    def __init__(self, docs: DataFrame):
        self.columns = docs.columns
        self.name = {c: f"_doc_{i}" for i, c in enumerate(docs.columns)}
        self.rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in self.name.items()])

    def __getitem__(self, column: str):
        """The caller's column; a name in another case is accepted."""
        found = {c.lower(): n for c, n in self.name.items()}
        return F.col(found[column.lower()])

    def back(self, df: DataFrame, *more) -> DataFrame:
        """``df`` with the caller's names again, and the given columns after them."""
        return df.select(*[F.col(n).alias(c) for c, n in self.name.items()], *more)


def let(value, body):
    """``body(x)`` with ``x`` bound to ``value`` once: a Catalyst lambda
    variable, so an array that a lambda indexes is built only one time."""
    return F.transform(F.array(value), body)[0]
