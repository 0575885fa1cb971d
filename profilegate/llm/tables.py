"""Reading input tables and landing intermediate ones in the folder the executors share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from profilegate.options import shared_folder

# The characters [\x20\x09-\x0D], which separate words.
SPACES = " \t\n\x0b\x0c\r"
MOST_ROWS = 500
MOST_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Work:
    """A fresh folder under ``spark.checkpoint.dir``; what is landed there survives lost executors.

    Whole texts go through Python, so the session's Arrow batches are held to ``MOST_ROWS`` rows and end with the row that
    brings them to ``MOST_BYTES``; the defaults let a task hold many more than it needs, several times over.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = shared_folder(spark)
        self.count = 0
        if not 0 < int(spark.conf.get(_BATCH)) <= MOST_ROWS:
            spark.conf.set(_BATCH, str(MOST_ROWS))
        size = spark.conf.get(_BATCH_BYTES)
        if not size.isdigit() or int(size) > MOST_BYTES:
            spark.conf.set(_BATCH_BYTES, str(MOST_BYTES))

    def land(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write a table and read it again, which cuts the lineage and fixes the row values."""
        self.count += 1
        path = f"{self.folder}/{self.count:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def without_spaces(text: Column) -> Column:
    for char in SPACES:
        text = F.replace(text, F.lit(char), F.lit(""))
    return text


def id_text(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves ``fold`` when divided by ``folds``; a null id counts as empty text."""
    return F.crc32(id_text(doc_id).cast("binary")) % folds == fold


def rows_of(df: DataFrame) -> int:
    return df.agg(F.count(F.lit(1))).first()[0]


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores after it until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def give_back() -> None:
    """Return memory freed by a task to the system; Python workers outlive their tasks and would keep it."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
