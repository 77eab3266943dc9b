"""What several operators share: reading tables, words and code points as column expressions."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tradeloom.session import tune, written

TEXT_ROWS = 2_000
ROW = "_row"  # the number of a row, in tables of the operators' own
DRAWS = 1 << 50
FILE_ROWS = 1 << 40  # more than any file has
BROADCAST_FILES = 500_000  # counted; some 60 MB
BROADCAST_NUMBERS = 2_000_000  # counted; some 32 MB
WORD_BREAKS = " \t\n\x0b\f\r"  # a word is a run of any other characters


def lean(spark: SparkSession) -> SparkSession:
    """The session, set to hand a bounded number of rows to Python at once: they hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name += "_"
    return name


def numbered(df: DataFrame, stored: bool = False) -> tuple[DataFrame, str]:
    """The rows with a number of their own, and the name of its column, which the frame didn't have before.

    ``stored`` says that the frame is a table of Parquet files, or columns of one: its rows are numbered by file and place in the
    file, the same for every reader, and nothing is copied. Other frames are written once with their numbers.
    """
    number = free_name(df, ROW)
    if stored:
        file, place = free_name(df, "_file"), free_name(df, "_place")
        try:
            placed = df.withColumns({file: F.col("_metadata.file_path"), place: F.col("_metadata.row_index")})
        except AnalysisException:  # no table of files after all
            placed = None
        if placed is not None:
            # one row per file, which the driver lists anyway
            files = placed.where(F.col(place) == 0).select(file).withColumn(number, F.row_number().over(Window.orderBy(file)))
            files = written(files, "files")
            if files.count() <= BROADCAST_FILES:
                at = (F.col(number).cast("long") * FILE_ROWS + F.col(place)).alias(number)
                return placed.join(F.broadcast(files), file).select(*df.columns, at), number
    return written(df.withColumn(number, F.monotonically_increasing_id()), "numbered"), number


def _by_number(df: DataFrame, number: str, numbers: DataFrame, how: str) -> DataFrame:
    right = numbers.select(F.col(numbers.columns[0]).alias(number))
    few = right.count() <= BROADCAST_NUMBERS
    return df.join(F.broadcast(right) if few else right, number, how)


def only_rows(df: DataFrame, number: str, numbers: DataFrame) -> DataFrame:
    """The rows whose number is in the first column of the written table ``numbers``; a few numbers go to the rows, and no row is moved."""
    return _by_number(df, number, numbers, "left_semi")


def without_rows(df: DataFrame, number: str, numbers: DataFrame) -> DataFrame:
    """The rows whose number is not in ``numbers``, without the number."""
    return _by_number(df, number, numbers, "left_anti").drop(number)


def text_of(column: str | Column) -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order."""
    return F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda word: word != "")


def bounded_sample(df: DataFrame, rows: int, *columns: str) -> DataFrame:
    """At most ``rows`` rows, those with the least hashes of ``columns``, the same on every run but for rows that agree in these.

    Most rows are passed over where they are read; the few that may be in the sample are sorted, so that no number of rows
    that agree in ``columns`` makes it larger."""
    total = df.count()
    if total <= rows:
        return df
    draw = F.xxhash64(*columns)
    near = df.where(F.pmod(draw, F.lit(DRAWS)) < F.lit(int(rows / total * DRAWS) + 1))
    return near.orderBy(F.pmod(draw, F.lit(DRAWS)), *columns).limit(rows)
