"""Types of text columns, inferred from every row, and rows that do not fit.

One aggregate over all rows counts, per column, how many values fit each type
of a small lattice (boolean, bigint within double, date within timestamp, all
within string).  A column gets the narrowest type that all its values fit, or
all but a stated share, so that a few bad lines among many do not turn a
number column into strings.  The rows that do not fit are then split off with
their text: one scan writes the typed rows and the rejected ones side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, _parse_datatype_string

from ..session import work_dir

#: Narrowest first; each with the shape its text must have besides the cast.
SHAPES = {
    "boolean": "^(true|false|True|False|TRUE|FALSE)$",
    "bigint": "^[+-]?[0-9]{1,19}$",
    "double": "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "date": "^[0-9]{4}-[0-9]{2}-[0-9]{2}$",
    "timestamp": "^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?(Z|[+-][0-9]{2}:[0-9]{2})?$",
}
_WIDER = {"bigint": ("bigint", "double"), "date": ("date", "timestamp")}
RECORD = "_record"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fits(name: str, kind: str) -> Column:
    """Whether a text value has the shape of ``kind`` and converts to it."""
    return F.col(_quoted(name)).rlike(SHAPES[kind]) & F.expr(f"try_cast({_quoted(name)} AS {kind})").isNotNull()


def profile(df: DataFrame) -> DataFrame:
    """One row: per string column ``i`` the values that are neither null nor
    empty (``n_i``) and those that fit each type (``kind_i``)."""
    aggs = []
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(F.col(_quoted(c)) != "").alias(f"n_{i}"))
        # a value counts for its narrowest type; wider types add up below
        first = F.lit(None).cast("string")
        for kind in reversed(SHAPES):
            first = F.when(fits(c, kind), F.lit(kind)).otherwise(first)
        aggs += [F.count_if(first == kind).alias(f"{kind}_{i}") for kind in SHAPES]
    return df.agg(*aggs)


def narrowest(n: int, found: dict[str, int], reject_share: float) -> str:
    """The type of a column with ``n`` values, ``found[kind]`` of which have
    ``kind`` as their narrowest type."""
    sums = {k: sum(found[m] for m in SHAPES if k in _WIDER.get(m, (m,))) for k in SHAPES}
    for kind in SHAPES:
        if n and sums[kind] >= n * (1 - reject_share):
            return kind
    return "string"


def infer_csv(spark: SparkSession, paths: str | Sequence[str], reject_share: float = 0.0, header: bool = True,
              **options) -> StructType:
    """The schema of CSV files: names from the header, types from all rows.

    ``reject_share`` is the share of a column's values that may fit worse
    types (they become rejects).  Lines with too few or too many fields do not
    count.  A column of only nulls and empty strings is a string."""
    paths = paths if isinstance(paths, str) else list(paths)
    reader = spark.read.options(header=header, **options)
    names = reader.csv(paths).columns
    text = StructType([StructField(c, StringType()) for c in [*names, RECORD]])
    rows = reader.schema(text).option("columnNameOfCorruptRecord", RECORD).csv(paths)
    whole = rows.select(*[F.when(F.col(RECORD).isNull(), F.col(_quoted(c))).alias(c) for c in names])
    row = profile(whole).first()
    kinds = [narrowest(row[f"n_{i}"], {k: row[f"{k}_{i}"] for k in SHAPES}, reject_share) for i in range(len(names))]
    return StructType([StructField(c, _parse_datatype_string(k)) for c, k in zip(names, kinds)])


@dataclass
class Split:
    """Typed rows, and rejected ones: their text, their file and whatever of their fields could be read."""
    typed: DataFrame
    rejected: DataFrame


def read_csv_split(spark: SparkSession, paths: str | Sequence[str], schema: StructType | None = None, header: bool = True,
                   reject_share: float = 0.0, root: str | None = None, **options) -> Split:
    """Read CSV files once and split them: rows that fit ``schema`` (inferred
    from all rows if not given), and rows with a field that does not convert or
    with a wrong number of fields, as written.

    Both sides are written as Parquet below ``root`` (a new work folder by
    default) in one job, so later reads neither parse nor split again."""
    paths = paths if isinstance(paths, str) else list(paths)
    schema = schema or infer_csv(spark, paths, reject_share, header, **options)
    full = StructType([*schema.fields, StructField(RECORD, StringType())])
    rows = spark.read.options(header=header, **options).schema(full).option("columnNameOfCorruptRecord", RECORD).csv(paths)
    root = root or work_dir(spark, "csv-split")
    rows.select("*", F.col("_metadata.file_path").alias("_file"), F.col(RECORD).isNotNull().alias("_bad")) \
        .write.partitionBy("_bad").parquet(root)
    written = StructType([*full.fields, StructField("_file", StringType()), StructField("_bad", _parse_datatype_string("boolean"))])
    back = spark.read.schema(written).parquet(root)
    return Split(back.filter("NOT _bad").drop(RECORD, "_file", "_bad"), back.filter("_bad").drop("_bad"))
