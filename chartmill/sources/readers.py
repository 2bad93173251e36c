"""Reading source tables and staged entities."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from chartmill.schemas import staged_schema


def read_table(spark: SparkSession, path: str, columns: Sequence[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """A columnar table; naming the columns documents what the job reads (Spark prunes the rest anyway)."""
    df = spark.read.format(fmt).load(path)
    return df.select(*columns) if columns else df


def jdbc_options(url: str, table: str, key: str, lower: int, upper: int, partitions: int,
                 columns: Sequence[str] | None = None, **extra: str) -> dict[str, str]:
    """Options of a database read in parallel key ranges.

    The ranges only divide the work: keys below `lower` or above `upper` fall into the first and last range.
    """
    source = f"(SELECT {', '.join(columns)} FROM {table}) t" if columns else table
    return {
        "url": url, "dbtable": source, "partitionColumn": key, "lowerBound": str(lower), "upperBound": str(upper),
        "numPartitions": str(partitions), "fetchsize": "10000", **extra,
    }


def read_jdbc(spark: SparkSession, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**options)).load()


def balanced_predicates(keys: DataFrame, key: str, partitions: int, accuracy: int = 100_000) -> list[str]:
    """Conditions that deal rows into ranges of about equally many rows each, whatever the key's distribution; together they hold for every row once.

    The bounds come from a sketch of the key over `keys`, such as an earlier copy of the table.  They only divide the work: rows
    the sketch has not seen, and those without a key, fall into some range too.  A single key is never divided.
    """
    cuts = keys.agg(F.percentile_approx(key, [i / partitions for i in range(1, partitions)], accuracy)).first()[0] if partitions > 1 else []
    bounds = sorted(set(cuts or []))
    name = f"`{key}`" if "`" not in key else key
    said = [repr(b) if isinstance(b, (int, float)) else f"'{b}'" for b in bounds]
    if not said:
        return ["1 = 1"]
    middle = [f"{name} > {low} AND {name} <= {high}" for low, high in zip(said, said[1:], strict=False)]
    return [f"{name} <= {said[0]} OR {name} IS NULL", *middle, f"{name} > {said[-1]}"]


def read_jdbc_balanced(spark: SparkSession, url: str, table: str, predicates: Sequence[str], **properties: str) -> DataFrame:
    """A database table, one task for each of `balanced_predicates`."""
    # Databases differ in how they quote names, so none is quoted.
    return spark.read.jdbc(url, table, predicates=[p.replace("`", "") for p in predicates], properties={"fetchsize": "10000", **properties})


def read_in_ranges(df: DataFrame, predicates: Sequence[str], alias: str = "range_number") -> DataFrame:
    """Rows with the number of the range that they fall in: the first condition that holds."""
    number = F.lit(None).cast("int")
    for i, predicate in reversed(list(enumerate(predicates))):
        number = F.when(F.expr(predicate), i).otherwise(number)
    return df.withColumn(alias, number)


def read_staged(spark: SparkSession, path: str, schema: StructType, first_run: bool = False) -> DataFrame:
    """A staged entity as a relation.  A missing folder is an error, lest a mistyped path loads everything again; only
    on the first run it may be missing, and the entity is empty."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if not first_run or missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_concept_dictionary(spark: SparkSession, path: str, header: Mapping[str, str] | None = None) -> DataFrame:
    """The concept dictionary from CSV with a header line.

    Columns are taken by position; `header` renames by name instead, from {file column: dictionary column}.
    Broken lines raise instead of turning into nulls.
    """
    schema = staged_schema("concept_dictionary")
    reader = spark.read.option("header", True).option("mode", "FAILFAST").option("escape", '"').option("multiLine", False)
    if header is None:
        return reader.schema(schema).csv(path)
    return reader.csv(path).select(*[F.col(f"`{name}`").cast("string").alias(alias) for name, alias in header.items()])


def read_concept_dictionary_or_reject(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The concept dictionary from CSV with a header line, and the lines that are none: (file, line, reason).

    Every line but the header is in one of the two, so a broken line neither ends the job nor turns into nulls.
    """
    schema = staged_schema("concept_dictionary")
    told = StructType([*schema, StructField(BROKEN, StringType())])
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("escape", '"').option("columnPruning", False)
    rows = reader.option("columnNameOfCorruptRecord", BROKEN).schema(told).csv(path).select(*told.names, F.col("_metadata.file_path").alias("file"))
    fields = F.size(F.split(F.col(BROKEN), ","))
    reason = F.when(F.pmod(F.length(F.regexp_replace(BROKEN, '[^"]', "")), F.lit(2)) == 1, "open quote").when(fields < len(schema), "too few fields").otherwise("too many fields")
    bad = F.col(BROKEN).isNotNull()
    # Spark does not read broken lines alone, so the other columns are asked for as well.
    fully = F.length(F.concat_ws("", *schema.names)) >= 0
    return rows.where(~bad).select(*schema.names), rows.where(bad & fully).select("file", F.col(BROKEN).alias("line"), reason.alias("reason"))


BROKEN = "_broken"
