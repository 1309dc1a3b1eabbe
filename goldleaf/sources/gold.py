"""The output table: a catalog table in buckets of its key, to which upserts append.

Every row carries the time its upsert began, and of several rows with one key the last one counts. So an
upsert compares nothing and rewrites nothing: it is one append, which Spark commits as a whole or not at
all, and a repeated one changes no result. Rows of a key always share a bucket. Reading the current rows and joining with
the keys therefore go bucket by bucket, without a shuffle of the table, and read only the columns asked for.
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.operators.unique import one_per
from goldleaf.schemas import ENTITY_COLUMNS, GOLD, UNKNOWN_MODEL
from goldleaf.session import scratch, settings

#: When the upsert of a row began, in nanoseconds.
STAMP = "_upserted"
#: A task holds the rows of one bucket, so it needs one open file, and no sort by bucket before it.
UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": "1"}


def align(df: DataFrame, schema: T.StructType = GOLD) -> DataFrame:
    """The schema's columns by name: missing ones null, lists empty, others dropped, types cast.

    Records as single agents leave them, with tokens and model per agent, get their sum and their first
    model; without either 0 and `unknown`. Values that are there win.
    """
    have = set(df.columns)
    per_agent = {
        "tokens_used": sum((F.coalesce(c, F.lit(0)) for c in df.columns if c.endswith("_tokens_used")), F.lit(0)),
        "model_used": F.coalesce(
            *[F.nullif(F.col(c), F.lit("")) for c in df.columns if c.endswith("_model")], F.lit(UNKNOWN_MODEL)
        ),
    }

    def column(f: T.StructField) -> Column:
        value = (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType)
        if f.name in per_agent:
            value = F.coalesce(value, per_agent[f.name].cast(f.dataType))
        if isinstance(f.dataType, T.ArrayType):
            value = F.coalesce(value, F.array().cast(f.dataType))
        return value.alias(f.name)

    return df.select(*[column(f) for f in schema])


def with_json_lists(gold: DataFrame) -> DataFrame:
    """Entity lists as JSON text, for consumers that want them so."""
    empty = F.array().cast("array<string>")
    return gold.withColumns({c: F.to_json(F.coalesce(F.col(c), empty)) for c in ENTITY_COLUMNS})


class GoldTable:
    """Upsert table with a name in the catalog, keyed by `id_col`.

    It is made by the first upsert, under `location` if that is given and where the catalog keeps its tables otherwise. A
    location that holds such a table already is taken up; the bucket count has to be the one it was made with.
    """

    def __init__(
        self,
        spark: SparkSession,
        name: str,
        id_col: str = "review_id",
        schema: T.StructType = GOLD,
        buckets: int = 64,
        location: str | None = None,
    ) -> None:
        self.spark = spark
        self.name = name
        self.id_col = id_col
        self.schema = schema
        self.buckets = buckets
        self.location = location

    def create(self) -> None:
        """The schema and the table, where they do not exist yet."""
        if "." in self.name:
            self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.name.rsplit('.', 1)[0]}")
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(columns)}, {STAMP} bigint) USING parquet "
            f"CLUSTERED BY (`{self.id_col}`) INTO {self.buckets} BUCKETS" + (f" LOCATION '{self.location}'" if self.location else "")
        )

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def _rows(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema).withColumn(STAMP, F.lit(None).cast("bigint"))
        # Another session may have appended to it.
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def read(self) -> DataFrame:
        """The current rows; none while nothing has been written."""
        last = Window.partitionBy(self.id_col).orderBy(F.desc(STAMP))
        return self._rows().withColumn("_nth", F.row_number().over(last)).where(F.col("_nth") == 1).select(self.schema.names)

    def ids(self) -> DataFrame:
        """The keys; one that was replaced more than once."""
        return self._rows().select(self.id_col)

    def count(self) -> int:
        """Number of keys; 0 while nothing has been written."""
        return self.ids().distinct().count()

    def upsert_one(self, record: dict) -> int:
        more = [T.StructField(k, T.IntegerType()) for k in record if k.endswith("_tokens_used")]
        more += [T.StructField(k, T.StringType()) for k in record if k.endswith("_model")]
        kind = T.StructType([*self.schema.fields, *more])
        row = [tuple(record.get(f.name) for f in kind)]
        return self.upsert(self.spark.createDataFrame(row, kind))

    def upsert(self, batch: DataFrame, unique: bool = False) -> int:
        """Insert or replace rows by id; returns the number of rows written.

        `unique` says that the batch holds no id twice. The rows are shuffled by bucket, so that a
        task writes one file of one bucket, and counted while they are written.
        """
        rows = align(batch, self.schema)
        key = F.coalesce(F.col(self.id_col), F.raise_error(F.lit(f"{self.id_col} is null")))
        rows = rows.withColumn(self.id_col, key.cast(self.schema[self.id_col].dataType))
        if not unique:
            order = ["enriched_at"] if "enriched_at" in self.schema.names else []
            rows = one_per(rows, [self.id_col], order)
        self.create()
        written = Observation()
        stamped = rows.withColumn(STAMP, F.lit(time.time_ns())).repartition(self.buckets, self.id_col)
        with settings(batch.sparkSession, UNSORTED):
            stamped.observe(written, F.count("*").alias("n")).write.insertInto(self.name)
        return written.get["n"]


def scratch_gold(spark: SparkSession, buckets: int = 64, **options) -> GoldTable:
    """An output table of its own in the shared folder."""
    path = scratch(spark, "gold")
    return GoldTable(spark, path.rsplit("/", 1)[-1].replace("-", "_"), buckets=buckets, location=path, **options)
