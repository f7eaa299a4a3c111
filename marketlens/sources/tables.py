"""Tables: the named DataFrames an analysis reads.

A `Tables` holds lazy builders; asking for ``t.customers`` builds the
DataFrame (a plan, not data) once and keeps it. Sources:

  * ``Tables.from_testdata``: adapter views over the driver's TPC-H-like
    parquet tables (see ``sources/testdata.py``)
  * ``Tables.from_shop_csv`` / ``from_marketplace_csv``: the reference's
    CSV layouts, read with fixed schemas (no inference)
  * ``Tables.from_parquet``: any folder of ``<name>.parquet`` datasets,
    e.g. a star layer written by ``plans.warehouse.write_star``

Star tables (``dim_*``, ``fact_*``) that are not supplied are derived from
the raw marketplace tables by the warehouse ETL on first use.
"""

from __future__ import annotations

import os
import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from marketlens.sources import schemas, testdata

_RECORD = "_record"  # the text of a record that does not fit


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any store that Spark reads."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return [f.getPath().getName() for f in
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]


class Tables:
    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[], DataFrame]] | None = None):
        self.spark = spark
        self._builders: dict[str, Callable[[], DataFrame]] = dict(builders or {})
        self._built: dict[str, DataFrame] = {}
        self.materialize_star = False

    # -- access -------------------------------------------------------------
    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            builder = self._builders.get(name)
            if builder is None:
                builder = self._derived(name)
            if builder is None:
                raise KeyError(f"table {name!r} is not available")
            self._built[name] = builder()
        return self._built[name]

    def __contains__(self, name: str) -> bool:
        return name in self._builders or self._derived(name) is not None

    def register(self, name: str, df_or_builder) -> "Tables":
        if isinstance(df_or_builder, DataFrame):
            self._built[name] = df_or_builder
            self._builders[name] = lambda d=df_or_builder: d
        else:
            self._builders[name] = df_or_builder
            self._built.pop(name, None)
        return self

    def _derived(self, name: str):
        """Star tables not supplied are built from the raw layer on first use.

        By default they stay plans, so each report prunes the ETL to the
        columns it needs. With ``materialize_star = True`` (for a `Tables`
        that serves many reports) each derived table is built once and
        checkpointed to the cluster's checkpoint folder instead; for a single
        report that loses column pruning and measured slower.
        """
        if name in schemas.STAR:
            from marketlens.plans import warehouse
            from marketlens.session import ensure_checkpoint_dir

            def build():
                df = warehouse.STAR_BUILDERS[name](self)
                if not self.materialize_star:
                    return df
                ensure_checkpoint_dir(self.spark)
                return df.checkpoint(eager=True)
            return build
        return None

    # -- constructors -------------------------------------------------------
    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str) -> "Tables":
        base_cache: dict[str, DataFrame] = {}

        def base() -> dict[str, DataFrame]:
            if not base_cache:
                for t in testdata.BASE_TABLES:
                    base_cache[t] = (spark.read.schema(testdata.BASE_SCHEMAS[t])
                                     .parquet(os.path.join(sf_dir, f"{t}.parquet")))
            return base_cache

        builders = {name: (lambda n=name: testdata.build_view(spark, base(), n))
                    for name in testdata.VIEWS}
        # the shop analyses call the orders table "orders"
        builders["orders"] = builders.pop("shop_orders")
        return cls(spark, builders)

    @classmethod
    def from_shop_csv(cls, spark: SparkSession, folder: str) -> "Tables":
        def reader(name: str):
            def build():
                df = (spark.read.schema(schemas.SHOP[name]).option("header", True)
                      .option("mode", "FAILFAST").csv(os.path.join(folder, f"{name}.csv")))
                if name == "order_items":
                    df = df.withColumn("line_revenue", F.col("quantity") * F.col("unit_price"))
                return df
            return build
        return cls(spark, {n: reader(n) for n in schemas.SHOP})

    @classmethod
    def from_marketplace_csv(cls, spark: SparkSession, folder: str, files: dict[str, str] | None = None,
                             rejects: bool = False) -> "Tables":
        """Raw marketplace export. Empty text reads as null; quoted texts may hold
        doubled quotes, those of the reviews also line breaks (that file is read
        whole, all others in splits). Files are found by name
        (`schemas.raw_file_names`); ``files`` maps raw tables to other names.

        A record that does not fit its columns is an error; with ``rejects`` it is
        left out of its table instead and kept in the table ``rejects``
        (table_name, record), which `warehouse.integrity_report` counts.
        """
        names = {**schemas.RAW_FILES, **schemas.raw_file_names(_listed(spark, folder)), **(files or {})}

        def read(name: str):
            r = (spark.read.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
                 .option("emptyValue", None).option("nullValue", "").option("escape", '"')
                 .option("multiLine", name in schemas.MULTILINE))
            path = os.path.join(folder, names[name])
            if not rejects:
                return r.schema(schemas.RAW[name]).option("mode", "FAILFAST").csv(path)
            return (r.schema(StructType([*schemas.RAW[name].fields, StructField(_RECORD, StringType())]))
                    .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _RECORD)
                    .csv(path))

        def parted(name: str, fits: bool) -> DataFrame:
            df = read(name)
            # a condition that is always true and names all columns: a scan of some of them would
            # only see what is bad in those, and one of the record column alone is refused
            whole = F.xxhash64(*schemas.RAW[name].names) % 2 < 2
            return df.where((F.col(_RECORD).isNull() if fits else F.col(_RECORD).isNotNull()) & whole)

        def good(name: str):
            return lambda: parted(name, True).drop(_RECORD) if rejects else read(name)

        def bad() -> DataFrame:
            parts = [parted(n, False).select(F.lit(n).alias("table_name"), F.col(_RECORD).alias("record"))
                     for n in schemas.RAW if n in present]
            return reduce(DataFrame.unionByName, parts)

        present = {*schemas.raw_file_names(_listed(spark, folder)), *(files or {})}
        return cls(spark, {n: good(n) for n in schemas.RAW} | ({"rejects": bad} if rejects else {}))

    @classmethod
    def from_sales_csv(cls, spark: SparkSession, path: str) -> "Tables":
        """A flat file of sales transactions (`schemas.SALES`)."""
        return cls(spark, {"sales": lambda: (spark.read.schema(schemas.SALES).option("header", True)
                                             .option("mode", "FAILFAST").csv(path))})

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str, names=None) -> "Tables":
        """``<name>.parquet`` datasets below ``folder``, in any store that Spark reads.

        Without ``names`` the folder is listed through Spark's file system."""
        if names is None:
            names = [n[:-len(".parquet")] for n in _listed(spark, folder) if n.endswith(".parquet")]
        return cls(spark, {n: (lambda n=n: spark.read.parquet(os.path.join(folder, f"{n}.parquet")))
                           for n in names})

    @classmethod
    def from_catalog(cls, spark: SparkSession, prefix: str = "star_") -> "Tables":
        """The star tables that `warehouse.save_star` has put into the catalog."""
        return cls(spark, {n: (lambda n=n: spark.table(prefix + n)) for n in schemas.STAR
                           if spark.catalog.tableExists(prefix + n)})

    def create_views(self, names=None) -> None:
        """Temporary views of the tables (all that were supplied, or ``names``), for `sql`."""
        for name in names or self._builders:
            self[name].createOrReplaceTempView(name)

    def sql(self, text: str, **params) -> DataFrame:
        """A query over the tables: ``{name}`` stands for a table, ``:name`` for a parameter's value."""
        used = {f for _, f, _, _ in string.Formatter().parse(text) if f}
        return self.spark.sql(text, args=params or None, **{n: self[n] for n in used})
