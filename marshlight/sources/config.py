"""Configuration as small DataFrames: indicator definitions, metadata, code labels, groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[Sequence], names: Sequence[str]) -> DataFrame:
    """A driver-side list of text rows as a table whose size the optimizer can see.

    Made from an Arrow table, which Spark keeps as a local relation: joins with facts are broadcast by
    Spark's own size rule and never shuffle the facts on a handful of keys.
    """
    columns = list(zip(*rows)) or [()] * len(names)
    text = [pa.array([None if v is None else str(v) for v in c], pa.string()) for c in columns]
    return spark.createDataFrame(pa.Table.from_arrays(text, names=list(names)))


def indicator_map(spark: SparkSession, definitions: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (INDICATOR, DX, CO): one per element id of a definition; `DX.CO` names one category.

    An indicator with an empty definition keeps one row with null DX, so its name is not lost.
    """
    rows = [(name, raw) for name, ids in definitions.items() for raw in (list(ids) or [None])]
    return split_definitions(literal_table(spark, rows, ["INDICATOR", "RAW"]))


def split_definitions(raw: DataFrame, col: str = "RAW") -> DataFrame:
    parts = F.split(F.col(col), r"\.")
    return raw.select(
        "INDICATOR",
        F.get(parts, F.lit(0)).alias("DX"),
        F.get(parts, F.lit(1)).alias("CO"),
    )


def element_ids(mapping: DataFrame) -> DataFrame:
    """Distinct element ids, categories dropped."""
    return mapping.filter("DX is not null").select("DX").distinct()


def metadata_table(spark: SparkSession, metadata: Mapping[str, Mapping[str, object]]) -> DataFrame:
    """One row per output variable; every attribute as text, in the order given."""
    attributes = list(dict.fromkeys(k for v in metadata.values() for k in v))
    rows = [(name, *[None if v.get(a) is None else str(v[a]) for a in attributes])
            for name, v in metadata.items()]
    return literal_table(spark, rows, ["VARIABLE", *[a.upper() for a in attributes]])


def update_metadata(meta: DataFrame, updates: DataFrame, attribute: str = "PERIOD") -> DataFrame:
    """Set `attribute` of the variables in `updates(VARIABLE, <attribute>)`, keep the rest.

    A name that is not in the table raises when the result is computed.
    """
    known = meta.withColumns({"_known": F.lit(True), "_new": F.lit(None).cast("string")})
    new = updates.select("VARIABLE", F.lit(False).alias("_known"), F.col(attribute).cast("string").alias("_new"))
    rest = [c for c in meta.columns if c != "VARIABLE"]
    both = known.unionByName(new, allowMissingColumns=True).groupBy("VARIABLE").agg(
        F.max("_known").alias("_known"), F.max("_new").alias("_new"), *[F.max(c).alias(c) for c in rest])
    checked = F.when(F.col("_known"), F.coalesce("_new", attribute)).otherwise(
        F.raise_error(F.concat(F.lit("unknown variable: "), F.col("VARIABLE"))))
    return both.withColumn(attribute, checked).select(*meta.columns)


def code_labels(df: DataFrame, code: str, label: str, code_name: str, label_name: str) -> DataFrame:
    """Label dimension of a coded survey column."""
    return df.select(F.col(label).alias(label_name), F.col(code).cast("int").alias(code_name)).distinct()


def metric_names(mapping: Mapping[str, str], ids: Column | str) -> Column:
    """Metric id to metric name, null when unknown; the map is a driver constant."""
    lookup = F.create_map(*[F.lit(x) for k, v in mapping.items() for x in (v, k)])
    return F.try_element_at(lookup, F.col(ids) if isinstance(ids, str) else ids)


def group_members(groups: DataFrame, names: Sequence[str] | None = None, members: str = "organisation_units",
                  ) -> DataFrame:
    """One row per group and unit; group names compared in lower case."""
    if names is not None:
        groups = groups.filter(F.lower("name").isin([n.lower() for n in names]))
    return groups.select("id", "name", F.explode(members).alias("OU_ID"))
