"""S7/S8 as nested documents: one JSON object for each batch, written and read back with a schema.

The report tables are flat (a row for each batch, column or rule), which is what
Spark queries want. These functions fold them into the shape in which a report is
handed to others: scalars, a map of missing cells by column, a struct of
checks; an array of rule structs. Grouping is by batch, whose reports are bounded
by the number of columns or rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.columns import DEFAULT_COLUMNS, Columns

CHECKS = ("missing_ok", "duplicates_ok", "fraud_rate_ok")
QUALITY = (
    "batch_index int, n_rows long, missing struct<pct_total: double, per_column: map<string, long>>, "
    "duplicates struct<count: long, pct: double>, target struct<rate: double, positive: long, negative: long>, "
    "amount struct<mean: double, std: double>, balance struct<mean: double>, "
    "checks struct<missing_ok: boolean, duplicates_ok: boolean, fraud_rate_ok: boolean>, passed boolean"
)
RULES = (
    "batch_index int, n_rules int, rules array<struct<antecedents: array<string>, consequents: array<string>, antecedent_support: double, "
    "consequent_support: double, support: double, confidence: double, lift: double>>"
)


def quality_documents(report: DataFrame, missing: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """The quality report and the missing cells by column as one document for each batch."""
    cells = missing.groupBy(cols.batch).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("column_name", "missing_count")))).alias("per_column"))
    part = lambda **fields: F.struct(*[F.col(c).alias(name) for name, c in fields.items()])
    return report.join(cells, cols.batch, "left").select(
        cols.batch, "n_rows", part(pct_total="missing_pct_total", per_column="per_column").alias("missing"),
        part(count="duplicates_count", pct="duplicates_pct").alias("duplicates"),
        part(rate="fraud_rate", positive="fraud_count", negative="legit_count").alias("target"),
        part(mean="amount_mean", std="amount_std").alias("amount"), part(mean="balance_mean").alias("balance"),
        F.struct(*CHECKS).alias("checks"), "passed",
    )


def rule_documents(top: DataFrame, cols: Columns = DEFAULT_COLUMNS) -> DataFrame:
    """A batch's best rules as one document, the best first."""
    fields = ["antecedents", "consequents", "antecedent_support", "consequent_support", "support", "confidence", "lift"]
    ranked = top.groupBy(cols.batch).agg(F.array_sort(F.collect_list(F.struct("rank", *fields))).alias("r"))
    rules = F.transform("r", lambda x: F.struct(*[x[f].alias(f) for f in fields]))
    return ranked.select(cols.batch, F.size("r").alias("n_rules"), rules.alias("rules"))


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON object a line; empty fields are kept."""
    documents.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def read_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Stored documents by their schema, in batch order; a line that isn't such a document raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).orderBy("batch_index")
