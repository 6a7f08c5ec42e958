"""Bounded samples of labelled rows to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridtables.llm.common import staged

#: Labelled rows of each class that a classifier is fitted on at most.
PER_CLASS = 10_000


def labelled_sample(labels: DataFrame, id_col: str, label_col: str, usable: Column, per_class: int = PER_CLASS) -> DataFrame:
    """(id, label 0/1, weight): of each class the ``per_class`` ids that come first by hash, weighted to the class's share.

    Rows with a null id or another label are left out; an id with both labels is left out too, repeated rows count once.
    """
    rows = labels.where(usable & F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("label"), F.max(label_col).alias("high")).where("label = high")
    rows = staged(rows.select("id", F.col("label").cast("double").alias("label")))
    total = {r.label: r.n for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = [
        rows.where(F.col("label") == label).orderBy(F.xxhash64("id"), "id").limit(per_class)
        .withColumn("weight", F.lit(total.get(label, 0) / max(1, min(per_class, total.get(label, 0)))))
        for label in (0.0, 1.0)]
    return staged(parts[0].unionByName(parts[1]))
