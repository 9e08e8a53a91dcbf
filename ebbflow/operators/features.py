"""Model features from what is known at the reference month."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.functions import guarded_ratio, month_number, volume_band, year_number
from ebbflow.settings import REGIONAL, Study


def quarter(month_no: Column, as_label: bool = False) -> Column:
    number = F.ceil(month_no / 3).cast("int")
    return F.concat(F.lit("Q"), number.cast("string")) if as_label else number


def silver(modelling: DataFrame, study: Study = REGIONAL) -> DataFrame:
    """Strict column list, strict types: key, features and label, nothing else."""
    month_no = month_number("month_seq")
    angle = F.lit(2.0 * math.pi) * month_no / F.lit(12.0)
    total = F.col("n_total")
    columns = [
        F.col("month").cast("string").alias("month"),
        F.col("month_seq").cast("int").alias("month_seq"),
        *[F.col(c).cast("string").alias(c) for c in study.keys.profile],
        *[F.col(c).cast("bigint").alias(c) for c in ("n_total", "n_pos", "n_neg")],
        F.log1p(total.cast("double")).alias("log_volume"),
        guarded_ratio(F.col("n_neg"), total).alias("share_neg"),
        guarded_ratio(F.col("n_pos"), total).alias("share_pos"),
        volume_band(total, study.volume_edges, study.volume_labels).alias("volume_band"),
        year_number("month_seq").alias("year"),
        quarter(month_no, study.quarter_as_label).alias("quarter"),
    ]
    if study.month_as_category:
        columns.append(F.lpad(month_no.cast("string"), 2, "0").alias("month_no"))
    else:
        columns += [
            month_no.alias("month_no"),
            F.sin(angle).alias("month_sin"),
            F.cos(angle).alias("month_cos"),
        ]
    label = study.features.label
    return modelling.select(*columns, F.col(label).cast("int").alias(label))
