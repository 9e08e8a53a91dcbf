"""ebbflow: cohort turnover analytics on Spark DataFrames."""

from ebbflow.settings import NATIONAL, REGIONAL, CohortKeys, FeatureSet, Outlook, Study

__all__ = ["NATIONAL", "REGIONAL", "CohortKeys", "FeatureSet", "Outlook", "Study"]
