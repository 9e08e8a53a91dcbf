"""Everything that differs between two studies, as immutable values.

Operators take these objects (or plain arguments); none of them keeps state or
owns a session.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
MINIMUM_WAGE = 1412.0

UNKNOWN = "DESCONHECIDO"

# (inclusive upper age, label); below MIN_AGE or null is UNKNOWN.
MIN_AGE = 14
AGE_BANDS = (
    (17, "14-17"),
    (24, "18-24"),
    (34, "25-34"),
    (44, "35-44"),
    (54, "45-54"),
    (64, "55-64"),
)
OLDEST_BAND = "65+"

# (inclusive upper bound in minimum wages, label)
SALARY_BANDS = (
    (1, "ATE_1_SM"),
    (2, "1_A_2_SM"),
    (3, "2_A_3_SM"),
    (5, "3_A_5_SM"),
)
TOP_SALARY_BAND = "MAIS_DE_5_SM"

REGIONAL_CODES = (21, 22, 23, 24, 25, 26, 27, 28, 29)

REGION_LABELS = {
    21: "MA",
    22: "PI",
    23: "CE",
    24: "RN",
    25: "PB",
    26: "PE",
    27: "AL",
    28: "SE",
    29: "BA",
}

FILE_FAMILIES = ("MOV", "EXC", "FOR")
# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class CohortKeys:
    """The cohort key is `time` plus `profile`."""

    profile: tuple[str, ...] = ("region", "section", "age_band")
    time: str = "month_seq"

    @property
    def columns(self) -> tuple[str, ...]:
        return (self.time, *self.profile)


# Nested on purpose: every key extends the one before it, so coarser counts roll
# up from finer ones without touching the movements again.
KEY_A = ("month_seq", "region", "section", "age_band")
KEY_B = (*KEY_A, "occupation_group", "schooling")
KEY_C = (*KEY_B, "sex", "salary_band")
KEY_LADDER = {"A": KEY_A, "B": KEY_B, "C": KEY_C}


@dataclass(frozen=True)
class Outlook:
    """How far ahead to look and where to cut the indicator into two classes."""

    horizon: int = 6
    threshold_quantile: float = 0.5
    # "all": quantile over every eligible cohort; "train": only over the train part
    threshold_scope: str = "all"
    # drop reference months whose horizon has calendar months missing from the data
    require_complete_horizon: bool = False


@dataclass(frozen=True)
class FeatureSet:
    """Which silver columns enter the feature vector, and in which layout."""

    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    categorical_first: bool = True
    encoder_invalid: str = "error"
    label: str = "high_turnover"

    @property
    def columns(self) -> tuple[str, ...]:
        return (*self.categorical, *self.numeric)


@dataclass(frozen=True)
class Study:
    """One parameterisation of the whole analysis."""

    region_codes: tuple[int, ...] | None
    volume_edges: tuple[int, int]
    volume_labels: tuple[str, str, str]
    size_thresholds: tuple[int, ...]
    features: FeatureSet
    quarter_as_label: bool = False
    month_as_category: bool = False
    keys: CohortKeys = field(default_factory=CohortKeys)
    outlook: Outlook = field(default_factory=Outlook)


REGIONAL = Study(
    region_codes=REGIONAL_CODES,
    volume_edges=(20, 100),
    volume_labels=("PEQUENO", "MEDIO", "GRANDE"),
    size_thresholds=(10, 20, 50, 100),
    features=FeatureSet(
        categorical=("region", "section", "age_band", "volume_band"),
        numeric=(
            "n_total",
            "n_pos",
            "n_neg",
            "log_volume",
            "share_neg",
            "year",
            "month_no",
            "quarter",
            "month_sin",
            "month_cos",
        ),
    ),
)

NATIONAL = Study(
    region_codes=None,
    volume_edges=(25, 400),
    volume_labels=("PEQUENA", "MEDIA", "GRANDE"),
    size_thresholds=(20, 50, 100, 133),
    features=FeatureSet(
        categorical=("region", "section", "age_band", "volume_band", "month_no", "quarter"),
        numeric=("n_total", "n_pos", "n_neg", "log_volume", "share_neg", "year"),
        categorical_first=False,
        encoder_invalid="keep",
    ),
    quarter_as_label=True,
    month_as_category=True,
)
