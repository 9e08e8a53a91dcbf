"""The column names of the published tables, to and from the library's."""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values -------------------------------------------------------------
PUBLISHED_NAMES = {
    "month": "competênciamov",
    "region": "uf",
    "section": "seção",
    "age": "idade",
    "schooling": "graudeinstrução",
    "occupation": "cbo2002ocupação",
    "sex": "sexo",
    "salary": "salário",
    "balance": "saldomovimentação",
    "category": "categoria",
    "age_band": "FAIXA_ETARIA",
    "salary_band": "FAIXA_SALARIAL",
    "occupation_group": "GRUPO_CBO",
    "n_total": "N_TOTAL_T",
    "n_pos": "N_POSITIVOS_T",
    "n_neg": "N_NEGATIVOS_T",
    "n_total_6m": "N_TOTAL_6M",
    "n_pos_6m": "N_POSITIVOS_6M",
    "n_neg_6m": "N_NEGATIVOS_6M",
    "share_neg_6m": "PROP_NEGATIVOS_6M",
    "high_turnover": "ALTA_ROTATIVIDADE_6M",
    "log_volume": "LOG_VOLUME_COORTE",
    "share_neg": "PROP_NEGATIVOS_T",
    "share_pos": "PROP_POSITIVOS_T",
    "volume_band": "FAIXA_VOLUME_COORTE",
    "year": "ANO",
    "month_no": "MES",
    "quarter": "TRIMESTRE",
    "month_sin": "MES_SIN",
    "month_cos": "MES_COS",
    "n_group": "N_CBO",
    "n_cohort": "N_TOTAL_COORTE",
    "share": "SHARE_CBO_DOMINANTE",
}

NATIONAL_NAMES = {
    **PUBLISHED_NAMES,
    "volume_band": "FAIXA_VOLUME_T",
    "year": "COMPONENTE_ANO",
    "month_no": "COMPONENTE_MES",
}
# ------------------------------------------------------------------------------


def to_published(df: DataFrame, names: dict[str, str] = PUBLISHED_NAMES) -> DataFrame:
    """Rename the columns that have a published name; the others stay."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def from_published(df: DataFrame, names: dict[str, str] = PUBLISHED_NAMES) -> DataFrame:
    """The reverse, for tables written under the published names."""
    return df.withColumnsRenamed({v: k for k, v in names.items() if v in df.columns})
