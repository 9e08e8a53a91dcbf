"""Dominant occupation of a cohort and its turnover."""

from __future__ import annotations

from ebbflow.operators import occupation as oc
from ebbflow.operators.cohorts import fine_counts, roll_up
from ebbflow.plans.registry import query
from ebbflow.plans.sql import PROFILE, oracle
from ebbflow.plans.stages import label_cohorts
from ebbflow.settings import REGIONAL
from ebbflow.sources.layers import materialise
from ebbflow.sources.samples import movements

COLUMNS = ("month_seq", "region", "section", "age_band", "occupation_group", "balance")


def _counts(spark, sf_dir):
    return fine_counts(movements(spark, sf_dir, COLUMNS), ["occupation_group"])


def _both(spark, sf_dir):
    """Labelled cohorts and dominant occupations from one pass over the movements."""
    counts = materialise(_counts(spark, sf_dir), "occupation_counts")
    labelled = label_cohorts(roll_up(counts))
    return labelled.table, oc.dominant_occupation(counts)


def _joined(spark, sf_dir):
    return oc.dominant_join(*_both(spark, sf_dir))


@query("occupation_share", oracle("SELECT * FROM occ", "occ"))
def occupation_share(spark, sf_dir):
    return oc.occupation_share(_counts(spark, sf_dir))


@query("dominant_occupation", oracle("SELECT * FROM dominant", "dominant"))
def dominant_occupation(spark, sf_dir):
    return oc.dominant_occupation(_counts(spark, sf_dir))


@query("dominant_join", oracle("SELECT * FROM occ_label", "occ_label"))
def dominant_join(spark, sf_dir):
    return _joined(spark, sf_dir)


@query(
    "dominance_quantiles",
    oracle(
        "SELECT 'share' AS metric, "
        + ", ".join(
            f"quantile_disc(share, {p}) AS {name}" for name, p in oc.DOMINANCE_QUANTILES.items()
        )
        + " FROM occ_label",
        "occ_label",
    ),
)
def dominance_quantiles(spark, sf_dir):
    joined = materialise(_joined(spark, sf_dir), "dominant")
    return oc.dominance_quantiles(joined)


def _rates(by: str, minimum: int, top: int) -> str:
    return oracle(
        f"""SELECT {by}, count(*) AS n_cohorts,
        count(*) FILTER (WHERE high_turnover = 1) AS n_class_1,
        count(*) FILTER (WHERE high_turnover = 0) AS n_class_0,
        round(count(*) FILTER (WHERE high_turnover = 1) / count(*) * 100, 6) AS pct_class_1,
        round(avg(share) * 100, 6) AS mean_share_pct, CAST(sum(n_total) AS BIGINT) AS volume
        FROM occ_label GROUP BY {by} HAVING count(*) >= {minimum}
        ORDER BY pct_class_1 DESC, {by} LIMIT {top}""",
        "occ_label",
    )


@query("occupation_rate", _rates("occupation_group", 50, 10))
def occupation_rate(spark, sf_dir):
    return oc.occupation_rate(_joined(spark, sf_dir))


@query("occupation_section_rate", _rates("occupation_group, section", 30, 15))
def occupation_section_rate(spark, sf_dir):
    return oc.occupation_rate(_joined(spark, sf_dir), ("occupation_group", "section"), 30, 15)


@query("occupation_region_rate", _rates("occupation_group, region", 30, 10))
def occupation_region_rate(spark, sf_dir):
    return oc.occupation_rate(_joined(spark, sf_dir), ("occupation_group", "region"), 30, 10)


def _fanout(keys: str) -> str:
    return oracle(
        f"""SELECT CAST(sum(l) AS BIGINT) AS rows_left, CAST(sum(r) AS BIGINT) AS rows_right,
        CAST(sum(l * r) AS BIGINT) AS rows_joined,
        CAST(coalesce(sum(l) FILTER (WHERE r = 0), 0) AS BIGINT) AS rows_left_unmatched,
        max(r) AS max_matches_per_row,
        sum(l * r) > coalesce(sum(l) FILTER (WHERE r > 0), 0) AS multiplies
        FROM (SELECT coalesce(a.n, 0) AS l, coalesce(b.n, 0) AS r FROM
          (SELECT {keys}, count(*) AS n FROM labelled GROUP BY {keys}) a FULL JOIN
          (SELECT {keys}, count(*) AS n FROM dominant GROUP BY {keys}) b USING ({keys}))""",
        "labelled",
        "dominant",
    )


@query("join_fanout_audit", _fanout("month_seq, region, section"))
def join_fanout_audit(spark, sf_dir):
    """The age band left out of the key: the join multiplies cohorts."""
    return oc.join_fanout_audit(*_both(spark, sf_dir), ["month_seq", "region", "section"])


@query("join_fanout_audit_full_key", _fanout(f"month_seq, {PROFILE}"))
def join_fanout_audit_full_key(spark, sf_dir):
    return oc.join_fanout_audit(*_both(spark, sf_dir), REGIONAL.keys.columns)
