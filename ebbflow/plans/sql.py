"""Shared common table expressions of the oracles."""

from __future__ import annotations


def month_of(seq: str) -> str:
    return f"CAST((({seq}) - 1) // 12 * 100 + (({seq}) - 1) % 12 + 1 AS VARCHAR)"


def age_band(age: str) -> str:
    return f"""CASE WHEN {age} IS NULL OR {age} < 14 THEN 'DESCONHECIDO'
      WHEN {age} BETWEEN 14 AND 17 THEN '14-17' WHEN {age} BETWEEN 18 AND 24 THEN '18-24'
      WHEN {age} BETWEEN 25 AND 34 THEN '25-34' WHEN {age} BETWEEN 35 AND 44 THEN '35-44'
      WHEN {age} BETWEEN 45 AND 54 THEN '45-54' WHEN {age} BETWEEN 55 AND 64 THEN '55-64'
      ELSE '65+' END"""


def salary_band(salary: str) -> str:
    return f"""CASE WHEN {salary} IS NULL OR {salary} <= 1412.0 THEN 'ATE_1_SM'
      WHEN {salary} <= 2824.0 THEN '1_A_2_SM' WHEN {salary} <= 4236.0 THEN '2_A_3_SM'
      WHEN {salary} <= 7060.0 THEN '3_A_5_SM' ELSE 'MAIS_DE_5_SM' END"""


def hash_percent(key: str, seed: int = 42) -> str:
    return f"(CAST('0x' || substr(md5({key} || '|{seed}'), 1, 8) AS BIGINT) % 100)"


COHORT_KEY = "CAST(month_seq AS VARCHAR) || '|' || region || '|' || section || '|' || age_band"

PROFILE = "region, section, age_band"

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "mv": (
        (),
        f"""SELECT *, {age_band("age")} AS age_band, {salary_band("salary")} AS salary_band,
      substr(occupation, 1, 2) AS occupation_group
    FROM (SELECT CAST(year(l_shipdate) * 12 + month(l_shipdate) AS INTEGER) AS month_seq,
        s_nationkey AS region, l_returnflag AS section,
        CAST(floor(l_quantity * 1.6) AS INTEGER) AS age, l_extendedprice / 10 AS salary,
        CAST(l_partkey AS VARCHAR) AS occupation, o_orderpriority AS schooling,
        l_linenumber % 2 AS sex, p_type AS movement_type,
        CASE l_linestatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 END AS balance
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
        LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey)""",
    ),
    "cohort": (
        ("mv",),
        f"""SELECT month_seq, {month_of("month_seq")} AS month, {PROFILE}, count(*) AS n_total,
      count(*) FILTER (WHERE balance = 1) AS n_pos,
      count(*) FILTER (WHERE balance = -1) AS n_neg
    FROM mv GROUP BY ALL""",
    ),
    # stated as a range join, not as the range frame the Spark plan uses
    "windowed": (
        ("cohort",),
        """SELECT c.month_seq, c.month, c.region, c.section, c.age_band,
      c.n_total, c.n_pos, c.n_neg,
      CAST(coalesce(sum(f.n_total), 0) AS BIGINT) AS n_total_6m,
      CAST(coalesce(sum(f.n_pos), 0) AS BIGINT) AS n_pos_6m,
      CAST(coalesce(sum(f.n_neg), 0) AS BIGINT) AS n_neg_6m,
      count(f.month_seq) AS months_active,
      CASE WHEN coalesce(sum(f.n_total), 0) > 0 THEN sum(f.n_neg) / sum(f.n_total)
        ELSE 0.0 END AS share_neg_6m,
      count(f.month_seq) > 0 AS has_future
    FROM cohort c LEFT JOIN cohort f ON f.region = c.region AND f.section = c.section
      AND f.age_band = c.age_band AND f.month_seq > c.month_seq
      AND f.month_seq <= c.month_seq + 6
    GROUP BY c.month_seq, c.month, c.region, c.section, c.age_band,
      c.n_total, c.n_pos, c.n_neg""",
    ),
    "eligible": (
        ("windowed", "months"),
        """SELECT w.*, (SELECT CAST(count(*) AS INTEGER) FROM months m
        WHERE m.month_seq > w.month_seq AND m.month_seq <= w.month_seq + 6) AS months_observed
    FROM windowed w WHERE w.month_seq <= (SELECT max(month_seq) FROM months) - 6""",
    ),
    "months": (("mv",), "SELECT DISTINCT month_seq FROM mv"),
    "labelled": (
        ("eligible",),
        """SELECT *, CASE WHEN share_neg_6m > (SELECT quantile_disc(share_neg_6m, 0.5)
        FROM eligible) THEN 1 ELSE 0 END AS high_turnover FROM eligible""",
    ),
    "modelling": (
        ("labelled",),
        f"""SELECT month, month_seq, {PROFILE}, n_total, n_pos, n_neg, high_turnover
    FROM labelled""",
    ),
    "silver": (
        ("modelling",),
        """SELECT month, month_seq, CAST(region AS VARCHAR) AS region, section, age_band,
      CAST(n_total AS BIGINT) AS n_total, CAST(n_pos AS BIGINT) AS n_pos,
      CAST(n_neg AS BIGINT) AS n_neg, round(ln(1 + n_total), 9) AS log_volume,
      n_neg / n_total AS share_neg, n_pos / n_total AS share_pos,
      CASE WHEN n_total <= 20 THEN 'PEQUENO' WHEN n_total <= 100 THEN 'MEDIO'
        ELSE 'GRANDE' END AS volume_band,
      CAST(substr(month, 1, 4) AS INTEGER) AS year,
      CAST(ceil(CAST(substr(month, 5, 2) AS INTEGER) / 3) AS INTEGER) AS quarter,
      CAST(substr(month, 5, 2) AS INTEGER) AS month_no,
      round(sin(2 * pi() * CAST(substr(month, 5, 2) AS INTEGER) / 12), 9) AS month_sin,
      round(cos(2 * pi() * CAST(substr(month, 5, 2) AS INTEGER) / 12), 9) AS month_cos,
      high_turnover
    FROM modelling""",
    ),
    "parts": (
        ("silver",),
        f"""SELECT *, CASE WHEN {hash_percent(COHORT_KEY)} < 70 THEN 'train' ELSE 'test' END
      AS part FROM silver""",
    ),
    "pred": (
        ("parts",),
        """SELECT *, share_neg AS score, CASE WHEN share_neg > 0.5 THEN 1 ELSE 0 END AS prediction
    FROM parts WHERE part = 'test'""",
    ),
    "occ": (
        ("mv",),
        f"""SELECT *, CAST(sum(n_group) OVER (PARTITION BY month_seq, {PROFILE}) AS BIGINT)
      AS n_cohort, n_group / sum(n_group) OVER (PARTITION BY month_seq, {PROFILE}) AS share
    FROM (SELECT month_seq, {PROFILE}, occupation_group, count(*) AS n_group
      FROM mv GROUP BY ALL)""",
    ),
    "dominant": (
        ("occ",),
        f"""SELECT * FROM occ QUALIFY row_number() OVER (PARTITION BY month_seq, {PROFILE}
      ORDER BY n_group DESC, occupation_group) = 1""",
    ),
    "occ_label": (
        ("dominant", "labelled"),
        f"""SELECT month_seq, {PROFILE}, n_total, high_turnover, occupation_group, n_group,
      n_cohort, share FROM labelled JOIN dominant USING (month_seq, {PROFILE})""",
    ),
    "raw": (
        (),
        """SELECT year(l_shipdate) * 100 + month(l_shipdate) AS comp, s_nationkey AS region,
      CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN NULL ELSE l_returnflag END
        AS section,
      CAST(floor(l_quantity * 1.6) AS INTEGER) AS age, l_linenumber,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
      CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN NULL
        WHEN l_linestatus = 'O' THEN 1 ELSE -1 END AS balance
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    ),
}


def oracle(body: str, *needs: str) -> str:
    """`body` under the named expressions and everything they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for parent in CTES[name][0]:
                visit(parent)
            ordered.append(name)

    for name in needs:
        visit(name)
    parts = [f"{name} AS ({CTES[name][1]})" for name in ordered]
    return (f"WITH {', '.join(parts)} " if parts else "") + body
