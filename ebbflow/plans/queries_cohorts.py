"""Counting: months, regions, cohorts and their forward windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.functions import age_band, month_label, month_number, salary_band, year_number
from ebbflow.operators import cohorts as co
from ebbflow.operators import horizon as ho
from ebbflow.operators import occupation as oc
from ebbflow.operators import profiling as pr
from ebbflow.operators.cleaning import in_regions, rejected_counts, valid_movements
from ebbflow.plans.registry import query
from ebbflow.plans.sql import PROFILE, age_band as sql_age, month_of, oracle, salary_band as sql_salary
from ebbflow.plans.stages import cohorts_of, windowed_stage
from ebbflow.settings import KEY_C, REGIONAL_CODES
from ebbflow.sources.layers import materialise
from ebbflow.sources.samples import movements, order_movements, table

SIZE_THRESHOLDS = (2, 5, 10, 20, 50, 100)


def _months(spark, sf_dir):
    """One row per month present, counted once."""
    counted = co.records_per_month(movements(spark, sf_dir, ["month_seq"]))
    return materialise(counted, "months")


@query(
    "records_per_month",
    oracle(
        f"SELECT {month_of('month_seq')} AS month, month_seq, count(*) AS n_rows FROM mv GROUP BY month_seq",
        "mv",
    ),
)
def records_per_month(spark, sf_dir):
    return co.records_per_month(movements(spark, sf_dir, ["month_seq"]))


@query(
    "month_ordinal",
    oracle(
        """SELECT strftime(o_orderdate, '%Y%m') AS month, CAST(year(o_orderdate) AS INTEGER) AS year,
        CAST(month(o_orderdate) AS INTEGER) AS month_no,
        CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month_seq,
        count(*) AS n_rows FROM orders GROUP BY ALL"""
    ),
)
def month_ordinal(spark, sf_dir):
    months = order_movements(spark, sf_dir).groupBy("month_seq").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return months.select(
        month_label("month_seq").alias("month"),
        year_number("month_seq").alias("year"),
        month_number("month_seq").alias("month_no"),
        "month_seq",
        "n_rows",
    )


@query(
    "month_coverage",
    oracle(
        f"""SELECT {month_of('s')} AS month, CAST(s AS INTEGER) AS month_seq,
        coalesce(n, 0) AS n_rows, n IS NOT NULL AS present
        FROM range((SELECT min(month_seq) FROM mv), (SELECT max(month_seq) FROM mv) + 1) r(s)
        LEFT JOIN (SELECT month_seq, count(*) AS n FROM mv GROUP BY 1) ON s = month_seq""",
        "mv",
    ),
)
def month_coverage(spark, sf_dir):
    return co.month_coverage(_months(spark, sf_dir))


@query(
    "region_year_counts",
    oracle(
        """SELECT region, n_name AS region_name, year, n_rows FROM (
        SELECT region, CAST((month_seq - 1) // 12 AS INTEGER) AS year, count(*) AS n_rows
        FROM mv GROUP BY CUBE (region, year)) LEFT JOIN nation ON region = n_nationkey""",
        "mv",
    ),
)
def region_year_counts(spark, sf_dir):
    labels = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("region"), F.col("n_name").alias("region_name")
    )
    return co.region_year_counts(movements(spark, sf_dir, ["month_seq", "region"]), labels)


@query(
    "region_filter",
    oracle(
        """SELECT region, count(*) AS n_rows, count(*) FILTER (WHERE balance = -1) AS n_neg
        FROM mv WHERE region IN (21, 22, 23, 24, 25, 26, 27, 28, 29) GROUP BY region""",
        "mv",
    ),
)
def region_filter(spark, sf_dir):
    kept = in_regions(movements(spark, sf_dir, ["region", "balance"]), REGIONAL_CODES)
    return kept.groupBy("region").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("balance") == -1).alias("n_neg")
    )


ORDER_SIGN = "CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'F' THEN -1 ELSE 0 END"


@query(
    "valid_movements",
    f"""SELECT CAST(year(o_orderdate) * 12 + month(o_orderdate) AS INTEGER) AS month_seq,
    count(*) AS n_rows, count(*) FILTER (WHERE {ORDER_SIGN} = 1) AS n_pos
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_nationkey IS NOT NULL AND c_mktsegment IS NOT NULL AND {ORDER_SIGN} IN (1, -1)
    GROUP BY 1""",
)
def valid(spark, sf_dir):
    rows = valid_movements(order_movements(spark, sf_dir))
    return rows.groupBy("month_seq").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("balance") == 1).alias("n_pos")
    )


@query(
    "rejected_movements",
    f"""SELECT CASE WHEN c_nationkey IS NULL THEN 'region' WHEN c_mktsegment IS NULL THEN 'section'
    WHEN {ORDER_SIGN} NOT IN (1, -1) THEN 'balance' ELSE 'valid' END AS reason, count(*) AS n
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
)
def rejected(spark, sf_dir):
    return rejected_counts(order_movements(spark, sf_dir))


@query(
    "age_band",
    oracle(
        f"SELECT age, {sql_age('age')} AS age_band, count(*) AS n_rows FROM mv GROUP BY ALL", "mv"
    ),
)
def age_bands(spark, sf_dir):
    ages = movements(spark, sf_dir, ["age"]).groupBy("age").agg(F.count(F.lit(1)).alias("n_rows"))
    return ages.select("age", age_band(F.col("age")).alias("age_band"), "n_rows")


@query(
    "salary_band",
    oracle(
        f"""SELECT {sql_salary('salary')} AS salary_band, count(*) AS n_rows,
        min(salary) AS lowest, max(salary) AS highest FROM mv GROUP BY 1""",
        "mv",
    ),
)
def salary_bands(spark, sf_dir):
    return (
        movements(spark, sf_dir, ["salary"])
        .groupBy(salary_band(F.col("salary")).alias("salary_band"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.min("salary").alias("lowest"),
            F.max("salary").alias("highest"),
        )
    )


@query(
    "occupation_group",
    oracle(
        """SELECT occupation_group, count(DISTINCT occupation) AS n_codes, count(*) AS n_rows
        FROM mv GROUP BY 1""",
        "mv",
    ),
)
def occupation_groups(spark, sf_dir):
    codes = (
        movements(spark, sf_dir, ["occupation", "occupation_group"])
        .groupBy("occupation_group", "occupation")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return codes.groupBy("occupation_group").agg(
        F.count(F.lit(1)).alias("n_codes"), F.sum("n").alias("n_rows")
    )


@query(
    "type_sign_crosstab",
    oracle("SELECT movement_type, balance, count(*) AS n FROM mv GROUP BY ALL", "mv"),
)
def type_sign_crosstab(spark, sf_dir):
    """Counted per code first, so that the lookup of its type meets one row per code
    and sign, however many movements a code has."""
    codes = (
        movements(spark, sf_dir, ["occupation", "balance"])
        .groupBy(F.col("occupation").cast("bigint").alias("p_partkey"), "balance")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    types = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("movement_type"))
    return pr.crosstab(codes.join(types, "p_partkey", "left"), "movement_type", "balance", "n")


@query(
    "occupation_volume",
    oracle(
        """SELECT occupation_group, count(*) AS n_total,
        count(*) FILTER (WHERE balance = 1) AS n_pos,
        count(*) FILTER (WHERE balance = -1) AS n_neg
        FROM mv GROUP BY 1 ORDER BY n_total DESC, occupation_group LIMIT 10""",
        "mv",
    ),
)
def occupation_volume(spark, sf_dir):
    return oc.occupation_volume(movements(spark, sf_dir, ["occupation_group", "balance"]))


@query("cohort_month", oracle("SELECT * FROM cohort", "cohort"))
def cohort_month(spark, sf_dir):
    return cohorts_of(spark, sf_dir)


_LADDER = {
    "A": f"month_seq, {PROFILE}",
    "B": f"month_seq, {PROFILE}, occupation_group, schooling",
    "C": f"month_seq, {PROFILE}, occupation_group, schooling, sex, salary_band",
}
_SIZES = " UNION ALL ".join(
    f"SELECT '{name}' AS cohort_key, count(*) AS n_total FROM mv GROUP BY {key}"
    for name, key in _LADDER.items()
)
_BELOW = ", ".join(
    f"round(count(*) FILTER (WHERE n_total < {t}) / count(*) * 100, 6) AS pct_below_{t}"
    for t in (10, 20, 50, 100)
)
_FROM = ", ".join(
    f"round(count(*) FILTER (WHERE n_total >= {t}) / count(*) * 100, 6) AS pct_from_{t}"
    for t in (20, 50)
)


@query(
    "cohort_granularity",
    oracle(
        f"""SELECT cohort_key, count(*) AS n_cohorts, round(avg(n_total), 6) AS mean_size,
        {_BELOW}, {_FROM},
        CAST(quantile_disc(n_total, 0.25) AS DOUBLE) AS p25,
        CAST(quantile_disc(n_total, 0.5) AS DOUBLE) AS p50,
        CAST(quantile_disc(n_total, 0.75) AS DOUBLE) AS p75,
        CAST(quantile_disc(n_total, 0.9) AS DOUBLE) AS p90
        FROM ({_SIZES}) GROUP BY cohort_key""",
        "mv",
    ),
)
def cohort_granularity(spark, sf_dir):
    sizes = materialise(co.cohort_sizes(movements(spark, sf_dir, KEY_C)), "sizes")
    return co.cohort_granularity(sizes)


_STEPS = ", ".join(f"({t})" for t in SIZE_THRESHOLDS)


@query(
    "threshold_simulation",
    oracle(
        f"""SELECT t AS min_size, count(*) AS cohorts_before,
        count(*) FILTER (WHERE n_total >= t) AS cohorts_after,
        round(count(*) FILTER (WHERE n_total < t) / count(*) * 100, 6) AS pct_cohorts_removed,
        CAST(coalesce(sum(n_total) FILTER (WHERE n_total >= t), 0) AS BIGINT) AS rows_kept,
        round(coalesce(sum(n_total) FILTER (WHERE n_total >= t), 0) / sum(n_total) * 100, 6)
          AS pct_rows_kept
        FROM cohort, (VALUES {_STEPS}) v(t) GROUP BY t""",
        "cohort",
    ),
)
def threshold_simulation(spark, sf_dir):
    return co.threshold_simulation(cohorts_of(spark, sf_dir), SIZE_THRESHOLDS)


@query("forward_window", oracle("SELECT * FROM windowed", "windowed"))
def forward_window(spark, sf_dir):
    return ho.forward_window(cohorts_of(spark, sf_dir))


@query(
    "forward_window_join",
    # stated as a range frame, not as the equi-join the Spark plan uses
    oracle(
        f"""SELECT *, CASE WHEN n_total_6m > 0 THEN n_neg_6m / n_total_6m ELSE 0.0 END
          AS share_neg_6m, months_active > 0 AS has_future
        FROM (SELECT month_seq, month, {PROFILE}, n_total, n_pos, n_neg,
          CAST(coalesce(sum(n_total) OVER ahead, 0) AS BIGINT) AS n_total_6m,
          CAST(coalesce(sum(n_pos) OVER ahead, 0) AS BIGINT) AS n_pos_6m,
          CAST(coalesce(sum(n_neg) OVER ahead, 0) AS BIGINT) AS n_neg_6m,
          count(*) OVER ahead AS months_active
          FROM cohort WINDOW ahead AS (PARTITION BY {PROFILE} ORDER BY month_seq
            RANGE BETWEEN 1 FOLLOWING AND 6 FOLLOWING))""",
        "cohort",
    ),
)
def forward_window_join(spark, sf_dir):
    return ho.forward_window_join(materialise(cohorts_of(spark, sf_dir), "cohorts"))


@query(
    "right_censoring",
    oracle(
        f"""SELECT {month_of('last')} AS last_month, {month_of('last - 6')} AS last_eligible_month,
        count(*) AS cohorts_total, count(*) FILTER (WHERE month_seq <= last - 6)
          AS cohorts_eligible,
        count(*) FILTER (WHERE month_seq > last - 6) AS cohorts_excluded,
        round(count(*) FILTER (WHERE month_seq > last - 6) / count(*) * 100, 6) AS pct_excluded
        FROM cohort, (SELECT max(month_seq) AS last FROM cohort) GROUP BY last""",
        "cohort",
    ),
)
def right_censoring(spark, sf_dir):
    # counts per month need no forward window
    return ho.censoring_report(cohorts_of(spark, sf_dir))


@query(
    "horizon_listing",
    oracle(
        f"""SELECT {month_of('m.month_seq')} AS month, CAST(s AS INTEGER) AS step,
        CASE WHEN f.month_seq IS NULL THEN 'INDISPONIVEL' ELSE {month_of('f.month_seq')} END
          AS future_month, f.month_seq IS NOT NULL AS available
        FROM months m CROSS JOIN range(1, 7) r(s)
        LEFT JOIN months f ON f.month_seq = m.month_seq + s""",
        "months",
    ),
)
def horizon_listing(spark, sf_dir):
    return ho.horizon_listing(_months(spark, sf_dir))
