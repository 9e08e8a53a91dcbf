"""Ingest, write-back checks, profiles and quality gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ebbflow.functions import month_label, to_double, to_int
from ebbflow.operators import checks as ck
from ebbflow.operators import cleaning as cl
from ebbflow.operators import filings
from ebbflow.operators import profiling as pr
from ebbflow.operators import quality as qu
from ebbflow.operators import sketches as sk
from ebbflow.operators.features import silver
from ebbflow.operators.horizon import last_month
from ebbflow.operators.labels import modelling_table
from ebbflow.operators.ranking import exact_quantiles
from ebbflow.plans.registry import query
from ebbflow.plans.sql import oracle
from ebbflow.plans.stages import cohorts_of, labelled_stage, modelling_stage, silver_stage, windowed_stage
from ebbflow.settings import REGIONAL
from ebbflow.sources import delimited, files, landing, layers, sinks
from ebbflow.sources.samples import movements, order_movements, raw_movements, table

_SALARY = """CASE WHEN l_linenumber IN (5, 6, 7) THEN NULL ELSE cents / 100 END"""


@query(
    "decimal_parse",
    oracle(
        f"""SELECT l_linenumber AS line, count(*) AS n_rows,
        count({_SALARY}) AS n_parsed,
        CAST(count(*) FILTER (WHERE l_linenumber NOT IN (6, 7)) AS BIGINT) AS n_parsed_grouped,
        CAST(coalesce(sum(cents) FILTER (WHERE l_linenumber NOT IN (5, 6, 7)), 0) AS BIGINT)
          AS cents,
        CAST(coalesce(sum(cents) FILTER (WHERE l_linenumber NOT IN (6, 7)), 0) AS BIGINT)
          AS cents_grouped,
        CAST(sum(age) AS BIGINT) AS age_sum FROM raw GROUP BY l_linenumber""",
        "raw",
    ),
)
def decimal_parse(spark, sf_dir):
    plain = to_double(F.col("salário"))
    grouped = to_double(F.col("salário"), thousands_sep=".")

    def cents(value):
        return F.coalesce(F.sum(F.round(value * 100).cast("bigint")), F.lit(0))

    return (
        raw_movements(spark, sf_dir)
        .groupBy(to_int(F.col("categoria")).alias("line"))
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count(plain).alias("n_parsed"),
            F.count(grouped).alias("n_parsed_grouped"),
            cents(plain).alias("cents"),
            cents(grouped).alias("cents_grouped"),
            F.sum(to_int(F.col("idade"))).alias("age_sum"),
        )
    )


@query(
    "delimited_ingest",
    oracle(
        f"""SELECT CAST(comp AS VARCHAR) AS month, region, section, count(*) AS n_rows,
        count(*) FILTER (WHERE balance = 1) AS n_pos, count({_SALARY}) AS n_salaries,
        CAST(sum(age) AS BIGINT) AS age_sum
        FROM raw WHERE section IS NOT NULL AND balance IN (1, -1) GROUP BY ALL""",
        "raw",
    ),
)
def delimited_ingest(spark, sf_dir):
    """Write the rows as `;`-text, scan, conform, cast, validate, store by month, read."""
    text, base = layers.new_path(spark, "text"), layers.new_path(spark, "months")
    raw_movements(spark, sf_dir).write.options(header=True, sep=";").csv(text)
    raw = delimited.conform(delimited.scan_delimited(spark, text))
    sinks.write_months(cl.valid_movements(cl.typed(raw)), base, rebalance=True)
    stored = sinks.read_table(spark, base)
    return stored.groupBy("month", "region", "section").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("balance") == 1).alias("n_pos"),
        F.count("salary").alias("n_salaries"),
        F.sum("age").alias("age_sum"),
    )


@query(
    "month_rewrite",
    oracle(
        f"""SELECT CAST(comp AS VARCHAR) AS month, count(*) AS n_rows, count({_SALARY}) +
        CASE WHEN comp % 100 = 1 THEN count(*) FILTER (WHERE l_linenumber = 5) ELSE 0 END
        AS n_salaries FROM raw WHERE section IS NOT NULL AND balance IN (1, -1) GROUP BY comp""",
        "raw",
    ),
)
def month_rewrite(spark, sf_dir):
    """Ingest every month, then every January again with another number rule: the
    Januaries are replaced, not doubled, and the other months stay as they were."""
    base = layers.new_path(spark, "months")
    raw = delimited.conform(raw_movements(spark, sf_dir))
    sinks.write_months(cl.valid_movements(cl.typed(raw)), base, rebalance=True)
    again = cl.valid_movements(cl.typed(raw, thousands_sep="."))
    sinks.write_months(again.filter(F.col("month").endswith("01")), base, rebalance=True)
    stored = sinks.read_table(spark, base)
    return stored.groupBy("month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("salary").alias("n_salaries")
    )


def _order_files(spark, sf_dir):
    """One file name per month and family of the orders, and one with a bad month."""
    months = order_movements(spark, sf_dir).groupBy("month_seq").agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    label = month_label("month_seq")
    names = F.array(
        F.concat(F.lit("LABORMOV"), label, F.lit(".txt")),
        F.concat(F.lit("laborfor"), label, F.lit(".txt")),
        F.concat(F.lit("LABOREXC"), label, F.lit(".7z")),
        F.concat(F.lit("LABORMOV"), F.substring(label, 1, 4), F.lit("13.txt")),
        F.concat(F.lit("X"), label, F.lit(".txt")),
    )
    return months.select(F.explode(names).alias("file_name"), "n_rows", label.alias("_label"))


_FILES = """SELECT m, n_rows, kind, CASE kind WHEN 1 THEN 'LABORMOV' || m || '.txt'
    WHEN 2 THEN 'laborfor' || m || '.txt' WHEN 3 THEN 'LABOREXC' || m || '.7z'
    WHEN 4 THEN 'LABORMOV' || substr(m, 1, 4) || '13.txt' ELSE 'X' || m || '.txt' END AS file_name
    FROM (SELECT strftime(o_orderdate, '%Y%m') AS m, count(*) AS n_rows FROM orders GROUP BY 1),
    range(1, 6) r(kind)"""

# the orders date from the 1990s
_YEARS = (1990, 2100)


@query(
    "file_name_fields",
    f"""SELECT file_name, n_rows, kind <= 3 AS recognised,
    CASE kind WHEN 1 THEN 'MOV' WHEN 2 THEN 'FOR' WHEN 3 THEN 'EXC' END AS family,
    CASE WHEN kind <= 3 THEN CAST(substr(m, 1, 4) AS INTEGER) END AS year,
    CASE WHEN kind <= 3 THEN CAST(substr(m, 5, 2) AS INTEGER) END AS month_no,
    CASE WHEN kind <= 3 THEN m END AS month FROM ({_FILES})""",
)
def file_name_fields(spark, sf_dir):
    return files.file_name_fields(_order_files(spark, sf_dir).drop("_label"), years=_YEARS)


@query(
    "ingest_manifest",
    f"""SELECT CASE WHEN kind > 3 THEN 'unrecognised' WHEN kind <> 1 THEN 'filtered'
    WHEN m < '199901' THEN 'ingested' ELSE 'new' END AS status, count(*) AS n_files
    FROM ({_FILES}) GROUP BY 1""",
)
def ingest_manifest(spark, sf_dir):
    """Movement files wanted; everything before 1999 was ingested earlier."""
    listed = _order_files(spark, sf_dir)
    done = listed.filter(F.col("_label") < "199901").select("file_name")
    manifest = files.ingest_manifest(listed.drop("_label"), done, family="mov", years=_YEARS)
    return files.manifest_summary(manifest)


@query(
    "readback_check",
    oracle(
        """SELECT count(*) AS rows_before, count(*) AS rows_after, true AS rows_match,
        true AS success_marker, count(DISTINCT year) AS n_partitions,
        CAST(0 AS BIGINT) AS n_blank_cells, CAST(sum(high_turnover) AS BIGINT) AS n_label_1
        FROM silver""",
        "silver",
    ),
)
def readback_check(spark, sf_dir):
    """Write silver by year, read it back, compare. The file count depends on the
    cluster, so it is left out here."""
    rows = silver_stage(spark, sf_dir).table
    base = layers.new_path(spark, "silver")
    sinks.write_partitioned(rows, base, "year")
    return sinks.readback_report(rows, base, "year", "high_turnover").drop("n_files")


@query(
    "null_audit",
    oracle(
        """SELECT column_name, n AS n_rows, n_blank, round(n_blank / n * 100, 6) AS pct_blank FROM
        (SELECT count(*) AS n, count(*) FILTER (WHERE section IS NULL) AS s,
          count(*) FILTER (WHERE l_linenumber = 6) AS w FROM raw),
        LATERAL (VALUES ('competênciamov', 0), ('uf', 0), ('seção', s), ('idade', 0),
          ('graudeinstrução', 0), ('cbo2002ocupação', 0), ('sexo', 0), ('salário', w),
          ('saldomovimentação', 0), ('categoria', 0)) v(column_name, n_blank)""",
        "raw",
    ),
)
def null_audit(spark, sf_dir):
    return pr.null_audit(raw_movements(spark, sf_dir))


@query(
    "cardinality",
    oracle(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM mv"
            for c in ("region", "section", "occupation", "occupation_group", "schooling")
        ),
        "mv",
    ),
)
def cardinality(spark, sf_dir):
    columns = ["region", "section", "occupation", "occupation_group", "schooling"]
    return pr.cardinality(movements(spark, sf_dir, columns), columns)


_PROFILE_QUANTILES = ", ".join(
    f"CAST(quantile_disc(v, {p}) AS DOUBLE) AS {name}" for name, p in pr.PROFILE_QUANTILES.items()
)


@query(
    "numeric_profile",
    oracle(
        f"""SELECT metric, count(*) AS n, round(avg(v), 6) AS mean,
        round(stddev_samp(v), 6) AS stddev, CAST(min(v) AS DOUBLE) AS min,
        CAST(max(v) AS DOUBLE) AS max, {_PROFILE_QUANTILES}
        FROM (SELECT 'n_total' AS metric, n_total AS v FROM modelling
          UNION ALL SELECT 'n_pos', n_pos FROM modelling
          UNION ALL SELECT 'n_neg', n_neg FROM modelling) GROUP BY metric""",
        "modelling",
    ),
)
def numeric_profile(spark, sf_dir):
    rows = modelling_stage(spark, sf_dir)
    return pr.numeric_profile(rows.table, ["n_total", "n_pos", "n_neg"])


_FINE = {"p00001": 0.00001, "p99995": 0.99995, "p99999": 0.99999}


@query(
    "fine_quantiles",
    "SELECT 'l_extendedprice' AS metric, "
    + ", ".join(
        f"""list(l_extendedprice ORDER BY l_extendedprice)[greatest(1, CAST(ceil(CAST({p} AS DECIMAL(9, 5))
        * count(*)) AS BIGINT))] AS {name}"""
        for name, p in (("p00001", "0.00001"), ("p99995", "0.99995"), ("p99999", "0.99999"))
    )
    + " FROM lineitem",
)
def fine_quantiles(spark, sf_dir):
    """Probabilities far into both tails, taken as exact decimals."""
    return exact_quantiles(table(spark, sf_dir, "lineitem"), ["l_extendedprice"], _FINE)


@query(
    "describe_movements",
    oracle(
        """SELECT metric, count(v) AS n, round(avg(v), 6) AS mean,
        round(stddev_samp(v), 6) AS stddev, min(v) AS min, max(v) AS max
        FROM (SELECT 'age' AS metric, CAST(age AS DOUBLE) AS v FROM mv
          UNION ALL SELECT 'salary', salary FROM mv) GROUP BY metric""",
        "mv",
    ),
)
def describe_movements(spark, sf_dir):
    return pr.describe(movements(spark, sf_dir, ["age", "salary"]), ["age", "salary"])


_CATEGORIES = ("region", "section", "age_band")
_COUNTED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n "
    "FROM modelling GROUP BY ALL"
    for c in _CATEGORIES
)


@query(
    "category_profile",
    oracle(
        f"""SELECT column_name, n_values, kind, position, value, n,
          round(n / total * 100, 6) AS pct FROM (SELECT *,
          count(*) OVER (PARTITION BY column_name) AS n_values,
          sum(n) OVER (PARTITION BY column_name) AS total,
          row_number() OVER (PARTITION BY column_name ORDER BY n DESC, value) AS up,
          row_number() OVER (PARTITION BY column_name ORDER BY n, value) AS down
          FROM ({_COUNTED})), LATERAL (VALUES ('top', CAST(up AS INTEGER), up <= 3),
          ('rarest', CAST(down AS INTEGER), down = 1)) v(kind, position, kept) WHERE kept""",
        "modelling",
    ),
)
def category_profile(spark, sf_dir):
    return pr.category_profile(modelling_stage(spark, sf_dir).table, _CATEGORIES)


@query(
    "period_bounds",
    oracle(
        """SELECT min(month) AS first_month, max(month) AS last_month,
        count(DISTINCT month) AS n_months, count(*) AS n_rows FROM modelling""",
        "modelling",
    ),
)
def period_bounds(spark, sf_dir):
    return pr.period_bounds(modelling_stage(spark, sf_dir).table)


@query(
    "duplicate_keys",
    oracle(
        """SELECT count(*) AS n_rows, count(DISTINCT (month_seq, region, section, age_band))
        AS n_keys, count(*) - count(DISTINCT (month_seq, region, section, age_band))
        AS n_duplicates FROM modelling""",
        "modelling",
    ),
)
def duplicate_keys(spark, sf_dir):
    return qu.key_report(modelling_stage(spark, sf_dir).table, REGIONAL.keys.columns)


@query(
    "duplicate_profiles",
    oracle(
        """SELECT region, section, age_band, count(*) AS n FROM cohort
        GROUP BY ALL HAVING count(*) > 1""",
        "cohort",
    ),
)
def duplicate_profiles(spark, sf_dir):
    """The same audit on a key that is not unique: a profile recurs every month."""
    return qu.duplicate_keys(cohorts_of(spark, sf_dir), REGIONAL.keys.profile)


@query(
    "attrition",
    oracle(
        """SELECT CAST(step AS INTEGER) AS step, stage, rows_before, rows_after,
        rows_before - rows_after AS rows_removed,
        round(rows_after / rows_before * 100, 6) AS pct_kept, rows_after >= 5000 AS enough_rows
        FROM (SELECT (SELECT count(*) FROM raw) AS a,
          (SELECT count(*) FROM raw WHERE section IS NOT NULL AND balance IN (1, -1)) AS v,
          (SELECT count(*) FROM cohort) AS c, (SELECT count(*) FROM eligible) AS e),
        LATERAL (VALUES (1, 'raw', a, a), (2, 'valid', a, v), (3, 'cohorts', v, c),
          (4, 'eligible', c, e)) t(step, stage, rows_before, rows_after)""",
        "raw",
        "eligible",
    ),
)
def attrition(spark, sf_dir):
    rows = cl.typed(delimited.conform(raw_movements(spark, sf_dir)))
    windowed = windowed_stage(spark, sf_dir)
    in_data = F.col("month_seq") <= last_month(windowed.table) - REGIONAL.outlook.horizon
    ingested = qu.stage_counts(rows, {"raw": None, "valid": cl.is_valid(cl.month_of(rows))})
    modelled = qu.stage_counts(windowed.table, {"cohorts": None, "eligible": in_data}, first=3)
    return qu.attrition(ingested.unionByName(modelled), minimum=5_000)


def _delivered(spark, sf_dir):
    """The raw rows as text lines of monthly deliveries in one folder, as parts of written folders.

    Even years use other names and another order of columns, and are compressed. In odd
    ones some lines (number 4) have a field too many or a quote that isn't closed.
    """
    raw = raw_movements(spark, sf_dir)
    odd = F.substring("competênciamov", 1, 4).cast("int") % 2 == 1
    plain = list(raw.columns)
    other = ["saldomovimentação", *[c for c in reversed(plain) if c != "saldomovimentação"]]
    names = {"salário": "valorsaláriofixo", "idade": "faixaetária"}
    bad = F.when((F.col("categoria") == "4") & (F.col("seção") == "A"), "2;2").when(
        (F.col("categoria") == "4") & (F.col("seção") == "R"), '"1'
    )
    spoilt = raw.withColumn("sexo", F.coalesce(F.when(odd, bad), F.col("sexo")))
    cells = lambda columns: F.concat_ws(";", *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    delivery = F.concat(F.lit("LABORMOV"), F.col("competênciamov"), F.lit(".txt"))
    folder = layers.new_path(spark, "deliveries")
    for kind, columns, kept, packed in (("a", plain, odd, "none"), ("b", other, ~odd, "gzip")):
        rows = spoilt.filter(kept).select(delivery.alias("delivery"), F.lit(1).alias("_at"), cells(columns).alias("line"))
        header = ";".join(c if kind == "a" else names.get(c, c).upper() for c in columns)
        heads = rows.select("delivery").distinct().select("delivery", F.lit(0).alias("_at"), F.lit(header).alias("line"))
        # one part for each delivery, its header first
        laid = rows.unionByName(heads).repartition(16, "delivery").sortWithinPartitions("delivery", "_at")
        laid.drop("_at").write.partitionBy("delivery").option("compression", packed).mode("append").text(folder)
    # a second copy of a month, a name that is none, and a delivery of another kind
    extra = spark.createDataFrame(
        [("OTHERMOV199501.txt", ";".join(plain)), ("notes.txt", "x"), ("LABORMOV199913.txt", "x"), ("LABORMOV205001.txt", "a;b;c")],
        "delivery string, line string",
    )
    extra.write.partitionBy("delivery").mode("append").text(folder)
    return folder


_SPEC = landing.Delivery(years=_YEARS)
_SPOILT = "l_linenumber = 4 AND comp // 100 % 2 = 1 AND section IN ('A', 'R')"


@query(
    "file_ingest",
    oracle(
        f"""SELECT CAST(comp AS VARCHAR) AS month, region, section, count(*) AS n_rows,
        count(*) FILTER (WHERE balance = 1) AS n_pos, count({_SALARY}) AS n_salaries,
        CAST(sum(age) AS BIGINT) AS age_sum
        FROM raw WHERE section IS NOT NULL AND balance IN (1, -1) AND NOT ({_SPOILT}) GROUP BY ALL""",
        "raw",
    ),
)
def file_ingest(spark, sf_dir):
    """Deliveries with two headers, other names and compressed parts: landed, then counted."""
    base = layers.new_path(spark, "landed")
    landing.land(spark, _delivered(spark, sf_dir), base, spec=_SPEC)
    return (
        landing.movements(spark, base)
        .groupBy("month", "region", "section")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("balance") == 1).alias("n_pos"),
            F.count("salary").alias("n_salaries"),
            F.sum("age").alias("age_sum"),
        )
    )


@query(
    "quarantine",
    oracle(
        f"""SELECT 'line' AS kind, CASE WHEN {_SPOILT} THEN CASE section WHEN 'A' THEN 'fields' ELSE 'quote' END
          WHEN section IS NULL THEN 'section' ELSE 'balance' END AS reason, count(*) AS n
        FROM raw WHERE section IS NULL OR balance IS NULL OR {_SPOILT} GROUP BY ALL
        UNION ALL
        SELECT 'delivery', reason, n FROM (SELECT count(DISTINCT comp) AS months FROM raw),
          LATERAL (VALUES ('new', months), ('duplicate', 1), ('unrecognised', 2), ('error', 1)) v(reason, n)
        UNION ALL
        SELECT 'all deliveries', 'listed', count(DISTINCT comp) + 4 FROM raw""",
        "raw",
    ),
)
def quarantine(spark, sf_dir):
    """What was kept apart: lines by reason, deliveries by status, and that these add up."""
    base = layers.new_path(spark, "landed")
    deliveries = landing.land(spark, _delivered(spark, sf_dir), base, spec=_SPEC)
    count = F.count(F.lit(1)).alias("n")
    by_line = landing.quarantine(spark, base).groupBy(F.lit("line").alias("kind"), "reason").agg(count)
    by_name = deliveries.groupBy(F.lit("delivery").alias("kind"), F.col("status").alias("reason")).agg(count)
    everything = deliveries.agg(count).select(F.lit("all deliveries").alias("kind"), F.lit("listed").alias("reason"), "n")
    return by_line.unionByName(by_name).unionByName(everything)


@query(
    "family_diff",
    oracle(
        """SELECT family, column_name, n AS n_files, exclusive FROM
        (SELECT CAST(count(DISTINCT comp) AS BIGINT) AS n FROM raw) months, (VALUES
          ('MOV', 'uf', FALSE), ('MOV', 'seção', FALSE), ('MOV', 'saldomovimentação', FALSE), ('MOV', 'salário', FALSE),
          ('MOV', 'idade', TRUE), ('EXC', 'uf', FALSE), ('EXC', 'seção', FALSE), ('EXC', 'saldomovimentação', FALSE),
          ('EXC', 'competênciaexc', TRUE), ('EXC', 'indicadordeexclusão', TRUE), ('FOR', 'uf', FALSE),
          ('FOR', 'seção', FALSE), ('FOR', 'saldomovimentação', FALSE), ('FOR', 'salário', FALSE),
          ('FOR', 'competênciadec', TRUE)) v(family, column_name, exclusive)""",
        "raw",
    ),
)
def family_diff(spark, sf_dir):
    """Columns of movement, exclusion and late files, from the headers of written deliveries."""
    raw = raw_movements(spark, sf_dir)
    folder = layers.new_path(spark, "families")
    shared = ["uf", "seção", "saldomovimentação"]
    kinds = {"MOV": ["salário", "idade"], "EXC": ["competênciaexc", "indicadordeexclusão"], "FOR": ["salário", "competênciadec"]}
    for family, own in kinds.items():
        columns = [*shared, *own]
        name = F.concat(F.lit(f"LABOR{family}"), F.col("competênciamov"), F.lit(".txt"))
        head = F.lit(";".join(columns))
        cells = F.concat_ws(";", *[F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("1") for c in columns])
        rows = raw.groupBy(name.alias("delivery")).agg(F.max(cells).alias("cells"))
        text = rows.select("delivery", F.concat_ws("\n", head, "cells").alias("line"))
        text.repartition(4, "delivery").write.partitionBy("delivery").mode("append").text(folder)
    _, files = landing.manifest(spark, folder, None, landing.Delivery(family=None, years=_YEARS))
    return landing.family_columns(files, _SPEC)


_FILED = """filed AS (SELECT CAST(comp AS VARCHAR) AS month, region, section, age, CAST(l_linenumber % 5 AS INTEGER) AS schooling,
    CAST(l_linenumber AS INTEGER) AS category, balance, l_linenumber = 6 AS late, l_linenumber = 3 AND section = 'N' AS gone
  FROM raw WHERE section IS NOT NULL AND balance IN (1, -1)), wrong AS (
    SELECT month, region, section, age + 1000 AS age, schooling, category, balance FROM filed WHERE gone AND age < 20)"""
_FILING_KEY = ("month", "region", "section", "age", "schooling", "category", "balance")


@query(
    "late_filings_merged",
    oracle(
        f"""SELECT * FROM (WITH {_FILED} SELECT month, region, section, count(*) AS n_rows,
          count(*) FILTER (WHERE balance = 1) AS n_pos, count(*) FILTER (WHERE category = 6) AS n_late,
          CAST(sum(age) AS BIGINT) AS age_sum
        FROM (SELECT {", ".join(_FILING_KEY)} FROM filed EXCEPT ALL (
          SELECT {", ".join(_FILING_KEY)} FROM filed WHERE gone UNION ALL SELECT * FROM wrong)) GROUP BY ALL)""",
        "raw",
    ),
)
def late_filings_merged(spark, sf_dir):
    """Movements by month; then late filings join their months and exclusions cancel rows.

    Some exclusions match nothing. The months touched are rewritten, the others stay.
    """
    rows = cl.valid_movements(cl.typed(delimited.conform(raw_movements(spark, sf_dir))))
    base, target = layers.new_path(spark, "months"), layers.new_path(spark, "merged")
    sinks.write_months(rows.filter("category <> 6"), base, rebalance=True)
    gone = rows.filter("category = 3 and section = 'N'")
    wrong = gone.filter("age < 20").withColumn("age", F.col("age") + 1000)
    filings.merge_into_months(spark, base, rows.filter("category = 6"), gone.unionByName(wrong), target, _FILING_KEY)
    return (
        sinks.read_table(spark, target)
        .groupBy("month", "region", "section")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("balance") == 1).alias("n_pos"),
            F.count_if(F.col("category") == 6).alias("n_late"),
            F.sum("age").alias("age_sum"),
        )
    )


_SKETCHED = {"p10": 0.1, "p50": 0.5, "p90": 0.9, "p99": 0.99}


def _sketched_months(spark, sf_dir):
    """The movements and their sketches, every year's January delivered twice."""
    rows = movements(spark, sf_dir, ["month_seq", "age", "salary", "region", "section", "occupation"])
    rows = layers.materialise(rows.withColumn("month", month_label("month_seq")), "sketched-rows")
    base = layers.new_path(spark, "sketches")
    numbers, categories = ["age", "salary"], ["region", "section", "occupation"]
    first = rows.filter(~F.col("month").endswith("01") | (F.col("age") > 30))
    sk.store_sketches(sk.month_sketches(first, numbers, categories), base)
    again = rows.filter(F.col("month").endswith("01"))
    sk.store_sketches(sk.month_sketches(again, numbers, categories), base)
    return rows, sk.read_sketches(spark, base)


@query(
    "quantiles_by_merged_sketch",
    oracle(
        """SELECT metric, name, n, TRUE AS in_bound FROM (SELECT 'age' AS metric, count(age) AS n FROM mv
        UNION ALL SELECT 'salary', count(salary) FROM mv), (VALUES ('p10'), ('p50'), ('p90'), ('p99')) q(name)""",
        "mv",
    ),
)
def quantiles_by_merged_sketch(spark, sf_dir):
    """Sketches of all months merged; each quantile's exact rank is within the promised bound."""
    rows, sketches = _sketched_months(spark, sf_dir)
    found = layers.materialise(sk.merged_quantiles(sketches, _SKETCHED), "merged-quantiles")
    checks = []
    for metric in ("age", "salary"):
        mine = found.filter(F.col("metric") == metric)
        errors = rows.agg(
            *[sk.rank_error(rows, metric, mine.select(q).scalar(), p).alias(q) for q, p in _SKETCHED.items()]
        )
        long = errors.unpivot([], list(_SKETCHED), "name", "error")
        checks.append(long.select(F.lit(metric).alias("metric"), "name", mine.select("n").scalar().alias("n"), (F.col("error") <= sk.RANK_ERROR).alias("in_bound")))
    return checks[0].unionByName(checks[1])


@query(
    "cardinality_merged",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_exact,
            CASE WHEN count(DISTINCT {c}) <= 64 THEN count(DISTINCT {c}) END AS n_small, TRUE AS in_bound FROM mv"""
            for c in ("age", "salary", "region", "section", "occupation")
        ),
        "mv",
    ),
)
def cardinality_merged(spark, sf_dir):
    """Distinct values from merged monthly sketches: exact while few, else within two percent."""
    rows, sketches = _sketched_months(spark, sf_dir)
    exact = pr.cardinality(rows, ["age", "salary", "region", "section", "occupation"])
    both = sk.merged_distinct(sketches).withColumnRenamed("n_distinct", "_about").join(exact, "column_name")
    return both.select(
        "column_name",
        F.col("n_distinct").alias("n_exact"),
        F.when(F.col("n_distinct") <= 64, F.col("_about")).alias("n_small"),
        (F.abs(F.col("_about") - F.col("n_distinct")) <= sk.DISTINCT_ERROR * F.col("n_distinct")).alias("in_bound"),
    )


_CHECKED = (("target_audit", "labelled"), ("modelling", "modelling"), ("silver", "silver"))


@query(
    "study_checks",
    oracle(
        " UNION ALL ".join(
            f"""SELECT '{layer}' AS layer, (SELECT count(*) FROM labelled) AS rows_expected, count(*) AS rows_written,
            count(*) AS rows_read, CAST(sum(high_turnover) AS BIGINT) AS n_label_1_written,
            CAST(sum(high_turnover) AS BIGINT) AS n_label_1_read, TRUE AS same_content, TRUE AS ok FROM {source}"""
            for layer, source in _CHECKED
        ),
        "silver",
    ),
)
def study_checks(spark, sf_dir):
    """The study's layers written one from the other, each compared with what was read back."""
    base = layers.new_path(spark, "study")
    labelled = layers.materialise(labelled_stage(spark, sf_dir).table, "labelled")
    n = labelled.count()
    ck.record(ck.write_checked(labelled, f"{base}/target_audit", "target_audit", label="high_turnover", exactly=n), f"{base}/checks")
    modelling = modelling_table(sinks.read_table(spark, f"{base}/target_audit"))
    ck.record(ck.write_checked(modelling, f"{base}/modelling", "modelling", label="high_turnover", exactly=n), f"{base}/checks")
    by_year = lambda df, path: sinks.write_partitioned(df, path, "year")
    features = silver(sinks.read_table(spark, f"{base}/modelling"))
    ck.record(ck.write_checked(features, f"{base}/silver", "silver", by_year, "high_turnover", n), f"{base}/checks")
    return sinks.read_table(spark, f"{base}/checks")
