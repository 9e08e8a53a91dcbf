"""Document fingerprints by I-Match, with JVM functions only.

The lexicon holds the terms whose inverse document frequency lies in a band. It is cut at
random, by bits of the terms' hashes, into many small subsets; a text's fingerprint holds,
for each subset it meets, one hash over its sorted distinct terms there. Subsets at rate
2^-level keep about one term of the text each, so the share of equal subset hashes follows
the share of common terms. Two neighbouring rates are kept, so texts whose numbers of terms
differ by less than half can always be compared.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbflow.llm.ordering import range_of, split_values
from ebbflow.llm.store import stored

TERM_BREAK = r"[^\p{L}\p{N}]+"
CELL_BITS = 6  # 64 subsets at each rate
ROWS_PER_RANGE = 4_000


@dataclass(frozen=True)
class Band:
    """Shares of documents between which a term is in the lexicon.

    By Markov's inequality at most `most_terms` terms can occur in (all occurrences in
    distinct documents) / most_terms documents, and the lower end is at least that, so the
    lexicon is bounded whatever the corpus is.
    """

    rarest: float = 0.002
    commonest: float = 0.2
    least_documents: int = 2
    most_terms: int = 200_000


def term_hashes(text: Column) -> Column:
    """Distinct hashed terms: runs of letters and digits, in lower case."""
    words = F.array_remove(F.split(F.lower(text), TERM_BREAK), "")
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def lexicon(docs: DataFrame, band: Band = Band()) -> list[int]:
    """Hashes of the terms inside the band, counted over every document. A bounded list."""
    terms = docs.select(F.explode(term_hashes(F.col("text"))).alias("term"))
    counts = stored(terms.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-counts")
    n_docs = docs.count()
    size = counts.agg(F.sum("n")).first()[0] or 0
    least = max(band.least_documents, band.rarest * n_docs, size / band.most_terms)
    most = max(band.commonest * n_docs, least)
    inside = counts.filter((F.col("n") >= least) & (F.col("n") <= most))
    return [row["term"] for row in inside.select("term").toLocalIterator()]


def _subset_hashes(terms: Column, level: Column) -> Column:
    """(subset number, 16 bits of a hash over its sorted terms) as one int, for met subsets."""
    kept = F.filter(terms, lambda t: t.bitwiseAND(F.call_function("shiftleft", F.lit(1), level).cast("bigint") - 1) == 0)
    cell = lambda t: F.shiftrightunsigned(t, 64 - CELL_BITS).cast("int")
    closed = lambda s: F.concat(
        s["out"], F.array(s["cell"] * 65_536 + s["h"].bitwiseAND(F.lit(65_535).cast("bigint")).cast("int"))
    )

    def state(out: Column, at: Column, h: Column) -> Column:
        return F.struct(out.alias("out"), at.alias("cell"), h.alias("h"))

    def step(s: Column, t: Column) -> Column:
        same = state(s["out"], s["cell"], F.xxhash64(s["h"], t))
        opened = state(F.when(s["cell"] < 0, s["out"]).otherwise(closed(s)), cell(t), F.xxhash64(t))
        return F.when(cell(t) == s["cell"], same).otherwise(opened)

    start = state(F.array().cast("array<int>"), F.lit(-1), F.lit(0).cast("bigint"))
    return F.aggregate(
        F.array_sort(kept), start, step, lambda s: F.when(s["cell"] < 0, s["out"]).otherwise(closed(s))
    )


def with_fingerprint(df: DataFrame, text: str, name: str, band_terms: list[int]) -> DataFrame:
    """Add the fingerprint of a text column as a struct (level, fine, coarse).

    A text without a lexicon term is told by all its terms, one without terms by itself.
    """
    terms, band, chosen = f"_{name}_terms", f"_{name}_band", f"_{name}_chosen"
    known = f"filter(`{terms}`, t -> t IN ({','.join(f'{t}L' if t >= -(2**63) + 1 else 'bigint(-9223372036854775808)' for t in band_terms)}))"
    level = F.greatest(F.floor(F.log2(F.size(chosen) / float(1 << CELL_BITS))), F.lit(0)).cast("int")
    df = df.withColumn(terms, term_hashes(F.col(text)))
    df = df.withColumn(band, F.expr(known) if band_terms else F.array().cast("array<bigint>"))
    df = df.withColumn(
        chosen,
        F.when(F.size(band) > 0, F.col(band))
        .when(F.size(terms) > 0, F.col(terms))
        .otherwise(F.array(F.xxhash64(F.col(text)))),
    )
    df = df.withColumn(f"_{name}_level", level)
    made = F.struct(
        F.col(f"_{name}_level").alias("level"),
        _subset_hashes(F.col(chosen), F.col(f"_{name}_level")).alias("fine"),
        _subset_hashes(F.col(chosen), F.col(f"_{name}_level") + 1).alias("coarse"),
    )
    return df.withColumn(name, made).drop(terms, band, chosen, f"_{name}_level")


def as_string(fingerprint: Column) -> Column:
    digits = lambda a: F.array_join(F.transform(a, lambda e: F.lpad(F.lower(F.hex(e)), 6, "0")), "")
    return F.concat_ws(
        ".", fingerprint["level"].cast("string"), digits(fingerprint["fine"]), digits(fingerprint["coarse"])
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes among the subsets that either text meets, 0 to 1."""
    cells = lambda x: F.transform(x, lambda e: F.floor(e / 65_536))
    equal = lambda x, y: F.size(F.array_intersect(x, y))
    met = lambda x, y: F.size(F.array_union(cells(x), cells(y)))
    share = lambda n, of: F.when(of > 0, n / of).otherwise(0.0)
    both = share(
        equal(a["fine"], b["fine"]) + equal(a["coarse"], b["coarse"]),
        met(a["fine"], b["fine"]) + met(a["coarse"], b["coarse"]),
    )
    apart = a["level"] - b["level"]
    return (
        F.when(apart == 0, both)
        .when(apart == 1, share(equal(a["fine"], b["coarse"]), met(a["fine"], b["coarse"])))
        .when(apart == -1, share(equal(a["coarse"], b["fine"]), met(a["coarse"], b["fine"])))
        .otherwise(0.0)
    )


def with_next_text(docs: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """(_range, _guest, doc_id, text, next_text): every row knows the text after it.

    Order: doc_id (null first), then text; after the last comes the first. Rows lie in
    ranges of doc_id; the first row of a range is also a guest at the end of the range
    before it, so the texts are shuffled once and no task sees more than a range.
    """
    edges = split_values(docs.select("doc_id"), "doc_id", rows_per_range)
    key = F.col("doc_id")
    bounds = docs.agg(F.min(key), F.count(F.when(key.isNull(), 1))).first()
    first = F.lit(None).cast("bigint") if bounds[1] else F.lit(bounds[0]).cast("bigint")
    none = F.lit(None).cast("int")
    at = range_of(key, edges)
    before = F.when(range_of(key - 1, edges) < at, at - 1).otherwise(none) if edges else none
    last = F.when(key.eqNullSafe(first), F.lit(len(edges))).otherwise(none)
    seats = F.filter(
        F.array(
            F.struct(at.alias("r"), F.lit(0).alias("g")),
            F.struct(before.alias("r"), F.lit(1).alias("g")),
            F.struct(last.alias("r"), F.lit(2).alias("g")),
        ),
        lambda s: s["r"].isNotNull(),
    )
    seated = docs.select("doc_id", "text", F.explode(seats).alias("_seat"))
    rows = seated.select(F.col("_seat.r").alias("_range"), F.col("_seat.g").alias("_guest"), "doc_id", "text")
    return rows.withColumn("next_text", F.lead("text").over(in_order()))


def in_order():
    return Window.partitionBy("_range").orderBy("_guest", "doc_id", "text")


def fingerprints(docs: DataFrame, band: Band = Band()) -> DataFrame:
    """Fingerprint of every text, of its edited text, and their likenesses.

    The edited text has its last quarter replaced by the first code points of the next
    document. Null text is empty. One row per input row; only doc_id and text are read.
    """
    narrow = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    terms = lexicon(narrow, band)
    rows = with_next_text(narrow).withColumn("n_chars", F.char_length("text").cast("bigint"))
    rows = with_fingerprint(rows, "text", "fp", terms)
    rows = rows.withColumn("next_fp", F.lead("fp").over(in_order())).filter("_guest = 0")
    quarter = "int(n_chars div 4)"
    edited = f"concat(substring(text, 1, int(n_chars) - {quarter}), substring(next_text, 1, {quarter}))"
    rows = rows.select("doc_id", "n_chars", "fp", "next_fp", F.expr(edited).alias("edited"))
    rows = with_fingerprint(rows, "edited", "edited_fp", terms)
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("fp")).alias("fingerprint"),
        as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).cast("double").alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).cast("double").alias("near_next"),
    )
