"""Language by Bayesian fusion of text, declared markup language, address suffix and host.

Text likelihoods come from hashed byte trigrams, counted per declared language over every
document; the languages are those that enough rows declare. One more class, no language of
these, is as likely as a text just beyond what its best language explains. Host priors are
counts of the classes that texts alone suggest, smoothed towards the address suffix of the
host, and that towards the whole corpus; the counts are grouped aggregations. The
posterior multiplies the parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbflow.llm.store import stored

CELLS = 1 << 16


@dataclass(frozen=True)
class Evidence:
    # `identified` takes the declared languages of its rows unless it is given settings
    languages: tuple[str, ...] = ("de", "en", "es", "fr")
    # a declared value is a language from a thousandth of the declaring rows on, at least and at
    # most so many; tasks hold CELLS counts for each language
    least_rows: int = 3
    enough_rows: int = 20
    most_languages: int = 256
    # part of each language's likelihood that is spread over all cells alike
    unseen: float = 0.01
    # a text may fall so far below its language's mean, in nats a trigram and in standard
    # errors; one of fewer trigrams says too little to be ruled out
    floor_nats: float = 2.0
    floor_errors: float = 3.0
    floor_trigrams: int = 20
    # trust in a declared language, spread over the others if it is wrong
    declared_right: float = 0.9
    # counts by which a host leans on its suffix, and a suffix on the corpus
    host_lean: float = 20.0
    suffix_lean: float = 20.0
    # a text counts as at most so many independent trigrams
    most_trigrams: int = 100
    # accepted when the best language is this likely; a text needs so many letters
    least_posterior: float = 0.5
    least_letters: int = 1


def trigram_cells(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of a batch of texts and each text's end. Case and digits are folded."""
    blobs = [b"  " + (t or "").lower().encode("utf-8") + b"  " for t in texts]
    data = np.frombuffer(b"".join(blobs), np.uint8)
    data = _FOLD[data].astype(np.uint32)
    sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
    code = (data[:-2] * np.uint32(961) + data[1:-1] * np.uint32(31) + data[2:]) * np.uint32(2654435761)
    cells = (code >> np.uint32(16)).astype(np.int64)
    # blanks stand at both ends, so a window over two texts tells nothing of either
    return cells, np.minimum(np.cumsum(sizes), len(cells))


_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:0x41] = 0x20  # blanks, digits and signs of ASCII
_FOLD[0x5B:0x61] = 0x20
_FOLD[0x7B:0x80] = 0x20


def suffix_of(host: Column) -> Column:
    """The last label of a host name; none if there is no dot or it is a number."""
    last = F.regexp_extract(F.lower(host), r"\.([a-z]{2,})$", 1)
    return F.when(last != "", last)


def host_of(url: Column) -> Column:
    """The host of an address in lower case; none if it has none or can't be read."""
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def declared_in(html: Column) -> Column:
    """The language a page declares: two letters of its html tag."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*\blang\s*=\s*[\"']?([a-z]{2})", 1))
    return F.when(found != "", found)


def evidence_of_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, text, declared, host) of documents: their lang column and their source."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.lower(F.col("lang").cast("string")).alias("declared"),
        F.lower(F.col("source").cast("string")).alias("host"),
    )


def evidence_of_pages(pages: DataFrame) -> DataFrame:
    """The same of raw pages; text is the html without its tags, scripts and styles."""
    bare = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    return pages.select(
        F.col("page_id").cast("bigint").alias("doc_id"),
        bare.alias("text"),
        declared_in(F.col("html")).alias("declared"),
        host_of(F.col("url")).alias("host"),
    )


def declared_languages(evidence: DataFrame, settings: Evidence = Evidence()) -> tuple[str, ...]:
    """The values that enough rows declare, in code point order; the commonest if too many."""
    counts = evidence.filter("declared is not null and declared <> ''").groupBy("declared").agg(F.count(F.lit(1)).alias("n"))
    counts = stored(counts, "declared-counts")
    rows = counts.agg(F.sum("n")).first()[0] or 0
    least = min(settings.enough_rows, max(settings.least_rows, rows // 1000))
    often = counts.filter(F.col("n") >= least).orderBy(F.desc("n"), "declared")
    return tuple(sorted(r["declared"] for r in often.limit(settings.most_languages).collect()))


def trained(evidence: DataFrame, settings: Evidence = Evidence()) -> np.ndarray:
    """Log likelihood of each cell in each language, from every row that declares one.

    Tasks send one row for each language and cell they met; the sums are a table of
    languages x CELLS numbers, whatever the corpus is.
    """
    names = list(settings.languages)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(names), CELLS), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                cells, ends = trigram_cells(piece.column(0).to_pylist())
                begin = 0
                for end, declared in zip(ends.tolist(), piece.column(1).to_pylist()):
                    sums[names.index(declared)] += np.bincount(cells[begin:end], minlength=CELLS)
                    begin = end
        which, cell = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(which, pa.int32()), pa.array(cell, pa.int32()), pa.array(sums[which, cell], pa.int64())],
            names=["which", "cell", "n"],
        )

    known = evidence.filter(F.col("declared").isin(names) & F.col("text").isNotNull())
    counts = known.select("text", "declared").mapInArrow(count, "which int, cell int, n bigint")
    table = np.zeros((len(names), CELLS))
    for row in counts.groupBy("which", "cell").agg(F.sum("n").alias("n")).toLocalIterator():
        table[row["which"], row["cell"]] = row["n"]
    # a cell that no text has costs the same in each language, however much text it has
    known_part = (1 - settings.unseen) * table / np.maximum(table.sum(axis=1, keepdims=True), 1)
    return np.log(known_part + settings.unseen / CELLS).astype(np.float32)


def expected(model: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of a trigram's log likelihood in a text of each language."""
    p = np.exp(model.astype(np.float64))
    p /= p.sum(axis=1, keepdims=True)
    mean = (p * model).sum(axis=1)
    return mean, np.sqrt((p * (model - mean[:, None]) ** 2).sum(axis=1))


def scored(evidence: DataFrame, model: np.ndarray, settings: Evidence = Evidence()) -> DataFrame:
    """(doc_id, text_hash, declared, host, letters, scores, unknown): log likelihoods by language.

    A long text's likelihood is tempered to that of `most_trigrams` trigrams. `unknown` is the
    least that a text of the best language has by its length, null for one too short to tell.
    """
    shared = evidence.sparkSession.sparkContext.broadcast((model, *expected(model)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, mean, deviation = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                cells, ends = trigram_cells(piece.column(4).to_pylist())
                starts = np.append(0, ends[:-1])
                empty = ends <= starts
                held = np.maximum(ends - starts, 1)
                begin = np.minimum(starts, max(len(cells) - 1, 0))
                sums = np.stack([np.add.reduceat(row[cells], begin, dtype=np.float64) for row in logs], axis=1)
                counted = np.minimum(held, settings.most_trigrams)
                sums *= (counted / held)[:, None]
                sums[empty] = 0.0
                best = np.argmax(sums, axis=1)
                floor = mean[best] - settings.floor_nats - settings.floor_errors * deviation[best] / np.sqrt(held)
                unknown = pa.array(counted * floor, mask=empty | (held < settings.floor_trigrams))
                lists = pa.array(list(sums), pa.list_(pa.float64()))
                names = ["doc_id", "text_hash", "declared", "host", "letters", "scores", "unknown"]
                yield pa.RecordBatch.from_arrays([*piece.columns[:4], piece.column(5), lists, unknown], names=names)

    text = F.coalesce("text", F.lit(""))
    rows = evidence.select(
        "doc_id",
        F.xxhash64(text).alias("text_hash"),
        "declared",
        "host",
        text.alias("text"),
        F.char_length(F.regexp_replace(text, r"[^\p{L}]+", "")).cast("bigint").alias("letters"),
    )
    kinds = "doc_id bigint, text_hash bigint, declared string, host string, letters bigint, scores array<double>, unknown double"
    return rows.mapInArrow(score, kinds)


def _best(values: str) -> Column:
    """Position of the greatest value, the first of equals."""
    return (F.array_position(F.col(values), F.array_max(values)) - 1).cast("int")


def identified(evidence: DataFrame, settings: Evidence | None = None) -> DataFrame:
    """doc_id, text_hash, language, posterior, text_language, accepted; one row per row.

    Without settings the languages are those the rows declare. A row without letters, or
    whose likeliest class is none of the languages, has no language and is not accepted.
    Missing evidence of one kind leaves that factor out; ties go to the language named first.
    """
    if settings is None:
        settings = replace(Evidence(), languages=declared_languages(evidence))
    names = list(settings.languages)
    k = len(names)  # position of the class that is none of them
    if not k:
        return _none_identified(evidence)
    rows = stored(scored(evidence, trained(evidence, settings), settings), "language-scores")
    # a text too short to be ruled out is as likely in no language as in its likeliest one
    rows = rows.withColumn("told", F.concat("scores", F.array(F.coalesce("unknown", F.array_max("scores")))))
    rows = rows.withColumn("text_best", F.when(F.col("letters") >= settings.least_letters, _best("told")))
    rows = rows.withColumn("suffix", suffix_of(F.col("host")))
    places = F.sequence(F.lit(0), F.lit(k))
    zeros = F.array_repeat(F.lit(0).cast("bigint"), k + 1)

    def votes(counts: Column) -> Column:
        return F.transform(places, lambda i: F.coalesce(counts[i], F.lit(0).cast("bigint")))

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda s, x: s + x)

    def gathered(counts: DataFrame, *keys: str) -> DataFrame:
        # at most one row for each key and class is collected
        sums = counts.groupBy(*keys, "text_best").agg(F.sum("n").alias("n"))
        pairs = F.map_from_entries(F.collect_list(F.struct("text_best", "n")))
        return sums.groupBy(*keys).agg(votes(pairs).alias("votes"))

    told = rows.filter("text_best is not null")
    counted = stored(told.groupBy("host", "suffix", "text_best").agg(F.count(F.lit(1)).alias("n")), "host-votes")
    per_suffix = gathered(counted.filter("suffix is not null"), "suffix").withColumnRenamed("votes", "of_suffix")
    whole = {r["text_best"]: r["n"] for r in counted.groupBy("text_best").agg(F.sum("n").alias("n")).collect()}
    everything = sum(whole.values()) + k + 1
    corpus = F.array(*[F.lit((whole.get(i, 0) + 1) / everything) for i in range(k + 1)])
    a, b = settings.suffix_lean, settings.host_lean
    hosts = gathered(counted.filter("host is not null"), "host", "suffix").join(per_suffix, "suffix", "left")
    of_suffix = F.coalesce("of_suffix", zeros)
    suffix_prior = F.zip_with(of_suffix, corpus, lambda n, p: (n + a * p) / (total(of_suffix) + a))
    host_prior = F.zip_with("votes", suffix_prior, lambda n, p: (n + b * p) / (total(F.col("votes")) + b))
    hosts = hosts.select("host", host_prior.alias("prior"))
    # one row for each host; a host with a third of all rows is split by adaptive execution
    joined = rows.join(hosts, "host", "left").withColumn("prior", F.coalesce("prior", corpus))
    # a declared value that is none of the languages speaks for the class that is none of them
    at = F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), F.col("declared")), F.lit(0)), F.lit(k + 1)) - 1
    right, wrong = math.log(settings.declared_right), math.log((1 - settings.declared_right) / k)
    declares = F.col("declared").isNotNull() & (F.col("declared") != "")
    declared = F.transform(places, lambda i: F.when(~F.coalesce(declares, F.lit(False)), 0.0).when(i == at, right).otherwise(wrong))
    logs = F.zip_with(F.zip_with("told", "prior", lambda t, p: t + F.log(p)), declared, lambda x, y: x + y)
    joined = joined.withColumn("logs", logs).withColumn("best", _best("logs"))
    spread = F.aggregate(
        "logs", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("logs"))
    )
    enough = F.col("letters") >= settings.least_letters
    joined = joined.withColumn("posterior", F.when(enough, 1.0 / spread).otherwise(0.0))
    name = lambda c: F.get(F.array(*[F.lit(n) for n in names]), F.col(c))
    return joined.select(
        "doc_id",
        "text_hash",
        F.when(enough, name("best")).alias("language"),
        "posterior",
        name("text_best").alias("text_language"),
        (enough & (F.col("best") < k) & (F.col("posterior") >= settings.least_posterior)).alias("kept"),
    )


def _none_identified(evidence: DataFrame) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return evidence.select(
        "doc_id",
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
        nothing.alias("language"),
        F.lit(0.0).alias("posterior"),
        nothing.alias("text_language"),
        F.lit(False).alias("kept"),
    )


def keep_identified(docs: DataFrame, settings: Evidence | None = None) -> DataFrame:
    """The rows of `docs` with an accepted language; `lang` becomes the language found."""
    found = identified(evidence_of_documents(docs), settings).filter("kept")
    found = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("language").alias("_lang"))
    # rows alike in doc_id and text may differ in their evidence; the surest reading is enough
    found = found.groupBy("_id", "_hash").agg(F.min("_lang").alias("_lang"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = docs.join(
        found, docs["doc_id"].cast("bigint").eqNullSafe(found["_id"]) & (F.xxhash64(text) == found["_hash"])
    )
    return both.select(*[F.col("_lang").alias("lang") if c == "lang" else docs[c] for c in docs.columns])
