"""Licence scan by sentence rules, with JVM functions only.

A text's sentences are normalised, known licence sentences become identifiers, and the
sequence of identifiers is matched against ordered licence rules. Every text is read
whole; nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ---------------------------------------------------------------------------
CUE = r"(?i)licen[sc]|copyright|warrant|permission|redistribut|spdx|public domain"

# normalised sentence (whole, as a pattern) -> identifier
SENTENCES = (
    ("SPDX", r"spdx license identifier [a-z0-9 .+-]+"),
    ("COPYRIGHT", r"(portions )?copyright( c)? .*"),
    ("ALLRIGHTS", r"all rights reserved"),
    ("APACHE2", r"((this (work|software|project|file) is )?(licensed|released|distributed) under )?(the )?apache license version 2\.0( the license)?"),
    ("COMPLIANCE", r"you may not use this file except in compliance with the license"),
    ("OBTAINCOPY", r"you may obtain a copy of the license at.*"),
    ("ASISBASIS", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("SEELICENSE", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MIT", r"((this (work|software|project|file) is )?(licensed|released|distributed) under )?(the )?mit license"),
    ("GRANTED", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction.*"),
    ("NOTICE", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("PROVIDEDASIS", r"the software is provided as is without warranty of any kind.*"),
    ("REDISTRIBUTION", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("KEEPSOURCE", r"(1\.? )?redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    ("KEEPBINARY", r"(2\.? )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("NONAMES", r"(3\.? )?neither the name of .* may be used to endorse or promote products.*"),
    ("BSDASIS", r"this software is provided by .* as is and any express or implied warranties.*"),
    ("GPL3", r"((this (work|software|project|file) is )?(licensed|released|distributed) under )?(the )?gnu general public license version 3(\.0)?"),
    ("GPL2", r"((this (work|software|project|file) is )?(licensed|released|distributed) under )?(the )?gnu general public license version 2(\.0)?"),
    ("FREESOFTWARE", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version [23] of the license or at your option any later version"),
    ("NOWARRANTY", r"this program is distributed in the hope that it will be useful but without any warranty.*"),
    ("LGPL", r"((this (work|software|project|file) is )?(licensed|released|distributed) under )?(the )?gnu lesser general public license version [23](\.[01])?"),
    ("MPL2", r"this source code form is subject to the terms of the mozilla public license v\.? ?2\.0"),
    ("CCBYNC4", r"((this (work|text|file) is )?(licensed|released|distributed) under )?(a )?(cc by nc|creative commons attribution noncommercial) 4\.0( international)?( license)?"),
    ("CCBYSA4", r"((this (work|text|file) is )?(licensed|released|distributed) under )?(a )?(cc by sa|creative commons attribution sharealike) 4\.0( international)?( license)?"),
    ("CCBY4", r"((this (work|text|file) is )?(licensed|released|distributed) under )?(a )?(cc by|creative commons attribution) 4\.0( international)?( license)?"),
    ("PUBLICDOMAIN", r"this (work|text|file|software) is (in|released into|dedicated to) the public domain"),
)

# rule -> identifiers that must follow one another in this order (others may stand between)
RULES = (
    ("Apache-2.0", ("APACHE2", "COMPLIANCE", "OBTAINCOPY", "ASISBASIS", "SEELICENSE")),
    ("Apache-2.0", ("APACHE2",)),
    ("MIT", ("GRANTED", "NOTICE", "PROVIDEDASIS")),
    ("MIT", ("MIT",)),
    ("BSD-3-Clause", ("REDISTRIBUTION", "KEEPSOURCE", "KEEPBINARY", "NONAMES", "BSDASIS")),
    ("BSD-2-Clause", ("REDISTRIBUTION", "KEEPSOURCE", "KEEPBINARY", "BSDASIS")),
    ("GPL-3.0", ("GPL3",)),
    ("GPL-2.0", ("GPL2",)),
    ("GPL", ("FREESOFTWARE", "NOWARRANTY")),
    ("LGPL", ("LGPL",)),
    ("MPL-2.0", ("MPL2",)),
    ("CC-BY-NC-4.0", ("CCBYNC4",)),
    ("CC-BY-SA-4.0", ("CCBYSA4",)),
    ("CC-BY-4.0", ("CCBY4",)),
    ("SPDX", ("SPDX",)),
    ("Public-Domain", ("PUBLICDOMAIN",)),
)
# --------------------------------------------------------------------------------------------

# a sentence ends at . ! ? ; before white space, at an empty line, at a line that is
# followed by a capital or a list mark; other line ends are wrapped lines
ENDS = (
    (r"([.!?;])[\x20\x09-\x0D]+", "$1\u0001"),
    (r"\n[\x20\x09\r]*\n", "\u0001"),
    (r"\n[\x20\x09]*([A-Z0-9*(-])", "\u0001$1"),
)
# dots stay inside numbers, everything else but letters and digits becomes one blank
NORMAL = ((r"[^a-z0-9.+]+", " "), (r"\.+( |$)", " "), (r" +", " "))


END, LINE = "\u0001", "\u0002"


def normalised(text: Column) -> Column:
    """Words and numbers in lower case, joined by single blanks; sentences end at END.

    LINE stands at a line end before a capital or a list mark. It may end a sentence or lie
    inside a wrapped one.
    """
    text = F.translate(text, LINE, " ")
    # the dot of a version's "v." ends no sentence
    text = F.regexp_replace(text, r"(?i)\b(v)\.\s+(?=[0-9])", "$1 ")
    for (pattern, by), mark in zip(ENDS, (END, END, LINE)):
        text = F.regexp_replace(text, pattern, by.replace(END, mark))
    marks = f"[{END}{LINE}]"
    (other, _), (dots, _), _ = NORMAL
    text = F.regexp_replace(F.lower(text), other.replace("]+", f"{END}{LINE}]+"), " ")
    text = F.regexp_replace(text, dots.replace("$)", f"$|(?={marks}))"), " ")
    text = F.regexp_replace(F.trim(F.regexp_replace(text, " +", " ")), f" ?({marks}) ?", "$1")
    return F.regexp_replace(text, f"{LINE}+", LINE)


def _over_lines(pattern: str) -> str:
    """A sentence's pattern that may run over LINE marks; an open end stops at the next mark."""
    parts = re.sub(r"\[[^\]]*\]| ", lambda m: f"[ {LINE}]" if m[0] == " " else m[0], pattern)
    if parts.endswith(".*"):
        parts = parts[:-2] + f"[^{END}{LINE}]*"
    return parts.replace(".*", f"[^{END}]*?")


# forms of a sentence besides those of SENTENCES
HEADINGS = (("MIT", r"(the )?mit license mit"),)
FORMS = tuple((name, _over_lines(pattern)) for name, pattern in (*SENTENCES, *HEADINGS))
ANY_FORM = f"(?<![^{END}{LINE}])(" + "|".join(f"(?:{p})(?![^{END}{LINE}])" for _, p in FORMS) + ")"


def identifiers(text: Column) -> Column:
    """The identifiers of the known sentences of a normalised text, in order."""

    def named(sentence: Column) -> Column:
        found = F.lit(None).cast("string")
        for name, pattern in reversed(FORMS):
            found = F.when(sentence.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(found)
        return found

    return F.transform(F.regexp_extract_all(text, F.lit(ANY_FORM), F.lit(1)), named)


def rule_pattern(ids: tuple[str, ...]) -> str:
    """A LIKE pattern over the identifiers, each between commas."""
    return "%" + "%".join(f",{i}," for i in ids) + "%"


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_cue_sentences, sentence_ids, licences, n_licences; one row per input row.

    `sentence_ids` lists the recognised sentences in order, between commas that stand twice
    between two; `licences` the rules met, in rule order, without repeats. Sentences count
    as cued by CUE, but are recognised with a cue or without. Null and empty texts have none. Whole texts are read, whatever their length.
    """
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", normalised(F.coalesce("text", F.lit(""))).alias("s"))
    cued = F.filter(F.split("s", f"[{END}{LINE}]"), lambda s: s.rlike(CUE))
    rows = rows.select("doc_id", F.size(cued).cast("bigint").alias("n_cue_sentences"), identifiers(F.col("s")).alias("ids"))
    joined = F.array_join(F.transform("ids", lambda i: F.concat(F.lit(","), i, F.lit(","))), "")
    rows = rows.withColumn("sentence_ids", joined)
    met = F.array(*[F.when(F.col("sentence_ids").like(rule_pattern(r)), F.lit(n)) for n, r in RULES])
    found = F.array_distinct(F.filter(met, lambda n: n.isNotNull()))
    return rows.select(
        "doc_id",
        "n_cue_sentences",
        "sentence_ids",
        F.array_join(found, ",").alias("licences"),
        F.size(found).cast("bigint").alias("n_licences"),
    )


SQL_END, SQL_LINE = r"\x01", r"\x02"  # END and LINE in patterns


def _sql_form(pattern: str) -> str:
    """A sentence's pattern over a text whose marks stand twice, in RE2, which looks neither ahead nor back."""
    parts = re.sub(r"\[[^\]]*\]| ", lambda m: f"(?: |{SQL_LINE * 2})" if m[0] == " " else m[0], pattern)
    if parts.endswith(".*"):
        parts = parts[:-2] + f"[^{SQL_END}{SQL_LINE}]*"
    return parts.replace(".*", f"[^{SQL_END}]*?")


def scan_sql() -> str:
    """The rows by DuckDB: every sentence of every text, with a cue or without, wrapped or not.

    Marks are doubled, so that two neighbouring sentences can each have one beside them.
    """
    blank, marks = r"[\x20\x09-\x0D]", f"[{SQL_END}{SQL_LINE}]"
    steps = (
        (r"(?i)\b(v)\." + blank + "+([0-9])", r"\1 \2"),
        (r"([.!?;])" + blank + "+", rf"\1{END}"),
        (r"\n[\x20\x09\r]*\n", END),
        (r"\n[\x20\x09]*([A-Z0-9*(-])", rf"{LINE}\1"),
    )
    lowered = (
        (f"[^a-z0-9.+{SQL_END}{SQL_LINE}]+", " "),
        (r"\.+( |$)", " "),
        (rf"\.+({marks})", r" \1"),
        (" +", " "),
    )

    def replaced(text: str, all_steps: tuple) -> str:
        for pattern, by in all_steps:
            text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
        return text

    text = replaced(f"replace(coalesce(text, ''), '{LINE}', ' ')", steps)
    text = f"trim({replaced(f'lower({text})', lowered)})"
    text = replaced(text, ((f" ?({marks}) ?", r"\1"), (f"{SQL_LINE}+", LINE)))
    forms = [(n, _sql_form(p)) for n, p in (*SENTENCES, *HEADINGS)]
    any_form = "|".join(f"(?:{p})" for _, p in forms)
    cases = " ".join(f"WHEN regexp_full_match(x, '{p}') THEN '{n}'" for n, p in forms)
    rules = ", ".join(f"CASE WHEN sentence_ids LIKE '{rule_pattern(ids)}' THEN '{n}' END" for n, ids in RULES)
    order = ", ".join(f"'{n}'" for n in dict.fromkeys(n for n, _ in RULES))
    sql = f"""
WITH cut AS (
    SELECT doc_id, {text} AS s FROM documents
), named AS (
    SELECT doc_id, len(list_filter(string_split_regex(s, '{marks}'), lambda x: regexp_matches(x, '{CUE}'))) AS n_cue_sentences,
        list_transform(regexp_extract_all('{END}' || regexp_replace(s, '({marks})', '\\1\\1', 'g') || '{END}',
            '{marks}({any_form}){marks}', 1), lambda x: CASE {cases} END) AS ids
    FROM cut
), joined AS (
    SELECT doc_id, n_cue_sentences,
        coalesce(array_to_string(list_transform(ids, lambda i: ',' || i || ','), ''), '') AS sentence_ids
    FROM named
), met AS (
    SELECT *, list_filter([{rules}], lambda n: n IS NOT NULL) AS found FROM joined
), once AS (
    SELECT *, list_filter([{order}], lambda n: list_contains(found, n)) AS names FROM met
)
SELECT doc_id, n_cue_sentences::BIGINT AS n_cue_sentences, sentence_ids,
    coalesce(array_to_string(names, ','), '') AS licences, len(names)::BIGINT AS n_licences
FROM once"""
    for mark in (END, LINE):
        sql = sql.replace(mark, f"' || chr({ord(mark)}) || '")
    return sql
