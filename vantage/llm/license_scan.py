"""Licence scan by canonical digests.

A text's canonical form is lower case, without copyright lines (nor the lines
'All rights reserved.' and 'MIT License' or the like), with every run
of signs and white space as one space, and with equivalent spellings unified.
Its SHA-256 is joined to the digests of known licence texts: a document is a
licence when its whole text is one in this sense. Lines are looked up in the
same way among known one-line notices.

DataFrame operations only, one pass over the scan. The known texts are a
broadcast table behind a size check (``known_rows``); a larger table is joined
by a shuffle of digests.

Defined results: a null text counts as empty; an empty canonical form is no
licence; rows are judged one by one, so repeated rows and null or repeated ids
give a row each; of two known names with one digest the smaller counts; an
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.llm.license_texts import NOTICES, SPELLINGS, TEXTS
from vantage.llm.shared import whole_text

SIGNS = r"[^\p{L}\p{N}]+"
# A copyright line: the mark, perhaps behind comment signs, and then a year, a
# (c) or a name in brackets somewhere in the line. The lines around it are the
# reservation of rights and the heading of a short licence.
_LINE = r"[^\p{L}\p{N}\n©(]*(?:copyright|©|\(c\))[^\n]*(?:\(c\)|©|[0-9]{4}|<|\[)[^\n]*"
_BSD = r"(?:(?:new|simplified|modified|revised|original) )?(?:(?:[023]-clause|zero-clause) bsd|bsd(?: (?:[023][ -]clause|zero clause))?)"
_NEW = r"(?: \x22(?:new|revised|modified|simplified)\x22(?: or \x22(?:new|revised|modified|simplified)\x22)?)?"
_HEADING = rf"(?:the )?(?:mit|isc|zlib|zlib/libpng|{_BSD}){_NEW} licen[cs]e(?: \((?:mit|isc|zlib|0bsd|bsd)\))?|zero-clause bsd"
COPYRIGHT = rf"(?m)^(?:{_LINE}|[^\p{{L}}\p{{N}}\n]*(?:all rights reserved|{_HEADING})[^\p{{L}}\p{{N}}\n]*)$"
KNOWN_ROWS = 10_000


def canonical(text: Column) -> Column:
    low = F.lower(text)
    lines = F.regexp_replace(low, COPYRIGHT, " ")
    plain = F.concat(F.lit(" "), F.trim(F.regexp_replace(lines, SIGNS, " ")), F.lit(" "))
    fixed = plain
    for old, new in SPELLINGS.items():
        fixed = F.replace(fixed, F.lit(f" {old} "), F.lit(f" {new} "))
    some = "|".join(SPELLINGS)
    return F.trim(F.when(plain.rlike(some), fixed).otherwise(plain))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_table(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """(name, digest) of known texts."""
    rows = spark.createDataFrame(sorted(texts.items()), "name string, text string")
    return rows.select("name", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("name").alias("name"))


def scan(docs: DataFrame, texts: DataFrame | None = None, notices: dict[str, str] = NOTICES) -> DataFrame:
    """One row per document row: doc_id, canonical_sha256, license (the known
    licence the whole text is, or null), n_notice_lines, notices (names of the
    licences its notice lines name, sorted, joined by commas).

    ``texts``: (digest, name), by default of ``license_texts.TEXTS``.
    """
    spark = docs.sparkSession
    texts = texts if texts is not None else known_table(spark, TEXTS)
    few = texts.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS
    known = texts.select(F.col("digest").alias("k_digest"), F.col("name").alias("license"))
    # the notices are the caller's short list: a map literal of their canonical forms
    forms = spark.createDataFrame(sorted(notices.items()), "line string, name string")
    pairs = forms.select(canonical(F.col("line")).alias("form"), "name").groupBy("form").agg(F.min("name").alias("name"))
    names = F.create_map(*[F.lit(x) for r in sorted(pairs.collect()) for x in (r.form, r.name)])
    # canonical() per line, on lines that could be one
    lines = F.filter(F.split(F.col("text"), "\n"), lambda x: F.lower(x).rlike("licen[cs]e"))
    found = F.transform(lines, lambda x: names[canonical(x)] if notices else F.lit(None).cast("string"))
    hits = F.filter(found, lambda x: x.isNotNull())
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    rows = rows.select(
        "doc_id", digest(F.col("text")).alias("canonical_sha256"), F.size(hits).cast("long").alias("n_notice_lines"),
        F.array_join(F.array_sort(F.array_distinct(hits)), ",").alias("notices"),
    )
    out = rows.join(F.broadcast(known) if few else known, F.col("canonical_sha256") == F.col("k_digest"), "left")
    return out.select("doc_id", "canonical_sha256", "license", "n_notice_lines", "notices")
