"""Small document tables for the operator tests."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
])

SYLLABLES = {
    "en": "the and ing ed er tion wh sh ou ea th re".split(),
    "de": "der und sch pf keit ung ver ein ä ö tz ch".split(),
    "fr": "le la eau oi ê é tre ment que ai on par".split(),
}


def words(rng: random.Random, lang: str, n: int) -> list[str]:
    return ["".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(n)]


def prose(rng: random.Random, lang: str = "en", n: int = 80) -> str:
    out, line = [], []
    for w in words(rng, lang, n):
        line.append(w)
        if rng.random() < 0.1:
            out.append(" ".join(line) + ".")
            line = []
    if line:
        out.append(" ".join(line) + ".")
    return "\n".join(out)


def rows(seed: int = 1, n: int = 60) -> list[tuple]:
    """Prose with copies, near copies, and the awkward cases: nulls in every
    column, empty and white texts, one very long text, repeated rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(SYLLABLES))
        text = prose(rng, lang, rng.randint(3, 160))
        out.append((i, text, lang, f"src{i % 4}", len(text)))
    for i in range(12):  # exact copies, near copies, shared passages
        base = out[i]
        out.append((n + i, base[1].replace(" ", "  ") if i % 3 == 0 else base[1], base[2], "src0", base[4]))
        near = base[1] + " end"
        out.append((n + 20 + i, near, base[2], "src1", len(near)))
    long = prose(rng, "en", 9000)
    out += [
        (n + 50, None, "en", "src0", None),
        (n + 51, "", None, "src0", 0),
        (n + 52, " \t\n ", "en", None, 4),
        (n + 53, long, "en", "src0", len(long)),
        (None, out[3][1], "de", None, 1),
        (n + 54, "###", "fr", "src1", 3),
        (n + 55, "aaaa" * 200, "en", "src2", 800),
        (n + 55, "aaaa" * 200, "en", "src2", 800),
    ]
    return out


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def with_extra(docs):
    """The table with further columns whose names operators use inside."""
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in ("digest", "size", "n", "f", "r", "fp", "x", "key", "kept", "taken", "_id")})


def as_set(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
