"""Small helpers of the operators in this package."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vantage.session import scratch_path

# Fixed by the data contracts: a word is a run of bytes other than ASCII white
# space. Python's bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"

# Field cut for held-out evaluation: crc32 of the id as text, modulo 5.
FOLDS = 5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fold(column: str = "doc_id") -> Column:
    """crc32 of the id's decimal text modulo FOLDS (a null id counts as empty text)."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS


def written(df: DataFrame, name: str, **options) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back:
    cuts the lineage, so a lost executor never recomputes what lies before."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def with_locators(docs: DataFrame) -> DataFrame:
    """(row, loc_file, loc_row): each row as a struct, with its place in the
    files it comes from, which names it even where ids repeat or are null.
    Rows that don't come straight from files are written first."""
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    try:
        return docs.select(row, F.col("_metadata.file_path").alias("loc_file"), F.col("_metadata.row_index").alias("loc_row"))
    except AnalysisException:
        return with_locators(written(docs, "located"))


def discard(df: DataFrame) -> None:
    """Removes the files of a ``written`` table that nothing needs any more,
    and lets the driver forget the shuffles of finished jobs."""
    spark = df.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    jvm = spark.sparkContext._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    gc.collect()
    jvm.System.gc()


def join_split(rows: DataFrame, table: DataFrame, key: str, weight: str, total: int, share: float = 0.001) -> DataFrame:
    """``rows`` left-joined to ``table`` (unique ``key``) without a hot key.

    Keys whose ``weight`` (their rows) exceeds ``share`` of ``total`` rows are
    joined by broadcast: there are at most 1 / share of them. Their rows then
    take part in the shuffled join of the others under a salt that matches
    nothing, so no partition holds more than its share, and ``rows`` is read
    once.
    """
    hot = F.col(weight) > total * share
    cols = [c for c in table.columns if c != key]
    mine = [F.col(c) for c in rows.columns]
    few = table.where(hot).select(F.col(key).alias("_hot"), F.struct(*cols).alias("_few"))
    rest = table.where(~hot).select(F.col(key).alias("_key"), F.struct(*cols).alias("_rest"), F.lit(0).alias("_zero"))
    salt = F.when(F.col("_hot").isNull(), 0).otherwise(1 + F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 20)).cast("int"))
    marked = rows.join(F.broadcast(few), F.col(key) == F.col("_hot"), "left").withColumn("_salt", salt)
    both = marked.join(rest, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_zero")), "left")
    found = F.coalesce("_few", "_rest")
    return both.select(*mine, *[found[c].alias(c) for c in cols])


def spread_text(column: str, chars: int, windows: int = 8) -> Column:
    """A text of at most ``chars`` characters as it is; of a longer one,
    ``windows`` pieces evenly spaced over the whole text, ``chars`` in all,
    without the words that a piece's ends cut."""
    text, size = F.col(column), max(1, chars // windows)
    room = F.length(text) - size
    pieces = []
    for k in range(windows):
        piece = F.substring(text, (F.floor(room * k / (windows - 1)) + 1).cast("int"), F.lit(size))
        inner = F.regexp_replace(piece, rf"^{WORD}(?={SPACE})" if k else "^$", "")
        inner = F.regexp_replace(inner, rf"(?<=[\x20\x09-\x0D]){WORD}$" if k < windows - 1 else "^$", "")
        pieces.append(inner)
    return F.when(F.length(text) > chars, F.concat_ws("\n", *pieces)).otherwise(text)


END = b"\xff"  # stands for the end of a text; no UTF-8 text holds this byte


def numbered_words(texts: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """(distinct words, their numbers in order): the words of all texts in a
    row, each text closed by END, which is number 0."""
    numbers = {END: 0}
    words = (b" \xff ".join(texts) + b" \xff").split() if texts else []
    number = numbers.setdefault
    at = np.fromiter((number(w, len(numbers)) for w in words), np.int32, len(words))
    return list(numbers), at


def slices(b: pa.RecordBatch, at: int, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows holding about ``size`` bytes of its text
    column ``at`` (one row at least), so that what is built from a run stays
    small whatever the batch."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    k = 0
    while k < len(b):
        before = int(ends[k - 1]) if k else 0
        to = max(k + 1, int(np.searchsorted(ends, before + size, "right")))
        yield b.slice(k, to - k)
        k = to


def text_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str | None]]]:
    """(first column, texts of the second) in blocks of about ``size`` bytes,
    so that memory doesn't follow the batch size."""
    for b in batches:
        keys, texts, held = [], [], 0
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py()
            keys.append(key)
            texts.append(text)
            held += len(text or "")
            if held >= size:
                yield keys, texts
                keys, texts, held = [], [], 0
        if keys:
            yield keys, texts


def hashed_share(rows: DataFrame, key: str, classes: str, most: int, seed: int) -> DataFrame:
    """About ``most`` rows of each class (fewer when there are fewer), chosen
    by a hash of ``key``: the same rows on every run. The classes are few."""
    counts = rows.groupBy(classes).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30)) / float(1 << 30)
    return rows.join(F.broadcast(counts), classes).where(place * F.col("_n") < most).drop("_n")
