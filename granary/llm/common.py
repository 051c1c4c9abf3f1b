"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.session import shared_dir


#: Rows of whole texts that a Python worker gets at once: the session's usual 10,000 are tens of MB, held
#: several times over by the JVM and by each of an executor's workers.
TEXTS_AT_ONCE = 200


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``TEXTS_AT_ONCE`` rows, if they are larger or unlimited."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= TEXTS_AT_ONCE:
        spark.conf.set(key, str(TEXTS_AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, whatever else the table holds: an exact name wins over one that
    differs in case, and the first wins among equals."""
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    low = [c.lower() for c in df.columns]
    at = [df.columns.index(n) if n in df.columns else low.index(n.lower()) for n in names]
    return plain.select(*[F.col(f"c{i}").alias(n) for i, n in zip(at, names)])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and ``whole``: the complete row as a struct of fields f0, f1, ... so that
    no extra column can clash with a working one. ``unpacked`` turns it back."""
    plain = df.toDF(*[f"f{i}" for i in range(len(df.columns))])
    whole = plain.select(F.struct(*plain.columns).alias("whole"))
    low = [c.lower() for c in df.columns]
    at = [df.columns.index(n) if n in df.columns else low.index(n.lower()) for n in names]
    return whole.select("whole", *[F.col(f"whole.f{i}").alias(n) for i, n in zip(at, names)])


def unpacked(df: DataFrame, like: DataFrame, **new) -> DataFrame:
    """Rows of ``like`` from ``whole``; ``new`` replaces columns of these exact names."""
    cols = [new[c] if c in new else F.col(f"whole.f{i}") for i, c in enumerate(like.columns)]
    return df.select(*[c.alias(n) for c, n in zip(cols, like.columns)])


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def share(column, parts: int, wanted):
    """True where crc32 of the value as text leaves one of ``wanted`` on division by ``parts``; a null
    counts as the empty text."""
    rest = F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(parts))
    return rest.isin(*wanted)


LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
#: lower-cases A-Z and turns every byte below 128 that is no letter or digit into a space
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256)
)


def plain_words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of letters, digits and characters from U+0080 on, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
