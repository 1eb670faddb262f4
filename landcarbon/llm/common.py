"""What the text operators share: reading columns, staging, text as bytes, joined spans."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Maps UTF-8 bytes: A-Z to lower case, what stands in no word to a blank. Bytes from 0x80 on belong to words.
WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)

BATCH_BYTES = 16 << 20
WHITE = r"\x20\x09-\x0D"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fresh(name: str, df: DataFrame) -> str:
    """``name``, made longer until no column of the table has it, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with batches bounded in bytes, so that very long texts do not meet in one batch."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxBytesPerBatch", str(2**31 - 1)).rstrip("bB")) > BATCH_BYTES:
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(fn, schema)


def word_list(text: str | None) -> list[bytes]:
    """Words of letters, digits and non-ASCII characters, ASCII lower case, as UTF-8; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()


def shared_path(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``, which all executors share.

    Only a local session may leave it unset and then writes to a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        given = spark.sparkContext.getCheckpointDir()
        if given is None and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        if given is None:
            import tempfile

            given = tempfile.mkdtemp(prefix="llm-stage-")
        base = given
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def staged(df: DataFrame) -> DataFrame:
    """Write a table to the shared folder and read on from there, also after executors are lost."""
    path = shared_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def mounted(path: str) -> str:
    """The shared folder as executors open it; needs a folder that is mounted on every machine."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise RuntimeError(f"{path} is not a mounted folder; give one that every machine can open")
    return path
