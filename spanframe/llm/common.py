"""What the corpus operators share: shared folders, lineage cuts, words."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: The six characters that separate words.
SPACES = " \t\n\x0b\x0c\r"

_word_bytes = re.compile(rb"[^\x20\x09-\x0D]+")


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8 bytes; bytes.split() breaks at exactly the six separators."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or what setCheckpointDir was given.

    Where neither is set, a session on one machine gets a folder of its own; a
    cluster must name one, since a folder of the driver's machine is none.
    """
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if at is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spanframe-checkpoints-"))
        at = sc.getCheckpointDir()
    return at.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage ends there, and lost executors cost nothing done before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/spanframe/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
