"""What the operators share: staged tables, the id column, and the white space of words."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word is a run of characters outside of this class.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
SPACE_CHARACTERS = " \t\n\x0b\x0c\r"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is ``spark.checkpoint.dir`` or, where that is unset, a folder of the
    warehouse. What is staged there stays until the owner of the folder
    expires it, as checkpoints do.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return (folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def staged(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` written to the shared folder and read back.

    The copy cuts the lineage and outlives every executor, so nothing behind
    it is computed twice.
    """
    path = new_folder(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Let Python workers find this package also where it is not installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(frame: DataFrame, wish: str) -> str:
    """A column name that ``frame`` doesn't have."""
    taken = {name.lower() for name in frame.columns}
    while wish.lower() in taken:
        wish += "_"
    return wish


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; other letters stay."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def words(text: Column) -> Column:
    """The words of a text; none for NULL."""
    split = F.split(F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARACTERS)), f"{SPACE}+")
    return F.filter(split, lambda word: word != "")


def first_by_hash(frame: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """Of each group the first ``most`` keys by their hash, numbered in ``place``.

    Groups are counted, and only keys whose hash is below a bound that leaves
    about twice as many go on: to the driver, a number or two each. Keys are
    unique in a group, and groups are few and not NULL.
    """
    spark = frame.sparkSession
    counts = frame.groupBy(group).count().collect()
    # Far more than the usual deviation above twice ``most``.
    bounds = [(row[group], min(1.0, (2 * most + 200) / row["count"])) for row in counts]
    schema = T.StructType([frame.schema[group], T.StructField("bound", T.DoubleType())])
    hashed = F.xxhash64(key)
    share = F.pmod(hashed, F.lit(1 << 52)) / F.lit(float(1 << 52))
    few = (
        frame.join(F.broadcast(spark.createDataFrame(bounds, schema)), group)
        .filter(share < F.col("bound"))
        .select(group, key, share.alias("share"))
    )
    ranked: dict[object, list] = {}
    for row in few.collect():
        ranked.setdefault(row[group], []).append((row["share"], row[key]))
    rows = [
        (name, chosen, place)
        for name, found in ranked.items()
        for place, (_, chosen) in enumerate(sorted(found)[:most], 1)
    ]
    fields = [frame.schema[group], frame.schema[key], T.StructField("place", T.IntegerType())]
    return spark.createDataFrame(rows, T.StructType(fields))


def is_held_out(folds: int, fold: int) -> Column:
    """Whether crc32 of doc_id as text modulo ``folds`` is ``fold``; true for a row without an id."""
    checksum = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(checksum % folds == fold, F.lit(True))
