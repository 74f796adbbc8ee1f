"""What the operators share: shipping code, the shared folder, tables written once."""

from __future__ import annotations

import io
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evalflow.session import fresh_folder

#: White space of the contracts: space and the controls from tab to carriage return.
SPACE = r"[\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, by way of the shared folder."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, str(file.relative_to(package.parent)))
    path = f"{fresh_folder(spark, package.name)}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    stream.write(packed.getvalue())
    stream.close()
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once as Parquet in the shared folder and read again.

    Later jobs start from the files: what lies before is not computed again, and a
    lost executor costs nothing that was written.
    """
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_rows(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """Only the columns an operator needs, a null text as an empty one."""
    return docs.select(*[F.col(c) for c in keep], F.coalesce(F.col(text), F.lit("")).alias("text"))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unused(name: str, taken: list[str]) -> str:
    """The name, with as many marks behind it as no column bears."""
    lower = {c.lower() for c in taken}
    while name in lower:
        name += "_"
    return name


def by_id(rows: DataFrame) -> list[Column]:
    """Keys of ranges in the order of ``doc_id``: rows of one id part by how their texts begin, then by hash.

    Within one id and beginning the order of ranges is that of the hash.
    """
    return [rows["doc_id"], F.left(rows["text"], F.lit(64)), F.xxhash64(rows["text"])]


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """``crc32`` of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))
