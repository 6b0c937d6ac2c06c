"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.session import ensure_checkpoint_dir

#: Words are runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_LOWER_TABLE = {ord(a): b for a, b in zip(UPPER, LOWER)}
_LOWER_BYTES = bytes.maketrans(UPPER.encode(), LOWER.encode())


def fresh(taken: list[str], stem: str) -> str:
    """A column name like ``stem`` that clashes with none of ``taken`` (case ignored)."""
    names = {c.lower() for c in taken}
    name = stem
    while name.lower() in names:
        name = f"{stem}_{uuid.uuid4().hex[:8]}"
    return name


def col(name: str) -> Column:
    """A column by its literal name (dots and spaces allowed)."""
    return F.col("`" + name.replace("`", "``") + "`")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The UTF-8 words of a text; ``bytes.split`` splits at just the six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def lower_words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER_BYTES).split() if text else []


#: Texts that a worker gets at once: whole texts are large rows.
TEXT_ROWS = 2000
_ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_shipped: set[str] = set()


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with a checkpoint folder (the cluster's if it names one) and
    this package sent to its Python workers, once per application.

    Where the session has Spark's default of 10,000 rows in an Arrow batch, it is
    set to ``TEXT_ROWS``, as whole texts are large rows; any other choice stays.
    """
    folder = ensure_checkpoint_dir(spark)
    sc = spark.sparkContext
    if spark.conf.get(_ARROW_ROWS) == "10000":  # Spark's default; a session's own choice stays
        spark.conf.set(_ARROW_ROWS, str(TEXT_ROWS))
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        bundle = io.BytesIO()
        with zipfile.ZipFile(bundle, "w") as z:
            for source in sorted(package.rglob("*.py")):
                z.write(source, source.relative_to(package.parent))
        # kept in the shared folder, from where every executor can fetch it
        path = sc._jvm.org.apache.hadoop.fs.Path(folder, "tableflow_package.zip")
        out = path.getFileSystem(sc._jsc.hadoopConfiguration()).create(path)
        out.write(bundle.getvalue())
        out.close()
        sc.addPyFile(path.toString())
        _shipped.add(sc.applicationId)
    return spark


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder: computed once, its lineage cut."""
    prepared(df.sparkSession)
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
