"""What every part of the engine needs of a session: its code on the executors, and reliable checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    name = os.path.basename(root)
    archive = os.path.join(tempfile.mkdtemp(prefix=f"{name}-"), f"{name}.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    path = os.path.join(folder, f)
                    out.write(path, os.path.join(name, os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def _shared(sc: SparkContext) -> str:
    """The shared folder of the session, set as its checkpoint folder too.

    Where a session names none, a folder of our own does for a local master, whose tasks share our disk;
    on a cluster executors couldn't read it, so that is an error.
    """
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="terrane-checkpoint-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cuts lineage with a reliable checkpoint in the shared folder that spark.checkpoint.dir names."""
    _shared(df.sparkSession.sparkContext)
    return df.checkpoint(eager=True)


def forgotten(df: DataFrame) -> DataFrame:
    """A checkpoint for rounds of joins, whose plan keeps no estimates of what it came from.

    A join's estimated size is the product of its sides', and a plain checkpoint keeps it. A round of some joins triples the
    digits at least, so after a dozen rounds a single estimate has millions of them and fills the driver.
    """
    spark, kept = df.sparkSession, checkpointed(df)._jdf
    return DataFrame(spark._jsparkSession.createDataFrame(kept.javaRDD(), kept.schema()), spark)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A folder of this application under the one that spark.checkpoint.dir names, which all executors share, for tables that are written once and read often."""
    sc = spark.sparkContext
    folder = _shared(sc)
    return f"{folder.rstrip('/')}/{sc.applicationId}-{name}"
