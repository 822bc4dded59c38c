"""Session set-up and the shared folder for tables a job writes between steps."""

import tempfile
import uuid

from pyspark.sql import SparkSession


_local_parents = {}


def build_session(name="tallystone", master=None, **conf):
    """A session with the settings the jobs are written for.

    Skewed shuffle partitions are split even where that costs another shuffle, because
    one facility or borrower may own a large part of the ledger.
    """
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark, label):
    """A fresh folder every executor can reach, for one run.

    The cluster names the parent in ``spark.checkpoint.dir``. Only a single-machine
    session without that setting gets a temporary folder.
    """
    parent = spark.conf.get("spark.checkpoint.dir", None)
    if parent is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        application = spark.sparkContext.applicationId
        if application not in _local_parents:
            _local_parents[application] = tempfile.mkdtemp(prefix="tallystone-")
        parent = _local_parents[application]
    return f"{parent.rstrip('/')}/{label}-{uuid.uuid4().hex}"
