"""Session settings the jobs are written for, and the package on the executors."""

import os
import shutil
import tempfile

# Skewed join partitions are split at run time. A join whose smaller side turns out to fit in memory per
# partition is hashed, which saves sorting the transactions once more. Arrow batches are large as the Python step only reads
# numbers from them. Expressions are built without a stack walk for each.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "50000",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def configure(builder):
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder


_SHIPPED = set()


def ship(spark):
    """Send this package to the executors of the session, once per application.

    Python tasks import it there. Where it is installed on all machines, there is no need to call this.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = shutil.make_archive(
        os.path.join(tempfile.mkdtemp(prefix="tallycard-"), "tallycard"),
        "zip",
        root_dir=os.path.dirname(package),
        base_dir=os.path.basename(package),
    )
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
