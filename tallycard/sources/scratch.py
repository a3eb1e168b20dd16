"""Folders for intermediate tables."""

import tempfile
import uuid


def scratch_dir(spark, purpose):
    """A new folder path for one job's intermediate tables.

    On a cluster it lies in the shared folder named by `spark.checkpoint.dir`. Only a local master may
    go without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master.startswith("local-cluster") or not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tallycard-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
