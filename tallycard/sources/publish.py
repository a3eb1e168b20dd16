"""Serving tables that are replaced as a whole."""

import re
import time
import uuid

# Versions of a table that stay: the one behind the view, and the one that readers may still be at.
KEPT_VERSIONS = 2


def publish(df, name):
    """Make `df` the content of the view `name`.

    The rows go to a table of their own and only the finished table is put behind the view. Readers
    never see a half-written table, and `df` may read the view it replaces. Older versions are dropped once
    the new one is in place. The tables lie in the session's warehouse folder.
    """
    spark = df.sparkSession
    version = f"{name}_v{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    df.write.saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    own = re.compile(re.escape(name.lower()) + r"_v\d{20}_[0-9a-f]{8}")
    versions = sorted(t.name for t in spark.catalog.listTables() if own.fullmatch(t.name.lower()))
    for old in versions[:-KEPT_VERSIONS]:
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    return spark.table(name)
