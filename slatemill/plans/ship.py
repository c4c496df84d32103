"""Sending this package to the Python workers of a session."""

import atexit
import io
import uuid
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import SparkSession

from slatemill.plans.cut import _remove, shared_dir

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Writes the package to the shared folder and adds it to the application's files, once, so that workers can import it."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    _shipped.add(app)
    package, packed = Path(__file__).resolve().parent.parent, io.BytesIO()
    with ZipFile(packed, "w") as z:
        for path in sorted(package.rglob("*.py")):
            z.write(path, path.relative_to(package.parent))
    jvm, folder = spark.sparkContext._jvm, f"{shared_dir(spark)}/slatemill-{uuid.uuid4().hex}"
    target = jvm.org.apache.hadoop.fs.Path(f"{folder}/slatemill_code.zip")
    out = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(packed.getvalue()))
    out.close()
    atexit.register(_remove, spark, folder)  # for the whole session, whatever scope is open
    spark.sparkContext.addPyFile(f"{folder}/slatemill_code.zip")
