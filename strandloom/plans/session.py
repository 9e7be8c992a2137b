"""What bounds the memory of Python workers and of the driver."""

from __future__ import annotations

import ctypes
import gc
from contextlib import suppress

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

#: Rows and bytes of a batch between the JVM and a worker: texts may be long.
ARROW_ROWS, ARROW_BYTES = 2_000, 8 << 20


def bound_arrow_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def give_back(spark: SparkSession) -> None:
    """The driver returns memory that it no longer uses to the system.

    A collection shrinks the heap, and the C libraries of the JVM and of
    Python let go of what they keep for later. Without it both stay at their
    peaks, and in a long session the C library alone holds hundreds of MB for
    the JVM's threads. What a JVM or a system can't do is left out.
    """
    gc.collect()
    sc = spark.sparkContext
    jvm, array = sc._jvm, sc._gateway.new_array
    jvm.System.gc()
    with suppress(Py4JError, StopIteration):  # Linux, Java 17.0.9 and later; the server's own class is closed to Py4J, its interface is not
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        args = array(jvm.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        args[2], args[3] = array(jvm.Object, 0), array(jvm.String, 0)
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
