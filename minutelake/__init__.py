"""minutelake: minute-granularity stream transport as Spark DataFrame jobs.

Every step of moving a stream (select closed collector files, publish into
minute partitions, merge, mirror, gap-fill, retention, audits) is a pure
``DataFrame -> DataFrame`` operator; I/O lives in ``sources``, ``sinks`` and
``streaming`` only.
"""

__version__ = "0.1.0"
