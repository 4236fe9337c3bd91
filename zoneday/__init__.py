"""zoneday: dense zone x day panels as Spark DataFrame jobs."""

__version__ = "0.1.0"
