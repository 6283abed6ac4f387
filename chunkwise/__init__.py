"""chunkwise: chunked time-series analytics and migration as Spark DataFrame jobs."""

from .config import Params, work_dir

__all__ = ["Params", "work_dir"]
__version__ = "0.1.0"
