"""League analytics on Spark: nested match-data JSON -> star schema -> reports.

Everything here is plain DataFrame / Spark SQL: no UDFs, no optimizer
extensions, no session created at import time.
"""

from touchline.star import Star

__all__ = ["Star"]
