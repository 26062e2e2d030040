"""domus: ingest, decode, search and keep current a stream of nested JSON listings on Spark.

Every operator is a ``DataFrame -> DataFrame`` function (or takes a format string plus
options), so file, message-broker and table endpoints are interchangeable.
"""

from domus.session import get_session, shared_dir

__all__ = ["get_session", "shared_dir"]
