"""kestrel — Spark-native data-quality and customer analytics.

Every operator is a ``DataFrame -> DataFrame`` function built from the
DataFrame / SQL / Structured Streaming APIs, so Catalyst plans the work and
nothing but bounded, schema-sized metadata ever reaches the driver.
"""

from kestrel.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
