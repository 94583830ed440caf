"""clickengine: click and event analytics as Spark DataFrame / Structured Streaming operators.

Every operator takes and returns DataFrames and is built from Catalyst
expressions, so the optimizer can push filters, prune columns and pick the
physical join/aggregate strategy.  Subpackages:

- ``sources``   readers (text, CSV, delimited lines, Kafka, views, replay)
- ``sinks``     writers (text, CSV, JDBC, keyed upsert, JSON documents, buffered)
- ``functions`` column expressions and SQL function registration
- ``operators`` batch operators (transforms, aggregates, windows, top-N,
                joins, patterns, timers, distribution)
- ``streaming`` Structured Streaming forms and stateful processors
- ``plans``     named queries over the driver tables plus their SQL oracles
"""

from clickengine.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
