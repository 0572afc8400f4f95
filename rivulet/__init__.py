"""rivulet: keyed event streams and upsert tables as Spark DataFrame operators.

Every operator is a ``DataFrame -> DataFrame`` function.  The same function
works on a batch DataFrame and, where Spark allows it, on a streaming one;
where the two need different plans there is a ``*_stream`` twin.
"""

from rivulet.session import checkpoint_root, get_spark

__all__ = ["get_spark", "checkpoint_root"]
