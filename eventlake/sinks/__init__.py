"""Sinks: windowed files, warehouse table, key/value cell tables, bulk
document index. Files and tables of a stream go through Spark's own file sink
(``start_files``); the bulk and cell sinks are called from ``foreachBatch`` and
write anew what a replayed batch wrote."""

from eventlake.sinks.files import write_avro, write_windowed_text
from eventlake.sinks.tables import write_cells, write_warehouse

__all__ = ["write_avro", "write_windowed_text", "write_cells", "write_warehouse"]
