"""keelson.sources: readers and writers."""

from keelson.sources.readers import (load_seed, read_csv_inferred, read_json, read_months,
                                     read_partitioned, read_table)
from keelson.sources.sinks import (append, materialize, rebuild, replace_partition, write_as, write_bucketed,
                                   write_partitioned)

__all__ = ["load_seed", "read_csv_inferred", "read_json", "read_months", "read_partitioned",
           "read_table", "append", "materialize", "rebuild", "replace_partition", "write_as", "write_bucketed",
           "write_partitioned"]
