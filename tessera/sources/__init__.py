"""Sources (S1-S14) and sinks (K1-K7)."""

from tessera.sources.geojson import (flatten_properties, read_features,  # noqa: F401
                                     write_collections, write_documents, write_feature_lines)
from tessera.sources.ordered import (compare, convert_checked, fingerprint, read_ordered,  # noqa: F401
                                     write_ordered)
from tessera.sources.readers import (HeaderClash, drop_header_line, from_rows,  # noqa: F401
                                     header_schema, int_range, load, parse_lines, read_csv,
                                     read_csv_checked, read_csv_strings, read_header_csv_union,
                                     read_lines, read_parquet, read_trimmed)
from tessera.sources.sinks import (format_lines, global_sum, join_lines,  # noqa: F401
                                   read_back_count, row_count, write_csv, write_parquet,
                                   write_raw_lines, write_text)
