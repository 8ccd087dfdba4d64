from shopflow.sources.files import (  # noqa: F401
    read_csv, read_csv_dir, read_json, read_lines, read_parquet,
    read_stream, read_xml_nested, register,
)
