from shopflow.sinks.files import (  # noqa: F401
    count_of, encode_messages, write_bucketed, write_collections, output_inventory, run_metadata, write_csv,
    write_documents, write_parquet, write_xml,
)
