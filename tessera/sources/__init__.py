"""Sources and sinks (S1-S21): CSV, JSON Lines, the document table, stored pages."""

from tessera.sources.csv import count_csv, read_csv, write_csv
from tessera.sources.doctable import DocumentTable
from tessera.sources.jsonl import count_jsonl, read_jsonl, write_jsonl
from tessera.sources.pages import read_pages, split_fetched
from tessera.sources.sinks import backup, clear, export, output_path, storage_info, table_info, write_sink

__all__ = ["DocumentTable", "backup", "count_csv", "count_jsonl", "export", "output_path",
           "read_csv", "read_jsonl", "read_pages", "split_fetched", "storage_info", "table_info",
           "clear", "write_csv", "write_jsonl", "write_sink"]
