from tidemark.sinks.files import export_views, write_csv, write_json

__all__ = ["export_views", "write_csv", "write_json"]
