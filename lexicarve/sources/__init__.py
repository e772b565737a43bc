"""Sources and sinks."""

from .corpus import (CLASS_VOTES, TABLES, VOTE_COLUMNS, labelled_corpus, labelled_schema,
                     read_features_text, read_labelled_csv, read_table, with_class, write_csv,
                     write_features_text, write_parquet)
from .models import load_model, save_model

__all__ = ["CLASS_VOTES", "TABLES", "VOTE_COLUMNS", "labelled_corpus", "labelled_schema",
           "read_features_text", "read_labelled_csv", "read_table", "with_class", "write_csv",
           "write_features_text", "write_parquet", "load_model", "save_model"]
