from .readers import read_csv_typed, read_libsvm, schema_of, table, tables
from .inline import inline_table
from .spread import dealt
from .shared import exists, materialize, new_shared_path, release, shared_root

__all__ = ["read_csv_typed", "read_libsvm", "schema_of", "table", "tables", "inline_table",
           "exists", "materialize", "new_shared_path", "release", "shared_root",
           "dealt"]
