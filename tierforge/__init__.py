"""tierforge: a PySpark toolkit for layered (bronze / silver / gold) sales warehouses.

Subpackages:
  functions  - column-expression cleaning rules
  operators  - DataFrame operators (latest per key, end-dating, surrogate keys, lookups)
  sources    - feeds, tables, audit log, storage configuration
  plans      - table builds, fixtures, the task runner and SQL oracles
  streaming  - incremental (file-stream) runs of the row-wise silver builds
"""

__version__ = "0.1.0"
