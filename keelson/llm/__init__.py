"""Training-data operators: corpus operators, each in a module of its own,
with the registered queries in ``queries`` and their DuckDB SQL in ``oracle``.

Nothing else in the package imports this subpackage. Modules that run Python
in tasks need the package on the executors (``--py-files`` or an installed
package), as usual for PySpark code.
"""
