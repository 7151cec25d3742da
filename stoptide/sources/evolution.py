"""Append-only tables whose columns grow.

The schema of a table is what all its writers have declared, column by column, in a log beside
its files (`_schema/<n>.json`). A writer declares its columns before it writes: new ones are
added to the log, a column of another type is refused. Readers take the schema from the log, so
files without a column give NULL, and no file has to be opened to know the columns.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .versions import Conflict, _Folder

_LOG = "_schema"


class SchemaConflict(ValueError):
    """A column that the table has with another type."""


def merged(known: T.StructType, new: T.StructType, where: str = "") -> T.StructType:
    """Both schemas' columns, the known ones first; all may be NULL.

    Columns are the same if their names differ in case only, as Spark resolves them. Structs
    merge by field, also inside arrays and maps; any other difference of type is refused.
    """
    fields = {f.name.lower(): f for f in known}
    if len(fields) < len(known.fields):
        raise SchemaConflict(f"columns that differ in case only: {known.names}")
    seen = set()
    for f in new:
        key = f.name.lower()
        if key in seen:
            raise SchemaConflict(f"two columns are called {where}{f.name}")
        seen.add(key)
        have = fields.get(key)
        kind = f.dataType if have is None else _both(have.dataType, f.dataType, where + f.name)
        fields[key] = T.StructField(f.name if have is None else have.name, kind, True)
    return T.StructType(list(fields.values()))


def _both(known: T.DataType, new: T.DataType, name: str) -> T.DataType:
    if isinstance(known, T.StructType) and isinstance(new, T.StructType):
        return merged(known, new, f"{name}.")
    if isinstance(known, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(_both(known.elementType, new.elementType, f"{name}[]"), True)
    if isinstance(known, T.MapType) and isinstance(new, T.MapType):
        return T.MapType(_both(known.keyType, new.keyType, f"{name}.key"),
                         _both(known.valueType, new.valueType, f"{name}.value"), True)
    if known != new:
        raise SchemaConflict(f"{name} is {known.simpleString()} in the table, and "
                             f"{new.simpleString()} in what is to be written")
    return known


def _newest(folder: _Folder) -> tuple[int, T.StructType | None]:
    numbers = sorted(int(n[:-5]) for n in folder.names(_LOG)
                     if n.endswith(".json") and not n.startswith("."))
    if not numbers:
        return 0, None
    text = folder.read(_LOG, f"{numbers[-1]:012d}.json")
    return numbers[-1], T.StructType.fromJson(json.loads(text))


def schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The table's columns; None before anybody has declared any."""
    return _newest(_Folder(spark, path))[1]


def declare(spark: SparkSession, path: str, wanted: T.StructType) -> T.StructType:
    """Add the columns of a writer to those of the table, and return them all.

    A table that was written before it had a log starts it with the columns of its files, which
    are opened for that once. Writers may declare at the same time: who comes second merges with
    what the first has added.
    """
    folder = _Folder(spark, path)
    while True:
        number, known = _newest(folder)
        if known is None:
            files = [n for n in folder.names() if not n.startswith(("_", "."))]
            known = spark.read.option("mergeSchema", "true").parquet(path).schema \
                if files else T.StructType([])
        both = merged(known, wanted)
        if number and both == known:
            return both
        folder.fs.mkdirs(folder.path(_LOG))
        try:
            folder.write_new(both.json(), _LOG, f"{number + 1:012d}.json")
            return both
        except Conflict:
            continue


def read(spark: SparkSession, path: str, options: dict[str, str] | None = None) -> DataFrame:
    """All rows with all columns, whichever of them a file has."""
    return spark.read.schema(_declared(spark, path)).options(**(options or {})).parquet(path)


def stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same as a stream; columns that come later need it to be started again."""
    reader = spark.readStream.schema(_declared(spark, path))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.parquet(path)


def _declared(spark: SparkSession, path: str) -> T.StructType:
    found = schema(spark, path)
    if found is None:
        raise ValueError(f"no columns have been declared for {path}")
    return found
