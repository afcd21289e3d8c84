"""Raw and mart tables in layered databases."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_TABLES
from ..session import side_by_side

#: Folder name of rows without a value, as Spark writes it.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _folder(column: str, value: str | None) -> str:
    return f"PARTITION ({column}={'null' if value is None else repr(value)})"


def _form(schema: StructType, partition_by: list[str]) -> tuple:
    """Columns with their types, folder columns last, and the folder columns."""
    columns = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    return sorted(columns, key=lambda c: c[0] in partition_by), partition_by


@dataclass(frozen=True)
class Warehouse:
    """Databases ``raw_<domain>``, ``staging`` and ``marts`` below one root folder.

    ``prefix`` keeps several warehouses apart in one catalog.
    """

    spark: SparkSession
    root: str
    prefix: str = ""

    def database(self, layer: str) -> str:
        name = f"{self.prefix}{layer}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{self.root}/{layer}'")
        return name

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def exists(self, layer: str, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(layer, table))

    def read(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def declare(self, layer: str, table: str, schema: StructType) -> str:
        """Create an empty table with a fixed schema unless it exists."""
        name = self.name(layer, table)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
        return name

    def append(self, layer: str, table: str, rows: DataFrame) -> None:
        """Add rows to a declared table, matching columns by name."""
        name = self.name(layer, table)
        rows.select(*self.spark.table(name).columns).write.mode("append").insertInto(name)

    def replace(self, layer: str, table: str, rows: DataFrame, partition_by: list[str] | None = None) -> None:
        """Replace the whole table.

        The new rows go to a folder of their own, a generation, and the table is pointed at it once they are complete, so a
        job lost half-way leaves the previous contents readable. The table stays while it is pointed elsewhere: one catalog
        statement without folders, else one per folder. Only a change of columns, or several folder levels, drop and create it.
        """
        name = self.name(layer, table)
        target = self._write(layer, table, rows, partition_by)
        levels = partition_by or []
        if len(levels) < 2 and self.exists(layer, table) and self._form(name) == _form(rows.schema, levels):
            if levels:
                self._point(name, levels[0], rows.schema, target)
            else:
                self.spark.sql(f"ALTER TABLE {name} SET LOCATION '{target}'")
        else:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
            layout = f"PARTITIONED BY ({', '.join(levels)})" if levels else ""
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {layout} LOCATION '{target}'")
            if levels:
                self.spark.catalog.recoverPartitions(name)
        self.spark.catalog.refreshTable(name)

    def replace_folders(
        self, layer: str, table: str, rows: DataFrame, column: str, covered: Callable[[str | None], bool]
    ) -> None:
        """Replace the folders whose value is ``covered`` by ``rows``; such folders without new rows go, the others stay."""
        name = self.name(layer, table)
        self._point(name, column, rows.schema, self._write(layer, table, rows, [column]), covered)
        self.spark.catalog.refreshTable(name)

    def _write(self, layer: str, table: str, rows: DataFrame, partition_by: list[str] | None) -> str:
        target = f"{self.root}/{layer}/{table}__{uuid.uuid4().hex}"
        writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
        writer.parquet(target)
        return target

    def _form(self, name: str) -> tuple:
        folders = [c.name for c in self.spark.catalog.listColumns(name) if c.isPartition]
        return _form(self.spark.table(name).schema, folders)

    def _point(self, name: str, column: str, schema: StructType, target: str, covered: Callable[[str | None], bool] = lambda value: True) -> None:
        """Point the folders of a table at those below ``target``; covered folders that ``target`` lacks are dropped."""
        written = self.spark.read.schema(schema).parquet(target).select(F.col(column).cast("string")).distinct()
        new = {row[0] for row in written.collect()}  # one value per folder
        shown = [row[0].split("=", 1)[1] for row in self.spark.sql(f"SHOW PARTITIONS {name}").collect()]
        old = {None if value == _NULL_FOLDER else value for value in shown}
        for value in sorted(new, key=str):
            place = f"LOCATION '{target}/{column}={_NULL_FOLDER if value is None else value}'"
            change = f"{_folder(column, value)} SET {place}" if value in old else f"ADD {_folder(column, value)} {place}"
            self.spark.sql(f"ALTER TABLE {name} {change}")
        for value in sorted(old - new, key=str):
            if covered(value):
                self.spark.sql(f"ALTER TABLE {name} DROP {_folder(column, value)}")

    def location(self, layer: str, table: str) -> str:
        facts = self.spark.sql(f"DESCRIBE FORMATTED {self.name(layer, table)}")
        return facts.filter("col_name = 'Location'").first()["data_type"]

    def drop_superseded(self, layer: str, table: str) -> None:
        """Delete what earlier contents of a replaced table left behind, once no reader needs them.

        Whole generations go, and in those that are still in use the folders that the table does not point at any more.
        """
        used = {path.rsplit("/", 1)[0] for path in self.read(layer, table).inputFiles()}
        used = {path.split(f"/{layer}/", 1)[-1] for path in used} | {self.location(layer, table).rsplit("/", 1)[-1]}
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{layer}")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for generation in files.globStatus(jvm.org.apache.hadoop.fs.Path(folder, f"{table}__*")):
            place = generation.getPath()
            if not any(path.split("/")[0] == place.getName() for path in used):
                files.delete(place, True)
                continue
            for entry in files.globStatus(jvm.org.apache.hadoop.fs.Path(place, "*=*")):
                if f"{place.getName()}/{entry.getPath().getName()}" not in used:
                    files.delete(entry.getPath(), True)

    def load(self, domain: str, tables: dict[str, DataFrame]) -> None:
        """Load every raw table of a domain, side by side, replacing what was there."""
        side_by_side([
            partial(self.replace, f"raw_{domain}", table, tables[table].select(*schema.names))
            for table, schema in RAW_TABLES[domain].items()
        ])
