"""Tables whose readers see one whole version: folders that are never changed, and a manifest that names them.

Each write goes to a folder of its own, ``<root>/version=<id>``, with the partitions below it. The manifest of a version is one
small JSON file: the schema, and the folder of each partition (an empty name for a table without partitions or rows). It is
published by one rename: before it, readers see the version before; after it, all of the new one. A write that breaks off
anywhere leaves the table as it was. Reading a manifest is no Spark job, and no footer is opened for the schema.

A partial replacement names new folders for the partitions it touches and the old ones for all others; nothing is copied.
The version before stays, for readers that have begun with it; what neither version names is removed after a write, leftovers
of broken runs among it. So a table has one writer at a time, and any number of readers.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from claimwright.session import COMPRESSION, remove

#: Spark's name of the partition of nulls.
NULL_PLACE = "__HIVE_DEFAULT_PARTITION__"
#: Versions that stay readable: the newest and those that readers may still hold.
KEPT = 2

Parts = dict[str, str]
#: The one place of a table without partitions.
WHOLE = ""


def _folders(path: str) -> list[str]:
    """Names of the folders ``column=value`` in ``path``; none where it is absent."""
    store, at = fs.FileSystem.from_uri(path)
    found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory and "=" in f.base_name)


@dataclass(frozen=True)
class VersionedTable:
    """A table below ``root``, partitioned by at most one column."""

    root: str
    kept: int = KEPT

    @property
    def manifest(self) -> str:
        return f"{self.root}/_manifest"

    def versions(self) -> list[int]:
        """Numbers of the published versions that are kept, oldest first."""
        store, at = fs.FileSystem.from_uri(self.manifest)
        found = store.get_file_info(fs.FileSelector(at, allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def _path(self, version: int) -> str:
        return f"{self.manifest}/{version:08d}.json"

    def _manifest(self, version: int | None = None) -> tuple[int, Parts, StructType | None]:
        numbers = self.versions()
        if not numbers or version is not None and version not in numbers:
            return 0, {}, None
        version = numbers[-1] if version is None else version
        store, at = fs.FileSystem.from_uri(self._path(version))
        with store.open_input_stream(at) as f:
            found = json.loads(f.read())
        return version, found["parts"], StructType.fromJson(found["schema"])

    def parts(self, version: int | None = None) -> tuple[int, Parts]:
        """Number and folders (by partition, below ``root``) of a version, by default the newest; 0 and none before the first."""
        return self._manifest(version)[:2]

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame:
        """The rows of one version. Raises FileNotFoundError where there is none."""
        number, parts, schema = self._manifest(version)
        if not number:
            raise FileNotFoundError(f"no published version of {self.root}")
        paths = [f"{self.root}/{f}" for f in sorted(parts.values())]
        return spark.read.schema(schema).option("basePath", self.root).parquet(*paths).select(*schema.names)

    def replace(self, rows: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """A version of just ``rows``, partitioned by at most one column."""
        before, _ = self.parts()
        folder, parts = self._written(rows, partition_by)
        self._publish(rows, before + 1, parts or {WHOLE: folder})

    def replace_partitions(self, rows: DataFrame, partition: str, places: Iterable[str]) -> None:
        """A version in which ``rows`` stand in for the partitions ``places``: those without a row go, the others stay.

        ``rows`` have the columns of the table; rows of any other partition are refused.
        """
        places = set(places)
        before, parts, schema = self._manifest()
        if schema is not None and set(rows.columns) != set(schema.names):
            raise ValueError(f"columns {rows.columns} are not those of {self.root}")
        folder, fresh = self._written(rows, (partition,))
        if not fresh.keys() <= places:
            raise ValueError(f"rows for partitions that were not named: {sorted(fresh.keys() - places)}")
        kept = {p: f for p, f in parts.items() if p != WHOLE and p not in places}
        self._publish(rows, before + 1, kept | fresh or {WHOLE: folder})

    def _written(self, rows: DataFrame, partition_by: Sequence[str]) -> tuple[str, Parts]:
        """Rows in a new folder, and its partitions. Rows are rebalanced by them: few files for each, and a hot one is split."""
        folder = f"version=v{uuid.uuid4().hex}"
        path = f"{self.root}/{folder}"
        if not partition_by:
            rows.write.parquet(path, compression=COMPRESSION)
            return folder, {}
        rows.hint("rebalance", *partition_by).write.partitionBy(*partition_by).parquet(path, compression=COMPRESSION)
        return folder, {unquote(f.split("=", 1)[1]): f"{folder}/{f}" for f in _folders(path)}

    def _publish(self, rows: DataFrame, version: int, parts: Parts) -> None:
        store, at = fs.FileSystem.from_uri(self._path(version))
        if store.get_file_info(at).type != fs.FileType.NotFound:
            raise RuntimeError(f"another writer has published version {version} of {self.root}")
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        unfinished = f"{at}.{uuid.uuid4().hex}"
        with store.open_output_stream(unfinished) as out:
            out.write(json.dumps({"schema": rows.schema.jsonValue(), "parts": parts}).encode())
        store.move(unfinished, at)
        self._retire(version)

    def _retire(self, newest: int) -> None:
        """Remove what the newest versions do not name."""
        held = set()
        for n in self.versions():
            if n <= newest - self.kept:
                store, at = fs.FileSystem.from_uri(self._path(n))
                store.delete_file(at)
            else:
                held |= set(self.parts(n)[1].values())
        for folder in _folders(self.root):
            if folder not in held:
                inner = [f"{folder}/{f}" for f in _folders(f"{self.root}/{folder}")]
                gone = [f for f in inner if f not in held]
                for path in gone if len(gone) < len(inner) else [folder]:
                    remove(f"{self.root}/{path}")
