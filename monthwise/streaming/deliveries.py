"""Deliveries in a landing folder as a stream source.

A delivery is what one month is sent as: a file, a folder of part files, or
numbered parts.  The source's offset is the number of a *manifest*, which
names whole deliveries with their files; a batch is the manifests between two
offsets.  So a batch that is run again, after a crash or a lost executor, is
the same set of files whatever has come since.

* ``latestOffset`` looks at the folders whose modification time has changed
  since they were last listed, finds files that no manifest has (by path, time
  and size), and writes a manifest of their deliveries with all their files.
  Unchanged folders are not listed again.  (A store without folder times has
  all its folders listed.)
* ``read`` gives the files of a manifest: ``manifest, unit, path,
  modificationTime, length``.
* ``commit`` takes the deliveries of a finished batch away when asked to
  (``clean``: archive or delete): a folder as a whole, and only if it still
  holds just the files that were loaded, so a part that came meanwhile keeps
  its delivery in place, to be sent again whole.  A numbered part that comes
  after its fellows were archived is sent with them, read from the archive (after
  they were deleted it is an error); a folder or file that comes again is a new
  delivery.

Spark asks for the commit of a batch when the next one begins;
``finish_deliveries`` does it for the last one, from the stream's own commit log.

Writers must bring files in by rename or as new files, as Hadoop's and Spark's
do: a file overwritten in place does not change its folder's time.  Hidden
names (``_``, ``.``) are left out.  Opened with pyarrow: a file system that
pyarrow does not open cannot be a landing folder of this source.
"""

from __future__ import annotations

import datetime as dt
import json
import re
import time
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from monthwise.functions.calendar import LANDING_PREFIX
from monthwise.sources.footers import open_file_system

SCHEMA = "manifest long, unit string, path string, modificationTime timestamp, length long"

#: Folders whose time is this close to their listing are listed again: a file
#: may have come in the same tick.
SETTLE_S = 2.0
#: Files of a manifest that one task reads.
FILES_A_TASK = 10_000
#: Files that are taken away at once.
MOVERS = 16

PART = re.compile(r"-([0-9]{5})\.parquet$")


def unit_of(path: str, prefix: str = LANDING_PREFIX) -> str:
    """``month_unit`` for one path: the delivery it belongs to, empty if none."""
    found = re.match("(.*" + re.escape(prefix) + "[0-9]{4}[_-](?:0[1-9]|1[0-2])[^/]*)", path)
    return PART.sub("", found[1]) if found else ""


class Landing:
    """The landing folder and the log of manifests, on one file system each."""

    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.log = options["log"].rstrip("/")
        self.prefix = options.get("prefix", LANDING_PREFIX)
        self.clean = options.get("clean", "")
        self.archive = options.get("archive", "").rstrip("/")
        self.max_files = int(options.get("maxfiles", "0"))
        if self.clean not in ("", "archive", "delete"):
            raise ValueError(f"clean must be archive or delete, not {self.clean}")
        if self.clean == "archive" and not self.archive:
            raise ValueError("clean=archive needs the archive folder")
        self.fs, self.base = open_file_system(self.root)
        # what a path has before the part that pyarrow knows
        self.scheme = self.root[: -len(self.base)] if self.root.endswith(self.base) else ""

    # the log

    def numbers(self) -> list[int]:
        from pyarrow.fs import FileSelector

        fs, base = open_file_system(self.log)
        names = [i.base_name for i in fs.get_file_info(FileSelector(base, allow_not_found=True))]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"[0-9]+\.json", n))

    def manifest(self, number: int) -> dict:
        fs, base = open_file_system(self.log)
        with fs.open_input_file(f"{base}/{number}.json") as f:
            return json.loads(f.read())

    def write(self, number: int, manifest: dict) -> None:
        fs, base = open_file_system(self.log)
        fs.create_dir(base, recursive=True)
        with fs.open_output_stream(f"{base}/_{number}.json") as f:
            f.write(json.dumps(manifest).encode())
        fs.move(f"{base}/_{number}.json", f"{base}/{number}.json")

    # the landing folder

    def info(self, path: str):
        return self.fs.get_file_info([path])[0]

    def children(self, folder: str):
        from pyarrow.fs import FileSelector

        found = self.fs.get_file_info(FileSelector(folder, allow_not_found=True))
        return [i for i in found if not i.base_name.startswith(("_", "."))]

    def archived(self, number: int, path: str) -> str:
        """Where a batch's file or folder goes, its place below the landing kept."""
        _, to = open_file_system(self.archive)
        return f"{to}/batch={number}{path[len(self.base):]}"

    def take_away(self, number: int) -> None:
        """Archive or delete the deliveries of one manifest; safe to repeat."""
        from pyarrow.fs import FileType

        if not self.clean:
            return
        with ThreadPoolExecutor(MOVERS) as pool:
            for unit, files in self.manifest(number)["deliveries"].items():
                live = {f["path"]: f for f in files if not f.get("archived")}
                if unit and self.info(unit).type == FileType.Directory:
                    if {i.path for i in self._below(unit)} == set(live):
                        self._away(number, unit)
                    continue
                # a file delivered anew under the name is left for its own batch
                same = [
                    i.path
                    for i in self.fs.get_file_info(list(live))
                    if i.type == FileType.File and [i.mtime_ns, i.size] == [live[i.path]["mtime"], live[i.path]["size"]]
                ]
                for _ in pool.map(self._away, [number] * len(same), same):
                    pass

    def _away(self, number: int, path: str) -> None:
        from pyarrow.fs import FileType

        if self.clean == "delete":
            if self.info(path).type == FileType.Directory:
                self.fs.delete_dir(path)
            else:
                self.fs.delete_file(path)
            return
        to = self.archived(number, path)
        self.fs.create_dir(to.rsplit("/", 1)[0], recursive=True)
        self.fs.move(path, to)

    def _below(self, folder: str):
        from pyarrow.fs import FileType

        for i in self.children(folder):
            if i.type == FileType.Directory:
                yield from self._below(i.path)
            elif i.path.endswith(".parquet"):
                yield i


class DeliveryReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self._landing = None
        self._folders: dict[str, tuple] = {}  # folder -> (its time, when listed)
        self._files: dict[str, list] = {}  # live file -> [time, size]
        self._sent: dict[str, list] = {}  # file of a manifest -> [time, size]
        self._parts: dict[str, dict] = defaultdict(dict)  # unit -> part number -> archived file
        self._last = 0

    @property
    def landing(self) -> Landing:
        if self._landing is None:
            self._landing = Landing(self.options)
            for number in self._landing.numbers():
                self._remember(number, self._landing.manifest(number))
        return self._landing

    def __getstate__(self):
        return {"options": self.options}

    def __setstate__(self, state):
        self.__init__(state["options"])

    def _remember(self, number: int, manifest: dict) -> None:
        self._last = number
        for unit, files in manifest["deliveries"].items():
            parts = {}
            for f in files:
                if not f.get("archived"):
                    self._sent[f["path"]] = [f["mtime"], f["size"]]
                part = PART.search(f["path"])
                if part and self._landing.clean:
                    parts[part[1]] = self._taken_away(number, f)
            self._parts[unit] = parts

    def _taken_away(self, number: int, f: dict) -> dict | None:
        if f.get("archived") or self._landing.clean == "delete":
            return f if f.get("archived") else None
        return {**f, "path": self._landing.archived(number, f["path"]), "archived": True}

    def initialOffset(self) -> dict:
        return {"manifest": 0}

    def _look(self) -> None:
        """Bring ``_files`` up to date from the folders that have changed."""
        from pyarrow.fs import FileType

        landing = self.landing
        known = landing.fs.get_file_info(list(self._folders)) if self._folders else []
        todo = [] if self._folders else [landing.base]
        for i in known:
            seen, listed = self._folders[i.path]
            if i.type != FileType.Directory:
                del self._folders[i.path]
                self._files = {p: f for p, f in self._files.items() if not p.startswith(f"{i.path}/")}
            elif i.mtime is None or i.mtime_ns != seen or listed - i.mtime.timestamp() < SETTLE_S:
                todo.append(i.path)
        while todo:
            folder = todo.pop()
            at, info = time.time(), landing.info(folder)
            if info.type != FileType.Directory:
                self._folders.pop(folder, None)
                continue
            self._folders[folder] = (info.mtime_ns, at)
            found = landing.children(folder)
            files = {i.path: [i.mtime_ns, i.size] for i in found if i.type == FileType.File and i.path.endswith(".parquet")}
            gone = [p for p in self._files if p.rsplit("/", 1)[0] == folder and p not in files]
            for p in gone:
                del self._files[p]
            self._files.update(files)
            todo += [i.path for i in found if i.type == FileType.Directory and i.path not in self._folders]

    def latestOffset(self) -> dict:
        landing = self.landing
        self._look()
        units = defaultdict(list)
        for path in self._files:
            units[unit_of(path, landing.prefix)].append(path)
        new: dict[str, list] = {}
        taken = 0
        for unit, paths in sorted(units.items(), key=lambda u: (min(self._files[p][0] for p in u[1]), u[0])):
            fresh = [p for p in paths if self._files[p] != self._sent.get(p)]
            if not fresh:
                continue
            # files that name no month are no delivery; each is sent once
            sent = sorted(paths if unit else fresh)
            files = [{"path": p, "mtime": self._files[p][0], "size": self._files[p][1]} for p in sent]
            numbers = {m[1] for p in sent if (m := PART.search(p))}
            away = self._parts.get(unit, {})
            if unit and numbers and not numbers & set(away):  # late parts join their fellows
                if None in away.values():
                    raise ValueError(f"a part of {unit} came after its fellows were loaded and deleted")
                files += away.values()
            if landing.max_files and taken and taken + len(files) > landing.max_files:
                break
            new[unit] = files
            taken += len(files)
        if new:
            landing.write(self._last + 1, {"deliveries": new})
            self._remember(self._last + 1, {"deliveries": new})
        return {"manifest": self._last}

    def partitions(self, start: dict, end: dict):
        out = []
        for number in range(start["manifest"] + 1, end["manifest"] + 1):
            files = sum(map(len, self.landing.manifest(number)["deliveries"].values()))
            out += [InputPartition((number, lo)) for lo in range(0, files, FILES_A_TASK)]
        return out

    def read(self, partition):
        number, lo = partition.value
        landing = Landing(self.options)
        rows = ((unit, f) for unit, files in landing.manifest(number)["deliveries"].items() for f in files)
        for i, (unit, f) in enumerate(rows):
            if lo <= i < lo + FILES_A_TASK:
                at = dt.datetime.fromtimestamp(f["mtime"] / 1e9, dt.timezone.utc)
                name = landing.scheme + unit if unit else ""
                yield number, name, landing.scheme + f["path"], at, f["size"]

    def commit(self, end: dict) -> None:
        # manifests of earlier batches were taken away with those
        landing = self.landing
        for number in range(max(1, getattr(self, "_cleaned", 0) + 1), end["manifest"] + 1):
            landing.take_away(number)
            self._cleaned = number

    def stop(self) -> None:
        pass


class Deliveries(DataSource):
    """Options: ``path`` (the landing folder), ``log`` (the manifests), and
    optionally ``prefix``, ``clean`` (archive, delete), ``archive``, ``maxFiles``."""

    @classmethod
    def name(cls) -> str:
        return "deliveries"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> DataSourceStreamReader:
        return DeliveryReader({k.lower(): v for k, v in self.options.items()})


def batch_state(checkpoint: str) -> tuple[int, bool]:
    """(the manifest up to which the stream has finished its batches, whether
    a batch has begun and not finished)."""
    from pyarrow.fs import FileSelector

    fs, base = open_file_system(checkpoint.rstrip("/"))

    def last(kind: str) -> int:
        found = fs.get_file_info(FileSelector(f"{base}/{kind}", allow_not_found=True))
        return max((int(i.base_name) for i in found if i.base_name.isdigit()), default=-1)

    done = last("commits")
    if done < 0:
        return 0, last("offsets") > done
    with fs.open_input_file(f"{base}/offsets/{done}") as f:
        lines = f.read().decode().splitlines()
    return json.loads(lines[-1])["manifest"], last("offsets") > done  # one source: the last line is its offset


def finish_deliveries(options: dict, checkpoint: str) -> None:
    """Take away what finished batches have loaded."""
    reader = DeliveryReader({k.lower(): v for k, v in options.items()})
    reader.commit({"manifest": batch_state(checkpoint)[0]})
