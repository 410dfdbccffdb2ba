"""File discovery, byte sniffing, configuration and regions."""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FORMATS = ("%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M")


def local_time(written: str) -> float:
    for f in FORMATS:
        try:
            return datetime.strptime(written.strip(), f).timestamp()
        except ValueError:
            continue
    raise ValueError(f"no date and time: {written!r}")


def discover(spark: SparkSession, path: str, glob: str = "*.pdf", recursive: bool = True, before: datetime | None = None, after: datetime | None = None, content: bool = False) -> DataFrame:
    """path, modificationTime, length (and content) of files, strictly between two times, each once."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive).load(path)
    if before:
        df = df.where(F.col("modificationTime") < F.lit(before))
    if after:
        df = df.where(F.col("modificationTime") > F.lit(after))
    return (df if content else df.drop("content")).dropDuplicates(["path"])


def discover_folders(root: str, glob: str = "*.pdf", before: float | None = None, after: float | None = None) -> list[str]:
    """Files of the direct subfolders whose own times are strictly inside the bounds; the files' times don't count."""
    folders = [d for d in Path(root).iterdir() if d.is_dir() and (before is None or d.stat().st_mtime < before) and (after is None or d.stat().st_mtime > after)]
    return sorted({str(f.resolve()) for d in folders for f in d.rglob(glob)})


def sniffed_name(name: Column, content: Column, kind: Column) -> Column:
    """.pdf if the bytes or the content type say so, else .bin."""
    pdf = (F.substring(content, 1, 4) == F.lit(b"%PDF")) | F.coalesce(F.lower(kind).contains("application/pdf"), F.lit(False))
    return F.concat(name, F.when(pdf, ".pdf").otherwise(".bin"))


def unique_names(df: DataFrame, name: str, order: str) -> DataFrame:
    """_2, _3, ... before the suffix of later files of the same name."""
    n = F.row_number().over(Window.partitionBy(name).orderBy(order))
    return df.withColumn(name, F.when(n == 1, F.col(name)).otherwise(F.concat(F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1), F.lit("_"), n.cast("string"), F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 2))))


def read_regions(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.json(path, multiLine=True)
    return df.select(F.explode("regions").alias("r")).select("r.*")


def next_region_id(regions: DataFrame, page: int) -> str:
    top = regions.where(F.col("page") == page).agg(F.max(F.regexp_extract("id", r"_region_(\d+)$", 1).try_cast("int"))).first()[0]
    return f"page_{page:02d}_region_{(top or 0) + 1:02d}"


def rectangle(x0: float, y0: float, x1: float, y1: float) -> dict[str, float]:
    """Two clicks in any order."""
    return {"x0": round(min(x0, x1), 2), "y0": round(min(y0, y1), 2), "x1": round(max(x0, x1), 2), "y1": round(max(y0, y1), 2)}


@dataclass
class Paths:
    values: dict[str, str]
    root: Path

    def __getitem__(self, name: str) -> Path:
        if name not in self.values:
            raise KeyError(f"{name} isn't in the configuration")
        path = Path(self.values[name]).expanduser()
        return path if path.is_absolute() else self.root / path


def find_root(start: Path, marks: tuple[str, ...] = ("config", ".git")) -> Path:
    for folder in (start, *start.parents):
        if any((folder / m).exists() for m in marks):
            return folder
    return start


def load_paths(path: str | Path) -> Paths:
    """Scalars of a flat `key: value` file; `#` begins a comment. Relative *_dir, *_path and *_archive are under the project's root."""
    values = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        if m := re.match(r"^\s*([A-Za-z_][\w-]*)\s*:\s*(.*?)\s*(?:\s#.*)?$", line):
            values[m[1]] = m[2].strip("'\"")
    return Paths({k: v for k, v in values.items() if v}, find_root(Path(path).resolve().parent))
