"""XLSX sheets as DataFrames: each workbook is streamed row by row in one task."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.numbers import excel_column, to_double

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
#: The registry's headers, in order, and the columns they become (fixed values).
REGISTRY = {
    "NombreProyecto": "nombre_proyecto", "FechaEmisionEtiqueta": "fecha_emision", "TipoCalificación": "estado_cev", "Región": "region_codigo", "Comuna": "comuna", "ZonaTérmica": "zona_termica",
    "Calificación": "etiqueta", "RolVivienda": "rol_vivienda", "RolProyecto": "rol_proyecto", "Longitud": "longitud", "Latitud": "latitud",
}


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    out = []
    with book.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if node.tag == NS + "si":
                out.append("".join(t.text or "" for t in node.iter(NS + "t")))
                node.clear()
    return out


def cell_text(cell: ElementTree.Element, strings: list[str]) -> str:
    if cell.get("t") == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(NS + "t"))
    value = cell.findtext(NS + "v") or ""
    return strings[int(value)] if cell.get("t") == "s" and value else value


def sheet_rows(blob: bytes, sheet: str) -> Iterator[tuple[int, list[str]]]:
    """(row number, cells) with gaps filled by empty text."""
    with zipfile.ZipFile(io.BytesIO(blob)) as book:
        strings = shared_strings(book)
        with book.open(sheet) as f:
            number = 0
            for _, row in ElementTree.iterparse(f):
                if row.tag != NS + "row":
                    continue
                number = int(row.get("r") or number + 1)
                cells: list[str] = []
                for cell in row.findall(NS + "c"):
                    ref = "".join(c for c in cell.get("r") or "" if c.isalpha())
                    at = excel_column(ref) if ref else len(cells)
                    cells += [""] * (at - len(cells))
                    cells.append(cell_text(cell, strings))
                yield number, cells
                row.clear()


def raw_rows(spark: SparkSession, path: str, sheet: str = "xl/worksheets/sheet1.xml") -> DataFrame:
    """path, row, cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, blob in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held: list[tuple[int, list[str]]] = []
                for row in sheet_rows(blob.as_py(), sheet):
                    held.append(row)
                    if len(held) == 5000:
                        yield pa.RecordBatch.from_arrays([pa.array([p] * len(held)), pa.array([r for r, _ in held], pa.int32()), pa.array([c for _, c in held], pa.list_(pa.string()))], ["path", "row", "cells"])
                        held = []
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([p] * len(held)), pa.array([r for r, _ in held], pa.int32()), pa.array([c for _, c in held], pa.list_(pa.string()))], ["path", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, row int, cells array<string>")


def read_xlsx(spark: SparkSession, path: str, sheet: str = "xl/worksheets/sheet1.xml", header: list[str] | None = None) -> DataFrame:
    """A sheet with a header row; with header given, it must be exactly that. Adds fila_origen, the sheet's row number."""
    rows = raw_rows(spark, path, sheet)
    first = rows.orderBy("row").limit(1).collect()
    names = [] if not first else list(first[0]["cells"])
    if header is not None and names != header:
        raise ValueError(f"header is {names}, not {header}")
    if not first:
        return spark.createDataFrame([], "fila_origen int")
    body = rows.where((F.col("row") > first[0]["row"]) & F.exists("cells", lambda c: c != ""))
    return body.select(F.col("row").alias("fila_origen"), *[F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit("")).alias(n) for i, n in enumerate(names)])


def registry(spark: SparkSession, path: str, sheet: str = "xl/worksheets/sheet3.xml") -> DataFrame:
    """The location registry: renamed, dates as ISO text, status and zone normalised."""
    df = read_xlsx(spark, path, sheet, list(REGISTRY)).withColumnsRenamed(REGISTRY)
    df = df.withColumns({c: F.trim(c) for c in REGISTRY.values()})
    return df.withColumns({"fecha_emision": dates.from_excel(F.col("fecha_emision")), "estado_cev": text.status(F.col("estado_cev")), "zona_termica": text.zone(F.col("zona_termica"))})


def typed_registry(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): date and coordinates must be there and in range."""
    typed = df.withColumns({"fecha_emision": F.try_to_date("fecha_emision", "yyyy-MM-dd"), "region_codigo": F.col("region_codigo").try_cast("smallint"), "longitud": to_double(F.col("longitud")), "latitud": to_double(F.col("latitud"))})
    ok = F.coalesce(F.col("fecha_emision").isNotNull() & F.col("longitud").between(-180, 180) & F.col("latitud").between(-90, 90), F.lit(False))
    return typed.where(ok), typed.where(~ok)
