"""Spreadsheets: a reader for .xlsx as a Spark data source, schema resolution by header aliases, and a plain writer."""

from __future__ import annotations

import datetime as dt
import os
import re
import xml.etree.ElementTree as ET
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass, field
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from juriflow.functions.constants import REQUIRED
from juriflow.functions.text import plain

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_DATES = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}

# The headers under which each column may come, in order of preference.
ALIASES = {
    "processo": ("processo", "numero_processo", "n_processo"),
    "classe": ("classe", "classe_judicial"),
    "origem": ("origem",),
    "orgao_julgador": ("orgao_julgador",),
    "data": ("data", "data_expediente"),
    "polo_ativo": ("polo_ativo",),
    "polo_passivo": ("polo_passivo",),
    "expediente": ("expediente",),
    "prazo": ("prazo",),
    "assunto": ("assunto",),
    "secao_subsecao": ("secao_subsecao", "secao/subsecao"),
    "link": ("link",),
    "decisao": ("decisao_judicial", "decisao"),
    "nucleo": ("nucleo",),
}


def header_key(value) -> str:
    return re.sub(r"[^a-z0-9/]+", "_", plain("" if value is None else str(value))).strip("_")


def resolve(headers: list) -> dict[str, int]:
    """Column indexes by canonical name; of equal headers the last counts. ValueError without a required one."""
    at = {header_key(h): i for i, h in enumerate(headers)}
    found = {name: next(at[a] for a in aliases if a in at) for name, aliases in ALIASES.items() if any(a in at for a in aliases)}
    if missing := [c for c in REQUIRED if c not in found]:
        raise ValueError(f"required columns are missing: {missing}; headers: {headers}")
    return found


def _column(ref: str) -> int:
    n = 0
    for ch in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(ch) - 64
    return n - 1


class Workbook:
    """Cell values of an .xlsx file, as last calculated."""

    def __init__(self, path: str):
        if not os.path.exists(path):
            raise FileNotFoundError(path)
        self.zip = zipfile.ZipFile(path)
        book = ET.fromstring(self.zip.read("xl/workbook.xml"))
        rels = {r.get("Id"): r.get("Target") for r in ET.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        self.sheets = {s.get("name"): rels[s.get(f"{_R}id")] for s in book.iter(f"{_M}sheet")}
        self.since_1904 = any(p.get("date1904") in ("1", "true") for p in book.iter(f"{_M}workbookPr"))
        names = set(self.zip.namelist())
        self.strings: list[str] = []
        if "xl/sharedStrings.xml" in names:
            for item in ET.fromstring(self.zip.read("xl/sharedStrings.xml")).iter(f"{_M}si"):
                self.strings.append("".join(t.text or "" for t in self._texts(item)))
        self.dates: list[bool] = []
        if "xl/styles.xml" in names:
            styles = ET.fromstring(self.zip.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): f.get("formatCode") for f in styles.iter(f"{_M}numFmt")}
            formats = styles.find(f"{_M}cellXfs")
            for xf in formats if formats is not None else ():
                n = int(xf.get("numFmtId", 0))
                self.dates.append(n in _DATES or re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(n, "")), re.I) is not None)

    @staticmethod
    def _texts(item: ET.Element) -> Iterator[ET.Element]:
        """Text runs, without phonetic ones."""
        for child in item:
            if child.tag == f"{_M}t":
                yield child
            elif child.tag == f"{_M}r":
                yield from child.iter(f"{_M}t")

    def _value(self, cell: ET.Element):
        kind, v = cell.get("t", "n"), cell.find(f"{_M}v")
        if kind == "inlineStr":
            inline = cell.find(f"{_M}is")
            return "".join(t.text or "" for t in self._texts(inline)) if inline is not None else None
        if v is None or v.text is None:
            return None
        if kind == "s":
            return self.strings[int(v.text)]
        if kind == "b":
            return v.text == "1"
        if kind in ("str", "e", "d"):
            return v.text
        number = float(v.text)
        style = int(cell.get("s", 0))
        if style < len(self.dates) and self.dates[style]:
            day = dt.datetime(1904, 1, 1) if self.since_1904 else dt.datetime(1899, 12, 30)
            return day + dt.timedelta(seconds=round(number * 86400))
        return int(number) if number.is_integer() and "." not in v.text else number

    def rows(self, sheet: str | None = None) -> Iterator[list]:
        """Rows from the first to the last one used; rows left out in the file are empty lists."""
        name = next(iter(self.sheets)) if sheet is None else sheet
        if name not in self.sheets:
            raise KeyError(name)
        target = self.sheets[name]
        path = target.lstrip("/") if target.startswith("/") else f"xl/{target}"
        at = 0
        with self.zip.open(path) as f:
            for _, row in ET.iterparse(f):
                if row.tag != f"{_M}row":
                    continue
                number = int(row.get("r", at + 1))
                yield from ([] for _ in range(number - at - 1))
                at, cells = number, []
                for cell in row.iter(f"{_M}c"):
                    place = _column(cell.get("r")) if cell.get("r") else len(cells)
                    cells += [None] * (place - len(cells))
                    cells.append(self._value(cell))
                yield cells
                row.clear()


def _text(value) -> str | None:
    return None if value is None else str(value)


class XlsxSource(DataSource):
    """spark.read.format("xlsx").option("path", ...)[.option("sheet", ...)][.option("raw", "true")]: source_row and text columns.

    Columns are resolved by ALIASES; with raw they are the sheet's own headers, and the row's number is excel_row.
    """

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def _head(self) -> list:
        rows = Workbook(self.options["path"]).rows(self.options.get("sheet"))
        return next(rows, [])

    def _columns(self) -> dict[str, int]:
        head = self._head()
        if self.options.get("raw", "false").lower() == "true":
            return {str(h): i for i, h in enumerate(head) if h is not None}
        return resolve(head)

    def schema(self) -> StructType:
        row = "excel_row" if self.options.get("raw", "false").lower() == "true" else "source_row"
        return StructType([StructField(row, IntegerType()), *[StructField(c, StringType()) for c in self._columns()]])

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(dict(self.options), list(self._columns().items()))


class _Reader(DataSourceReader):
    def __init__(self, options: dict, columns: list[tuple[str, int]]):
        self.options, self.columns = options, columns

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # one file is one compressed stream

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = Workbook(self.options["path"]).rows(self.options.get("sheet"))
        next(rows, None)
        for number, cells in enumerate(rows, 2):
            yield (number, *[_text(cells[i]) if i < len(cells) else None for _, i in self.columns])


def read(spark: SparkSession, path: str, sheet: str | None = None, raw: bool = False) -> DataFrame:
    spark.dataSource.register(XlsxSource)
    reader = spark.read.format("xlsx").option("path", path).option("raw", str(raw).lower())
    return (reader.option("sheet", sheet) if sheet else reader).load()


def read_table(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    """A decisions table of any supported kind, columns resolved by alias, with source_row (row 2 first).

    Rows of files other than spreadsheets are numbered by their own source_row where they have one.
    """
    if path.endswith(".xlsx"):
        return read(spark, path, sheet)
    if path.endswith(".csv"):
        df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    elif path.endswith((".json", ".jsonl")):
        df = spark.read.json(path)
    else:
        df = spark.read.parquet(path)
    found = resolve(df.columns)
    if "source_row" in df.columns:
        return df.select("source_row", *[df[df.columns[i]].alias(c) for c, i in found.items()])
    # row order is meaning here: a scan's partitions are in order, and so are the rows within; their counts are a row for each partition
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND((1 << 33) - 1)
    named = df.select(F.monotonically_increasing_id().alias("_id"), *[df[df.columns[i]].cast("string").alias(c) for c, i in found.items()])
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = df.select(F.monotonically_increasing_id().alias("_id")).groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    sums = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = named.withColumn("_part", part).join(F.broadcast(sums), "_part")
    return numbered.select((F.col("_before") + place + 2).cast("int").alias("source_row"), *found)


_BAD = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
MAX_CELL = 32_767


class Formula(str):
    """A cell that a spreadsheet works out, with the value that is shown until then."""

    value: object = None

    @classmethod
    def of(cls, formula: str, value) -> Formula:
        out = cls(formula)
        out.value = value
        return out


@dataclass
class Rules:
    """What a sheet asks of those who fill it in: drop-down lists (range, source) and coloured marks (range, formula, RRGGBB)."""

    lists: list[tuple[str, str]] = field(default_factory=list)
    marks: list[tuple[str, str, str]] = field(default_factory=list)

    def xml(self, colours: list[str]) -> str:
        out = ""
        for priority, (where, formula, colour) in enumerate(self.marks, 1):
            out += (
                f'<conditionalFormatting sqref="{where}"><cfRule type="expression" dxfId="{colours.index(colour)}" priority="{priority}">'
                f"<formula>{escape(formula)}</formula></cfRule></conditionalFormatting>"
            )
        if self.lists:
            rules = "".join(
                f'<dataValidation type="list" allowBlank="1" showInputMessage="1" showErrorMessage="1" sqref="{where}"><formula1>{escape(source)}</formula1></dataValidation>'
                for where, source in self.lists
            )
            out += f'<dataValidations count="{len(self.lists)}">{rules}</dataValidations>'
        return out


def _styles(colours: list[str]) -> str:
    """The one cell style there is, and a fill for each mark's colour."""
    fills = "".join(f'<dxf><fill><patternFill patternType="solid"><bgColor rgb="FF{c}"/></patternFill></fill></dxf>' for c in colours)
    return (
        f'<styleSheet xmlns="{_M[1:-1]}"><fonts count="1"><font/></fonts><fills count="2"><fill><patternFill patternType="none"/></fill><fill><patternFill patternType="gray125"/></fill></fills>'
        '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="1"><xf/></cellXfs>'
        f'<dxfs count="{len(colours)}">{fills}</dxfs></styleSheet>'
    )


def column_name(i: int) -> str:
    out = ""
    while i >= 0:
        out, i = chr(65 + i % 26) + out, i // 26 - 1
    return out


def _cell(ref: str, value) -> str:
    if value is None:
        return ""
    if isinstance(value, Formula):
        shown = value.value
        kind = "" if isinstance(shown, (int, float)) else ' t="str"'
        return f'<c r="{ref}"{kind}><f>{escape(str(value))}</f><v>{"" if shown is None else escape(str(shown))}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{ref}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{ref}"><v>{value}</v></c>'
    text = escape(_BAD.sub("", str(value))[:MAX_CELL])
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def write(path: str, sheets: dict[str, tuple[list[str], Iterator]], hidden: tuple[str, ...] = (), rules: dict[str, Rules] | None = None) -> None:
    """A workbook of sheets: name -> (headers, rows). Rows are streamed; cells longer than a sheet allows are cut."""
    kinds = "http://schemas.openxmlformats.org/package/2006/content-types"
    office = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    head = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    rules = rules or {}
    colours = sorted({m[2] for r in rules.values() for m in r.marks})
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        main = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{main}.worksheet+xml"/>' for i in range(1, len(sheets) + 1))
        z.writestr("[Content_Types].xml", f'{head}<Types xmlns="{kinds}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{main}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{main}.styles+xml"/>{parts}</Types>')
        rel = "http://schemas.openxmlformats.org/package/2006/relationships"
        z.writestr("_rels/.rels", f'{head}<Relationships xmlns="{rel}"><Relationship Id="rId1" Type="{office}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        names = "".join(f'<sheet name="{escape(n)}" sheetId="{i}"{" state=%shidden%s" % (chr(34), chr(34)) if n in hidden else ""} r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'{head}<workbook xmlns="{_M[1:-1]}" xmlns:r="{office}"><sheets>{names}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{i}" Type="{office}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(sheets) + 1))
        links += f'<Relationship Id="rId{len(sheets) + 1}" Type="{office}/styles" Target="styles.xml"/>'
        z.writestr("xl/styles.xml", f"{head}{_styles(colours)}")
        z.writestr("xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{rel}">{links}</Relationships>')
        for i, (name, (headers, rows)) in enumerate(sheets.items(), 1):
            with z.open(f"xl/worksheets/sheet{i}.xml", "w") as f:
                f.write(f'{head}<worksheet xmlns="{_M[1:-1]}"><sheetData>'.encode())
                for number, row in enumerate(_lead(headers, rows), 1):
                    cells = "".join(_cell(f"{column_name(k)}{number}", v) for k, v in enumerate(row))
                    f.write(f'<row r="{number}">{cells}</row>'.encode())
                f.write(f"</sheetData>{rules[name].xml(colours) if name in rules else ''}</worksheet>".encode())


def _lead(headers: list[str], rows: Iterator) -> Iterator:
    yield headers
    yield from rows
