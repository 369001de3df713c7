"""Office and HTML files as raw blocks and cells, with the standard library only.

Files come through ``binaryFile``; each is parsed where it was read. PDF layout, OCR and picture description need models
that aren't part of this library: they plug in as extractors, ``Callable[[bytes], list[dict]]``, by source type.
"""

from __future__ import annotations

import hashlib
import io
import posixpath
import re
import zipfile
from collections.abc import Callable, Iterable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCKS = "path string, source_type string, part int, ord int, kind string, level int, text string, ref string, row int, col int, value_type string, error string"
#: Most cells of one sheet (fixed value); larger sheets are reported instead of read.
MAX_CELLS = 2_000_000

Extractor = Callable[[bytes], list[dict]]


def _tag(node) -> str:
    return node.tag.rpartition("}")[2]


def _xml(package: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(package.read(name))


def _attribute(node, name: str):
    return next((v for k, v in node.attrib.items() if k.rpartition("}")[2] == name), None)


def _numbered(package: zipfile.ZipFile, pattern: str) -> list[str]:
    found = [(int(m[1]), name) for name in package.namelist() if (m := re.fullmatch(pattern, name))]
    return [name for _, name in sorted(found)]


def _targets(package: zipfile.ZipFile, name: str) -> dict[str, str]:
    folder, file = posixpath.split(name)
    rels = f"{folder}/_rels/{file}.rels"
    if rels not in package.namelist():
        return {}
    return {r.attrib["Id"]: posixpath.normpath(posixpath.join(folder, r.attrib["Target"])) if not r.attrib["Target"].startswith("/") else r.attrib["Target"][1:] for r in _xml(package, rels)}


def _column(ref: str) -> int:
    n = 0
    for letter in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(letter) - 64
    return n


def xlsx(content: bytes) -> list[dict]:
    """Cells of every sheet, in rows; formulas are kept as '=...'. kind 'sheet' (text its name), then 'cell'."""
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        names = package.namelist()
        shared = ["".join(t.text or "" for t in item.iter() if _tag(t) == "t") for item in _xml(package, "xl/sharedStrings.xml")] if "xl/sharedStrings.xml" in names else []
        targets = _targets(package, "xl/workbook.xml")
        sheets = [(s.attrib["name"], targets.get(_attribute(s, "id"))) for s in _xml(package, "xl/workbook.xml").iter() if _tag(s) == "sheet"]
        out = []
        for part, (title, target) in enumerate(sheets, 1):
            out.append({"part": part, "kind": "sheet", "text": title})
            if not target or target not in names:
                continue
            tree = _xml(package, target)
            cells = [c for c in tree.iter() if _tag(c) == "c"]
            if len(cells) > MAX_CELLS:
                out.append({"part": part, "kind": "error", "error": "sheet_too_large"})
                continue
            for cell in cells:
                ref, kind = cell.attrib.get("r", ""), cell.attrib.get("t", "n")
                value = next((v.text for v in cell if _tag(v) == "v"), None)
                formula = next((f.text for f in cell if _tag(f) == "f"), None)
                if kind == "s" and value is not None:
                    value = shared[int(value)]
                elif kind == "inlineStr":
                    value = "".join(t.text or "" for t in cell.iter() if _tag(t) == "t")
                elif kind == "b" and value is not None:
                    value = "TRUE" if value == "1" else "FALSE"
                if formula is not None and kind != "e":
                    value, kind = "=" + formula, "str"
                if value is None or not re.match(r"[A-Z]+\d+$", ref):
                    continue
                is_number = kind == "n"
                out.append({"part": part, "kind": "cell", "text": value, "ref": ref, "row": int(re.search(r"\d+$", ref)[0]), "col": _column(ref), "value_type": "error" if kind == "e" else "boolean" if kind == "b" else ("integer" if re.fullmatch(r"-?\d+", value) else "float") if is_number else "string"})
        return out


def _paragraph(node) -> str:
    out = []
    for t in node.iter():
        name = _tag(t)
        if name == "t":
            out.append(t.text or "")
        elif name == "tab":
            out.append("\t")
        elif name in ("br", "cr"):
            out.append("\n")
    return "".join(out).replace("\xa0", " ")


def docx(content: bytes) -> list[dict]:
    """Body order: 'heading' (level), 'bullet', 'paragraph', table 'cell's, and 'image' with its media's hash."""
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        targets = _targets(package, "word/document.xml")
        body = next(b for b in _xml(package, "word/document.xml").iter() if _tag(b) == "body")
        out, tables = [], 0
        for node in body:
            if _tag(node) == "p":
                style = next((_attribute(s, "val") or "" for s in node.iter() if _tag(s) == "pStyle"), "")
                heading = re.match(r"(?:Heading|Title)\s?(\d*)", style)
                listed = any(_tag(s) == "numPr" for s in node.iter()) or style.startswith("List")
                text = _paragraph(node).strip()
                if text:
                    out.append({"part": 1, "kind": "heading" if heading else "bullet" if listed else "paragraph", "level": int(heading[1] or 1) if heading else None, "text": text})
            elif _tag(node) == "tbl":
                tables += 1
                for row, tr in enumerate((r for r in node if _tag(r) == "tr"), 1):
                    for col, tc in enumerate((c for c in tr if _tag(c) == "tc"), 1):
                        out.append({"part": tables, "kind": "cell", "row": row, "col": col, "text": "\n".join(_paragraph(p) for p in tc.iter() if _tag(p) == "p").strip()})
            for drawing in node.iter():
                target = targets.get(_attribute(drawing, "embed") or "") if _tag(drawing) == "blip" else None
                if target and target in package.namelist():
                    out.append({"part": 1, "kind": "image", "text": posixpath.basename(target), "ref": hashlib.sha256(package.read(target)).hexdigest()})
        return out


def pptx(content: bytes) -> list[dict]:
    """Slides in order: 'title', 'bullet' (level), table 'cell's, 'image's and 'notes'; groups are walked through."""
    with zipfile.ZipFile(io.BytesIO(content)) as package:
        out = []
        for part, name in enumerate(_numbered(package, r"ppt/slides/slide(\d+)\.xml"), 1):
            targets = _targets(package, name)
            for shape in _xml(package, name).iter():
                if _tag(shape) == "sp":
                    holder = next((p for p in shape.iter() if _tag(p) == "ph"), None)
                    title = holder is not None and holder.attrib.get("type", "") in ("title", "ctrTitle")
                    for p in (p for p in shape.iter() if _tag(p) == "p"):
                        text = _paragraph(p).strip()
                        level = next((int(x.attrib.get("lvl", 0)) for x in p if _tag(x) == "pPr"), 0)
                        if text:
                            out.append({"part": part, "kind": "title" if title else "bullet", "level": level, "text": text})
                elif _tag(shape) == "tbl":
                    for row, tr in enumerate((r for r in shape if _tag(r) == "tr"), 1):
                        for col, tc in enumerate((c for c in tr if _tag(c) == "tc"), 1):
                            out.append({"part": part, "kind": "cell", "row": row, "col": col, "text": " ".join(filter(None, (_paragraph(p).strip() for p in tc.iter() if _tag(p) == "p")))})
                elif _tag(shape) == "pic":
                    embed = next((_attribute(b, "embed") for b in shape.iter() if _tag(b) == "blip"), None)
                    target = targets.get(embed or "")
                    if target and target in package.namelist():
                        out.append({"part": part, "kind": "image", "text": posixpath.basename(target), "ref": hashlib.sha256(package.read(target)).hexdigest()})
            note = next((t for t in targets.values() if "notesSlide" in t), None)
            if note and note in package.namelist():
                text = "\n".join(filter(None, (_paragraph(p).strip() for p in _xml(package, note).iter() if _tag(p) == "p")))
                if text:
                    out.append({"part": part, "kind": "notes", "text": text})
        return out


class _Page(HTMLParser):
    """Blocks of a static page; style, script and templates are dropped."""

    DROPPED = frozenset(("script", "style", "template", "noscript", "head"))
    KINDS = {"p": "paragraph", "li": "bullet", "td": "cell", "th": "cell", "title": "title", "blockquote": "paragraph", "pre": "paragraph", "figcaption": "caption", **{f"h{n}": "heading" for n in range(1, 7)}}

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[dict] = []
        self.skip = 0
        self.kind, self.level, self.held = "paragraph", None, []
        self.row = self.col = self.table = 0

    def flush(self) -> None:
        text = " ".join("".join(self.held).split())
        self.held = []
        if text:
            own = {"part": self.table or 1, "kind": self.kind, "level": self.level, "text": text}
            self.out.append(own | ({"row": self.row, "col": self.col} if self.kind == "cell" else {}))
        self.kind, self.level = "paragraph", None

    def handle_starttag(self, tag: str, attrs) -> None:
        if tag in self.DROPPED and tag != "head":
            self.skip += 1
        if tag == "table":
            self.table += 1
            self.row = 0
        elif tag == "tr":
            self.row += 1
            self.col = 0
        if tag in self.KINDS or tag in ("div", "section", "article", "ul", "ol", "table", "tr"):
            self.flush()
        if tag in ("td", "th"):
            self.col += 1
        if tag in self.KINDS:
            self.kind = self.KINDS[tag]
            self.level = int(tag[1]) if tag[0] == "h" and tag[1:].isdigit() else None
        if tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag in self.DROPPED and tag != "head":
            self.skip = max(0, self.skip - 1)
        if tag in self.KINDS or tag in ("div", "section", "article", "table", "tr"):
            self.flush()

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.held.append(data)


def html_page(content: bytes) -> list[dict]:
    page = _Page()
    page.feed(content.decode("utf-8", "replace"))
    page.close()
    page.flush()
    return page.out


def plain_text(content: bytes) -> list[dict]:
    return [{"part": 1, "kind": "paragraph", "text": block.strip()} for block in re.split(r"\n\s*\n", content.decode("utf-8", "replace")) if block.strip()]


#: Source types and their extractors; others are reported as unsupported.
EXTRACTORS: dict[str, Extractor] = {"xlsx": xlsx, "docx": docx, "pptx": pptx, "html": html_page, "htm": html_page, "txt": plain_text}


def blocks(files: DataFrame, extractors: dict[str, Extractor] | None = None) -> DataFrame:
    """The blocks of files (path, content), ``BLOCKS``. A file that can't be read gives one row of kind 'error'; later
    extractors of a type may be chained by the caller (the first that doesn't raise)."""
    known = EXTRACTORS | (extractors or {})
    names = [f.split()[0] for f in BLOCKS.split(", ")]
    kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kind = path.rpartition(".")[2].lower()
                try:
                    made = known[kind](content) if kind in known else [{"kind": "error", "error": "unsupported"}]
                except Exception as error:
                    made = [{"kind": "error", "error": type(error).__name__}]
                rows = [{"path": path, "source_type": kind, "ord": at, **block} for at, block in enumerate(made)]
                yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], t) for n, t in zip(names, kinds)], names=names)

    return files.select("path", "content").where(F.col("path").isNotNull() & F.col("content").isNotNull()).mapInArrow(run, BLOCKS)


def read_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """(path, modificationTime, length, content) of the files below a folder."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)


def first_that_works(*chain: Extractor) -> Extractor:
    """An extractor that tries others in turn and reports which failed before it."""

    def extract(content: bytes) -> list[dict]:
        failed = []
        for one in chain:
            try:
                return [{"kind": "warning", "error": name} for name in failed] + one(content)
            except Exception as error:
                failed.append(type(error).__name__)
        raise ValueError(", ".join(failed))

    return extract


def inspection(found: DataFrame) -> DataFrame:
    """(path, page_count, text_pages, chars, usable): usable with a page of text and at least 100 characters in all."""
    pages = found.where(F.col("kind") != "error").groupBy("path", "part").agg(F.sum(F.coalesce(F.char_length(F.trim("text")), F.lit(0))).alias("n"))
    counted = pages.groupBy("path").agg(F.count("*").alias("page_count"), F.count_if(F.col("n") > 0).alias("text_pages"), F.sum("n").alias("chars"))
    return counted.withColumn("usable", (F.col("text_pages") >= 1) & (F.col("chars") >= 100))
