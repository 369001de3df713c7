"""Markup residue to clean text, with the structure that the markup gave.

One scan finds the opaque regions of a record (code, comments, formulas, no-markup spans, escapes), leftmost first, so that
whatever stands inside one is never read as markup of another kind. The rest goes as a stream through the standard
library's HTML parser, whose events give HTML structure, and line by line through the few forms of Markdown, wiki and
LaTeX structure. For the clean text each line has a text-to-tag ratio; the ratios are smoothed with a Gaussian and split
into two clusters by an iterated threshold, and lines of the poor cluster that hold no structure and no sentence (menus,
link bars, wrappers) are left out. Records are handled one by one: no shuffle.
"""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("heading", "list_item", "code_block", "formula")
#: Stands for every character of an opaque region but line ends.
_OPAQUE = "\x01"

# Environments and elements by what they hold.
_MATH_ENV = r"(?:equation|align|alignat|gather|multline|eqnarray|displaymath|math|flalign|dmath)"
_CODE_ENV = r"(?:verbatim|Verbatim|lstlisting|minted|alltt)"
_NO_BLANK = r"(?:(?!\n[ \t]*\n)[\s\S])"
_REGION = re.compile(
    r"(?P<fence>^[ \t>]*(?P<f>`{3,}|~{3,})[^`\n]*\n(?:[\s\S]*?\n)??(?:[ \t>]*(?P=f)[`~]*[ \t]*$|\Z))"
    rf"|(?P<codeenv>\\begin\{{(?P<c>{_CODE_ENV}\*?)\}}[\s\S]*?(?:\\end\{{(?P=c)\}}|\Z))"
    rf"|(?P<mathenv>\\begin\{{(?P<m>{_MATH_ENV}\*?)\}}[\s\S]*?\\end\{{(?P=m)\}})"
    r"|(?P<hidden>\\begin\{comment\}[\s\S]*?\\end\{comment\})"
    r"|(?P<comment><!--[\s\S]*?(?:-->|\Z))"
    r"|(?P<math><math\b[^>]*(?<!/)>[\s\S]*?(?:</math\s*>|\Z))"
    r"|(?P<pre><(?P<p>pre|syntaxhighlight|xmp)\b[^>]*(?<!/)>[\s\S]*?(?:</(?P=p)\s*>|\Z)|<source\b[^>]*(?<!/)>[\s\S]*?</source\s*>)"
    r"|(?P<skip><(?P<s>script|style|nowiki|textarea)\b[^>]*(?<!/)>[\s\S]*?(?:</(?P=s)\s*>|\Z))"
    r"|(?P<code><(?P<i>code|tt|kbd|samp)\b[^>]*>[\s\S]*?</(?P=i)\s*>)"
    r"|(?P<remark>^[ \t]*%[^\n]*|(?<![\\\d])%[ \t]*\\[a-zA-Z]+[^\n]*)"
    r"|(?P<escape>\\\\|\\[*_{}#+\-.!$%&~|`<>])"
    rf"|(?P<display>\$\$(?=[^$])(?:(?!\$\$){_NO_BLANK})+\$\$|\\\[{_NO_BLANK}+?\\\])"
    rf"|(?P<inline>\\\({_NO_BLANK}+?\\\)|(?<![\\$\w])\$(?=[^\s$])(?:[^$\n\\]|\\[^\n])*?(?<=[^\s])\$(?![\w$]))"
    rf"|(?P<tick>(?<!`)(?P<t>`+)(?!`){_NO_BLANK}+?(?<!`)(?P=t)(?!`))",
    re.M | re.I,
)
_REGION_SIGN = re.compile(r"[\\`~$%<]")
_UNIT_OF = {"fence": "code_block", "codeenv": "code_block", "pre": "code_block", "mathenv": "formula", "math": "formula", "display": "formula", "inline": "formula"}
_NOT_NEWLINE = re.compile(r"[^\n]")

_ATX = re.compile(r"^(?:>[ \t]?)* {0,3}(#{1,6})[ \t]+\S")
_WIKI_HEADING = re.compile(r"^[ \t]*(={2,6})[ \t]*[^=\s].*?\1[ \t\x01]*$")
_SETEXT = re.compile(r"^ {0,3}(?:=+|-{2,})[ \t]*$")
_LIST = re.compile(r"^(?:>[ \t]?)*[ \t]*(?:[-+*•]|\d{1,9}[.)])[ \t]+\S")
_WIKI_LIST = re.compile(r"^[*#:;]*(?:[*]{2,}|[*#]*#|#[*#]*|[:;]*[*])[*#:]*[ \t]+\S")
_RULE = re.compile(r"^ {0,3}(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$")
_LATEX_HEADING = re.compile(r"\\(?:part|chapter|(?:sub){0,2}section|(?:sub)?paragraph)\*?(?:\[[^\]\n]*\])?\{")
_LATEX_ITEM = re.compile(r"\\item(?![a-zA-Z])")
_WIKI_SIGN = re.compile(r"^={2,6}[^=\n]+={2,6}\s*$|^\{\||^\|-|\[\[[^\]\n]+\]\]|'''|\{\{[^{}\n]+\}\}|</?ref\b", re.M)
_MARKDOWN_SIGN = re.compile(r"^#{2,6}[ \t]+\S.*$|\]\([^)\s]+\)|\*\*\S|^```|^~~~|^\|[ :|-]*-{3,}|(?<!~)~~\S|\[\^\w+\]", re.M)

#: Inline and line forms that only show that there is markup.
_MARKUP = re.compile(
    r"</?[a-zA-Z][^<>]*>|&(?:[a-zA-Z][a-zA-Z0-9]{1,31}|#\d+|#[xX][0-9a-fA-F]+);"
    r"|\*\*(?=\S)[^*\n]+(?<=\S)\*\*|(?<![\w*])\*(?=[^\s*])[^*\n]*(?<=[^\s*])\*(?![\w*])"
    r"|(?<!\w)__(?=\S)[^_\n]+(?<=\S)__(?!\w)|(?<![\w_])_(?=[^\s_])[^_\n]*(?<=[^\s_])_(?![\w_])"
    r"|(?<!~)~~(?=\S)[^~\n]+(?<=\S)~~|!?\[[^\]\n]*\]\([^)\n]*\)|\[\^[^\]\n]+\]|^\[[^\]\n]+\]:[ \t]*\S|\]\[[^\]\n]*\]"
    r"|^[ \t]*\|?[ \t]*:?-{3,}:?[ \t]*\||^[ \t]*>[ \t]*\S"
    r"|'{2,}(?=\S)[^'\n]+'{2,}|\[\[[^\]\n]+\]\]|\{\{[^{}\n]+\}\}|\[https?://[^\s\]]+[^\]\n]*\]|^\{\||^\|\}|^\|-|^[:;]+[ \t]*\S|__[A-Z]+__"
    r"|\\[a-zA-Z]+\*?(?:\[[^\]\n]*\])?\{|\{\\[a-z]+ |\\(?:item|par|hline|newline|noindent|maketitle|tableofcontents|centering|bigskip|medskip|smallskip|newpage|clearpage|LaTeX|ldots)(?![a-zA-Z])|(?<=\S)\\,|~\\",
    re.M,
)

_HEADING_TAGS = frozenset(f"h{n}" for n in range(1, 7))


class _Events(HTMLParser):
    """Structure and tag events of one record, each with its line; ``tags`` holds (number of tags, characters in them) by line."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.found: list[tuple[int, int, str]] = []
        self.tags: dict[int, list[int]] = {}

    def _tag(self, size: int) -> None:
        held = self.tags.setdefault(self.getpos()[0], [0, 0])
        held[0] += 1
        held[1] += size

    def handle_starttag(self, tag: str, attrs) -> None:
        self._tag(len(self.get_starttag_text() or ""))
        if tag in _HEADING_TAGS or tag == "li":
            self.found.append((*self.getpos(), "list_item" if tag == "li" else "heading"))

    def handle_endtag(self, tag: str) -> None:
        self._tag(len(tag) + 3)

    def set_cdata_mode(self, elem, **more) -> None:
        """Opaque elements are cut out already; a stray script or style tag must not swallow the rest."""


def _mask(text: str, regions: list[tuple[int, int, str]]) -> str:
    parts, at = [], 0
    for start, end, _ in regions:
        parts += [text[at:start], _NOT_NEWLINE.sub(_OPAQUE, text[start:end])]
        at = end
    parts.append(text[at:])
    return "".join(parts)


def _regions(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), _kind(m)) for m in _REGION.finditer(text)] if _REGION_SIGN.search(text) else []


_REGION_NAMES = tuple("escape inline display tick math comment pre fence codeenv mathenv remark code skip hidden".split())


def _kind(met: re.Match) -> str:
    return met.lastgroup if met.lastgroup in _REGION_NAMES else next(name for name in _REGION_NAMES if met[name] is not None)


def line_units(masked: str) -> tuple[list[tuple[int, str]], list[tuple[int, int]], bool]:
    """(offset, kind) of the headings and list items given by whole lines; (start, end) of indented code; any rule or so."""
    lines = masked.split("\n")
    units, code, marked = [], [], False
    at, offsets = 0, []
    for line in lines:
        offsets.append(at)
        at += len(line) + 1
    wiki = None
    n, no = len(lines), 0
    blank_before, in_list = True, False
    while no < n:
        line = lines[no]
        bare = line.strip()
        if not bare:
            blank_before = True
            no += 1
            continue
        solid = bare.strip(_OPAQUE + " ") != ""
        if solid and blank_before and line.startswith(("    ", "\t")) and not (in_list and _LIST.match(line)):
            first_line = last = no
            while no < n and (not lines[no].strip() or lines[no].startswith(("    ", "\t"))):
                if lines[no].strip():
                    last = no
                no += 1
            code.append((offsets[first_line], offsets[last] + len(lines[last])))
            blank_before, no = False, last + 1
            continue
        if solid:
            first = bare[0]
            if first == "#" or first == ">":
                met = _ATX.match(line)
                if met:
                    if wiki is None:
                        wiki = bool(_WIKI_SIGN.search(masked)) and not _MARKDOWN_SIGN.search(masked)
                    run = (no > 0 and lines[no - 1].startswith(("#", "*"))) or (no + 1 < n and lines[no + 1].startswith(("# ", "## ", "#*", "#:")))
                    item = line[0] == "#" and (run or wiki and not bare.endswith("#") and len(bare.split()) > 9)
                    units.append((offsets[no], "list_item" if item else "heading"))
                    in_list = item
                    blank_before = False
                    no += 1
                    continue
            if first == "=" and _WIKI_HEADING.match(line):
                units.append((offsets[no], "heading"))
                in_list = blank_before = False
                no += 1
                continue
            if _RULE.match(line) and (blank_before or bare[0] != "-"):
                marked = True
            elif _LIST.match(line) or (first in "*#:;" and _WIKI_LIST.match(line)):
                units.append((offsets[no], "list_item"))
                in_list, blank_before = True, False
                no += 1
                continue
            elif no + 1 < n and _SETEXT.match(lines[no + 1]) and first not in "|<" and not _SETEXT.match(line) and not bare.startswith("\\"):
                units.append((offsets[no], "heading"))
                in_list = blank_before = False
                no += 2
                continue
            elif blank_before and not line.startswith((" ", "\t")):
                in_list = False
        elif blank_before:
            in_list = False
        blank_before = False
        no += 1
    return units, code, marked


class Parsed:
    """Regions, structure units (offset, kind) in reading order, tags by line, and whether there is any markup."""

    __slots__ = ("regions", "masked", "units", "tags", "markup")

    def __init__(self, text: str):
        self.regions = _regions(text)
        units = [(start, _UNIT_OF[kind]) for start, _, kind in self.regions if kind in _UNIT_OF]
        masked = _mask(text, self.regions) if self.regions else text
        lines, code, rule = line_units(masked)
        if code:
            inside = lambda at: any(a <= at < b for a, b in code)
            self.regions = sorted([r for r in self.regions if not inside(r[0])] + [(a, b, "indented") for a, b in code])
            units = [(start, _UNIT_OF[kind]) for start, _, kind in self.regions if kind in _UNIT_OF]
            masked = _mask(text, self.regions)
            lines, _, rule = line_units(masked)
            units += [(a, "code_block") for a, _ in code]
        units += lines
        self.tags: dict[int, list[int]] = {}
        if "<" in masked:
            events = _Events()
            try:
                events.feed(masked)
                events.close()
            except AssertionError:  # the parser's own check on broken declarations
                pass
            self.tags = events.tags
            if events.found:
                starts = [0]
                for line in masked.split("\n"):
                    starts.append(starts[-1] + len(line) + 1)
                units += [(starts[line - 1] + column, kind) for line, column, kind in events.found]
        if "\\" in masked:
            units += [(m.start(), "heading") for m in _LATEX_HEADING.finditer(masked)]
            units += [(m.start(), "list_item") for m in _LATEX_ITEM.finditer(masked)]
        self.masked, self.units = masked, sorted(units)
        marks = any(kind != "escape" or text[a:b] != "\\\\" or _break(text, a, b) for a, b, kind in self.regions)
        self.markup = bool(units) or rule or marks or bool(_MARKUP.search(masked))


def _break(text: str, start: int, end: int) -> bool:
    """Whether a double backslash is a LaTeX line break (at a line's end) rather than the start of a network path."""
    return text[end : end + 1] in ("\n", "") or text[end : end + 2] == " \n"


def structure_units(text: str | None) -> list[tuple[str, int]]:
    """[('markup', 1)] if there is any markup, and (kind, n) with n = 1, 2, ... per kind in reading order."""
    if not text or not text.strip():
        return []
    parsed = Parsed(text)
    if not parsed.markup:
        return []
    out, counts = [("markup", 1)], dict.fromkeys(KINDS, 0)
    for _, kind in parsed.units:
        counts[kind] += 1
        out.append((kind, counts[kind]))
    return out


# ---- clean text ----


def smoothed(values: list[float], sigma: float = 1.0) -> list[float]:
    """Gaussian smoothing of one value per line, with a window of three sigmas on each side."""
    reach = max(1, math.ceil(3 * sigma))
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    out = []
    for at in range(len(values)):
        total = weight = 0.0
        for d in range(-reach, reach + 1):
            if 0 <= at + d < len(values):
                total += weights[d + reach] * values[at + d]
                weight += weights[d + reach]
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """The border between two clusters: the mean of their means, iterated until it stays."""
    if not values:
        return 0.0
    border = sum(values) / len(values)
    for _ in range(32):
        low, high = [v for v in values if v < border], [v for v in values if v >= border]
        if not low or not high:
            break
        moved = (sum(low) / len(low) + sum(high) / len(high)) / 2
        if abs(moved - border) < 1e-9:
            break
        border = moved
    return border


_TAG = re.compile(r"<[^<>\n]*>")
#: Letters of scripts written without blanks (Thai, Lao, Burmese, Khmer, kana, Han): there letters count instead of words.
_DENSE = r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff]"
_SENTENCE = re.compile(r"\w+\W+\w+\W+\w+[^\n]*[.!?。！？।؟]|\w{3,}\W+\w+\W+\w+\W+\w+\W+\w+" + f"|{_DENSE}{{5,}}[^\\n]*[.!?。！？]|{_DENSE}{{10,}}")


def content_lines(parsed: Parsed) -> list[bool]:
    """For each line, whether it belongs to a content region by its smoothed text-to-tag ratio; the tags are the parser's events.
    Without tags all lines do."""
    lines = parsed.masked.split("\n")
    if not parsed.tags:
        return [True] * len(lines)
    ratios = []
    for no, line in enumerate(lines, 1):
        tags, signs = parsed.tags.get(no, (0, 0))
        ratios.append(max(0, len(line.strip()) - signs) / max(1, tags))
    soft = smoothed(ratios)
    border = threshold(soft) / 2
    return [s >= border or r >= border for s, r in zip(soft, ratios)]


_INLINE_STEPS = (
    (re.compile(r"<ref\b[^>]*/>|<ref\b[^>]*>[^<]*</ref>", re.I), ""),
    (re.compile(r"</?(?:td|th)\b[^>]*>\s*<(?:td|th)\b[^>]*>", re.I), " | "),
    (re.compile(r"</?(?:p|div|tr|table|ul|ol|blockquote|body|html|head|section|article|h[1-6])\b[^>]*>", re.I), "\n"),
    (re.compile(r"<br\s*/?>", re.I), " "),
    (re.compile(r"</?[a-zA-Z][^<>]*>"), ""),
    (re.compile(r"!\[([^\]\n]*)\]\([^)\n]*\)"), r"\1"),
    (re.compile(r"\[([^\]\n]*)\]\([^)\s]+[^)\n]*\)"), r"\1"),
    (re.compile(r"\[\^[^\]\n]+\]"), ""),
    (re.compile(r"\[\[(?:Category|File|Image):[^\]\n]*\]\]", re.I), ""),
    (re.compile(r"\[\[(?:[^\]|\n]*\|)?([^\]|\n]*)\]\]"), r"\1"),
    (re.compile(r"\[https?://[^\s\]]+ ?([^\]\n]*)\]"), r"\1"),
    (re.compile(r"\{\{[^{}]*\}\}"), ""),
    (re.compile(r"'{2,}"), ""),
    (re.compile(r"\*\*(?=\S)([^*\n]+?)(?<=\S)\*\*"), r"\1"),
    (re.compile(r"(?<!\w)__(?=\S)([^_\n]+?)(?<=\S)__(?!\w)"), r"\1"),
    (re.compile(r"(?<![\w*])\*(?=[^\s*])([^*\n]+?)(?<=[^\s*])\*(?![\w*])"), r"\1"),
    (re.compile(r"(?<![\w_])_(?=[^\s_])([^_\n]+?)(?<=[^\s_])_(?![\w_])"), r"\1"),
    (re.compile(r"~~(?=\S)([^~\n]+?)(?<=\S)~~"), r"\1"),
    (re.compile(r"[ ~]?\\(?:cite|label|ref|footnote|index|vspace|hspace)[a-z]*\*?(?:\[[^\]\n]*\])?\{[^{}\n]*\}"), ""),
    (re.compile(r"\\(?:documentclass|usepackage)(?:\[[^\]\n]*\])?\{[^{}\n]*\}|\\(?:begin|end)\{[a-zA-Z]+\*?\}(?:\{[a-z|]*\})?"), "\n"),
    (re.compile(r"\\(?:emph|textbf|textit|texttt|underline|text)\{([^{}\n]*)\}|\{\\[a-z]+ ([^{}\n]*)\}"), lambda m: m[1] or m[2] or ""),
    (re.compile(r"\\,"), " "),
)
_WIKI_TABLE = re.compile(r"^(?:\{\|.*|\|\}|\|-.*)$|^\|[ \t]*(?=\S)", re.M)
_TABLE_RULE = re.compile(r"^[ \t]*\|?(?:[ \t]*:?-{3,}:?[ \t]*\|?)+[ \t]*$", re.M)
_HEADING_LINE = re.compile(r"^(?:>[ \t]?)*\s*(#{1,6}|={2,6})[ \t]*(.*?)[ \t]*[#=]*\s*$")
_LATEX_TITLE = re.compile(r"\\((?:sub){0,2})(?:section|chapter|part|paragraph)\*?(?:\[[^\]\n]*\])?\{([^{}\n]*)\}")
_HTML_TITLE = re.compile(r"<h([1-6])\b[^>]*>([\s\S]*?)(?:</h\1\s*>|\n\n)", re.I)
_ITEM_LINE = re.compile(r"^([ \t]*)(?:[-+•]|[*#:;]+|\d{1,9}[.)])[ \t]+")
_MORE_BLANK = re.compile(r"\n[ \t]*\n(?:[ \t]*\n)+")


def _inner(region: str, kind: str) -> str:
    """What is kept of an opaque region."""
    if kind == "escape":
        return region[1:] if region != "\\\\" else " "
    if kind in ("comment", "hidden", "remark"):
        return ""
    if kind == "skip":
        met = re.fullmatch(r"<nowiki\b[^>]*>([\s\S]*?)</nowiki\s*>", region, re.I)
        return met[1] if met else ""
    if kind in ("tick", "code"):
        body = re.sub(r"^`+|`+$", "", region) if kind == "tick" else html.unescape(re.sub(r"<[^<>]*>", "", region))
        return f"`{body.strip()}`"
    if kind in ("fence", "codeenv", "pre", "indented"):
        if kind == "fence":
            body = "\n".join(region.split("\n")[1:])
            body = re.sub(r"\n?[ \t>]*(?:`{3,}|~{3,})[ \t]*$", "", body)
        elif kind == "codeenv":
            body = re.sub(r"^\\begin\{[^}]*\}(?:\[[^\]\n]*\])?\n?|\n?\\end\{[^}]*\}$", "", region)
        elif kind == "pre":
            body = html.unescape(re.sub(r"^<[^>]*>(?:<code\b[^>]*>)?\n?|\n?(?:</code\s*>)?</[^>]*>$", "", region, flags=re.I))
        else:
            body = "\n".join(line[4:] if line.startswith("    ") else line.lstrip("\t") for line in region.split("\n"))
        return f"\n```\n{body}\n```\n"
    body = re.sub(r"^(?:\$\$?|\\[\[(])|(?:\$\$?|\\[\])])$", "", region)
    body = re.sub(r"^\\begin\{[^}]*\}|\\end\{[^}]*\}$", "", body)
    if kind == "math":
        body = html.unescape(re.sub(r"<[^<>]*>", " ", region)) if "<m" in region[5:] else re.sub(r"</?math\b[^>]*>", "", region, flags=re.I)
        body = re.sub(r"\s+", " ", body)
    return f"$${body.strip()}$$" if kind in ("display", "mathenv") else f"${body.strip()}$"


def clean_text(text: str | None) -> tuple[str, dict[str, int], int, int]:
    """(clean text, units per kind, content lines, lines). Headings come out as '# ...', list items as '- ...', code blocks
    fenced, formulas in dollar signs; null and blank records give ''."""
    counts = dict.fromkeys(KINDS, 0)
    if not text or not text.strip():
        return "", counts, 0, 0
    parsed = Parsed(text)
    for _, kind in parsed.units:
        counts[kind] += 1
    lines_in = parsed.masked.count("\n") + 1
    if not parsed.markup:
        return text.strip(), counts, lines_in, lines_in
    content = content_lines(parsed)
    at_line = {parsed.masked.count("\n", 0, at): kind for at, kind in reversed(parsed.units)}
    kept, body = [], []
    at = 0
    for no, (start, end, kind) in enumerate(parsed.regions):
        body += [text[at:start], f"\x02{no}\x03" + "\n" * text.count("\n", start, end)]
        kept.append(_inner(text[start:end], kind))
        at = end
    body.append(text[at:])
    lines = "".join(body).split("\n")
    keep = [content[no] or no in at_line or not line.strip() or no + 1 not in parsed.tags or bool(_SENTENCE.search(_TAG.sub(" ", line))) or "\x02" in line for no, line in enumerate(lines)]
    titles = {no for no, (a, b) in enumerate(zip(lines, lines[1:])) if a.strip() and _SETEXT.match(b) and no in at_line}
    out = []
    for no, line in enumerate(lines):
        if not keep[no] or no - 1 in titles:
            continue
        if no in titles:
            line = "# " + line.strip()
        elif no in at_line:
            if _WIKI_HEADING.match(line) or (_ATX.match(line) and at_line[no] == "heading"):
                met = _HEADING_LINE.match(line)
                line = "#" * min(6, len(met[1])) + " " + met[2]
            elif at_line[no] == "list_item" and (met := _ITEM_LINE.match(line)):
                line = f"{met[1]}- {line[met.end() :]}"
        elif _RULE.match(line):
            line = ""
        out.append(line)
    whole = "\n".join(out)
    whole = _LATEX_TITLE.sub(lambda m: f"\n{'#' * (1 + len(m[1]) // 3)} {m[2]}\n", whole)
    whole = _LATEX_ITEM.sub("\n- ", whole)
    whole = re.sub(r"(\n- )(?:\[[^\]\n]*\])?\s*", r"\1", whole)
    whole = _HTML_TITLE.sub(lambda m: f"\n\n{'#' * int(m[1])} {' '.join(_TAG.sub('', m[2]).split())}\n\n", whole)
    whole = re.sub(r"<li\b[^>]*>\s*", "\n- ", whole, flags=re.I)
    for pattern, to in _INLINE_STEPS:
        whole = pattern.sub(to, whole)
    whole = _WIKI_TABLE.sub("", _TABLE_RULE.sub("", whole))
    whole = html.unescape(whole)
    whole = re.sub(r"\x02(\d+)\x03\n*", lambda m: kept[int(m[1])] + ("\n" * min(2, m[0].count("\n"))), whole)
    return _MORE_BLANK.sub("\n\n", "\n".join(line.rstrip() for line in whole.split("\n"))).strip(), counts, sum(keep), lines_in


# ---- Spark ----


def _records(results: DataFrame) -> DataFrame:
    return results.select(F.col("extraction_id").cast("bigint").alias("extraction_id"), F.col("markdown").cast("string").alias("markdown")).where(F.col("extraction_id").isNotNull() & F.col("markdown").isNotNull())


def units(results: DataFrame) -> DataFrame:
    """(extraction_id, unit_kind, unit_no) as a set: one ('markup', 1) per record with any markup, and its structure units.

    Null and blank records have no rows; a repeated delivery counts once; other columns are not read.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, numbers = [], [], []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = structure_units(text.as_py())
                ids += [own] * len(found)
                kinds += [k for k, _ in found]
                numbers += [n for _, n in found]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(numbers, pa.int64())], names=["extraction_id", "unit_kind", "unit_no"])

    return _records(results).mapInArrow(run, "extraction_id bigint, unit_kind string, unit_no bigint").distinct()


def clean(results: DataFrame) -> DataFrame:
    """One row per record: (extraction_id, clean_text, n_headings, n_list_items, n_code_blocks, n_formulas, content_lines,
    n_lines). Every record has a row: null and blank ones an empty text. A repeated delivery counts once."""
    schema = pa.schema([("extraction_id", pa.int64()), ("clean_text", pa.string()), *((f"n_{k}s", pa.int32()) for k in KINDS), ("content_lines", pa.int32()), ("n_lines", pa.int32())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body, counts, kept, lines = clean_text(text.as_py())
                rows.append((own, body, *(counts[k] for k in KINDS), kept, lines))
            columns = zip(*rows) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    own = results.select(F.col("extraction_id").cast("bigint").alias("extraction_id"), F.col("markdown").cast("string").alias("markdown")).where(F.col("extraction_id").isNotNull())
    made = own.mapInArrow(run, "extraction_id bigint, clean_text string, n_headings int, n_list_items int, n_code_blocks int, n_formulas int, content_lines int, n_lines int")
    return made.dropDuplicates(["extraction_id"])
