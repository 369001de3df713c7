"""Scalar text rules as column expressions: they stay in the JVM, inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
#: Every character that counts as a blank (Java's own class lacks most of them).
BLANK = r"[\s\p{Z}\x1c-\x1f\x85]"
TOKEN = r"[a-z0-9]+(?:[./_-][a-z0-9]+)*"
TECHNICAL = r"(?iU)\b(?:[a-z]*\d[\w./-]*|\d+(?:\.\d+)?)\b"
UNITS = ("mm", "cm", "kg", "%", "mpa", "°c")
FORMULA_ERRORS = ("#NULL!", "#DIV/0!", "#VALUE!", "#REF!", "#NAME?", "#NUM!", "#N/A")
URL = r"(?i)(?:https?://|file://)[^\s<>\"]+"
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def squeezed(x: Column | str) -> Column:
    """Runs of blanks to one space, none at the ends."""
    return F.trim(F.regexp_replace(_c(x), BLANK + "+", " "))


def normalised(x: Column | str) -> Column:
    """Runs of blanks to one space, none at the ends; blank text is null. Within lambdas :func:`squeezed` is the cheaper form:
    there a value that is compared and returned is worked out twice."""
    return F.nullif(squeezed(x), F.lit(""))


def folded(x: Column | str) -> Column:
    """Case folding as far as lower case and sharp s go."""
    return F.replace(F.lower(_c(x)), F.lit("ß"), F.lit("ss"))


def tokens(x: Column | str) -> Column:
    """Word tokens of the folded text, in order; inner . / _ - join."""
    return F.regexp_extract_all(folded(x), F.lit(f"({TOKEN})"), F.lit(1))


def technical_values(x: Column | str) -> Column:
    """The distinct numbers and codes of a text, folded and sorted."""
    return F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(_c(x), F.lit(TECHNICAL), F.lit(0)), folded)))


def technical_difference(a: Column, b: Column) -> Column:
    """Both have values and neither's values contain the other's."""
    return (F.size(a) > 0) & (F.size(b) > 0) & (F.size(F.array_except(a, b)) > 0) & (F.size(F.array_except(b, a)) > 0)


def bound(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once: inside a lambda a plain expression would run again for every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def column_letters(n: Column) -> Column:
    """1 to A, 26 to Z, 27 to AA, up to three letters."""
    letter = lambda k: F.char(F.lit(65) + k)
    last = F.pmod(n - 1, F.lit(26))
    rest = F.floor((n - 1) / 26)
    middle = F.pmod(rest - 1, F.lit(26))
    first = F.floor((rest - 1) / 26)
    return F.concat(F.when(first > 0, letter(F.pmod(first - 1, F.lit(26)))).otherwise(""), F.when(rest > 0, letter(middle)).otherwise(""), letter(last))


def cell_range(row: Column, column: Column, last_row: Column, last_column: Column) -> Column:
    return F.concat(column_letters(column), row.cast("string"), F.lit(":"), column_letters(last_column), last_row.cast("string"))


def row_range(first: Column, last: Column) -> Column:
    return F.when(first == last, first.cast("string")).otherwise(F.concat_ws("-", first.cast("string"), last.cast("string")))


def column_name(x: Column | str) -> Column:
    """A label as a column name: lower case, other than letters and digits to single underscores; 'column' if none is left."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(_c(x)), r"[^\p{L}\p{N}]+", "_"), "^_+|_+$", "")
    return F.when((plain == "") | plain.isNull(), "column").otherwise(plain)


def value_type(x: Column | str) -> Column:
    """boolean, integer, float, empty or string of a cell's text; booleans before numbers."""
    c = F.trim(_c(x))
    return (
        F.when(c.isNull() | (c == ""), "empty")
        .when(F.lower(c).isin("true", "false"), "boolean")
        .when(c.rlike(r"^[+-]?\d+$"), "integer")
        .when(c.rlike(r"^[+-]?(?:\d+\.\d*|\.\d+|\d+)(?:[eE][+-]?\d+)?$"), "float")
        .otherwise("string")
    )


def unit_of(value: Column | str, name: Column | str) -> Column:
    """The first known unit that the value or the column's name contains."""
    v, n = F.coalesce(F.lower(_c(value)), F.lit("")), F.coalesce(F.lower(_c(name)), F.lit(""))
    return F.coalesce(*[F.when(F.contains(v, F.lit(u)) | F.contains(n, F.lit(u)), u) for u in UNITS])


def measurement(x: Column | str) -> Column:
    """struct(value double, unit) of a text such as '15 cm'; null otherwise."""
    c = _c(x)
    number = F.regexp_extract(c, r"^\s*(-?\d+(?:\.\d+)?)\s*(\S+)\s*$", 1)
    return F.when(number != "", F.struct(number.cast("double").alias("value"), F.regexp_extract(c, r"^\s*(-?\d+(?:\.\d+)?)\s*(\S+)\s*$", 2).alias("unit")))


def without_placeholder(x: Column | str) -> Column:
    n = normalised(x)
    return F.when(F.lower(n) != "none", n)


def is_formula(x: Column | str) -> Column:
    return F.coalesce(F.startswith(_c(x), F.lit("=")), F.lit(False))


def is_formula_error(x: Column | str) -> Column:
    return F.coalesce(_c(x).isin(*FORMULA_ERRORS), F.lit(False))


def is_heading(line: Column | str, plain: bool = False) -> Column:
    """At most 12 words, and a leading #, a final colon or mostly capitals. ``plain``: the line is normalised already."""

    def judged(n: Column) -> Column:
        words = F.regexp_replace(n, "^[# ]+", "")
        many = F.when(words == "", 0).otherwise(1 + F.char_length(words) - F.char_length(F.replace(words, F.lit(" "), F.lit(""))))
        capitals = (F.char_length(n) - F.char_length(F.regexp_replace(n, r"\p{Lu}", ""))) / F.greatest(F.char_length(n), F.lit(1))
        return many.between(1, 12) & (F.startswith(n, F.lit("#")) | F.endswith(n, F.lit(":")) | (capitals > 0.45))

    if plain:
        return F.coalesce(judged(_c(line)), F.lit(False))
    return bound(F.coalesce(normalised(line), F.lit("")), judged)


def heading_text(line: Column | str) -> Column:
    return F.coalesce(normalised(F.regexp_replace(_c(line), "^[# ]+", "")), _c(line))


def is_bullet(line: Column | str, plain: bool = False) -> Column:
    n = _c(line) if plain else normalised(line)
    return F.coalesce(F.substring(n, 1, 1).isin("-", "*", ">") | (F.substring(n, 1, 2) == "o "), F.lit(False))


def bullet_text(line: Column | str) -> Column:
    """Without its marker, if a space follows that; a bare marker is null, and '-20 C' stays."""
    n = normalised(line)
    return F.nullif(F.when(n.isin("-", "*", ">"), "").otherwise(F.trim(F.regexp_replace(n, "^(?:[-*>o] )", ""))), F.lit(""))


def inferred_title(text: Column | str, fallback: Column) -> Column:
    """The first heading-like line, else ``fallback``."""
    lines = F.filter(F.transform(F.split(_c(text), r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"), squeezed), lambda x: x != "")
    return F.coalesce(heading_text(F.get(F.filter(lines, lambda x: is_heading(x, True)), F.lit(0))), fallback)


def context_prefix(title: Column, labels: Column) -> Column:
    """What stands before a chunk's text in its embedding text."""
    return F.concat(F.lit("Document: "), title, F.lit("\nContext: "), F.array_join(labels, " > "), F.lit("\nContent: "))


def short_hash(prefix: str, length: int, *parts: Column | str) -> Column:
    """``prefix`` and the first digits of the SHA-256 of the parts joined by '|'; null parts count as empty."""
    joined = F.concat_ws("|", *[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(joined, 256), 1, length))


def file_hash(content: Column | str) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(_c(content), 256))


def is_local_path(x: Column | str) -> Column:
    return F.coalesce(_c(x).rlike(r"^(?:[A-Za-z]:[\\/]|\\\\)"), F.lit(False))


def reference_of(raw: Column | str) -> Column:
    """struct(raw, uri, kind, scheme, host, extension) of a candidate reference, without its trailing punctuation.

    URIs lose parameters and fragment, and scheme and host are lower case; drive and network paths become file URIs.
    """
    c = F.regexp_replace(_c(raw), r"[.,;:)]+$", "")
    pattern = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(?:#.*)?$"
    scheme = F.lower(F.regexp_extract(c, pattern, 1))
    netloc = F.lower(F.regexp_extract(c, pattern, 2))
    path = F.regexp_replace(F.regexp_extract(c, pattern, 3), r";[^/]*$", "")
    query = F.regexp_replace(F.regexp_extract(c, pattern, 4), r"^\?$", "")
    uri = F.concat(scheme, F.lit("://"), netloc, path, query)
    local, remote = is_local_path(c), scheme.isin("http", "https")
    posix = F.regexp_replace(c, r"\\", "/")
    extension = lambda p: F.nullif(F.lower(F.regexp_extract(p, r"[^/](\.[^./]+)$", 1)), F.lit(""))
    return F.struct(
        c.alias("raw"),
        F.when(local, F.concat(F.lit("file:///"), posix)).when(remote | (scheme == "file"), uri).alias("uri"),
        F.when(local, "file").when(remote, "url").when(scheme == "file", "file").otherwise("unknown").alias("kind"),
        F.when(local, "path").otherwise(F.nullif(scheme, F.lit(""))).alias("scheme"),
        F.when(remote, F.regexp_replace(F.regexp_replace(netloc, r"^.*@", ""), r":\d*$", "")).alias("host"),
        F.when(local, extension(posix)).when(remote | (scheme == "file"), extension(path)).otherwise(extension(c)).alias("extension"),
    )


def box(left: Column, top: Column, right: Column, bottom: Column, width: Column, height: Column, corners_first: bool = False) -> Column:
    """struct(left, top, width, height) of either spelling of a box; ``corners_first`` says which wins where both are given."""
    corners = F.when(left.isNotNull() & top.isNotNull() & right.isNotNull() & bottom.isNotNull(), F.struct(F.least(left, right).alias("left"), F.least(top, bottom).alias("top"), F.abs(right - left).alias("width"), F.abs(bottom - top).alias("height")))
    sizes = F.when(left.isNotNull() & top.isNotNull() & width.isNotNull() & height.isNotNull(), F.struct(left.alias("left"), top.alias("top"), F.abs(width).alias("width"), F.abs(height).alias("height")))
    return F.coalesce(corners, sizes) if corners_first else F.coalesce(sizes, corners)


def overlap_area(a: Column, b: Column) -> Column:
    across = F.least(a["left"] + a["width"], b["left"] + b["width"]) - F.greatest(a["left"], b["left"])
    down = F.least(a["top"] + a["height"], b["top"] + b["height"]) - F.greatest(a["top"], b["top"])
    return F.greatest(F.lit(0.0), across) * F.greatest(F.lit(0.0), down)


def page_score(n_text: Column, blocks: Column, tables: Column, images: Column, has_notes: Column) -> Column:
    return n_text + 40 * blocks + 220 * tables + 25 * images + F.when(has_notes, 30).otherwise(0)


def attempt_seconds(pages: Column, ocr: bool = False, most: int = 900) -> Column:
    """The first attempt's time budget of a paged document."""
    return F.greatest(F.lit(120), F.least(F.lit(most), 60 + (12 if ocr else 6) * pages))


def retry_seconds(first: Column, elapsed: Column | None = None, total: int = 1800, least: int = 300, most: int = 900) -> Column:
    """A retry's budget: twice the first attempt's, at least ``least``, at most ``most`` and what is left of ``total`` after
    ``elapsed`` seconds (the first attempt's budget where not given). Null where that isn't more than the first attempt had."""
    left = F.greatest(F.lit(0), F.lit(total) - F.ceil(elapsed if elapsed is not None else first)).cast("int")
    allowed = F.least(F.lit(most), left, F.greatest(F.lit(least), 2 * first))
    return F.when(allowed > first, allowed)


def watchdog_seconds(first: Column, total: int = 1800, grace: int = 120) -> Column:
    """The outer deadline: both attempts' budgets within the total, and a grace for starting and stopping."""
    return F.least(F.lit(total), first + F.coalesce(retry_seconds(first, total=total), F.lit(0))) + grace


def checked_budgets(base: int = 60, page: int = 6, ocr_page: int = 12, least: int = 120, most: int = 900, total: int = 1800) -> dict[str, int]:
    """The budget parameters, if all are positive and least <= most <= total; anything else raises."""
    if min(base, page, ocr_page, least, most, total) <= 0 or not least <= most <= total:
        raise ValueError("budgets must be positive, and least <= most <= total")
    return {"base": base, "page": page, "ocr_page": ocr_page, "least": least, "most": most, "total": total}


def recognised_text(blocks: Column) -> Column:
    """struct(text, confidence) of recognised blocks (text, score): blank ones and those under 0.5 are left out."""
    kept = F.filter(blocks, lambda b: normalised(b["text"]).isNotNull() & (b["score"] >= 0.5))
    mean = F.aggregate(kept, F.lit(0.0), lambda held, b: held + b["score"]) / F.size(kept)
    return F.struct(F.array_join(F.transform(kept, lambda b: normalised(b["text"])), "\n").alias("text"), F.when(F.size(kept) > 0, F.bround(mean, 4)).alias("confidence"))


def safe_component(x: Column | str, default: str) -> Column:
    """A value that is safe as one part of a path."""
    plain = F.regexp_replace(F.regexp_replace(_c(x), r"[^A-Za-z0-9._-]+", "_"), r"^[._]+|[._]+$", "")
    return F.when((plain == "") | plain.isNull(), default).otherwise(plain)


def is_safe_component(x: Column | str) -> Column:
    return F.coalesce(_c(x).rlike(r"\A[A-Za-z0-9][A-Za-z0-9._-]*\z"), F.lit(False))


def collection_name(agent: Column | str, prefix: str = "documents") -> Column:
    """The vector collection of an agent; an agent name that gives no valid one raises."""
    plain = F.replace(F.lower(_c(agent)), F.lit("_"), F.lit("-"))
    return F.when(plain.rlike(r"\A[a-z0-9][a-z0-9-]*\z"), F.concat(F.lit(f"{prefix}-"), plain, F.lit("-chunks"))).otherwise(F.raise_error(F.concat(F.lit("invalid agent name: "), F.coalesce(_c(agent), F.lit("null")))))


def uuid5(name: Column | str, namespace: str = URL_NAMESPACE) -> Column:
    """The name-based UUID of version 5."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace)), _c(name).cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12))


def without_fence(x: Column | str) -> Column:
    """A reply without the code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(_c(x)), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def version_number(x: Column | str) -> Column:
    """The number of 'v12'; null for other forms."""
    return F.nullif(F.regexp_extract(_c(x), r"^v(\d+)$", 1), F.lit("")).cast("int")
