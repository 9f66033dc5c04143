"""Scalar expressions on strings and JSON; all of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The rules a safe object name must follow.
NAME_SEPARATORS = r"[./ ]"
NAME_CONTROLS = r"[\x00-\x1f\x7f]"
NAME_LENGTH = 255

# Tags of a tagged document, in order.
DOCUMENT_TAGS = ("product_category", "product_sub_category", "product_name", "product_doc")

TOKEN_BREAK = r"[^\p{L}\p{N}]+"
LINES_PER_CHUNK = 4


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it in ``body``.

    A lambda evaluates what it mentions for every element; bound here, a split of a text
    is made once per row and not once per element.
    """
    return F.transform(F.array(value), body)[0]


def login_prefix(login: Column) -> Column:
    """Everything before the first ``@``."""
    return F.regexp_replace(login, "@.*$", "")


def safe_name(name: Column) -> Column:
    """A name usable for a catalog object."""
    joined = F.regexp_replace(name, NAME_SEPARATORS, "_")
    return F.substring(F.lower(F.regexp_replace(joined, NAME_CONTROLS, "")), 1, NAME_LENGTH)


def flat_key(key: Column) -> Column:
    """Dotted key to a plain identifier."""
    return F.replace(key, F.lit("."), F.lit("_"))


def spaced_name(name: Column, sep: str) -> Column:
    return F.replace(name, F.lit(" "), F.lit(sep))


def function_name(tool: Column) -> Column:
    """A tool's name spells the dots of a function's name as double underscores."""
    return F.replace(tool, F.lit("__"), F.lit("."))


def name_parts(name: Column) -> Column:
    return F.split(name, r"\.")


def file_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def host(url: Column) -> Column:
    return F.regexp_extract(url, r"^[a-z]+://([^/?#:]+)", 1)


def indexed_doc(category: Column, sub_category: Column, name: Column, doc: Column) -> Column:
    """The other columns, each in its tag, one per line."""
    fields = zip(DOCUMENT_TAGS, (category, sub_category, name, doc), strict=True)
    return F.concat_ws(
        "\n",
        *[
            F.concat(F.lit(f"<{tag}>"), F.coalesce(value, F.lit("")), F.lit(f"</{tag}>"))
            for tag, value in fields
        ],
    )


def parse_indexed_doc(doc: Column) -> dict[str, Column]:
    """The inverse of :func:`indexed_doc`.

    A field reaches up to its closing tag before the next field, the last one up to the
    end of the text, so a ``<`` or a newline inside a field survives.
    """
    pattern = "(?s)^" + "\n".join(f"<{tag}>(.*?)</{tag}>" for tag in DOCUMENT_TAGS[:-1])
    pattern += f"\n<{DOCUMENT_TAGS[-1]}>(.*)</{DOCUMENT_TAGS[-1]}>$"
    return {tag: F.regexp_extract(doc, pattern, i) for i, tag in enumerate(DOCUMENT_TAGS, 1)}


def tokens(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), TOKEN_BREAK)
    return F.filter(parts, lambda t: t != "")


def plain_base64(payload: Column) -> Column:
    """Base64 on one line; Spark's own breaks the line every 76 characters."""
    return F.translate(F.base64(payload), "\r\n", "")


def line_chunks(text: Column, lines: int = LINES_PER_CHUNK) -> Column:
    """The text cut into runs of ``lines`` lines, as an array: no shuffle is needed."""

    def cut(rows: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(rows), F.lit(lines))
        return F.transform(starts, lambda at: F.array_join(F.slice(rows, at, lines), "\n"))

    return let(F.split(text, "\n"), cut)


def heading_chunks(text: Column) -> Column:
    """Markdown cut before every heading line; text above the first heading is kept."""
    return F.filter(F.split(text, r"(?m)^(?=#{1,6} )"), lambda part: F.trim(part) != "")


_OPEN = "array<struct<level: int, title: string>>"
_SECTIONS = "array<struct<level: int, path: string, chunk: string>>"


def section_chunks(text: Column) -> Column:
    """Heading chunks as ``(level, path, chunk)``; the path names the headings a chunk is under, its own last.

    The open headings are a stack: a heading closes those of its own level and below. Text above
    the first heading has level 0 and no path. A title ends with its line or at a tag.
    """
    start = F.struct(F.array().cast(_OPEN).alias("stack"), F.array().cast(_SECTIONS).alias("out"))

    def add(seen: Column, chunk: Column) -> Column:
        level = F.length(F.regexp_extract(chunk, "^(#{1,6}) ", 1)).cast("int")
        title = F.trim(F.regexp_extract(chunk, r"^#{1,6} ([^\n<]*)", 1))
        above = F.filter(seen["stack"], lambda h: h["level"] < level)
        stack = F.when(level > 0, F.concat(above, F.array(F.struct(level.alias("level"), title.alias("title"))))).otherwise(seen["stack"])
        path = F.when(level > 0, F.array_join(F.transform(stack, lambda h: h["title"]), " > ")).otherwise("")
        row = F.struct(level.alias("level"), path.alias("path"), chunk.alias("chunk"))
        found = F.struct(stack.alias("stack"), F.concat(seen["out"], F.array(row)).alias("out"))
        return found.cast(f"struct<stack: {_OPEN}, out: {_SECTIONS}>")

    return F.aggregate(heading_chunks(text), start, add, lambda seen: seen["out"])


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"[.!?]+"), lambda s: F.regexp_replace(s, r"\s+", "") != "")


def term_matches(text: Column, terms: tuple[str, ...]) -> Column:
    """How many tokens of the text are in a fixed, short list of terms."""
    wanted = F.array(*[F.lit(t) for t in terms])
    return F.size(F.filter(tokens(text), lambda t: F.array_contains(wanted, t)))
