"""Text expressions: id lists, names, html, excerpts and search tokens. All stay inside codegen."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def id_list(c: Column | str) -> Column:
    """Space-delimited ids as an array; empty text, NULL and the word "null" give no ids."""
    tokens = F.filter(F.split(F.coalesce(_col(c), F.lit("")), r"\s+"), lambda t: (t != "") & (t != "null"))
    return F.transform(tokens, lambda t: t.cast("bigint"))


def has_token(c: Column | str, token: int | str) -> Column:
    """The space-delimited list contains the token, wherever the outer spaces are."""
    return F.array_contains(F.split(F.trim(_col(c)), r"\s+"), str(token))


def comma_list(c: Column | str) -> Column:
    """Comma-delimited text as trimmed, non-empty strings."""
    return F.filter(F.transform(F.split(F.coalesce(_col(c), F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")


def base_type(c: Column | str) -> Column:
    """Item type without its view suffix."""
    return F.regexp_replace(_col(c), f"{fixed.VIEW_SUFFIX}$", "")


def capitalised(c: Column | str) -> Column:
    """First letter in upper case, the rest as it is."""
    c = _col(c)
    return F.concat(F.upper(F.substring(c, 1, 1)), c.substr(F.lit(2), F.length(c)))


def store_name(item_type: Column | str, kind: Column | str | None = None, prefix: str = "export") -> Column:
    """Name of the table of an item type, or of one of its side tables; references share one table."""
    item_type = F.lower(_col(item_type))
    if kind is None:
        return F.concat_ws("_", F.lit(prefix), item_type)
    kind = F.lower(_col(kind))
    return F.when(kind == "reference", F.concat_ws("_", F.lit(prefix), kind)).otherwise(
        F.concat_ws("_", F.lit(prefix), base_type(item_type), kind)
    )


def document_set(item_type: Column | str, language: Column | str, searchable: bool = False, prefix: str = "export") -> Column:
    """Name of the document set; file content has one set without languages and no searchable one."""
    kind = F.lower(F.trim(_col(item_type)))
    content = kind == fixed.FILE_CONTENT_TYPE.lower()
    lang = _col(language).cast("string")
    if searchable:
        return F.when(content, F.lit("")).otherwise(F.concat_ws("_", F.lit(prefix), kind, F.lit("search"), lang))
    return F.when(content, F.concat_ws("_", F.lit(prefix), kind)).otherwise(
        F.concat_ws("_", F.lit(prefix), kind, lang)
    )


HTML_DROPPED = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
# A tag starts with a letter, a slash, an exclamation or a question mark right after the bracket; "a < b" is text.
HTML_TAG = r"<[A-Za-z/!?][^>]*>"
HTML_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9A-Fa-f]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"


def _named_references() -> Column:
    """Names of the html standard's character references, with their characters."""
    names = {name[:-1]: char for name, char in html5.items() if name.endswith(";")}
    return F.from_json(F.lit(json.dumps(names)), "map<string,string>")


def _decoded(reference: Column) -> Column:
    """The character a reference stands for; one that stands for none stays as it is written."""
    body = F.substring(reference, 2, F.length(reference) - 2)
    digits = F.when(body.rlike("^#[xX]"), F.conv(F.substr(body, F.lit(3)), 16, 10)).otherwise(F.substr(body, F.lit(2)))
    code = F.when(body.startswith("#"), digits.try_cast("bigint"))
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    character = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return F.coalesce(F.when(valid, character), F.element_at(_named_references(), body), reference)


def decode_references(c: Column | str) -> Column:
    """Text with its numeric and named character references decoded, each once and from left to right."""
    c = _col(c)
    between, found = F.split(c, HTML_REFERENCE, -1), F.regexp_extract_all(c, F.lit(HTML_REFERENCE), F.lit(0))
    decoded = F.concat(F.transform(found, _decoded), F.array(F.lit("")))
    joined = F.array_join(F.zip_with(between, decoded, lambda text, char: F.concat(text, char)), "")
    return F.when(c.rlike(HTML_REFERENCE), joined).otherwise(c)


def _visible(c: Column) -> Column:
    """Html without tags, its references decoded; text without markup skips the patterns."""
    text = F.when(c.contains("<"), F.regexp_replace(F.regexp_replace(c, HTML_DROPPED, " "), HTML_TAG, " ")).otherwise(c)
    return F.when(c.contains("&"), F.replace(decode_references(text), F.lit("\u00a0"), F.lit(" "))).otherwise(text)


def html_text(c: Column | str) -> Column:
    """Visible text of an html value: tags become spaces, runs of white space one space."""
    return F.trim(F.regexp_replace(_visible(_col(c)), r"\s+", " "))


def search_tokens(c: Column | str) -> Column:
    """Tokens of the primary analyzer: html stripped, split at white space, lower case."""
    return F.array_remove(F.split(F.lower(_visible(_col(c))), r"\s+"), "")


def head_tail(c: Column | str, length: int, separator: str = "") -> Column:
    """Text above ``length`` keeps its first and last halves."""
    c = _col(c)
    half = length // 2
    return F.when(
        F.length(c) > length, F.concat(F.left(c, F.lit(half)), F.lit(separator), F.right(c, F.lit(half)))
    ).otherwise(c)


def big_value(c: Column | str) -> Column:
    """A long attribute cut to the store's attribute size."""
    return head_tail(c, fixed.ATTRIBUTE_DATA_LENGTH)


def content_excerpt(c: Column | str) -> Column:
    """Raw excerpt of a file's content."""
    return head_tail(c, fixed.FILE_CONTENT_LENGTH, " ")


def raw_keyword(c: Column | str) -> Column:
    """Lower-case keyword; values above the keyword size have none."""
    c = _col(c)
    return F.when(F.length(c) <= fixed.RAW_KEYWORD_LENGTH, F.lower(c))
