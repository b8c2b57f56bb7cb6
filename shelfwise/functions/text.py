"""Column expressions for text: cleaning, parsing, URLs, prices and hashes.

Every function takes and returns a ``Column`` and stays inside Spark's expression engine, but for
``nfkc``, which has no built-in.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space that a trim takes off at the ends: ``\s``, and wide and other spaces.
BLANKS = " \t\n\x0b\f\r\x85\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Runs of white space that are not one space already, so that most texts stay as they are.
_RUN = "[\\t\\n\\f\\r][\\t\\n\\f\\r ]*| [\\t\\n\\f\\r ]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def or_null(c: Column) -> Column:
    """A text that is computed once, or null if it is empty."""
    return let(c, lambda x: F.nullif(x, F.lit("")))


def quoted(words: list[str] | tuple[str, ...]) -> str:
    """A regular expression that matches any of ``words`` literally."""
    return "|".join("\\Q" + w + "\\E" for w in words)


def clean_text(c: Column) -> Column:
    """Runs of white space become one space, none stays at the ends; null becomes empty."""
    return _cleaned(F.coalesce(c, F.lit("")))


def _cleaned(c: Column) -> Column:
    """``clean_text`` that leaves null alone."""
    return F.trim(F.regexp_replace(c, _RUN, " "), F.lit(BLANKS))


def clean_lines(c: Column) -> Column:
    """``clean_text`` on every line; empty lines go."""
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), clean_text)
    return F.array_join(F.filter(parts, lambda x: x != ""), "\n")


def truncate_chars(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def unescape_entities(c: Column) -> Column:
    """The five basic entities, in one pass: ``&amp;lt;`` becomes ``&lt;`` and no more."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


#: All characters but ``a-z0-9가-힣_-``, by their ranges: a negated class of ranges takes Java about ten times as long.
_NOT_IN_SLUG = "[\\x00-,./:-^`{-\\uabff\\ud7a4-\\x{10ffff}]+"


def slug(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.trim(c)), _NOT_IN_SLUG, "-"), F.lit("-"))


@F.pandas_udf(T.StringType())  # type: ignore[call-overload]
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc_lower(c: Column, normalise: bool = True) -> Column:
    """Compatibility-normalised lower case.

    ``normalise=False`` leaves the normal form to the caller, for data known to have it (plain ASCII
    and Hangul syllables), and keeps the plan free of Python.
    """
    return F.lower(_nfkc(c)) if normalise else F.lower(c)


def tokens(c: Column) -> Column:
    """Runs of Latin letters, digits and Hangul of a lower-case text."""
    return F.regexp_extract_all(c, F.lit("[0-9a-zA-Z가-힣]+"), F.lit(0))


def first_non_empty(*cols: Column) -> Column:
    """The first alias that has text, cleaned; empty if none has."""
    return F.coalesce(*(or_null(_cleaned(c)) for c in cols), F.lit(""))  # those after it are not cleaned


def contains_any(c: Column, words: list[str] | tuple[str, ...]) -> Column:
    return let(c, lambda x: any_of([x.contains(w) for w in words]))


def _number_text(c: Column) -> Column:
    """A text without white space at its ends and without commas; what is inside is left to the pattern of a number."""
    return F.replace(F.trim(c, F.lit(BLANKS)), F.lit(","), F.lit(""))


def parse_uint(c: Column) -> Column:
    """Digits, with thousands commas; anything else is null."""
    digits = _number_text(c)
    return let(digits, lambda d: F.when(d.rlike("^[0-9]{1,19}$"), d.try_cast("bigint")))


def parse_float(c: Column) -> Column:
    return let(_number_text(c), lambda n: F.when(n.rlike("^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"), n.try_cast("double")))


def _always_in(pattern: str) -> str:
    """The characters that a pattern begins with, if they stand for themselves and in one case."""
    found = re.match("[^\\\\\\[\\](){}.*+?^$|a-zA-Z/]{2,}|\"[a-zA-Z]+\"", pattern)
    return found[0] if found and not pattern[found.end() :].startswith(("?", "*", "{")) and "|" not in pattern else ""


def first_group(c: Column, patterns: list[str]) -> Column:
    """Group 1 of the first pattern that matches with text in it; empty if none does.  Patterns whose beginning is not in
    the text are not tried."""

    def group(x: Column, p: str) -> Column:
        found, begin = or_null(F.regexp_extract(x, p, 1)), _always_in(p)
        return F.when(x.contains(begin), found) if begin else found

    return let(F.coalesce(c, F.lit("")), lambda x: F.coalesce(*(group(x, p) for p in patterns), F.lit("")))


_S = "[\\t\\n\\f\\r ]*"
#: Where a price in won may stand, in order of trust.
PRICE_PATTERNS = [
    f"[￦₩]{_S}([0-9,]+)",
    f"KRW{_S}([0-9,]+)",
    f"([0-9,]+){_S}원",
    f"\\({_S}[￦₩]{_S}([0-9,]+){_S}\\)",
    f"판매가{_S}([0-9,]+)",
    f"쿠폰적용가{_S}([0-9,]+)",
]
LEAST_PRICE = 100


def _grouped(c: Column, kind: str = "bigint") -> Column:
    """Digits without their commas as a number; null if there are none, without a cast, because one that fails costs
    ten times one that does not."""
    return or_null(F.replace(c, F.lit(","), F.lit(""))).try_cast(kind)


def price_krw(c: Column, patterns: list[str] | None = None) -> Column:
    """The first price of at least 100 by pattern, whatever its case, else the largest number grouped by commas."""
    enough = lambda value: let(value, lambda v: F.when(v >= LEAST_PRICE, v))

    def found(x: Column) -> Column:
        grouped = F.regexp_extract_all(x, F.lit("([0-9]{1,3}(?:,[0-9]{3})+)"), F.lit(1))
        largest = let(F.array_max(F.transform(grouped, lambda g: _grouped(g))), lambda v: F.when(v > 0, v))
        return F.coalesce(*(enough(_grouped(F.regexp_extract(x, f"(?i){p}", 1))) for p in patterns or PRICE_PATTERNS), F.when(x.contains(","), largest))

    # the fixed patterns allow runs of white space wherever they allow one, so only others need a clean text
    return let(clean_text(c) if patterns else c, found)


def price_usd(c: Column) -> Column:
    return _grouped(F.regexp_extract(c, f"\\${_S}([0-9,]+(?:\\.[0-9]+)?)", 1), "double")


def first_number(c: Column) -> Column:
    """The first run of digits, with commas only where they group thousands."""
    return _grouped(F.regexp_extract(c, "([0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)", 1))


#: Where a product code stands in a link or script, in order; and in a path of provider B.
CODE_PATTERNS = ["(?i)goodscode=([0-9]+)", "(?i)goodsno=([0-9]+)", "(?i)itemno=([0-9]+)", f"(?i)item{_S}no\\.{_S}:{_S}([0-9]+)", "/([0-9]{8,})"]
PATH_PATTERN = "/goods/([0-9]+)"


def product_code(c: Column) -> Column:
    return first_group(c, CODE_PATTERNS)


def path_code(c: Column) -> Column:
    return first_group(c, [PATH_PATTERN])


def platform_of(url: Column) -> Column:
    """``korean`` or ``global`` by the host of provider A, else ``list``."""
    lower = F.lower(url)
    return F.when(lower.contains("item.gmarket.co.kr"), "korean").when(lower.contains("global.gmarket.co.kr"), "global").otherwise("list")


def url_decoded(c: Column) -> Column:
    """Percent signs and pluses decoded; a text that is no valid encoding stays."""
    return F.coalesce(F.try_url_decode(c), c)


def absolute_url(c: Column, base: Column) -> Column:
    """Unescaped, decoded, with a scheme, and resolved against the host of ``base`` if it is a path."""
    root = F.regexp_extract(base, "^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)", 1)
    resolved = lambda u: (
        F.when(u == "", F.lit(""))
        .when(u.startswith("//"), F.concat(F.lit("https:"), u))
        .when(u.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), u)
        .when(u.startswith("/"), F.concat(root, u))
        .otherwise(F.concat(root, F.lit("/"), u))
    )
    plain = F.replace(unescape_entities(clean_text(c)), F.lit("\\/"), F.lit("/"))
    return let(plain, lambda p: let(url_decoded(p), resolved))


#: Item pages of provider A, and where links to its pages stand in scripts and attributes.
DOMESTIC_ITEM, GLOBAL_ITEM = "https://item.gmarket.co.kr/Item?goodscode=", "https://global.gmarket.co.kr/item?goodscode="
GLOBAL_LINKS = [
    "(?i)SearchListPage\\.viewUrl\\(\\s*'([^']+)'",
    "(?i)SearchListPage\\.viewUrl\\(\\s*\"([^\"]+)\"",
    "(?i)'(https?://global\\.gmarket\\.co\\.kr/[^']+)'",
    "(?i)\"(https?://global\\.gmarket\\.co\\.kr/[^\"]+)\"",
    "(?i)(https?://global\\.gmarket\\.co\\.kr/[^\\s'\")]+)",
]
DOMESTIC_LINKS = ["(?i)(https?://item\\.gmarket\\.co\\.kr/[^\\s'\")]+)", "(?i)(https?://www\\.gmarket\\.co\\.kr/[^\\s'\")]+)"]


def url_triple(raw: Column, code: Column | None = None) -> Column:
    """``struct(code, domestic, foreign)`` from attributes and scripts of a link; ``code`` if none is in them."""
    item = lambda url, prefix, found: F.when((url == "") & (found != ""), F.concat(F.lit(prefix), found)).otherwise(url)
    secure = lambda url, host: F.replace(url, F.lit(f"http://{host}"), F.lit(f"https://{host}"))

    def links(text: Column) -> Column:
        foreign = absolute_url(first_group(text, GLOBAL_LINKS), F.lit("https://global.gmarket.co.kr"))
        domestic = absolute_url(first_group(text, DOMESTIC_LINKS), F.lit("https://www.gmarket.co.kr"))
        return F.struct(text.alias("text"), foreign.alias("foreign"), domestic.alias("domestic"))

    def coded(x: Column) -> Column:
        found = F.coalesce(*(or_null(product_code(x[c])) for c in ("text", "foreign", "domestic")), code if code is not None else F.lit(""), F.lit(""))
        return F.struct(found.alias("code"), x["domestic"].alias("domestic"), x["foreign"].alias("foreign"))

    def whole(x: Column) -> Column:
        return F.struct(
            x["code"].alias("code"),
            secure(item(x["domestic"], DOMESTIC_ITEM, x["code"]), "item.gmarket.co.kr").alias("domestic"),
            secure(item(x["foreign"], GLOBAL_ITEM, x["code"]), "global.gmarket.co.kr").alias("foreign"),
        )

    plain = F.replace(unescape_entities(raw), F.lit("\\/"), F.lit("/"))
    return let(plain, lambda p: let(url_decoded(p), lambda t: let(links(t), lambda x: let(coded(x), whole))))


def piped_union(*cols: Column) -> Column:
    """Ordered distinct parts of pipe-separated lists, cleaned, as an array."""
    parts = F.transform(F.split(F.concat_ws("|", *cols), "[|]"), clean_text)
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def unique_keep_order(c: Column) -> Column:
    return F.array_distinct(F.filter(F.transform(c, clean_text), lambda x: x != ""))


def fnv1a_32(c: Column) -> Column:
    """FNV-1a of the UTF-8 bytes of a text, as a non-negative long."""
    digits = F.hex(F.encode(c, "UTF-8"))
    pairs = F.filter(F.split(F.regexp_replace(digits, "(..)", "$1 "), " "), lambda x: x != "")
    return F.aggregate(
        pairs,
        F.lit(2166136261).cast("long"),
        lambda h, byte: (h.bitwiseXOR(F.conv(byte, 16, 10).cast("long")) * F.lit(16777619).cast("long")).bitwiseAND(F.lit(4294967295).cast("long")),
    )


def batch_token(table: str, payload: Column) -> Column:
    return F.sha2(F.concat(F.lit(table), F.char(F.lit(31)), payload).cast("binary"), 256)


def uuid_v7(ts: Column) -> Column:
    """Time-ordered random identifier: 48 bits of milliseconds, version 7, the rest random."""
    ms = F.lpad(F.lower(F.hex(F.unix_millis(ts))), 12, "0")
    r = F.replace(F.uuid(), F.lit("-"), F.lit(""))  # the 17th digit of a random one is its variant
    return F.concat_ws("-", F.substring(ms, 1, 8), F.substring(ms, 9, 4), F.concat(F.lit("7"), F.substring(r, 1, 3)), F.substring(r, 17, 4), F.substring(r, 21, 12))


def event_key(event_type: Column, url: Column, uuid: Column) -> Column:
    link = F.trim(F.coalesce(url, F.lit("")))
    return F.when(link != "", F.concat(event_type, F.lit(":"), link)).otherwise(F.concat(event_type, F.lit(":"), uuid))


def thousands(c: Column) -> Column:
    return F.format_number(c, 0)


def range_key(low: Column, high: Column) -> Column:
    return F.concat(F.lit("range:"), F.greatest(low, F.lit(0)).cast("string"), F.lit("-"), F.greatest(high, F.lit(0)).cast("string"))


def range_label(low: Column, high: Column) -> Column:
    top = F.concat(F.lit("~₩"), thousands(high))
    return F.when(low <= 0, top).otherwise(F.concat(F.lit("₩"), thousands(low), top))


def time_text(ts: Column, millis: bool = False) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS" if millis else "yyyy-MM-dd HH:mm:ss")


def valid_json(c: Column) -> Column:
    """Whether a text is one JSON value; the parser alone would pass over what follows the first."""
    wrapped = F.concat(F.lit("["), c, F.lit("]"))
    return F.coalesce(F.try_parse_json(wrapped).isNotNull() & (F.json_array_length(wrapped) == 1), F.lit(False))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
