"""Text rules as native column expressions. Columns are strings; nulls stay null unless said otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space, as a Java character class's inside.
_SPACE = r"\s\x{0085}\p{Z}"
#: Also taken for spaces where markers are looked for: zero width space and byte order mark.
_ODD_SPACE = r"\x{200B}\x{FEFF}"
_NUMBER = r"\d{1,3}(?:[,\p{Zs}]\d{3})+|\d+"
#: "from - to / total", with thousands grouped by commas or spaces. A plain run of digits is one number, however long.
PAGER = rf"({_NUMBER})[\s\p{{Zs}}]*[-–][\s\p{{Zs}}]*({_NUMBER})[\s\p{{Zs}}]*/[\s\p{{Zs}}]*({_NUMBER})"
#: Possessive: a tag's text can be cut in one way only, so the match needs no way back and stays linear.
TAG = r"""<(?:"[^"]*+"|'[^']*+'|[^'">]++)*+>"""
#: Dates that stand for none.
NO_DATES = ("1000-01-01", "3000-01-01")


def collapse(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{_SPACE}]+", " "))


def normalise(c: Column) -> Column:
    """collapse(), with invisible spaces as spaces: what markers are searched in."""
    return F.trim(F.regexp_replace(c, f"[{_SPACE}{_ODD_SPACE}]+", " "))


def trimmed(c: Column) -> Column:
    """Without white space at the ends. A pattern that ends in $ tries every run of blanks of a long text, so one is used only where the text ends in a blank."""
    head = F.when(F.left(c, F.lit(1)).rlike(f"[{_SPACE}]"), F.regexp_replace(c, f"^[{_SPACE}]+", "")).otherwise(c)
    return F.when(F.right(head, F.lit(1)).rlike(f"[{_SPACE}]"), F.regexp_replace(head, f"[{_SPACE}]+$", "")).otherwise(head)


def query_key(c: Column) -> Column:
    """The key of a query: trimmed, lower case."""
    return F.lower(trimmed(c))


def store_key(line: Column) -> Column:
    """The key of a store's line: its first tab-separated field as a query key."""
    return query_key(F.split_part(line, F.lit("\t"), F.lit(1)))


def strip_html(c: Column) -> Column:
    """Tags go, a lone no-break space entity is empty, and double quotes become single ones. Other entities stay."""
    bare = F.when(F.contains(c, F.lit("<")), F.regexp_replace(c, TAG, "")).otherwise(c)
    return F.when(bare.isin("&nbsp;", "&#160;"), "").otherwise(F.translate(bare, '"', "'"))


def cell(c: Column) -> Column:
    return collapse(strip_html(c))


def utf16_length(c: Column) -> Column:
    return (F.octet_length(F.encode(c, "UTF-16BE")) / 2).cast("int")


def clip(c: Column, n: int) -> Column:
    """The first n UTF-16 units; a character of two units is not cut."""
    if n <= 0:
        return F.when(c.isNotNull(), "")
    wide = lambda x: F.when(F.octet_length(x) > 3, 2).otherwise(1)
    chars = F.split(F.substring(c, 1, n), "")
    walked = F.aggregate(
        chars,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("units")),
        lambda s, x: F.when(s["units"] + wide(x) <= n, F.struct(F.concat(s["text"], x).alias("text"), (s["units"] + wide(x)).alias("units"))).otherwise(F.struct(s["text"].alias("text"), F.lit(n).alias("units"))),
    )["text"]
    return F.when(utf16_length(c) == F.length(c), F.substring(c, 1, n)).otherwise(walked)


def unique_join(values: Column, sep: str = ", ") -> Column:
    """First occurrences in order."""
    return F.array_join(F.array_distinct(values), sep)


def date_only(c: Column) -> Column:
    """What stands before T; without a T, or for a date that stands for none, nothing."""
    day = F.split_part(c, F.lit("T"), F.lit(1))
    return F.when(F.contains(c, F.lit("T")) & ~day.isin(*NO_DATES), day).when(c.isNotNull(), "")


def sanitise(c: Column) -> Column:
    """A name for files: wildcards by name, other characters than letters, digits, spaces and dashes as one dash, at most 60 bytes. Names of different queries may agree."""
    trim = lambda x: F.regexp_replace(x, "^-+|-+$", "")
    named = F.replace(F.replace(trimmed(c), F.lit("*"), F.lit("-star-")), F.lit("?"), F.lit("-qmark-"))
    plain = trim(F.regexp_replace(F.lower(F.regexp_replace(named, r"[^\p{L}\p{N} -]+", "-")), "-{2,}", "-"))
    plain = F.when(plain == "", "query").otherwise(plain)
    fits = F.try_element_at(F.filter(F.sequence(F.lit(60), F.lit(1), F.lit(-1)), lambda k: F.octet_length(F.left(plain, k)) <= 60), F.lit(1))
    return F.when(F.octet_length(plain) <= 60, plain).otherwise(trim(F.left(plain, fits)))


def archive_name(query: Column, page: Column) -> Column:
    return F.format_string("%s_p%d.raw", sanitise(query), page)


def full_name(query: Column) -> Column:
    """The name of a query's whole first page of results."""
    return F.concat(sanitise(query), F.lit("_full.html"))


def snippet(c: Column, n: int) -> Column:
    text = normalise(c)
    return F.when(F.octet_length(text) <= n, text).when(F.lit(n <= 3), F.left(text, F.lit(n))).otherwise(F.concat(F.left(text, F.lit(max(0, n - 3))), F.lit("...")))


def truncated(c: Column, n: int) -> Column:
    return F.when(F.octet_length(c) > n, F.concat(F.left(c, F.lit(n)), F.lit("…"))).otherwise(c)


def pager(c: Column) -> Column:
    """A position line as struct(from, to, total, last); null if it is none or ends past its total."""
    part = lambda i: F.regexp_replace(F.regexp_extract(c, PAGER, i), r"[,\p{Zs}]", "").try_cast("long")
    first, to, total = part(1), part(2), part(3)
    read = F.struct(first.alias("from"), to.alias("to"), total.alias("total"), (to >= total).alias("last"))
    return F.when(first.isNotNull() & (to <= total), read)


def first_marker(text: Column, markers: Sequence[str]) -> Column:
    """The first marker, in list order, that the text holds."""
    return F.coalesce(*[F.when(F.contains(text, F.lit(m)), F.lit(m)) for m in markers]) if markers else F.lit(None).cast("string")


def markers_held(text: Column, markers: Sequence[str]) -> Column:
    total = F.lit(0)
    for m in markers:
        total = total + F.contains(text, F.lit(m)).cast("int")
    return total


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"\.$", "")


def from_site(url: Column, domains: Sequence[str], fragment: str) -> Column:
    """Whether a URL's host is one of the domains or below one, and its path holds the fragment."""
    h = host(url)
    inside = F.lit(False)
    for d in domains:
        inside = inside | (h == d) | F.endswith(h, F.lit("." + d))
    return F.coalesce(inside & F.contains(F.lower(F.try_parse_url(url, F.lit("PATH"))), F.lit(fragment)), F.lit(False))


def resource_blocked(kind: Column, url: Column, kinds: Sequence[str], hosts: Sequence[str], parts: Sequence[str]) -> Column:
    """Whether a request is left out: by resource type, by a part of its host, or by a part of its URL."""
    held = lambda c, xs: F.coalesce(first_marker(F.lower(c), xs).isNotNull(), F.lit(False))
    return kind.isin(*kinds) | held(host(url), hosts) | held(url, parts)


def row_key(brand: Column, holder: Column, reg_number: Column, reg_date: Column, number: Column, record_id: Column) -> Column:
    """A row's identity within a query: its record id, or else what it shows and its place."""
    empty = lambda c: F.coalesce(c, F.lit(""))
    shown = F.concat_ws("\x1f", empty(brand), empty(holder), empty(reg_number), empty(reg_date), F.coalesce(number, F.lit(-1)).cast("string"))
    return F.when(F.coalesce(record_id, F.lit("")) != "", F.concat(F.lit("id:"), record_id)).otherwise(F.concat(F.lit("c:"), shown))


def row_hash(query: Column, key: Column) -> Column:
    """A 64-bit hash of a row in its query. The zero byte keeps (ab, 12) apart from (a, b12)."""
    return F.xxhash64(F.concat(query, F.lit("\x00"), key))


def stamped(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd HH:mm:ss")


def day(at: Column) -> Column:
    return F.date_format(at, "yyyy-MM-dd")


def action_seconds(action: Column) -> Column:
    """Seconds of an action sleepN, 1 to 3600; else null."""
    n = F.regexp_extract(action, r"^sleep\+?(\d{1,9})$", 1).try_cast("int")
    return F.when(n.between(1, 3600), n)
