"""Scalar functions as Column expressions; only accent folding needs Python (NFKD is not built in)."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Bodies that mean that a comment is gone.
GONE = ("", "[deleted]", "[removed]")
# Texts of links to a post that are counters or controls, not titles.
COUNTER = "(?i)^(?:[0-9]+[.,]?[0-9]*\\s*)?(?:comments?|replies|votes?|shares?)$"
CONTROLS = ("open post", "view post", "share", "save", "more options")
# White space as Python's str methods see it.
BLANK = "[\\s\\x1c-\\x1f\\x85\\p{Z}]"


def column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: str | Column) -> Column:
    """Runs of white space become one space; none at the ends; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(column(c), F.lit("")), f"{BLANK}+", " "))


def clean_lines(c: str | Column) -> Column:
    """Line feeds become spaces, other white space stays inside and goes at the ends."""
    return F.regexp_replace(F.replace(F.coalesce(column(c), F.lit("")), F.lit("\n"), F.lit(" ")), f"^{BLANK}+|{BLANK}+$", "")


def fold(text: str | None) -> str:
    """Compatibility decomposition without marks, in lower case."""
    text = text or ""
    if text.isascii():
        return text.lower()
    # no character below U+0300 is a mark
    return re.sub("[^\x00-\u02ff]+", lambda run: "".join(c for c in run[0] if not unicodedata.combining(c)), unicodedata.normalize("NFKD", text)).lower()


#: fold() row by row: texts go to Python by the hundred, not in batches of 10,000, whose size grows with the texts.
normalize_for_match = F.udf(fold, T.StringType(), useArrow=False)


def is_title(c: str | Column) -> Column:
    """Whether a cleaned text is neither blank, a counter nor a control."""
    return (column(c) != "") & ~column(c).rlike(COUNTER) & ~F.lower(column(c)).isin(*CONTROLS)


def is_title_text(text: str) -> bool:
    """is_title() for one text."""
    return bool(text) and not re.match(COUNTER, text) and text.casefold() not in CONTROLS


def parse_int(c: str | Column, default: int | Column = 0) -> Column:
    """The first run of digits and commas as a number; anything else is the default."""
    found = F.replace(F.regexp_extract(F.coalesce(column(c).cast("string"), F.lit("")), "-?[0-9,]+", 0), F.lit(","), F.lit(""))
    return F.coalesce(found.try_cast("bigint"), default if isinstance(default, Column) else F.lit(default).cast("bigint"))


def parse_created(c: str | Column) -> Column:
    """Epoch seconds from a number, a number as text, or an ISO time; null if neither."""
    text = F.trim(column(c).cast("string"))
    return F.coalesce(text.try_cast("double"), (F.unix_micros(text.try_cast("timestamp")) / 1e6))


def to_iso(c: str | Column, zero_is_missing: bool = False) -> Column:
    """ISO 8601 in UTC from epoch seconds, microseconds only if there are any; missing is empty."""
    seconds = column(c).cast("double")
    micros = F.round(seconds * 1e6).cast("bigint")
    at = F.timestamp_micros(micros)
    # date_format pads fractions, so they are left out where they are zero
    text = F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.pmod(micros, F.lit(1_000_000)) == 0, "").otherwise(F.date_format(at, ".SSSSSS")), F.lit("+00:00"))
    missing = seconds.isNull() | ((seconds == 0) & F.lit(zero_is_missing))
    return F.when(missing, "").otherwise(text)


def strip_fullname(c: str | Column) -> Column:
    """An id without its kind prefix (t1_ or t3_)."""
    return F.regexp_replace(column(c), "^t[13]_", "")


def normalize_post_id(c: str | Column) -> Column:
    return F.lower(strip_fullname(F.trim(F.coalesce(column(c), F.lit("")))))


def to_fullname(c: str | Column, kind: str = "t3") -> Column:
    """The id with its kind, which it keeps if it has one."""
    return F.when(column(c).rlike("^t[13]_"), column(c)).otherwise(F.concat(F.lit(f"{kind}_"), column(c)))


def after_cursor(c: str | Column) -> Column:
    """The paging cursor after a post: base64 of its fullname."""
    return F.base64(F.concat(F.lit("t3_"), strip_fullname(c)).cast("binary"))


def truncate(c: str | Column, limit: int) -> Column:
    """Stripped; longer than limit characters ends in three dots; limit 0 is none."""
    text = F.regexp_replace(F.coalesce(column(c), F.lit("")), f"^{BLANK}+|{BLANK}+$", "")
    if not limit:
        return text
    return F.when(F.length(text) > limit, F.concat(F.regexp_replace(F.substring(text, 1, limit), f"{BLANK}+$", ""), F.lit("..."))).otherwise(text)


def is_gone(c: str | Column) -> Column:
    return F.lower(clean_text(c)).isin(*GONE)


def first_present(c: str | Column, *paths: str) -> Column:
    """The first of several paths in a JSON text that is not null; 0, false and "" are values."""
    return F.coalesce(*[F.get_json_object(column(c), f"$.{p}") for p in paths])


def fetch_outcome(status: str | Column, body: str | Column) -> Column:
    """How a landed response is treated: ok, retry or failed."""
    status = column(status)
    blocked = F.lower(F.coalesce(column(body), F.lit(""))).rlike("blocked by network security|too many requests")
    return F.when((status == 429) | (status >= 500) | blocked, "retry").when(status.isin(401, 403, 404), "failed").otherwise("ok")
