"""URL functions as Column expressions. The host is a parameter of those that write one."""

from __future__ import annotations

from urllib.parse import parse_qsl, quote_plus, urlencode, urlsplit, urlunsplit

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import column

# The site that landed pages and exports come from, and the hosts of its two layouts.
SITE = "reddit.com"
OLD_HOST, MODERN_HOST = f"old.{SITE}", f"www.{SITE}"
POST_PATH = "(?i)/r/([^/]+)/comments/([a-z0-9]+)"
LISTING_SORTS, SEARCH_SORTS = ("hot", "new", "rising", "controversial", "top"), ("relevance", "hot", "top", "new", "comments")


def absolute(c: str | Column, host: str = MODERN_HOST) -> Column:
    """Paths get scheme and host; whole URLs stay; blank is null."""
    text = F.trim(F.coalesce(column(c), F.lit("")))
    return F.when(text == "", F.lit(None)).when(text.rlike("^[a-zA-Z]+://"), text).otherwise(F.concat(F.lit(f"https://{host}"), F.when(text.startswith("/"), "").otherwise("/"), text))


def on_host(c: str | Column, host: str) -> Column:
    """The URL on another host of the site; other sites' URLs stay; blank is the host's root."""
    whole = F.coalesce(absolute(c, host), F.lit(f"https://{host}"))
    name = F.lower(F.regexp_extract(whole, "^[a-zA-Z]+://([^/?#:]*)", 1))
    return F.when(name.endswith(SITE), F.regexp_replace(whole, "^[a-zA-Z]+://[^/?#]*", f"https://{host}")).otherwise(whole)


def old_url(c: str | Column) -> Column:
    return on_host(c, OLD_HOST)


def modern_url(c: str | Column) -> Column:
    return on_host(c, MODERN_HOST)


def variants(c: str | Column) -> Column:
    """The URL itself and its forms on both hosts, each once."""
    return F.array_distinct(F.array(F.coalesce(absolute(c), F.lit("")), old_url(c), modern_url(c)))


def post_id(c: str | Column) -> Column:
    """The id after /comments/, or empty."""
    return F.regexp_extract(F.coalesce(column(c), F.lit("")), "(?i)/comments/([^/?#]+)", 1)


def community(c: str | Column) -> Column:
    """The name after /r/, or empty."""
    return F.regexp_extract(F.coalesce(column(c), F.lit("")), "(?i)/r/([^/?#]+)", 1)


def is_post_path(c: str | Column) -> Column:
    return F.coalesce(column(c), F.lit("")).rlike(POST_PATH)


def host_of(c: str | Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(column(c), F.lit("")), "^[a-zA-Z]+://([^/?#:]*)", 1))


def with_query(url: str, **params: str | int | None) -> str:
    """url with parameters set, or removed where None; repeated parameters collapse to the last."""
    parts = urlsplit(url)
    query = dict(parse_qsl(parts.query, keep_blank_values=True)) | {k: str(v) for k, v in params.items() if v is not None}
    return urlunsplit(parts._replace(query=urlencode({k: v for k, v in query.items() if not (k in params and params[k] is None)})))


def listing_url(community: str, sort: str = "new", period: str = "all") -> str:
    """The first page of a community's listing; an unknown sort is new, and only two sorts have a period."""
    sort = sort if sort in LISTING_SORTS else "new"
    more = {"t": period} if sort in ("top", "controversial") else {}
    return with_query(f"https://{OLD_HOST}/r/{quote_plus(community)}/{sort}/", limit=100, **more)


def search_url(community: str, term: str, sort: str = "new", period: str = "all") -> str:
    return with_query(f"https://{OLD_HOST}/r/{quote_plus(community)}/search", q=term, restrict_sr="on", sort=sort if sort in SEARCH_SORTS else "new", t=period, limit=100)


def thread_url(url: str, sort: str = "confidence") -> str:
    """The form in which pages of a thread are asked for and landed."""
    return with_query(url, limit=500, sort=sort, show="all")


def segment_after(c: str | Column, name: str) -> Column:
    """The path segment after one of that name, case aside, or empty."""
    return F.regexp_extract(F.coalesce(column(c), F.lit("")), f"(?i)^[^?#]*?/{name}/+([^/?#]+)", 1)


def repair_target(c: str | Column, keep_case: bool = False) -> Column:
    """The post id that a line of a repair list names, or null: a whole URL of a post, or an id with or without its kind.

    One export keeps the case of ids and knows the kind of posts only.
    """
    line = F.trim(F.coalesce(column(c), F.lit("")))
    found = F.when(line.rlike("^https?://"), segment_after(line, "comments")).otherwise(F.regexp_replace(line, "^t3_" if keep_case else "^t[13]_", ""))
    found = found if keep_case else F.lower(F.regexp_replace(found, "^t[13]_", ""))
    valid = F.when(line.rlike("^https?://"), found != "").otherwise(found.rlike("(?i)^[a-z0-9]+$"))
    return F.when(valid, found)
