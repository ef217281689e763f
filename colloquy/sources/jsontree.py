"""Nested reply trees in JSON to rows, one page or many."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import exploded

# Where the parts of a reply tree may stand, in order of preference.
ID_PATHS, ITEMS_PATHS, PAGE_PATHS = ("id", "data.id", "comment.id"), ("replies.items", "replies", "data.replies.items"), ("replies.page", "data.replies.page")


def dig(value, path: str):
    """The value at a dotted path, or None where anything on the way is no object."""
    for part in path.split("."):
        value = value.get(part) if isinstance(value, dict) else None
    return value


def first_match(value, paths: tuple[str, ...]):
    return next((x for p in paths if (x := dig(value, p)) is not None), None)


def walk(items, depth: int):
    """(item, depth) in pre-order, without recursion."""
    stack = [(i, depth) for i in reversed(items if isinstance(items, list) else [])]
    while stack:
        item, d = stack.pop()
        yield item, d
        replies = first_match(item, ITEMS_PATHS)
        stack += [(r, d + 1) for r in reversed(replies if isinstance(replies, list) else [])]


def page_of(payload: str | None) -> dict:
    """A landed page; what is no JSON object counts as an empty one, and faults() names it."""
    import json

    try:
        page = json.loads(payload or "{}")
    except ValueError:
        return {}
    return page if isinstance(page, dict) else {}


def faults(pages: DataFrame, payload: str = "payload") -> DataFrame:
    """pages whose payload is neither blank nor a JSON object, with a column error."""
    text = F.trim(F.coalesce(payload, F.lit("")))
    reason = F.when(F.try_parse_json(text).isNull(), "invalid JSON").otherwise("not an object")
    return pages.filter((text != "") & F.json_object_keys(text).isNull()).withColumn("error", reason)


def _own(item) -> str:
    import json

    return json.dumps({k: v for k, v in item.items() if k != "replies"} if isinstance(item, dict) else {}, ensure_ascii=False)


def flatten(pages: DataFrame, keep: list[str], payload: str = "payload", base_depth: str | None = None) -> DataFrame:
    """keep columns, comment_id, depth, seq (pre-order place) and item of every comment of a landed page {comments: [...]}."""

    def rows(text, base=0):
        found = walk(page_of(text).get("comments"), int(base or 0))
        return [(None if (i := first_match(item, ID_PATHS)) is None else str(i), depth, n, _own(item)) for n, (item, depth) in enumerate(found)]

    return exploded(pages, keep, [payload, base_depth] if base_depth else [payload], rows, "comment_id string, depth int, seq long, item string")


def cursors(pages: DataFrame, keep: list[str], payload: str = "payload", base_depth: str | None = None) -> DataFrame:
    """keep columns, next cursor, its depth and order: replies' cursors one level deeper, the page's own at its depth, last."""

    def following(page, depth):
        return [(str(page["nextCursor"]), depth)] if isinstance(page, dict) and page.get("hasMore") and page.get("nextCursor") else []

    def after(items, depth):
        """Cursors in the order in which a depth-first walk leaves the comments."""
        stack, out = [(i, depth, False) for i in reversed(items if isinstance(items, list) else [])], []
        while stack:
            item, d, left = stack.pop()
            if left:
                out += following(first_match(item, PAGE_PATHS), d + 1)
                continue
            stack.append((item, d, True))
            replies = first_match(item, ITEMS_PATHS)
            stack += [(r, d + 1, False) for r in reversed(replies if isinstance(replies, list) else [])]
        return out

    def rows(text, base=0):
        page, depth = page_of(text), int(base or 0)
        return [(c, d, n) for n, (c, d) in enumerate(after(page.get("comments"), depth) + following(page.get("page"), depth))]

    return exploded(pages, keep, [payload, base_depth] if base_depth else [payload], rows, "next_cursor string, next_depth int, n long")


def assemble(pages: DataFrame, thread: str = "thread_id", cursor: str = "cursor", max_comments: int = 0, max_pages: int = 0) -> DataFrame:
    """Comments of whole threads from landed pages (thread, cursor, payload; the first page has a null cursor).

    Pages are reached breadth-first, one join a level; comments are numbered by
    (place of the page, place on it), the first of an id counts, then caps apply.
    truncated: a cap was hit, a cursor leads to a page that has not landed, a page
    cannot be read, or cursors lead in a circle. Payloads are joined last, so that
    no window or sort carries them.
    """
    from ..session import cut

    landed = pages.select(F.col(thread).alias("t"), F.col(cursor).alias("c"), "payload")
    # a path over cursors that does not repeat a page is no longer than the thread's pages; longer ones go round in circles
    longest = landed.groupBy("t").count().agg(F.max("count")).first()[0] or 0
    level = landed.filter("c is null").select("t", F.lit("").alias("c"), F.lit(0).alias("d"), F.lit("").alias("place"), "payload")
    places, missing, steps_left = level.drop("payload"), faults(landed).select("t").distinct(), min(longest, max_pages or longest)
    while True:
        links = cursors(level, ["t", "c", "place"], base_depth="d")
        order = F.concat_ws("/", "place", F.lpad(F.col("n").cast("string"), 9, "0"))
        links = links.select("t", F.col("next_cursor").alias("c"), F.col("next_depth").alias("d"), order.alias("place"))
        # a cursor counts once a depth, in its first place
        links = links.groupBy("t", "c", "d").agg(F.min("place").alias("place")).join(places.select("t", "c", "d"), ["t", "c", "d"], "left_anti")
        found = cut(links.join(landed, ["t", "c"], "left").select("t", "c", "d", "place", "payload"))
        missing = missing.unionByName(found.filter("payload is null").select("t").distinct())
        level = found.filter("payload is not null")
        steps_left -= 1
        if level.isEmpty():
            break
        if steps_left <= 0:
            missing = missing.unionByName(level.select("t").distinct())
            break
        places = places.unionByName(level.drop("payload"))
    # breadth first: fewer steps from the first page come first
    steps = F.size(F.split("place", "/"))
    ranked = places.withColumn("page_no", F.row_number().over(Window.partitionBy("t").orderBy(steps, "place")))
    total = ranked.groupBy("t").agg(F.max("page_no").alias("pages"))
    if max_pages:
        ranked = ranked.filter(F.col("page_no") <= max_pages)
    known = landed.withColumn("c", F.coalesce("c", F.lit("")))
    rows = flatten(ranked.join(known, ["t", "c"]), ["t", "page_no"], base_depth="d").filter("comment_id is not null")
    # of an id's places the first counts
    first = rows.groupBy("t", "comment_id").agg(F.min(F.struct("page_no", "seq", "depth", "item")).alias("r")).select("t", "comment_id", "r.*")
    visits = first.select("t", "comment_id", F.row_number().over(Window.partitionBy("t").orderBy("page_no", "seq")).alias("visit"))
    counts = visits.groupBy("t").agg(F.max("visit").alias("collected"))
    if max_comments:
        visits = visits.filter(F.col("visit") <= max_comments)
    capped = (F.lit(bool(max_pages)) & (F.col("pages") > max_pages)) | (F.lit(bool(max_comments)) & (F.col("collected") > max_comments)) | F.col("gone")
    flags = total.join(counts, "t").join(missing.distinct().withColumn("gone", F.lit(True)), "t", "left").fillna(False, ["gone"]).select("t", capped.alias("truncated"))
    out = first.select("t", "comment_id", "depth", "item").join(visits, ["t", "comment_id"]).join(flags, "t")
    return out.select(F.col("t").alias(thread), "comment_id", "depth", "visit", "item", "truncated")
