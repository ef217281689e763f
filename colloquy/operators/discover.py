"""Discovery: filters, keyword matching, merging of candidates, caps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as U
from ..functions.text import clean_text, fold, is_gone, is_title, normalize_for_match, normalize_post_id, parse_created, parse_int, strip_fullname
from ..session import cut


def recent(created: str | Column, cutoff: float | Column | None) -> Column:
    """Unknown dates stay, dates at the cutoff stay; no cutoff keeps all."""
    created = F.col(created) if isinstance(created, str) else created
    return F.lit(True) if cutoff is None else created.isNull() | (created == 0) | (created >= cutoff)


def cutoff(now: float, days: int, zero_is_unlimited: bool) -> float | None:
    """Zero days are no limit in one export and a limit of now in the other."""
    return None if zero_is_unlimited and not days else now - 86400 * max(days, 0)


def at_least(count: str, threshold: int) -> Column:
    return F.coalesce(F.col(count), F.lit(0)) >= threshold


def not_stickied(flag: str = "is_stickied", skip: bool = True) -> Column:
    return ~F.coalesce(F.col(flag), F.lit(False)) if skip else F.lit(True)


def same_community(name: str, wanted: str | Column) -> Column:
    """Case-insensitive; an empty wanted name matches all."""
    wanted = F.lit(wanted) if isinstance(wanted, str) else wanted
    return (wanted == "") | (F.lower(name) == F.lower(wanted))


def without_gone(df: DataFrame, body: str = "body", include: bool = False) -> DataFrame:
    """Drops deleted bodies, before any parent is inferred."""
    return df if include else df.filter(~is_gone(body))


def title_of(*values: str) -> Column:
    """The first text that is neither a counter nor a control's label."""
    return F.coalesce(*[F.when(is_title(clean_text(v)), clean_text(v)) for v in values], F.lit(""))


def flatten_keywords(categories: dict[str, list[str]], strip: bool = True, limit: int = 0) -> list[str]:
    """Terms of all categories in order; stripped, non-blank and each once, unless strip is off."""
    terms = [t for group in categories.values() for t in group or []]
    if strip:
        terms = list(dict.fromkeys(t.strip() for t in map(str, terms) if t.strip()))
    return terms[:limit] if limit else terms


#: Beyond so many keywords they are looked for in one pass over a text, not one by one in the plan.
KEYWORDS_IN_PLAN = 200


def match_keywords(posts: DataFrame, keywords: list[str], text: str = "title") -> DataFrame:
    """One row for each post and keyword that its text contains, accents and case aside, with kw_seq.

    An empty keyword matches all. Posts are normalised once. A short keyword list
    travels inside the plan; a long one goes to the tasks as an automaton.
    """
    folded = [fold(k) for k in keywords]
    if len(keywords) <= KEYWORDS_IN_PLAN:
        hits = F.array_compact(F.array(*[F.when(F.col("__text").contains(f), F.struct(F.lit(i).alias("kw_seq"), F.lit(k).alias("keyword"))) for i, (f, k) in enumerate(zip(folded, keywords))]))
    else:
        hits = F.transform(_found_places(folded)(F.col("__text")), lambda i: F.struct(i.alias("kw_seq"), F.element_at(F.array(*map(F.lit, keywords)), i + 1).alias("keyword")))
    return posts.withColumn("__text", normalize_for_match(text)).withColumn("__hit", F.explode(hits)).select(*posts.columns, "__hit.kw_seq", "__hit.keyword")


def _found_places(folded: list[str]):
    """A function from texts to the places, in the list, of the keywords that they contain; texts go to Python by the hundred."""

    made: list = []  # filled once in every task

    def finder():
        always = [i for i, f in enumerate(folded) if not f]
        same: dict[str, list[int]] = {}
        for i, f in enumerate(folded):
            if f:
                same.setdefault(f, []).append(i)
        try:
            import ahocorasick
        except ImportError:
            return lambda t: sorted(always + [i for f, at in same.items() if f in t for i in at])
        automaton = ahocorasick.Automaton()
        for f, at in same.items():
            automaton.add_word(f, at)
        automaton.make_automaton()
        return lambda t: sorted({*always, *(i for _, at in automaton.iter(t) for i in at)})

    def found(text: str) -> list[int]:
        if not made:
            made.append(finder())
        return made[0](text)

    return F.udf(found, "array<int>", useArrow=False)


def literal_hits(results: DataFrame, title: str = "title", term: str = "term") -> DataFrame:
    """Search results whose title contains the term that they were found by, accents and case aside."""
    return results.filter(F.contains(normalize_for_match(title), normalize_for_match(term)))


def keywords_in_order(hits: DataFrame, key: str, seq: str = "kw_seq", word: str = "keyword") -> DataFrame:
    """key and matched_keyword: distinct keywords in order of their first sight, joined by "; "."""
    first = hits.groupBy(key, word).agg(F.min(seq).alias("s"))
    return first.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", word))), lambda x: x[word]), "; ").alias("matched_keyword"))


def keywords_sorted(hits: DataFrame, key: str, word: str = "keyword") -> DataFrame:
    """key and matched_keyword: distinct keywords in code-point order, joined by "; "."""
    return hits.select(key, word).distinct().groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(word)), "; ").alias("matched_keyword"))


def keyword_first(hits: DataFrame, key: str, seq: str = "kw_seq", word: str = "keyword") -> DataFrame:
    return hits.groupBy(key).agg(F.min_by(word, seq).alias("matched_keyword"))


def merge_richest(rows: DataFrame, key: str = "post_id", seq: str = "seq") -> DataFrame:
    """One row per key from several sightings: earliest longest title, first non-blank author and date, most comments, any pin."""
    return rows.groupBy(key).agg(
        F.max_by("title", F.struct(F.length("title"), -F.col(seq))).alias("title"),
        F.min_by("author", F.when(F.coalesce("author", F.lit("")) != "", F.col(seq))).alias("author"),
        F.min_by("created_utc", F.when(F.coalesce("created_utc", F.lit(0.0)) != 0, F.col(seq))).alias("created_utc"),
        F.max("num_comments").alias("num_comments"),
        F.bool_or("is_stickied").alias("is_stickied"),
        F.min(seq).alias(seq),
    )


def keep_first(df: DataFrame, key: str | list[str], seq: str) -> DataFrame:
    keys = [key] if isinstance(key, str) else key
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(seq))).filter("__n = 1").drop("__n")


def keep_last(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key, at the place of its first."""
    rest = [c for c in df.columns if c not in (key, seq)]
    last = df.groupBy(key).agg(F.max_by(F.struct(*rest), seq).alias("__row"), F.min(seq).alias(seq))
    return last.select(key, seq, *[F.col("__row")[c].alias(c) for c in rest])


def new_only(candidates: DataFrame, known: DataFrame, key: str = "post_id", normalized: bool = False) -> DataFrame:
    """Candidates whose key is not known; keys may be compared without kind prefix and case."""
    make = normalize_post_id if normalized else F.col
    known = known.select(make(key).alias("__known")).distinct()
    return candidates.join(known, make(key) == F.col("__known"), "left_anti")


def capped(df: DataFrame, by: str, order: list, most: int) -> DataFrame:
    """The first `most` rows of each group; 0 keeps all. Caps come after deduplication."""
    if not most:
        return df
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("__n") <= most).drop("__n")


def new_capped(candidates: DataFrame, known: DataFrame, key: str, by: str, order: list, most: int, normalized: bool = False) -> DataFrame:
    return capped(new_only(candidates, known, key, normalized), by, order, most)


def route(threshold: int, count: str = "num_comments", mode: str = "intake_mode") -> Column:
    """Small known threads take the cheap way, repairs and unknown counts the full one."""
    cheap = (F.col(mode) != "repair") & F.lit(threshold != 0) & F.col(count).isNotNull() & (F.col(count) < threshold)
    return F.when(cheap, "cheap").otherwise("full")


def reroute(route: str | Column, fetched: str | Column, reported: str | Column) -> Column:
    """The cheap way that brought nothing, though comments are reported, is given up for the full one."""
    route, fetched, reported = (F.col(c) if isinstance(c, str) else c for c in (route, fetched, reported))
    return F.when((route == "cheap") & (F.coalesce(fetched, F.lit(0)) == 0) & (F.coalesce(reported, F.lit(0)) > 0), "full").otherwise(route)


def stop_pages(rows: DataFrame, by: str, page: str, old: Column, last_counts: bool = True) -> DataFrame:
    """Rows up to the first page with an old row, that page included or not; a null source is one like others."""
    stop = rows.groupBy(F.col(by).alias("__by")).agg(F.min(F.when(old, F.col(page))).alias("__stop"))
    seen = F.col("__stop").isNull() | ((F.col(page) <= F.col("__stop")) if last_counts else (F.col(page) < F.col("__stop")))
    return rows.join(stop, F.col("__by").eqNullSafe(F.col(by))).filter(seen).drop("__by", "__stop")


def walk_listing(rows: DataFrame, cutoff: float | None, max_pages: int = 0, max_posts: int = 0, stop_when_old: bool = True, skip_stickied: bool = True, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """Candidates that a walk over the pages of a listing collects, each once, from landed rows (by, page_no from 1, seq on the page, post_id, created_utc, is_stickied, ...).

    A walk ends before a page that has not landed or has no row, and, if asked for,
    at the first page without a recent row; stickied rows are skipped but count as
    recent. The cap counts what was collected.
    """
    keys = list(by)
    fresh = recent("created_utc", cutoff)
    pages = rows.groupBy(*keys, "page_no").agg(F.bool_or(fresh).alias("__recent"))
    pages = pages.withColumn("__place", F.row_number().over(Window.partitionBy(*keys).orderBy("page_no"))).filter(F.col("__place") == F.col("page_no"))
    if max_pages:
        pages = pages.filter(F.col("page_no") <= max_pages)
    if stop_when_old:
        end = F.min(F.when(~F.col("__recent"), F.col("page_no"))).over(Window.partitionBy(*keys))
        pages = pages.withColumn("__end", end).filter(F.col("__end").isNull() | (F.col("page_no") <= F.col("__end")))
    kept = rows.join(pages.select(*keys, "page_no"), [*keys, "page_no"], "left_semi").filter(fresh)
    kept = keep_first(kept.filter(not_stickied(skip=skip_stickied)).withColumn("__order", F.struct("page_no", "seq")), [*keys, "post_id"], "__order")
    if max_posts:
        kept = kept.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy("__order"))).filter(F.col("__n") <= max_posts).drop("__n")
    return kept.drop("__order")


def walk_feed(rows: DataFrame, cutoff: float | None, max_pages: int = 0, max_posts: int = 0, by: str = "source") -> DataFrame:
    """As walk_listing() for the paid feed: it ends after the first page that holds an old row or no new id."""
    first = Window.partitionBy(by, "post_id").orderBy("page_no", "seq")
    fresh = recent("created_utc", cutoff)
    seen = rows.filter(F.coalesce("post_id", F.lit("")) != "").withColumn("__new", fresh & (F.row_number().over(first.partitionBy(by, "post_id", fresh)) == 1))
    pages = seen.groupBy(by, "page_no").agg(F.bool_or(~fresh).alias("__old"), F.bool_or("__new").alias("__any"))
    stop = pages.groupBy(by).agg(F.min(F.when(F.col("__old") | ~F.col("__any"), F.col("page_no"))).alias("__stop"))
    kept = seen.join(stop, by).filter(F.col("__new") & (F.col("__stop").isNull() | (F.col("page_no") <= F.col("__stop"))))
    if max_pages:
        kept = kept.filter(F.col("page_no") <= max_pages)
    return capped(kept.drop("__new", "__stop"), by, ["page_no", "seq"], max_posts)


def walk_searches(rows: DataFrame, cutoff: float | None, max_pages: int = 0, max_posts: int = 0, stop_when_old: bool = True, skip_stickied: bool = True) -> DataFrame:
    """Candidates of keyword searches (source, kw_seq, keyword, page_no, seq, post_id, ...): each post once, with its keywords in order."""
    found = walk_listing(rows, cutoff, max_pages, 0, stop_when_old, skip_stickied, ("source", "kw_seq")).withColumn("__order", F.struct("kw_seq", "page_no", "seq"))
    words = found.groupBy("source", "post_id").agg(F.array_sort(F.collect_set(F.struct("kw_seq", "keyword"))).alias("__w"))
    words = words.select("source", "post_id", F.array_join(F.array_distinct(F.transform("__w", lambda x: x["keyword"])), "; ").alias("matched_keyword"))
    kept = keep_first(found, ["source", "post_id"], "__order").drop("matched_keyword", "keyword", "kw_seq").join(words, ["source", "post_id"])
    return capped(kept, "source", ["__order"], max_posts).drop("__order")


def merge_sources(rows: DataFrame, key: str = "post_id", order: str = "source_no") -> DataFrame:
    """Each post once, from its first source; keywords of a post that several sources bring are united and sorted."""
    terms = F.filter(F.transform(F.split(F.coalesce("matched_keyword", F.lit("")), ";"), lambda x: F.trim(x)), lambda x: x != "")
    united = rows.groupBy(key).agg(F.count("*").alias("__n"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list(terms)))), "; ").alias("__terms"))
    kept = keep_first(rows, key, order).join(united, key)
    return kept.withColumn("matched_keyword", F.when(F.col("__n") > 1, F.col("__terms")).otherwise(F.col("matched_keyword"))).drop("__n", "__terms")


def by_type(kind: str | Column, skip_unknown: bool) -> Column:
    """How a source is walked: full_scrape or keyword_search; one export skips other types (null), the other takes them for the first."""
    kind = F.col(kind) if isinstance(kind, str) else kind
    return F.when(kind == "keyword_search", "keyword_search").when((kind == "full_scrape") | F.lit(not skip_unknown), "full_scrape")


def link_candidates(links: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    """Candidates from links of a live listing (href, post_id, card_title, aria_label, title_attr, text, author, created, comment_count, stickied, card_text, community, seq): links to one post are merged."""
    href = U.modern_url("href")
    name, found = F.regexp_extract(href, U.POST_PATH, 1), F.regexp_extract(href, U.POST_PATH, 2)
    card = F.lower(clean_text("card_text"))
    pinned = ~F.lower(F.trim(F.coalesce("stickied", F.lit("")))).isin("", "0", "false", "no", "none") | card.contains("pinned by moderators") | card.contains("stickied post")
    rows = links.filter(href.rlike(U.POST_PATH) & ((F.coalesce("community", F.lit("")) == "") | (F.lower(name) == F.lower("community"))))
    given = strip_fullname(F.coalesce("post_id", F.lit("")))
    rows = rows.select(
        *by, F.when(given != "", given).otherwise(found).alias("post_id"), title_of("card_title", "aria_label", "title_attr", "text").alias("title"), name.alias("subreddit"),
        F.regexp_replace(clean_text("author"), "^u/", "").alias("author"), parse_int("comment_count").alias("num_comments"), parse_created("created").alias("created_utc"), href.alias("permalink"), pinned.alias("is_stickied"), "seq",
    )
    whole = rows.withColumn("__key", F.struct(*by, "post_id"))
    merged = merge_richest(whole, "__key").select("__key.*", "title", F.coalesce("author", F.lit("")).alias("author"), "created_utc", "num_comments", "is_stickied", "seq")
    return merged.join(rows.select(*by, "post_id", "seq", "subreddit", "permalink"), [*by, "post_id", "seq"])


def merge_live(parsed: DataFrame, live: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows of a parsed page and of its live form by key: the longer title, missing authors and dates filled in, the larger count."""
    a, b = parsed.select(F.col(key), F.struct(*parsed.columns).alias("p")), live.select(F.col(key), F.struct(*parsed.columns).alias("l"))
    rest = [c for c in parsed.columns if c not in (key, "title", "author", "created_utc", "created_iso", "num_comments")]
    length = lambda x: F.length(F.coalesce(x, F.lit("")))
    fill = lambda c, blank: F.when(F.coalesce(F.col(f"p.{c}"), F.lit(blank)) != blank, F.col(f"p.{c}")).otherwise(F.coalesce(F.when(F.coalesce(F.col(f"l.{c}"), F.lit(blank)) != blank, F.col(f"l.{c}")), F.col(f"p.{c}"))).alias(c)
    made = {
        "title": F.when(F.col("p").isNull() | (length(F.col("l.title")) > length(F.col("p.title"))), F.col("l.title")).otherwise(F.col("p.title")).alias("title"),
        "author": fill("author", ""), "created_utc": fill("created_utc", 0.0), "num_comments": F.greatest(F.coalesce("p.num_comments", F.lit(0)), F.coalesce("l.num_comments", F.lit(0))).alias("num_comments"),
    }
    if "created_iso" in parsed.columns:
        made["created_iso"] = fill("created_iso", "")
    both = a.join(b, key, "full_outer")
    return both.select(*[F.col(key) if c == key else made[c] if c in made else F.when(F.col("p").isNotNull(), F.col(f"p.{c}")).otherwise(F.col(f"l.{c}")).alias(c) for c in parsed.columns if c == key or c in made or c in rest])


def page_over_candidate(candidates: DataFrame, pages: DataFrame, key: str = "post_id") -> DataFrame:
    """candidates with what their landed pages say (key, page_*) in place of their own values."""
    said = {c: f"page_{c}" for c in candidates.columns if c != key and f"page_{c}" in pages.columns}
    out = candidates.join(pages.select(key, *said.values()), key, "left")
    return out.select(*[F.coalesce(said[c], c).alias(c) if c in said else F.col(c) for c in candidates.columns])


def manual_candidates(targets: DataFrame, url: str = "url", mode: str = "manual") -> DataFrame:
    """Candidates from whole URLs of posts; id and community come from the URL, a URL without an id has an error."""
    link = U.old_url(url)
    found = F.regexp_extract(link, "/comments/+([^/]+)", 1)
    blank = {"title": "", "matched_keyword": "", "author": "", "body": "", "created_iso": ""}
    return targets.select(
        "*", found.alias("post_id"), U.community(link).alias("subreddit"), F.lit(mode).alias("intake_mode"), *[F.lit(v).alias(k) for k, v in blank.items()], F.lit(0).alias("score"), F.lit(0).alias("num_comments"),
        F.lit(None).cast("double").alias("created_utc"), link.alias("permalink"), F.when(found == "", F.concat(F.lit("no post id in "), F.coalesce(url, F.lit("")))).alias("error"),
    )


def newest_first(candidates: DataFrame, created: str = "created_utc", seq: str = "seq") -> DataFrame:
    """candidates with ordinal, from 1: latest first, unknown dates last, ties as they came; counted range by range, so that no task sorts all."""
    order = [F.coalesce(F.col(created), F.lit(0.0)).desc(), F.col(seq)]
    ranged = cut(candidates.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = ranged.groupBy("__part").agg(F.count("*").alias("n")).select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__start"))
    ranked = ranged.withColumn("__n", F.row_number().over(Window.partitionBy("__part").orderBy(*order))).join(F.broadcast(starts), "__part")
    return ranked.withColumn("ordinal", F.col("__start") + F.col("__n")).drop("__part", "__n", "__start")


def within_budget(rows: DataFrame, by: str, order: list, calls: str, total: int) -> DataFrame:
    """remaining (before the row) and granted calls of every row; a row without any left is skipped. 0 is no limit."""
    before = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    remaining = F.lit(total) - F.coalesce(F.sum(calls).over(before), F.lit(0)) if total else F.lit(None).cast("bigint")
    out = rows.withColumn("remaining", remaining)
    granted = F.col(calls) if not total else F.greatest(F.least(F.col(calls), F.col("remaining")), F.lit(0))
    return out.withColumn("granted", granted).filter(F.col("granted") > 0)


def output_order(created: str = "created_utc", depth: str = "depth", node: str = "comment_id") -> list[Column]:
    return [F.coalesce(F.col(created), F.lit(0)), F.col(depth), F.col(node)]


def seeded_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows without replacement in a shuffled order that the seed decides: that of the md5 of seed and key."""
    return df.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary")), key).limit(n)
