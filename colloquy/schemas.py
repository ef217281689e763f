"""Column lists of the tables that flow between stages. Order is part of the contract of every sink."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, COUNT, WHOLE, REAL, FLAG = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in columns.items()])


COMMENT = _schema(
    comment_id=TEXT, thread_id=TEXT, thread_title=TEXT, thread_body=TEXT, subreddit=TEXT, intake_mode=TEXT, matched_keyword=TEXT, parent_id=TEXT, root_comment_id=TEXT, ancestor_ids=TEXT,
    parent_body=TEXT, context_text=TEXT, author=TEXT, body=TEXT, score=COUNT, depth=COUNT, created_utc=REAL, created_iso=TEXT, permalink=TEXT, thread_permalink=TEXT, fetched_at=TEXT,
)
#: The shorter export has no thread body and no rebuilt context.
SHORT_COMMENT = T.StructType([f for f in COMMENT.fields if f.name not in {"thread_body", "root_comment_id", "ancestor_ids", "parent_body", "context_text"}])
POST = _schema(
    post_id=TEXT, title=TEXT, subreddit=TEXT, intake_mode=TEXT, matched_keyword=TEXT, author=TEXT, body=TEXT, score=COUNT, num_comments=COUNT, fetched_comment_count=COUNT, created_utc=REAL,
    created_iso=TEXT, permalink=TEXT, fetched_at=TEXT,
)
CANDIDATE = T.StructType([*[f for f in POST.fields if f.name not in {"fetched_comment_count", "fetched_at"}], T.StructField("is_stickied", FLAG)])
FAILED_POST = _schema(post_id=TEXT, title=TEXT, permalink=TEXT, attempt=COUNT, error=TEXT, failed_at=TEXT)
DISCOVERED = _schema(post_id=TEXT, subreddit=TEXT, source_type=TEXT, matched_keyword=TEXT, title=TEXT, score=TEXT, num_comments=TEXT, created_utc=TEXT, created_iso=TEXT, permalink=TEXT)
STATE_COMMENT = _schema(comment_id=TEXT, thread_id=TEXT, subreddit=TEXT, parent_id=TEXT, root_comment_id=TEXT, depth=COUNT, first_seen_at=TEXT, last_seen_at=TEXT)
STATE_POST = _schema(
    post_id=TEXT, subreddit=TEXT, source_type=TEXT, matched_keyword=TEXT, title=TEXT, permalink=TEXT, reported_comment_count=COUNT, fetched_comment_count=COUNT, was_truncated=FLAG,
    first_seen_at=TEXT, last_scraped_at=TEXT,
)
RUN_EVENT = _schema(run_id=TEXT, seq=WHOLE, status=TEXT, post_count=COUNT, new_comment_count=COUNT, at=TEXT)
REQUEST = T.StructType([T.StructField("custom_id", TEXT), T.StructField("user_content", TEXT), T.StructField("comment_ids", T.ArrayType(TEXT))])
CLASSIFICATION = _schema(comment_id=TEXT, relevance_tag=TEXT, icp_likelihood=TEXT, confidence=TEXT, rationale=TEXT)


def names(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
