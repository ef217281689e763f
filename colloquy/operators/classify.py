"""Classification requests and answers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import truncate
from ..session import cut

# The labels that a classification may carry besides the rubric's tags, and prices in dollars for a million tokens (in, out).
LIKELIHOODS, CONFIDENCES = ("1", "2A", "2B", "3", "4", "none"), ("high", "medium", "low")
PRICES = {"larger": (1.00, 5.00), "smaller": (0.50, 2.50)}


def chunk_by_thread(comments: DataFrame, most: int, thread: str = "thread_id", seq: str = "seq") -> DataFrame:
    """comments with chunk (number of its request) and place in it; at most `most` rows, never two threads.

    Threads count in order of their first row, rows in their own order.
    """
    if most < 1:
        raise ValueError("a request must hold one comment at least")
    within = Window.partitionBy(thread).orderBy(seq)
    rows = comments.withColumn("__n", F.row_number().over(within) - 1)
    threads = comments.groupBy(thread).agg(F.min(seq).alias("__first"), F.ceil(F.count("*") / F.lit(most)).alias("__chunks"))
    # requests before a thread: summed range by range of the threads' first rows, so that no task sorts all of them
    threads = cut(threads.repartitionByRange("__first").withColumn("__part", F.spark_partition_id()))
    sums = threads.groupBy("__part").agg(F.sum("__chunks").alias("s"))  # a row a partition
    before = sums.select("__part", F.coalesce(F.sum("s").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__base"))
    inner = Window.partitionBy("__part").orderBy("__first", thread).rowsBetween(Window.unboundedPreceding, -1)
    threads = threads.withColumn("__within", F.coalesce(F.sum("__chunks").over(inner), F.lit(0))).join(F.broadcast(before), "__part")
    starts = threads.select(thread, (F.col("__base") + F.col("__within")).alias("__start"))
    out = rows.join(starts, thread)
    return out.withColumn("chunk", F.col("__start") + F.floor(F.col("__n") / F.lit(most))).withColumn("place", F.col("__n") % most).drop("__n", "__start")


def comment_lines(limit: int = 400) -> Column:
    """One comment of a request: id and depth, its root and parent where it has them, and the whole body."""
    depth = F.coalesce(F.col("depth"), F.lit(0))
    context, parent = truncate("context_text", limit), truncate("parent_body", limit)
    return F.concat_ws(
        "\n",
        F.concat(F.lit("["), F.col("comment_id"), F.lit("] (depth "), depth.cast("string"), F.lit(")")),
        F.when((depth >= 2) & (context != ""), F.concat(F.lit("    Thread root: "), context)),
        F.when((depth >= 1) & (parent != ""), F.concat(F.lit("    Replying to: "), parent)),
        F.concat(F.lit("    Comment: "), F.coalesce("body", F.lit(""))),
    )


def render_requests(chunked: DataFrame, limit: int = 400, thread: str = "thread_id") -> DataFrame:
    """custom_id, user_content and comment_ids of every request; rows of a request are few by construction."""
    rows = chunked.withColumn("__lines", comment_lines(limit))
    one = F.struct("place", "comment_id", "__lines", "thread_title", "thread_body")
    packed = rows.groupBy("chunk", thread).agg(F.array_sort(F.collect_list(one)).alias("r"))
    body = truncate(F.col("r")[0]["thread_body"], limit)
    content = F.concat_ws(
        "\n",
        F.concat(F.lit("Thread: "), F.coalesce(F.col("r")[0]["thread_title"], F.lit(""))),
        F.when(body != "", F.concat(F.lit("Post body: "), body)),
        F.lit(""),
        F.lit("Comments:"),
        F.array_join(F.transform("r", lambda x: x["__lines"]), "\n"),
    )
    return packed.select(F.concat(F.lit("chunk_"), F.col("chunk").cast("string"), F.lit("_"), F.col(thread)).alias("custom_id"), content.alias("user_content"), F.transform("r", lambda x: x["comment_id"]).alias("comment_ids"))


def system_prompt(rubric: str) -> str:
    """Instructions for a classifier: the rubric and what each comment is to get."""
    return (
        "Classify every comment of the request by the rubric below.\n\n" + rubric.strip() + "\n\nA comment may come with its thread's title and body, the comment that it replies to and the start of "
        "its branch; read it in that light, but judge it alone.\nFor each comment return relevance_tag (a tag of the rubric or none), icp_likelihood "
        f"({', '.join(LIKELIHOODS)}), confidence ({', '.join(CONFIDENCES)}) and a rationale of one line under 25 words.\nAnswer for all comments in one call."
    )


def classify(requests: DataFrame, fn: Callable[[str, list[str]], tuple[list[dict], int, int]]) -> DataFrame:
    """Answers of a model function (content, ids) -> (classifications, input tokens, output tokens), one row a request.

    status is succeeded, or the name of the error that the function raised.
    """
    schema = "custom_id string, status string, input_tokens long, output_tokens long, classifications array<struct<comment_id:string,relevance_tag:string,icp_likelihood:string,confidence:string,rationale:string>>"
    fields = ("comment_id", "relevance_tag", "icp_likelihood", "confidence", "rationale")

    def run(batches: Iterator):
        import pandas as pd

        for batch in batches:
            rows = []
            for cid, content, ids in zip(batch["custom_id"], batch["user_content"], batch["comment_ids"]):
                try:
                    answers, n_in, n_out = fn(content, list(ids))
                    rows.append((cid, "succeeded", n_in, n_out, [{f: a.get(f) for f in fields} for a in answers]))
                except Exception as error:  # noqa: BLE001  a failed request is an outcome
                    rows.append((cid, type(error).__name__, 0, 0, []))
            yield pd.DataFrame(rows, columns=["custom_id", "status", "input_tokens", "output_tokens", "classifications"])

    return requests.mapInPandas(run, schema)


def stub_model(content: str, ids: list[str]) -> tuple[list[dict], int, int]:
    """A deterministic stand-in for a model: labels by the md5 of the id."""
    import hashlib

    pick = lambda i, n: int(hashlib.md5(i.encode()).hexdigest()[:8], 16) % n
    answers = [{"comment_id": i, "relevance_tag": "none", "icp_likelihood": LIKELIHOODS[pick(i, 6)], "confidence": CONFIDENCES[pick(i, 3)], "rationale": "stub"} for i in ids]
    return answers, len(content) // 4, 20 * len(ids)


#: A landed result of a batch.
RESULT = (
    "custom_id string, result struct<type:string,message:struct<usage:struct<input_tokens:bigint,output_tokens:bigint>,"
    "content:array<struct<type:string,input:struct<classifications:array<struct<comment_id:string,relevance_tag:string,icp_likelihood:string,confidence:string,rationale:string>>>>>>>"
)
NO_ANSWER = "no_tool_use_block"


def read_results(landed: DataFrame, payload: str = "payload") -> DataFrame:
    """Landed results (one JSON text each) as rows of classify(): the first answer block counts; a success without one is an error of its own, whose tokens were spent."""
    r = F.from_json(payload, RESULT)
    rows = landed.select(r.alias("r")).select("r.custom_id", "r.result.type", "r.result.message.usage", F.filter("r.result.message.content", lambda x: x["type"] == "tool_use").alias("blocks"))
    good = F.col("type") == "succeeded"
    answered = good & (F.coalesce(F.size("blocks"), F.lit(0)) > 0)
    status = F.when(answered, "succeeded").when(good, NO_ANSWER).otherwise(F.coalesce("type", F.lit("unreadable")))
    tokens = lambda c: F.coalesce(F.when(good, F.col(f"usage.{c}")), F.lit(0))
    answers = F.coalesce(F.when(answered, F.col("blocks")[0]["input"]["classifications"]), F.array())
    return rows.select("custom_id", status.alias("status"), tokens("input_tokens").alias("input_tokens"), tokens("output_tokens").alias("output_tokens"), answers.alias("classifications"))


def errors(results: DataFrame) -> DataFrame:
    """custom_id and error of every request that brought no answer."""
    return results.filter(F.col("status") != "succeeded").select("custom_id", F.col("status").alias("error"))


def usage(results: DataFrame) -> DataFrame:
    """One row: tokens of requests that were answered, with or without classifications, and the number of those that failed."""
    paid = F.col("status").isin("succeeded", NO_ANSWER)
    total = lambda c: F.coalesce(F.sum(F.when(paid, F.col(c))), F.lit(0))
    return results.agg(total("input_tokens").alias("input_tokens"), total("output_tokens").alias("output_tokens"), F.count_if(F.col("status") != "succeeded").alias("failed"))


def cost(tokens_in: str | Column, tokens_out: str | Column, model: str) -> Column:
    """Dollars at the model's prices, four decimals; an unknown model has none."""
    if model not in PRICES:
        return F.lit(None).cast("double")
    a, b = (F.col(c) if isinstance(c, str) else c for c in (tokens_in, tokens_out))
    return F.round(a / 1e6 * PRICES[model][0] + b / 1e6 * PRICES[model][1], 4)


def attach(comments: DataFrame, answers: DataFrame, seq: str | None = None, key: str = "comment_id") -> DataFrame:
    """comments with their answers; the last answer of a comment counts; without one the columns are empty."""
    columns = [c for c in answers.columns if c not in (key, seq)]
    if seq:
        answers = answers.groupBy(key).agg(F.max_by(F.struct(*columns), seq).alias("__a")).select(key, *[F.col("__a")[c].alias(c) for c in columns])
    out = comments.join(answers, key, "left")
    return out.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns})


def unclassified(classified: DataFrame, tag: str = "relevance_tag") -> DataFrame:
    return classified.filter(F.col(tag) == "")


def only_requested(comments: DataFrame, manifest: DataFrame, key: str = "comment_id") -> DataFrame:
    """Comments of the manifest's requests, where those are a sample of all."""
    ids = manifest.select(F.explode("comment_ids").alias("__id")).distinct()
    return comments.join(ids, F.col(key) == F.col("__id"), "left_semi")
