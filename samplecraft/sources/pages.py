"""Captured pages in the order of the links they carry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from samplecraft.session import written
from samplecraft.sources.web import next_link, page_number_key, page_text_key


def next_page(
    body: Column,
    link_key: str | None = None,
    host: str = "",
    cursor_key: str | None = None,
    page_key: str | None = None,
    template: str | None = None,
    limit: int = 0,
    limit_key: str | None = None,
    link_header: Column | None = None,
) -> Column:
    """Address of the page after this one; null if it names none.

    A link in the body (``link_key``, behind ``host``) comes first, then the cursor or page number under its key, put
    into ``template`` for ``${page}`` (with ``${limit}``, from the body's ``limit_key`` or else ``limit``), then the
    ``rel="next"`` link of the header.
    """
    found = []
    if link_key:
        found.append(page_text_key(body, link_key, host))
    if template and (cursor_key or page_key):
        marks = [c for k in (cursor_key, page_key) if k for c in (page_number_key(body, k).cast("string"), page_text_key(body, k))]
        size = F.coalesce(page_number_key(body, limit_key), F.lit(limit)) if limit_key else F.lit(limit)
        filled = F.replace(F.lit(template), F.lit("${page}"), F.coalesce(*marks))
        found.append(F.replace(filled, F.lit("${limit}"), size.cast("string")))
    if link_header is not None:
        found.append(next_link(link_header))
    if not found:
        raise ValueError("nothing to follow: name a link, a cursor or a page key with a template, or a header")
    return F.coalesce(*found)


def chain_pages(
    df: DataFrame,
    following: Column,
    first: Column,
    request: str = "request_id",
    page: str = "url",
    status: str = "status",
    payload_key: str | None = None,
    max_pages: int = 0,
    max_pages_key: str | None = None,
    body: str = "body",
    into: str = "page_no",
) -> DataFrame:
    """Pages of each request in the order of their links, from the page that ``first`` is true of, numbered from 1.

    ``following`` is the address of the next page. A page outside 2xx ends a chain without being kept, one whose
    ``payload_key`` holds an empty list or object ends it and is kept, as is the last of ``max_pages`` (or of the number
    under the first page's ``max_pages_key``). A chain also ends where a page was not captured, and before a page it
    has been at. Pages that no link leads to are not in the result, nor are requests without a first page. Of captures of one address the
    least by body counts.

    Only numbers of pages take part: after one pass over the bodies and one match of their addresses the pages 2^k links ahead are joined with themselves,
    and the pages reached so far with them, which doubles both; so a chain of a million links takes twenty rounds, and
    one request with most of the pages is spread like many.
    """
    text = F.col(body)
    good = F.coalesce(F.col(status).between(200, 299), F.lit(False))
    ends = text.rlike('"\\Q' + payload_key + r'\E"\s*:\s*(\[\s*\]|\{\s*\})') if payload_key else F.lit(False)
    limit = page_number_key(text, max_pages_key) if max_pages_key else F.lit(max_pages or None).cast("bigint")
    known = df.select(
        F.col(request).alias("r"),
        F.col(page).alias("p"),
        F.when(~F.coalesce(ends, F.lit(False)), following).alias("q"),
        F.coalesce(first, F.lit(False)).alias("first"),
        limit.alias("most"),
        F.xxhash64(body).alias("capture"),
        good.alias("good"),
    ).where("p IS NOT NULL AND r IS NOT NULL")
    facts = ["q", "first", "most", "capture", "good"]
    known = known.groupBy("r", "p").agg(F.min_by(F.struct(*facts), F.struct("capture", "good", "first", F.coalesce("q", F.lit("")))).alias("x"))
    # addresses are matched once; from here on a page is a number
    known = written(known.select("r", "p", "x.*").where("good").withColumn("page", F.monotonically_increasing_id()))

    pages = known.select("r", F.col("p").alias("q"), F.col("page").alias("to"))
    ahead = known.where("q IS NOT NULL AND p != q").select("r", "q", "page").join(pages, ["r", "q"]).select("page", "to")
    reached = known.where("first").groupBy("r").agg(F.min_by("page", "p").alias("page")).select("page", F.lit(1).cast("bigint").alias("n"))
    reached, count, step = written(reached), -1, 1
    while (now := reached.count()) != count:
        count = now
        ahead = written(ahead)
        more = reached.join(ahead, "page").select(F.col("to").alias("page"), (F.col("n") + step).alias("n"))
        reached = written(reached.unionByName(more).groupBy("page").agg(F.min("n").alias("n")))
        beyond = ahead.select(F.col("page").alias("to"), F.col("to").alias("far"))
        ahead = ahead.join(beyond, "to").select("page", F.col("far").alias("to"))
        step *= 2
    reached = reached.join(known.select("page", "r", "p", "capture", "most"), "page")
    if max_pages or max_pages_key:
        most = reached.where("n = 1").select("r", F.col("most").alias("limit"))
        reached = reached.join(most, "r").where("limit IS NULL OR n <= limit").drop("limit")
    place = reached.select(F.col("r").alias("_r"), F.col("p").alias("_p"), F.col("capture").alias("_c"), F.col("n").alias(into))
    kept = df.join(place, (F.col(request) == F.col("_r")) & (F.col(page) == F.col("_p")) & (F.xxhash64(body) == F.col("_c")) & good)
    # The join's keys, so nothing is shuffled again for rows that repeat.
    return kept.dropDuplicates(["_r", "_p", "_c"]).drop("_r", "_p", "_c")
