"""Link discovery over tables of landing pages and responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdsift import rules as R
from holdsift.functions import html as H
from holdsift.functions import urls as U
from holdsift.operators.keys import keep_first
from holdsift.session import ship


def _matches(selector: Column, link: Column) -> Column:
    """Condition for ``a[href]``, ``a[href*='x']`` and ``a[download]``; other selectors match no link."""
    part = F.regexp_extract(selector, r"^a\[href\*=['\"]?(.*?)['\"]?\]$", 1)
    return (selector == "a[href]") | ((selector == "a[download]") & link["download"]) | (
        selector.startswith("a[href*=") & link["href"].contains(part))


def page_links(pages: DataFrame, page_url: str = "url", html: str = "html",
               file_types: Column | Sequence[str] | None = None, words: str = R.DOCUMENT_URL_WORDS,
               selectors: Column | Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """One row per document link: absolute URL, filename, type and the context around it.

    ``keep`` names page columns to carry along.  ``selectors``, one list or a column of them, narrow
    the links down; an empty or null list takes every link.  Links that fail the document test are
    dropped inside the array, before rows are multiplied.
    """
    ship(pages.sparkSession)
    base = F.col(page_url)
    wanted = selectors if isinstance(selectors, Column) else F.array(*(F.lit(s) for s in selectors)).cast("array<string>")
    wanted = F.coalesce(wanted, F.array().cast("array<string>"))
    staged = pages.withColumn("_parts", H.page_parts(F.col(html)))
    absolute = F.transform(
        F.filter(F.col("_parts.links"), lambda x: (F.size(wanted) == 0) | F.exists(wanted, lambda s: _matches(s, x))),
        lambda x: F.struct(U.resolve_url(base, x["href"]).alias("link_url"), x.alias("link")),
    )
    ok = F.filter(absolute, lambda x: U.is_document_url(x["link_url"], file_types, words))
    rows = staged.select(
        *[F.col(k) for k in keep],
        base.alias("page_url"),
        F.col("_parts.structure_hash").alias("page_structure_hash"),
        H.dropdowns(F.col(html)).alias("_drop"),
        F.explode(ok).alias("_x"),
    )
    url = F.col("_x.link_url")
    return rows.select(
        *[F.col(k) for k in keep], F.col("page_url"), F.col("_x.link.link_idx").alias("seq"), url.alias("url"),
        U.filename_from_url(url).alias("filename"), U.file_type(url).alias("file_type"),
        F.lit("DISCOVERED").alias("status"), F.col("page_structure_hash"),
        F.struct(
            *[F.col(f"_x.link.{k}").alias(k) for k in
              ("link_text", "parent_text", "grandparent_text", "title", "aria_label", "data_attrs")],
            F.col("_drop").alias("active_dropdowns"),
        ).alias("page_context"),
    )


def select_responses(responses: DataFrame, patterns: Column | Sequence[str] = (), url: str = "url",
                     content_type: str = "content_type") -> DataFrame:
    """Responses that carry a document or hit an API pattern."""
    return responses.filter(U.is_kept_response(F.col(url), F.col(content_type), patterns))


def response_documents(responses: DataFrame, links: DataFrame | None = None,
                       patterns: Column | Sequence[str] = (), group: Sequence[str] = ("source_key",)) -> DataFrame:
    """Kept responses, then page links, first row per exact URL within ``group``.

    ``responses``: group, seq, url, content_type; ``links``: group, seq, url and, if it is to be kept, page_context
    (null for a response, which stands on no page).
    The first row wins by (responses before links, seq), kept with a partial
    aggregate, so a source with a third of all rows does not land in one task.
    """
    kept = select_responses(responses, patterns).select(
        *group, F.lit(0).alias("origin"), "seq", "url", F.coalesce("content_type", F.lit("")).alias("content_type")
    )
    if links is not None:
        context = [c for c in links.columns if c == "page_context"]
        kept = kept.unionByName(
            links.select(*group, F.lit(1).alias("origin"), "seq", "url", F.lit("").alias("content_type"), *context),
            allowMissingColumns=True,
        )
    first = keep_first(kept, [*group, "url"], ["origin", "seq"])
    return first.withColumns(
        {
            "filename": U.filename_from_url(F.col("url")),
            "file_type": U.file_type(F.col("url"), F.col("content_type")),
            "status": F.lit("DISCOVERED"),
        }
    )


def enrich(docs: DataFrame, run_id: str | None = None, source_key: str = "source_key") -> DataFrame:
    """Fingerprint, missing filename and type, deterministic id and run id."""
    url = F.col("url")
    cols = {
        "url_fingerprint": U.url_fingerprint(url),
        "filename": F.coalesce(F.col("filename"), U.filename_from_url(url)),
        "file_type": F.coalesce(F.col("file_type"), U.file_type(url)),
    }
    if run_id is not None:
        cols["pipeline_run_id"] = F.lit(run_id)
    return docs.withColumns(cols).withColumn(
        "doc_id", F.sha2(F.concat_ws("|", F.col(source_key).cast("string"), F.col("url_fingerprint")), 256)
    )


def page_structures(pages: DataFrame) -> DataFrame:
    """(source_key, page_structure_hash): the structure of a source is that of its first page, by url.

    Urls alone are read first, so that only such pages are read for their structure.
    """
    firsts = pages.groupBy("source_key").agg(F.min("url").alias("_url"))
    same = (pages["source_key"] == firsts["source_key"]) & (pages["url"] == firsts["_url"])
    return pages.join(firsts, same, "left_semi").groupBy("source_key").agg(
        F.min(H.structure_hash(F.col("html"))).alias("page_structure_hash"))


def discover(pages: DataFrame, responses: DataFrame, sources: DataFrame, run_id: str | None = None) -> DataFrame:
    """Run each source's strategy: link extraction, or interception (responses plus link fallback).

    Links are those the source's selectors match; without selectors link extraction takes every link
    and interception none.

    ``pages``: source_key, url, html; ``responses``: source_key, seq, url, content_type.
    ``sources`` is the registry (a handful of rows per fund house; Spark decides on
    the join by its size).
    """
    reg = sources.select("source_key", "strategy", "file_types", "api_patterns", "download_selectors")
    by_link = pages.join(reg.filter(F.col("strategy") == "link_extraction"), "source_key")
    by_net = pages.join(reg.filter(F.col("strategy") != "link_extraction"), "source_key")
    take = lambda pages: page_links(
        pages, file_types=F.col("file_types"), selectors=F.col("download_selectors"), keep=["source_key"])
    plain, fallback = take(by_link), take(by_net.filter(F.size("download_selectors") > 0))
    caught = responses.join(reg.filter(F.col("strategy") != "link_extraction"), "source_key")
    net = response_documents(caught, fallback, F.col("api_patterns"))
    net = net.join(page_structures(by_net), "source_key", "left")
    cols = ["source_key", "url", "filename", "file_type", "status", "page_structure_hash", "page_context"]
    both = plain.select(*cols, F.lit("").alias("content_type")).unionByName(net.select(*cols, "content_type"))
    return enrich(both, run_id)
