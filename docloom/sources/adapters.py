"""Adapters (L1, L2): how one kind of source plans requests and turns archived responses into rows.

An adapter does no I/O. ``plan`` gives first requests, ``plan_recheck`` targets for resources that are due, ``parse``
turns a frame of archived responses (request_url, body) into candidate rows, ``next_requests`` gives the pages that
follow, and ``build`` turns candidates into rows that can be delivered. Options are checked before an adapter is made.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.functions.text import clean_value, value_error
from docloom.operators.containers import anchors
from docloom.operators.webpages import list_pages
from docloom.sources.config import ConfigError, SourceConfig


class Adapter(Protocol):
    contract: str

    @staticmethod
    def validate_options(options: dict) -> None: ...

    def plan(self, config: SourceConfig) -> list[str]: ...

    def plan_recheck(self, resources: DataFrame) -> DataFrame: ...

    def parse(self, responses: DataFrame) -> DataFrame: ...

    def next_requests(self, responses: DataFrame, depth: int) -> DataFrame: ...

    def build(self, candidates: DataFrame) -> DataFrame: ...


class Base:
    """What adapters share; ``options`` names the options that one takes, with their kinds."""

    contract = "docloom.base.v1"
    options: dict[str, type] = {}

    @classmethod
    def validate_options(cls, options: dict) -> None:
        if set(options) - set(cls.options) or any(not isinstance(v, cls.options[k]) or isinstance(v, bool) for k, v in options.items()):
            raise ConfigError("invalid_adapter_options")

    def plan(self, config: SourceConfig) -> list[str]:
        return config.entry_urls

    def plan_recheck(self, resources: DataFrame) -> DataFrame:
        """Targets of due resources: namespace, external_key, public_url, recheck_url -> identity, request_url, role, error.

        The identity is told up front, so a recheck that fails is still a delivery of its resource.
        """
        identity = F.struct("namespace", "external_key", "public_url", "recheck_url").alias("identity")
        error = F.when(F.coalesce("recheck_url", F.lit("")) == "", "recheck_locator_unsupported").alias("error")
        return resources.select(identity, F.col("recheck_url").alias("request_url"), F.lit("detail").alias("role"), error)

    def build(self, candidates: DataFrame) -> DataFrame:
        """Candidates (request_url, position, locator and fields) as rows: cleaned fields, and why a row is none."""
        kept = [c for c in candidates.columns if c not in ("request_url", "position", "locator")]
        cleaned = [(clean_value(F.col(c)) if kind == "string" else F.col(c)).alias(c) for c, kind in candidates.dtypes if c in kept]
        error = F.lit(None).cast("string")
        for c, kind in candidates.dtypes:
            if c in kept and kind == "string":
                error = F.coalesce(error, F.when(value_error(F.col(c)).isNotNull(), f"invalid_document_{c}"))
        return candidates.select("request_url", "position", "locator", *cleaned, error.alias("error"))


class JsonList(Base):
    """An API whose body has results[] and next_page_url; one row a result, paging up to ``max_pages``."""

    contract = "docloom.json-list.v1"
    body = "struct<results:array<struct<document_number:string,title:string,type:string>>,next_page_url:string>"

    options = {"max_pages": int}

    def __init__(self, max_pages: int = 10):
        self.max_pages = max_pages

    def parse(self, responses: DataFrame) -> DataFrame:
        read = responses.select("request_url", F.from_json("body", self.body).alias("b"))
        return read.select("request_url", F.posexplode("b.results").alias("position", "r")).select("request_url", "position", F.concat(F.lit("/results/"), F.col("position")).alias("locator"), "r.*")

    def next_requests(self, responses: DataFrame, depth: int) -> DataFrame:
        url = F.get_json_object("body", "$.next_page_url")
        return responses.select(url.alias("request_url")).where(F.col("request_url").isNotNull() & F.lit(depth + 1 < self.max_pages)).distinct()


class HtmlList(Base):
    """Pages whose anchors lead to documents (by pattern) or to further pages."""

    contract = "docloom.html-list.v1"

    options = {"detail": str}

    def __init__(self, detail: str):
        self.detail = detail

    def _anchors(self, responses: DataFrame) -> DataFrame:
        return anchors(responses.select(F.col("request_url").alias("page_id"), F.col("request_url").alias("url"), F.col("body").alias("html")))

    def parse(self, responses: DataFrame) -> DataFrame:
        found = self._anchors(responses).where(F.col("address").rlike(self.detail))
        return found.select(F.col("page_id").alias("request_url"), "position", F.col("address").alias("locator"), F.col("text").alias("title"))

    def next_requests(self, responses: DataFrame, depth: int) -> DataFrame:
        return self._anchors(responses).where(~F.col("address").rlike(self.detail) & F.col("same_host")).select(F.col("address").alias("request_url")).distinct()


class PostbackList(Base):
    """Lists that post a form back for their next page; one row a document, and the form of the page that follows."""

    contract = "docloom.postback-list.v1"

    def _lists(self, responses: DataFrame) -> DataFrame:
        return list_pages(responses.select(F.col("request_url").alias("page_id"), F.col("request_url").alias("url"), F.col("body").alias("html")))

    def parse(self, responses: DataFrame) -> DataFrame:
        found = self._lists(responses).select(F.col("page_id").alias("request_url"), F.posexplode("details").alias("position", "locator"))
        return found.select("request_url", "position", "locator", F.regexp_extract("locator", r"[?&]docid=(\d+)", 1).alias("document_number"))

    def next_requests(self, responses: DataFrame, depth: int) -> DataFrame:
        """request_url, form (fields to post) and number (that the next page must show)."""
        event = F.create_map(F.lit("__EVENTTARGET"), F.col("target"), F.lit("__EVENTARGUMENT"), F.col("argument"))
        held = F.map_filter("fields", lambda k, _: ~k.isin("__EVENTTARGET", "__EVENTARGUMENT"))
        lists = self._lists(responses).where("argument IS NOT NULL")
        return lists.select(F.col("action").alias("request_url"), F.map_concat(held, event).alias("form"), (F.col("number") + 1).alias("number"))


ADAPTERS: dict[str, type] = {"json_list": JsonList, "html_list": HtmlList, "postback_list": PostbackList}


def adapter(name: str, **options) -> Adapter:
    """An adapter by name; unknown names and options are refused."""
    if name not in ADAPTERS:
        raise ConfigError("unknown_adapter")
    ADAPTERS[name].validate_options(options)
    try:
        return ADAPTERS[name](**options)
    except TypeError:
        raise ConfigError("invalid_adapter_options") from None
