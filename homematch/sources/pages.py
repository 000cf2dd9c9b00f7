"""Links and listing records from stored web pages."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from homematch.functions.text import absolute_url

# Element and class of each field on a listing page.
LISTING_SELECTORS = {
    "title": ("h1", "h4 md:text-xl leading-normal"),
    "address": ("div", "text-slate h4 font-normal leading-none font-heading"),
    "price_block": ("div", "otm-Price"),
    "price": ("span", "price"),
    "pricing_qualifier": ("small", "qualifier"),
    "time_block": ("div", "text-denim"),
    "listing_time": ("small", "font-heading"),
    "property_type": ("div", "otm-PropertyIcon"),
    "details": ("div", "font-heading text-xs flex flex-wrap border-t border-b mb-6 md:text-md py-3 md:py-4 md:mb-9"),
    "features_block": ("section", "otm-FeaturesList"),
    "feature": ("li", "otm-ListItemOtmBullet"),
}

# Texts written where a listing page lacks a field.
MISSING = {
    "title": "Title not available",
    "address": "Address not available",
    "price": "Price not available",
    "pricing_qualifier": "Price qualifier not available",
    "listing_time": "Listing time not available",
    "property_type": "Property type not available",
    "bedrooms": "Bedrooms info not available",
    "bathrooms": "Bathrooms info not available",
    "epc_rating": "EPC rating not available",
    "size": "Size info not available",
}

# Words that mark a detail block.
DETAIL_WORDS = {
    "bedrooms": ["bed"],
    "bathrooms": ["bath"],
    "epc_rating": ["epc rating"],
    "size": ["sq ft", "sq m"],
}

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


# Tasks get the parser with the job, so workers need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class _Node:
    """Element with its texts and child elements in page order."""

    __slots__ = ("tag", "classes", "href", "title", "items")

    def __init__(self, tag: str, attributes: dict[str, str | None]):
        self.tag, self.classes, self.items = tag, attributes.get("class") or "", []
        self.href, self.title = attributes.get("href"), attributes.get("title")

    def walk(self) -> Iterator["_Node | str"]:
        """Everything under this element in page order, without recursion."""
        waiting = list(reversed(self.items))
        while waiting:
            item = waiting.pop()
            yield item
            if isinstance(item, _Node):
                waiting.extend(reversed(item.items))

    def find_all(self, selector: tuple[str, str | None]) -> Iterator["_Node"]:
        tag, classes = selector
        for item in self.walk():
            if isinstance(item, _Node) and item.tag == tag:
                if classes is None or item.classes == classes or classes in item.classes.split():
                    yield item

    def find(self, selector: tuple[str, str | None]) -> "_Node | None":
        return next(self.find_all(selector), None)

    def text(self) -> str:
        return "".join(item.strip() for item in self.walk() if isinstance(item, str))


class _Page(HTMLParser):
    """Element tree of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = _Node("", {})
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs))
        self.open[-1].items.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.open[-1].items.append(_Node(tag, dict(attrs)))

    def handle_endtag(self, tag):
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                del self.open[i:]
                return

    def handle_data(self, data):
        if self.open[-1].tag not in ("script", "style"):
            self.open[-1].items.append(data)


def parsed(html: str) -> _Node:
    """Root element of a page."""
    page = _Page()
    page.feed(html)
    page.close()
    return page.root


def listing_record(html: str, selectors: dict[str, tuple[str, str | None]]) -> dict[str, object]:
    """Fields of one listing page."""
    root = parsed(html)

    def text_of(name: str, block: _Node | None) -> str:
        found = block.find(selectors[name]) if block is not None else None
        return found.text() if found is not None else MISSING[name]

    prices, times = root.find(selectors["price_block"]), root.find(selectors["time_block"])
    record: dict[str, object] = {name: text_of(name, root) for name in ("title", "address", "property_type")}
    record["price"], record["pricing_qualifier"] = text_of("price", prices), text_of("pricing_qualifier", prices)
    record["listing_time"] = text_of("listing_time", times)
    details = root.find(selectors["details"])
    blocks = [node.text() for node in details.find_all(("div", None))] if details is not None else []
    for name, words in DETAIL_WORDS.items():
        record[name] = next((b for b in blocks if any(w in b.lower() for w in words)), MISSING[name])
    section = root.find(selectors["features_block"])
    record["features"] = [node.text() for node in section.find_all(selectors["feature"])] if section is not None else []
    return record


RECORD_FIELDS = [*MISSING, "features"]
RECORD_SCHEMA = ", ".join(["page_id bigint", "property_url string"] + [f"{c} string" for c in MISSING] + ["features array<string>", "error string"])


def listing_records(pages: DataFrame, selectors: dict[str, tuple[str, str | None]] | None = None) -> DataFrame:
    """One record per stored page; an unreadable or empty page carries its ``error``."""
    chosen = {**LISTING_SELECTORS, **(selectors or {})}

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                row = dict.fromkeys(RECORD_FIELDS)
                row.update(page_id=page_id, property_url=url, error=None)
                if not html:
                    row["error"] = "empty page"
                else:
                    try:
                        row.update(listing_record(html, chosen))
                    except Exception as problem:  # a bad page must not stop the others
                        row["error"] = f"{type(problem).__name__}: {problem}"
                rows.append(row)
            yield pd.DataFrame(rows, columns=["page_id", "property_url", *RECORD_FIELDS, "error"])

    return pages.select("page_id", "url", "html").mapInPandas(parse, RECORD_SCHEMA)


def readable_records(records: DataFrame) -> DataFrame:
    return records.where(F.col("error").isNull()).drop("error")


def failed_records(records: DataFrame) -> DataFrame:
    """Pages kept only with their error."""
    return records.where(F.col("error").isNotNull()).select("page_id", "property_url", "error")


def _from_pages(html: Column, kind: str, pick: Callable[[_Node], object]) -> Column:
    """What ``pick`` takes from each parsed page; null for a null or unreadable page."""

    def take(page: str | None) -> object:
        if page is None:
            return None
        try:
            return pick(parsed(page))
        except Exception:  # a bad page must not stop the others
            return None

    @F.pandas_udf(kind)
    def run(htmls: pd.Series) -> pd.Series:
        return pd.Series([take(h) for h in htmls], dtype=object)

    return run(html)


def anchors(html: Column) -> Column:
    """Targets of all links on a page."""
    return _from_pages(html, "array<string>", lambda root: [a.href for a in root.find_all(("a", None)) if a.href is not None])


def listing_links(pages: DataFrame, base: str, prefix: str = "/details/") -> DataFrame:
    """Distinct absolute addresses of the listing links on search pages."""
    links = pages.select(F.explode(anchors(F.col("html"))).alias("link"))
    urls = links.select(absolute_url(base, F.col("link"), prefix).alias("property_url"))
    return urls.where(F.col("property_url").isNotNull()).distinct()


def next_page(html: Column, base: str, title: str = "Next page") -> Column:
    """Absolute address of the following search page, null on the last one."""
    link = _from_pages(html, "string", lambda root: next((a.href for a in root.find_all(("a", None)) if a.title == title), None))
    return F.when(link != "", F.concat(F.lit(base), link))


def feature_bullets(html: Column, section: str = "otm-FeaturesList", item: str = "otm-ListItemOtmBullet") -> Column:
    """Texts of the feature bullets of a listing page; none without the section."""

    def bullets(root: _Node) -> list[str]:
        block = root.find(("section", section))
        return [node.text() for node in block.find_all(("li", item))] if block is not None else []

    return _from_pages(html, "array<string>", bullets)
