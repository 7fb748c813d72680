"""Links, element texts and metadata out of stored pages; URL lists.

Patterns run inside the JVM.  Only containers that may hold elements of their
own kind need a real parser; that one is a small function over Arrow batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableloom.functions import text as tx
from tableloom.operators.keyed import first_seen
from tableloom.plans.ordered import numbered

HIDDEN = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
# The named entities of plain HTML; the ampersand comes last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&"))


def unescape(text: Column) -> Column:
    for name, char in ENTITIES:
        text = F.replace(text, F.lit(name), F.lit(char))
    return text


def visible(html: Column) -> Column:
    """The page without comments, scripts and styles."""
    return F.regexp_replace(html, HIDDEN, "")


def tag_attributes(html: Column, tag: str, attribute: str) -> Column:
    """Values of an attribute over all tags of a kind that have it, in page order."""
    tags = F.regexp_extract_all(visible(html), F.lit(rf"(?is)<{tag}\b([^>]*)>"), F.lit(1))
    quoted = rf'(?is)(?:^|\s){attribute}\s*=\s*("[^"]*"|\'[^\']*\'|[^\s>]+)'
    found = F.transform(tags, lambda t: F.regexp_extract(t, quoted, 1))
    kept = F.filter(found, lambda v: v != "")
    return F.transform(kept, lambda v: unescape(F.regexp_replace(v, "^[\"']|[\"']$", "")))


def plain_text(html: Column) -> Column:
    """Markup removed, entities resolved."""
    return unescape(F.regexp_replace(html, "<[^>]*>", ""))


def leaf_texts(html: Column, tag: str) -> Column:
    """Texts of elements that cannot contain their own kind (headings, titles)."""
    inner = F.regexp_extract_all(visible(html), F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>"), F.lit(1))
    return F.transform(inner, plain_text)


class _Blocks(HTMLParser):
    """Collects the text of every element of one tag and class, also nested ones."""

    VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}

    def __init__(self, tag: str, class_name: str | None):
        super().__init__()
        self.tag, self.class_name = tag, class_name
        self.done: list[list[str]] = []
        self.open: list[list[str] | None] = []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag and tag not in self.VOID:
            classes = (dict(attrs).get("class") or "").split()
            wanted = self.class_name is None or self.class_name in classes
            block: list[str] | None = [] if wanted else None
            if block is not None:
                self.done.append(block)
            self.open.append(block)

    def handle_endtag(self, tag):
        if tag == self.tag and self.open:
            self.open.pop()

    def handle_data(self, data):
        for block in self.open:
            if block is not None:
                block.append(data)


def block_texts(html: Column, tag: str, class_name: str | None = None) -> Column:
    """Texts of elements by tag and class, where elements may be nested."""

    @F.pandas_udf("array<string>")
    def extract(pages: pd.Series) -> pd.Series:
        def one(page):
            if page is None:
                return []
            parser = _Blocks(tag, class_name)
            parser.feed(page)
            parser.close()
            return ["".join(block) for block in parser.done]

        return pages.map(one)

    return extract(html)


def links(pages: DataFrame, tag: str = "a", attribute: str = "href", pattern: str | None = None) -> DataFrame:
    """``(page_id, pos, href)``; ``pattern`` keeps matching ones, positions count what is kept."""
    found = tag_attributes(F.col("html"), tag, attribute)
    if pattern is not None:
        found = F.filter(found, lambda v: v.rlike(pattern))
    return pages.select("page_id", F.posexplode(found).alias("pos", "href"))


def metadata(texts: Column, *fields: str) -> Column:
    """Fields of JSON texts as structs."""
    return F.transform(texts, lambda j: F.struct(*[F.get_json_object(j, f"$.{f}").alias(f) for f in fields]))


def nested_item(json: Column, *indices: int) -> Column:
    """An item of nested JSON arrays, as ``page[1][1]``."""
    return F.get_json_object(json, "$" + "".join(f"[{i}]" for i in indices))


def query_words(query: Column) -> Column:
    """Words of a query joined by ``+``."""
    return F.regexp_replace(F.trim(query), r"\s+", "+")


def filled(template: str, **values: Column) -> Column:
    """A URL template such as ``http://host/search?q={q}`` with its fields filled in."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(before), values[name].cast("string")]
    return F.concat(*parts, F.lit(rest))


def offsets(df: DataFrame, count: int, step: int = 10, name: str = "start") -> DataFrame:
    """One row per offset 0, step, ... below ``count``."""
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(count - 1), F.lit(step))))


def numbered_pages(base: Column, count: Column) -> Column:
    """``base/1.html`` to ``base/count.html``."""
    return F.transform(F.sequence(F.lit(1), count), lambda n: F.concat(base, F.lit("/"), n.cast("string"), F.lit(".html")))


def unique_numbered(found: DataFrame, url: str, order: Sequence[str]) -> DataFrame:
    """Every URL once, at its first place, with a running number in that order."""
    return numbered(first_seen(found.select(url, *order), [url], list(order)), (), list(order), "number")


def picture_name(url: Column) -> Column:
    """The last path segment when it names a picture, else the error name."""
    last = F.substring_index(url, "/", -1)
    return F.when(F.contains(last, F.lit(".jpg")), last).otherwise(F.lit("error.jpg"))


def album_title(title: Column) -> Column:
    """``name (1/n)`` as ``name[n]``, slashes as spaces."""
    count = tx.last_number(title).cast("string")
    return F.replace(
        F.concat(F.substring_index(title, " (", 1), F.lit("["), count, F.lit("]")), F.lit("/"), F.lit(" ")
    )


def not_yet_stored(found: DataFrame, manifest: DataFrame, name: str) -> DataFrame:
    """Rows with a name that the manifest does not list yet."""
    return found.where(F.col(name).isNotNull()).join(manifest.select(name).distinct(), name, "left_anti")


def file_manifest(files: DataFrame, kind: str, order: Sequence[str], extension: Column) -> DataFrame:
    """Add ``file_name``: ``kind_n.extension`` with a counter per kind."""
    counted = numbered(files, [kind], list(order), "counter")
    return counted.withColumn(
        "file_name", F.concat(F.col(kind), F.lit("_"), F.col("counter").cast("string"), F.lit("."), extension)
    )
