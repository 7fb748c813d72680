"""Page and URL extraction."""

from __future__ import annotations

from pyspark.sql import functions as F

from tableloom.operators import web
from tableloom.operators.keyed import product_with_bounded
from tableloom.registry import query

HTML = r"regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>', '', 'g')"
HREFS = rf"""[replace(replace(replace(replace(replace(h, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&')
  for h in regexp_extract_all({HTML}, '(?is)<a\s[^>]*?href\s*=\s*"([^"]*)"', 1)]"""
LINKS = f"""links AS (SELECT page_id, generate_subscripts(h, 1) - 1 AS pos, unnest(h) AS href FROM (SELECT page_id, {HREFS} AS h FROM pages))"""


def clean_sql(expr: str) -> str:
    return f"""replace(replace(replace(replace(replace(regexp_replace({expr}, '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'),
  '&quot;', '"'), '&#39;', ''''), '&amp;', '&')"""


def bigpos(df):
    return df.withColumn("pos", F.col("pos").cast("bigint"))


@query("h1_image_sources", """
SELECT page_id, unnest([url, 'b&' || page_id]) AS src FROM pages""")
def h1(t):
    """The stored pages have no pictures, so each gets two tags around its markup."""
    tagged = F.concat(
        F.lit('<img alt="x" src="'), F.col("url"), F.lit('">'), F.col("html"), F.lit("<IMG SRC='b&amp;"),
        F.col("page_id").cast("string"), F.lit("'/>"),
    )
    pages = t.pages.select("page_id", tagged.alias("html"))
    return web.links(pages, "img", "src").select("page_id", F.col("href").alias("src"))


@query("h2_matching_anchors", f"""
WITH {LINKS}, m AS (SELECT * FROM links WHERE regexp_matches(href, '^/[a-z]')) SELECT page_id,
  row_number() OVER (PARTITION BY page_id ORDER BY pos) - 1 AS pos, href FROM m""")
def h2(t):
    return bigpos(web.links(t.pages, pattern="^/[a-z]"))


@query("h3_heading_texts", rf"""
SELECT page_id, pos, text FROM (SELECT page_id, generate_subscripts(h, 1) - 1 AS pos, {clean_sql('unnest(h)')} AS text
FROM (SELECT page_id, regexp_extract_all({HTML}, '(?is)<h1\b[^>]*>(.*?)</h1\s*>', 1) AS h FROM pages))""")
def h3(t):
    return bigpos(t.pages.select("page_id", F.posexplode(web.leaf_texts(F.col("html"), "h1")).alias("pos", "text")))


@query("h3_blocks_by_class", rf"""
SELECT page_id, pos, text FROM (SELECT page_id, generate_subscripts(h, 1) - 1 AS pos, {clean_sql('unnest(h)')} AS text
FROM (SELECT page_id, regexp_extract_all({HTML}, '(?is)<div class="ad"[^>]*>(.*?)</div\s*>', 1) AS h FROM pages))""")
def h3_blocks(t):
    return bigpos(t.pages.select("page_id", F.posexplode(web.block_texts(F.col("html"), "div", "ad")).alias("pos", "text")))


@query("h4_element_metadata", """
SELECT page_id, url AS ou, CASE page_id % 2 WHEN 0 THEN 'png' ELSE 'jpg' END AS ity FROM pages""")
def h4(t):
    """Each page's own address and a type, put into an element as JSON and read back."""
    kind = F.when(F.col("page_id") % 2 == 0, "png").otherwise("jpg")
    meta = F.to_json(F.struct(F.col("url").alias("ou"), kind.alias("ity")))
    block = F.concat(F.col("html"), F.lit('<div class="rg_meta x">'), F.replace(meta, F.lit("&"), F.lit("&amp;")), F.lit("</div>"))
    texts = web.block_texts(F.col("html"), "div", "rg_meta")
    return t.pages.select("page_id", block.alias("html")).select(
        "page_id", F.explode(web.metadata(texts, "ou", "ity")).alias("m")
    ).select("page_id", "m.*")


@query("h5_nested_json_item", "SELECT page_id, url AS item FROM pages")
def h5(t):
    page = F.to_json(F.array(F.array(F.lit("meta")), F.array(F.lit("skip"), F.col("url"))))
    return t.pages.select("page_id", web.nested_item(page, 1, 1).alias("item"))


@query("h6_query_url", r"""
SELECT p_partkey, 'http://search.example.com/find?q=' || regexp_replace(trim(p_name || '   ' || p_type), '\s+', '+', 'g') || '&page=1' AS url FROM part""")
def h6(t):
    words = web.query_words(F.concat(F.lit(" "), "p_name", F.lit("   "), "p_type", F.lit(" ")))
    return t.part.select("p_partkey", web.filled("http://search.example.com/find?q={q}&page=1", q=words).alias("url"))


@query("h7_url_grid", """
SELECT r_name || '+' || p_type AS q, start, 'http://search.example.com/?q=' || r_name || '+' || p_type || '&start=' || start AS url
FROM region, (SELECT DISTINCT p_type FROM part), (SELECT CAST(unnest(range(0, 100, 10)) AS INTEGER) AS start)""")
def h7(t):
    terms = t.part.select("p_type").distinct()
    pairs = product_with_bounded(terms, t.region.select("r_name"))
    grid = web.offsets(pairs.select(F.concat_ws("+", "r_name", "p_type").alias("q")), 100)
    return grid.select("q", "start", web.filled(
        "http://search.example.com/?q={q}&start={s}", q=F.col("q"), s=F.col("start")).alias("url"))


@query("h8_numbered_pages", """
SELECT p_partkey, 'http://album.example.com/' || p_partkey || '/' || n || '.html' AS url FROM
(SELECT p_partkey, unnest(range(1, p_size + 1)) AS n FROM part)""")
def h8(t):
    base = F.concat(F.lit("http://album.example.com/"), F.col("p_partkey").cast("string"))
    return t.part.select("p_partkey", F.explode(web.numbered_pages(base, F.col("p_size"))).alias("url"))


@query("h9_unique_links", f"""
WITH {LINKS}, f AS (SELECT href, min(page_id * 100000 + pos) AS first FROM links GROUP BY 1)
SELECT href, first // 100000 AS page_id, first % 100000 AS pos, row_number() OVER (ORDER BY first) AS number FROM f""")
def h9(t):
    return web.unique_numbered(bigpos(web.links(t.pages)), "href", ["page_id", "pos"])


@query("h10_picture_name", """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN list_extract(string_split(url, '/'), -1) || '.jpg' ELSE 'error.jpg' END AS name FROM pages""")
def h10(t):
    address = F.when(F.col("page_id") % 2 == 0, F.concat(F.col("url"), F.lit(".jpg"))).otherwise(F.col("url"))
    return t.pages.select("page_id", web.picture_name(address).alias("name"))


TITLE = rf"""{clean_sql(rf"regexp_extract({HTML}, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")}"""


@query("h11_title_parse", f"""
SELECT page_id, replace(string_split(title || ' (1/' || length(url) || ')', ' (')[1] || '[' || length(url) || ']', '/', ' ') AS album
FROM (SELECT page_id, url, {TITLE} AS title FROM pages)""")
def h11(t):
    title = F.concat(
        web.leaf_texts(F.col("html"), "title")[0], F.lit(" (1/"), F.length("url").cast("string"), F.lit(")")
    )
    return t.pages.select("page_id", web.album_title(title).alias("album"))


@query("h12_every_other_node", f"WITH {LINKS} SELECT page_id, pos, href FROM links WHERE pos % 2 = 0")
def h12(t):
    return bigpos(web.links(t.pages)).where("pos % 2 = 0")


@query("h13_not_yet_stored", f"""
WITH {LINKS}, m AS (SELECT DISTINCT '/' || word AS href FROM (SELECT unnest(string_split(text, ' ')) AS word FROM benchmark))
SELECT page_id, href FROM links WHERE href NOT IN (SELECT href FROM m)""")
def h13(t):
    words = t.benchmark.select(F.explode(F.split("text", " ")).alias("w"))
    stored = words.select(F.concat(F.lit("/"), "w").alias("href"))
    return web.not_yet_stored(web.links(t.pages).select("page_id", "href"), stored, "href")


@query("s28_file_manifest", """
SELECT page_id, kind || '_' || row_number() OVER (PARTITION BY kind ORDER BY page_id) || '.html' AS file_name
FROM (SELECT page_id, split_part(url, '/', 4) AS kind FROM pages)""")
def s28(t):
    files = t.pages.select("page_id", F.split_part("url", F.lit("/"), F.lit(4)).alias("kind"))
    return web.file_manifest(files, "kind", ["page_id"], F.lit("html")).select("page_id", "file_name")
