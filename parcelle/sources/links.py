"""Link extraction from listing pages stored as a (url, html) table.

The landing job reads directory listings: an anchor whose text (slashes
stripped) is all digits names a year folder; an anchor whose ``href`` ends
with the file suffix names a file, fetched from ``listing url + href``.
The network fetch itself is out of scope; this is the table transform.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# An anchor (href in double quotes) and any tag
ANCHOR_PATTERN = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'
TAG_PATTERN = r"<[^>]*>"


def extract_links(pages: DataFrame, url_col: str = "url", html_col: str = "html",
                  id_col: str = "page_id", suffix: str = ".gz") -> DataFrame:
    """One row per anchor: href, visible text, year (when the text is a
    number) and file URL (when the href ends with ``suffix``)."""
    anchors = pages.select(id_col, url_col,
                           F.explode(F.regexp_extract_all(html_col, F.lit(ANCHOR_PATTERN), 0)).alias("_a"))
    href = F.regexp_extract("_a", ANCHOR_PATTERN, 1)
    text = F.regexp_replace(F.regexp_extract("_a", ANCHOR_PATTERN, 2), TAG_PATTERN, "")
    out = anchors.select(id_col, url_col, href.alias("href"), text.alias("link_text"))
    stripped = F.expr("trim(BOTH '/' FROM link_text)")
    return out.select(
        id_col, "href", "link_text",
        F.when(stripped.rlike("^[0-9]+$"), stripped).alias("year"),
        F.when(F.col("href").endswith(suffix), F.concat(F.col(url_col), F.col("href"))).alias("file_url"))
