"""Title, links and text of HTML pages by built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def html_title(page: Column) -> Column:
    """The title without blanks around; the empty string where there is none."""
    return F.trim(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1))


def html_links(page: Column) -> Column:
    """Targets of the anchors in order, as written."""
    return F.filter(F.transform(F.regexp_extract_all(page, F.lit(r"""(?is)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""), F.lit(1)), F.trim), lambda x: x != "")


def html_text(page: Column) -> Column:
    """Visible text with single blanks: scripts, styles, remarks and tags taken out, the five basic entities resolved."""
    x = F.regexp_replace(page, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]+>", " ")
    for entity, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(x, r"\s+", " "))
