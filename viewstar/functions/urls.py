"""Country code read off a URL's host."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNKNOWN = "unknown"

# The host is the text between "//" and the next "/", "?" or "#", after an optional scheme.
START = r"^[\x00-\x20]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//"
END = r"(?:[/?#]|\z)"
LAST_LABEL = START + r"[^/?#]*\.([^./?#]{2})" + END
LABEL_BEFORE = START + r"[^/?#]*\.([^./?#]{2})\.[^./?#]*" + END


def url_country(url) -> Column:
    """Two-letter last label of the host, else a two-letter label before it, else unknown.

    A label counts only after another one. The rule looks at label length alone, so an IP
    address or a port takes part in it as any other text does. A bracketed host that never
    closes, or never opens, counts as malformed.
    """
    url = F.col(url) if isinstance(url, str) else url
    cleaned = F.translate(url, "\t\r\n", "")
    opened, closed = (cleaned.rlike(START + r"[^/?#]*" + bracket)
                      for bracket in (r"\[", r"\]"))
    malformed = (url.contains("[") | url.contains("]")) & (opened != closed)
    label = F.coalesce(*[F.nullif(F.regexp_extract(cleaned, pattern, 1), F.lit(""))
                         for pattern in (LAST_LABEL, LABEL_BEFORE)])
    return F.when(malformed, UNKNOWN).otherwise(F.coalesce(F.lower(label), F.lit(UNKNOWN)))
