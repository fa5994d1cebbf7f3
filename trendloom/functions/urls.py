"""Host names of links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendloom.dictionaries import ALLOWED_DOMAINS

# What stands between "//" and the next "/", "?" or "#"; user and port stay in.
NETLOC = r"^(?:[A-Za-z0-9+.-]+:)?//([^/?#]*)"
# The last two word labels, ASCII letters only, at the very end.
PRIMARY_DOMAIN = r"(\w+\.\w+)$"


def netloc(url: Column) -> Column:
    """Network location of a link; empty when the link has no ``//`` part."""
    return F.regexp_extract(url, NETLOC, 1)


def primary_domain(host: Column) -> Column:
    """Last two labels of the host; the host itself when it has no such ending."""
    labels = F.regexp_extract(host, PRIMARY_DOMAIN, 1)
    return F.when(labels != "", labels).otherwise(host)


def all_allowed(primary_domains: Column, allowed: Sequence[str] = ALLOWED_DOMAINS) -> Column:
    """True when every domain is on the list (also for an empty array)."""
    return F.forall(primary_domains, lambda domain: domain.isin(*allowed))
