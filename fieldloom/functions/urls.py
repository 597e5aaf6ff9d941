"""URL audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hosts that uploads may go to, and default ports.
UPLOAD_HOSTS = [".amazonaws.com", ".storage.googleapis.com", ".blob.core.windows.net"]
PORTS = {"http": "80", "https": "443"}


def _part(url: Column, what: str) -> Column:
    return F.try_parse_url(url, F.lit(what))


def origin_of(url: Column) -> Column:
    """scheme://host[:port], lower case, without a default port; empty if there is none."""
    scheme, host = F.lower(_part(url, "PROTOCOL")), F.lower(_part(url, "HOST"))
    port = F.nullif(F.regexp_extract(_part(url, "AUTHORITY"), r":(\d+)$", 1), F.lit(""))
    default = F.lit(False)
    for s, p in PORTS.items():
        default = default | ((scheme == s) & (port == p))
    bad = port.isNotNull() & (F.coalesce(port.try_cast("int"), F.lit(65536)) > 65535)
    shown = F.when(port.isNull() | default, F.concat(scheme, F.lit("://"), host)).otherwise(F.concat(scheme, F.lit("://"), host, F.lit(":"), port))
    return F.when(scheme.isNull() | host.isNull() | (host == "") | bad, "").otherwise(shown)


def url_audit(df: DataFrame, url: str, allow: list[str] | None = None) -> DataFrame:
    """Flags by URL: path traversal, encoded traversal, embedded scheme, double slash, line break; https on an allowed host; its origin."""
    path = F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1), F.lit(""))
    low = F.lower(path)
    host = F.lower(_part(F.col(url), "HOST"))
    good = F.lit(False)
    for suffix in UPLOAD_HOSTS if allow is None else allow:
        good = good | host.endswith(suffix) | (host == suffix.lstrip("."))
    return df.withColumns({
        "traversal": path.rlike(r"/\.\.?/|/\.\.$"),
        "encoded_traversal": low.rlike("%2e%2e"),
        "embedded_scheme": F.contains(low, F.lit("://")),
        "double_slash": path.rlike("//"),
        "line_break": F.coalesce(F.col(url).rlike(r"[\r\n]"), F.lit(False)),
        "allowed_host": F.coalesce((F.lower(_part(F.col(url), "PROTOCOL")) == "https") & good, F.lit(False)),
        "origin": origin_of(F.col(url)),
    })
