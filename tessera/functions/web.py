"""URL builders: U2 extract_domain, U3 normalize_url, T11h url_part."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions._util import col

# netloc of a URL that has '//' after an optional scheme (user, password and port kept)
NETLOC_RE = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


# Characters urlsplit removes before parsing — leading C0 controls and
# space (stripped from the left) and TAB, CR, LF (deleted anywhere).
URL_LEADING = "".join(chr(i) for i in range(0x21))
URL_DELETED = "\t\r\n"


# brackets may only hold an IPv6 (or later) address, and hold all of the host
_HOST_OK = r"^(?:[^\[\]]*|(?:[^@\[\]]*@)?\[(?:[0-9A-Fa-f:.]*:[0-9A-Fa-f:.]*|v[0-9A-Fa-f]+\..+)\](?::[^\[\]]*)?)$"


def _cleaned(c) -> Column:
    return F.ltrim(F.translate(col(c), URL_DELETED, ""), F.lit(URL_LEADING))


def extract_domain(c) -> Column:
    """The netloc part of the URL, '' when the URL has no '//' authority, null
    when the authority is invalid (unbalanced or wrongly filled brackets)."""
    netloc = F.regexp_extract(_cleaned(c), NETLOC_RE, 1)
    return F.when(netloc.rlike(_HOST_OK), netloc)


# Schemes that relative references are resolved for.
RELATIVE_SCHEMES = ["", "ftp", "http", "gopher", "nntp", "imap", "wais", "file", "https", "shttp", "mms", "prospero",
                    "rtsp", "rtsps", "rtspu", "sftp", "svn", "svn+ssh", "ws", "wss"]
_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"


def _parts(u: Column) -> dict[str, Column]:
    rest = F.regexp_replace(u, _SCHEME, "")
    return {"scheme": F.lower(F.regexp_extract(u, _SCHEME, 1)), "has_host": rest.startswith("//"),
            "host": F.regexp_extract(rest, r"^//([^/?#]*)", 1),
            "path": F.regexp_extract(F.regexp_replace(rest, r"^//[^/?#]*", ""), r"^([^?#]*)", 1),
            "query": F.regexp_extract(rest, r"^[^?#]*\?([^#]*)", 1)}


def _joined_path(base: Column, ref: Column) -> Column:
    """RFC 3986 5.2: the reference's path on the base's, without '.', '..' and empty segments."""
    own, of = F.split(ref, "/", -1), F.split(base, "/", -1)
    folder = F.when(F.element_at(of, -1) == "", of).otherwise(F.slice(of, 1, F.size(of) - 1))
    segments = F.when(ref.startswith("/"), own).otherwise(F.concat(folder, own))
    inner = F.filter(segments, lambda x, i: (i == 0) | (i == F.size(segments) - 1) | (x != ""))
    walked = F.aggregate(inner, F.array().cast("array<string>"), lambda acc, x: F.when(
        x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.concat(acc, F.array(x))))
    walked = F.when(F.element_at(own, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    joined = F.array_join(walked, "/")
    return F.when(joined == "", "/").otherwise(joined)


def url_join(base, url) -> Column:
    """RFC 3986 reference resolution as Python's ``urljoin`` does it (a ';' belongs to
    the path): one expression, no Python. Null when either has an invalid authority."""
    b, u = col(base), col(url)
    bp, up = _parts(b), _parts(u)
    scheme = F.when(up["scheme"] == "", bp["scheme"]).otherwise(up["scheme"])
    host = F.when(up["host"] != "", up["host"]).otherwise(bp["host"])
    path = (F.when(up["host"] != "", up["path"]).when(up["path"] == "", bp["path"]).otherwise(_joined_path(bp["path"], up["path"])))
    path = F.when((host != "") & (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)).otherwise(path)
    query = F.when((up["host"] == "") & (up["path"] == "") & (up["query"] == ""), bp["query"]).otherwise(up["query"])
    full = F.concat(F.when(scheme == "", "").otherwise(F.concat(scheme, F.lit(":"))),
                    F.when(host == "", "").otherwise(F.concat(F.lit("//"), host)), path,
                    F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)))
    same = (scheme == bp["scheme"]) & scheme.isin(*RELATIVE_SCHEMES)
    good = bp["host"].rlike(_HOST_OK) & up["host"].rlike(_HOST_OK)
    return (F.when(b.isNull() | u.isNull(), u).when(u == "", b).when(b == "", u).when(~good, F.lit(None).cast("string"))
            .when(same, full).otherwise(u))


def normalize_url(c, base=None) -> Column:
    """U3: ''/null -> '', cut at the first '#', resolve against ``base`` (a string or
    a Column) unless the URL already starts with http:// or https://; null when it
    cannot be resolved."""
    u = col(c)
    cut = F.substring_index(u, "#", 1)
    if base is None:
        resolved = cut
    else:
        b = F.lit(base) if isinstance(base, str) else base
        needs = ~(cut.startswith("http://") | cut.startswith("https://"))
        joined = url_join(b, cut)
        resolved = F.when(needs & b.isNotNull() & (b != ""), joined).otherwise(cut)
    return F.when(u.isNull() | (u == ""), F.lit("")).otherwise(resolved)


def url_part(c, index: int = 2, default: str = "unknown") -> Column:
    """T11h: ``url.split('/')[index]`` when the URL contains '/', else ``default``;
    a missing part is null (the reference's failure value)."""
    u = F.coalesce(col(c), F.lit(""))
    return F.when(F.instr(u, "/") > 0, F.get(F.split(u, "/"), index)).otherwise(F.lit(default))
